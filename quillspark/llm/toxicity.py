"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade > k | x) = sigmoid(w.x - t_k): the weights w are shared by all thresholds t_0 < t_1 < ..., which differ by
positive steps and so stay in order. Grades are 0 (clean), 1 (mild) and 2 (severe): a labelled row is clean or toxic by
its label, and a toxic one severe if its share of words that mark toxic rows is above the median. Which words mark is
learnt on the other half of the rows, so that no row's grade is made of what is learnt from it. The expected severity is
the sum over k of P(grade > k), between 0 and 2.

Features are the distinct words of the whole text, their beginnings of PREFIX letters, and the beginnings that two or more
longer words share (forms of one stem), hashed to DIM numbers. Only features that are LIFT times as frequent in one class as in the other, beyond chance
(LEAST_Z), have a weight: the many words of a long text that say nothing don't add up; of these the MOST_FEATURES
clearest are kept. Learning takes about SAMPLE labelled rows by a hash of doc_id, a documented bound, and one of each
group of near copies; the cut that rejects is chosen on the fifth of them that is kept out of learning.

Features of the sampled rows are a table, and are counted where they lie. The driver gets counts by feature (DIM at most),
four hashes a row, and for each row which of the kept features it has: bounded by SAMPLE, DIM and MOST_FEATURES, however
long the texts are.

Null and empty texts have no features: their severity is what the thresholds give. Labels that are null or whose doc_id
is unknown are left out; of several labels of a document the highest counts. Without both classes nothing is learnt and
every severity is 0. Of severities that are equal to the cut none is rejected. Extra columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import bounded, materialize, pieces
from quillspark.storage import release

DIM, PREFIX, SAMPLE, LEAST_DOCS, LIFT, LEAST_Z, RARE, SLACK, MOST_FEATURES = 1 << 20, 4, 20_000, 4, 8.0, 4.0, 0.01, 0.005, 4096
#: Beginnings whose weights a worker keeps.
CACHE = 100_000
_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> set[str]:
    return set(_TOKEN.findall((text or "").lower()))


def slot(x: str) -> int:
    return zlib.crc32(x.encode()) % DIM


def features(words: set[str]) -> np.ndarray:
    """Slots of words, beginnings and shared beginnings, in the same order on every run."""
    stems = Counter(w[:PREFIX] for w in words if len(w) > PREFIX)
    shared = [slot("2^" + x) for x, n in sorted(stems.items()) if n > 1]
    return np.array([s for w in sorted(words) for s in (slot(w), slot("^" + w[:PREFIX]))] + shared, np.int32)


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float
    stems: dict[str, tuple[float, float]] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        at = np.flatnonzero(self.weights)
        self.table = dict(zip(at.tolist(), self.weights[at].tolist(), strict=True))

    def _stem(self, stem: str) -> tuple[float, float]:
        """What a beginning adds for each word, and once more when a second word shares it."""
        got = self.table.get(slot("^" + stem), 0.0), self.table.get(slot("2^" + stem), 0.0)
        if len(self.stems) < CACHE:
            self.stems[stem] = got
        return got

    def raw(self, words: set[str]) -> float:
        total, get, stems, seen, crc = 0.0, self.table.get, self.stems, set(), zlib.crc32
        shared = set()
        for w in words:
            stem = w[:PREFIX]
            got = stems.get(stem) or self._stem(stem)
            total += get(crc(w.encode()) % DIM, 0.0) + got[0]
            if got[1] and len(w) > PREFIX:
                if stem in seen and stem not in shared:
                    shared.add(stem)
                    total += got[1]
                seen.add(stem)
        return total

    def above(self, raw: np.ndarray) -> np.ndarray:
        """P(grade > k), a column for each k."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(raw, np.float64)[:, None] - self.thresholds, -40, 40)))

    def severity(self, raw: np.ndarray) -> np.ndarray:
        return self.above(raw).sum(axis=1)


def rows_of(slots: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every entry."""
    cols = np.concatenate(slots) if slots else np.zeros(0, np.int32)
    return np.repeat(np.arange(len(slots)), [len(s) for s in slots]), cols


def sketch(slots: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Four least hashes of a row's features, of those that aren't common: near copies share the first or the second two.

    Shorter rows have fewer; they are alike if all agree.
    """
    own = slots[~common[slots]]
    h = np.unique((own if len(own) > 1 else slots).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16))
    return h[:4].astype(np.int64)


def unlike(sketches: list[np.ndarray]) -> np.ndarray:
    """The first row of each group of near copies, whose rare words would all seem to tell their class."""
    seen, out = set(), []
    for i, h in enumerate(sketches):
        keys = {(0, *h[:2].tolist()), (1, *h[2:].tolist())} if len(h) > 3 else {(0, *h.tolist())}
        if not seen & keys:
            out.append(i)
        seen |= keys
    return np.array(out, np.int64)


def telling(bad: np.ndarray, rest: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Which features say something about the class, and which of these mark the toxic one.

    bad, rest: in how many of the n toxic and the m other rows each feature is.
    """
    n, m = max(1, n), max(1, m)
    p, q, both = bad / n, rest / m, (bad + rest) / (n + m)
    z = (p - q) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n + 1 / m))
    lift = (bad + 0.5) / n / ((rest + 0.5) / m)
    mark = (z > LEAST_Z) & (lift > LIFT) & (bad >= LEAST_DOCS)
    tells = mark | ((z < -LEAST_Z) & (lift < 1 / LIFT) & (rest >= LEAST_DOCS))
    if tells.sum() > MOST_FEATURES:
        tells &= np.abs(z) >= np.partition(np.abs(z[tells]), -MOST_FEATURES)[-MOST_FEATURES]
    return tells, mark & tells


def fit(slots: list[np.ndarray], grades: np.ndarray, marks: np.ndarray | None = None, k: int = 3, steps: int = 200, l2: float = 2e-5, rate: float = 0.1) -> Model:
    """Adam on the cumulative-link likelihood, both classes weighing the same.

    marks: by feature, whether it marks the toxic class; such a weight isn't negative, any other isn't positive.
    """
    n = len(slots)
    row, cols = rows_of(slots)
    names, cols = np.unique(cols, return_inverse=True)
    w_all, m, v = [np.zeros(len(names)), np.array([0.0]), np.zeros(k - 2)], [0.0] * 3, [0.0] * 3
    weight = np.where(grades > 0, 0.5 * n / max(1, (grades > 0).sum()), 0.5 * n / max(1, (grades == 0).sum()))
    for step in range(1, steps + 1):
        w, base, gaps = w_all
        t = base[0] + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        raw = np.bincount(row, weights=w[cols], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(raw[:, None] - t, -40, 40)))
        # log P(grade g) = log(P(> g-1) - P(> g)); its derivatives by raw and by the thresholds
        up = np.concatenate((np.ones((n, 1)), p, np.zeros((n, 1))), axis=1)
        hi, lo = up[np.arange(n), grades], up[np.arange(n), grades + 1]
        d_hi, d_lo, mass = hi * (1 - hi), lo * (1 - lo), np.maximum(hi - lo, 1e-9)
        g_raw = -weight * (d_hi - d_lo) / mass / n
        g_t = np.zeros(k - 1)
        for j in range(k - 1):
            g_t[j] = (weight * (np.where(grades == j + 1, d_hi, 0) - np.where(grades == j, d_lo, 0)) / mass).sum() / n
        g = [np.bincount(cols, weights=g_raw[row], minlength=len(names)) + l2 * w, np.array([g_t.sum()]), np.array([g_t[j + 1 :].sum() * np.exp(gaps[j]) for j in range(k - 2)])]
        for i in range(3):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g[i], 0.999 * v[i] + 0.001 * g[i] ** 2
            w_all[i] = w_all[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        if marks is not None:
            w_all[0] = np.where(marks[names], np.maximum(w_all[0], 0), np.minimum(w_all[0], 0))
    full = np.zeros(DIM)
    full[names] = w_all[0]
    return Model(full, w_all[1][0] + np.concatenate(([0.0], np.cumsum(np.exp(w_all[2])))), 1.0)


def grades_of(shares: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0, 1 or 2: toxic rows are split at the median of their shares of marks."""
    out = toxic.astype(np.int64)
    if toxic.any():
        out[(toxic == 1) & (shares > np.median(shares[toxic == 1]))] = 2
    return out


def best_cut(severity: np.ndarray, toxic: np.ndarray) -> float:
    """The highest severity that separates well: half way between two unlike ones at which wrong acceptances and, weighing
    double, wrong rejections are within SLACK of the fewest. 2 rejects nothing."""
    order = np.argsort(severity, kind="stable")
    s, t = severity[order], toxic[order]
    missed = np.concatenate(([0], np.cumsum(t))) / max(1, t.sum())
    hurt = ((1 - t).sum() - np.concatenate(([0], np.cumsum(1 - t)))) / max(1, (1 - t).sum())
    edges = np.concatenate(([s[0] - 0.1 if len(s) else 0], s, [2.0]))
    cost = np.where(edges[:-1] < edges[1:], missed + 2 * hurt, np.inf)  # between equal ones there is no cut
    cost[-1] = missed[-1] + 2 * hurt[-1]
    at = int(np.flatnonzero(cost <= cost.min() + SLACK)[-1])
    return float((edges[at] + edges[at + 1]) / 2)


def _counted(rows: DataFrame, kinds: int) -> np.ndarray:
    """In how many rows each feature is, by the rows' kind; kinds * DIM numbers at most. rows: kind, w."""

    def run(batches):
        out = np.zeros((kinds, DIM), np.int32)
        for b in pieces(batches):
            for kind, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                out[kind, np.unique(np.frombuffer(w, np.int32))] += 1
        kind, slot = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(out[kind, slot].astype(np.int64))], ["kind", "slot", "n"])

    got = rows.select("kind", "w").mapInArrow(run, "kind int, slot int, n long").groupBy("kind", "slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((kinds, DIM), np.int64)
    out[got.column("kind").to_numpy(), got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return out


def _each(rows: DataFrame, make) -> tuple[list, np.ndarray, list[np.ndarray]]:
    """k, toxic and the numbers that make(features) keeps of each row, in the order of k."""

    def run(batches):
        for b in pieces(batches):
            got = [make(np.frombuffer(w, np.int32)) for w in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x.astype(np.int64).tobytes() for x in got], pa.binary())], ["k", "toxic", "x"])

    got = rows.select("k", "toxic", "w").mapInArrow(run, T.StructType([rows.schema["k"], rows.schema["toxic"], T.StructField("x", T.BinaryType())])).toArrow().sort_by([("k", "ascending"), ("x", "ascending")])
    return got.column("k").to_pylist(), got.column("toxic").to_numpy().astype(np.int64), [np.frombuffer(x.as_buffer(), np.int64) for x in got.column("x")]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled rows of docs."""
    bounded(docs.sparkSession)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("k")).agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > sample:
        known = known.where(F.shiftrightunsigned(F.xxhash64(F.lit(5), F.col("k")), 11) / float(1 << 53) < sample / n)
    known = known.select("k", (F.col("toxic") > 0).cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id").alias("k"), "text").join(F.broadcast(known), "k")  # about `sample` rows of 12 bytes

    def words(batches):
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([features(tokens(t)).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["k", "toxic", "w"])

    schema = T.StructType([T.StructField("k", docs.schema["doc_id"].dataType), T.StructField("toxic", T.IntegerType()), T.StructField("w", T.BinaryType())])
    table = materialize(rows.select("k", "text", "toxic").mapInArrow(words, schema))
    nothing = Model(np.zeros(DIM), np.array([40.0, 41.0]), 1.0)
    seen = table.count()
    common = _counted(table.withColumn("kind", F.lit(0)), 1)[0] > RARE * seen
    keys, toxic, sketches = _each(table, lambda s: sketch(s, common))
    one = unlike(sketches)
    toxic = toxic[one]
    if not 0 < toxic.sum() < len(toxic):
        release(table)
        return nothing
    taken = table.join(F.broadcast(docs.sparkSession.createDataFrame([(keys[i],) for i in one.tolist()], T.StructType([schema["k"]])).distinct()), "k").dropDuplicates(["k"])
    half = F.crc32(F.concat(F.lit("half"), F.col("k").cast("string")).cast("binary")) % 2
    kept = materialize(taken.withColumn("kind", (2 * half + F.col("toxic")).cast("int")))
    release(table)
    counts = _counted(kept, 4)
    sizes = {r["kind"]: r["count"] for r in kept.groupBy("kind").count().collect()}
    many = [sizes.get(i, 0) for i in range(4)]
    tells, marks = telling(counts[1] + counts[3], counts[0] + counts[2], many[1] + many[3], many[0] + many[2])
    by_half = [telling(counts[2 * h + 1], counts[2 * h], many[2 * h + 1], many[2 * h])[1] for h in range(2)]
    # The last number of a row says which share of its features the other half's marks are.
    scale = 1 << 20
    shares = [_each(kept.where(F.col("kind").isin(2 * h, 2 * h + 1)), lambda s, m=by_half[1 - h]: np.append(s[tells[s]], int(m[s].mean() * scale) if len(s) else 0)) for h in range(2)]
    release(kept)
    keys, toxic, got = sum((x[0] for x in shares), []), np.concatenate([x[1] for x in shares]), sum((x[2] for x in shares), [])
    slots = [x[:-1].astype(np.int32) for x in got]
    grades = grades_of(np.array([x[-1] / scale for x in got]), toxic)
    out = np.array([zlib.crc32(str(k).encode()) % 5 == 0 for k in keys])
    if not 0 < toxic[out].sum() < out.sum() or not 0 < toxic[~out].sum() < (~out).sum():
        out = np.zeros(len(out), bool)
    model = fit([s for s, x in zip(slots, out.tolist(), strict=True) if not x], grades[~out], marks)
    check = out if out.any() else ~out
    raw = np.array([model.weights[s].sum() for s in slots])
    model.cut = best_cut(model.severity(raw[check]), toxic[check])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str, str] = ("severity", "grade", "toxic")) -> DataFrame:
    """docs with severity (0 to 2), grade (the likeliest) and toxic (severity above the model's cut), under `names`."""
    bounded(docs.sparkSession)
    at = np.flatnonzero(model.weights)
    sent = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), model.weights[at], model.thresholds, model.cut))  # DIM weights at most
    rest = [c for c in docs.columns if c not in names]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(n, k) for n, k in zip(names, (T.DoubleType(), T.IntegerType(), T.BooleanType()), strict=True)])

    def run(batches):
        where, weights, thresholds, cut = sent.value
        full = np.zeros(DIM)
        full[where] = weights
        own = Model(full, thresholds, cut)
        for b in pieces(batches):
            raw = np.array([own.raw(tokens(t)) for t in b.column(b.schema.get_field_index(text)).to_pylist()])
            p, s = own.above(raw), own.severity(raw)
            mass = -np.diff(np.concatenate((np.ones((len(p), 1)), p, np.zeros((len(p), 1))), axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in rest], pa.array(s), pa.array(mass.argmax(axis=1).astype(np.int32)), pa.array(s > cut)], [*rest, *names])

    return docs.mapInArrow(run, schema)


def grade(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, severity, grade, toxic of every document."""
    return score(docs.select("doc_id", "text"), learn(docs, labels)).drop("text")


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the toxic ones."""
    got = score(docs, learn(docs, labels), names=("__severity", "__grade", "__toxic"))  # a column of docs may have the usual names
    return got.where("NOT __toxic").select(*docs.columns)
