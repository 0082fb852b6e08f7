"""Language identification by language-bitmask n-gram filters.

One bit-sliced Bloom filter serves all languages: slot i of the table is a mask with PLANES bits for each language, and an
n-gram sets its languages' bits in K slots. The AND of an n-gram's K slots gives all languages that contain it (the first
plane) and, as a weight, those where it is at least SHARE as frequent as where it is most frequent (the second), for every
n-gram of a batch at once. Each bit's hits over a text are its popcount; the hits that false positives are expected to
have, known from how full the bit's slice is, are taken off. The highest sum of a language's corrected counts, by the
planes' WEIGHTS, decides; the score is its share among all languages' sums.

Learning takes about SAMPLE documents of each language by a hash of doc_id, a documented bound, and every n-gram of them,
whole. n-grams are counted and turned into masks on the executors; the driver gets the filter's slots, whose number follows
the largest language's n-grams from LEAST_SLOTS to MOST_SLOTS: a larger one gets fuller, and more is taken off.

Text that is null or has no letter is `und` with score 0. Of equal counts the language that is first by code point wins.
An empty table learns nothing; then every text is `und`. Extra columns aren't read. Repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import bounded, materialize, pieces
from quillspark.storage import release

K, SIZES, PLANES, LEAST_SLOTS, MOST_SLOTS = 3, (3, 4), 2, 1 << 16, 1 << 22
#: What a hit of each plane counts.
WEIGHTS = (0.125, 1.0)
SAMPLE, SHARE = 3000, 0.25
_PRIMES = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63], np.uint64)
#: Characters that are looked at together, in prediction and in learning.
CHUNK, PIECE = 1 << 18, 1 << 20


def held_out(key):
    """crc32 of the key as text mod 5 is 0."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def letters(low: str) -> np.ndarray:
    """Code points of the letters, all else 0."""
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), "<u4")
    known = np.unique(points)
    letter = known[np.array([chr(c).isalpha() for c in known.tolist()], bool)] if len(known) else known
    table = np.zeros(int(known[-1]) + 1, bool)
    table[letter] = True
    return np.where(table[points], points, 0).astype(np.uint64)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters, all else 0, with a 0 before and after each text; where each text starts."""
    low = [t.lower() for t in texts]
    lengths = np.fromiter(map(len, low), np.int64, len(low))
    starts = np.concatenate(([1], 1 + np.cumsum(lengths + 1)))[:-1]
    return letters("\n".join(["", *low, ""])), starts


def gram_hashes(points: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram at each position; whether it is one: its inner characters are letters, its ends may not be."""
    m = len(points) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h, whole = np.full(m, n, np.uint64), np.ones(m, bool)
    for i in range(n):
        part = points[i : i + m]
        h = (h ^ part) * _PRIMES[i % 4]
        h ^= h >> np.uint64(29)
        if 0 < i < n - 1:
            whole &= part != 0
    return h * _PRIMES[0], whole


def slots(h: np.ndarray, i: int, n: int) -> np.ndarray:
    """The i-th slot of each hash: double hashing with odd steps."""
    return ((h >> np.uint64(32)) + np.uint64(i) * ((h & np.uint64(0xFFFFFFFF)) | np.uint64(1))) % np.uint64(n)


@dataclass
class Filter:
    languages: list[str]
    table: np.ndarray  # a row of 64-bit words (of 8-bit ones for few languages) for each slot, PLANES bits a language
    wrong: np.ndarray  # a false positive's probability, by bit

    def popcounts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text; hits by text and bit."""
        points, starts = code_points(texts)
        bits = PLANES * len(self.languages)
        n, hits = np.zeros(len(texts), np.int64), np.zeros((len(texts), bits), np.int64)
        width, one = 8 * self.table.dtype.itemsize, self.table.dtype.type(1)
        for size in SIZES:
            h, ok = gram_hashes(points, size)
            for at in range(0, len(h), CHUNK):
                part, keep = h[at : at + CHUNK], np.flatnonzero(ok[at : at + CHUNK])
                if not len(keep):
                    continue
                found = self.table[slots(part[keep], 0, len(self.table))]
                for i in range(1, K):
                    found &= self.table[slots(part[keep], i, len(self.table))]
                bounds = np.searchsorted(keep + at, np.append(starts[1:] - 1, len(points)))
                n += np.diff(np.concatenate(([0], bounds)))
                for j in range(bits):
                    run = np.concatenate(([0], np.cumsum((found[:, j // width] >> self.table.dtype.type(j % width)) & one, dtype=np.int64)))
                    hits[:, j] += np.diff(np.concatenate(([0], run[bounds])))
        return n, hits

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text; counts by text, language and plane, without the expected false positives."""
        n, hits = self.popcounts(texts)
        right = np.clip((hits - n[:, None] * self.wrong) / (1 - self.wrong), 0, None)
        return n, right.reshape(len(texts), len(self.languages), PLANES)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, score, and the share of the text's n-grams that the language contains."""
        lang, score, known = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if not at or not self.languages:
            return lang, score, known
        n, right = self.counts([texts[i] for i in at])
        sums = right @ np.array(WEIGHTS)
        for i, j, row, m in zip(at, sums.argmax(axis=1).tolist(), range(len(at)), n.tolist(), strict=True):
            total = float(sums[row].sum())
            lang[i], score[i], known[i] = self.languages[j], float(sums[row, j]) / total if total else 0.0, min(1.0, float(right[row, j, 0]) / m) if m else 0.0
        return lang, score, known


def shape(languages: int, n_slots: int) -> tuple[tuple[int, int], np.dtype]:
    bits = PLANES * languages
    return (n_slots, 1 if bits <= 8 else (bits + 63) // 64), np.dtype(np.uint8 if bits <= 8 else np.uint64)


def filled(languages: list[str], table: np.ndarray) -> Filter:
    """A filter, with its bits' rates of false positives from how full they are."""
    width, one = 8 * table.dtype.itemsize, table.dtype.type(1)
    full = [float(((table[:, j // width] >> table.dtype.type(j % width)) & one).mean()) for j in range(PLANES * len(languages))]
    return Filter(languages, table, np.array([min(0.999, x**K) for x in full]))


def size_for(grams: int) -> int:
    """Slots for a language of so many n-grams: under a tenth of them set, up to MOST_SLOTS."""
    return min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (10 * K * max(1, grams) - 1).bit_length()))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Filter:
    """A filter from rows with a lang; about `sample` rows of each language, by the hash of their key.

    Whole texts are read, PIECE characters at a time.
    """
    bounded(docs.sparkSession)
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = rows.groupBy(F.col(lang).alias("l")).count().collect()
    if not sizes:
        return filled([], np.zeros((1, 1), np.uint8))
    rate = F.create_map(*[x for r in sizes for x in (F.lit(r["l"]), F.lit(min(1.0, sample / r["count"])))])
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(11), F.col(key)), 11) / float(1 << 53)
    taken = rows.where(unit < F.element_at(rate, F.col(lang))).select(F.col(lang).alias("l"), F.col(text).alias("t"))

    def count(batches):
        for b in pieces(batches):
            names = np.array(b.column(0).to_pylist(), object)
            texts = np.array(b.column(1).to_pylist(), object)
            for name in sorted(set(names.tolist())):
                low = "\n".join(["", *[t.lower() for t in texts[names == name]], ""])
                for at in range(0, len(low), PIECE):
                    points = letters(low[at : at + PIECE + max(SIZES) - 1])
                    for size in SIZES:
                        h, ok = gram_hashes(points[: PIECE + size - 1], size)  # those that start in the piece
                        g, c = np.unique(h[ok], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(c.astype(np.int64))], ["l", "g", "c"])

    counts = materialize(taken.mapInArrow(count, "l string, g long, c long").groupBy("l", "g").agg(F.sum("c").alias("c")))
    totals = sorted((r["l"], r["n"], r["c"]) for r in counts.groupBy("l").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect())
    languages = [x[0] for x in totals]
    (n_slots, words), kind = shape(len(languages), size_for(max([x[1] for x in totals], default=1)))
    table = np.zeros((n_slots, words), kind)
    if not languages:
        release(counts)
        return filled([], table)
    place = F.create_map(*[x for i, (name, _, c) in enumerate(totals) for x in (F.lit(name), F.struct(F.lit(i).alias("i"), F.lit(float(c)).alias("all")))])
    of = counts.withColumn("p", F.element_at(place, F.col("l"))).select("g", F.col("p.i").alias("i"), (F.col("c") / F.col("p.all")).alias("f"))
    known = of.groupBy("g").agg(F.collect_list(F.struct("i", "f")).alias("of"), F.max("f").alias("most"))  # as many as there are languages
    first = F.transform("of", lambda x: x["i"] * PLANES)
    second = F.transform(F.filter("of", lambda x: x["f"] >= F.col("most") * SHARE), lambda x: x["i"] * PLANES + 1)
    bits = known.select("g", F.explode(F.concat(first, second)).alias("bit"))
    at = [(F.shiftrightunsigned("g", 32) + F.lit(i) * F.col("g").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1))).bitwiseAND(F.lit(n_slots - 1)) for i in range(K)]
    set_ = bits.select(F.explode(F.array(*at)).alias("slot"), F.floor(F.col("bit") / 64).cast("int").alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int")).alias("mask"))
    got = set_.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()
    table[got.column("slot").to_numpy(), got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64).astype(kind)
    release(counts)
    return filled(languages, table)


def predict(docs: DataFrame, f: Filter, text: str = "text", names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """docs with the language and its score, and the share of n-grams it contains if three `names` are given.

    The filter has a bounded size (MOST_SLOTS masks), which is what is broadcast.
    """
    bounded(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((f.languages, f.table.shape, f.table.dtype.str, f.table.tobytes(), f.wrong.tolist()))
    rest = [c for c in docs.columns if c not in names]
    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(n, k) for n, k in zip(names, kinds)])

    def run(batches):
        known, of, kind, raw, wrong = sent.value
        own = Filter(known, np.frombuffer(raw, kind).reshape(of), np.array(wrong))
        for b in pieces(batches):
            texts, made, at = b.column(b.schema.get_field_index(text)).to_pylist(), ([], [], []), 0
            while at < len(texts):
                end, chars = at, 0
                while end < len(texts) and (end == at or chars < CHUNK):
                    chars += len(texts[end] or "")
                    end += 1
                for to, got in zip(made, own.predict(texts[at:end]), strict=True):
                    to += got
                at = end
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in rest], *[pa.array(x, t) for x, t, _ in zip(made, (pa.string(), pa.float64(), pa.float64()), names)]], [*rest, *names])

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every text; learnt from those that aren't held out."""
    f = learn(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), f).drop("text")


def keep(docs: DataFrame, least: float = 1.2, known: float = 0.5) -> DataFrame:
    """docs without those that have no language: `und`, a best share under `least` times chance, one over the languages, or
    a best language that contains under `known` of the text's n-grams.

    Of the share at most half is asked for, which the better of two always has.
    """
    columns = docs.columns
    f = learn(docs.select("doc_id", "text", "lang"))
    share = min(0.5, least / max(1, len(f.languages)))
    got = predict(docs, f, names=("__lang", "__share", "__known"))  # a column of docs may have the usual names
    return got.where((F.col("__lang") != "und") & (F.col("__share") >= share) & (F.col("__known") >= known)).select(*columns)
