"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has four segments of 16 bits on a ring. If two fingerprints differ in 3 bits at most, then some segment
starts a chain of which every prefix of l segments differs in at most 3 * l / 4 bits: 0 in the first, 1 in two, 2 in
three, 3 in all (pigeonring principle). Candidates meet under a key of the chain's first segment, which is equal, and
of one half of the second, since of its two halves one is equal if it differs in 1 bit at most: 24 bits in 8 ways, each
way on a table of its own. Inside a key the chain's budgets are tested, and then the full distance. Of the links that
are found there, a spanning forest is kept: it connects the same fingerprints, and large groups give no list of pairs.
A key of more than HOT distinct fingerprints is split: of four parts of the bits that its key leaves open one is equal, so
that they meet under a key and a part, and so on for DEEPEST rounds. A worker holds the distinct fingerprints of one key.

Rows with equal fingerprints form one class. Null and empty texts have fingerprint zero and are linked like any other.
A null doc_id counts as larger than all others; a component of such rows only has a null component_id. Repeated rows
give repeated results. Extra columns aren't read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import map_arrow, materialize
from quillspark.llm.url_filter import BITS_PER_URL, BROADCAST_BLOCKS, bits_of, block_of, bloom
from quillspark.operators.components import components

SHINGLE, SEED, BITS, RADIUS = 3, 42, 64, 3
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLOCK, _FEW = 1 << 16, 8
#: Fingerprints of a key from which on it is split, and how often.
HOT, DEEPEST = 1 << 14, 2


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    from xxhash import xxh64_intdigest

    words = _WORD.findall((text or "").encode().lower())  # of bytes, lower() changes A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    view = memoryview(joined)
    return np.fromiter((xxh64_intdigest(view[a:b], SEED) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)), np.uint64, len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is 1 if it is set in over half the hashes."""
    if not len(hashes):
        return 0
    set_, step = np.zeros(BITS, np.int64), _BLOCK
    for i in range(0, len(hashes), step):
        part = np.ascontiguousarray(hashes[i : i + step].astype("<u8"))
        set_ += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * set_ > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp (signed 64-bit) of each whole text."""
    kind = docs.schema[key].dataType

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(shingle_hashes(t)) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["k", "fp"])

    return map_arrow(docs.select(F.col(key).alias("k"), F.col(text).alias("t")), one, f"k {kind.simpleString()}, fp long")


def _segment(fp: np.ndarray, i: int) -> np.ndarray:
    return (fp >> np.uint64(16 * (i % 4))) & np.uint64(0xFFFF)


def near(a: np.ndarray, b: np.ndarray, start: int) -> np.ndarray:
    """Whether the chain that starts at a segment keeps its budgets, the last of which is the full distance."""
    x = np.bitwise_xor(a, b)
    sums, ok = np.zeros(x.shape, np.uint8), np.ones(x.shape, bool)
    for length in range(1, 5):
        sums = sums + np.bitwise_count(_segment(x, start + length - 1))
        ok &= sums <= RADIUS * length // 4
    return ok


class _Forest:
    """Links found in one key's fingerprints so far."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def add(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _run_links(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among fingerprints under one key: each step takes what one reaches, all at once."""
    left, out = np.unique(fps), []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            got = np.zeros(len(left), bool)
            by = np.zeros(len(left), np.uint64)
            for f in front:
                hit = ~got & near(left, f, start)
                by[hit], got = f, got | hit
            out += zip(by[got].tolist(), left[got].tolist(), strict=True)
            front, left = left[got], left[~got]
    return out


def bucket_links(keys: np.ndarray, fps: np.ndarray, start_of_key: np.ndarray) -> list[tuple[int, int]]:
    """Rows sorted by key. Short runs are tested together, long ones each for itself."""
    n = len(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    size = np.diff(np.append(first, n))
    out: list[tuple[int, int]] = []
    few = np.repeat(size <= _FEW, size)
    for step in range(1, min(_FEW, n)):
        at = np.flatnonzero((keys[step:] == keys[:-step]) & few[:-step])
        for s in range(4):
            pick = at[start_of_key[at] == s]
            a, b = fps[pick], fps[pick + step]
            ok = near(a, b, s) & (a != b)
            out += zip(a[ok].tolist(), b[ok].tolist(), strict=True)
    for i, m in zip(first[size > _FEW].tolist(), size[size > _FEW].tolist(), strict=True):
        out += _run_links(fps[i : i + m], int(start_of_key[i]))
    return out


def _ways() -> list[tuple[int, int]]:
    """Start and mask of each way: a segment, and one half of the next."""
    out = []
    for i in range(4):
        for half in range(2):
            out.append((i, 0xFFFF << 16 * i | 0xFF << (16 * ((i + 1) % 4) + 8 * half)))
    return out


def _parts(mask: int) -> list[int]:
    """mask with one of four parts of the bits that it leaves open."""
    open_ = [b for b in range(BITS) if not mask >> b & 1]
    cuts = [round(len(open_) * i / 4) for i in range(5)]
    return [mask | sum(1 << b for b in open_[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keyed(rows: DataFrame, ways: list[tuple[int, int]], of: dict[int, list[int]]) -> DataFrame:
    """fp, way, key: each fingerprint under its bits in the masks of the ways that `of` gives for its way. Keys are hashes:
    two that meet by chance are tested and not linked."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for _, m in ways])
    pick = F.create_map(*[x for w, to in of.items() for x in (F.lit(w), F.array(*map(F.lit, to)))])
    got = rows.select("fp", F.explode(F.element_at(pick, F.col("way"))).alias("way"))
    return got.select("fp", "way", F.xxhash64("way", F.col("fp").bitwiseAND(F.element_at(masks, F.col("way") + 1))).alias("key"))


def links(distinct: DataFrame) -> DataFrame:
    """a, b: pairs of distinct fingerprints (column fp) that connect just what all links within RADIUS bits connect."""
    ways = _ways()
    first = list(range(len(ways)))
    rows = _keyed(distinct.select("fp", F.lit(-1).alias("way")), ways, {-1: first})
    done = None
    for _ in range(DEEPEST):
        hot = rows.groupBy("way", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).drop("n")
        hot = materialize(hot)
        if not hot.limit(1).count():
            break
        cold = rows.join(hot, ["way", "key"], "left_anti").select("fp", "way", "key")
        done = cold if done is None else done.unionByName(cold)
        of, more = {}, []
        for w in first:
            of[w] = list(range(len(ways) + len(more), len(ways) + len(more) + 4))
            more += [(ways[w][0], m) for m in _parts(ways[w][1])]
        first, ways = list(range(len(ways), len(ways) + len(more))), ways + more
        rows = _keyed(rows.join(hot, ["way", "key"], "left_semi").select("fp", "way"), ways, of)
    rows = rows if done is None else done.unionByName(rows)
    starts = np.array([s for s, _ in ways], np.int64)
    dealt = rows.repartition("key").sortWithinPartitions("key", "way").select("fp", "way", "key")

    def run(batches):
        held, n, limit = [], 0, _BLOCK

        def emit(keys, ways_, fps):
            got = np.array(bucket_links(keys, fps, starts[ways_]), np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["a", "b"])

        for b in batches:
            fps, ways_, keys = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            held.append((keys, ways_, fps.view(np.uint64)))
            n += len(keys)
            if n < limit:
                continue
            keys, ways_, fps = map(np.concatenate, zip(*held, strict=True))
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key's rows may go on
            if cut:
                yield emit(keys[:cut], ways_[:cut], fps[:cut])
            held, n = [(keys[cut:], ways_[cut:], fps[cut:])], len(keys) - cut
            limit = max(_BLOCK, 2 * n)
        if n:
            yield emit(*map(np.concatenate, zip(*held, strict=True)))

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint (16 hex digits), component_id (the smallest key reachable over links)."""
    fps = materialize(fingerprints(docs, key, text))
    classes = fps.groupBy("fp").agg(F.min("k").alias("least"))
    roots = components(links(classes.select("fp")))
    named = materialize(classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", "root"))
    linked = named.where(F.col("root").isNotNull())
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    alone = named.where(F.col("root").isNull()).select("fp", F.col("least").alias("component_id"))  # null keys of a join would meet in one task
    known = linked.join(ids, "root").select("fp", "component_id").unionByName(alone)
    out = fps.join(known, "fp", "left")
    return out.select(F.col("k").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each component: the one with its smallest key, nulls last, of equal keys by a hash of the row.

    Components are of fingerprints, so that unlike texts under one key, or under none, are told apart. Which rows stay is
    decided on numbers; whole texts are written once. A Bloom filter of the rows that go is sent to them, up to
    BROADCAST_BLOCKS blocks of it, and only those that it lets through are shuffled to be looked up; without it all are.
    Columns that begin with two underscores are used inside.
    """
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(shingle_hashes(t)) for t in b.column(b.schema.get_field_index(text)).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(fp)], [*columns, "__fp"])

    rows = materialize(map_arrow(docs, one, schema).withColumn("__row", F.monotonically_increasing_id()))
    order = F.struct(F.col(key).isNull(), F.col(key), F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns), "__row")
    classes = materialize(rows.groupBy(F.col("__fp").alias("fp")).agg(F.min(order).alias("lead")))
    roots = components(links(classes.select("fp")))
    leads = classes.join(roots, classes.fp == roots.node, "left").groupBy(F.coalesce("root", "fp")).agg(F.min("lead").alias("lead"))
    leads = materialize(leads.select(F.col("lead.__row").alias("__row")))
    gone = materialize(rows.select("__row").join(leads, "__row", "left_anti"))
    n = gone.count()
    if not n:
        return rows.select(*columns)
    blocks = max(1, n * BITS_PER_URL // 64)
    if blocks > BROADCAST_BLOCKS:
        return rows.join(leads, "__row", "left_semi").select(*columns)
    masks = F.broadcast(bloom(gone, "__row", blocks).select(F.col("block").alias("__block"), F.col("mask").alias("__mask")))
    bits = bits_of(F.col("__row"))
    probed = rows.join(masks, block_of(F.col("__row"), blocks) == F.col("__block"), "left")
    maybe = F.coalesce(F.col("__mask").bitwiseAND(bits) == bits, F.lit(False))
    sure = probed.where(~maybe).select(*columns)
    return probed.where(maybe).join(gone, "__row", "left_anti").select(*columns).unionByName(sure)
