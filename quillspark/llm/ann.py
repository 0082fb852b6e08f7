"""Approximate nearest neighbours by a forest of hash prefixes.

Each of TREES trees gives every vector a string of DEPTH bits, the sides of random hyperplanes; a tree is the sorted
array of its strings. A query descends in each tree to its longest prefix match and takes the vectors round it: the bound
that their 20th best inner product gives is a floor. Then all trees ascend together, one bit at a time, the first of them
ahead by a bit, until a vector of that inner product or more, whose angle to the query is known, would share the prefix
in some tree with probability TARGET. What lies under these prefixes is searched, and the best are returned. Clustered
vectors end deep in the trees; where all directions are alike (as in the test tables) the rule climbs nearly to the roots.

The trees hold each vector as one byte a component and a scale, which gives an inner product between two bounds; whatever
its upper bound lets into the best is then scored from the original vectors, in double precision from the first
component to the last. Vectors are scaled by their own largest component first: norms of any size go.

A tree is cut into cells by its first bits and, where a cell is larger than CELL vectors, into chunks; a query visits the
cells under its prefix, and only those. The queries of a cell are dealt into lots of MOST_QUERIES, each with a copy of the
cell. Equal vectors are one class with its smallest ids, as many as can be asked for: no group of copies grows a cell.

Vectors that are null, zero, empty or hold null or non-finite components take no part, nor do rows without vec_id; vectors
of unlike length count as filled with zeros. Repeated rows count once. Of several vectors under one vec_id each is a
candidate, the id appears once with its best score, and the smallest vector is the query. A score of array<double> that
overflows is infinite; one that isn't a number ranks last. Extra columns aren't read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import materialize, pieces
from quillspark.llm.vectors import CELLS, matrix, unpack, valid
from quillspark.storage import release

TREES, DEPTH, CELL, MOST_BITS, TARGET, ROUND, SEED = 8, 32, 1 << 17, 10, 0.95, 96, 20
#: Queries that share a copy of a cell; vectors that a task packs together; sides of a block of inner products.
MOST_QUERIES, PACK, ROWS, LOT = 1 << 14, 1 << 15, 128, 1 << 14
#: Scales from here on are kept by 4 bytes each; the bounds allow for it.
TINY = 1e-30


def planes(d: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((TREES, d, DEPTH)).astype(np.float32)


def strings(u: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The bits of each vector in one tree, first bit highest. u: vectors with a largest component of 1."""
    return ((u @ p > 0) @ (1 << np.arange(DEPTH - 1, -1, -1, dtype=np.int64)).astype(np.float64)).astype(np.int64)


def scaled(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector over its largest component, and that component."""
    most = np.abs(v).max(axis=1)
    return v / most[:, None], most


@lru_cache(maxsize=4096)
def _ascent(p: float, target: float) -> list[int]:
    depth = [DEPTH] * TREES
    for x in range(DEPTH - 1, -1, -1):
        for t in range(TREES):
            if 1 - math.prod(1 - p**k for k in depth) >= target:
                return depth
            depth[t] = x
            if not x:  # one tree's root is all there is
                return [0] + [DEPTH] * (TREES - 1)
    return depth


def ascent(floor: float, norms: float, target: float = TARGET) -> list[int]:
    """Prefix length in each tree at which an inner product of `floor` or more is found with probability `target`.

    norms: the query's norm times the largest norm of all vectors, so that floor / norms is a cosine at least as small.
    """
    p = 1 - math.acos(max(-1.0, min(1.0, floor / norms))) / math.pi if norms > 0 and math.isfinite(floor) else 0.0
    return _ascent(math.floor(p * 1000) / 1000, target)


def _part(tree: int, cell, chunk):
    return (tree << 40) | (cell << 20) | chunk


def _cells(vectors: DataFrame, d: int, bits: int) -> np.ndarray:
    """Number of vectors by tree and cell: TREES * 2 ** MOST_BITS numbers at most come to the driver, whatever the input."""
    out = np.zeros((TREES, 1 << bits), np.int64)
    if not bits:
        return out

    def run(batches):
        p = planes(d)
        for b in pieces(batches, max(1, CELLS // d)):
            u = scaled(matrix(b.column(0), d))[0].astype(np.float32)
            for t in range(TREES):
                cell, n = np.unique(strings(u, p[t]) >> (DEPTH - bits), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), t, np.int32)), pa.array(cell), pa.array(n.astype(np.int64))], ["tree", "cell", "n"])

    for r in vectors.select("v").mapInArrow(run, "tree int, cell long, n long").groupBy("tree", "cell").agg(F.sum("n").alias("n")).collect():
        out[r["tree"], r["cell"]] = r["n"]
    return out


def _forest(classes: DataFrame, d: int, bits: int, chunks: np.ndarray, most: float) -> DataFrame:
    """part, codes, reps, scales, z (packed): runs of the sorted arrays, up to PACK vectors of a task for each tree."""
    names = ["part", "codes", "reps", "scales", "z"]

    def run(batches):
        p, held, n = planes(d), [], 0

        def flush():
            reps, scales, z, codes = (np.concatenate(x, axis=-1 if i == 3 else 0) for i, x in enumerate(zip(*held, strict=True)))
            for t in range(TREES):
                cell = codes[t] >> (DEPTH - bits)
                part = _part(t, cell, reps % chunks[t, cell])
                order = np.lexsort((codes[t], part))
                cuts = np.flatnonzero(np.concatenate(([True], np.diff(part[order]) != 0, [True]))).tolist()
                rows = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                made = ([x[i].tobytes() for i in rows] for x in (codes[t].astype("<u4"), reps.astype("<i8"), scales if scales.min() < TINY else scales.astype("<f4"), z))
                yield pa.RecordBatch.from_arrays([pa.array([int(part[i[0]]) for i in rows], pa.int64()), *[pa.array(x, pa.binary()) for x in made]], names)

        for b in pieces(batches, max(1, CELLS // d)):
            u, own = scaled(matrix(b.column(1), d))
            z, f = np.rint(u * 127).astype(np.int8), u.astype(np.float32)
            held.append((b.column(0).to_numpy(zero_copy_only=False), own / most / 127, z, np.stack([strings(f, p[t]) for t in range(TREES)])))
            n += len(z)
            if n >= PACK:
                yield from flush()
                held, n = [], 0
        if held:
            yield from flush()

    return classes.select("rep", "v").mapInArrow(run, "part long, codes binary, reps binary, scales binary, z binary")


def _under(t: int, code: int, x: int, bits: int, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells and parts under a prefix of x bits; without a depth (-1) those of the own cell."""
    open_ = max(0, bits - x) if x >= 0 else 0
    cell = np.arange(1 << open_) + (code >> (DEPTH - bits) >> open_ << open_)
    n = chunks[t, cell]
    every = np.repeat(cell, n)
    return every, _part(t, every, np.arange(len(every)) - np.repeat(np.cumsum(n) - n, n))


def _seen(queries: DataFrame, d: int, norm: float, emit, schema: str) -> DataFrame:
    """What emit(reps, u, codes, depths, floors) makes of the queries: rep, v, floor (null: descend)."""

    def run(batches):
        p = planes(d)
        for b in pieces(batches):
            u = scaled(matrix(b.column(1), d))[0].astype(np.float32)
            size = np.linalg.norm(u.astype(np.float64), axis=1) * norm
            floors = b.column(2).to_pylist()
            depth = np.array([[-1] * TREES if f is None else ascent(f, n) for f, n in zip(floors, size.tolist(), strict=True)])
            yield from emit(b.column(0).to_numpy(zero_copy_only=False), u, [strings(u, p[t]) for t in range(TREES)], depth, floors)

    return queries.select("rep", "v", "floor").mapInArrow(run, schema)


def _lots(queries: DataFrame, d: int, bits: int, norm: float) -> np.ndarray:
    """By tree and cell, the number of lots that its queries are dealt into."""

    def emit(reps, u, codes, depth, floors):
        for t in range(TREES):
            open_ = np.where(depth[:, t] >= 0, np.maximum(0, bits - depth[:, t]), 0)
            first, n = np.unique(np.stack((codes[t] >> (DEPTH - bits) >> open_ << open_, open_)), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), t, np.int32)), pa.array(first[0]), pa.array(first[1]), pa.array(n.astype(np.int64))], ["tree", "first", "open", "n"])

    seen = np.zeros((TREES, 1 << bits), np.int64)
    for r in _seen(queries, d, norm, emit, "tree int, first long, open long, n long").groupBy("tree", "first", "open").agg(F.sum("n").alias("n")).collect():
        seen[r["tree"], r["first"] : r["first"] + (1 << r["open"])] += r["n"]
    return np.maximum(1, -(-seen // MOST_QUERIES))


def _visits(queries: DataFrame, d: int, bits: int, chunks: np.ndarray, lots: np.ndarray, norm: float) -> DataFrame:
    """part, lot, q, code, depth, floor, u: a row for each chunk that a query visits."""
    names = ["part", "lot", "q", "code", "depth", "floor", "u"]

    def emit(reps, u, codes, depth, floors):
        packed = [x.tobytes() for x in u]
        for t in range(TREES):
            rows = []
            for i, (c, x) in enumerate(zip(codes[t].tolist(), depth[:, t].tolist(), strict=True)):
                cell, part = _under(t, c, x, bits, chunks)
                rows += [(a, b, i) for a, b in zip(part.tolist(), (int(reps[i]) % lots[t, cell]).tolist(), strict=True)]
            for at in range(0, len(rows), 4096):
                part, lot, i = zip(*rows[at : at + 4096], strict=True)
                of = list(i)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(lot, pa.int64()), pa.array(reps[of]), pa.array(codes[t][of]), pa.array(depth[of, t].astype(np.int32)), pa.array([floors[j] for j in of], pa.float64()), pa.array([packed[j] for j in of], pa.binary())], names)

    return _seen(queries, d, norm, emit, "part long, lot long, q long, code long, depth int, floor double, u binary")


def within(u: np.ndarray, z: np.ndarray, scales: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector, lower and upper bound of the inner products that may be among a query's k best and reach `least`."""
    n, d = z.shape
    size = np.linalg.norm(u.astype(np.float64), axis=1)
    err = 0.5 * np.abs(u.astype(np.float64)).sum(axis=1) + (d + 20) * 1.2e-7 * size * 127 * math.sqrt(d)
    raw = (u @ z.astype(np.float32).T).astype(np.float64)
    low, high = (raw - err[:, None]) * scales, (raw + err[:, None]) * scales
    least = np.maximum(least, np.partition(low, n - k, axis=1)[:, n - k]) if n >= k else least
    row, col = np.nonzero(high >= least[:, None])
    return row, col, low[row, col], high[row, col]


def _best(q: np.ndarray, rep: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Without what k others of the same query are surely better than. Each (q, rep) comes once."""
    order = np.lexsort((-low, q))
    q, rep, low, high = q[order], rep[order], low[order], high[order]
    first, last = np.searchsorted(q, q), np.searchsorted(q, q, "right")
    ok = (last - first < k) | (high >= low[np.minimum(first + k - 1, len(q) - 1)])
    return q[ok], rep[ok], low[ok], high[ok]


def _searched(visits: DataFrame, index: DataFrame, d: int, k: int) -> DataFrame:
    """q, rep, low, high: what may be among a query's k best."""
    names = ["q", "rep", "low", "high"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=names)
        if not left.num_rows or not right.num_rows:
            return none
        code, reps = (np.frombuffer(b"".join(right.column(c).to_pylist()), t) for c, t in (("codes", "<u4"), ("reps", "<i8")))
        scales = np.concatenate([np.frombuffer(x, "<f4" if len(x) == len(c) else "<f8").astype(np.float64) for x, c in zip(right.column("scales").to_pylist(), right.column("codes").to_pylist(), strict=True)])
        z, code = unpack(right.column("z"), d, np.int8), code.astype(np.int64)
        order = np.lexsort((reps, code))
        code, reps, scales, z = code[order], reps[order], scales[order], z[order]  # the tree's sorted array
        qcode, depth, qs, u = left.column("code").to_numpy(), left.column("depth").to_numpy().astype(np.int64), left.column("q").to_numpy(), unpack(left.column("u"), d, np.float32)
        least = np.nan_to_num(left.column("floor").to_numpy().astype(np.float64), nan=-np.inf, neginf=-np.inf)
        lost = np.where(depth >= 0, DEPTH - np.maximum(depth, 0), 0)
        first = np.searchsorted(code, qcode >> lost << lost)
        last = np.searchsorted(code, ((qcode >> lost) + 1) << lost)
        at = np.searchsorted(code, qcode)  # descent: the longest matches lie round this place
        round_ = depth < 0
        first[round_], last[round_] = np.maximum(0, at - ROUND // 2)[round_], np.minimum(len(code), at + ROUND // 2)[round_]
        out, by = [], np.lexsort((last, first))
        cuts = np.flatnonzero(np.concatenate(([True], (np.diff(first[by]) != 0) | (np.diff(last[by]) != 0), [True])))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            lo, hi = int(first[by[a]]), int(last[by[a]])
            for i in range(a, b if hi > lo else a, ROWS):
                pick, got = by[i : min(i + ROWS, b)], []
                for s in range(lo, hi, LOT):
                    row, col, low, high = within(u[pick], z[s : min(s + LOT, hi)], scales[s : min(s + LOT, hi)], least[pick], k)
                    got.append((qs[pick][row], reps[s + col], low, high))
                out.append(_best(*map(np.concatenate, zip(*got, strict=True)), k))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=names) if out else none

    keys = ["part", "lot"]
    return visits.groupBy(*keys).cogroup(index.groupBy(*keys)).applyInArrow(run, "q long, rep long, low double, high double")


def inner(a: str, b: str) -> Column:
    """Inner product in double precision, summed from the first component to the last."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)


def search(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose key is divisible by `every`."""
    spark = vectors.sparkSession
    rows = valid(vectors, key, vec, zero=False).withColumn("c1", F.xxhash64("v")).withColumn("c2", F.xxhash64(F.lit(1), F.col("v")))
    classes = materialize(rows.groupBy("c1", "c2").agg(F.first("v").alias("v")).select(F.monotonically_increasing_id().alias("rep"), "c1", "c2", "v"))
    own = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    log_norm = F.log("m") + F.log(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x.cast("double") / F.col("m")) * (x.cast("double") / F.col("m")))) / 2
    total, d, most, longest = classes.withColumn("m", own).agg(F.count(F.lit(1)), F.max(F.size("v")), F.max("m"), F.max(log_norm)).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    norm = math.exp(longest - math.log(most)) * (1 + 1e-9)
    few = rows.select("c1", "c2", "vec_id").distinct().withColumn("n", F.row_number().over(W.partitionBy("c1", "c2").orderBy("vec_id"))).where(F.col("n") <= k + 1)
    members = few.groupBy("c1", "c2").agg(F.collect_list("vec_id").alias("ids"))
    least = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    asked = least.select("query_id", F.xxhash64("v").alias("c1"), F.xxhash64(F.lit(1), F.col("v")).alias("c2"))
    asked = materialize(asked.join(classes.select("rep", "c1", "c2"), ["c1", "c2"]).select("query_id", F.col("rep").alias("q")))
    queries = materialize(classes.join(asked.select(F.col("q").alias("rep")).distinct(), "rep", "left_semi").select("rep", "v"))

    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, total) / CELL))))
    chunks = np.maximum(1, -(-_cells(classes, d, bits) // CELL))
    index = materialize(_forest(classes, d, bits, chunks, most))

    def round_(asking: DataFrame) -> DataFrame:
        lots = _lots(asking, d, bits, norm)
        many = [(int(t) << 20 | int(c), int(lots[t, c])) for t, c in zip(*np.nonzero(lots > 1), strict=True)]
        dealt = index.withColumn("lots", F.lit(1))
        if many:  # TREES * 2 ** MOST_BITS rows at most
            hot = F.broadcast(spark.createDataFrame(many, "cell long, lots int"))
            dealt = index.join(hot, F.shiftright("part", 20) == F.col("cell"), "left").withColumn("lots", F.coalesce("lots", F.lit(1)))
        dealt = dealt.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("lots") - 1).cast("long")))).select("part", "lot", "codes", "reps", "scales", "z")
        return _searched(_visits(asking, d, bits, chunks, lots, norm), dealt, d, k + 1)

    def merged(found: DataFrame) -> DataFrame:
        """Each (q, rep) once, as a table."""
        return materialize(found.groupBy("q", "rep").agg(F.max("low").alias("low"), F.min("high").alias("high")))

    def floors(once: DataFrame) -> DataFrame:
        """Each q's floor: the k + 1st lower bound, where there are so many."""
        top = once.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("low"), "rep"))).where(F.col("n") <= k + 1)
        floor = top.groupBy("q").agg(F.min("low").alias("floor"), F.count(F.lit(1)).alias("m"))
        return floor.select("q", F.when(F.col("m") > k, F.col("floor")).otherwise(float("-inf")).alias("floor"))

    first = merged(round_(queries.withColumn("floor", F.lit(None).cast("double"))))
    second = materialize(queries.join(floors(first), queries.rep == F.col("q"), "left").select("rep", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")))
    once = merged(first.unionByName(round_(second)))
    release(index)
    release(first)
    pairs = once.join(floors(once), "q").where("high >= floor").select("q", "rep")
    scored = pairs.join(queries.select(F.col("rep").alias("q"), F.col("v").alias("qv")), "q").join(classes, "rep").select("q", "c1", "c2", inner("qv", "v").alias("score"))
    spread = scored.join(members, ["c1", "c2"]).select("q", "score", F.explode("ids").alias("vec_id")).groupBy("q", "vec_id").agg(F.coalesce(F.max(F.when(~F.isnan("score"), F.col("score"))), F.lit(float("nan"))).alias("score"))
    order = [F.isnan("score"), F.desc("score"), F.col("vec_id")]
    spread = spread.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(*order))).where(F.col("n") <= k + 1)
    answers = spread.join(asked, "q").where("vec_id <> query_id")
    return answers.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
