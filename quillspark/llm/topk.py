"""Exact top-k inner products by block-at-a-time pruning.

Vectors become whole numbers, floor(256 * x). They are laid in ranges by the signs of a few random sums, so that a range's
vectors point alike, and cut into blocks of BLOCK rows: the block's matrix is its forward index, and of every term
(component) it keeps the maximum and minimum. A query's bound for a block sums its terms' largest contributions. Each
query orders the blocks by bound: the best SEEDS of every FAN pages are scored through their forward indexes, which
gives a k-th score, and then just the blocks whose bound is not below it. What is left out can't reach the k-th score:
the result is exact, ties included. Blocks travel in pages of CELLS numbers, queries in packs of PACK, and a query goes
to a page once, with a mark for each of its blocks. Groups of packs (MOST_PACKS, MOST_QUERIES) get a copy of what they meet.

The floor of 256 times a double is a double, exactly, and inner products are exact, too: doubles where all sums stay under
2 ** 53, else a bound by doubles and then Python's integers for what may be among the best. A score among the best that
a long can't hold fails the query, as does a component that is over a double when multiplied by 256.

Vectors that are null or hold null or non-finite components take no part, nor do rows without vec_id. Zero and empty
vectors do; vectors of unlike length count as filled with zeros. Repeated rows count once; where one vec_id has several
vectors, each is a candidate, and the query is the smallest of them. Extra columns aren't read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import materialize, pieces
from quillspark.llm.vectors import CELLS as BATCH
from quillspark.llm.vectors import matrix, valid

BLOCK, CELLS, FAN, PACK, MOST_PACKS, MOST_QUERIES, SEEDS, SIGNS, SEED = 512, 1 << 19, 64, 128, 16, 1 << 14, 4, 16, 8
#: Whole numbers up to here are exact in doubles.
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)


def packed(m: np.ndarray) -> bytes:
    """Whole numbers in doubles, by 4 bytes each where they fit, else by 8."""
    return (m.astype("<i4") if not m.size or np.abs(m).max() < 1 << 31 else m.astype("<f8")).tobytes()


def unpacked(raw: bytes, rows: int, d: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4" if len(raw) == 4 * rows * d else "<f8").reshape(rows, d).astype(np.float64)


def whole(column: pa.Array, d: int) -> np.ndarray:
    """floor(256 * x) of each component."""
    out = np.floor(matrix(column, d) * 256.0)
    if not np.isfinite(out).all():
        raise ValueError("a component times 256 exceeds a double")
    return out


def pages(rows: DataFrame, d: int) -> DataFrame:
    """page, n, ids, m (packed rows), hi, lo (packed, a row for each block) of vec_id, v."""
    size = max(BLOCK, CELLS // d // BLOCK * BLOCK)
    names = ["page", "n", "ids", "m", "hi", "lo"]

    def signed(batches):
        p = np.random.default_rng(SEED).standard_normal((d, SIGNS))
        for b in pieces(batches, max(1, BATCH // d)):
            m = whole(b.column(1), d)
            sign = ((m / np.maximum(1.0, np.abs(m).max(axis=1, keepdims=True)) @ p > 0) @ (1 << np.arange(SIGNS - 1, -1, -1))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([packed(x) for x in m], pa.binary()), pa.array(sign)], ["vec_id", "v", "sign"])

    def cut(batches):
        from pyspark import TaskContext

        at, ids, rows_, n = TaskContext.get().partitionId() << 32, [], [], 0

        def emit():
            m = np.concatenate([unpacked(x, 1, d) for x in rows_])
            starts = np.arange(0, len(m), BLOCK)
            made = [np.array(ids, "<i8").tobytes(), packed(m), packed(np.maximum.reduceat(m, starts)), packed(np.minimum.reduceat(m, starts))]
            return pa.RecordBatch.from_arrays([pa.array([at + n]), pa.array([len(m)]), *[pa.array([x], pa.binary()) for x in made]], names)

        for b in batches:
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(i)
                rows_.append(x)
                if len(ids) == size:
                    yield emit()
                    ids, rows_, n = [], [], n + 1
        if ids:
            yield emit()

    dealt = rows.mapInArrow(signed, "vec_id long, v binary, sign long").repartitionByRange("sign", "vec_id").sortWithinPartitions("sign", "vec_id", "v")
    return dealt.select("vec_id", "v").mapInArrow(cut, "page long, n long, ids binary, m binary, hi binary, lo binary")


def packs(queries: DataFrame, d: int) -> DataFrame:
    """pack, n, qs, q, floor (packed) of query_id, v, floor. A pack is what PACK rows in a row of a task give."""
    names = ["pack", "n", "qs", "q", "floor"]

    def run(batches):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        for n, b in enumerate(pieces(batches, PACK)):
            ids, floor = b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([at + n]), pa.array([b.num_rows]), *[pa.array([x], pa.binary()) for x in (ids.astype("<i8").tobytes(), packed(whole(b.column(1), d)), floor.astype("<f8").tobytes())]], names)

    return queries.select("query_id", "v", "floor").mapInArrow(run, "pack long, n long, qs binary, q binary, floor binary")


def bounds(q: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """By query and block: no vector of the block scores more. Doubles may round, so a little is added where they do."""
    with np.errstate(over="ignore", invalid="ignore"):
        out, most = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T, np.abs(q) @ np.maximum(np.abs(hi), np.abs(lo)).T
        return np.nan_to_num(out + np.where(most < EXACT, 0.0, 1e-9 * most), nan=np.inf, posinf=np.inf)


def best(q: np.ndarray, own: np.ndarray, m: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, id and exact score of each query's k best, ties to smaller ids, its own id left out.

    A score under a long's range is given as the least long; one over it raises.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        s = q @ m.T
        exact = float(np.abs(q).max(initial=0)) * float(np.abs(m).max(initial=0)) * q.shape[1] < EXACT
        err = 0.0 if exact else (q.shape[1] + 8) * 2.3e-16 * (np.abs(q) @ np.abs(m).T)
        low, high = s - err, s + err
    lost = ~np.isfinite(s)
    low[lost], high[lost] = -np.inf, np.inf
    same = own[:, None] == ids[None, :]
    low[same], high[same] = -np.inf, -np.inf
    at = max(0, s.shape[1] - k)
    row, col = np.nonzero((high >= np.partition(low, at, axis=1)[:, at][:, None]) & ~same)
    if exact:
        score = s[row, col].astype(np.int64)
    else:
        found = [sum(int(x) * int(y) for x, y in zip(q[i].tolist(), m[j].tolist(), strict=True)) for i, j in zip(row.tolist(), col.tolist(), strict=True)]
        if found and max(found) > LONG.max:
            raise ValueError("a score exceeds a long")
        score = np.array([max(x, LONG.min) for x in found], np.int64)
    order = np.lexsort((ids[col], ~score, row))  # ~x falls as x rises, and holds for the least long, too
    row, col, score = row[order], col[order], score[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[kept], ids[col[kept]], score[kept]


def _salted(rows: DataFrame, salts: int) -> DataFrame:
    """A copy of each row for every salt."""
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))


def chosen(asking: DataFrame, cut: DataFrame, d: int, groups: int, salts: int, seeds: bool) -> DataFrame:
    """page, pack, n, qs, q, marks: the queries of a pack that a page is scored for, with a mark for each of its blocks.

    seeds: the best blocks of each group of pages; else all whose bound isn't below the query's floor.
    """
    names = ["page", "pack", "n", "qs", "q", "marks"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got, parts = [], sorted(right.to_pylist(), key=lambda r: r["page"])
        blocks = [-(-r["n"] // BLOCK) for r in parts]
        ends = np.cumsum(blocks).tolist()
        hi, lo = (np.concatenate([unpacked(r[c], b, d) for r, b in zip(parts, blocks, strict=True)]) if parts else None for c in ("hi", "lo"))
        for p in left.to_pylist() if parts else []:
            ids, q, floor = np.frombuffer(p["qs"], "<i8"), unpacked(p["q"], p["n"], d), np.frombuffer(p["floor"], "<f8")
            bound = bounds(q, hi, lo)
            if seeds:
                pick = np.zeros(bound.shape, bool)
                np.put_along_axis(pick, np.argsort(-bound, axis=1, kind="stable")[:, :SEEDS], True, axis=1)
            else:
                pick = bound >= floor[:, None]
            for r, b, end in zip(parts, blocks, ends, strict=True):
                own = pick[:, end - b : end]
                some = own.any(axis=1)
                if some.any():
                    got.append((r["page"], p["pack"], int(some.sum()), ids[some].tobytes(), packed(q[some]), own[some].tobytes()))
        columns = zip(*got, strict=True) if got else [[]] * 6
        return pa.table([pa.array(list(x), t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=names)

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    left = asking.withColumn("g", every).withColumn("salt", F.pmod(F.xxhash64("pack"), F.lit(salts)))
    right = _salted(cut.select("page", "n", "hi", "lo", F.pmod(F.xxhash64("page"), F.lit(groups)).alias("g")), salts)
    return left.groupBy("g", "salt").cogroup(right.groupBy("g", "salt")).applyInArrow(run, "page long, pack long, n long, qs binary, q binary, marks binary")


def scored(pairs: DataFrame, cut: DataFrame, d: int, k: int, salts: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each query in each block that it was sent to."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in right.to_pylist():
            ids, m = np.frombuffer(r["ids"], "<i8"), unpacked(r["m"], r["n"], d)
            blocks = -(-r["n"] // BLOCK)
            for p in left.to_pylist():
                qs, q, marks = np.frombuffer(p["qs"], "<i8"), unpacked(p["q"], p["n"], d), np.frombuffer(p["marks"], bool).reshape(p["n"], blocks)
                for b in np.flatnonzero(marks.any(axis=0)).tolist():
                    some, s = marks[:, b], slice(b * BLOCK, (b + 1) * BLOCK)
                    row, vec, score = best(q[some], qs[some], m[s], ids[s], k)
                    out.append((qs[some][row], vec, score))
        got = zip(*out, strict=True) if out else [[np.zeros(0, np.int64)]] * 3
        return pa.table([pa.array(np.concatenate(x)) for x in got], names=["query_id", "vec_id", "score"])

    left = pairs.withColumn("salt", F.pmod(F.xxhash64("pack"), F.lit(salts)))
    right = _salted(cut.select("page", "n", "ids", "m"), salts)
    return left.groupBy("page", "salt").cogroup(right.groupBy("page", "salt")).applyInArrow(run, "query_id long, vec_id long, score long")


def search(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each row whose key is divisible by `every`."""
    spark = vectors.sparkSession
    rows = valid(vectors, key, vec, zero=True).distinct()
    d = rows.agg(F.max(F.size("v"))).first()[0]
    if d is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    d = max(1, d)
    cut = materialize(pages(rows, d))
    n_pages = cut.count()
    low = F.lit(float("-inf"))
    asked = materialize(valid(vectors, key, vec, zero=True).where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v")))
    n = asked.count()
    groups = math.ceil(n_pages / FAN)
    lots, salts = max(1, math.ceil(n / PACK / MOST_PACKS)), max(1, math.ceil(n / MOST_QUERIES))

    def top(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    def round_(asking: DataFrame, seeds: bool) -> DataFrame:
        return top(scored(chosen(packs(asking, d), cut, d, groups, lots, seeds), cut, d, k, salts))

    floors = round_(asked.withColumn("floor", low), True).groupBy("query_id").agg(F.min("score").alias("f"), F.count(F.lit(1)).alias("c")).where(F.col("c") == k)
    again = materialize(asked.join(floors, "query_id", "left").select("query_id", "v", F.coalesce(F.col("f").cast("double"), low).alias("floor")))
    out = round_(again, False)
    held = F.when(F.col("score") == int(LONG.min), F.raise_error(F.lit("a score exceeds a long")).cast("long")).otherwise(F.col("score"))
    return out.select("query_id", "rank", "vec_id", held.alias("score"))
