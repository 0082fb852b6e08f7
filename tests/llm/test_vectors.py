"""The vector searches (5 and 8) against brute force: any scale, copies, unlike lengths, rows that take no part."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import ann, topk

VEC = "vec_id long, embedding array<float>, label int"
DOUBLE = "vec_id long, embedding array<double>, label int"


def frame(spark, rows, kind=VEC):
    return spark.createDataFrame([(i, None if v is None else list(v), 0) for i, v in rows], kind)


def inner(a, b):
    out = 0.0
    for x, y in zip(a, b):  # the shorter one's missing components are zeros
        out += float(x) * float(y)
    return out


def nearest(rows, every, k):
    """Brute force in double precision: the best score of each id, ties to the smaller id."""
    out = {}
    for q in sorted({i for i, _ in rows if i % every == 0}):
        own = min(v for i, v in rows if i == q)
        best = {}
        for i, v in rows:
            if i != q:
                best[i] = max(best.get(i, -math.inf), inner(own, v))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in want.items() if x}
    for q, rows in got.items():
        assert rows == sorted(rows, key=lambda x: (-x[1], x[0])) and q not in dict(rows)
    return sum(len(dict(got[q]).keys() & dict(want[q]).keys()) for q in got) / sum(map(len, got.values()))


def as_floats(m):
    return np.asarray(m, np.float32).astype(np.float64).tolist()


@pytest.mark.parametrize("scale", [1e-30, 1.0, 3e37])
def test_ann_at_any_scale(spark, scale):
    rng = np.random.default_rng(4)
    rows = list(enumerate(as_floats(rng.standard_normal((300, 16)) * scale)))
    want = nearest(rows, 20, 20)
    got = found(ann.search(frame(spark, rows)))
    assert recall(got, want) >= 0.9
    exact = {i: v for i, v in rows}
    assert all(s == inner(exact[q], exact[i]) for q, x in got.items() for i, s in x)


def test_ann_of_mixed_scales_loses_nothing(spark):
    rng = np.random.default_rng(5)
    scales = 10.0 ** rng.uniform(-30, 38, 200)
    rows = list(enumerate(as_floats(rng.uniform(-1, 1, (200, 8)) * scales[:, None])))
    assert recall(found(ann.search(frame(spark, rows))), nearest(rows, 20, 20)) >= 0.9


def test_ann_keeps_doubles(spark):
    rng = np.random.default_rng(6)
    rows = list(enumerate((rng.standard_normal((200, 12)) * 10.0 ** rng.uniform(-2, 100, (200, 1))).tolist()))
    got = found(ann.search(frame(spark, rows, DOUBLE)))
    assert recall(got, nearest(rows, 20, 20)) >= 0.9
    assert all(s == inner(rows[q][1], rows[i][1]) for q, x in got.items() for i, s in x)
    huge = list(enumerate([[1e200, 1.0], [1e200, -1.0], [-1e200, 1.0], [1.0, 1.0]]))
    assert found(ann.search(frame(spark, huge, DOUBLE)))[0] == [(1, math.inf), (3, 1e200), (2, -math.inf)]


def test_ann_large_norms_of_floats(spark):
    rows = [(i, as_floats([v])[0]) for i, v in ((0, [3e38, 1e38]), (20, [2e38, 2e38]), (1, [1e38, -1e38]), (2, [1e38, 1e37]))]
    got = found(ann.search(frame(spark, rows)))
    assert got == nearest(rows, 20, 20) and all(len(x) == 3 for x in got.values())


def test_equal_vectors_are_one_class(spark):
    rows = [(i, [0.5, 0.75]) for i in range(100)] + [(200, [1.0, 0.0])]
    want = nearest(rows, 20, 20)
    assert found(ann.search(frame(spark, rows))) == want
    assert [i for i, _ in want[0]] == list(range(1, 21))


def test_several_vectors_under_an_id_and_unlike_lengths(spark):
    rng = np.random.default_rng(7)
    rows = list(enumerate(as_floats(rng.standard_normal((60, 6)))))
    rows += [(20, [9.0] * 6), (21, [8.0] * 6), (22, [7.0, 7.0]), (40, [0.5]), (23, [3.0] * 9)]
    got = found(ann.search(frame(spark, rows + rows[:10])))
    assert recall(got, nearest(rows, 20, 20)) >= 0.95 and {21, 20} <= {i for i, _ in got[0]} | {i for i, _ in got[40]}


def odd(d):
    return [(1000, None), (1020, [0.0] * d), (1040, [float("nan")] + [1.0] * (d - 1)), (1060, [float("inf")] * d), (1080, [None] + [1.0] * (d - 1)), (None, [1.0] * d), (1100, [])]


def test_ann_leaves_out_what_takes_no_part(spark):
    rng = np.random.default_rng(8)
    rows = list(enumerate(as_floats(rng.standard_normal((80, 8)))))
    df = frame(spark, rows + odd(8)).withColumn("q", F.lit(1)).withColumn("rep", F.lit("x"))
    assert recall(found(ann.search(df)), nearest(rows, 20, 20)) >= 0.9
    assert ann.search(df.limit(0)).count() == 0 and ann.search(frame(spark, odd(8))).count() == 0 and ann.search(frame(spark, rows[:1])).count() == 0


def test_ann_always_returns_k_in_dense_clusters(spark):
    rng = np.random.default_rng(6)
    v = np.repeat(rng.standard_normal((12, 16)), 40, axis=0) + 0.05 * rng.standard_normal((480, 16))
    rows = list(enumerate(as_floats(v)))
    assert recall(found(ann.search(frame(spark, rows))), nearest(rows, 20, 20)) >= 0.9


def test_ann_in_many_cells_chunks_and_lots(spark, monkeypatch):
    """Small limits: several cells a tree, chunks of a dense cell, and lots of its queries."""
    for name, n in (("CELL", 64), ("MOST_QUERIES", 4), ("PACK", 100), ("LOT", 32), ("ROWS", 8)):
        monkeypatch.setattr(ann, name, n)
    rng = np.random.default_rng(9)
    v = rng.standard_normal((600, 12))
    v[:300] = v[0] + 0.1 * v[:300]
    rows = list(enumerate(as_floats(v)))
    assert recall(found(ann.search(frame(spark, rows))), nearest(rows, 20, 20)) >= 0.9


def test_bounds_hold_the_inner_product():
    rng = np.random.default_rng(10)
    for d in (1, 3, 64, 700):
        v = rng.standard_normal((200, d)) * 10.0 ** rng.uniform(-20, 20, (200, 1))
        q = rng.standard_normal((20, d))
        u, own = ann.scaled(v)
        z, scales = np.rint(u * 127).astype(np.int8), own / own.max() / 127
        scales = np.where(scales < ann.TINY, scales, scales.astype(np.float32))
        uq = ann.scaled(q)[0]
        row, col, low, high = ann.within(uq.astype(np.float32), z, scales, np.full(20, -np.inf), 500)
        assert len(row) == 20 * 200
        true = np.einsum("ij,ij->i", uq[row], v[col] / own.max())
        assert (low <= true).all() and (true <= high).all()


def test_ascent_is_monotone():
    deep, shallow = ann.ascent(0.95, 1.0), ann.ascent(0.3, 1.0)
    assert sum(deep) > sum(shallow) and max(deep) - min(deep) <= 1 and ann.ascent(float("-inf"), 1.0) == [0] + [ann.DEPTH] * (ann.TREES - 1)


def whole_best(rows, every=50, k=5):
    """Brute force in Python's integers; every row is a candidate."""
    w = [(i, [math.floor(256 * x) if abs(x) < 1e300 else None for x in v]) for i, v in rows]
    out = {}
    for q in sorted({i for i, _ in rows if i % every == 0}):
        own = next(x for i, x in w if i == q)
        s = [(sum(a * b for a, b in zip(own, x)), i) for i, x in w if i != q]
        out[q] = [(i, x) for x, i in sorted(s, key=lambda y: (-y[0], y[1]))[:k]]
    return out


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e4, 2e6])
def test_topk_is_exact_at_any_scale(spark, scale):
    rng = np.random.default_rng(11)
    v = rng.standard_normal((300, 8)) * scale
    v[50:90] = v[0]
    rows = list(enumerate(as_floats(v)))
    assert found(topk.search(frame(spark, rows))) == whole_best(rows)


def test_topk_loses_no_large_component(spark):
    rows = [(0, [1.0, 0.0]), (1, [1e7, 1.0]), (2, [0.5, 0.5]), (50, [9e6, 1.0])]
    assert found(topk.search(frame(spark, rows))) == whole_best(rows)
    rng = np.random.default_rng(12)
    rows = list(enumerate(as_floats(rng.standard_normal((80, 4))))) + [(101, [3e38, 0.0, 0.0, 0.0]), (102, [0.0, -3e38, 3e38, 0.0])]
    rows = [(i, [0.0, 0.0, 0.0, 1.5]) if i % 50 == 0 else (i, v) for i, v in rows]
    assert found(topk.search(frame(spark, rows))) == whole_best(rows)


def test_topk_fails_on_a_score_beyond_a_long(spark):
    rows = [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [1.0, 1.0])]
    with pytest.raises(Exception, match="exceeds a long"):
        topk.search(frame(spark, rows)).collect()
    with pytest.raises(Exception, match="exceeds a long"):
        topk.search(frame(spark, [(0, [3e38]), (1, [-3e38])])).collect()


def test_topk_keeps_every_row(spark):
    rng = np.random.default_rng(13)
    rows = list(enumerate(as_floats(rng.standard_normal((120, 6))))) + [(1020, [0.0] * 6), (3, [5.0] * 6), (7, [4.0, 4.0]), (9, [2.0] * 8), (1101, [])]
    df = frame(spark, rows + [x for x in odd(6) if x[0] not in (1020, 1100)] + rows[5:6]).withColumn("page", F.lit(1)).withColumn("pack", F.lit("x"))
    assert found(topk.search(df)) == whole_best(rows)
    assert topk.search(df.limit(0)).count() == 0


def test_topk_in_many_pages_groups_and_lots(spark, monkeypatch):
    for name, n in (("BLOCK", 8), ("CELLS", 128), ("FAN", 2), ("PACK", 2), ("MOST_PACKS", 2), ("MOST_QUERIES", 4), ("SEEDS", 1)):
        monkeypatch.setattr(topk, name, n)
    rng = np.random.default_rng(14)
    rows = list(enumerate(as_floats(rng.standard_normal((400, 8)))))
    assert found(topk.search(frame(spark, rows), every=20)) == whole_best(rows, every=20)


def test_topk_bounds():
    q, hi, lo = np.array([[2.0, -1.0]]), np.array([[3.0, 5.0], [-1.0, 4.0]]), np.array([[1.0, 2.0], [-2.0, 0.0]])
    assert topk.bounds(q, hi, lo).tolist() == [[4.0, -2.0]]
    assert topk.bounds(np.array([[1e300]]), np.array([[1e300]]), np.array([[-1e300]])).tolist() == [[math.inf]]
