"""Pairs that share long lines are made where they are counted."""

from itertools import combinations

from quillspark.plans import catalogue, identity


def test_no_pair_is_shuffled(spark, tmp_path):
    """A line that all of 60 documents hold gives 1,770 pairs, which no join or count follows; a label comes twice."""
    lines = {i: {"all " * 20} | ({"some " * 20} if i % 3 == 0 else set()) for i in range(60)}
    spark.createDataFrame([(i, "en", "\n".join(ls)) for i, ls in lines.items()], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1), (1, 1), (1, 0), (2, 0)], "doc_id long, quality long").write.parquet(f"{tmp_path}/labels.parquet")
    df = catalogue.queries()["bulk_candidates"](spark, str(tmp_path))
    got = sorted((r.left_id, r.right_id, r.shared, r.date_relation, r.decision) for r in df.collect())
    year = {0: [1], 1: [0, 1], 2: [0]}
    told = lambda x, y: "incomplete_dates" if x is None or y is None else "matching_dates" if x == y else "conflicting_dates"
    want = [(*sorted((str(a), str(b))), len(lines[a] & lines[b]), told(x, y), "different" if (a + b) % 5 == 0 else None) for a, b in combinations(lines, 2) for x in year.get(a, [None]) for y in year.get(b, [None])]
    assert sorted(map(str, got)) == sorted(map(str, want))
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("Join ")
    assert plan[1].startswith("Inner") and "__k" in plan[1].splitlines()[0] and "Aggregate" not in plan[0]


def test_decisions_as_a_table(spark):
    members = spark.createDataFrame([("a", "n", 1), ("b", "n", 2), ("c", "m", 1)], "entry_id string, name_key string, year int")
    said = spark.createDataFrame([(e, t, 70) for e in "abc" for t in "pq"] + [("c", "short", 5), ("a", "short", 5)], "entry_id string, text_sha256 string, chars int")
    decided = spark.createDataFrame([("b", "a", "same")], "left_id string, right_id string, decision string")
    assert [tuple(r) for r in identity.bulk_candidates(members, said, decided).collect()] == [("a", "b", "n", 2, "strong_literal", "conflicting_dates", "same")]
