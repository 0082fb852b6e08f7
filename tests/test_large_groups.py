"""Groups that are larger than at the driver's small sizes are whole in the queries as well."""

from itertools import combinations

from pyspark.sql import functions as F

from quillspark.operators import pairs
from quillspark.plans import catalogue, chronicle, extraction, identity


def test_meetings_are_all_pairs_once(spark, monkeypatch):
    """Against every pair, with blocks of three rows; d has two facts, and x none."""
    monkeypatch.setattr(pairs, "_BLOCK", 3)
    monkeypatch.setattr(pairs, "_TASK", 20)
    held = {f"m{i}": {k for k in range(1, 12) if (i * 7 + 3) % k == 0} for i in range(40)} | {"d": {1, 2}, "x": {1, 2}, "none": set()}
    rows = spark.createDataFrame([(m, str(k), "g") for m, ks in held.items() for k in ks] * 2 + [("m1", None, "g"), ("m1", "1", "other")], "m string, k string, g string")
    facts = spark.createDataFrame([(m, "g", m + "!") for m in held if m != "x"] + [("d", "g", "again")], "m string, g string, fact string")
    got = sorted(tuple(r) for r in pairs.meetings(rows, "m", ["k"], within="g", of=facts).select("g", "left_id", "right_id", "shared", "left_fact", "right_fact").collect())
    told = lambda m: ["d!", "again"] if m == "d" else [] if m == "x" else [m + "!"]
    assert got == sorted(("g", a, b, len(held[a] & held[b]), x, y) for a, b in combinations(sorted(held), 2) if held[a] & held[b] for x in told(a) for y in told(b))


def test_gaps_of_a_name_with_over_a_thousand_entries(spark, tmp_path):
    ks = [53 * i for i in range(1003)]
    spark.createDataFrame([(k,) for k in ks], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    got = catalogue.queries()["relationship_gaps"](spark, str(tmp_path)).agg(F.count(F.lit(1)), F.countDistinct("l", "r"), F.min("teachers"), F.min("students")).first()
    want = sum(a // 60 != b // 60 for a, b in combinations(ks, 2))
    assert tuple(got) == (want, want, 1, 1)


def test_gaps_are_all_pairs_and_equal_lists_meet_once(spark, monkeypatch):
    """Against every pair, with packs of about three entries; an entry has two rows in the view, one has none, and lists of none
    but strangers' names meet nobody. What meets are packs, not entries."""
    monkeypatch.setattr(pairs, "_PACK", 3)
    monkeypatch.setattr(pairs, "_BLOCK", 2)
    monkeypatch.setattr(pairs, "_TASK", 5)
    met, real = [], pairs.meetings

    def counted(rows, member, *args, **more):
        met.append(rows.select(member).distinct().count())
        return real(rows, member, *args, **more)

    monkeypatch.setattr(pairs, "meetings", counted)
    lists = {f"e{i:02}": ("g" if i % 10 else "h", {"t", f"t{i % 2}"}, {f"s{i % 3}"} if i % 4 else set()) for i in range(60)} | {"lone": ("g", {"nobody"}, set())}
    rows = [(e, k, n, g) for e, (g, *both) in lists.items() for k, ns in zip(("teachers", "students"), both, strict=True) for n in ns]
    view = [(e, g, f"i{e[-1]}", f"b-{e}") for e, (g, *_) in lists.items() if e != "e07"] + [("e08", "g", "again", "b-again")]
    feats, seen = spark.createDataFrame(rows * 2, "entry_id string, kind string, name string, name_key string"), spark.createDataFrame(view, "entry_id string, name_key string, identity_id string, book_id string")
    full = identity.relationship_gaps(feats, seen, most_group=None, more=())
    got = sorted((r.name_key, r.left_id, r.right_id, r.left_identity, r.right_identity, r.left_book, r.right_book, tuple(r.teachers), tuple(r.students), r.priority) for r in full.collect())
    want = []
    for (a, g, ai, ab), (b, h, bi, bb) in combinations(sorted(view), 2):
        common = [tuple(sorted(lists[a][k] & lists[b][k])) for k in (1, 2)]
        if g == h and a != b and ai != bi and any(common):
            want.append((g, a, b, ai, bi, ab, bb, *common, "both_lists_3plus" if all(common) and sum(map(len, common)) >= 3 else "weak_overlap"))
    assert got == sorted(want)
    assert met[0] < 45
    some = identity.relationship_gaps(feats, seen, most_group=None, brief=True)
    assert sorted((*sorted((r.left_book, r.right_book)), r.teachers, r.students) for r in some.collect()) == sorted((*sorted(w[5:7]), len(w[7]), len(w[8])) for w in want)


def test_gaps_read_no_statements(spark, monkeypatch):
    """Pairs of entries need names and lists: no statement, class or date is made for them."""

    def made(*args):
        raise AssertionError("not needed")

    for module, name in ((extraction, "statements"), (extraction, "biographies"), (chronicle, "records")):
        monkeypatch.setattr(module, name, made)
    assert catalogue.queries()["relationship_gaps"](spark, "/root/testdata/sf0.001").count() > 0
