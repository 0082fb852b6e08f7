"""Pairs that share little, or texts that many hold, are in the pair queries as well."""

import pytest

from quillspark.plans import catalogue


def supplied(spark, path, parts):
    """parts: partkey, name, suppliers."""
    spark.createDataFrame([(e, k, "B") for e, k, _ in parts], "p_partkey long, p_name string, p_brand string").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame([(e, s) for e, _, ss in parts for s in ss], "l_partkey long, l_suppkey long").write.parquet(f"{path}/lineitem.parquet")
    return str(path)


@pytest.fixture(scope="module")
def overlaps(spark, tmp_path_factory):
    """1 and 2 share three suppliers, 1 and 3 two, 1 and 4 one, 5 none with anyone; 6 has another name."""
    return supplied(spark, tmp_path_factory.mktemp("overlaps"), [(1, "red tin", [1, 2, 3, 4]), (2, "red tin", [1, 2, 3]), (3, "red tin", [3, 4]), (4, "red tin", [4]), (5, "red tin", [9]), (6, "blue tin", [1, 2, 3, 4])])


PAIRS = {(1, 2): "1,2,3", (1, 3): "3,4", (1, 4): "4", (2, 3): "3", (3, 4): "4"}


def test_overlaps_of_one_and_two(spark, overlaps):
    got = catalogue.queries()["array_overlap_pairs"](spark, overlaps).collect()
    assert {(r.left_id, r.right_id): r.common for r in got} == PAIRS and len(got) == 5
    assert {(r.left_id, r.right_id): r.priority for r in got} == {p: "one_list_3plus" if p == (1, 2) else "weak_overlap" for p in PAIRS}


def test_observations_and_neighbors_of_weak_overlaps(spark, overlaps):
    got = catalogue.queries()["symmetric_observations"](spark, overlaps).collect()
    assert sorted((r.entry_id, r.other_id) for r in got) == sorted([*PAIRS, *[(b, a) for a, b in PAIRS]])
    got = catalogue.queries()["graph_neighbors"](spark, overlaps).collect()
    assert [tuple(r) for r in got] == [("red tin", "B", 4, 10)]


def test_variant_pairs_of_one_shared_supplier(spark, tmp_path):
    """1 and 2 share four suppliers, 1 and 3 one; 4 has the name of 1, 5 another signature."""
    sf = supplied(spark, tmp_path, [(1, "red tin", [1, 2, 3, 4]), (2, "blue tin", [1, 2, 3, 4]), (3, "green tin", [4]), (4, "red tin", [1]), (5, "red zinc", [1, 2])])
    got = catalogue.queries()["variant_pairs_cross_key"](spark, sf).collect()
    assert {(r.left_id, r.right_id): r.shared for r in got} == {(1, 2): 4, (1, 3): 1, (2, 3): 1, (2, 4): 1} and len(got) == 4


def test_lines_of_up_to_twenty_documents_give_pairs(spark, tmp_path):
    """One line in 5 documents, one in 20, one in 21, which is above the reference's cap."""
    texts = [(i, "en", c * 70) for c, ids in (("a", range(5)), ("b", range(100, 120)), ("c", range(200, 221))) for i in ids]
    spark.createDataFrame(texts, "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.left_id, r.right_id) for r in catalogue.queries()["literal_pairs_capped"](spark, str(tmp_path)).collect()}
    assert got == {(a, b) for ids in (range(5), range(100, 120)) for a in ids for b in ids if a < b}
