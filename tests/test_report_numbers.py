"""Numbers of reports are read whatever their length."""

from quillspark.plans import catalogue


def test_grades_of_reports_above_99999(spark, tmp_path):
    ks = [99_998, 100_001, 1_199_998, 2**62 + 2]
    spark.createDataFrame([(k,) for k in ks], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    got = catalogue.queries()["grade_claims"](spark, str(tmp_path)).collect()
    assert sorted((r.k, r.number) for r in got) == [(k, str(k)) for k in ks]
