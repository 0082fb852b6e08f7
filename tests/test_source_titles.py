"""Titles come out as the page spells them."""

import duckdb

from quillspark.plans import catalogue


def test_titles_with_references_of_all_kinds(spark, tmp_path):
    titles = ["a &amp; b", "cut &amp", "cut &am", 'token = &quot;1&quot; "2"', "a > b & c", "&#39;", ""]
    rows = [(i, f"<html><head><title>{x}</title></head><body><p>x</p></body></html>") for i, x in enumerate(titles)] + [(90, "<p>none</p>"), (91, None)]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = catalogue.queries()["html_page_shape"](spark, str(tmp_path)).collect()
    want = duckdb.sql(catalogue.oracle_sql()["html_page_shape"].replace("FROM pages", f"FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")).fetchall()
    assert sorted((r.page_id, r.title, r.fallback, r.pages) for r in got) == sorted(want, key=lambda r: r[0]) and [r.title for r in got if r.page_id < 90] == titles
