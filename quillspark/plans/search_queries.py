"""Full-text search on the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import search
from quillspark.plans.base import Registry, Tables

query = Registry()

_TOK = r"tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents)"


def _found(t: Tables, q: str, mode: str) -> DataFrame:
    return search.search(t.documents.select("doc_id", "text"), "doc_id", "text", q, mode).select("doc_id")


@query(f"WITH {_TOK} SELECT doc_id FROM tok WHERE list_contains(w, 'the') AND list_contains(w, 'with')")
def search_words(t: Tables) -> DataFrame:
    return _found(t, "the with", "words")


@query(f"WITH {_TOK} SELECT doc_id FROM tok WHERE contains(' ' || array_to_string(w, ' ') || ' ', ' of the ')")
def search_phrase(t: Tables) -> DataFrame:
    return _found(t, "of the", "phrase")


@query(f"WITH {_TOK} SELECT doc_id FROM tok WHERE list_contains(w, 'und') AND len(list_filter(w, lambda x: starts_with(x, 'sch'))) > 0")
def search_prefix(t: Tables) -> DataFrame:
    return _found(t, "und sch", "prefix")


@query(f"WITH {_TOK} SELECT tok.doc_id FROM tok JOIN documents USING (doc_id) WHERE list_contains(w, 'that') AND list_contains(w, 'and') AND contains(text, 'That and')")
def search_exact(t: Tables) -> DataFrame:
    return _found(t, "That and", "exact")


@query(rf"""WITH {_TOK}, d AS (SELECT doc_id, len(w) AS dl, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'with')) AS b FROM tok),
s AS (SELECT count(*) FILTER (dl > 0)::DOUBLE AS n, avg(dl) FILTER (dl > 0) AS m, count(*) FILTER (a > 0)::DOUBLE AS fa, count(*) FILTER (b > 0)::DOUBLE AS fb FROM d)
SELECT doc_id, round(ln((n - fa + 0.5) / (fa + 0.5) + 1) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * dl / m)) + ln((n - fb + 0.5) / (fb + 0.5) + 1) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * dl / m)), 6) AS score
FROM d, s WHERE a + b > 0 ORDER BY score DESC, doc_id LIMIT 20""")
def bm25_topk(t: Tables) -> DataFrame:
    got = search.bm25(t.documents, "doc_id", F.lower("text"), ["the", "with"])
    return got.select("doc_id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(20)


@query(r"""WITH h AS (SELECT doc_id, lower(string_split(text, chr(10))[1]) AS title FROM documents), w AS (SELECT doc_id, title, regexp_extract_all(title, '[\p{L}\p{N}]+') AS w FROM h)
SELECT doc_id, leads, row_number() OVER (ORDER BY leads DESC, doc_id) AS position FROM (SELECT doc_id, starts_with(title, 'the') AS leads FROM w WHERE list_contains(w, 'the')) ORDER BY position LIMIT 20""")
def entry_ranking(t: Tables) -> DataFrame:
    """Titles that begin with the query come first (L2)."""
    from pyspark.sql import Window as W

    h = t.documents.select("doc_id", F.lower(F.split("text", "\n")[0]).alias("title"))
    got = search.search(h, "doc_id", "title", "the").select("doc_id", F.col("title").startswith("the").alias("leads"))
    got = got.orderBy(F.desc("leads"), "doc_id").limit(20)
    return got.withColumn("position", F.row_number().over(W.orderBy(F.desc("leads"), "doc_id")).cast("long"))
