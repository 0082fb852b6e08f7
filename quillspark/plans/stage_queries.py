"""Reader, review and identity stages on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.passages import elementary_intervals, toc_level
from quillspark.operators import sequence
from quillspark.plans import identity, reader, review
from quillspark.plans.base import Registry, Tables

query = Registry()


@query("SELECT conv_id, role AS title, turn AS page FROM (SELECT *, lag(role) OVER w AS p, row_number() OVER w AS n FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE n = 1 OR p IS DISTINCT FROM role")
def volume_starts(t: Tables) -> DataFrame:
    return reader.volumes(t.conversations, "conv_id", "role", "turn").withColumnRenamed("turn", "page")


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) - 1 AS page FROM documents")
def global_page_index(t: Tables) -> DataFrame:
    return reader.page_index(t.documents.select("doc_id", "source", "n_chars"), "source", ["n_chars", "doc_id"]).drop("n_chars")


@query("WITH v AS (SELECT conv_id, turn, role, CASE WHEN lag(role) OVER w IS DISTINCT FROM role THEN role END AS t FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn AS page, last_value(t IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS volume FROM v")
def volume_lookup(t: Tables) -> DataFrame:
    v = reader.volumes(t.conversations, "conv_id", "role", "turn")
    return reader.volume_of(t.conversations, v, "conv_id", "turn")


_STATES = "g AS (SELECT source, doc_id, CASE WHEN toxic = 1 AND quality = 1 THEN 'review' WHEN toxic = 1 THEN 'weak' WHEN quality = 1 THEN 'sahih' END AS status FROM labels JOIN documents USING (doc_id))"


def _graded(t: Tables) -> DataFrame:
    s = F.when((F.col("toxic") == 1) & (F.col("quality") == 1), F.array(F.lit("weak"), F.lit("sahih"))).when(F.col("toxic") == 1, F.array(F.lit("weak"))).when(F.col("quality") == 1, F.array(F.lit("sahih"))).otherwise(F.array().cast("array<string>"))
    return t.labels.join(t.documents.select("doc_id", "source"), "doc_id").select("source", "doc_id", reader.grade_status(s).alias("status"))


@query(f"WITH {_STATES} SELECT source, count(*) FILTER (status = 'weak') AS weak, count(*) FILTER (status = 'sahih') AS sahih, count(*) FILTER (status = 'hasan') AS hasan, count(*) FILTER (status = 'review') AS review FROM g GROUP BY 1")
def grade_rollup(t: Tables) -> DataFrame:
    return reader.grade_counts(_graded(t), "source")


@query(f"WITH {_STATES} SELECT source, doc_id, status, min(CASE WHEN status = 'sahih' THEN doc_id END) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_page FROM g")
def next_graded_page(t: Tables) -> DataFrame:
    return reader.next_graded(_graded(t), "source", "status", page="doc_id")


@query("WITH h AS (SELECT doc_id, length(text) AS n, length(text) // 4 AS a, length(text) // 2 AS b, length(text) * 3 // 4 AS c FROM documents), e AS (SELECT doc_id, n, a, b, c, unnest(list_sort(list_distinct([0, n, a, c, b, c]))) AS s FROM h), p AS (SELECT *, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS e FROM e) SELECT doc_id, s::INT AS \"start\", e::INT AS \"end\", ((a <= s AND c >= e)::INT + (b <= s AND c >= e)::INT) AS ranges FROM p WHERE e IS NOT NULL")
def highlight_pieces(t: Tables) -> DataFrame:
    n = F.length("text")
    at = lambda f: F.floor(n * f).cast("int")
    ranges = F.array(F.struct(at(0.25).alias("start"), at(0.75).alias("end")), F.struct(at(0.5).alias("start"), at(0.75).alias("end")))
    got = t.documents.select("doc_id", F.explode(elementary_intervals(n, ranges)).alias("p"))
    return got.select("doc_id", "p.start", "p.end", F.size("p.over").alias("ranges"))


@query("SELECT doc_id, CASE WHEN starts_with(title, 'كتاب') OR starts_with(title, 'الكتاب') THEN 1 ELSE 2 END AS level FROM (SELECT doc_id, string_split(text, chr(10))[1] AS title FROM documents) WHERE length(title) > 4 AND length(title) < 250")
def toc_levels(t: Tables) -> DataFrame:
    h = t.documents.select("doc_id", F.split("text", "\n")[0].alias("title"))
    return h.select("doc_id", toc_level(F.col("title")).alias("level")).where("level IS NOT NULL")


@query("SELECT sha256, doc_id FROM (SELECT sha256(text) AS sha256, doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY source, doc_id) AS n FROM documents) WHERE n = 1")
def first_occurrences(t: Tables) -> DataFrame:
    rows = t.documents.select(F.sha2("text", 256).alias("sha256"), "source", "doc_id")
    return sequence.latest(rows, ["sha256"], [F.col("source"), F.col("doc_id")]).select("sha256", "doc_id")


@query("SELECT name_key, year FROM (SELECT o_custkey AS name_key, year(o_orderdate)::INT AS year FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey, year(o_orderdate)::INT FROM orders WHERE o_orderpriority = '1-URGENT')")
def year_evidence_union(t: Tables) -> DataFrame:
    rows = t.orders.select(F.col("o_custkey").alias("name_key"), F.year("o_orderdate").alias("year"), "o_orderstatus", "o_orderpriority")
    return rows.where("o_orderstatus = 'F'").select("name_key", "year").union(rows.where("o_orderpriority = '1-URGENT'").select("name_key", "year")).distinct()


def _entries(t: Tables) -> DataFrame:
    """Parts as entries: one name, a book, and biographies but for one type."""
    kind = F.when(F.col("p_type") == "ECONOMY", "short_index_candidate").otherwise("biography_candidate")
    return t.part.select(F.col("p_partkey").cast("string").alias("entry_id"), F.col("p_name").alias("name_key"), F.col("p_name").alias("name_label"), kind.alias("classification"), F.col("p_brand").alias("book_id"), F.col("p_type").alias("opening_page_id"))


@query("SELECT 'name-' || left(sha256(p_name), 32) AS name_group_id, p_name AS name_key, count(*) AS entry_count, count(*) FILTER (p_type <> 'ECONOMY') AS biography_count, count(DISTINCT p_brand) AS distinct_books, CASE WHEN count(*) FILTER (p_type <> 'ECONOMY') = 0 THEN 'index_only' WHEN count(*) = 1 THEN 'single_entry' WHEN len(string_split(p_name, ' ')) < 5 THEN 'short_name_review' ELSE 'multiple_entries' END AS status FROM part GROUP BY p_name")
def name_index(t: Tables) -> DataFrame:
    return identity.name_groups(_entries(t))


@query("WITH c AS (SELECT p_name AS identity_id, p_partkey AS e, p_size AS y FROM part WHERE p_size > 0), g AS (SELECT identity_id, count(*) AS claims, count(DISTINCT e) AS entries, list_sort(list(DISTINCT y)) AS ys FROM c GROUP BY 1), u AS (SELECT *, CASE WHEN ys[1] = ys[-1] THEN 1 WHEN ys[1] // 10 = ys[-1] // 10 THEN 10 WHEN ys[1] // 100 = ys[-1] // 100 THEN 100 WHEN ys[1] // 1000 = ys[-1] // 1000 THEN 1000 END AS b FROM g) SELECT identity_id, claims, entries, array_to_string(ys, ',') AS years, b::INT AS bucket_size, (ys[1] // b * b)::INT AS bucket_start, (ys[1] // b * b + b - 1)::INT AS bucket_end FROM u")
def identity_date_summary(t: Tables) -> DataFrame:
    view = _entries(t).withColumn("identity_id", F.col("name_key"))
    dated = t.part.where("p_size > 0").select(F.col("p_partkey").cast("string").alias("entry_id"), F.col("p_size").alias("year"), F.lit("q").alias("quote"), F.lit("p").alias("page_id"))
    return identity.identity_dates(view, dated, dated.limit(0))[1]


@query("WITH p AS (SELECT doc_id AS e, doc_id // 4 AS person FROM labels WHERE quality = 1), d AS (SELECT a.e AS l, b.e AS r FROM p a JOIN p b ON a.person = b.person AND a.e < b.e JOIN labels x ON x.doc_id = a.e JOIN labels y ON y.doc_id = b.e WHERE x.toxic = y.toxic), s AS (SELECT person, count(*) AS n FROM p GROUP BY 1), h AS (SELECT person, count(*) AS decided FROM d JOIN p ON p.e = d.l GROUP BY 1) SELECT person AS person_id, n, (n * (n - 1) // 2 - coalesce(decided, 0))::BIGINT AS missing FROM s LEFT JOIN h USING (person) WHERE n * (n - 1) // 2 > coalesce(decided, 0) OR n < 2")
def incomplete_persons(t: Tables) -> DataFrame:
    """Documents of good quality, four ids to a person; two of a person with equal toxic labels are decided as the same."""
    p = t.labels.where("quality = 1").select(F.col("doc_id").alias("entry_id"), F.floor(F.col("doc_id") / 4).alias("person_id"), "toxic")
    l, r = p.alias("l"), p.alias("r")
    same = l.join(r, (F.col("l.person_id") == F.col("r.person_id")) & (F.col("l.entry_id") < F.col("r.entry_id")) & (F.col("l.toxic") == F.col("r.toxic")))
    return identity.incomplete_persons(p, same.select(F.col("l.entry_id").alias("left_id"), F.col("r.entry_id").alias("right_id"), F.lit("same").alias("decision")))


@query("WITH g AS (SELECT p_name AS name_label, p_size AS y, p_name || p_size AS gid, min(p_partkey) AS e FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY name_label, gid) AS rank FROM g WHERE y = (SELECT min(y) FROM g) OR y = (SELECT max(y) FROM g)) SELECT gid AS group_id, name_label, y AS death_year, rank, e AS entry_id FROM r WHERE rank <= 8")
def endpoint_examples(t: Tables) -> DataFrame:
    rec = t.part.select(F.col("p_partkey").alias("entry_id"), F.concat("p_name", "p_size").alias("group_id"), F.col("p_name").alias("name_label"), F.col("p_size").alias("death_year"), F.lit("p").alias("evidence_page_id"), F.lit("q").alias("evidence_quote"))
    groups = rec.groupBy("group_id", "name_label", "death_year").agg(F.count(F.lit(1)).alias("source_entries"))
    return review.endpoint_examples(groups, rec).select("group_id", "name_label", "death_year", "rank", "entry_id")


@query("SELECT 'unlabelled' AS what, count(*) AS n FROM conversations WHERE text IS NULL OR trim(text) = '' UNION ALL SELECT 'fallback', count(*) FROM pages WHERE url LIKE 'http://%' UNION ALL SELECT 'odd_sources', count(*) FROM documents WHERE source IS NULL OR source NOT IN ('src0', 'src1')")
def audit_predicates(t: Tables) -> DataFrame:
    """Blank-or-null labels, a prefix, and a list of literals."""
    rows = [
        t.conversations.where(F.col("text").isNull() | (F.trim("text") == "")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("unlabelled").alias("what"), "n"),
        t.pages.where(F.col("url").startswith("http://")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("fallback").alias("what"), "n"),
        t.documents.where(F.col("source").isNull() | ~F.col("source").isin("src0", "src1")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("odd_sources").alias("what"), "n"),
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def _book_pages(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents as pages of their source; a long first line is a heading, two of three of them with a name."""
    pages = t.documents.select(F.col("doc_id").alias("page_id"), F.col("source").alias("source_id"), F.lit("book").alias("book_id"), F.col("doc_id").alias("ordinal"), "text")
    first = F.split("text", "\n")[0]
    heads = t.documents.where(F.length(first) >= 40).select(F.col("doc_id").alias("entry_id"), F.col("doc_id").alias("page_id"), F.lit(0).alias("start_offset"), F.length(first).alias("end_offset"), F.when(F.col("doc_id") % 3 > 0, first).alias("name_label"))
    return pages, heads, t.documents.limit(0).select(F.col("doc_id").alias("page_id"), F.lit(0).alias("start_offset"), F.lit(0).alias("end_offset"))


@query("""
WITH p AS (SELECT doc_id, source, length(text) AS n, length(string_split(text, chr(10))[1]) >= 40 AS head FROM documents),
o AS (SELECT *, last_value(CASE WHEN head THEN CASE WHEN doc_id % 3 > 0 THEN doc_id ELSE -1 END END IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner FROM p)
SELECT doc_id AS page_id, 0 AS start_offset, n::INT AS end_offset, nullif(owner, -1) AS biography_id, CASE WHEN owner IS NULL OR owner = -1 THEN 'unassigned' WHEN head THEN 'opening' ELSE 'continuation' END AS role FROM o WHERE n > 0""")
def extraction_regions(t: Tables) -> DataFrame:
    from quillspark.plans import extraction

    pages, heads, _ = _book_pages(t)
    return extraction.regions(pages, heads).drop("source_id")
