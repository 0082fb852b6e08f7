"""Corpus, citations, paging, windows and segmentation on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators import audit, corpus, sequence
from quillspark.plans.base import Registry, Tables

query = Registry()

LINES = """lines AS (
  SELECT doc_id, source, i, line, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_offset
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
passages AS (SELECT doc_id, source, start_offset, start_offset + length(line) AS end_offset, sha256(line) AS sha256, line AS passage FROM lines WHERE length(regexp_replace(line, '^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$', '', 'g')) >= 80)"""


@query("SELECT sha256(text) AS sha256, min(length(text))::BIGINT AS char_count, count(*) AS occurrences, min(doc_id) AS first_id FROM documents GROUP BY 1")
def page_text_dedup(t: Tables) -> DataFrame:
    return corpus.page_texts(t.documents, "doc_id", "text")


@query("SELECT sha256(text) AS sha256, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_pages(t: Tables) -> DataFrame:
    return corpus.duplicate_groups(t.documents, F.sha2("text", 256).alias("sha256"))


@query(f"WITH {LINES} SELECT doc_id, start_offset, end_offset, sha256 FROM passages")
def passages_with_offsets(t: Tables) -> DataFrame:
    return corpus.passages(t.documents, "doc_id", "text").drop("passage")


@query(f"WITH {LINES} SELECT sha256, count(*) AS occurrences, count(DISTINCT doc_id) AS pages, min(doc_id) AS first_id FROM passages GROUP BY 1 HAVING count(*) > 1")
def duplicate_passages(t: Tables) -> DataFrame:
    p = corpus.passages(t.documents, "doc_id", "text")
    return p.groupBy("sha256").agg(F.count(F.lit(1)).alias("occurrences"), F.countDistinct("doc_id").alias("pages"), F.min("doc_id").alias("first_id")).where("occurrences > 1")


@query(r"WITH n AS (SELECT sha256(w) AS sha256, lower(trim(regexp_replace(w, '\s+', ' ', 'g'))) AS norm FROM (SELECT unnest(string_split(text, '.')) AS w FROM documents) WHERE length(w) >= 8) SELECT sha256(norm) AS normalized_sha256, count(DISTINCT sha256) AS variants, count(*) AS occurrences FROM n GROUP BY 1 HAVING count(DISTINCT sha256) > 1")
def normalized_variant_groups(t: Tables) -> DataFrame:
    from quillspark.functions.arabic import normalize

    w = t.documents.select(F.explode(F.split("text", r"\.", -1)).alias("w")).where(F.length("w") >= 8)
    # Keys of 32 and 16 bytes; equal sentences are counted before they travel.
    p = w.select(F.unhex(F.md5("w")).alias("w"), F.unhex(F.sha2(normalize(F.col("w")), 256)).alias("n"))
    once = p.groupBy("n", "w").agg(F.count(F.lit(1)).alias("c"))
    got = once.groupBy("n").agg(F.count(F.lit(1)).alias("variants"), F.sum("c").alias("occurrences")).where("variants > 1")
    return got.select(F.lower(F.hex("n")).alias("normalized_sha256"), "variants", "occurrences")


@query("SELECT count(*) AS occurrences, count(DISTINCT sha256(text)) AS distinct_texts, count(*) - count(DISTINCT sha256(text)) AS reused, sum(octet_length(encode(text)))::BIGINT AS bytes FROM documents")
def storage_reuse_summary(t: Tables) -> DataFrame:
    return corpus.storage_reuse(t.documents, F.sha2("text", 256), F.octet_length("text"))


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, o_orderpriority AS priority, c_name AS customer, n_name AS nation FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def citations_star_join(t: Tables) -> DataFrame:
    """Nation is a fixed table of 25 rows; the other sides are left to the planner's own size check."""
    got = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return got.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part_id"), F.col("o_orderpriority").alias("priority"), F.col("c_name").alias("customer"), F.col("n_name").alias("nation"))


@query("SELECT source, count(*) AS files, count(DISTINCT sha256(text)) AS distinct_texts, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY source")
def books_with_file_counts(t: Tables) -> DataFrame:
    return t.documents.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.countDistinct(F.sha2("text", 256)).alias("distinct_texts"), F.sum("n_chars").alias("chars"))


@query("SELECT doc_id, source, position, has_more FROM (SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 40 AS position, count(*) OVER () > 60 AS has_more FROM documents) WHERE position BETWEEN 1 AND 20")
def page_sources_paged(t: Tables) -> DataFrame:
    return corpus.page(t.documents.select("doc_id", "source"), [F.col("source"), F.col("doc_id")], 20, 40)


@query("SELECT conv_id, turn, lag(turn) OVER w AS previous_id, lead(turn) OVER w AS next_id FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def prev_next_page(t: Tables) -> DataFrame:
    return sequence.neighbours(t.conversations.select("conv_id", "turn"), "conv_id", ["turn"], "turn")


_OWNED = """owned AS (
  SELECT conv_id, turn, role, text, last_value(CASE WHEN role = 'user' THEN turn WHEN role = 'system' THEN -1 END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS o FROM conversations)"""


def _owned(t: Tables) -> DataFrame:
    """A user turn is a person's heading, a system turn another heading, an assistant turn a body page."""
    heading = F.col("role").isin("user", "system")
    return sequence.carry_forward(t.conversations, "conv_id", ["turn"], heading, F.when(F.col("role") == "user", F.col("turn")))


@query(f"WITH {_OWNED} SELECT conv_id, turn, nullif(o, -1) AS owner, CASE WHEN role = 'user' THEN 'opening' WHEN nullif(o, -1) IS NOT NULL THEN 'continuation' ELSE 'unassigned' END AS role FROM owned")
def segments_carry_forward(t: Tables) -> DataFrame:
    role = F.when(F.col("role") == "user", "opening").when(F.col("owner").isNotNull(), "continuation").otherwise("unassigned")
    return _owned(t).select("conv_id", "turn", "owner", role.alias("role"))


@query("SELECT boundary_status, count(*) AS n FROM (SELECT role, CASE WHEN lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT NULL THEN 'next_recorded_heading' ELSE 'source_file_end_unresolved' END AS boundary_status FROM conversations WHERE role IN ('user', 'system')) WHERE role = 'user' GROUP BY 1")
def boundary_status_counts(t: Tables) -> DataFrame:
    h = sequence.boundary_status(t.conversations.where(F.col("role").isin("user", "system")), "conv_id", ["turn"])
    return h.where("role = 'user'").groupBy("boundary_status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c.conv_id, c.turn, max(u.turn) AS owner_turn FROM conversations c LEFT JOIN conversations u ON u.conv_id = c.conv_id AND u.role = 'user' AND u.turn <= c.turn WHERE c.role = 'assistant' GROUP BY 1, 2")
def mention_owner_asof(t: Tables) -> DataFrame:
    got = sequence.carry_forward(t.conversations, "conv_id", ["turn"], F.col("role") == "user", F.col("turn"), "owner_turn")
    return got.where("role = 'assistant'").select("conv_id", "turn", "owner_turn")


@query(f"WITH {_OWNED} SELECT conv_id, o AS owner, count(*) AS segment_count, sum(length(text))::BIGINT AS char_count, count(*) FILTER (role = 'assistant') AS statement_count FROM owned WHERE o >= 0 GROUP BY 1, 2")
def biography_rollup(t: Tables) -> DataFrame:
    got = _owned(t).where(F.col("owner").isNotNull()).groupBy("conv_id", "owner")
    return got.agg(F.count(F.lit(1)).alias("segment_count"), F.sum(F.length("text")).alias("char_count"), F.count_if(F.col("role") == "assistant").alias("statement_count"))


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' OR event_type = 'login' OR event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner FROM events")
def events_with_owner_asof(t: Tables) -> DataFrame:
    got = sequence.carry_forward(t.events, "user_id", ["ts", "event_id"], F.col("event_type").isin("signup", "login", "click"), F.col("event_id"))
    return got.select("event_id", "user_id", "owner")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def status_frequency(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {LINES}, halves AS (SELECT doc_id, 0 AS start_offset, length(text) // 2 AS end_offset FROM documents)
SELECT 'uncontained' AS "check", count(*) AS violations FROM passages p WHERE NOT EXISTS (SELECT 1 FROM halves h WHERE h.doc_id = p.doc_id AND h.start_offset <= p.start_offset AND h.end_offset >= p.end_offset)
UNION ALL SELECT 'overlapping', count(*) FROM passages p WHERE EXISTS (SELECT 1 FROM halves h WHERE h.doc_id = p.doc_id AND h.start_offset < p.end_offset AND h.end_offset > p.start_offset)
UNION ALL SELECT 'crossed', count(*) FROM passages p WHERE EXISTS (SELECT 1 FROM halves h WHERE h.doc_id = p.doc_id AND p.start_offset < h.end_offset AND h.end_offset < p.end_offset)""")
def containment_audit(t: Tables) -> DataFrame:
    p = corpus.passages(t.documents, "doc_id", "text").select("doc_id", "start_offset", "end_offset")
    half = t.documents.select("doc_id", F.lit(0).alias("start_offset"), F.floor(F.length("text") / 2).alias("end_offset"))
    checks = [audit.required(audit.uncontained(p, half, "doc_id"), "uncontained"), audit.required(audit.overlapping(p, half, "doc_id"), "overlapping"), audit.required(audit.crossed(p, half.withColumnRenamed("end_offset", "at"), "doc_id"), "crossed")]
    return checks[0].unionAll(checks[1]).unionAll(checks[2])


@query(f"WITH {LINES} SELECT count(*) AS passages, count(*) FILTER (p.passage <> substr(d.text, p.start_offset + 1, p.end_offset - p.start_offset)) AS mismatches FROM passages p JOIN documents d USING (doc_id)")
def offset_equality_audit(t: Tables) -> DataFrame:
    p = corpus.passages(t.documents, "doc_id", "text").join(t.documents.select("doc_id", "text"), "doc_id")
    bad = audit.quote_mismatches(p, "text", "start_offset", "end_offset", "passage")
    return p.agg(F.count(F.lit(1)).alias("passages")).join(bad.agg(F.count(F.lit(1)).alias("mismatches")))


@query("SELECT (SELECT count(*) FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')) AS with_returns, (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)) AS without_lines")
def semi_anti_suite(t: Tables) -> DataFrame:
    o, l = t.orders, t.lineitem
    on = F.col("o_orderkey") == F.col("l_orderkey")
    return o.join(l.where("l_returnflag = 'R'"), on, "left_semi").agg(F.count(F.lit(1)).alias("with_returns")).join(o.join(l, on, "left_anti").agg(F.count(F.lit(1)).alias("without_lines")))


@query("SELECT n_name AS nation, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def left_join_using_chain(t: Tables) -> DataFrame:
    got = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return got.groupBy(F.col("n_name").alias("nation")).agg(F.countDistinct("c_custkey").alias("customers"), F.count("o_orderkey").alias("orders"))


@query("SELECT d.doc_id, b.item_id, count(*) AS matches FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) d JOIN (SELECT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark) b USING (line) WHERE length(line) >= 20 GROUP BY 1, 2")
def multiset_quote_join(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", F.explode(F.split("text", "\n", -1)).alias("line")).where(F.length("line") >= 20)
    b = t.benchmark.select("item_id", F.explode(F.split("text", "\n", -1)).alias("line")).where(F.length("line") >= 20)
    return d.join(b, "line").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("matches"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, event_type FROM events WHERE event_type = 'click' AND value > 0.5")
def json_props(t: Tables) -> DataFrame:
    return t.events.where((F.col("event_type") == "click") & (F.col("value") > 0.5)).select("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type")


@query("SELECT source, doc_id, n_chars, rank FROM (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 12")
def topk_per_group(t: Tables) -> DataFrame:
    return sequence.top_per_group(t.documents.select("source", "doc_id", "n_chars"), "source", [F.desc("n_chars"), F.col("doc_id")], 12)


@query("SELECT doc_id, source FROM documents WHERE lower(source) LIKE '%rc1%' ORDER BY md5(concat(doc_id::VARCHAR, 'seed')) LIMIT 25")
def seeded_sample(t: Tables) -> DataFrame:
    """The reference's seeded sample (L10), with a contains filter on the folded group name."""
    return t.documents.select("doc_id", "source").where(F.lower("source").contains("rc1")).orderBy(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("seed")))).limit(25)


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CASE WHEN contains(html, 'PageText') THEN 'marked' ELSE 'fallback' END AS layout FROM pages")
def html_title_meta(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.when(F.contains("html", F.lit("PageText")), "marked").otherwise("fallback").alias("layout"))


@query("SELECT 'documents' AS t, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'conversations', count(*) FROM conversations UNION ALL SELECT 'labels', count(*) FROM labels")
def table_counts(t: Tables) -> DataFrame:
    one = [getattr(t, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("t"), "n") for n in ("documents", "pages", "conversations", "labels")]
    return one[0].unionAll(one[1]).unionAll(one[2]).unionAll(one[3])
