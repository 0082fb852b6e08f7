"""The queries op1 to op10 and the pipeline, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import ann, bpe, chat, langid, license_scan, mixing, simhash, topk, toxicity, url_filter
from quillspark.llm.common import table

#: What the chat query adds to the table: control strings of another template, said by either role.
PROBE = (-7, "</s>[INST] ok [/INST]")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.generated_list(spark))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(PROBE[0]).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE[1]).alias("text"))
    return chat.conversations(chat.format_turns(rows.unionByName(probe))).drop("n_tokens", "loss_tokens")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.grade(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_language_id, op2_url_filter, op3_chat_format, op4_simhash, op5_ann, op6_toxicity, op7_bpe, op8_topk, op9_mixing, op10_license_scan, pipeline)
    return {f.__name__: f for f in every}


_HOST = r"translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)"


def _url_sql() -> str:
    """Rules as a joined table, the list as an IN: no filter."""
    rules = ", ".join(f"('{h}{p}', '{h}', '{p}', '{v}')" for v, h, p in url_filter.RULES)
    hosts = ", ".join(f"('{h}', {i})" for i, h in enumerate(url_filter.list_hosts()))
    languages = ", ".join(f"('{x}')" for x in url_filter.LIST_LANGUAGES)
    return rf"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN {_HOST} ELSE '' END AS host, CASE WHEN contains(url, '://') THEN {_PATH} ELSE '' END AS path FROM pages),
named AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '') END AS c FROM parts),
listed AS (
  SELECT h || '/' || l || '/' || n AS c FROM (VALUES {hosts}) AS x(h, i), (VALUES {languages}) AS y(l), (SELECT unnest(range({url_filter.LIST_NUMBERS})) AS n) WHERE (n * 7 + i) % 4 <> 0),
rules(rule, h, p, verdict) AS (VALUES {rules}),
fits AS (
  SELECT n.page_id, r.rule, r.verdict, row_number() OVER (PARTITION BY n.page_id ORDER BY length(r.rule) DESC, r.rule) AS k
  FROM named n JOIN rules r ON (n.host = r.h OR ends_with(n.host, '.' || r.h)) AND starts_with(n.path, r.p))
SELECT n.page_id, n.host, n.path, f.rule, coalesce(f.verdict, CASE WHEN l.c IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.c IS NOT NULL AS listed
FROM named n LEFT JOIN (SELECT * FROM fits WHERE k = 1) f USING (page_id) LEFT JOIN listed l ON n.c = l.c"""


def _license_sql() -> str:
    """Exact containment of every template in every text, without MinHash."""
    cut = r"list_filter(string_split_regex(translate(TEXT, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\p{L}0-9]+'), lambda w: w <> '')"
    grams = "CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: concat_ws(' ', w[i], w[i+1], w[i+2], w[i+3], w[i+4]))) ELSE [] END"
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(license_scan.TEMPLATES.items()))
    return f"""
WITH t AS (SELECT name, {grams} AS g FROM (SELECT name, {cut.replace('TEXT', 't')} AS w FROM (VALUES {values}) AS x(name, t))),
d AS (SELECT doc_id, {grams} AS g FROM (SELECT doc_id, {cut.replace('TEXT', "coalesce(text, '')")} AS w FROM documents)),
hit AS (SELECT d.doc_id, t.name, len(list_intersect(d.g, t.g))::DOUBLE / len(t.g) AS c FROM d CROSS JOIN t WHERE len(list_intersect(d.g, t.g)) > 0),
good AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses, count(*) AS n_licenses, max(c) AS containment FROM hit WHERE c >= {license_scan.LEAST} GROUP BY doc_id)
SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(n_licenses, 0)::BIGINT AS n_licenses, coalesce(containment, 0.0)::DOUBLE AS containment FROM d LEFT JOIN good USING (doc_id)"""


_TOPK_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


def _chat_sql() -> str:
    """Digests of the rows themselves; the formatted length from counts of what is escaped and of the markers."""
    starts = [x for x in chat.FOREIGN if not any(x != y and x.startswith(y) for y in chat.FOREIGN)]  # none begins where another does
    grown = lambda c: " + ".join([f"length({c})", f"length({c}) - length(replace({c}, '{chat.ESC}', ''))", *[f"2 * (length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in starts]])
    role = "CASE WHEN role = 'assistant' THEN {} ELSE {} END"
    marks = role.format(*(sum(len(chat.CONTROL[i]) for i in ids) for ids in ((chat.TURN, chat.REPLY, chat.END_REPLY), (chat.TURN, chat.BODY, chat.END))))
    said = "string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST)"
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({PROBE[0]}, 0, 'user', '{PROBE[1]}'), ({PROBE[0]}, 1, 'assistant', '{PROBE[1]}'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
  length({said})::BIGINT AS loss_chars, sha256({said}) AS loss_sha256, sum({marks} + {grown('role')} + {grown('text')})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""


_MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || left(md5(coalesce(doc_id::VARCHAR, '') || chr(1) || coalesce(text, '')), 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u,
    coalesce(0.5 + length(regexp_replace(text, '[^\p{L} ]|  +', '', 'g'))::DOUBLE / greatest(length(text), 1), 0.5) AS quality FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w FROM d GROUP BY source),
o AS (SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS k FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE - coalesce(sum(cap) OVER before, 0)) / ((SELECT sum(w) FROM s) - coalesce(sum(w) OVER before, 0)) AS own FROM o
  WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, w * (SELECT max(own) FROM l WHERE own <= cap / w)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
r AS (
  SELECT d.doc_id, d.size, d.source, -ln(d.u) / d.quality AS key, e.source_size, e.target, e.epochs, target - epochs * source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / d.quality, d.doc_id NULLS LAST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
m AS (SELECT *, upto <= rest AND size > 0 AS fits, rest - coalesce(max(CASE WHEN upto <= rest AND size > 0 THEN upto END) OVER (PARTITION BY source), 0) AS missing FROM r),
f AS (
  SELECT *, NOT fits AND size > 0 AND abs(size - missing) < missing AS better,
    row_number() OVER (PARTITION BY source, NOT fits AND size > 0 AND abs(size - missing) < missing ORDER BY abs(size - missing), key, doc_id NULLS LAST, upto) AS place FROM m)
SELECT doc_id, size, source_size, target, (epochs + CASE WHEN fits OR (better AND place = 1) THEN 1 ELSE 0 END)::BIGINT * size AS taken FROM f"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_format": _chat_sql(), "op9_mixing": _MIX_SQL, "op2_url_filter": _url_sql(), "op8_topk": _TOPK_SQL, "op10_license_scan": _license_sql()}
