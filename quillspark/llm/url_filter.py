"""URL filters, native: rules by host and path, and a list of canonical URLs behind a blocked Bloom filter.

The list is hashed into blocks of 64 bits, K bits of one block to each URL. A probe reads one block; URLs of which all
bits are set are possible hits, and an equi-join with the list removes the false positives among them. The filter's
size follows the list (BITS_PER_URL). Up to BROADCAST_BLOCKS blocks of 12 bytes it is broadcast, and up to BROADCAST_BYTES
of URLs the list is, too, so that the pages are read once and not shuffled; larger ones are joined with a shuffle, the list
with the possible hits only.

A url that is null or has no `://` has an empty host and path, fits no rule and isn't listed. Equal URLs on the list count
once, null ones not at all. Urls of any length go. listed_urls() passes extra columns through, whatever their names; judge()
returns its own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_URL, K, BROADCAST_BLOCKS, BROADCAST_BYTES = 16, 4, 1 << 20, 1 << 24
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    after = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    after = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One spelling of a page: no www. or m., no index page, no .html, no closing slash, no query."""
    p = F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html?$", ""), r"/+$", "")
    return F.when(host != "", F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), p))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct(rule, verdict) of the longest rule (verdict, host, path) that fits, else null.

    A rule fits its host and all subdomains where the path starts with the rule's. Rules are few: they are part of the
    expression. Of equally long ones that fit, the smaller by code point wins.
    """
    out: Column | None = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        got = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, got) if out is None else out.when(fits, got)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def block_of(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bits_of(url: Column) -> Column:
    """K of 64 bits, by six bits of a second hash each."""
    h, out = F.xxhash64(F.lit(7), url), None
    for i in range(K):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def bloom(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """block, mask of the list's URLs."""
    return listed.select(block_of(F.col(url), blocks).alias("block"), bits_of(F.col(url)).alias("bits")).groupBy("block").agg(F.bit_or("bits").alias("mask"))


def listed_urls(pages: DataFrame, listed: DataFrame, url: str = "canonical") -> DataFrame:
    """pages with a boolean `listed` (in place of a column of that name): whether `url` is on the list's column `canonical`."""
    names = listed.where(F.col("canonical").isNotNull()).select(F.col("canonical").alias("__u")).distinct()
    n, size = names.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("__u")), F.lit(0))).first()
    blocks = max(1, n * BITS_PER_URL // 64)
    masks = bloom(names, "__u", blocks).select(F.col("block").alias("__block"), F.col("mask").alias("__mask"))
    if blocks <= BROADCAST_BLOCKS:
        masks = F.broadcast(masks)
    columns = [c for c in pages.columns if c != "listed"]
    probed = pages.select(*columns, F.col(url).alias("__c"), block_of(F.col(url), blocks).alias("__b"), bits_of(F.col(url)).alias("__m"))
    maybe = F.coalesce(F.col("__mask").bitwiseAND(F.col("__m")) == F.col("__m"), F.lit(False)) & F.col("__c").isNotNull()
    probed = probed.join(masks, F.col("__b") == F.col("__block"), "left").select(*columns, F.when(maybe, F.col("__c")).alias("__key"))
    on = F.col("__key") == F.col("__u")
    if size <= BROADCAST_BYTES:
        return probed.join(F.broadcast(names), on, "left").select(*columns, F.col("__u").isNotNull().alias("listed"))
    # Rows that the filter rules out have no key and stay where they are.
    sure = probed.where(F.col("__key").isNull()).select(*columns, F.lit(False).alias("listed"))
    return probed.where(F.col("__key").isNotNull()).join(names, on, "left").select(*columns, F.col("__u").isNotNull().alias("listed")).unionByName(sure)


#: The contract's rules: verdict, host, path.
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed: the longest rule's verdict, else block for listed URLs and allow for others."""
    u = F.col("url")
    rows = pages.select("page_id", host_of(u).alias("host"), path_of(u).alias("path"))
    rows = rows.withColumn("canonical", canonical(F.col("host"), F.col("path"))).withColumn("__r", rule_of(F.col("host"), F.col("path"), rules))
    rows = listed_urls(rows, listed)
    return rows.select("page_id", "host", "path", F.col("__r.rule").alias("rule"), F.coalesce("__r.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """canonical: the list in a text file, an URL a line; blank lines and those that begin with # are skipped."""
    u = F.trim("value")
    lines = spark.read.text(path).select(u.alias("u")).where((F.col("u") != "") & ~F.col("u").startswith("#"))
    whole = F.when(F.col("u").contains("://"), F.col("u")).otherwise(F.concat(F.lit("http://"), F.col("u")))
    return lines.select(canonical(host_of(whole), path_of(whole)).alias("canonical"))


#: A list by rule, to go with tables that have none: hosts, languages, and of the numbers from 0 those that the rule takes.
LIST_NAMES, LIST_ENDS, LIST_LANGUAGES, LIST_NUMBERS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"), ("com", "net", "org"), ("de", "en", "es", "fr"), 1000


def list_hosts() -> list[str]:
    return [f"{name}.example.{end}" for name in LIST_NAMES for end in LIST_ENDS]


def generated_list(spark: SparkSession) -> DataFrame:
    """canonical: three of four numbers under each host and language. It is made of the rule alone, never of the pages."""
    hosts = F.array(*map(F.lit, list_hosts()))
    every = spark.range(LIST_NUMBERS).select("id", F.posexplode(hosts).alias("i", "host")).withColumn("lang", F.explode(F.array(*map(F.lit, LIST_LANGUAGES))))
    return every.where((F.col("id") * 7 + F.col("i")) % 4 != 0).select(F.concat_ws("/", "host", "lang", F.col("id").cast("string")).alias("canonical"))
