"""Page texts, passages, duplicates and citations: storage is shared, occurrences are all kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.native import running

#: Shortest passage, after stripping.
PASSAGE = 80


def content_id(*parts: Column) -> Column:
    """Content-addressed id: sha-256 over the parts with a zero character between them."""
    return F.sha2(F.concat_ws("\u0000", *parts), 256)


def page_texts(pages: DataFrame, key: str, text: str) -> DataFrame:
    """sha256, char_count, occurrences and the first occurrence of each distinct text."""
    return pages.groupBy(F.sha2(text, 256).alias("sha256")).agg(F.min(F.length(text)).cast("long").alias("char_count"), F.count(F.lit(1)).alias("occurrences"), F.min(key).alias("first_id"))


def duplicate_groups(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Groups of more than one row under the keys, with their size (A3, A4)."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def passages(pages: DataFrame, key: str, text: str, least: int = PASSAGE) -> DataFrame:
    """key, start_offset, end_offset, sha256, passage of every line that is `least` characters or longer.

    Offsets are code points, the end exclusive. A page is cut where it lies, and nothing is shuffled: where lines end is a
    running sum over the array of its lines, in chunks, so that a page of a million lines ends, too.
    """
    lines = pages.select(key, F.split(F.col(text), "\n", -1).alias("__l"))
    rows = lines.withColumn("__e", running(F.transform("__l", lambda x: (F.length(x) + 1).cast("long"))))
    found = rows.select(key, F.explode(F.arrays_zip("__l", "__e")).alias("x")).select(key, F.col("x.__l").alias("passage"), (F.col("x.__e") - 1).alias("end_offset"))
    found = found.where(F.length("passage") >= least)  # cheap, before the exact test
    kept = found.where(F.length(F.regexp_replace("passage", r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")) >= least)
    return kept.select(key, (F.col("end_offset") - F.length("passage")).alias("start_offset"), "end_offset", F.sha2("passage", 256).alias("sha256"), "passage")


def storage_reuse(rows: DataFrame, key: Column, size: Column) -> DataFrame:
    """One row: occurrences, distinct, reused, and bytes (A2, A5)."""
    return rows.agg(F.count(F.lit(1)).alias("occurrences"), F.countDistinct(key).alias("distinct_texts"), (F.count(F.lit(1)) - F.countDistinct(key)).alias("reused"), F.sum(size).cast("long").alias("bytes"))


def page(rows: DataFrame, order: list[Column], limit: int, offset: int = 0, most: int = 100) -> DataFrame:
    """One page in a given order, limit clamped to 1..most, with has_more on each row."""
    limit, offset = max(1, min(most, limit)), max(0, offset)
    got = rows.orderBy(*order).offset(offset).limit(limit + 1)
    numbered = got.withColumn("position", F.row_number().over(W.orderBy(*order)).cast("long"))  # limit + 1 rows at most
    more = F.max("position").over(W.partitionBy(F.lit(1))) > limit
    return numbered.withColumn("has_more", more).where(F.col("position") <= limit)
