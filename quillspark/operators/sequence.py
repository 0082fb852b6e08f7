"""What depends on order: carrying a heading forward, boundaries, neighbours, latest decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def carry_forward(rows: DataFrame, by: str, order: list[str], heading: Column, owner: Column, name: str = "owner") -> DataFrame:
    """The owner that the latest heading at or before a row sets; a heading without an owner resets it."""
    marked = F.when(heading, F.struct(owner.alias("o")))
    upto = W.partitionBy(by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(marked, ignorenulls=True).over(upto)["o"])


def spans_to_next(rows: DataFrame, by: str, start: str, length: Column) -> DataFrame:
    """end_offset: the next start on the page, else the page's length."""
    return rows.withColumn("end_offset", F.coalesce(F.lead(start).over(W.partitionBy(by).orderBy(start)), length))


def boundary_status(headings: DataFrame, by: str, order: list[str]) -> DataFrame:
    """next_recorded_heading, or source_file_end_unresolved for a source's last heading."""
    later = F.lead(F.lit(True)).over(W.partitionBy(by).orderBy(*order))
    return headings.withColumn("boundary_status", F.when(later, "next_recorded_heading").otherwise("source_file_end_unresolved"))


def neighbours(rows: DataFrame, by: str, order: list[str], key: str) -> DataFrame:
    """previous_id and next_id in the order of a book."""
    w = W.partitionBy(by).orderBy(*order)
    return rows.withColumn("previous_id", F.lag(key).over(w)).withColumn("next_id", F.lead(key).over(w))


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order: the state after an append-only history."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def top_per_group(rows: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group, with their rank."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new replace those of old with the same keys; the others stay (K2, K3)."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_or_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old, and the rows of new whose keys it lacks, one for each (K1, S3)."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))
