"""Years: bands, conflicts, triage, the smallest common decimal bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def year_groups(rows: DataFrame, name: str, year: str, label: str) -> DataFrame:
    """One group for each (name, year): the least label and the number of entries."""
    return rows.where(F.col(year).isNotNull()).groupBy(name, year).agg(F.min(label).alias("label"), F.count(F.lit(1)).alias("source_entries"))


def bins(years: DataFrame, width: int, year: str = "year", sums: tuple[str, ...] = ("groups", "source_entries")) -> DataFrame:
    """Bands of `width` years that begin at 1, width + 1, ...; bands without a year stay, with zeros (A10)."""
    start = (F.floor((F.col(year) - 1) / width) * width + 1).cast("long")
    got = years.groupBy(start.alias("start")).agg(*[F.sum(s).cast("long").alias(s) for s in sums])
    spine = got.agg(F.min("start").alias("a"), F.max("start").alias("b")).where("a IS NOT NULL").select(F.explode(F.sequence("a", "b", F.lit(width).cast("long"))).alias("start"))
    return spine.join(got, "start", "left").select("start", (F.col("start") + width - 1).alias("end"), *[F.coalesce(s, F.lit(0)).cast("long").alias(s) for s in sums])


def null_conflicts(rows: DataFrame, name: str, year: str, status: str, conflict: str = "ambiguous_name_or_conflicting_year") -> DataFrame:
    """Where a name has two years or more, every row of it loses its year and gets the status, undated rows too.

    Names are counted first and joined back: a hot name isn't gathered, only its few distinct years are.
    """
    bad = rows.where(F.col(year).isNotNull()).select(name, year).distinct().groupBy(name).count().where("count > 1").select(F.col(name).alias("__k"))
    joined = rows.join(bad, F.col(name) == F.col("__k"), "left")
    hit = F.col("__k").isNotNull()
    return joined.withColumn(status, F.when(hit, conflict).otherwise(F.col(status))).withColumn(year, F.when(~hit, F.col(year))).drop("__k")


def triage(rows: DataFrame, name: str, year: str) -> DataFrame:
    """dated_rows, distinct_years and a status: conflicting, matching, one or none."""
    got = rows.groupBy(name).agg(F.count(year).alias("dated_rows"), F.countDistinct(year).alias("distinct_years"))
    status = F.when(F.col("distinct_years") > 1, "conflicting_dates").when(F.col("dated_rows") > 1, "matching_dates").when(F.col("dated_rows") == 1, "one_dated").otherwise("none_dated")
    return got.withColumn("triage_status", status)


#: Bucket sizes that are tried in this order.
UNITS = (1, 10, 100, 1000)


def common_unit(low: Column, high: Column) -> Column:
    """The smallest unit whose bucket holds both ends, else null."""
    out = F.when(low.isNull(), F.lit(None).cast("int"))
    for u in UNITS:
        out = out.when(F.floor(low / u) == F.floor(high / u), u)
    return out


def decimal_bucket(rows: DataFrame, name: str, year: str) -> DataFrame:
    """years (sorted, distinct, joined by ,), bucket_size, bucket_start and bucket_end."""
    got = rows.groupBy(name).agg(F.array_sort(F.collect_set(year)).alias("ys"))
    got = got.withColumn("bucket_size", common_unit(F.array_min("ys"), F.array_max("ys")))
    start = (F.floor(F.array_min("ys") / F.col("bucket_size")) * F.col("bucket_size")).cast("int")
    return got.select(name, F.array_join(F.transform("ys", lambda y: y.cast("string")), ",").alias("years"), "bucket_size", start.alias("bucket_start"), (start + F.col("bucket_size") - 1).alias("bucket_end"))


def date_relation(left: Column, right: Column) -> Column:
    """conflicting, matching or incomplete for two years that may be null."""
    return F.when(left.isNull() | right.isNull(), "incomplete_dates").when(left == right, "matching_dates").otherwise("conflicting_dates")

