"""Checks that must find nothing, and counts that must agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote_mismatches(quotes: DataFrame, text: str, start: str, end: str, quote: str) -> DataFrame:
    """Rows whose quote isn't what stands at its offsets."""
    return quotes.where(~F.col(quote).eqNullSafe(F.col(text).substr(F.col(start) + 1, F.col(end) - F.col(start))))


def uncontained(inner: DataFrame, outer: DataFrame, on: str) -> DataFrame:
    """Intervals that no interval of the same page contains."""
    i, o = inner.alias("i"), outer.alias("o")
    return i.join(o, (F.col(f"i.{on}") == F.col(f"o.{on}")) & (F.col("o.start_offset") <= F.col("i.start_offset")) & (F.col("o.end_offset") >= F.col("i.end_offset")), "left_anti")


def overlapping(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Intervals that share a character with one of the same page."""
    l, r = left.alias("l"), right.alias("r")
    return l.join(r, (F.col(f"l.{on}") == F.col(f"r.{on}")) & (F.col("r.start_offset") < F.col("l.end_offset")) & (F.col("r.end_offset") > F.col("l.start_offset")), "left_semi")


def crossed(intervals: DataFrame, points: DataFrame, on: str, at: str = "at") -> DataFrame:
    """Intervals with a point of the same page strictly inside."""
    i, p = intervals.alias("i"), points.alias("p")
    return i.join(p, (F.col(f"i.{on}") == F.col(f"p.{on}")) & (F.col("i.start_offset") < F.col(f"p.{at}")) & (F.col(f"p.{at}") < F.col("i.end_offset")), "left_semi")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with the side."""
    cols = a.columns
    return a.exceptAll(b).select(*cols, F.lit("left").alias("side")).unionByName(b.select(*cols).exceptAll(a).select(*cols, F.lit("right").alias("side")))


def count_mismatches(groups: DataFrame, members: DataFrame, key: str, count: str) -> DataFrame:
    """Groups whose stored count isn't the number of their members, and members without a group."""
    got = members.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return groups.select(key, count).join(got, key, "full_outer").where(~F.coalesce(F.col(count), F.lit(0)).eqNullSafe(F.coalesce(F.col("__n"), F.lit(0)))).select(key, count, F.col("__n").alias("members"))


def required(rows: DataFrame, what: str) -> DataFrame:
    """One row: the check's name and how many rows break it."""
    return rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(what).alias("check"), "violations")


def refuse(df: DataFrame, bad: Column, message: str) -> DataFrame:
    """df, failing at run time on the first row that breaks a constraint."""
    return df.where(F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(True))
