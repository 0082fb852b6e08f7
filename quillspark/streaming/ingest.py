"""Incremental ingest and review state as streams (2.14): idempotent, failures kept, latest decision wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillspark.operators.sequence import insert_or_ignore, latest


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ingest_new(source: DataFrame, key: str, out: str, failed: str, checkpoint: str, error: str = "error") -> StreamingQuery:
    """Appends rows with keys not stored yet to `out`; rows with an error go to `failed`, by batch, and may come again.

    A batch that is tried again adds nothing: its keys are stored, and its failures replace what it wrote.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        good = batch.where(F.col(error).isNull()).dropDuplicates([key])
        if _exists(spark, out):
            good = good.join(spark.read.parquet(out).select(key), key, "left_anti")
        good.write.mode("append").parquet(out)
        batch.where(F.col(error).isNotNull()).write.mode("overwrite").parquet(f"{failed}/batch={number}")

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_state(source: DataFrame, keys: list[str], order: str, history: str, checkpoint: str) -> StreamingQuery:
    """Adds every decision to `history`, by batch; current_state() of it is what holds. A batch that is tried again replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{history}/batch={number}")

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_state(spark: SparkSession, history: str, keys: list[str], order: str) -> DataFrame:
    rows = spark.read.parquet(history)
    rest = [F.desc(c) for c in rows.columns if c not in (*keys, order, "batch")]
    return latest(rows, keys, [F.desc(order), F.desc("batch"), *rest])


def regroup_dates(source: DataFrame, claims: str, out: str, name: str, year: str, checkpoint: str) -> StreamingQuery:
    """Late corrections: claims (name, year) of a batch are stored, and the years of the names in it, and only of these, are
    grouped again (2.14, E5). `out` has a folder a batch; current_groups() reads the latest group of each name."""
    from quillspark.operators.chronology import decimal_bucket

    def each(batch: DataFrame, number: int) -> None:
        batch.select(name, year).write.mode("overwrite").parquet(f"{claims}/batch={number}")
        all_ = batch.sparkSession.read.parquet(claims).join(batch.select(name).distinct(), name, "left_semi")
        decimal_bucket(all_, name, year).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_groups(spark: SparkSession, out: str, name: str) -> DataFrame:
    rows = spark.read.parquet(out)
    return latest(rows, [name], [F.desc("batch")]).drop("batch")


def counts_by_window(events: DataFrame, ts: str, kind: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events by window and kind, with a watermark for late rows; works on streams and tables."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), kind, "n")


__all__ = ["counts_by_window", "current_groups", "current_state", "ingest_new", "insert_or_ignore", "latest_state", "regroup_dates"]
