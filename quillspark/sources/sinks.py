"""Ways to store and report results."""

from __future__ import annotations

import html
import json

from pyspark.sql import DataFrame, SparkSession

from quillspark.operators.sequence import insert_or_ignore, upsert
from quillspark.storage import materialize


def write_once(df: DataFrame, path: str) -> None:
    """Stores a stage's output; an existing one is never overwritten (K6)."""
    df.write.mode("errorifexists").parquet(path)


def append_history(df: DataFrame, path: str) -> None:
    """Adds rows to an append-only log (K4)."""
    df.write.mode("append").parquet(path)


def rebuild(df: DataFrame, path: str) -> None:
    """Replaces a derived table (K13). It is written elsewhere first, as it may be made from what it replaces."""
    materialize(df).write.mode("overwrite").parquet(path)


def add_missing(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> None:
    """Rows whose keys the table lacks (K1)."""
    rebuild(insert_or_ignore(spark.read.parquet(path), df, keys), path)


def merge(spark: SparkSession, df: DataFrame, path: str, keys: list[str]) -> None:
    """Rows replace those with the same keys (K2, K3)."""
    rebuild(upsert(spark.read.parquet(path), df, keys), path)


def bucketed(df: DataFrame, table: str, keys: list[str], buckets: int = 64) -> None:
    """A table that later joins and aggregations on the keys read without a shuffle (K5)."""
    df.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").saveAsTable(table)


def csv_report(df: DataFrame, order: list, most: int = 100_000) -> bytes:
    """A report of at most `most` rows in a fixed order, with a byte order mark for spreadsheets (K8)."""
    import csv
    import io

    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("a report has too many rows; write the table instead")
    out = io.StringIO()
    w = csv.writer(out)
    w.writerow(df.columns)
    w.writerows([["" if v is None else v for v in r] for r in rows])
    return out.getvalue().encode("utf-8-sig")


def json_report(df: DataFrame, order: list, most: int = 100_000) -> str:
    """The same rows as JSON (K7)."""
    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("a report has too many rows; write the table instead")
    return json.dumps([r.asDict(recursive=True) for r in rows], ensure_ascii=False, indent=2, default=str)


def html_report(title: str, df: DataFrame, order: list, most: int = 10_000) -> str:
    """A page with one table; all values are escaped (K9)."""
    cells = lambda tag, values: "".join(f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>" for v in values)
    rows = df.orderBy(*order).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("a report has too many rows; write the table instead")
    body = "".join(f"<tr>{cells('td', r)}</tr>" for r in rows)
    return f'<!doctype html><html dir="auto"><meta charset="utf-8"><title>{html.escape(title)}</title><table><thead><tr>{cells("th", df.columns)}</tr></thead><tbody>{body}</tbody></table></html>'
