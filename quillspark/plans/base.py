"""Registry of catalogue queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspark.storage import table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """t.documents reads the table of that name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._dir, name)


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def keep(f: Callable[[Tables], DataFrame]):
            self.queries[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql:
                self.sql[f.__name__] = sql
            f.of = f  # the query of tables, for others to build on
            return f

        return keep
