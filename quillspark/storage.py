"""Tables between stages, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes that a task holds back before it writes them.
_ROW_GROUP = 1 << 24

_written: list[tuple[SparkSession, str]] = []
#: Tables by the identity of their DataFrame, which is kept so that the number isn't used again.
_paths: dict[int, tuple[DataFrame, str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Without one, a local master gets a temporary folder, as in tests, and a
    cluster is refused: each of its executors would write to a disk of its own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        app, master = spark.sparkContext.applicationId, spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="quill-")
        where = _own[app]
    return where.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/quill-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", _ROW_GROUP).parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    _paths[id(out)] = (out, path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone at exit
        return


def release(df: DataFrame) -> None:
    """Deletes a table of materialize() that no later result reads."""
    found = _paths.pop(id(df), None)
    if found is None:
        raise ValueError("not a table of materialize()")
    _written.remove((df.sparkSession, found[1]))
    _delete(df.sparkSession, found[1])


@contextmanager
def scope() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """On leaving, deletes the tables that were written inside, but those that were given to keep()."""
    before, kept = {p for _, p in _written}, set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(_paths[id(df)][1])
        return df

    yield keep
    for spark, path in [x for x in _written if x[1] not in before | kept]:
        _written.remove((spark, path))
        _delete(spark, path)
    for key in [k for k, (_, p) in _paths.items() if p not in before | kept]:
        del _paths[key]


def forget() -> None:
    """Deletes what materialize() wrote in this process."""
    _paths.clear()
    while _written:
        _delete(*_written.pop())


atexit.register(forget)
