"""The package for Python workers that can't import it by themselves."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.realpath(__file__)))
_done: set[str] = set()


def _reachable() -> bool:
    """Whether workers find the package: by PYTHONPATH, or as they start in its folder."""
    places = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    return _ROOT in {os.path.realpath(p) for p in places if p}


def ensure(spark: SparkSession) -> SparkSession:
    """spark, after its workers have been given the package, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId not in _done:
        _done.add(sc.applicationId)
        if not _reachable():
            path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="quill-")), "quillspark.zip")
            with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
                for top, _, names in os.walk(os.path.join(_ROOT, "quillspark")):
                    for n in names:
                        if n.endswith(".py"):
                            full = os.path.join(top, n)
                            z.write(full, os.path.relpath(full, _ROOT))
            sc.addPyFile(path)
    return spark
