"""The driver's contract, with and without the folder of training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_names_match_between_queries_and_sql():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 70


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables here")
def test_entry(spark):
    import __spark_entry__ as e

    got = e.entry(spark)
    assert got.columns == ["sha256", "occurrences", "pages", "first_id"] and got.count() > 0


def test_the_rest_imports_without_the_folder(tmp_path):
    shutil.copytree(os.path.join(ROOT, "quillspark"), tmp_path / "quillspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'duplicate_passages' in q and 'pipeline' not in q and not any(n.startswith('op1') for n in q); e.oracle_sql()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_the_folder():
    for top, _, files in os.walk(os.path.join(ROOT, "quillspark")):
        if os.sep + "llm" not in top:
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(top, f), encoding="utf-8") as h:
                        assert "quillspark.llm" not in h.read(), f
