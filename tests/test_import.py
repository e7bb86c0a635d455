"""The driver imports ``__spark_entry__`` in its own process: from another
folder, with pyspark taken from its zip and no session running."""

import os
import subprocess
import sys

import pyspark

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code: str, tmp_path, extra_path: str = "") -> str:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    if extra_path:
        env["PYTHONPATH"] = extra_path
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=300)
    assert out.returncode == 0, out.stderr[-3000:]
    return out.stdout


def test_import_needs_no_jvm_and_no_session(tmp_path):
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = [os.path.join(lib, n) for n in sorted(os.listdir(lib)) if n.endswith(".zip")] if os.path.isdir(lib) else []
    code = f"import sys; sys.path.insert(0, {REPO!r}); import __spark_entry__ as e; " \
           "print(len(e.queries()), len(e.oracle_sql()))"
    n_queries, n_sql = map(int, _run(code, tmp_path, os.pathsep.join(zips)).split())
    assert n_queries >= 60 and n_sql >= 40


def test_workers_import_the_package_from_any_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as e
print("rows", e.queries()["svd_variance"](spark, "/root/testdata/sf0.001").count())
"""
    assert "rows" in _run(code, tmp_path)
