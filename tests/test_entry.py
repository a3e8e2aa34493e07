"""The driver contract imports without a JVM, also with PySpark from its zip."""

import glob
import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _import(extra: list[str]) -> str:
    code = (
        "import pyspark, __spark_entry__ as e; from pyspark import SparkContext; "
        "q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q), set(o) - set(q); "
        "assert SparkContext._active_spark_context is None; print(pyspark.__file__, len(q), len(o))"
    )
    env = os.environ | {"PYTHONPATH": os.pathsep.join([*extra, ROOT])}
    return subprocess.run(
        [sys.executable, "-c", code], env=env, cwd=ROOT, check=True, capture_output=True, text=True
    ).stdout


def test_imports_without_a_session():
    assert int(_import([]).split()[-2]) >= 58


def test_imports_with_pyspark_from_its_zip():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = [os.path.join(lib, "pyspark.zip"), *glob.glob(os.path.join(lib, "py4j-*.zip"))]
    out = _import(zips)
    assert "pyspark.zip" in out
