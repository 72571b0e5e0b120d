"""The entry module imports without a session, also when PySpark comes from its zip."""

import os
import subprocess
import sys

import pyspark

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = (
    "import __spark_entry__ as e, pyspark; from pyspark import SparkContext; q, o = e.queries(), e.oracle_sql(); "
    "assert SparkContext._active_spark_context is None; assert set(o) <= set(q) and len(q) >= 77; "
    "print(pyspark.__file__, len(q))"
)


def test_entry_imports_from_zipped_pyspark_without_a_session():
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = sorted(os.path.join(lib, f) for f in os.listdir(lib) if f.endswith(".zip")) if os.path.isdir(lib) else []
    env = os.environ | {"PYTHONPATH": os.pathsep.join([*zips, ROOT])}
    p = subprocess.run([sys.executable, "-c", CODE], capture_output=True, text=True, env=env, cwd="/", timeout=300)
    assert p.returncode == 0, p.stderr[-2000:]
    if zips:
        assert "pyspark.zip" in p.stdout
