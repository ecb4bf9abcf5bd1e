import glob
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_a_session_from_zipped_pyspark():
    """The entry point imports, and lists queries and SQL, with PySpark on the
    path as its zip (as spark-submit puts it) and no session running."""
    import pyspark
    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    zips = glob.glob(os.path.join(lib, "*.zip"))
    assert zips
    code = ("import pyspark; assert '.zip' in pyspark.__file__, pyspark.__file__; import __spark_entry__ as e;"
            "from pyspark import SparkContext; q = e.queries(); o = e.oracle_sql();"
            "assert SparkContext._active_spark_context is None; assert set(o) <= set(q) and len(q) >= 50")
    env = dict(os.environ, PYTHONPATH=os.pathsep.join(zips + [ROOT]))
    subprocess.run([sys.executable, "-c", code], check=True, env=env, cwd=ROOT, timeout=120)
