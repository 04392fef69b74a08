import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {r[0] for r in df.select("part").distinct().collect()} == {"history", "removed"}


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_python_tasks_run_outside_the_repo_directory(tmp_path):
    """Executors must not need the package on their path (functions are
    shipped by value): run a pandas-UDF query and the sequencer from /tmp."""
    import subprocess
    import sys
    from pathlib import Path

    entry = Path(__file__).resolve().parents[1] / "__spark_entry__.py"
    script = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {str(entry)!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
q = E.queries()
assert q["nearest_centroid"](spark, "/root/testdata/sf0.001").count() > 0
assert q["next_item_transition_topk"](spark, "/root/testdata/sf0.001").count() > 0
print("ok")
"""
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().endswith("ok")
