"""The driver contract imports without Spark's jars, files or a JVM."""
import os
import subprocess
import sys

from pyspark.ml.feature import StopWordsRemover

from basketry.plans.oracles import SPARK_ENGLISH_STOPWORDS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_stopwords_are_those_of_spark(spark):
    assert list(SPARK_ENGLISH_STOPWORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_entry_imports_without_jars_or_java():
    code = ("import glob; glob.glob = lambda *a, **k: []\n"
            "import __spark_entry__ as e\n"
            "assert len(e.queries()) >= 63 and len(e.oracle_sql()) >= 48\n"
            "from pyspark import SparkContext\n"
            "assert SparkContext._gateway is None")
    env = {k: v for k, v in os.environ.items() if k not in ("JAVA_HOME", "SPARK_HOME")}
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env | {"PATH": "/nonexistent"}, check=True)
