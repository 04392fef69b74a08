"""Session helpers.

Library functions never create a session themselves; they take DataFrames.
``build_session`` is for tests, tools and the benchmark.  Shared scratch space
(for file round trips and lineage cuts) always lives under the cluster's
``spark.checkpoint.dir``; a private directory is only created when that setting
is missing and the master is ``local``, as in tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "basketry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.

    The cluster's ``spark.checkpoint.dir`` is used as it is.  Only a session
    whose master is ``local`` may go without that setting: it then gets a
    private directory.  Anywhere else executors have disks of their own, so a
    missing setting is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="basketry-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/basketry-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


# While a scratch table is written.  Its shuffle files go as soon as it is written:
# nothing reads them again, and else they stay until the driver happens to collect
# its garbage.  Texts come to Python in batches of bounded size.
WRITE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
              "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    """The session with some settings, and afterwards as it was."""
    last = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in last.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def cut_lineage(df: DataFrame, name: str = "stage", codec: str | None = None) -> DataFrame:
    """Materialise ``df`` as a parquet table under the shared checkpoint
    directory and continue from that table.  Later stages (and iterative
    fits) read the written files, so a lost executor costs a re-read rather
    than a replay of the whole lineage; parquet keeps the data columnar and
    compressed (by ``codec``, where given), with statistics for filter pushdown."""
    path = scratch_path(df.sparkSession, name)
    with _settings(df.sparkSession, WRITE_CONF):
        df.write.mode("overwrite").parquet(path, compression=codec)
    table = df.sparkSession.read.parquet(path)
    table._scratch = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a ``cut_lineage`` table nothing reads any more."""
    path = getattr(table, "_scratch", None)
    if path:
        _delete(table.sparkSession, path)


def release_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of the session's checkpoint directory.  The
    results of catalogue queries are lazy and read such tables, so the caller
    releases them, once a result is written or collected."""
    _delete(spark, _scratch_root(spark))


def layout_partitions(rows: int, rows_per_partition: int = 100_000, at_least: int = 8) -> int:
    """Partitions for a seeded fit, from the number of rows alone: the same on
    any number of cores."""
    return max(at_least, -(-rows // rows_per_partition))


def fixed_layout(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Hash-partition on ``key`` into exactly ``partitions`` partitions, sorted
    by it: seeded algorithms that draw per partition then see the same rows in
    the same order."""
    return df.repartition(partitions, key).sortWithinPartitions(key)


def spread(df: DataFrame, key: str, partitions: int | None) -> DataFrame:
    """Hash-partition ``df`` on ``key`` into ``partitions`` (a small file with
    few row groups ahead of CPU-heavy work); None leaves the scan's splits as
    they are, without a shuffle, which is right for large inputs."""
    return df if partitions is None else df.repartition(partitions, key)


def recommended_conf(input_bytes: int, cores: int, shuffle_partition_bytes: int = 256 << 20,
                     split_bytes: int = 128 << 20, max_partitions: int | None = None) -> dict[str, str]:
    """Session settings sized from the input volume: enough shuffle partitions
    that each holds about ``shuffle_partition_bytes`` (at least two per core),
    AQE to coalesce small ones and split skewed join partitions, and scan
    splits of ``split_bytes``.  100 TB gives about 400,000 partitions; a caller
    whose driver cannot track as many sets ``max_partitions`` and gets larger
    ones.  ``collect_list`` keeps hashing over many groups before it sorts."""
    parts = max(2 * cores, -(-input_bytes // shuffle_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts if max_partitions is None else min(parts, max_partitions)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
        # a small input has few files and row groups: spread CPU-heavy work on it
        **({"spark.basketry.scanPartitions": str(2 * cores)} if input_bytes < cores * split_bytes else {}),
    }
