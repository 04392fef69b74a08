"""Versioned sinks: a write becomes visible as a whole or not at all.

A sink is a folder.  Data go to ``data/<unique name>`` first; when the write has
succeeded, a small file ``versions/<number>`` that names this folder is created.
Creating it without overwriting is the commit: it happens once, and of two writers
one gets the number and the other the next.  A write that fails leaves its folder
without a version; its data are deleted and every earlier version reads as before.

Only Spark's writers and Hadoop's file system are used, so a sink may lie on any
storage that Spark reads.  Tables, fitted models and run parameters share it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

WIDTH = 12                      # digits of a version's file name


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, sink: str) -> list[int]:
    """The committed versions, ascending; none for a new sink."""
    fs, place = _hadoop(spark, f"{sink}/versions")
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted(int(n) for n in names if n.isdigit())


def _record(spark: SparkSession, sink: str, number: int) -> dict:
    path = f"{sink}/versions/{number:0{WIDTH}d}"
    return json.loads("".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def _commit(spark: SparkSession, sink: str, record: dict) -> int:
    number = max(versions(spark, sink), default=0)
    while True:
        number += 1
        fs, place = _hadoop(spark, f"{sink}/versions/{number:0{WIDTH}d}")
        try:
            out = fs.create(place, False)
        except Exception as taken:  # noqa: BLE001 - the file system's own error
            if fs.exists(place):
                continue            # another writer was first
            raise taken
        out.write(json.dumps({**record, "version": number}).encode())
        out.close()
        return number


def write_version(spark: SparkSession, sink: str, write: Callable[[str], object], kind: str = "parquet") -> int:
    """Run ``write(folder)`` and commit the folder as the sink's next version, whose
    number is returned.  If it fails, its data are deleted and nothing changes."""
    name = f"data/{uuid.uuid4().hex}"
    try:
        write(f"{sink}/{name}")
        return _commit(spark, sink, {"folder": name, "kind": kind})
    except BaseException:
        fs, place = _hadoop(spark, f"{sink}/{name}")
        fs.delete(place, True)
        raise


def version_folder(spark: SparkSession, sink: str, version: int | None = None) -> str:
    """The folder of a version, of the last one by default."""
    known = versions(spark, sink)
    number = known[-1] if version is None and known else version
    if number not in known:
        raise FileNotFoundError(f"{sink} has no version {'at all' if number is None else number}")
    return f"{sink}/{_record(spark, sink, number)['folder']}"


def save_table(df: DataFrame, sink: str) -> int:
    return write_version(df.sparkSession, sink, lambda folder: df.write.parquet(folder))


def load_table(spark: SparkSession, sink: str, version: int | None = None) -> DataFrame:
    return spark.read.parquet(version_folder(spark, sink, version))


def save_model(spark: SparkSession, model, sink: str) -> int:
    return write_version(spark, sink, lambda folder: model.write().save(folder), "model")


def load_model(spark: SparkSession, model_cls, sink: str, version: int | None = None):
    return model_cls.load(version_folder(spark, sink, version))


def save_params(params: DataFrame, sink: str) -> int:
    """A frame of run parameters as JSON lines."""
    return write_version(params.sparkSession, sink, lambda folder: params.write.json(folder), "params")


def load_params(spark: SparkSession, sink: str, schema, version: int | None = None) -> DataFrame:
    return spark.read.schema(schema).json(version_folder(spark, sink, version))


def discard_unfinished(spark: SparkSession, sink: str) -> int:
    """Delete the data of writes that never committed (a killed driver's); to be
    called while no write is running.  Returns how many there were."""
    fs, place = _hadoop(spark, f"{sink}/data")
    if not fs.exists(place):
        return 0
    held = {_record(spark, sink, n)["folder"].rpartition("/")[2] for n in versions(spark, sink)}
    left = [s.getPath() for s in fs.listStatus(place) if s.getPath().getName() not in held]
    for path in left:
        fs.delete(path, True)
    return len(left)
