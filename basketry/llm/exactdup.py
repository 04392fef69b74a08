"""Exact duplicates by a stateful stream, in DataFrame functions only.

Texts are compared without their ASCII white space.  A first stream reads the
files and writes one thin row a document: the digest of its normalised text, its
id, its length and the place of its content (file and row).  A second stream
groups the thin rows by digest; its state, on the executors' disks (RocksDB) and
logged to the shared folder, has no expiry and holds for each digest the document
that stays (length, id), the place of its content and the number of documents.
Both run until their input is used up and go on from their checkpoints when
there is more, so a corpus that grows by files is deduplicated as it grows.

A hit, a document whose digest others have too, is not trusted: the whole
normalised texts of the hits are grouped by digest and text, copies within a task
becoming one row before the shuffle, and digests with more than one text are
regrouped by the text itself.  Texts without a hit are not moved at all.

Documents meet the state again through their digest.  Digests of over a
``HEAVY``-th of the documents with hits, fewer than ``HEAVY`` of course, are broadcast;
so no task gets a large group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import key_filter
from basketry.session import cut_lineage, scratch_path

HEAVY = 1024
BATCH_BYTES = 64 << 30              # thin rows of a micro-batch, about; a lost batch is redone
SPACES = (" ", "\t", "\n", "\x0b", "\f", "\r")
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # no disk reserved ahead of need: a state has many small stores
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for s in SPACES:
        out = F.replace(out, F.lit(s), F.lit(""))
    return out


def sha256(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def _as_pattern(path: str) -> str:
    """The path as a pattern that only it matches: a stream's plain path must be a
    folder, a pattern may also match a single file."""
    if any(c in path for c in "*?[{"):
        return path
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/{{{name}}}"


def _place() -> list[Column]:
    """Where a row's content is: its file and its row in it."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]


class Deduplicator:
    """The streams over the Parquet files of ``path`` and what their state says.

    ``folder`` (on storage that all executors share) keeps the streams' logs and
    state; a later run with the same folder reads only new files."""

    def __init__(self, spark: SparkSession, path: str, folder: str | None = None, key: str = "doc_id",
                 text: str = "text", digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES):
        self.spark, self.path, self.key, self.text, self.digest = spark, path, key, text, digest
        self.folder, self.batch_bytes = folder or scratch_path(spark, "exact-dedup"), batch_bytes
        # settings of the state's store, without changing those of the caller's session
        self.streams = spark.newSession()
        for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            self.streams.conf.set(name, spark.conf.get(name))
        for name, value in STREAM_CONF.items():
            self.streams.conf.set(name, value)

    def update(self) -> "Deduplicator":
        """Take in the files that no earlier update has seen."""
        docs = self.streams.readStream.schema(self.spark.read.parquet(self.path).schema).parquet(_as_pattern(self.path))
        body = normalised(F.col(f"`{self.text}`"))
        thin = docs.select(F.col(f"`{self.key}`").cast("long").alias("k"), self.digest(body).alias("digest"),
                           F.length(F.coalesce(F.col(f"`{self.text}`"), F.lit(""))).cast("long").alias("points"), *_place())
        self._run(thin.writeStream.format("parquet").outputMode("append").option("path", f"{self.folder}/thin"), "thin")
        rows = (self.streams.readStream.schema(thin.schema).option("maxBytesPerTrigger", str(self.batch_bytes))
                .parquet(f"{self.folder}/thin"))
        # the longest, then the smallest id (null last): ~ turns the order of whole numbers round
        stays = F.max(F.struct("points", F.bitwise_not("k").alias("k"), "file", "row")).alias("stays")
        state = rows.groupBy("digest").agg(stays, F.count(F.lit(1)).alias("size"))
        self._run(state.writeStream.format("noop").outputMode("update"), "state")
        return self

    def _run(self, writer, name: str) -> None:
        query = writer.option("checkpointLocation", f"{self.folder}/{name}-log").trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            query.stop()

    def documents(self) -> DataFrame:
        """The thin rows: ``k``, ``digest``, ``points``, ``file``, ``row``."""
        return self.spark.read.schema("k bigint, digest binary, points bigint, file string, row bigint").parquet(
            f"{self.folder}/thin")

    def registry(self) -> DataFrame:
        """The state: one row per digest with the document that stays, the place
        of its content (``stays``) and the number of documents (``size``)."""
        state = self.streams.read.format("statestore").load(f"{self.folder}/state-log")
        value = state.select("key.digest", F.col("value").alias("v"))
        first, second = value.schema["v"].dataType.names
        table = value.select("digest", F.col("v")[first].alias("stays"), F.col("v")[second].alias("size"))
        # read by the caller's session: the state's reader belongs to the streams' one
        return self.spark.read.parquet(cut_lineage(table, "exact-state")._scratch)

    def collisions(self, hits: DataFrame) -> DataFrame:
        """``(digest, file, row, body)`` of the documents whose digest (one of
        ``hits``) stands for more than one text: all bytes are compared."""
        docs = self.spark.read.parquet(self.path)
        body = normalised(F.col(f"`{self.text}`"))
        rows = docs.select(body.alias("body"), *_place()).withColumn("digest", self.digest(F.col("body")))
        marked = key_filter(rows, F.xxhash64("digest"), hits.select(F.xxhash64("digest").alias("x")), "x", "hit").where("hit")
        texts = marked.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("n"))
        several = texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
        several = cut_lineage(several, "exact-collisions")
        if several.isEmpty():
            return self.spark.createDataFrame([], "digest binary, file string, row bigint, body string")
        return marked.join(several, "digest", "left_semi").select("digest", "file", "row", "body")

    def groups(self) -> DataFrame:
        """One row per document: ``k``, ``digest``, ``points``, ``file``, ``row``
        and ``stays`` and ``size`` of its group, all bytes compared."""
        found = self.registry()
        hits = cut_lineage(found.where("size > 1"), "exact-hits")
        rows = self.documents()
        split = cut_lineage(self.collisions(hits), "exact-split")
        if split.isEmpty():
            return with_groups(rows, hits, ["digest"])
        # the digest is not enough for these: the text decides
        stays = F.max(F.struct("points", F.bitwise_not("k").alias("k"), "file", "row")).alias("stays")
        alike = rows.join(split, ["digest", "file", "row"])
        parted = cut_lineage(alike.groupBy("digest", "body").agg(stays, F.count(F.lit(1)).alias("size")), "exact-texts")
        same = with_groups(alike, parted, ["digest", "body"]).drop("body")
        rest = rows.join(split.select("file", "row"), ["file", "row"], "left_anti")
        return with_groups(rest.select(rows.columns), hits, ["digest"]).unionByName(same.select(*rows.columns, "stays", "size"))


def with_groups(rows: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``stays`` and ``size`` of their group; rows whose key no group
    has are alone.  Groups of over a ``HEAVY``-th of all members are broadcast, the
    others joined by their key."""
    least = (groups.agg(F.sum("size")).first()[0] or 0) // HEAVY
    heavy = groups.where(F.col("size") > least)             # fewer than HEAVY rows, or the sum would be greater
    met = rows.join(F.broadcast(heavy), key, "left")
    light = met.where("size is null").drop("stays", "size").join(groups.where(F.col("size") <= least), key, "left")
    own = F.struct("points", F.bitwise_not("k").alias("k"), "file", "row")
    light = light.withColumn("stays", F.coalesce("stays", own)).withColumn("size", F.coalesce("size", F.lit(1)))
    return met.where("size is not null").select(light.columns).unionByName(light)


def exact_duplicates(spark: SparkSession, path: str, key: str = "doc_id", text: str = "text", folder: str | None = None,
                     digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document of the Parquet files of ``path``: its key, ``keep_id``
    (key of the document that stays for its group), ``group_size``, ``kept``,
    ``digest`` (binary) and the place of its content (``file``, ``row``).

    Texts are equal if they are without ASCII white space; the longest in code
    points stays, then the smallest key (null last), of wholly equal rows the last
    by file and row.

    Defined results: a null text is an empty one, and all texts of white space are
    equal; a group of null keys only has the ``keep_id`` null, but one row kept;
    an empty table gives an empty result; columns other than key and text are not
    read and may have any name; a digest that two texts share is split by the
    texts."""
    found = Deduplicator(spark, path, folder, key, text, digest, batch_bytes).update().groups()
    return found.select(
        F.col("k").alias(key), F.bitwise_not(F.col("stays.k")).alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("stays.file").eqNullSafe(F.col("file")) & F.col("stays.row").eqNullSafe(F.col("row"))).alias("kept"),
        "digest", "file", "row")


ORACLE = r"""
WITH docs AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                     sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
              FROM documents),
grouped AS (SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
            FROM docs)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
"""
