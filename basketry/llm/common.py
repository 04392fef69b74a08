"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import cut_lineage, discard

# Words of the operators' contracts: runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def read_docs(spark, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def word_runs(text: bytes, limit: int = 1 << 22) -> Iterator[list[bytes]]:
    """The words of ``text`` in order, as lists from stretches of about
    ``limit`` bytes (cut at white space), so a huge text never becomes one
    huge list.  ``bytes.split`` cuts at exactly the six ASCII spaces."""
    at = 0
    while len(text) - at > limit:
        cut = _SPACE.search(text, at + limit)
        if cut is None:
            break
        yield text[at:cut.start()].split()
        at = cut.end()
    yield text[at:].split() if at else text.split()


def small(batches: Iterator, rows: int = 1024) -> Iterator:
    """Arrow batches of texts in slices, so that few texts at a time become
    Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def extended(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` and more columns after it."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


NO_COLUMN = "no other column"


def with_rest(docs: DataFrame, text: Column, without: list[str]) -> DataFrame:
    """``(__row, __text)``: the columns of ``docs`` but those of ``without`` as one,
    whatever their names, and a text, for a pass that adds columns to them."""
    gone = {c.lower() for c in without}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in gone]
    return docs.select(F.struct(*(kept or [F.lit(None).cast("int").alias(NO_COLUMN)])).alias("__row"), text.alias("__text"))


def rest_and(made: DataFrame, added: list[str]) -> DataFrame:
    """The columns that ``with_rest`` joined, and ``added`` ones."""
    alone = made.schema["__row"].dataType.names == [NO_COLUMN]
    return made.select(*added) if alone else made.select("__row.*", *added)


def hash_bound(share: float) -> int:
    """The 64-bit hash (signed) up to which a ``share`` of all hashes lies, however
    small the share."""
    return max(-(1 << 63), min((1 << 63) - 1, int(share * 2.0**64) - (1 << 63)))


def partition_ranks(df: DataFrame, order: list, rank: str, name: str) -> DataFrame:
    """``df`` with the 0-based position of each row in the given total order,
    without a single-task window: a range sort, then each sorted partition's
    start (one number per partition) added to the place within it."""
    place = "__place"
    rows = cut_lineage(df.orderBy(*order).withColumn(place, F.monotonically_increasing_id()), name)
    part = F.shiftright(place, 33)
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(part).count().collect())
    starts, at = [], 0
    for p, n in sizes:
        starts.append((p, at))
        at += n
    table = rows.sparkSession.createDataFrame(starts or [(0, 0)], "__part long, __start long")
    within = F.col(place) - F.shiftleft(part, 33)
    return (rows.withColumn("__part", part).join(F.broadcast(table), "__part")
            .withColumn(rank, F.col("__start") + within).drop("__part", "__start", place))


FILTER_BITS = 1 << 24           # 2 MB, whatever the number of keys


def key_filter(rows: DataFrame, column: Column, keys: DataFrame, key: str, mark: str,
               bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with a boolean ``mark``: true wherever ``column`` is among the
    whole numbers ``keys[key]``, false for most other rows.  Made of a bitmap of
    fixed size, built by Spark's bitmap aggregates and broadcast (bits / 8 bytes
    at most).  Rows it rejects need not be shuffled to be joined with the keys;
    with more keys than bits it lets everything pass, and the join decides."""
    # the bitmap functions count places from 1 on; a bucket holds 32,768 of them
    spots = keys.select((F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(bits)) + 1).alias("x"))
    table = cut_lineage(spots.groupBy((F.bitmap_bucket_number("x") - 1).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("x")).alias("__bits")), "key-filter")
    spot = F.pmod(F.xxhash64(F.lit(7), column), F.lit(bits))
    byte = F.substring("__bits", F.floor(F.col("__spot") % 32768 / 8).cast("int") + 1, F.lit(1))
    found = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.expr("shiftleft(1, cast(__spot % 8 as int))")) != 0
    marked = rows.withColumn("__spot", spot).withColumn("__at", F.floor(F.col("__spot") / 32768))
    joined = marked.join(F.broadcast(table), F.col("__at") == F.col("__bucket"), "left")
    return joined.withColumn(mark, F.coalesce(found, F.lit(False))).drop("__spot", "__at", "__bucket", "__bits")


def components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph of bigint ids: one row
    ``(node, root)`` per node that has an edge, ``root`` the smallest id
    reachable.

    Alternating large and small stars: every round links each node's
    neighbours to the smallest id around it, so paths shrink geometrically.
    Rounds are written to the shared scratch folder; the driver sees two
    numbers a round.  A hub's edges are joined to one row of minima, a join
    whose big side adaptive execution splits."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = cut_lineage(e, name)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        # the smallest id around a node also has to stay linked to it
        keep = low.where("m < u").select("u", F.col("m").alias("v"))
        large = large.unionByName(keep).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
                  .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        last, e = e, cut_lineage(linked, name)
        discard(last)
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == tuple(now):
            break
        seen = tuple(now)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
