"""Target-distribution importance resampling on hashed n-grams.

A text becomes words by one byte table and one split: the table lower-cases A-Z
and turns every separator into a blank, in UTF-8, where no byte below 0x80 is
part of another character.  The crc32 of a run of words is the crc32 of its last
word seeded with that of the words before it, so each further word of an n-gram
costs one call.  Counters add up the buckets of a task; a task writes one row a
bucket, whatever its texts hold, and these are summed.

The corpus and the target give each bucket a gain, the floored log-ratio of their
smoothed shares; a text's weight is the sum over its features.  Gumbel noise from
a hash of the id turns "the highest scores" into a draw without replacement whose
chances follow the weights, the same in every run and on any partitions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import partition_ranks, small, word_runs
from basketry.session import cut_lineage

BUCKETS = 10_000
ORDER = 3
MIN_WORDS = 20
SCALE = 1000

_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def feature_crcs(text: bytes | None, order: int = ORDER) -> Iterator[tuple[int, list[int]]]:
    """The words and the crc32s of all runs of 1 to ``order`` words of a text, as
    ``(words, crcs)`` for one stretch of it after another."""
    before: list[bytes] = []
    for run in word_runs((text or b"").translate(TABLE)):
        words = before + run
        seeds = list(map(crc32, words))
        out = seeds[len(before):]
        tails = [b" " + w for w in words]
        for n in range(1, order):
            seeds = list(map(crc32, tails[n:], seeds))
            # runs that end within the words carried over were counted before
            out += seeds[max(0, len(before) - n):]
        yield len(run), out
        before = words[len(words) - order + 1:] if 1 < order <= len(words) else words if order > 1 else []


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """``(bucket, n)``: how many features of all texts of ``docs`` fall in each
    bucket, for buckets that have any.  A task writes ``buckets`` rows at most.

    Defined results: a null text has no feature; an empty table gives no row."""
    def run(batches):
        counts: Counter = Counter()
        for batch in small(batches, 256):
            for t in batch.column(0).to_pylist():
                for _, crcs in feature_crcs(t, order):
                    counts.update((np.array(crcs, np.uint32) % buckets).tolist())
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int32()), pa.array(counts.values(), pa.int64())],
                                             ["bucket", "n"])

    found = docs.select(F.encode(F.col(text), "UTF-8").alias("t")).mapInArrow(run, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, gain)`` for all ``buckets`` buckets, from two tables of
    ``bucket_counts``: floor(1000 * ln) of the ratio of the target's share to the
    source's, each count plus one."""
    spark = source.sparkSession
    table = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
             .join(source.select("bucket", F.col("n").alias("s")), "bucket", "left")
             .join(target.select("bucket", F.col("n").alias("t")), "bucket", "left").na.fill(0, ["s", "t"]))
    table = cut_lineage(table, "importance-counts")             # read twice; the counts cost a pass over the texts
    all_s, all_t = table.agg(F.sum("s") + buckets, F.sum("t") + buckets).first()
    ratio = ((F.col("t") + 1) * F.lit(float(all_s))) / ((F.col("s") + 1) * F.lit(float(all_t)))
    return table.select("bucket", F.floor(F.lit(float(SCALE)) * F.log(ratio)).cast("long").alias("gain"))


def weigh(docs: DataFrame, gains: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
          order: int = ORDER) -> DataFrame:
    """One row per document: its key, ``n_words``, ``n_features`` and ``weight``,
    the sum of the gains of its features.  The gains (a number a bucket) travel
    with the tasks.

    Defined results: a null text or one without a word has zero of each; repeated
    rows stay repeated; other columns are not read."""
    table = np.zeros(buckets, np.int64)
    for r in gains.collect():
        table[r["bucket"]] = r["gain"]

    def run(batches):
        for batch in small(batches):
            n_words, n_features, weights = [], [], []
            for t in batch.column(1).to_pylist():
                words = features = weight = 0
                for n, crcs in feature_crcs(t, order):
                    words += n
                    features += len(crcs)
                    weight += int(table[np.array(crcs, np.uint32) % buckets].sum())
                n_words.append(words)
                n_features.append(features)
                weights.append(weight)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in (n_words, n_features, weights))],
                [key, "n_words", "n_features", "weight"])

    thin = docs.select(F.col(f"`{key}`").alias(key), F.encode(F.col(f"`{text}`"), "UTF-8").alias("__text"))
    schema = T.StructType([thin.schema[key], *T.StructType.fromDDL("n_words long, n_features long, weight long").fields])
    return thin.mapInArrow(run, schema)


def noisy_score(weight: str, key: str, seed: int = 42):
    """``weight`` and 1000 times a Gumbel number from sha256(``seed:key``), floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.lit(-float(SCALE)) * F.log(-F.log((h + 0.5) / 4294967296.0))
    return F.col(weight) + F.floor(noise).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, key: str = "doc_id", text: str = "text",
             target_text: str = "text", buckets: int = BUCKETS, order: int = ORDER, min_words: int = MIN_WORDS,
             seed: int = 42) -> DataFrame:
    """One row per document: its key, ``n_words``, ``n_features``, ``weight``,
    ``score`` and ``rank``.  Of the N documents with at least ``min_words`` words,
    the floor(percent * N / 100) highest scores are drawn and ranked from 1 on;
    the rest have a null rank.

    Defined results: a null text has no words; a null key counts as an empty one
    in the noise; ties go to the smaller key (null last), and between rows of one
    key and score any order; an empty target or corpus is all smoothing; an empty
    table gives an empty result; columns other than key and text are not read."""
    gains = bucket_gains(bucket_counts(docs, text, buckets, order),
                         bucket_counts(target, target_text, buckets, order), buckets)
    weighed = weigh(docs, gains, key, text, buckets, order)
    scored = cut_lineage(weighed.withColumn("score", noisy_score("weight", key, seed)), "importance-scores")
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    ranked = partition_ranks(scored.where(able), [F.col("score").desc(), F.col(f"`{key}`").asc_nulls_last()],
                             "__rank", "importance-ranks")
    rank = F.when(F.col("__rank") < drawn, F.col("__rank") + 1)
    rest = scored.where(~able).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank.cast("long")).drop("__rank").unionByName(rest)
