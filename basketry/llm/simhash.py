"""SimHash near-duplicates with Golay-code fuzzy hashing.

Fingerprints: bit b of a document's 64-bit fingerprint is 1 if it is set in
over half of the XXH64 values of the document's word shingles.

Links: documents of one fingerprint are one node, so copies cost one row.  The
64 bits are cut into segments of 23, 23 and 18 bits.  The binary Golay code is
perfect: each 23-bit word lies within 3 bits of exactly one codeword.  The keys
of a segment are the codewords that the words up to one bit away decode to (one
key, or six); two segments at most 2 bits apart have a word one bit from both,
so they share a key.  With at most 2 bits different over three segments, one
segment is equal (pigeonhole) and the next is at most 2 bits apart: a
fingerprint's keys are each segment's bits with a Golay key of the next, 16 keys
of 30 to 35 bits on average.  Fingerprints that share a key are compared.

A key with over ``MAX_BUCKET`` fingerprints is not compared pair by pair.  Its
fingerprints are linked exactly by stars: two fingerprints are at most 2 bits
apart if and only if some word is at most one bit from both, so each is filed
under the 65 such words and linked to the smallest one filed there.  That is 65
rows a fingerprint whatever the group's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import components, extended, rest_and, small, with_rest, word_runs
from basketry.session import cut_lineage, discard

SEGMENTS = ((0, 23), (23, 23), (46, 18))      # first bit, bits
GOLAY = 0b110001110101                        # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
MAX_BUCKET = 64
SEED = 42
RUN = 1 << 18                                 # hashes counted at a time


# ---------------------------------------------------------------- fingerprints

def shingle_hashes(text: bytes, words: int = 3):
    """XXH64 of every shingle of a lower-cased text, as uint64 arrays.  Fewer
    words than a shingle make one shingle of all; no word makes none."""
    digest, before = xxhash.xxh64_intdigest, []
    n = 0
    for run in word_runs(text):
        n += len(run)
        run = before + run
        grams = zip(*[run[i:] for i in range(words)])
        hashes = [digest(b" ".join(g), SEED) for g in grams]
        if hashes:
            yield np.array(hashes, np.uint64)
        before = run[len(run) - words + 1:] if words > 1 and len(run) >= words else run if words > 1 else []
    if 0 < n < words:
        yield np.array([digest(b" ".join(before), SEED)], np.uint64)


def bit_counts(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set per document; ``starts`` are the
    first hashes of the documents.  Eight bits are counted at a time in the
    eight bytes of a word, over runs of at most 255 hashes."""
    ends = np.append(starts[1:], len(hashes))
    pieces = (ends - starts + 254) // 255
    doc = np.repeat(np.arange(len(starts)), pieces)
    first = np.cumsum(pieces) - pieces
    cuts = starts[doc] + 255 * (np.arange(len(doc)) - first[doc])
    out = np.empty((len(starts), 8, 8), np.int64)
    for bit in range(8):
        lanes = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        small = np.add.reduceat(lanes, cuts).view(np.uint8).reshape(-1, 8)
        out[:, :, bit] = np.add.reduceat(small.astype(np.int64), first, axis=0)
    return out.reshape(-1, 64)


def fingerprint(text: bytes | None, words: int = 3) -> int:
    return int(fingerprints([text], words)[0])


def fingerprints(texts: list, words: int = 3) -> np.ndarray:
    """Unsigned fingerprints of UTF-8 texts (0 for a null text or no word)."""
    counts = np.zeros((len(texts), 64), np.int64)
    totals = np.zeros(len(texts), np.int64)
    waiting, docs, size = [], [], 0

    def count():
        if waiting:
            lengths = np.array([len(w) for w in waiting])
            starts = np.cumsum(lengths) - lengths
            np.add.at(counts, docs, bit_counts(np.concatenate(waiting), starts))
            np.add.at(totals, docs, lengths)
            waiting.clear()
            docs.clear()

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text.lower() if text else b"", words):
            waiting.append(hashes)
            docs.append(i)
            size += len(hashes)
            if size >= RUN:
                count()
                size = 0
    count()
    bits = (2 * counts > totals[:, None]).astype(np.uint64)
    return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def with_fingerprints(docs: DataFrame, text: str = "text", words: int = 3) -> DataFrame:
    """The columns of ``docs`` but the text, and ``fp``, a bigint with the
    fingerprint's bits (an input column of that name is replaced)."""
    def run(batches):
        for batch in small(batches):
            found = fingerprints(batch.column(batch.num_columns - 1).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found.view(np.int64))],
                                             ["__row", "fp"])

    rows = with_rest(docs, F.encode(F.col(f"`{text}`"), "UTF-8"), [text, "fp"])
    return rest_and(rows.mapInArrow(run, extended(rows.select("__row"), "fp bigint")), ["fp"])


# ---------------------------------------------------------------- Golay keys

def _syndromes(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY << (bit - 11), 0)
    return rest


def _error_table() -> np.ndarray:
    """For each 11-bit syndrome the one error of at most 3 bits that has it."""
    ones = [1 << i for i in range(23)]
    errors = [0] + ones + [a | b for a in ones for b in ones if a < b] + \
        [a | b | c for a in ones for b in ones if a < b for c in ones if b < c]
    errors = np.array(errors, np.int64)
    table = np.empty(2048, np.int64)
    table[_syndromes(errors)] = errors
    return table


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices near 23-bit words: ``(row, index)``, one or six a row.
    A word's codeword is the word without its error; flipping a bit shifts the
    syndrome by that bit's own."""
    table = _error_table()
    flips = np.concatenate([[0], 1 << np.arange(23)])
    moved = words[:, None] ^ flips
    code = moved ^ table[_syndromes(words)[:, None] ^ _syndromes(flips)]
    code = np.sort(code >> 11, axis=1)
    new = np.ones(code.shape, bool)
    new[:, 1:] = code[:, 1:] != code[:, :-1]
    row = np.nonzero(new)[0]
    return row, code[new]


def _segment(fps: np.ndarray, i: int) -> np.ndarray:
    first, bits = SEGMENTS[i]
    return ((fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _key_pass(batches):
    """``(key, fp)``: each segment's bits with a Golay key of the next."""
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(fps), 4096):
            some = fps[at:at + 4096]
            for i in range(3):
                row, code = golay_keys(_segment(some, (i + 1) % 3))
                key = (i << 36) | (_segment(some, i)[row] << 12) | code
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some.view(np.int64)[row])], ["key", "fp"])


def _near_words(fp: Column, max_bits: int) -> Column:
    """Words that two fingerprints share exactly if they are close: for two
    bits, all at most one bit away; for one bit, the fingerprint without bit b,
    with b's place (as two columns of a struct)."""
    flips = [F.struct(fp.bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))).alias("w"), F.lit(-1).alias("b"))
             for i in range(64)] if max_bits == 2 else \
        [F.struct(fp.bitwiseAND(F.lit(~(1 << i) if i < 63 else (1 << 63) - 1)).alias("w"), F.lit(i).alias("b"))
         for i in range(64)]
    return F.array(F.struct(fp.alias("w"), F.lit(-1).alias("b")), *flips)


def fingerprint_links(fps: DataFrame, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links ``(a, b)`` between different fingerprints of ``fps`` (one column
    ``fp``, distinct): every link is a true one, and every two fingerprints at
    most ``max_bits`` (0 to 2) apart are connected."""
    if max_bits not in (0, 1, 2):
        raise ValueError("a Golay key tolerates two bits a segment: max_bits is 0, 1 or 2")
    spark = fps.sparkSession
    if max_bits == 0:
        return spark.createDataFrame([], "a bigint, b bigint")
    keys = cut_lineage(fps.select("fp").mapInArrow(_key_pass, "key bigint, fp bigint"), "golay-keys")
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    filed = cut_lineage(keys.join(buckets, "key"), "golay-buckets")
    discard(keys)
    small = filed.where(F.col("n") <= max_bucket)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (small.select("key", F.col("fp").alias("a")).join(small.select("key", F.col("fp").alias("b")), "key")
             .where(F.col("a") < F.col("b")).where(close).select("a", "b"))
    large = filed.where(F.col("n") > max_bucket).select("fp").distinct()
    words = large.select("fp", F.explode(_near_words(F.col("fp"), max_bits)).alias("near")).select("fp", "near.*")
    stars = (words.groupBy("w", "b").agg(F.collect_set("fp").alias("fps"))        # 65 at most
             .where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
             .where("a <> b"))
    return pairs.unionByName(stars)


def _classes(prints: DataFrame, max_bits: int, max_bucket: int) -> DataFrame:
    """``(fp, root, component)`` per fingerprint of ``prints`` (columns k, fp)."""
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("k").alias("low")), "fingerprint-nodes")
    roots = components(fingerprint_links(nodes, max_bits, max_bucket), "a", "b", "simhash")
    lows = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
            .select("fp", F.coalesce("root", "fp").alias("root"), "low"))
    return lows.join(lows.groupBy("root").agg(F.min("low").alias("component")), "root")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3,
                    max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row ``(key, fp, component)`` per document: its fingerprint (bigint)
    and the smallest key reachable over links of at most ``max_bits`` different
    bits, its own included.

    Defined results: a null or empty text, or one of white space only, has
    fingerprint 0, which links like any other; repeated rows stay repeated; a
    null key counts as larger than all others (a component of null keys only
    has the component null); an empty table gives an empty result; columns
    other than key and text are not read."""
    thin = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    prints = cut_lineage(with_fingerprints(thin, "t", words), "fingerprints")
    return (prints.join(_classes(prints, max_bits, max_bucket), "fp")
            .select(F.col("k").alias(key), "fp", "component"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3,
             max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``docs`` with one document left of each group of near-duplicates: the one
    with the smallest key (null last), between rows of one key the one with the
    least hash of all columns, of wholly equal rows one.  Columns may have any
    names but ``__row`` and ``__key``."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    thin = docs.select(F.col(key).alias("k"), row.alias("h"), F.col(text).alias("t"))
    prints = cut_lineage(with_fingerprints(thin, "t", words), "fingerprints")
    grouped = prints.join(_classes(prints, max_bits, max_bucket).select("fp", "root"), "fp")
    first = (grouped.groupBy("root").agg(F.min(F.struct(F.col("k").isNull().alias("none"), "k", "h")).alias("m"))
             .select(F.col("m.k").alias("__key"), F.col("m.h").alias("__row")))
    first = cut_lineage(first, "simhash-kept")
    rows = docs.withColumn("__row_hash", row)
    kept = rows.join(first, (rows["__row_hash"] == first["__row"]) & rows[key].eqNullSafe(first["__key"]), "left_semi")
    equal = (prints.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .join(first, F.expr("h = __row and k <=> __key"), "left_semi").select("h").distinct())
    equal = cut_lineage(equal, "simhash-equal-rows")
    if not equal.isEmpty():
        alone = kept.join(equal, kept["__row_hash"] == equal["h"], "left_anti")
        tied = kept.join(equal, kept["__row_hash"] == equal["h"], "left_semi").dropDuplicates(["__row_hash", key])
        kept = alone.unionByName(tied)
    return kept.drop("__row_hash")
