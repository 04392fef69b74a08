"""The most similar rows of each row by the cosine of their TF-IDF vectors.

The vectors stay sparse and no table of all pairs is made:

* Rows with the same terms and counts are one node.  A node keeps its k + 1
  smallest row ids; the row limit of the window is applied in each task before
  the shuffle, so any number of copies is a few rows.
* Terms have one order, the rarest first.  A node is filed in an inverted index
  under its prefix only: the terms from which on the rest of its vector, by its
  own length and by each term's largest weight, could still give the least
  cosine asked for.  Two nodes that are similar enough have their first common
  term in both prefixes, so they meet there, and only there they are compared.
* The nodes filed under a term are dealt into cells by their weight of the term
  and the length of the vector after it.  Cells whose largest values cannot reach
  the least cosine are not compared; large cells are split into blocks by a hash,
  so a hot term is many tasks' work.
* A filed vector is its term numbers and counts in a few bytes a term; weights
  follow from the terms' idf at hand.  Blocks are as large as a task can hold of
  these, so that few copies of a vector are shuffled.
* Two blocks are compared tile by tile: a product in single precision, with its
  error allowed for, names the pairs that are compared in double precision, once
  those that meet under an earlier term, too, have been left out by bits.  A
  task keeps k nodes a node; the best k of these are kept by a window.

Cosines are rounded to ``DIGITS`` before they are compared, so that equal ones tie
whatever the order of summation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators.tfidf import BROADCAST_TERMS, TermStats, idf_table, top_terms
from basketry.session import cut_lineage

DIGITS = 6
BLOCK = 2048
TILE = 2048
LARGEST, GROUP_BYTES = 16384, 16 << 20      # rows of a block, and bytes of its vectors
SLACK = 2e-6                    # two roundings: nothing that rounds to the least cosine is pruned
GRID = 8
TERM_SLICE = 4096
HEAVY = 1024


def _numbered_terms(stats: TermStats, max_features: int) -> DataFrame:
    """``(term, tid, idf)``: the vocabulary numbered from the rarest term on."""
    vocabulary = top_terms(stats.tf, max_features)
    table = idf_table(stats.tf, vocabulary, stats.n_docs)
    # the window ranks the bounded vocabulary only
    order = Window.orderBy("doc_freq", "term")
    return table.select("term", (F.row_number().over(order) - 1).alias("tid"), "idf")


def vector_nodes(stats: TermStats, max_features: int = 1000) -> tuple[DataFrame, DataFrame]:
    """``(rows, nodes)``: ``rows`` has each row's id (``i``) and the ``node`` of its
    vector; ``nodes`` has each different vector once, with ``n`` rows, its term
    numbers ``tids`` (ascending), their counts ``tfs``, its length ``norm`` and unit
    weights ``ws``.  A node is named by the
    smallest id of its rows.  Rows without a term of the vocabulary have none."""
    if max_features > BROADCAST_TERMS:
        raise ValueError(f"the index holds a number a term: at most {BROADCAST_TERMS} of them")
    terms = cut_lineage(_numbered_terms(stats, max_features), "similar-terms")
    found = stats.tf.join(F.broadcast(terms), "term")
    docs = found.groupBy(F.col(stats.id_col).alias("i")).agg(
        F.array_sort(F.collect_list(F.struct("tid", "tf", "idf"))).alias("t"))
    key = F.sha2(F.array_join(F.transform("t", lambda x: F.concat_ws(":", x["tid"], x["tf"])), ","), 256)
    docs = cut_lineage(docs.withColumn("key", key), "similar-rows")
    named = docs.groupBy("key").agg(F.min("i").alias("node"), F.count(F.lit(1)).alias("n"))
    raw = F.transform("t", lambda x: x["tf"] * x["idf"])
    nodes = (docs.join(named.select("node", "n"), F.col("i") == F.col("node"))
             .select("node", "n", "key", F.col("t.tid").alias("tids"), F.col("t.tf").alias("tfs"), raw.alias("raw"))
             .withColumn("norm", F.sqrt(F.aggregate("raw", F.lit(0.0), lambda a, x: a + x * x)))
             .select("node", "n", "key", "tids", "tfs", "norm", F.transform("raw", lambda x: x / F.col("norm")).alias("ws")))
    return docs.select("i", "key"), cut_lineage(nodes, "similar-nodes")


def term_numbers(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Each term's largest weight and its idf: numbers a term of the vocabulary."""
    each = nodes.select("norm", F.explode(F.arrays_zip("tids", "tfs", "ws")).alias("x"))
    found = each.groupBy(F.col("x.tids").alias("tid")).agg(
        F.max("x.ws").alias("w"), F.max(F.col("x.ws") * F.col("norm") / F.col("x.tfs")).alias("idf")).collect()
    largest, idf = (np.zeros(max((r["tid"] for r in found), default=0) + 1) for _ in range(2))
    for r in found:
        largest[r["tid"]], idf[r["tid"]] = r["w"], r["idf"]
    return largest, idf


def _term_type(n_terms: int) -> np.dtype:
    return np.dtype(np.uint16 if n_terms <= 1 << 16 else np.uint32)


def prefix_postings(nodes: DataFrame, min_cosine: float, numbers: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """The inverted index: a row per node and term of its prefix, with the weight
    of the term (``a``), the length of the vector after it (``b``) and the vector:
    ``norm`` and the bytes of its term numbers and counts (a byte each where all
    are below 256)."""
    largest, idf = numbers or term_numbers(nodes)
    kind, least = _term_type(len(idf)), min_cosine - SLACK

    def run(batches):
        for batch in batches:
            names, norms = batch.column(0), batch.column(1)
            at, tid, a, b, terms, counts = [], [], [], [], [], []
            for row, (ts, cs, ws) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4)))):
                w = np.asarray(ws)
                from_here = np.cumsum((w * w)[::-1])[::-1]
                bound = np.minimum(np.sqrt(from_here), np.cumsum((w * largest[ts])[::-1])[::-1])
                n = int(np.searchsorted(-bound, -least, "right"))          # bounds fall along the vector
                at += [row] * n
                tid += ts[:n]
                a += ws[:n]
                b += np.sqrt(np.append(from_here[1:], 0.0))[:n].tolist()
                terms.append(np.asarray(ts, kind).tobytes())
                counts.append(np.asarray(cs, np.uint8 if max(cs, default=0) < 256 else np.int64).tobytes())
            terms, counts = pa.array(terms, pa.binary()), pa.array(counts, pa.binary())
            for start in range(0, len(at), 512):
                rows = pa.array(at[start:start + 512], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tid[start:start + 512], pa.int32()), pa.array(a[start:start + 512]), pa.array(b[start:start + 512]),
                     names.take(rows), norms.take(rows), terms.take(rows), counts.take(rows)],
                    ["tid", "a", "b", "node", "norm", "terms", "counts"])

    vectors = nodes.select("node", "norm", "tids", "tfs", "ws")
    schema = T.StructType([*T.StructType.fromDDL("tid int, a double, b double").fields, nodes.schema["node"],
                           *T.StructType.fromDDL("norm double, terms binary, counts binary").fields])
    return vectors.mapInArrow(run, schema)


def deal_blocks(postings: DataFrame, min_cosine: float, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(postings, pairs)``: the postings with their block ``blk``, and the pairs
    of blocks ``(tid, l, r)`` of a term that can hold a pair of similar nodes."""
    cell = (F.least(F.floor(F.col("a") * GRID), F.lit(GRID - 1)) * GRID
            + F.least(F.floor(F.col("b") * GRID), F.lit(GRID - 1))).cast("int")
    filed = postings.withColumn("cell", cell)
    cells = filed.groupBy("tid", "cell").agg(F.count(F.lit(1)).alias("size"))
    whole = Window.partitionBy("tid")                          # GRID x GRID rows a term
    cells = cells.withColumn("all", F.sum("size").over(whole)).where("all > 1")
    cells = cells.withColumn("parts", F.when(F.col("all") <= block, F.lit(0)).otherwise(F.ceil(F.col("size") / block)))
    cells = cut_lineage(cells.select("tid", "cell", F.col("parts").cast("long")), "similar-cells")
    salt = F.pmod(F.xxhash64("node"), F.greatest("parts", F.lit(1)))
    blk = F.when(F.col("parts") == 0, F.lit(-1)).otherwise(F.shiftleft(F.col("cell").cast("long"), 40) + salt)
    dealt = cut_lineage(filed.join(cells, ["tid", "cell"]).withColumn("blk", blk).drop("cell", "parts"), "similar-postings")
    blocks = cut_lineage(dealt.groupBy("tid", "blk").agg(F.max("a").alias("a"), F.max("b").alias("b")), "similar-blocks")
    left, right = (blocks.select("tid", *[F.col(c).alias(f"{c}{s}") for c in ("blk", "a", "b")]) for s in "lr")
    reach = F.col("al") * F.col("ar") + F.col("bl") * F.col("br") >= min_cosine - SLACK
    pairs = left.join(right, "tid").where("blkl <= blkr").where(reach)
    return dealt, pairs.select("tid", F.col("blkl").alias("l"), F.col("blkr").alias("r"))


class _Side:
    """The vectors of some rows, by flat arrays of terms, weights and rows."""

    def __init__(self, rows: pd.DataFrame, idf: np.ndarray):
        kind = _term_type(len(idf))
        self.n, self.vocabulary = len(rows), len(idf)
        sizes = rows["terms"].map(len).to_numpy() // kind.itemsize
        self.longest = int(sizes.max(initial=0))
        self.terms = np.frombuffer(b"".join(rows["terms"]), kind).astype(np.int64)
        counts = [np.frombuffer(c, np.uint8 if len(c) == n else np.int64) for c, n in zip(rows["counts"], sizes)]
        self.row = np.repeat(np.arange(self.n), sizes)
        self.weights = np.concatenate([*counts, np.empty(0, np.uint8)]) * idf[self.terms] / np.repeat(rows["norm"].to_numpy(), sizes)
        self.held = np.zeros(len(idf), bool)
        self.held[self.terms] = True
        self.a, self.b = float(rows["a"].max()), float(rows["b"].max())

    def dense(self, some: np.ndarray, kind) -> np.ndarray:
        place = np.full(self.vocabulary, -1)
        place[some] = np.arange(len(some))
        at = place[self.terms]
        held = at >= 0
        out = np.zeros((self.n, len(some)), kind)
        out[self.row[held], at[held]] = self.weights[held]
        return out

    def held_bits(self, some: np.ndarray) -> np.ndarray:
        """Which of some terms each row has, a bit a term."""
        bits = np.packbits(self.dense(some, bool), axis=1)
        return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.uint64)


def _near_pairs(left: _Side, right: _Side, term: int, min_cosine: float, itself: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(i, j, cosine)``: the pairs of two tiles (``itself``: i < j of one) of at
    least ``min_cosine`` that have no common term before ``term``, so that products
    are made of the terms from it on.  The terms are taken ``TERM_SLICE`` at a time."""
    terms = np.nonzero(left.held & right.held)[0]
    cut = int(np.searchsorted(terms, term))
    early, slices = ([some[s:s + TERM_SLICE] for s in range(0, len(some), TERM_SLICE)] for some in (terms[:cut], terms[cut:]))
    rough = np.zeros((left.n, right.n), np.float32)
    for some in slices:
        rough += left.dense(some, np.float32) @ right.dense(some, np.float32).T
    # what single precision can be off for vectors of length 1 with that many products
    error = 1.2e-7 * (min(left.longest, right.longest) + len(slices) + 8)
    near = rough >= min_cosine - SLACK - error
    if itself:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    # pairs with a common term before this one belong to that term's list
    for some in early:
        x, y = left.held_bits(some), right.held_bits(some)
        first = [~(x[i[s:s + 65536]] & y[j[s:s + 65536]]).any(axis=1) for s in range(0, len(i), 65536)]
        first = np.concatenate([*first, np.empty(0, bool)])
        i, j = i[first], j[first]
    sims = np.zeros(len(i))
    if not len(i):
        return i, j, sims
    whole = len(i) > near.size // 16
    for some in slices:
        x, y = left.dense(some, np.float64), right.dense(some, np.float64)
        if whole:
            sims += (x @ y.T)[i, j]
            continue
        for s in range(0, len(i), 1024):
            sims[s:s + 1024] += (x[i[s:s + 1024]] * y[j[s:s + 1024]]).sum(axis=1)
    sims = np.round(sims, DIGITS)
    good = sims >= min_cosine
    return i[good], j[good], sims[good]


def _best(i: np.ndarray, j: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best ``j`` of every ``i``: largest cosine, then the smaller ``j``."""
    order = np.lexsort((j, -sims, i))
    i, j, sims = i[order], j[order], sims[order]
    kept = np.arange(len(i)) - np.searchsorted(i, i, "left") < k
    return i[kept], j[kept], sims[kept]


def block_rows(nodes: DataFrame) -> int:
    """How many vectors of the mean size a block can hold."""
    mean = nodes.agg(F.avg(F.size("tids"))).first()[0] or 0
    return int(max(BLOCK, min(LARGEST, GROUP_BYTES // (5 * mean + 64))))


def similar_nodes(nodes: DataFrame, k: int, min_cosine: float, block: int | None = None) -> DataFrame:
    """``(node, other, sim)``: for each node the ``k`` other nodes of the largest
    cosine of at least ``min_cosine`` (ties: smaller node)."""
    numbers = term_numbers(nodes)
    dealt, pairs = deal_blocks(prefix_postings(nodes, min_cosine, numbers), min_cosine, block or block_rows(nodes))
    idf = numbers[1]
    kind = nodes.schema["node"].dataType
    out = T.StructType([T.StructField("node", kind), T.StructField("other", kind), T.StructField("sim", T.DoubleType())])
    pairs = cut_lineage(pairs, "similar-pairs")
    # a block that meets itself comes once
    asks = pairs.select("tid", F.col("l").alias("blk"), "l", "r", F.lit(0).alias("side")).unionByName(
        pairs.where("l < r").select("tid", F.col("r").alias("blk"), "l", "r", F.lit(1).alias("side")))
    groups = dealt.join(asks, ["tid", "blk"]).groupBy("tid", "l", "r")

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node").reset_index(drop=True)
        names, itself = rows["node"].to_numpy(), key[1] == key[2]
        tiles = []                                      # of a side: its rows' places and their vectors, the longest rests first
        for side in (0,) if itself else (0, 1):
            mine = rows[rows["side"] == side].sort_values("b", ascending=False)
            tiles.append([(mine.index[s:s + TILE].to_numpy(), _Side(mine.iloc[s:s + TILE], idf)) for s in range(0, len(mine), TILE)])
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for x, (mine, left) in enumerate(tiles[0]):
            for y, (theirs, right) in enumerate(tiles[-1]):
                if itself and y < x or left.a * right.a + left.b * right.b < min_cosine - SLACK:
                    continue
                i, j, sims = _near_pairs(left, right, int(key[0]), min_cosine, itself and x == y)
                i, j = mine[i], theirs[j]
                found += [_best(i, j, sims, k), _best(j, i, sims, k)]
        i, j, sims = _best(*(np.concatenate(c) for c in zip(*found)), k)
        return pd.DataFrame({"node": names[i], "other": names[j], "sim": sims})

    found = groups.applyInPandas(compare, out)
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def cosine_topk(stats: TermStats, k: int = 5, min_cosine: float = 0.5, max_features: int = 1000,
                block: int | None = None) -> DataFrame:
    """``(id, rank, other, cosine)``: for each row of ``stats`` the ``k`` other rows
    of the largest cosine (rounded to ``DIGITS`` places), at least ``min_cosine``,
    ties to the smaller id.

    ``min_cosine`` must be above 0: rows without a common term are not similar.
    Rows without a term of the vocabulary have no similar rows; rows with equal
    terms and counts are similar by 1.0."""
    if not 0 < min_cosine <= 1:
        raise ValueError("min_cosine must be above 0, at most 1")
    rows, nodes = vector_nodes(stats, max_features)
    near = cut_lineage(similar_nodes(nodes, k, min_cosine, block), "similar-nodes-best")
    members = rows.withColumn("place", F.row_number().over(Window.partitionBy("key").orderBy("i"))).where(F.col("place") <= k + 1)
    members = cut_lineage(members.join(nodes.select("node", "key"), "key").select("node", "i", "place"), "similar-members")
    own = members.select("node", F.col("i").alias("other"), F.lit(1.0).alias("sim"))
    theirs = (near.join(members.where(F.col("place") <= k).select(F.col("node").alias("other"), "i"), "other")
              .select("node", F.col("i").alias("other"), "sim"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    # one more than asked for: a row's own id may be among its node's best
    best = own.unionByName(theirs).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = best.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("place", "other", "sim"))).alias("best"))
    lists = cut_lineage(lists.join(nodes.select("node", "key", "n"), "node").select("key", "n", "best"), "similar-lists")
    # vectors of a thousandth of the rows, a thousand of them at most, are broadcast
    least = (nodes.agg(F.sum("n")).first()[0] or 0) // HEAVY
    heavy, light = lists.where(F.col("n") > least), lists.where(F.col("n") <= least)
    met = (rows.join(F.broadcast(heavy.select("key", F.col("best").alias("often"))), "key", "left"))
    joined = met.where("often is not null").select("i", F.col("often").alias("best")).unionByName(
        met.where("often is null").join(light.select("key", "best"), "key").select("i", "best"))
    rest = F.slice(F.filter("best", lambda x: x["other"] != F.col("i")), 1, k)
    found = joined.select("i", F.posexplode(rest).alias("at", "x"))
    return found.select(F.col("i").alias(stats.id_col), (F.col("at") + 1).alias("rank"), F.col("x.other").alias("other"),
                        F.col("x.sim").alias("cosine"))
