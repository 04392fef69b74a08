"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors become one node with a weight.  A bounded sample gives centres;
   every node goes to the shards of its ``overlap`` closest centres.  A shard
   larger than ``BLOCK`` nodes is dealt into blocks by hash.
2. Build: each block of each shard gets a flat graph.  A node's candidates, its
   nearest ones and some far ones, are pruned robustly: the closest is kept and
   candidates much closer to it than to the node go.  Reverse edges are added.
3. Union: a node's lists from all its shards become one.
4. Search: in each shard every node is searched from the medoids by greedy search
   with a beam; once it meets vectors in range, the search expands through all of
   them.  Blocks of one shard meet in pairs, so a hot shard is many tasks, each of
   two blocks; no task and no row holds a group.
5. Verify: a link is a cosine of at least ``threshold`` in double precision.
   Two nodes that share several shards are linked in the first of them only, so
   each task can count its links and give its local components: pairs of vectors
   are never written out.
6. Audit: for a bounded sample of nodes, drawn until enough of them have links,
   the links are also counted against all vectors.  While the share found of the
   pairs of different nodes, or its mean over the nodes, is below ``min_recall``, the search is repeated
   with one shard more per node and a wider beam.
7. Where the widest search is still below, all links are counted exactly: every
   node is in the blocks of its closest centre and meets every block whose shard
   can hold a vector in range (triangle inequality of angles), by matrix products.
   An audit that fails then is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import hash_bound, components
from basketry.llm.topk import as_matrix, usable
from basketry.session import cut_lineage

BLOCK = 2048
OVERLAP = 3
SAMPLE = 8192                   # vectors that centres are fitted on
MAX_CENTRES = 2048
NEAREST, FAR = 40, 24           # candidates of a node
KEEP_NEAREST, KEEP_FAR = 20, 8  # edges kept of them
ALPHA = 1.2
BEAM = 32
MEDOIDS = 16
AUDIT, MAX_AUDIT = 256, 4096    # nodes whose links are counted exactly
LINKED = 64                     # of them with a link


# ---------------------------------------------------------------- one block

def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, safe from overflow."""
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(top > 0, top, 1)
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def fit_centres(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means over unit rows (in a fixed order)."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.concatenate([np.argmax(x[a:a + 1024] @ centres.T, axis=1) for a in range(0, len(x), 1024)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        filled = np.bincount(near, minlength=k) > 0
        centres = np.where(filled[:, None], unit_rows(sums), centres)
    return centres


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, keep: int, alpha: float = ALPHA) -> np.ndarray:
    """Edges of ``nodes`` out of ``candidates`` (a row each, -1 where none):
    closest first, and each kept edge removes the candidates that are ``alpha``
    times closer to it than to the node.  Returns ``keep`` columns, -1 filled."""
    rows = np.arange(len(nodes))
    there = candidates >= 0
    c = x[np.maximum(candidates, 0)]
    far = np.where(there, 2 - 2 * np.einsum("ncd,nd->nc", c, x[nodes]), np.inf)      # squared distances
    between = 2 - 2 * np.einsum("ncd,nkd->nck", c, c)
    edges = np.full((len(nodes), keep), -1)
    alive = far.copy()
    for e in range(keep):
        best = np.argmin(alive, axis=1)
        some = np.isfinite(alive[rows, best])
        if not some.any():
            break
        edges[some, e] = candidates[rows[some], best[some]]
        gone = alpha * alpha * between[rows, best] <= far
        alive = np.where(gone & some[:, None], np.inf, alive)
        alive[rows, best] = np.inf
    return edges


def build_graph(x: np.ndarray, seed: int = 1) -> list[np.ndarray]:
    """Neighbours of each of the unit rows ``x`` of one block."""
    n = len(x)
    rng = np.random.default_rng(seed)
    found: list = [[] for _ in range(n)]
    for at in range(0, n, 256):
        nodes = np.arange(at, min(n, at + 256))
        sims = x[nodes] @ x.T
        sims[np.arange(len(nodes)), nodes] = -2
        k = min(NEAREST, n - 1)
        if k < 1:
            break
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        far = rng.integers(0, n, (len(nodes), FAR))
        far = np.where(far == nodes[:, None], -1, far)
        edges = np.concatenate([robust_prune(x, nodes, near, KEEP_NEAREST), robust_prune(x, nodes, far, KEEP_FAR)], axis=1)
        for i, row in zip(nodes, edges):
            found[i].append(row[row >= 0])
    out = np.concatenate([np.repeat(i, sum(map(len, f))) for i, f in enumerate(found)] or [np.empty(0, int)]).astype(int)
    to = np.concatenate([e for f in found for e in f] or [np.empty(0, int)]).astype(int)
    a, b = np.concatenate([out, to]), np.concatenate([to, out])
    order = np.unique(a * n + b)
    a, b = order // max(n, 1), order % max(n, 1)
    return np.split(b, np.searchsorted(a, np.arange(1, n))) if n else []


def medoids(x: np.ndarray) -> np.ndarray:
    """The rows closest to the block's mean and to the centres of its parts."""
    centres = np.concatenate([unit_rows(x.mean(axis=0, keepdims=True)), fit_centres(x, min(MEDOIDS, len(x)), 3)])
    return np.unique(np.argmax(x @ centres.T, axis=0))


def range_search(x: np.ndarray, graph: list[np.ndarray], entries: np.ndarray, query: np.ndarray,
                 threshold: float, beam: int) -> np.ndarray:
    """Rows found whose cosine with ``query`` is at least ``threshold``."""
    seen = np.zeros(len(x), bool)
    seen[entries] = True
    ids, sims = entries, x[entries] @ query
    expanded = np.zeros(len(ids), bool)
    while True:                                        # greedy: the best of the beam, some at a time
        if len(ids) > beam:
            top = np.argpartition(-sims, beam - 1)[:beam]
            top = np.union1d(top, np.nonzero(sims >= threshold)[0])
            ids, sims, expanded = ids[top], sims[top], expanded[top]
        open_ = np.nonzero(~expanded)[0]
        if not len(open_):
            break
        near = open_[sims[open_] >= threshold]         # in range: expand all of them at once
        go = near if len(near) else open_[np.argsort(-sims[open_])[:4]]
        expanded[go] = True
        new = np.concatenate([graph[i] for i in ids[go]])
        new = np.unique(new[~seen[new]])
        seen[new] = True
        ids, sims = np.concatenate([ids, new]), np.concatenate([sims, x[new] @ query])
        expanded = np.concatenate([expanded, np.zeros(len(new), bool)])
    return ids[sims >= threshold]


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row reachable over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def first_shared(shards: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest shard that rows a and b share."""
    same = (shards[a][:, :, None] == shards[b][:, None, :]).any(axis=2)
    return np.where(same, shards[a], np.iinfo(np.int64).max).min(axis=1)


# ---------------------------------------------------------------- the jobs

LINKS = "node bigint, links bigint, pairs bigint, root bigint"


def _fit_shards(nodes: DataFrame, n: int, overlap: int, dims: int, block: int) -> np.ndarray:
    """Centres of the shards, fitted on a bounded sample by hash."""
    share = min(1.0, 1.5 * SAMPLE / max(1, n))
    some = (nodes.where(F.col("node_hash") <= hash_bound(share))
            .orderBy("node_hash", "node").limit(SAMPLE).select("v"))
    x = unit_rows(as_matrix(some.toArrow().column("v"), dims))
    return fit_centres(x, max(1, min(MAX_CENTRES, len(x), -(-n * overlap // block))))


def _links(nodes: DataFrame, n: int, dims: int, threshold: float, overlap: int, beam: int, block: int) -> DataFrame:
    """``LINKS``: per node and task that found links, their number by weight and
    by nodes, and a node of its local component."""
    centres = _fit_shards(nodes, n, overlap, dims, block)
    overlap = min(overlap, len(centres))

    def assign(batches):
        for batch in batches:
            x = unit_rows(as_matrix(batch.column("v"), dims))
            near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :overlap]
            shards = pa.array(np.sort(near, axis=1).astype(np.int64).tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], [*batch.schema.names, "shards"])

    kinds = "node bigint, weight bigint, v array<double>, shards array<bigint>"
    placed = cut_lineage(nodes.select("node", "weight", "v").mapInArrow(assign, kinds), "graph-shards")
    filed = placed.withColumn("shard", F.explode("shards"))
    sizes = {r[0]: r[1] for r in filed.groupBy("shard").count().collect()}           # MAX_CENTRES rows at most
    blocks = [-(-sizes.get(s, 1) // block) for s in range(len(centres))]
    parts = F.element_at(F.array(*[F.lit(b) for b in blocks]), (F.col("shard") + 1).cast("int"))
    filed = filed.withColumn("blocks", parts).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        x = unit_rows(as_matrix(table.column("v"), dims))
        ids = table.column("node").to_numpy()
        return pa.table({"node": ids, "near": pa.array([ids[g].tolist() for g in build_graph(x)], pa.list_(pa.int64()))})

    lists = filed.select("shard", "block", "node", "v").groupBy("shard", "block").applyInArrow(
        build, "node bigint, near array<bigint>")
    union = (lists.groupBy("node").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near")))
    union = cut_lineage(union, "graph-lists")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tasks = (filed.join(union, "node").withColumn("other", other)
             .select("shard", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     "block", "node", "weight", "v", "shards", "near"))

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        ids, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        x = unit_rows(as_matrix(table.column("v"), dims))
        shards = as_matrix(table.column("shards"), overlap).astype(np.int64)
        shard, i, j = (table.column(c)[0].as_py() for c in ("shard", "i", "j"))
        side = table.column("block").to_numpy()
        near = table.column("near").combine_chunks()
        to, stops = near.flatten().to_numpy(), near.offsets.to_numpy()
        place = np.searchsorted(ids, to)
        place = np.where((place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == to), place, -1)
        found = []
        for mine, asks in ((i, j), (j, i))[:1 if i == j else 2]:
            local = np.nonzero(side == mine)[0]
            if not len(local):
                continue
            back = np.full(len(ids) + 1, -1)
            back[local] = np.arange(len(local))
            steps = back[place]
            graph = [g[g >= 0] for g in (steps[stops[r]:stops[r + 1]] for r in local)]
            entries = medoids(x[local])
            for q in np.nonzero(side == asks)[0]:
                hits = local[range_search(x[local] if len(local) < len(x) else x, graph, entries, x[q], threshold - 1e-12, beam)]
                hits = hits[hits != q]
                found.append(np.minimum(q, hits) * len(ids) + np.maximum(q, hits))
        pairs = np.unique(np.concatenate(found or [np.empty(0, np.int64)]).astype(np.int64))
        a, b = pairs // len(ids), pairs % len(ids)
        good = np.einsum("nd,nd->n", x[a], x[b]) >= threshold
        good &= first_shared(shards, a, b) == shard
        a, b = a[good], b[good]
        links = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
        number = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
        root = local_roots(len(ids), a, b)
        some = links > 0
        return pa.table({"node": ids[some], "links": links[some].astype(np.int64), "pairs": number[some], "root": ids[root[some]]})

    return tasks.groupBy("shard", "i", "j").applyInArrow(search, LINKS)


def _all_links(nodes: DataFrame, n: int, dims: int, threshold: float, overlap: int, block: int) -> DataFrame:
    """As ``_links``, but complete.  A vector within angle t of a member of a
    shard is within t and the shard's radius of its centre, so a node meets the
    blocks of those shards only."""
    centres = _fit_shards(nodes, n, overlap, dims, block)
    angles = lambda x: np.arccos(np.clip(x @ centres.T, -1, 1))
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-6

    def home(batches):
        for batch in batches:
            far = angles(unit_rows(as_matrix(batch.column("v"), dims)))
            shard = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard), pa.array(far[np.arange(len(far)), shard])],
                                             [*batch.schema.names, "shard", "far"])

    placed = cut_lineage(nodes.select("node", "weight", "v").mapInArrow(
        home, "node bigint, weight bigint, v array<double>, shard bigint, far double"), "graph-homes")
    blocks, radius = np.zeros(len(centres), int), np.full(len(centres), -np.inf)
    for shard, count, far in placed.groupBy("shard").agg(F.count(F.lit(1)), F.max("far")).collect():   # MAX_CENTRES rows at most
        blocks[shard], radius[shard] = -(-count // block), far
    first = np.cumsum(blocks) - blocks
    owner = np.repeat(np.arange(len(centres)), blocks)

    def meet_with(batches):
        for batch in batches:
            near = (angles(unit_rows(as_matrix(batch.column("v"), dims))) <= radius + reach)[:, owner]
            shard = batch.column("shard").to_numpy()
            mine = first[shard] + batch.column("place").to_numpy() % blocks[shard]
            near[np.arange(len(near)), mine] = True
            others = pa.array([np.nonzero(row)[0].tolist() for row in near], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("weight"), batch.column("v"), pa.array(mine), others],
                                             ["node", "weight", "v", "block", "others"])

    placed = placed.withColumn("place", F.pmod(F.xxhash64("node"), F.lit(1 << 31)))
    tasks = placed.mapInArrow(meet_with, "node bigint, weight bigint, v array<double>, block bigint, others array<bigint>")
    tasks = tasks.withColumn("other", F.explode("others")).select(
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "weight", "v")

    def count(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        ids, weight, side = (table.column(c).to_numpy() for c in ("node", "weight", "block"))
        x = unit_rows(as_matrix(table.column("v"), dims))
        i, j = (table.column(c)[0].as_py() for c in ("i", "j"))
        asks, answers = np.nonzero(side == i)[0], np.nonzero(side == j)[0]
        links, pairs, root = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.arange(len(ids))
        for at in range(0, len(asks), 256):
            rows = asks[at:at + 256]
            sims = x[rows] @ x[answers].T
            close = sims >= threshold
            a, b = np.nonzero(np.abs(sims - threshold) < 1e-12)            # by one rounding, whatever the block
            close[a, b] = np.einsum("nd,nd->n", x[rows[a]], x[answers[b]]) >= threshold
            close &= rows[:, None] != answers
            links[rows] += close @ weight[answers]
            pairs[rows] += close.sum(axis=1)
            if i != j:
                links[answers] += weight[rows] @ close
                pairs[answers] += close.sum(axis=0)
            a, b = np.nonzero(close)
            a, b = root[rows[a]], root[answers[b]]
            apart = np.unique(a[a != b] * len(ids) + b[a != b])
            if len(apart):
                root = local_roots(len(ids), apart // len(ids), apart % len(ids))[root]
        some = pairs > 0
        return pa.table({"node": ids[some], "links": links[some], "pairs": pairs[some], "root": ids[root[some]]})

    return tasks.groupBy("i", "j").applyInArrow(count, LINKS)


def _exact_links(nodes: DataFrame, n: int, dims: int, threshold: float) -> DataFrame:
    """``(node, exact, others)`` for a sample of nodes: their links counted
    against all nodes, by weight and by nodes.  The sample grows from ``AUDIT``
    nodes until ``LINKED`` of them have a link, or it has ``MAX_AUDIT``."""
    size = AUDIT
    while True:
        some = nodes.orderBy(F.xxhash64("node_hash"), "node").limit(size).select("node", "v").toArrow()
        ids, x = some.column("node").to_numpy(), unit_rows(as_matrix(some.column("v"), dims))

        def count(batches, ids=ids, x=x):
            total, others = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for batch in batches:
                weight, own = batch.column("weight").to_numpy(), batch.column("node").to_numpy()
                y = unit_rows(as_matrix(batch.column("v"), dims))
                for at in range(0, len(y), 2048):
                    close = (y[at:at + 2048] @ x.T >= threshold) & (own[at:at + 2048, None] != ids)
                    total += weight[at:at + 2048] @ close
                    others += close.sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total), pa.array(others)], ["node", "exact", "others"])

        exact = (nodes.select("node", "weight", "v").mapInArrow(count, "node bigint, exact bigint, others bigint")
                 .groupBy("node").agg(F.sum("exact").alias("exact"), F.sum("others").alias("others")))
        exact = cut_lineage(exact, "graph-audit")
        if size >= min(n, MAX_AUDIT) or exact.where("others > 0").count() >= LINKED:
            return exact
        size = min(4 * size, MAX_AUDIT)


def audited(exact: DataFrame, counted: DataFrame) -> tuple[float, float]:
    """Shares of the audited nodes' links found: of all pairs of nodes, and the
    mean over the nodes that have any, so no large group hides the others."""
    both = exact.where("others > 0").join(counted, "node", "left").select("others", F.coalesce("pairs", F.lit(0)).alias("pairs"))
    pairs, nodes = both.agg(F.sum("pairs") / F.sum("others"), F.avg(F.col("pairs") / F.col("others"))).first()
    return (1.0, 1.0) if pairs is None else (pairs, nodes)


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.95,
                    overlap: int = OVERLAP, beam: int = BEAM, block: int = BLOCK, min_recall: float = 0.97,
                    tries: int = 3) -> DataFrame:
    """One row per vector: ``key``, ``n_links`` (other vectors linked directly),
    ``component`` (smallest key reachable over links, its own included), ``kept``
    (the key is its component's) and ``exact_links`` (for copies of audited
    vectors: the true number of links; null for the others).

    Defined results: vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing; a vector shorter than the longest
    counts as filled with zeros; equal vectors link with each other; a row with a
    null key links with nothing, has the component null and is kept; repeated
    rows link like any equal vectors; an empty table gives an empty result;
    columns other than the two named are not read."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias("k"), v.alias("v"))
    joins = usable("v") & F.exists("v", lambda x: x != 0) & F.col("k").isNotNull()
    rows = rows.select("k", F.when(joins, F.col("v")).alias("v"))
    hashes = [F.xxhash64(F.lit(s), F.transform("v", lambda x: x + F.lit(0.0))) for s in (1, 2)]
    rows = rows.withColumn("h", F.when(F.col("v").isNotNull(), hashes[0])).withColumn("g", F.when(F.col("v").isNotNull(), hashes[1]))
    nodes = (rows.where("v is not null").groupBy("h", "g")
             .agg(F.min("k").alias("low"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")))
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()).withColumnRenamed("h", "node_hash"),
                        "graph-nodes")
    n, dims = nodes.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    kind = vectors.schema[key].dataType.simpleString()
    if n == 0:
        return rows.select(F.col("k").alias(key), F.lit(0).cast("bigint").alias("n_links"), F.col("k").alias("component"),
                           F.lit(True).alias("kept"), F.lit(None).cast("bigint").alias("exact_links"))
    exact = _exact_links(nodes, n, dims, threshold)
    for attempt in range(tries + 1):
        if attempt < tries:
            links = _links(nodes, n, dims, threshold, overlap + attempt, beam << attempt, block)
        else:
            links = _all_links(nodes, n, dims, threshold, overlap, block)
        links = cut_lineage(links, "graph-links")
        counted = links.groupBy("node").agg(F.sum("links").alias("links"), F.sum("pairs").alias("pairs"))
        recall = audited(exact, counted)
        if min(recall) >= min_recall:
            break
    else:
        raise RuntimeError(f"near-duplicate links: the audit found shares of {recall} (pairs, mean of nodes)")
    roots = components(links.where("node <> root"), "node", "root", "graph")
    ids = nodes.select("node", "low", "weight", F.col("node_hash").alias("h"), "g")
    ids = ids.join(counted.drop("pairs"), "node", "left").join(roots, "node", "left").join(exact.drop("others"), "node", "left")
    ids = ids.withColumn("root", F.coalesce("root", "node"))
    lows = ids.groupBy("root").agg(F.min("low").alias("component"))
    ids = ids.join(lows, "root").select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                                        "component", (F.col("exact") + F.col("weight") - 1).alias("exact_links"))
    found = rows.where("v is not null").select("k", "h", "g").join(ids, ["h", "g"])
    none = rows.where("v is null").select("k", F.lit(0).cast("bigint").alias("n_links"), F.col("k").alias("component"),
                                          F.lit(None).cast("bigint").alias("exact_links"))
    out = found.select("k", "n_links", "component", "exact_links").unionByName(none)
    return out.select(F.col("k").cast(kind).alias(key), "n_links", "component",
                      F.coalesce(F.col("k") == F.col("component"), F.lit(True)).alias("kept"), "exact_links")
