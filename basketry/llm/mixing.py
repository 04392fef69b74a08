"""Mixing sources to target weights by balanced (cube method) sampling.

Every source gets a target number of words.  A document's rate is its source's
target over the source's words; the whole part of the rate is how often each
document is taken anyway, the fraction is its inclusion probability.  The cube
method turns these fractions into 0 or 1 while the number of documents and the
number of words stay balanced: three open documents have a direction in which
both totals do not move, and a step along it settles at least one of them with
its probability kept (the flight).

The flight runs block by block.  A source is dealt into hash blocks of about
``block_rows`` documents; a block streams through one task with three open
documents in memory, longest first, and leaves at most two open.  The open ones
of all blocks of a source are the next, far smaller level.  When a source is
down to one block, its open documents are settled by a landing that passes the
words it is off by on to the shortest documents, which were kept back for it.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import WORD_PATTERN, partition_ranks
from basketry.session import cut_lineage

MASK = (1 << 64) - 1
EPS = 1e-9
TAIL = 512        # short documents that wait for a source's landing


def word_count(text: str = "text") -> Column:
    """Words of a text as a bigint; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def _uniform(x: int) -> float:
    """A fixed draw from [0, 1) for a 64-bit key."""
    x = (x + 0x9E3779B97F4A7C15) & MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return ((x ^ (x >> 31)) >> 11) / 9007199254740992.0


def _step(units: list, draw: float) -> None:
    """Move the probabilities of three open units (or two of equal size) along
    the direction that keeps their sum and their sum of words."""
    sizes = [u[2] for u in units]
    if len(units) == 2:
        way = [1.0, -1.0]
    else:
        s1, s2, s3 = sizes
        way = [s2 - s3, s3 - s1, s1 - s2] if not s1 == s2 == s3 else [1.0, -1.0, 0.0]
        top = max(map(abs, way))
        way = [w / top for w in way]
    up = min((1 - u[1]) / w if w > 0 else u[1] / -w for u, w in zip(units, way) if w)
    down = min(u[1] / w if w > 0 else (1 - u[1]) / -w for u, w in zip(units, way) if w)
    by = up if draw * (up + down) < down else -down
    for u, w in zip(units, way):
        u[1] += by * w


def _settled(p: float) -> bool:
    return p <= EPS or p >= 1 - EPS


def fly(open_units: list, new: list, step_seed: int) -> tuple[list, int]:
    """Run the flight over ``new`` units ``[row, probability, size, key]``
    after the ``open_units`` carried so far.  Settled units get exactly 0 or 1;
    returns the units still open (two at most, of different sizes)."""
    for u in new:
        if _settled(u[1]):
            u[1] = round(u[1])
            continue
        open_units.append(u)
        while len(open_units) == 3 or len(open_units) == 2 and open_units[0][2] == open_units[1][2]:
            step_seed += 1
            _step(open_units, _uniform(u[3] ^ (step_seed * 0x9E3779B97F4A7C15 & MASK)))
            left = []
            for x in open_units:
                if _settled(x[1]):
                    x[1] = round(x[1])
                else:
                    left.append(x)
            open_units = left
    return open_units, step_seed


def _settle(units: list) -> None:
    """Settle one or two open units: of the joint outcomes that keep both
    probabilities, the extreme one with the least expected squared error."""
    if len(units) == 1:
        u = units[0]
        u[1] = int(_uniform(u[3]) < u[1])
        return
    a, b = units
    mean = a[1] * a[2] + b[1] * b[2]
    cost = {(i, j): (i * a[2] + j * b[2] - mean) ** 2 for i in (0, 1) for j in (0, 1)}
    together = cost[1, 1] + cost[0, 0] < cost[1, 0] + cost[0, 1]
    both = min(a[1], b[1]) if together else max(0.0, a[1] + b[1] - 1)
    chances = {(1, 1): both, (1, 0): a[1] - both, (0, 1): b[1] - both}
    draw, taken = _uniform(a[3] ^ b[3] ^ MASK), (0, 0)
    for pair, chance in chances.items():
        if draw < chance:
            taken = pair
            break
        draw -= chance
    a[1], b[1] = taken


def land(units: list) -> None:
    """The landing, over a source's last open units and the short documents
    kept back for it, longest first.  The longest eighth flies; what it leaves
    open is settled at random, and the words this is off by are taken from (or
    given to) the probabilities of all shorter ones, in proportion, so that in
    expectation none changes.  Then these go the same way, down to
    the shortest document."""
    units = [u for u in units if not _settled(u[1])]
    while units:
        cut = (len(units) + 7) // 8
        head, units = units[:cut], units[cut:]
        left, _ = fly([], head, 0)
        if not left:
            continue
        before = sum(u[1] * u[2] for u in left)
        _settle(left)
        off = sum(u[1] * u[2] for u in left) - before
        room = sum((u[1] if off > 0 else 1 - u[1]) * u[2] for u in units)
        part = min(1.0, abs(off) / room) if room else 0.0
        for u in units:
            u[1] = u[1] * (1 - part) if off > 0 else 1 - (1 - u[1]) * (1 - part)
            if _settled(u[1]):
                u[1] = round(u[1])


def _flight_pass(batches):
    """Arrow pass over partitions sorted by group, longest documents first; the
    columns ``__group``, ``__prob``, ``__size``, ``__key`` and ``__last``
    (whether the group is its source's only one) steer it, everything else
    passes through.  ``__prob`` comes out as 0 or 1, or in between for the (two
    at most) units that a group leaves open.  Rows wait here while their unit
    is open or among the ``TAIL`` shortest so far of a last group."""
    group, last, flying, tail, seed, held = None, False, [], [], 0, None

    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch])
        n_held = 0 if held is None else held.num_rows
        groups = table.column("__group").to_pylist()
        prob = table.column("__prob").to_numpy().copy()
        sizes = table.column("__size").to_numpy()
        keys = table.column("__key").to_numpy().view(np.uint64)
        lasts = table.column("__last").to_pylist()
        units_here = flying + tail
        for i, u in enumerate(units_here):
            u[0] = i
        at = n_held
        while at < len(groups):
            if groups[at] != group:
                if last:
                    land(flying + tail)
                group, last, flying, tail, seed = groups[at], lasts[at], [], [], 0
            end = at
            while end < len(groups) and groups[end] == group:
                end += 1
            new = [[i, float(prob[i]), int(sizes[i]), int(keys[i])] for i in range(at, end)]
            units_here += new
            if last:
                tail += new
                new, tail = tail[:-TAIL], tail[-TAIL:]
            flying, seed = fly(flying, new, seed)
            at = end
        for u in units_here:
            prob[u[0]] = u[1]
        out = table.set_column(table.column_names.index("__prob"), "__prob", pa.array(prob))
        wait = [u[0] for u in flying + tail]
        held = out.take(pa.array(wait, pa.int64())).combine_chunks().to_batches()[0] if wait else None
        if wait:
            go = np.ones(len(groups), bool)
            go[wait] = False
            out = out.filter(pa.array(go))
        yield from out.to_batches()
    if held is not None:
        if last:
            land(flying + tail)
        i = held.schema.get_field_index("__prob")
        yield held.set_column(i, "__prob", pa.array([float(u[1]) for u in flying + tail]))


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: str = "1.5", cap: int = 2) -> DataFrame:
    """Per source ``(__source, __docs, __source_size, __target)``.  Sources by
    code point (null last) get the weights in turn and share ``share`` times
    all words by weight; a target stops at ``cap`` times its source's words and
    the excess is shared out again until none is above.  ``sizes`` has
    ``__source`` and ``__size``.  The driver holds three numbers a round."""
    stats = sizes.groupBy("__source").agg(F.count(F.lit(1)).alias("__docs"), F.sum("__size").alias("__source_size"))
    ranked = partition_ranks(stats, [F.col("__source").asc_nulls_last()], "__rank", "mix-sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("__rank") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(ranked.withColumn("__weight", weight.cast("bigint")), "mix-sources")
    most = (F.col("__source_size") * cap).cast("decimal(38,0)")
    total = ranked.agg(F.sum(F.col("__source_size").cast("decimal(38,0)"))).first()[0]
    total = Fraction(share) * int(total or 0)
    unit, capped = None, -1
    while True:
        above = F.lit(False) if unit is None else most.cast("double") <= F.lit(float(unit)) * F.col("__weight")
        n, spent, w = ranked.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, most)),
            F.sum(F.when(~above, F.col("__weight").cast("decimal(38,0)")))).first()
        if n == capped or not w:
            break
        capped, unit = n, (total - int(spent or 0)) / int(w)
    target = F.least(most.cast("double"), F.lit(float(unit or 0)) * F.col("__weight"))
    return ranked.select("__source", "__docs", "__source_size", target.alias("__target"))


def mix_sources(docs: DataFrame, size: Column | None = None, source: str = "source", weights=(3, 1, 2),
                share: str = "1.5", cap: int = 2, block_rows: int = 4_096) -> DataFrame:
    """``docs`` with five columns more: ``mix_size`` (words), ``mix_source_size``,
    ``mix_target`` (both of the source), ``mix_copies`` (how often the mix takes
    the document, 0 to ``cap``) and ``mix_taken`` (words taken, copies counted).

    Defined results: a null source is a source of its own and sorts last; a
    null or empty text has size 0 and counts as a document only; a source
    without words has target 0 and nothing is taken from it; repeated rows are
    separate documents; an empty table gives an empty result.  The draw of a
    document depends on the values of its row, so reruns agree whatever the
    partitions.  Columns of the input keep their names; one called like an
    output column is replaced."""
    size = word_count() if size is None else size
    added = ("mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_taken")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    flat = [F.col(f"`{f.name}`") if not isinstance(f.dataType, (T.MapType, T.VariantType)) else F.to_json(f"`{f.name}`")
            for f in docs.schema.fields]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), size.alias("__size"),
                       F.col(f"`{source}`").alias("__source"), F.xxhash64(*flat).alias("__key"))
    targets = cut_lineage(source_targets(rows, weights, share, cap), "mix-targets")
    some = F.col("__source_size") > 0
    rate = F.when(some, F.col("__target") / F.when(some, F.col("__source_size"))).otherwise(0.0)
    # equal sources share a hash, so the null source joins like any other
    named = lambda df: df.withColumn("__name", F.coalesce(F.concat(F.lit("s"), F.col("__source")), F.lit("n")))
    rows = (named(rows).drop("__source").join(named(targets).drop("__source"), "__name")
            .withColumn("__rate", rate).withColumn("__whole", F.floor("__rate").cast("int"))
            .withColumn("__prob", (F.col("__rate") - F.col("__whole")).cast("double")))
    done, level, n_left = None, 0, F.col("__docs")
    while True:
        blocks = F.ceil(n_left / block_rows)
        block = F.pmod(F.xxhash64(F.lit(level), "__key"), blocks)
        now = (rows.withColumn("__last", blocks <= 1)
               .withColumn("__group", F.concat_ws(":", block.cast("string"), "__name")))
        now = now.drop("__left")
        now = now.repartition(F.col("__group")).sortWithinPartitions("__group", F.col("__size").desc(), "__key")
        out = cut_lineage(now.mapInArrow(_flight_pass, now.schema), f"mix-level{level}")
        open_now = (F.col("__prob") > 0) & (F.col("__prob") < 1)
        settled = out.where(~open_now).drop("__group", "__last")
        done = settled if done is None else done.unionByName(settled)
        left = out.where(open_now)
        counts = left.groupBy("__name").agg(F.count(F.lit(1)).alias("__left"))
        if counts.isEmpty():
            break
        rows = left.drop("__group", "__last").join(counts, "__name")
        n_left, level = F.col("__left"), level + 1
    copies = (F.col("__whole") + F.col("__prob").cast("int")).cast("int")
    return done.select("__row.*", F.col("__size").alias("mix_size"), F.col("__source_size").alias("mix_source_size"),
                       F.col("__target").alias("mix_target"), copies.alias("mix_copies"),
                       (F.col("__size") * copies).alias("mix_taken"))


def take_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, without the
    ``mix_`` columns.

    Defined results: a row of 0 or null copies is left out; equal rows are copied
    one by one; an empty table stays empty; other columns stay as they are."""
    return (mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("mix_copies"))))
            .drop("__copy", "mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_taken"))
