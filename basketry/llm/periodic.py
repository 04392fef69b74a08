"""Runs of periodically repeated words by a dictionary of basic factors.

A text's words are numbered, and so are its factors of 2, 4, 8 ... words: the
number of a factor of 2^(k+1) words is that of its two halves of 2^k.  Factors
that stand in a text once only are left out, since nothing longer that starts
there can recur either; on prose little is left after a few lengths.

At each length, a place's successor is the next place with the same factor.
Successors at most two lengths away whose own successors are as far again are
arithmetic progressions, and their difference is a proposed period.  A run of
period p, at least four periods long, shows itself so at every length from p / 2
to 2 p: all places of it at which the factor recurs within it have the successor
p further on.  For lengths below p these places can be interrupted, so proposals
of one period that overlap by a period are united, extended word by word to both
sides (less than a period and a factor) and made distinct.

The documents of an Arrow slice are one array of numbers, in which words of
different documents differ, so each step is a few array operations for a thousand
texts; the slice's work memory is in proportion to its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import extended

MIN_LENGTH = 6
MIN_EXPONENT = 4
SLICE_ROWS = 512
SLICE_BYTES = 1 << 23


def _named(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (ascending) whose key recurs, the numbers of their keys, and the
    index of each place's successor among them (-1 where it has none)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    alone = new.copy()
    alone[:-1] &= new[1:]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    kept = np.ones(len(keys), bool)
    kept[order[alone]] = False
    where = np.cumsum(kept) - 1
    after = np.full(len(keys), -1, np.int64)
    same = ~new[1:]
    after[order[:-1][same]] = where[order[1:][same]]
    return places[kept], number[kept], after[kept]


def _number_at(places: np.ndarray, number: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The numbers of the factors at ``wanted`` places; a factor that does not
    recur has one of its own."""
    at = np.searchsorted(places, wanted)
    at[at == len(places)] = 0
    return np.where(places[at] == wanted, number[at], -1 - wanted)


def _extended(words: np.ndarray, at: np.ndarray, shift: np.ndarray, step: int) -> np.ndarray:
    """How far each ``at`` can move by ``step`` (1 or -1) while the word there
    equals the one ``shift`` further on."""
    moved = np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    while len(left):
        here = at[left] + step * moved[left]
        inside = (here >= 0) & (here + shift[left] < len(words))
        here, left = here[inside], left[inside]
        left = left[words[here] == words[here + shift[left]]]
        moved[left] += 1
    return moved


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """All runs ``(start, length, period)`` of an array of numbers, by start and
    period: the maximal stretches of at least ``min_length`` words and
    ``min_exponent`` (4 or more) times their smallest period."""
    if min_exponent < 4:
        raise ValueError("three occurrences in a row prove runs of four periods or more")
    words = np.asarray(words, np.int64)
    found = [np.empty((0, 3), np.int64)]
    places, number, after = _named(words, np.arange(len(words)))
    size = 1
    while len(places):
        apart = np.where(after >= 0, places[after] - places, 0)
        again = np.where(after >= 0, apart[after], 0)
        hit = np.nonzero((apart > 0) & (apart <= 2 * size) & (again == apart))[0]
        # a period longer than the factor: the factors that end with it fill the gap
        wide = apart[hit] > size
        ends = places[hit] + apart[hit] - size
        hit = hit[~wide | (_number_at(places, number, ends) == _number_at(places, number, ends + apart[hit]))]
        if len(hit):
            start, period = places[hit], apart[hit]
            end = start + 2 * period + size             # three occurrences
            order = np.lexsort((start, period))
            start, period, end = start[order], period[order], end[order]
            # of one period and overlapping by a period: one stretch
            new = np.ones(len(start), bool)
            new[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > end[:-1])
            first = np.nonzero(new)[0]
            last = np.append(first[1:], len(start)) - 1
            start, period, end = start[first], period[first], end[last]
            start = start - _extended(words, start - 1, period, -1)
            end = end + _extended(words, end - period, period, 1)
            long = (end - start >= min_length) & (end - start >= min_exponent * period)
            found.append(np.stack([start, end - start, period], 1)[long])
        # the factors of twice the size: both halves recur
        half = np.searchsorted(places, places + size)
        half[half == len(places)] = 0
        both = places[half] == places + size
        places, number, after = _named(number[both] * (int(number.max()) + 1) + number[half[both]], places[both])
        size *= 2
    found = np.unique(np.concatenate(found), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _slices(batches, column: int):
    """Slices of batches: ``SLICE_ROWS`` rows and about ``SLICE_BYTES`` of text at
    most, but one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            ends = np.cumsum(sizes[at:at + SLICE_ROWS])
            n = max(1, int(np.searchsorted(ends, SLICE_BYTES, "right")))
            yield batch.slice(at, n)
            at += n


def collapse(texts: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> tuple[list, list, list]:
    """For UTF-8 texts: numbers of words, runs (lists of ``(start, length,
    period)``) and the texts with each run cut to its first period, words joined
    by one space."""
    split = [t.split() if t else [] for t in texts]
    numbers: dict = {}
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.int64)
    sizes = np.array([len(ws) for ws in split], np.int64)
    ends = np.cumsum(sizes)
    # words of different documents differ
    flat += len(numbers) * np.repeat(np.arange(len(split)), sizes)
    runs = find_runs(flat, min_length, min_exponent)
    doc = np.searchsorted(ends, runs[:, 0], "right")
    lists: list = [[] for _ in texts]
    drop: dict = {}
    for (start, length, period), d in zip(runs.tolist(), doc.tolist()):
        start -= int(ends[d] - sizes[d])
        lists[d].append((start, length, period))
        drop.setdefault(d, np.zeros(sizes[d] + 1, np.int64))
        drop[d][start + period] += 1
        drop[d][start + length] -= 1
    for d, marks in drop.items():
        split[d] = [w for w, inside in zip(split[d], np.cumsum(marks).tolist()) if not inside]
    return sizes.tolist(), lists, [b" ".join(ws) for ws in split]


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """The columns of ``docs`` but the text, and ``n_words``, ``runs`` (an array of
    ``start``, ``length``, ``period`` in words, by start, then period) and
    ``collapsed``, the text with each run cut to its first period and its words
    joined by one space.

    Defined results: a null text has no words, no runs and an empty collapsed
    text, as has an empty one; repeated rows stay repeated; runs of different
    periods may overlap, and a word goes if any of them drops it; an empty table
    gives an empty result; input columns called like an output column are
    replaced, others may have any name; a very long text is one slice."""
    added = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    names = ("n_words", "runs", "collapsed")
    # other columns travel as one, whatever their names
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in names])
    rows = docs.select(rest.alias("__row"), F.encode(F.col(f"`{text}`"), "UTF-8").alias("__text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in _slices(batches, 1):
            sizes, runs, texts = collapse(batch.column(1).to_pylist(), min_length, min_exponent)
            found = [[{"start": s, "length": n, "period": p} for s, n, p in some] for some in runs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, kind),
                 pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], ["__row", *names])

    return rows.mapInArrow(run, extended(rows.select("__row"), added)).select("__row.*", *names)


def plant_runs(key: str, text: str):
    """``text`` with, for a tenth of the keys, its words from a place on replaced
    by copies of the first few of them.  With h = crc32 of the key as text and
    g = h // 10: where h % 10 = 0, word i >= a becomes word a + (i - a) % p, with
    a = g % n and p = 1 + (n - a) // (3 + g % 8)."""
    h = F.crc32(F.col(f"`{key}`").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(F.col(f"`{text}`"), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def planted(ws):
        n = F.size(ws)
        a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        copy = lambda w, i: F.when(i < a, w).otherwise(F.get(ws, a + F.pmod(i - a, p)))
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(F.transform(ws, copy), " "))

    # the words are a bound variable, so the text is split once
    made = F.element_at(F.transform(F.array(words), planted), 1)
    return F.when((h % 10 == 0) & F.col(f"`{text}`").isNotNull(), made).otherwise(F.col(f"`{text}`"))
