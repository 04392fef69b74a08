"""Quality scoring with a factorisation machine.

A document's features are its words, hashed to ``BUCKETS`` places and weighed by
the logarithm of their counts (scaled to length 1), and a few statistics of its
structure and metadata, standardised on the training rows.  With weights w and
factors v of rank k the machine scores

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

and the pairwise part is computed in linear time as
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

The model is fitted on a bounded sample of labelled rows (``MAX_ROWS``, chosen by
a hash of the id); their features, not their texts, come to the driver, at most
``BUCKETS`` numbers a row.  Every text is scored whole, in one pass.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import extended, hash_bound, rest_and, small, with_rest, word_runs

BUCKETS = 1 << 13
RANK = 8
MAX_ROWS = 12_000
EPOCHS = 15
MEMO = 100_000
UPPER = bytes(range(65, 91))
DIGIT = bytes(range(48, 58))
MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
ENDS = b".,;:?"
N_STATS = 14


class Featuriser:
    """Features of texts; keeps the places of the words seen last."""

    def __init__(self):
        self.places: dict[bytes, int] = {}

    def __call__(self, text: bytes | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, values and raw statistics of one UTF-8 text."""
        text, places = text or b"", self.places
        counts, n_words, same, letters_in_words, before = None, 0, 0, 0, None
        shouting = marked = 0
        for run in word_runs(text):
            if len(places) > MEMO:
                places.clear()
            at = []
            for w in run:
                p = places.get(w)
                if p is None:
                    p = places[w] = self.place(w)
                at.append(p)
            row = np.array(at, np.int64)
            n_words += len(row)
            shouting += int((row >> 32 & 1).sum())
            marked += int((row >> 33).sum())
            row &= 0xFFFFFFFF
            if len(row):
                same += int((row[1:] == row[:-1]).sum()) + int(before == row[0])
                before = row[-1]
            found = np.bincount(row, minlength=BUCKETS)
            counts = found if counts is None else counts + found
        size = max(1, len(text))
        share = lambda some: (len(text) - len(text.translate(None, some))) / size
        lines = [x for x in text.split(b"\n") if x]
        distinct = int(np.count_nonzero(counts))
        where = np.nonzero(counts)[0]
        value = np.log1p(counts[where])
        value = value / max(1e-9, float(np.sqrt((value * value).sum())))
        top = int(counts.max()) if n_words else 0
        words = max(1, n_words)
        stats = np.array([
            np.log1p(len(text)), np.log1p(n_chars if n_chars and n_chars > 0 else 0), share(UPPER), share(DIGIT),
            share(MARKS), share(ENDS), share(b"\n"), len(text) / words, distinct / words, top / words, same / words,
            shouting / words, marked / words, 1 - len(set(lines)) / max(1, len(lines))])
        return where.astype(np.int32), value.astype(np.float32), stats

    @staticmethod
    def place(word: bytes) -> int:
        """The hashed place, and above it whether the word shouts (over one
        letter, all capitals) and whether it ends in something odd."""
        core = word.strip(MARKS)
        shout = len(core) > 1 and core.isupper()
        odd = bool(word) and word[-1] in MARKS and word[-1] not in ENDS
        return zlib.crc32(word.lower()) % BUCKETS | shout << 32 | odd << 33


@dataclass
class Machine:
    bias: float
    weights: np.ndarray        # BUCKETS + N_STATS
    factors: np.ndarray        # (BUCKETS + N_STATS, RANK)
    mean: np.ndarray
    scale: np.ndarray

    def row(self, where, value, stats):
        """Places and values with the standardised statistics after the words."""
        s = np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(N_STATS)
        return np.concatenate([where, BUCKETS + np.arange(N_STATS)]), np.concatenate([value, s])

    def score(self, where, value, stats) -> float:
        i, x = self.row(where, value, stats)
        v = self.factors[i] * x[:, None]
        s = v.sum(axis=0)
        z = self.bias + self.weights[i] @ x + 0.5 * float(s @ s - (v * v).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_machine(rows: list, rank: int = RANK, epochs: int = EPOCHS, rate: float = 0.1, l2: float = 1e-4,
                batch: int = 128, seed: int = 7) -> Machine:
    """Fit by AdaGrad on the logistic loss.  ``rows``: (places, values,
    statistics, label 0/1).  Without rows of both labels the score is constant:
    the label (smoothed), or 0.5 without rows."""
    n = BUCKETS + N_STATS
    rng = np.random.default_rng(seed)
    ones = sum(r[3] for r in rows)
    prior = (ones + 0.5) / (len(rows) + 1)
    machine = Machine(float(np.log(prior / (1 - prior))), np.zeros(n), np.zeros((n, rank)), np.zeros(N_STATS), np.ones(N_STATS))
    if not 0 < ones < len(rows):
        return machine
    stats = np.array([r[2] for r in rows])
    machine.mean, machine.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    machine.factors = rng.normal(0, 0.05, (n, rank))
    w, v = machine.weights, machine.factors
    gw, gv, gb = np.full(n, 1e-3), np.full((n, rank), 1e-3), 1e-3
    data = [machine.row(*r[:3]) for r in rows]
    label = np.array([r[3] for r in rows], float)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            some = order[at:at + batch]
            i = np.concatenate([data[d][0] for d in some])
            x = np.concatenate([data[d][1] for d in some])
            sizes = np.array([len(data[d][0]) for d in some])
            starts = np.cumsum(sizes) - sizes
            doc = np.repeat(np.arange(len(some)), sizes)
            vx = v[i] * x[:, None]
            s = np.add.reduceat(vx, starts)
            pair = 0.5 * ((s * s).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), starts))
            z = machine.bias + np.add.reduceat(w[i] * x, starts) + pair
            off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[some]) / len(some)
            # gradients, summed over the batch at each place touched
            places, back = np.unique(i, return_inverse=True)
            dw = np.bincount(back, off[doc] * x, len(places)) + l2 * w[places] / len(some)
            each = off[doc][:, None] * x[:, None] * (s[doc] - vx)
            dv = np.stack([np.bincount(back, each[:, f], len(places)) for f in range(rank)], axis=1) + l2 * v[places] / len(some)
            gw[places] += dw * dw
            gv[places] += dv * dv
            w[places] -= rate * dw / np.sqrt(gw[places])
            v[places] -= 0.3 * rate * dv / np.sqrt(gv[places])
            db = off.sum()
            gb += db * db
            machine.bias -= rate * db / np.sqrt(gb)
    return machine


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
        n_chars: str = "n_chars", max_rows: int = MAX_ROWS) -> Machine:
    """Fit on the labelled rows of ``docs``, on about ``max_rows`` (a share of
    the ids by hash, then the first by hash) if there are more.

    Defined results: rows without an id, without a label of 0 or 1 or without a
    partner in the other table are not learnt from; a null text is an empty one,
    texts are read whole; a repeated id is a row for each pair; without rows the
    machine scores a constant; other columns are not read."""
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(label).cast("int").alias("label"))
    total = marks.count()
    share = min(1.0, 1.2 * max_rows / max(1, total))
    chosen = F.xxhash64("k") <= hash_bound(share)
    some = docs.select(F.col(key).alias("k"), F.encode(F.col(text), "UTF-8").alias("t"),
                       F.col(n_chars).cast("bigint").alias("n")).where(chosen).join(marks.where(chosen), "k")

    def run(batches):
        featuriser = Featuriser()
        for batch in small(batches):
            k, t, n, y = (batch.column(c).to_pylist() for c in ("k", "t", "n", "label"))
            found = [featuriser(a, b) for a, b in zip(t, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, batch.column("k").type), pa.array(y, pa.int32()),
                 *[pa.array([f[c].tobytes() for f in found], pa.binary()) for c in range(3)]],
                ["k", "label", "places", "x", "stats"])

    kind = marks.schema["k"].dataType.simpleString()
    made = some.mapInArrow(run, f"k {kind}, label int, places binary, x binary, stats binary")
    first = made.orderBy(F.xxhash64("k"), "k", "label", "stats").limit(max_rows).collect()
    return fit_machine([(np.frombuffer(r.places, np.int32), np.frombuffer(r.x, np.float32),
                         np.frombuffer(r.stats), r.label) for r in first])


def score(docs: DataFrame, machine: Machine, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The columns of ``docs`` but the text, and ``quality_score`` (0 to 1).

    Defined results: a null text scores like an empty one (no words, all
    statistics 0), a long one is read whole; an empty table gives an empty
    result; a null length counts as 0; repeated rows score alike; an
    input column called ``quality_score`` is replaced."""
    given = F.struct(F.encode(F.col(f"`{text}`"), "UTF-8").alias("t"), F.col(f"`{n_chars}`").cast("bigint").alias("n"))
    rows = with_rest(docs, given, [text, "quality_score"])

    def run(batches):
        featuriser = Featuriser()
        for batch in small(batches):
            texts, sizes = (batch.column(1).field(i).to_pylist() for i in (0, 1))
            found = [machine.score(*featuriser(t, n)) for t, n in zip(texts, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["__row", "quality_score"])

    return rest_and(rows.mapInArrow(run, extended(rows.select("__row"), "quality_score double")), ["quality_score"])
