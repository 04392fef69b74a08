"""Language identification by compression.

Each language gets a raw-content zstandard dictionary of its own prose.  A text
is encoded once with each dictionary, in blocks of ``BLOCK`` bytes so that the
text's own repetitions do not outweigh the dictionary; the language with the
smallest total is the answer, and a margin below ``MIN_MARGIN`` is a rejection.
Before encoding, texts are lower-cased and everything but letters becomes one
space, so shouting, markup and numbers do not matter.

The dictionaries are fitted on a bounded sample: about ``SAMPLE_DOCS`` labelled
documents a language, chosen by a hash of the id, of each a stretch of
``SAMPLE_BYTES`` characters at most, which may start anywhere in it.  The driver holds these samples; their size does not grow with the input.
Every text is classified whole.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import extended, hash_bound, rest_and, small, with_rest

DICT_BYTES = 1 << 17
BLOCK = 2048
LEVEL = 3
SAMPLE_DOCS = 300
SAMPLE_BYTES = 1 << 14
MIN_MARGIN = 0.005
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
RUN = 1 << 20


def letters_only(text: str) -> bytes:
    """The letters of a text in lower case, other runs as one space."""
    return _OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


def _blocks(text: str):
    """The normalised text in blocks; a huge text is normalised in stretches."""
    for at in range(0, len(text), RUN):
        data = letters_only(text[at:at + RUN])
        for start in range(0, len(data), BLOCK):
            yield data[start:start + BLOCK]


def fit_dictionaries(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
                     sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Language -> dictionary content, from the rows of ``docs`` with a language
    and a letter in the text.  Texts of a language fill its dictionary in the
    order of their ids' hash, the first at the end, where references are cheapest.

    Defined results: rows with a null language or a null text, or one without a
    letter, are not learnt from; rows of a null or a repeated id have one hash and
    go by their text; without rows there is no dictionary; other columns are not read."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key).alias("h"))
    counts = docs.where(F.col(lang).isNotNull()).groupBy(lang).count().collect()       # a number per dictionary
    if not counts:
        return {}
    # a share of each language's documents, taken before any of them is shuffled
    upto = F.create_map(*[F.lit(x) for r in counts for x in (r[0], hash_bound(2.0 * sample_docs / r[1]))])
    # of a long text a stretch from any place of it, by the same hash
    start = F.pmod(F.xxhash64(F.lit(3), "h"), F.greatest(F.length("text") - SAMPLE_BYTES, F.lit(0)) + 1).cast("int") + 1
    some = (rows.where(F.col("h") <= upto[F.col("lang")])
            .select("lang", "h", F.substring(F.col("text"), start, F.lit(SAMPLE_BYTES)).alias("text")))
    # the share takes twice the wanted number; of these the first by hash, in parts so that no task holds a language
    first = some.groupBy("lang", F.pmod(F.col("h"), F.lit(16)).alias("part")).agg(
        F.slice(F.array_sort(F.collect_list(F.struct("h", "text"))), 1, -(-sample_docs // 16)).alias("rows"))
    out: dict[str, list] = {}
    for r in first.collect():
        out.setdefault(r["lang"], []).extend((x["h"], x["text"]) for x in r["rows"])
    made = {}
    for name, texts in sorted(out.items()):
        content, size = [], 0
        for _, t in sorted(texts):
            content.append(letters_only(t))
            size += len(content[-1])
            if size >= DICT_BYTES:
                break
        made[name] = b"".join(reversed(content))[-DICT_BYTES:]
    return made


class Encoder:
    """The compressors of all languages."""

    def __init__(self, contents: dict[str, bytes]):
        self.names, self.coders = sorted(contents), []
        for name in self.names:
            d = zstandard.ZstdCompressionDict(contents[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(
                dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (second size over the sum of the two smallest; 0 for
        an unknown language) and margin (1 - smallest / second)."""
        if not text or not self.coders or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        totals = [0] * len(self.coders)
        for block in _blocks(text):
            for i, coder in enumerate(self.coders):
                totals[i] += len(coder.compress(block))
        if len(totals) == 1:
            return self.names[0], 1.0, 1.0
        order = sorted(range(len(totals)), key=lambda i: (totals[i], self.names[i]))
        best, second = totals[order[0]], totals[order[1]]
        return self.names[order[0]], second / (best + second), 1 - best / second


def identify(docs: DataFrame, contents: dict[str, bytes], text: str = "text",
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """The columns of ``docs`` but the text, and ``lang_pred``, ``lang_score``,
    ``lang_margin`` and ``lang_rejected``.

    Defined results: a null text or one without a letter is ``und`` with score
    0 and rejected; ties go to the smaller name by code point (and are
    rejected); with one language every text with a letter has it; with none
    everything is ``und``; input columns called like an output column are
    replaced."""
    added = "lang_pred string, lang_score double, lang_margin double, lang_rejected boolean"
    taken = ["lang_pred", "lang_score", "lang_margin", "lang_rejected"]
    rows = with_rest(docs, F.col(f"`{text}`"), [text, *taken])

    def run(batches):
        encoder = Encoder(contents)
        for batch in small(batches):
            found = [encoder.classify(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            names, scores, margins = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(margins, pa.float64()),
                 pa.array([n == UNKNOWN or m < min_margin for n, m in zip(names, margins)], pa.bool_())],
                ["__row", *taken])

    return rest_and(rows.mapInArrow(run, extended(rows.select("__row"), added)), taken)


def fold(key: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; null for a null id."""
    return (F.crc32(F.col(key).cast("string")) % parts).cast("int")


def keep_identified(docs: DataFrame, contents: dict[str, bytes], text: str = "text",
                    min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` without the documents whose language is rejected.

    Defined results: as ``identify``: null texts, texts without a letter and ties
    go; repeated rows stay or go together; an empty table stays empty; without
    dictionaries all rows go; columns may have any name."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__whole"), F.col(f"`{text}`").alias("__t"))
    return identify(rows, contents, "__t", min_margin).where(~F.col("lang_rejected")).select("__whole.*")
