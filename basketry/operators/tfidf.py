"""Tokenising and TF-IDF weights.

Weighting (smoothed IDF, L2 rows): ``w(d, t) = tf(d, t) * (ln((1 + N) / (1 + df(t))) + 1)``,
then each document's weights are divided by their Euclidean norm.  The
vocabulary is the ``max_features`` most frequent terms over the corpus (ties
by term, so it is deterministic) or a given list.  Spark's own ``IDF`` omits
the ``+ 1`` term, so IDF values are computed here and applied with
``ElementwiseProduct`` + ``Normalizer``.

Two routes compute the same numbers (cross-checked in tests):

* vector route, ``Corpus`` - word scores and clustering features: tokens are
  materialised once, the vocabulary comes from ``frequent_terms``, document
  frequencies from Spark ML's ``IDF`` fit (a tree aggregate), vectors from
  ``CountVectorizerModel`` and scores from ``Summarizer.sum``.  No (doc, term)
  shuffle.
* long form, ``term_stats`` / ``tfidf_long`` - per-(doc, term) weights, the
  SQL-checkable form: term counts aggregate on (doc, term) with map-side
  combine (a huge document or a very common term is reduced before it moves)
  and are materialised once; rows are normalised by a window per document that
  holds at most ``max_features`` rows.

The vocabulary (<= ``max_features``) is the only broadcast side.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer,
                                RegexTokenizer, StopWordsRemover)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import cut_lineage

TOKEN_PATTERN = r"\w\w+"
BROADCAST_TERMS = 100_000       # a longer vocabulary is joined, not broadcast


def english_stopwords() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def tokenize(df: DataFrame, text_col: str, out_col: str = "tokens",
             stopwords: Sequence[str] | None = None) -> DataFrame:
    """Lower-cased words of two or more word characters, English stopwords removed."""
    tmp = f"_{out_col}_raw"
    src = df.withColumn(tmp + "_in", F.coalesce(F.col(text_col), F.lit("")))
    tok = RegexTokenizer(inputCol=tmp + "_in", outputCol=tmp, pattern=TOKEN_PATTERN, gaps=False,
                         toLowercase=True, minTokenLength=1)
    rem = StopWordsRemover(inputCol=tmp, outputCol=out_col,
                           stopWords=list(stopwords) if stopwords is not None else english_stopwords())
    return rem.transform(tok.transform(src)).drop(tmp, tmp + "_in")


def term_counts(docs: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """``(id, term, tf)``.  ``explode_outer`` + a NULL filter instead of
    ``explode``: the latter makes Catalyst add ``size(tokens) > 0`` as a
    filter, which would run the whole tokenising expression a second time."""
    return (docs.select(id_col, F.explode_outer(tokens_col).alias("term"))
                .where(F.col("term").isNotNull())
                .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def top_terms(tf: DataFrame, max_features: int) -> DataFrame:
    """The ``max_features`` terms with the largest corpus frequency (ties by term)."""
    return (tf.groupBy("term").agg(F.sum("tf").alias("total"))
              .orderBy(F.desc("total"), F.asc("term")).limit(max_features).select("term"))


TRACKED = 100_000               # terms a sketch keeps
FAN_IN = 256


def sketch_error(tracked: int, n_terms: int) -> float:
    """By how much a frequent-items sketch of ``tracked`` items can be off after
    ``n_terms`` ones: 3.5 times their number by the size of its map, a power of two
    of which it fills three quarters."""
    size = 1 << math.ceil(math.log2(max(8, math.ceil(tracked / 0.75))))
    return 3.5 * n_terms / size


def frequent_terms(docs: DataFrame, tokens_col: str, max_features: int, tracked: int = TRACKED) -> DataFrame:
    """``(term, total)``: the ``max_features`` most frequent terms with their exact
    counts (ties by term), without shuffling every distinct term.

    A first pass sends one frequent-items sketch a task, merged in two levels.  A
    term that the sketch does not return has at most twice its error; those it
    returns and that could be among the first are counted exactly (joined with a
    broadcast of at most ``tracked`` terms).  If the last of the counted ones is
    above that bound, no other term can be among the first.  Otherwise (flat
    distributions, fewer terms than asked for) all terms are counted: the result
    is the same on either way.  ``docs`` is read twice: it should be written."""
    terms = docs.select(F.explode_outer(tokens_col).alias("term")).where(F.col("term").isNotNull())
    first = lambda counted: (counted.groupBy("term").agg(F.count(F.lit(1)).alias("total"))
                             .orderBy(F.desc("total"), F.asc("term")).limit(max_features))
    parts = terms.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("_g")).agg(
        F.expr(f"approx_top_k_accumulate(term, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("n"))
    if max_features > tracked:
        return first(terms)
    # grouped by a constant: without any term there is no group and no sketch to merge
    seen = parts.groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {tracked})").alias("top"),
                     F.sum("n").alias("n")).first()
    found = seen["top"] if seen else []
    if len(found) < max_features:
        return first(terms)
    error = sketch_error(tracked, seen["n"])
    least = found[max_features - 1]["count"] - error        # that many terms have at least this count
    held = docs.sparkSession.createDataFrame([(x["item"],) for x in found if x["count"] >= least], "term string")
    exact = cut_lineage(first(terms.join(F.broadcast(held), "term")), "frequent-terms")
    last = exact.agg(F.min("total"), F.count(F.lit(1))).first()
    if last[1] == max_features and last[0] > 2 * error:
        return exact
    return first(terms)


def idf_table(tf: DataFrame, vocabulary: DataFrame, n_docs: int, broadcast: bool = True) -> DataFrame:
    """``(term, doc_freq, idf)`` for the vocabulary terms; terms absent from the
    corpus get doc_freq 0.  ``broadcast`` only for a vocabulary of known,
    bounded size (top-k or a literal list); otherwise Spark/AQE chooses."""
    voc = F.broadcast(vocabulary) if broadcast else vocabulary
    dfreq = tf.join(voc, "term").groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
    out = voc.join(dfreq, "term", "left").fillna(0, ["doc_freq"])
    return out.withColumn("idf", F.log((F.lit(1.0 + n_docs)) / (F.col("doc_freq") + 1.0)) + 1.0)


@dataclass(frozen=True)
class TermStats:
    """Corpus statistics shared by every TF-IDF step: the materialised
    ``(id, term, tf)`` table and the number of documents."""
    tf: DataFrame
    n_docs: int
    id_col: str


def term_stats(docs: DataFrame, id_col: str, tokens_col: str) -> TermStats:
    """Counts terms once and keeps them under the shared checkpoint folder:
    the vocabulary, the IDF and the weights all read them, and text cleaning
    and tokenising (the expensive part) run a single time."""
    n_docs = docs.count()
    return TermStats(cut_lineage(term_counts(docs, id_col, tokens_col), "term-counts"), n_docs, id_col)


def tfidf_long(docs: DataFrame | TermStats, id_col: str | None = None, tokens_col: str | None = None,
               max_features: int | None = 1000, vocabulary: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """``(id, term, weight)`` for every (document, vocabulary term) present.
    ``docs`` is a tokenised frame (with ``id_col``/``tokens_col``) or
    precomputed ``TermStats``."""
    stats = docs if isinstance(docs, TermStats) else term_stats(docs, id_col, tokens_col)
    tf, n_docs, id_col = stats.tf, stats.n_docs, stats.id_col
    bounded = max_features is not None and max_features <= BROADCAST_TERMS     # a top-k or literal list of known size
    if vocabulary is None:
        vocab = top_terms(tf, max_features)
    elif isinstance(vocabulary, DataFrame):
        vocab, bounded = vocabulary.select("term"), False
    else:
        bounded = len(vocabulary) <= BROADCAST_TERMS
        vocab = tf.sparkSession.createDataFrame([(t,) for t in vocabulary], "term string")
    idf = idf_table(tf, vocab, n_docs, broadcast=bounded).select("term", "idf")
    raw = tf.join(F.broadcast(idf) if bounded else idf, "term").withColumn("raw", F.col("tf") * F.col("idf"))
    # every document has at most |vocabulary| rows here, so this window is bounded
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("raw") / norm).alias("weight"))


def term_scores(weights: DataFrame, k: int) -> DataFrame:
    """Sum of weights per term, top ``k`` (ties by term), with 1-based rank."""
    top = (weights.groupBy("term").agg(F.sum("weight").alias("score"))
                  .orderBy(F.desc("score"), F.asc("term")).limit(k))
    # the unpartitioned window only ranks the k rows left after the top-k
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), F.asc("term"))))


def idf_vector(docs: DataFrame | TermStats, tokens_col: str | None, vocabulary: Sequence[str]) -> list[float]:
    """Smoothed IDF of each vocabulary term, in vocabulary order (one aggregate;
    the result has len(vocabulary) entries).  With ``TermStats`` the document
    frequencies come from the materialised term counts."""
    if isinstance(docs, TermStats):
        n_docs = docs.n_docs
        terms = docs.tf.select("term")
    else:
        n_docs = docs.count()
        terms = docs.select(F.explode_outer(F.array_distinct(tokens_col)).alias("term"))
    dfreq = {r["term"]: r["n"] for r in
             terms.where(F.col("term").isin(list(vocabulary)))
                  .groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [math.log((1.0 + n_docs) / (1.0 + dfreq.get(t, 0))) + 1.0 for t in vocabulary]


def tfidf_vectors(docs: DataFrame, tokens_col: str, vocabulary: Sequence[str],
                  out_col: str = "features", idf: Sequence[float] | None = None) -> DataFrame:
    """Adds an L2-normalised TF-IDF vector over a fixed vocabulary (documents
    without a vocabulary term get the zero vector).  ``idf`` defaults to the
    IDF measured on ``docs`` itself."""
    vocab = list(vocabulary)
    if not vocab:                  # no vocabulary: every document gets the empty vector
        return docs.withColumn(out_col, array_to_vector(F.array().cast("array<double>")))
    if idf is None:
        idf = idf_vector(docs, tokens_col, vocab)
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol=tokens_col, outputCol="_tf")
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(p=2.0, inputCol="_tfidf", outputCol=out_col)
    return norm.transform(scaled.transform(cv.transform(docs))).drop("_tf", "_tfidf")


def dense_long(df: DataFrame, id_col: str, vector_col: str, vocabulary: Sequence[str]) -> DataFrame:
    """Dense form of a vector column as ``(id, feature_index, term, weight)``."""
    names = F.array(*[F.lit(t) for t in vocabulary])
    return (df.select(id_col, F.posexplode(vector_to_array(vector_col)).alias("feature_index", "weight"))
              .withColumn("term", names[F.col("feature_index")]))


def term_scores_from_vectors(vectors: DataFrame, vocabulary: Sequence[str], k: int,
                             features_col: str = "features", fan_in: int = 256) -> DataFrame:
    """Word scores from TF-IDF vectors, ranked like ``term_scores`` (score
    desc, term asc), top ``k``.

    The vectors are summed in two levels: Spark sums them per map-task group
    (``spark_partition_id() % fan_in``: every task contributes one partial
    sum, at most ``fan_in`` reducers each merge a share), and the <= ``fan_in``
    group sums (<= fan_in x |vocabulary| numbers) are added on the driver.  A
    plain global ``Summarizer.sum`` would send one |vocabulary|-wide buffer per
    task to a single reducer."""
    import numpy as np
    from pyspark.ml.stat import Summarizer

    partials = (vectors.groupBy(F.pmod(F.spark_partition_id(), F.lit(fan_in)).alias("_g"))
                       .agg(Summarizer.sum(F.col(features_col)).alias("_s")).collect())
    total = np.zeros(len(vocabulary))
    for row in partials:
        total += row["_s"].toArray()
    pairs = sorted(zip(total.tolist(), vocabulary), key=lambda x: (-x[0], x[1]))[:k]
    rows = [(t, sc, r + 1) for r, (sc, t) in enumerate(pairs)]
    return vectors.sparkSession.createDataFrame(rows, "term string, score double, rank int")


@dataclass(frozen=True)
class Corpus:
    """A tokenised corpus summarised once: materialised ``(id, tokens)``, the
    ``max_features`` most frequent terms (ties by term) and their document
    frequencies.  IDF values and TF-IDF vectors for any subset of the
    vocabulary follow without another pass over the text."""
    tokens: DataFrame
    id_col: str
    tokens_col: str
    vocabulary: tuple[str, ...]
    doc_freq: tuple[int, ...]
    n_docs: int
    counts: DataFrame | None = None      # (id, _tf): term counts over the whole vocabulary

    def idf(self, words: Sequence[str] | None = None) -> list[float]:
        dfreq = dict(zip(self.vocabulary, self.doc_freq))
        return [math.log((1.0 + self.n_docs) / (1.0 + dfreq.get(t, 0))) + 1.0
                for t in (words if words is not None else self.vocabulary)]

    def vectors(self, words: Sequence[str] | None = None, out_col: str = "features") -> DataFrame:
        if words is None and self.counts is not None:
            scaled = ElementwiseProduct(scalingVec=Vectors.dense(self.idf()), inputCol="_tf", outputCol="_tfidf")
            return Normalizer(p=2.0, inputCol="_tfidf", outputCol=out_col).transform(scaled.transform(self.counts)).drop("_tf", "_tfidf")
        w = list(words if words is not None else self.vocabulary)
        return tfidf_vectors(self.tokens, self.tokens_col, w, out_col=out_col, idf=self.idf(w))


def corpus(docs: DataFrame, id_col: str, tokens_col: str, max_features: int = 1000) -> Corpus:
    from pyspark.ml.feature import IDF

    toks = cut_lineage(docs.select(id_col, tokens_col), "tokens")
    vocab = [r["term"] for r in frequent_terms(toks, tokens_col, max_features).orderBy(F.desc("total"), F.asc("term")).collect()]
    if not vocab:
        return Corpus(toks, id_col, tokens_col, (), (), toks.count())
    tf = CountVectorizerModel.from_vocabulary(vocab, inputCol=tokens_col, outputCol="_tf").transform(toks)
    tf = cut_lineage(tf.select(id_col, "_tf"), "term-vectors")       # read by the document frequencies and the scores
    fitted = IDF(inputCol="_tf", outputCol="_idf").fit(tf)
    return Corpus(toks, id_col, tokens_col, tuple(vocab), tuple(int(d) for d in fitted.docFreq), int(fitted.numDocs), tf)


def top_words(c: Corpus, k: int) -> DataFrame:
    """``(term, score, rank)``: the ``k`` largest sums of TF-IDF weights over
    the corpus (same numbers as ``term_scores`` on the long form)."""
    if not c.vocabulary:
        return c.tokens.sparkSession.createDataFrame([], "term string, score double, rank int")
    return term_scores_from_vectors(c.vectors(), c.vocabulary, k)
