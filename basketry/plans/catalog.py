"""The query catalogue: every operator of the workload run over whole test
tables.  Each query is ``(spark, sf_dir) -> DataFrame``.

Table stand-ins: products = ``part`` (aisle = number in ``p_brand``,
department = ``p_size``), order items = ``lineitem`` (basket = ``l_orderkey``,
in-basket order = line number, part key, price), statistics on ``lineitem``
measures by ``l_returnflag`` / ``customer`` / ``documents``, classification on
``documents`` (label ``lang``), vectors in ``embeddings``.

Arrays are rendered as comma-joined text here (only here) so the result can
be compared value for value with SQL; the library operators return arrays.
Doubles are rounded to 6 decimals for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.arrays import cast_elements, join_ints, one_hot_dense
from basketry.functions.text import clean_text, contains_ci, first_word
from basketry.operators import baskets as B
from basketry.operators import classify as C
from basketry.operators import cluster as K
from basketry.operators import context as X
from basketry.operators import epochs as E
from basketry.operators import factors as FA
from basketry.operators import forest as FO
from basketry.operators import gridkmeans as G
from basketry.operators import nextitem as N
from basketry.operators import profile as P
from basketry.operators import similarity as SI
from basketry.operators import tfidf as TF
from basketry.operators.partitions import repartition_report
from basketry.operators.quantiles import exact_quantiles
from basketry.operators.sequence import sequence_items
from basketry.session import cut_lineage, scratch_path, spread
from basketry.sources import csv as CSV
from basketry.sources import local as L
from basketry.sources import sinks as S
from basketry.sources import versions as V
from basketry.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
SPLIT_SEED = 42
TEST_PERCENT = 20
SPLIT_DATE = "1997-01-01"
REPARTITION_N = 4              # the workload's own number
FIRST_WORD_NEEDLE = "cold"
RETURNFLAG_LABELS = {"A": "accepted", "N": "not returned", "R": "returned"}
LINEITEM_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
# Run parameters of the next-item model (fixed values of the workload).
NEXT_ITEM_PARAMS = {"embedding_dim": 256, "hidden_dim": 128, "learning_rate": 0.001, "epochs": 10,
                    "batch_size": 1, "dropout_prob": 0.3}
N_CLUSTERS = 20
TOP_WORDS = 30
MAX_FEATURES = 1000


def _r(c, digits: int = DIGITS):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# ---------------------------------------------------------------- inputs

def products(spark, sf):
    """Products view of ``part`` (ids, names, aisle and department ids, cleaned names)."""
    return B.products_from_part(read_table(spark, sf, "part"))


def joined_items(spark, sf):
    """Order items of ``lineitem`` joined to the products (inner, on the product id)."""
    return B.join_items_products(B.order_items_from_lineitem(read_table(spark, sf, "lineitem")), products(spark, sf))


BASKET_VALUES = {"product_ids": "order_product_id", "aisle_ids": "aisle_id",
                 "department_ids": "department_id", "product_names": "processed_product_name"}


def baskets(spark, sf, arrays=None):
    """Baskets with the named arrays only (all by default): struct fields
    inside ``collect_list`` are not pruned by the optimizer, so a query that
    needs fewer arrays must not gather (and compute) the others."""
    values = {k: v for k, v in BASKET_VALUES.items() if arrays is None or k in arrays}
    return B.build_baskets(joined_items(spark, sf), values)


def _render_baskets(df: DataFrame, int_cols=("product_ids", "aisle_ids", "department_ids"),
                    text_cols=("product_names",)) -> DataFrame:
    return df.withColumns({**{c: join_ints(c) for c in int_cols if c in df.columns},
                           **{c: F.array_join(c, "|", "NULL") for c in text_cols if c in df.columns}})


def _basket_table(b: DataFrame) -> DataFrame:
    sized = b.withColumn("n_items", F.size("product_ids").cast("bigint"))
    return _render_baskets(sized).select("order_id", "n_items", *BASKET_VALUES)


def rule_mapping(products_df: DataFrame) -> DataFrame:
    """Stand-in name -> virtual id map given by a fixed rule on the name (used
    where the map is an INPUT of the operator under test, so the query stays
    SQL-checkable); KMeans output is used by the clustering queries."""
    names = products_df.select(K.NAME).where(F.col(K.NAME).isNotNull()).distinct()
    return names.withColumn("virtual_product_id",
                            (F.pmod(F.length(K.NAME) * 31 + F.ascii(K.NAME), F.lit(N_CLUSTERS)) + 1).cast("int"))


KMEANS_STEPS = 20


def name_clusters(spark, sf):
    """KMeans(20) map cleaned name -> cluster, virtual_product_id."""
    return cut_lineage(K.cluster_names_exact(products(spark, sf), N_CLUSTERS, TOP_WORDS, KMEANS_STEPS), "name-clusters")


def scan_partitions(spark) -> int | None:
    """How many partitions CPU-heavy work on a table of few splits is spread
    over: the session's ``spark.basketry.scanPartitions`` (see
    ``recommended_conf``), or the scan's own splits where it is unset."""
    n = spark.conf.get("spark.basketry.scanPartitions", None)
    return int(n) if n else None


# ---------------------------------------------------------------- sources

def q_csv_scan_inferred(spark, sf):
    """S3: part written as CSV, read back with header + inferred types."""
    path = CSV.write_csv(read_table(spark, sf, "part"), scratch_path(spark, "part-csv"))
    return CSV.read_csv_inferred(spark, path)


def q_csv_scan_strings_cast(spark, sf):
    """Part as CSV read as strings, ids and numbers cast with try_cast."""
    path = CSV.write_csv(read_table(spark, sf, "part"), scratch_path(spark, "part-csv"))
    raw = CSV.read_csv_strings(spark, path)
    # ids as bigint: at full scale keys pass the int range and would become NULL
    return CSV.cast_columns(raw, {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"})


def q_local_frame_source(spark, sf):
    """A bounded aggregate through pandas and back with an explicit schema."""
    agg = (read_table(spark, sf, "nation").join(read_table(spark, sf, "region"),
                                                F.col("n_regionkey") == F.col("r_regionkey"))
           .groupBy("r_name").agg(F.count(F.lit(1)).alias("n_nations")))
    pdf = L.to_pandas(agg)                  # a row per region
    schema = T.StructType([T.StructField("r_name", T.StringType(), True),
                           T.StructField("n_nations", T.LongType(), True)])
    return L.from_pandas(spark, pdf, schema)


def q_local_rows_schema(spark, sf):
    """Local rows with an explicit schema (labels of the return flags),
    joined to the line items per flag."""
    labels = L.from_rows(spark, sorted(RETURNFLAG_LABELS.items()), T.StructType([
        T.StructField("l_returnflag", T.StringType(), False), T.StructField("flag_label", T.StringType(), True)]))
    counts = P.class_counts(read_table(spark, sf, "lineitem"), "l_returnflag")
    return counts.join(labels, "l_returnflag", "left").select("l_returnflag", "flag_label", "n")


def q_schema_report(spark, sf):
    """The part schema as rows."""
    return P.schema_report(read_table(spark, sf, "part"))


def q_head_rows(spark, sf):
    """First 20 orders by key."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    return P.head_rows(orders, ["o_orderkey"], 20)


def q_rdd_first_word_filter(spark, sf):
    """First word of each part name, kept if it contains the needle."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_name"])
    words = part.select("p_partkey", first_word("p_name").alias("first_word"))
    return words.where(contains_ci("first_word", FIRST_WORD_NEEDLE))


def q_filter_eq_literal(spark, sf):
    """p_partkey == '1' with the literal converted to the column type."""
    return P.filter_equals(read_table(spark, sf, "part"), "p_partkey", "1")


def q_group_sum_sorted(spark, sf):
    """A1, O1: sum of part keys per name, descending."""
    return P.group_sum_sorted(read_table(spark, sf, "part"), "p_name", "p_partkey", "sum_p_partkey")


def q_describe_table(spark, sf):
    """describe() of customer in long form."""
    d = P.describe_long(read_table(spark, sf, "customer"))
    return d.withColumn("num_value", _r("num_value"))


def q_row_counts(spark, sf):
    """Row count of every table used."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings")
    return P.row_counts({n: read_table(spark, sf, n) for n in names})


def q_class_counts(spark, sf):
    """A2: line items per return flag."""
    return P.class_counts(read_table(spark, sf, "lineitem"), "l_returnflag")


def q_null_counts(spark, sf):
    """NULLs per lineitem column."""
    return P.null_counts(read_table(spark, sf, "lineitem"))


def q_group_mean_stddev(spark, sf):
    """A4: mean and sample stddev of quantity and price per return flag."""
    m = P.group_moments(read_table(spark, sf, "lineitem"), "l_returnflag",
                        {"l_quantity": "quantity", "l_extendedprice": "extendedprice"})
    return m.select("l_returnflag", *[_r(c).alias(c) for c in m.columns if c != "l_returnflag"])


def q_class_mean_lengths(spark, sf):
    """Means per return flag with the flag mapped to a label."""
    m = P.group_moments(read_table(spark, sf, "lineitem"), "l_returnflag",
                        {"l_quantity": "quantity", "l_extendedprice": "extendedprice"}, stddev=False)
    return m.select("l_returnflag", P.label_codes("l_returnflag", RETURNFLAG_LABELS).alias("flag_label"),
                    _r("mean_quantity").alias("mean_quantity"), _r("mean_extendedprice").alias("mean_extendedprice"))


def q_correlation_pairs(spark, sf):
    """Pearson correlation of every ordered pair of four measures (one pass)."""
    c = P.correlation_pairs(read_table(spark, sf, "lineitem"), LINEITEM_MEASURES)
    return c.withColumn("corr", _r("corr"))


def _fences_row(spark, df, column):
    q1, q3 = exact_quantiles(df, column, [0.25, 0.75])
    lo, hi = P.iqr_fences(q1, q3)
    return q1, q3, lo, hi


def q_quartiles_exact(spark, sf):
    """Exact quartiles and IQR fences of customer account balances."""
    cust = read_table(spark, sf, "customer", ["c_acctbal"])
    q1, q3, lo, hi = _fences_row(spark, cust, "c_acctbal")
    found = {"q1": q1, "q3": q3, "iqr": None if q1 is None else q3 - q1, "lower_fence": lo, "upper_fence": hi}
    return spark.range(1).select(F.lit("c_acctbal").alias("column_name"),
                                 *[_r(F.lit(x).cast("double")).alias(n) for n, x in found.items()])


def q_iqr_outliers(spark, sf):
    """Documents whose n_chars lies strictly outside the IQR fences."""
    docs = read_table(spark, sf, "documents", ["doc_id", "n_chars"])
    _, _, lo, hi = _fences_row(spark, docs, "n_chars")
    return P.outside(docs, "n_chars", lo, hi)


# ---------------------------------------------------------------- baskets

def q_order_items_join_products(spark, sf):
    """Order items joined to products on differently named keys."""
    return joined_items(spark, sf).select("order_id", "order_product_id", "product_id", "product_name",
                                          "aisle_id", "department_id", "line_no")


def q_baskets(spark, sf):
    """Ordered baskets per order (aligned arrays)."""
    return _basket_table(baskets(spark, sf))


def q_baskets_min_size(spark, sf):
    """Baskets with at least two items."""
    return _basket_table(B.keep_min_size(baskets(spark, sf), "product_ids", 2))


def q_basket_cast_elements(spark, sf):
    """Baskets whose ids arrive as text (as from a header-only CSV) and are
    cast element-wise with a higher-order ``transform``."""
    part = read_table(spark, sf, "part", ["p_partkey", "p_brand", "p_size"])
    text_ids = part.select(F.col("p_partkey").alias("product_id"),
                           F.regexp_extract("p_brand", r"(\d+)$", 1).alias("aisle_id"),
                           F.col("p_size").cast("string").alias("department_id"))
    items = B.join_items_products(B.order_items_from_lineitem(read_table(spark, sf, "lineitem")), text_ids)
    b = B.build_baskets(items, {"aisle_ids": "aisle_id", "department_ids": "department_id"})
    cast = b.select("order_id", cast_elements("aisle_ids", "int").alias("aisle_ids"),
                    cast_elements("department_ids", "int").alias("department_ids"))
    return _render_baskets(cast)


BASKET_CHUNK = 256


def q_basket_chunks(spark, sf):
    """Baskets split into rows of at most BASKET_CHUNK items (skew-safe form)."""
    ch = B.build_basket_chunks(joined_items(spark, sf), BASKET_VALUES, BASKET_CHUNK)
    return _render_baskets(ch)


def q_basket_items_exploded(spark, sf):
    """One row per basket item with its position; the positions come
    from the item sequence, no basket is gathered to be taken apart again."""
    seq = sequence_items(joined_items(spark, sf), B.ORDER, B.ITEM_ORDER, "order_product_id",
                         out_item="product_id", keep_sort_cols=False)
    return seq.select(B.ORDER, "pos", "product_id")


def q_max_ids_from_arrays(spark, sf):
    """Maxima of the ids and max + 1 vocabulary sizes, over the
    items that the arrays are made of."""
    return B.max_item_ids(joined_items(spark, sf), {"order_product_id": "product", "aisle_id": "aisle",
                                                    "department_id": "department"})


def q_vocab_size_distinct(spark, sf):
    """Distinct virtual ids + 1 (NULL counts) with the rule name map."""
    prods = products(spark, sf)
    mapped = B.attach_mapping(prods, rule_mapping(prods), K.NAME, "virtual_product_id")
    return B.vocab_size_distinct(mapped, "virtual_product_id")


def q_vocab_size_clusters(spark, sf):
    """Distinct virtual product ids + 1 with the KMeans name -> cluster map."""
    prods = products(spark, sf)
    mapping = name_clusters(spark, sf)
    return B.vocab_size_distinct(B.attach_mapping(prods, mapping, K.NAME, "virtual_product_id"), "virtual_product_id")


LLO_CUT = {"product_ids": "removed_product_ids", "aisle_ids": "removed_aisle_ids",
           "department_ids": "removed_department_ids"}


def _leave_last_out(spark, sf):
    return B.leave_last_out(B.keep_min_size(baskets(spark, sf), "product_ids", 2), LLO_CUT)


def _cut_table(b: DataFrame) -> DataFrame:
    shown = _render_baskets(b, int_cols=(*LLO_CUT, *LLO_CUT.values()))
    return shown.select("order_id", "remove_count", *LLO_CUT, "product_names", *LLO_CUT.values())


def q_leave_last_out(spark, sf):
    """Last item of each basket moved to the removed_* arrays."""
    return _cut_table(_leave_last_out(spark, sf))


def q_leave_k_out_variable(spark, sf):
    """Remove 1, or 1-2 items chosen by a key hash for baskets over three items."""
    b = B.keep_min_size(baskets(spark, sf), "product_ids", 2)
    return _cut_table(B.leave_last_out(b, LLO_CUT, B.variable_remove_count("product_ids", "order_id")))


def q_leave_last_out_long(spark, sf):
    """Leave-last-out in long form (skew-safe): every item of a basket with
    two or more items, tagged 'history' or 'removed'."""
    seq = sequence_items(joined_items(spark, sf), B.ORDER, B.ITEM_ORDER, "order_product_id",
                         out_item="product_id", carry=["department_id"], keep_sort_cols=False)
    multi = seq.where((F.col("pos") > 1) | ~F.col("is_last"))
    return multi.select(B.ORDER, "pos", "product_id", "department_id",
                        F.when(F.col("is_last"), F.lit("removed")).otherwise(F.lit("history")).alias("role"))


def q_leave_last_out_chunks(spark, sf):
    """P10, F11, F12 (skew-safe array form, the flagship): history in chunks of
    at most BASKET_CHUNK items per row, the removed last item in a row of its own."""
    out = B.leave_last_out_chunks(joined_items(spark, sf),
                                  {"product_ids": "order_product_id", "aisle_ids": "aisle_id",
                                   "department_ids": "department_id"}, BASKET_CHUNK)
    return _render_baskets(out)


def q_one_hot_target(spark, sf):
    """one-hot of each basket's removed department id (width max + 1 over
    the baskets of two or more items)."""
    seq = sequence_items(joined_items(spark, sf), B.ORDER, B.ITEM_ORDER, "department_id", keep_sort_cols=False)
    multi = seq.where((F.col("pos") > 1) | ~F.col("is_last"))
    width = B.max_item_ids(multi, {"item": "d"}).first()["d_vocab_size"]
    return multi.where("is_last").select(B.ORDER, F.col("item").alias("target"),
                                         join_ints(one_hot_dense("item", int(width or 0))).alias("one_hot"))


# ---------------------------------------------------------------- text

def _part_tokens(spark, sf):
    return TF.tokenize(products(spark, sf).select("product_id", K.NAME), K.NAME)


def _document_tokens(spark, sf):
    docs = spread(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", scan_partitions(spark))
    return TF.tokenize(docs.select("doc_id", clean_text("text").alias("clean_text")), "clean_text")


def q_text_clean(spark, sf):
    """Cleaned product names."""
    return products(spark, sf).select("product_id", K.NAME)


def q_text_clean_documents(spark, sf):
    """Cleaned document texts (whole texts)."""
    docs = spread(read_table(spark, sf, "documents", ["doc_id", "text"]), "doc_id", scan_partitions(spark))
    return docs.select("doc_id", clean_text("text").alias("clean_text"))


def q_tokenize_names(spark, sf):
    """M7: tokens of the cleaned names, English stopwords removed."""
    return _part_tokens(spark, sf).select("product_id", F.array_join("tokens", " ").alias("tokens"))


def q_tfidf_weights(spark, sf):
    """M8: smoothed-IDF, L2-normalised TF-IDF weights per (product, term)."""
    w = TF.tfidf_long(_part_tokens(spark, sf), "product_id", "tokens", max_features=MAX_FEATURES)
    return w.withColumn("weight", _r("weight"))


def q_tfidf_top_words(spark, sf):
    """Top 30 words by summed TF-IDF weight over product names."""
    c = TF.corpus(_part_tokens(spark, sf), "product_id", "tokens", MAX_FEATURES)
    return TF.top_words(c, TOP_WORDS).select("term", _r("score").alias("score"), F.col("rank").cast("bigint"))


def q_tfidf_top_words_documents(spark, sf):
    """Top 30 words by summed TF-IDF weight over documents."""
    c = TF.corpus(_document_tokens(spark, sf), "doc_id", "tokens", MAX_FEATURES)
    return TF.top_words(c, TOP_WORDS).select("term", _r("score").alias("score"), F.col("rank").cast("bigint"))


def q_frequent_words_documents(spark, sf):
    """The 1000 most frequent words of the documents with their counts."""
    toks = cut_lineage(_document_tokens(spark, sf).select("tokens"), "document-tokens")
    return TF.frequent_terms(toks, "tokens", MAX_FEATURES)


def _fixed_vocab_dense(spark, sf):
    c = TF.corpus(_part_tokens(spark, sf), "product_id", "tokens", MAX_FEATURES)
    words = [r["term"] for r in TF.top_words(c, TOP_WORDS).orderBy("rank").collect()]
    vecs = c.vectors(words)
    d = TF.dense_long(vecs, "product_id", "features", words)
    return d.select("product_id", F.col("feature_index").cast("bigint"), "term", _r("weight").alias("weight"))


def q_tfidf_fixed_vocab(spark, sf):
    """TF-IDF over the 30 top words, dense form in long rows."""
    return _fixed_vocab_dense(spark, sf)


SIMILAR_K = 5
NAME_COSINE = 0.3
DOCUMENT_COSINE = 0.9


def q_cosine_topk(spark, sf):
    """For every distinct cleaned name the 5 most similar others by cosine."""
    names = products(spark, sf).where(F.col(K.NAME).isNotNull()).select(K.NAME).distinct()
    stats = TF.term_stats(TF.tokenize(names, K.NAME), K.NAME, "tokens")
    found = SI.cosine_topk(stats, SIMILAR_K, NAME_COSINE, MAX_FEATURES)
    return found.select(K.NAME, F.col("rank").cast("bigint"), F.col("other").alias("similar_name"), "cosine")


def q_cosine_topk_documents(spark, sf):
    """For every document the 5 most similar others with a cosine of at least 0.9."""
    stats = TF.term_stats(_document_tokens(spark, sf), "doc_id", "tokens")
    found = SI.cosine_topk(stats, SIMILAR_K, DOCUMENT_COSINE, MAX_FEATURES)
    return found.select("doc_id", F.col("rank").cast("bigint"), F.col("other").alias("similar_doc_id"), "cosine")


# ---------------------------------------------------------------- clusters

def q_kmeans_clusters(spark, sf):
    """KMeans(20) clusters of the cleaned names."""
    return name_clusters(spark, sf)


def q_cluster_members(spark, sf):
    """Members of each cluster with product counts."""
    prods = products(spark, sf)
    return K.cluster_members(prods, name_clusters(spark, sf))


def q_nearest_centroid(spark, sf):
    """Nearest label centroid of every embedding."""
    emb = spread(read_table(spark, sf, "embeddings"), "vec_id", scan_partitions(spark))
    cents = K.label_centroids(emb, "embedding", "label")
    out = K.nearest_centroid(emb, "embedding", cents, out_id="nearest_label")
    return out.select("vec_id", "label", "nearest_label", _r("distance").alias("distance"))


def q_cluster_map_left_join(spark, sf):
    """Products left-joined to the (deduplicated) rule name map."""
    prods = products(spark, sf)
    return B.attach_mapping(prods, rule_mapping(prods), K.NAME, "virtual_product_id") \
        .select("product_id", K.NAME, "virtual_product_id")


def q_cluster_map_fanout_count(spark, sf):
    """Rows the per-product name map would produce (sum of n squared)."""
    return B.mapping_fanout(products(spark, sf), K.NAME)


def _virtual_items(spark, sf):
    """Order items with the virtual product id (cluster + 1 of the cleaned name)."""
    mapped = B.attach_mapping(products(spark, sf), name_clusters(spark, sf), K.NAME, "virtual_product_id")
    return B.join_items_products(B.order_items_from_lineitem(read_table(spark, sf, "lineitem")), mapped)


def q_virtual_product_chunks(spark, sf):
    """The project's flow in its skew-safe form: histories of virtual products in
    rows of at most BASKET_CHUNK items, the removed last item in a row of its own."""
    out = B.leave_last_out_chunks(_virtual_items(spark, sf), {
        "virtual_product_ids": "virtual_product_id", "aisle_ids": "aisle_id", "department_ids": "department_id"}, BASKET_CHUNK)
    return _render_baskets(out, int_cols=("virtual_product_ids", "aisle_ids", "department_ids"))


def q_virtual_product_baskets(spark, sf):
    """Clean names -> TF-IDF -> KMeans(20) -> virtual product ids -> baskets ->
    leave last out (the project's flow, distributed)."""
    items = _virtual_items(spark, sf)
    b = B.build_baskets(items, {"virtual_product_id": "virtual_product_id", "product_id": "product_id",
                                "aisle_ids": "aisle_id", "department_ids": "department_id",
                                "processed_product_name": K.NAME})
    llo = B.leave_last_out(B.keep_min_size(b, "virtual_product_id", 2),
                           {"virtual_product_id": "removed_order_product_ids", "aisle_ids": "removed_aisle_ids",
                            "department_ids": "removed_department_ids"})
    return _render_baskets(llo, int_cols=("virtual_product_id", "product_id", "aisle_ids", "department_ids",
                                          "removed_order_product_ids", "removed_aisle_ids", "removed_department_ids"),
                           text_cols=("processed_product_name",))


# ---------------------------------------------------------------- classification

def _doc_features(spark, sf):
    docs = spread(read_table(spark, sf, "documents", ["doc_id", "text", "lang"]), "doc_id", scan_partitions(spark))
    return C.assemble(C.text_shape_features(docs, "text")).drop("text")


def q_assemble_features(spark, sf):
    """M1: four text-shape features assembled and read back from the vector."""
    from pyspark.ml.functions import vector_to_array
    f = _doc_features(spark, sf).withColumn("_a", vector_to_array("features"))
    return f.select("doc_id", "lang", *[F.col("_a")[i].alias(n) for i, n in enumerate(C.FEATURES)])


def q_train_test_split(spark, sf):
    """M2, M3: deterministic key-hash split of documents."""
    docs = read_table(spark, sf, "documents", ["doc_id"])
    return C.hash_split(docs, "doc_id", TEST_PERCENT, SPLIT_SEED).withColumn(
        "split_bucket", C.split_bucket("doc_id", SPLIT_SEED).cast("bigint"))


def q_train_test_by_date(spark, sf):
    """M3: split by a predicate of another table: line items of orders from
    SPLIT_DATE on are the test part."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    items = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    both = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    marked = C.predicate_split(both, F.col("o_orderdate") >= F.lit(SPLIT_DATE).cast("date"))
    return marked.select("l_orderkey", "l_linenumber", "l_partkey", "split")


def q_random_split_stable(spark, sf):
    """80/20 ``randomSplit`` (seed 42) after fixing the layout: split sizes."""
    docs = read_table(spark, sf, "documents", ["doc_id", "lang"])
    train, test = C.random_split_stable(docs, "doc_id", [0.8, 0.2], seed=SPLIT_SEED)
    return (train.select(F.lit("train").alias("split"), "doc_id")
                 .unionByName(test.select(F.lit("test").alias("split"), "doc_id"))
                 .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


RF_TREES, RF_DEPTH, RF_BINS = 100, 5, 32


def _rf(spark, sf):
    """The forest, the test documents with labels and predictions (written once), and the label names."""
    feats, labels = C.index_labels(C.hash_split(_doc_features(spark, sf), "doc_id", TEST_PERCENT, SPLIT_SEED), "lang")
    # features are computed once (regexes over whole texts) and read by both splits
    feats = cut_lineage(feats.select("doc_id", "lang", "split", F.col("label").cast("int").alias("label"), *C.FEATURES),
                        "doc-features")
    forest = FO.fit_forest(feats.where(F.col("split") == "train"), "doc_id", "label", C.FEATURES, len(labels),
                           RF_TREES, RF_DEPTH, RF_BINS, SPLIT_SEED)
    pred = FO.predict_forest(feats.where(F.col("split") == "test").drop("split"), forest)
    return forest, cut_lineage(pred.select("doc_id", "lang", "label", "prediction"), "rf-predictions"), labels


def q_rf_nodes(spark, sf):
    """M4: the nodes of the random forest (100 trees, depth 5) of the training documents."""
    return FO.node_table(spark, _rf(spark, sf)[0])


def q_rf_predictions(spark, sf):
    """M4, M5: random forest (100 trees, seed 42) predictions for the test documents."""
    _, pred, labels = _rf(spark, sf)
    names = F.array(*[F.lit(x) for x in labels])
    return pred.select("doc_id", "lang", "label", "prediction", names[F.col("prediction")].alias("predicted_lang"))


def q_rf_accuracy(spark, sf):
    """Accuracy by the evaluator and by aggregation."""
    _, pred, _ = _rf(spark, sf)
    acc = C.evaluator_accuracy(pred.select(F.col("label").cast("double"), F.col("prediction").cast("double")))
    table = C.accuracy_table(pred).withColumn("evaluator_accuracy", F.lit(acc))
    return table.withColumns({c: _r(c) for c in ("accuracy", "accuracy_pct", "evaluator_accuracy")})


def q_rf_confusion_matrix(spark, sf):
    """A3, O2: confusion matrix of the random forest."""
    return C.confusion_matrix(_rf(spark, sf)[1], "label")


def q_confusion_matrix(spark, sf):
    """A3, O2: confusion matrix of nearest-centroid predictions."""
    emb = spread(read_table(spark, sf, "embeddings"), "vec_id", scan_partitions(spark))
    pred = K.nearest_centroid(emb, "embedding", K.label_centroids(emb, "embedding", "label"), out_id="prediction")
    return C.confusion_matrix(pred, "label", "prediction")


# ---------------------------------------------------------------- next item

def _split_sequence(spark, sf):
    seq = sequence_items(joined_items(spark, sf), B.ORDER, B.ITEM_ORDER, "department_id", keep_sort_cols=False)
    return C.hash_split(seq, B.ORDER, TEST_PERCENT, SPLIT_SEED)


def _sequences(spark, sf):
    seq = _split_sequence(spark, sf)
    return seq.where(F.col("split") == "train"), seq.where(F.col("split") == "test")


def q_next_item_transition_topk(spark, sf):
    """Top-3 successors per item from training baskets."""
    train, _ = _sequences(spark, sf)
    top = N.top_next(N.transition_counts(train), 3)
    return top.select("prev_item", "item", "n", F.col("rank").cast("bigint"))


def q_next_item_transition_eval(spark, sf):
    """Hit rate of the transition model on test baskets."""
    train, test = _sequences(spark, sf)
    return N.hit_rate(N.transition_predictions(train, test, B.ORDER)).withColumn("accuracy", _r("accuracy"))


CONTEXT_DEPTH = 3


def q_next_item_context_topk(spark, sf):
    """The 3 most frequent items after every run of up to 3 items of training baskets."""
    train, _ = _sequences(spark, sf)
    top = X.context_topk(X.next_item_contexts(train, B.ORDER, CONTEXT_DEPTH), 3)
    return top.select(join_ints("context").alias("context"), "item", "n", F.col("rank").cast("bigint"))


def q_next_item_context_eval(spark, sf):
    """Hit rate of the longest known run of the history's last items, by its length."""
    train, test = _sequences(spark, sf)
    tree = X.context_tree(X.next_item_contexts(train, B.ORDER, CONTEXT_DEPTH))
    hidden = X.hidden_targets(X.item_windows(test, B.ORDER, CONTEXT_DEPTH))
    found = X.context_hit_rate(X.context_predictions(tree, hidden))
    return found.withColumn("accuracy", _r("accuracy"))


def q_next_item_factors_eval(spark, sf):
    """Hit rates of item factors (implicit ALS on the training baskets)."""
    return FA.factor_hit_rates(_split_sequence(spark, sf), B.ORDER)


def q_next_item_epochs(spark, sf):
    """Mean loss and held-out hits after every epoch of training."""
    return E.epoch_table(_split_sequence(spark, sf), B.ORDER, epochs=NEXT_ITEM_PARAMS["epochs"])


def _virtual_sequences(spark, sf):
    """Sequences of virtual product ids (KMeans cluster + 1 of the cleaned
    name), split into train/test orders by the key hash."""
    seq = sequence_items(_virtual_items(spark, sf), B.ORDER, B.ITEM_ORDER, "virtual_product_id", keep_sort_cols=False)
    seq = C.hash_split(seq, B.ORDER, TEST_PERCENT, SPLIT_SEED)
    return seq.where(F.col("split") == "train"), seq.where(F.col("split") == "test")


def q_next_item_virtual_transition_eval(spark, sf):
    """The project's flow end to end: virtual products from clustered names,
    next virtual product predicted by the transition model."""
    train, test = _virtual_sequences(spark, sf)
    return N.hit_rate(N.transition_predictions(train, test, B.ORDER)).withColumn("accuracy", _r("accuracy"))


def _fit_and_predict(train, test):
    """The classifier fitted on the training baskets and its predictions."""
    index = N.item_index(train, test)
    model = N.fit_classifier(N.history_features(train, B.ORDER, index))
    return model, N.classifier_predictions(model, N.history_features(test, B.ORDER, index), B.ORDER, index)


def q_next_item_virtual_classifier_accuracy(spark, sf):
    """Same flow with the logistic-regression classifier."""
    return N.hit_rate(_fit_and_predict(*_virtual_sequences(spark, sf))[1])


def q_next_item_classifier_predictions(spark, sf):
    """Logistic-regression next-item predictions."""
    return _fit_and_predict(*_sequences(spark, sf))[1]


def q_next_item_classifier_accuracy(spark, sf):
    """Hit rate of the classifier."""
    return N.hit_rate(_fit_and_predict(*_sequences(spark, sf))[1])


def q_next_item_classifier_loss(spark, sf):
    """Objective per iteration of the classifier fit."""
    model, _ = _fit_and_predict(*_sequences(spark, sf))
    rows = [(i, float(v)) for i, v in enumerate(N.loss_history(model))]
    return spark.createDataFrame(rows, "iteration int, loss double")


# ---------------------------------------------------------------- partitions and sinks

def q_repartition_counts(spark, sf):
    """Round-robin repartition into 4 and the partition count."""
    return repartition_report(read_table(spark, sf, "lineitem"), REPARTITION_N).select("n_partitions", "n_rows")


def q_feature_sink_roundtrip(spark, sf):
    """Fixed-vocabulary features written as parquet and read back."""
    return S.parquet_roundtrip(_fixed_vocab_dense(spark, sf), scratch_path(spark, "features"))


def q_cluster_labels_sink(spark, sf):
    """Cluster labels of the cleaned names written as parquet and read back."""
    labels = name_clusters(spark, sf)
    return S.parquet_roundtrip(labels, scratch_path(spark, "cluster-labels"))


def q_model_save_reload(spark, sf):
    """KMeans model saved, loaded and applied again."""
    prods = products(spark, sf)
    feats, _ = K.name_features(prods, n_words=TOP_WORDS)
    model = K.fit_kmeans(feats, k=N_CLUSTERS, seed=42, weight_col="n_products", layout_key=K.NAME)
    path = S.save_model(model, scratch_path(spark, "kmeans"))
    again = S.load_model(KMeansModel, path).setPredictionCol("cluster_reloaded")
    both = again.transform(model.transform(feats))
    return both.select(K.NAME, F.col("cluster").cast("int"), F.col("cluster_reloaded").cast("int"),
                       (F.col("cluster") == F.col("cluster_reloaded")).alias("same"))


def q_centres_save_reload(spark, sf):
    """The centres of the name clusters written as a version of a sink, loaded
    and applied again."""
    feats, _ = K.name_features(products(spark, sf), n_words=TOP_WORDS)
    feats = cut_lineage(feats.select(K.NAME, "n_products", "features"), "name-features")
    centres = G.fit_centres(G.grid_points(feats, weight_col="n_products"), N_CLUSTERS, KMEANS_STEPS)
    sink = scratch_path(spark, "centres")
    V.save_table(spark.createDataFrame(list(enumerate(centres)), "cluster int, v array<bigint>"), sink)
    again = [list(r["v"]) for r in V.load_table(spark, sink).orderBy("cluster").collect()]       # N_CLUSTERS rows
    both = G.assign(G.assign(feats, centres), again, out="cluster_reloaded")
    return both.select(K.NAME, "cluster", "cluster_reloaded", (F.col("cluster") == F.col("cluster_reloaded")).alias("same"))


def q_run_params_json(spark, sf):
    """Run parameters written as JSON and read back."""
    prods = products(spark, sf)
    mapped = B.attach_mapping(prods, rule_mapping(prods), K.NAME, "virtual_product_id")
    params = S.params_frame(spark, NEXT_ITEM_PARAMS, B.vocab_size_distinct(mapped, "virtual_product_id"))
    return S.write_params_json(params, scratch_path(spark, "params"))


def q_versioned_sink_history(spark, sf):
    """Three committed versions of a sink (the orders before a date, from it
    on, all of them), each read back by its number."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_totalprice"])
    sink, early = scratch_path(spark, "orders-sink"), F.col("o_orderdate") < F.lit(SPLIT_DATE).cast("date")
    for part in (orders.where(early), orders.where(~early), orders):
        V.save_table(part, sink)
    rows = [V.load_table(spark, sink, v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("n_rows"),
                                             F.sum("o_orderkey").alias("sum_orderkey"))
            for v in V.versions(spark, sink)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
