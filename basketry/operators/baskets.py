"""Baskets: order items joined to products and gathered into ordered arrays,
one row per order, plus the operators that work on them.

Ordering: items inside an order are placed by a total order key
(``ITEM_ORDER``, unique together with the order id), so "the last item" is
well defined no matter how the shuffle delivered the rows.  The arrays are
built as ONE list of structs (sort keys first) and then projected, so NULL
values keep the arrays aligned instead of silently shortening one of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.arrays import head, tail
from basketry.functions.keys import key_bucket
from basketry.functions.text import clean_text, trailing_number
from basketry.operators.sequence import sequence_items

ORDER = "order_id"
ITEM_ORDER = ("line_no", "order_product_id", "line_price")


def products_from_part(part: DataFrame) -> DataFrame:
    """Products view of ``part``: id, name, aisle id (number in the brand code),
    department id (size) and the cleaned name."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        trailing_number("p_brand").alias("aisle_id"),
        F.col("p_size").cast("int").alias("department_id"),
        clean_text("p_name").alias("processed_product_name"),
    )


def order_items_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Order items view of ``lineitem``: order id, product id (renamed as the
    item side of the join) and the in-order sort keys."""
    return lineitem.select(
        F.col("l_orderkey").alias(ORDER),
        F.col("l_partkey").alias("order_product_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_extendedprice").alias("line_price"),
    )


def join_items_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Inner equi-join on differently named keys (order_product_id = product_id).
    No hint: AQE turns it into a broadcast join when the product side is
    measured small at run time, and a shuffle join otherwise."""
    return items.join(products, items["order_product_id"] == products["product_id"], "inner")


def build_baskets(items: DataFrame, values: Mapping[str, Column | str], order_col: str = ORDER,
                  sort_cols: Sequence[str] = ITEM_ORDER) -> DataFrame:
    """One row per order; ``values`` maps output array name -> item column.

    Items are ordered by ``sort_cols`` ascending (NULL sort values first).
    ``collect_list`` of a struct is partially aggregated map-side, so an order
    split over many input partitions is merged without moving its raw rows.
    """
    fields = [F.col(c).alias(f"_k{i}") for i, c in enumerate(sort_cols)]
    # a value that is also a sort key travels once
    place = {name: f"_k{list(sort_cols).index(v)}" if isinstance(v, str) and v in sort_cols else name
             for name, v in values.items()}
    fields += [(F.col(v) if isinstance(v, str) else v).alias(name) for name, v in values.items() if place[name] == name]
    gathered = items.groupBy(order_col).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_items"))
    return gathered.select(order_col, *[F.col(f"_items.{place[name]}").alias(name) for name in values])


def build_basket_chunks(items: DataFrame, values: Mapping[str, str], chunk_size: int, order_col: str = ORDER,
                        sort_cols: Sequence[str] = ITEM_ORDER, partitions: int | None = None) -> DataFrame:
    """Baskets for skewed data: ``(order, chunk, first_pos, <arrays>)`` where
    chunk k holds the items at positions k*chunk_size+1 .. (k+1)*chunk_size.
    Concatenating an order's chunks by ``chunk`` gives its whole basket; no
    row ever holds more than ``chunk_size`` items, however large the order.
    Positions come from the range-partitioned ``sequence_items``."""
    names = list(values)
    first = names[0]
    seq = sequence_items(items.withColumns({n: F.col(c) for n, c in values.items()}), order_col, sort_cols, first,
                         out_item=first, partitions=partitions, carry=names[1:], keep_sort_cols=False)
    chunk = F.floor((F.col("pos") - 1) / F.lit(chunk_size)).cast("bigint")
    gathered = (seq.groupBy(order_col, chunk.alias("chunk"))
                   .agg(F.sort_array(F.collect_list(F.struct("pos", *names))).alias("_items"),
                        F.min("pos").alias("first_pos")))
    return gathered.select(order_col, "chunk", "first_pos", *[F.col(f"_items.{n}").alias(n) for n in names])


def leave_last_out_chunks(items: DataFrame, values: Mapping[str, str], chunk_size: int, order_col: str = ORDER,
                          sort_cols: Sequence[str] = ITEM_ORDER, partitions: int | None = None) -> DataFrame:
    """Leave-last-out for skewed data, in array form.

    For every basket of two or more items: rows ``(order, part, chunk,
    first_pos, <arrays>)``.  ``part`` 'history' chunk k holds the items at
    positions k*chunk_size+1 .. (k+1)*chunk_size of the basket without its last
    item (concatenating the chunks by ``chunk`` gives the history); ``part``
    'removed' is one row with the removed last item.  No row holds more than
    ``chunk_size`` items and nothing is joined back on the order, however large
    it is; baskets of items without an order id are one basket, kept like any
    other.  Positions and the last flag come from the range-partitioned
    ``sequence_items``."""
    names = list(values)
    seq = sequence_items(items.withColumns({n: F.col(c) for n, c in values.items()}), order_col, sort_cols, names[0],
                         out_item=names[0], partitions=partitions, carry=names[1:], keep_sort_cols=False)
    chunk = F.floor((F.col("pos") - 1) / F.lit(chunk_size)).cast("bigint")
    part = F.when(F.col("is_last"), F.lit("removed")).otherwise(F.lit("history"))
    gathered = (seq.where((F.col("pos") > 1) | ~F.col("is_last"))
                   .groupBy(order_col, part.alias("part"), chunk.alias("chunk"))
                   .agg(F.sort_array(F.collect_list(F.struct("pos", *names))).alias("_items"),
                        F.min("pos").alias("first_pos")))
    return gathered.select(order_col, "part", "chunk", "first_pos", *[F.col(f"_items.{n}").alias(n) for n in names])


def keep_min_size(baskets: DataFrame, column: str, min_size: int = 2) -> DataFrame:
    """Baskets with at least ``min_size`` items (a NULL array never passes)."""
    return baskets.filter(F.size(column) >= min_size)


def explode_items(baskets: DataFrame, column: str, out: str, order_col: str = ORDER) -> DataFrame:
    """One row per element with its 1-based position; empty arrays give no rows."""
    return baskets.select(order_col, F.posexplode(column).alias("pos", out)).withColumn("pos", F.col("pos") + 1)


def leave_last_out(baskets: DataFrame, cut: Mapping[str, str], remove_count: int | Column = 1) -> DataFrame:
    """Hide the last ``remove_count`` items: ``cut`` maps an array column to the
    name of the column that receives its removed tail; the array itself keeps
    the head.  Requires 1 <= remove_count < size (use ``keep_min_size``)."""
    rc = F.lit(remove_count) if isinstance(remove_count, int) else remove_count
    out = baskets.withColumn("remove_count", rc.cast("int"))
    out = out.withColumns({removed: tail(src, F.col("remove_count")) for src, removed in cut.items()})
    return out.withColumns({src: head(src, F.col("remove_count")) for src in cut})


def variable_remove_count(size_col: str, key_col: str, seed: int = 7) -> Column:
    """1 for baskets of size <= 3, else 1 or 2 chosen by a hash of the key
    (deterministic, independent of partitioning; see ``functions.keys``)."""
    return (F.when(F.size(size_col) <= 3, F.lit(1))
             .otherwise(key_bucket(key_col, 2, seed) + 1)).cast("int")


def max_ids(baskets: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Global maximum over array columns (``columns``: array -> short name) and
    the vocabulary sizes max + 1.  ``array_max`` per row, then one aggregate."""
    return _maxima(baskets, {n: F.array_max(c) for c, n in columns.items()})


def max_item_ids(items: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The same maxima from the items that the arrays are made of
    (``columns``: item column -> short name): one aggregate, and no basket is
    gathered."""
    return _maxima(items, {n: F.col(c) for c, n in columns.items()})


def _maxima(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    wide = df.agg(*[F.max(c).cast("bigint").alias(f"max_{n}") for n, c in columns.items()])
    return wide.select("*", *[(F.col(f"max_{n}") + 1).alias(f"{n}_vocab_size") for n in columns])


def vocab_size_distinct(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values + 1, where NULL counts as one value."""
    return df.select(column).distinct().agg((F.count(F.lit(1)) + 1).cast("bigint").alias("vocab_size"))


def dedupe_mapping(mapping: DataFrame, key: str, value: str) -> DataFrame:
    """One mapping row per key (the smallest value when a key maps to several)."""
    return mapping.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def attach_mapping(products: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Left join on a shared key column (USING), after deduplicating the
    mapping so each product keeps exactly one row."""
    return products.join(dedupe_mapping(mapping, key, value), on=key, how="left")


def mapping_fanout(products: DataFrame, key: str) -> DataFrame:
    """Row counts of the left join of products with a per-product mapping
    (one mapping row per product, joined on ``key``), without materialising
    it: a key shared by n products yields n*n rows; NULL keys match nothing
    and keep one row each.  Also reports the count with a deduplicated map."""
    per_key = products.groupBy(key).agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"))
    zero = F.lit(0).cast("decimal(38,0)")
    rows = F.when(F.col(key).isNull(), F.col("n")).otherwise((F.col("n") * F.col("n")).cast("decimal(38,0)"))
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).cast("bigint").alias("n_products"),
        F.coalesce(F.sum(rows), zero).cast("decimal(38,0)").alias("n_rows_per_product_map"),
        F.coalesce(F.sum("n"), zero).cast("bigint").alias("n_rows_distinct_map"),
    )
