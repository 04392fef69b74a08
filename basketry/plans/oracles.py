"""Independent DuckDB SQL for each deterministic catalogue query.

The SQL runs on views named after the test tables.  Column names and types
are aligned with the Spark results (aliases, BIGINT casts, rounding).  Queries
whose result depends on a model fitted in floating point (logistic regression,
factors, epochs), on a hash DuckDB does not have, or on file round trips of
model objects have no entry here.
"""

from __future__ import annotations

from basketry.functions.text import NAME_STOPWORD_PATTERN
from basketry.functions.keys import KEY_MULTIPLIER, KEY_PRIME
from basketry.operators.classify import FEATURES
from basketry.operators.forest import POISSON, SAMPLE, SAMPLE_TREE, SUBSET_TREE, mixed_sql, subset_size
from basketry.operators.gridkmeans import CANDIDATES
from basketry.plans.catalog import (BASKET_CHUNK, CONTEXT_DEPTH, DIGITS, DOCUMENT_COSINE, FIRST_WORD_NEEDLE, KMEANS_STEPS, LINEITEM_MEASURES,
                                    MAX_FEATURES, N_CLUSTERS, NAME_COSINE,
                                    NEXT_ITEM_PARAMS, REPARTITION_N, RETURNFLAG_LABELS, RF_BINS, RF_DEPTH, RF_TREES,
                                    SIMILAR_K, SPLIT_DATE, SPLIT_SEED, TEST_PERCENT, TOP_WORDS)

# The default English stopwords of Spark ML's StopWordsRemover,
# in the library's order (a test holds the list against the installed Spark).
SPARK_ENGLISH_STOPWORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())


def _lit_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def clean_sql(expr: str) -> str:
    stop = NAME_STOPWORD_PATTERN
    c = f"lower({expr})"
    c = rf"regexp_replace({c}, '\d+', '', 'g')"
    c = rf"regexp_replace({c}, '[^a-z\s]', '', 'g')"
    c = f"regexp_replace({c}, '{stop}', '', 'g')"
    c = rf"regexp_replace({c}, '\s+', ' ', 'g')"
    return f"trim({c})"


def tokens_sql(expr: str) -> str:
    stop = _lit_list(SPARK_ENGLISH_STOPWORDS)
    return (rf"list_filter(regexp_extract_all(lower(coalesce({expr}, '')), '\w\w+'), "
            f"lambda t: NOT list_contains({stop}, t))")


def key_bucket_sql(key: str, buckets: int, seed: int) -> str:
    return f"((({key} % {KEY_PRIME}) * {KEY_MULTIPLIER} + {seed}) % {KEY_PRIME}) % {buckets}"


def split_bucket_sql(key: str) -> str:
    return key_bucket_sql(key, 100, SPLIT_SEED)


ORDER_BY_ITEM = "line_no, order_product_id, line_price"

PRODUCTS = f"""products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         TRY_CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS aisle_id,
         CAST(p_size AS INTEGER) AS department_id,
         {clean_sql('p_name')} AS processed_product_name
  FROM part)"""
ITEMS = """items AS (
  SELECT l_orderkey AS order_id, l_partkey AS order_product_id, l_linenumber AS line_no,
         l_extendedprice AS line_price FROM lineitem)"""
JOINED = "joined AS (SELECT * FROM items JOIN products ON items.order_product_id = products.product_id)"
BASKETS = f"""baskets AS (
  SELECT order_id,
         list(order_product_id ORDER BY {ORDER_BY_ITEM}) AS product_ids,
         list(aisle_id ORDER BY {ORDER_BY_ITEM}) AS aisle_ids,
         list(department_id ORDER BY {ORDER_BY_ITEM}) AS department_ids,
         list(processed_product_name ORDER BY {ORDER_BY_ITEM}) AS product_names
  FROM joined GROUP BY order_id)"""
BASKET_CTES = f"WITH {PRODUCTS},\n{ITEMS},\n{JOINED},\n{BASKETS}"
RULE_MAP = f"""rule_map AS (
  SELECT processed_product_name,
         CAST(((length(processed_product_name) * 31 + ascii(processed_product_name)) % {N_CLUSTERS}) + 1 AS INTEGER)
           AS virtual_product_id
  FROM (SELECT DISTINCT processed_product_name FROM products WHERE processed_product_name IS NOT NULL))"""


def _ints(c: str, sep: str = ",") -> str:
    """Elements as text; NULL keeps its place."""
    return f"array_to_string(list_transform({c}, lambda x: coalesce(CAST(x AS VARCHAR), 'NULL')), '{sep}')"


def _tfidf_ctes(docs_sql: str, max_features: int = MAX_FEATURES) -> str:
    """CTEs docs(id, txt) -> w(id, term, weight), matching ``tfidf_long``."""
    return f"""docs AS ({docs_sql}),
toks AS (SELECT id, unnest({tokens_sql('txt')}) AS term FROM docs),
tf AS (SELECT id, term, count(*) AS tf FROM toks GROUP BY id, term),
ndocs AS (SELECT count(*) AS n FROM docs),
vocab AS (SELECT term FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {max_features}),
dfq AS (SELECT term, count(*) AS doc_freq FROM tf WHERE term IN (SELECT term FROM vocab) GROUP BY term),
idf AS (SELECT term, ln((1 + ndocs.n) / (1.0 + doc_freq)) + 1 AS idf FROM dfq, ndocs),
raw AS (SELECT tf.id, tf.term, tf.tf * idf.idf AS raw FROM tf JOIN idf USING (term)),
w AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM raw)"""


def _top_words(docs_sql: str) -> str:
    return f"""WITH {_tfidf_ctes(docs_sql)},
s AS (SELECT term, sum(weight) AS score FROM w GROUP BY term ORDER BY score DESC, term LIMIT {TOP_WORDS})
SELECT term, round(score, {DIGITS}) AS score,
       row_number() OVER (ORDER BY score DESC, term) AS rank FROM s"""


NAME_DOCS = f"SELECT DISTINCT {clean_sql('p_name')} AS id, {clean_sql('p_name')} AS txt FROM part"


def _cosine_topk(docs_sql: str, least: float, id_name: str, other_name: str) -> str:
    return f"""WITH {_tfidf_ctes(docs_sql)},
c AS (SELECT a.id AS i, b.id AS j, round(sum(a.weight * b.weight), {DIGITS}) AS cosine
      FROM w a JOIN w b ON a.term = b.term AND a.id <> b.id GROUP BY a.id, b.id),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY cosine DESC, j) AS rank FROM c WHERE cosine >= {least})
SELECT i AS {id_name}, rank, j AS {other_name}, cosine FROM r WHERE rank <= {SIMILAR_K}"""


def _context_ctes(depth: int = CONTEXT_DEPTH) -> str:
    """CTEs up to ``counts`` (context, len, item, n): contexts as text, the nearest item last."""
    lags = [f"lag(department_id, {d}) OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS i{d}" for d in range(1, depth + 1)]
    text = lambda n: " || ',' || ".join(f"CAST(i{d} AS VARCHAR)" for d in range(n, 0, -1)) or "''"
    runs = lambda rest: "\nUNION ALL ".join(
        f"SELECT {text(n)} AS context, {n} AS len, {rest} AND pos > {n}" for n in range(depth + 1))
    return f"""pos AS (
  SELECT order_id, department_id AS item, row_number() OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS pos,
         lead(1) OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) IS NULL AS is_last, {', '.join(lags)},
         CASE WHEN {split_bucket_sql('order_id')} < {TEST_PERCENT} THEN 'test' ELSE 'train' END AS split
  FROM joined),
runs AS ({runs("item FROM pos WHERE split = 'train'")}),
counts AS (SELECT context, len, item, count(*) AS n FROM runs GROUP BY context, len, item),
asked AS ({runs("order_id, item AS target_item FROM pos WHERE split = 'test' AND is_last AND pos > 1")})"""


PART_DOCS = f"SELECT p_partkey AS id, {clean_sql('p_name')} AS txt FROM part"
DOC_DOCS = f"SELECT doc_id AS id, {clean_sql('text')} AS txt FROM documents"

FIXED_VOCAB = f"""WITH {_tfidf_ctes(PART_DOCS)},
top AS (SELECT term, row_number() OVER (ORDER BY score DESC, term) - 1 AS feature_index
        FROM (SELECT term, sum(weight) AS score FROM w GROUP BY term ORDER BY score DESC, term LIMIT {TOP_WORDS})),
ftf AS (SELECT tf.id, tf.term, tf.tf FROM tf JOIN top USING (term)),
fidf AS (SELECT top.term, ln((1 + ndocs.n) / (1.0 + coalesce(d.doc_freq, 0))) + 1 AS idf
         FROM top CROSS JOIN ndocs LEFT JOIN (SELECT term, count(*) AS doc_freq FROM ftf GROUP BY term) d USING (term)),
fraw AS (SELECT ftf.id, ftf.term, ftf.tf * fidf.idf AS raw FROM ftf JOIN fidf USING (term)),
fw AS (SELECT id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY id)) AS weight FROM fraw)
SELECT docs.id AS product_id, CAST(top.feature_index AS BIGINT) AS feature_index, top.term,
       round(coalesce(fw.weight, 0.0), {DIGITS}) AS weight
FROM docs CROSS JOIN top LEFT JOIN fw ON fw.id = docs.id AND fw.term = top.term"""



def _name_cluster_ctes(k: int = N_CLUSTERS, steps: int = KMEANS_STEPS) -> str:
    """CTEs up to ``name_map`` (processed_product_name, cluster, virtual_product_id);
    expects ``products``.  KMeans in whole millionths, its rounds written out."""
    head = FIXED_VOCAB[len("WITH "):FIXED_VOCAB.rindex("SELECT docs.id AS product_id")].rstrip()
    d2 = "list_sum(list_transform(list_zip({0}, {1}), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    far, near = d2.format("x.v", "c.v"), d2.format("x.v", "c.v")
    ctes = [head, """vecs AS (SELECT docs.id, list(CAST(round(round(coalesce(fw.weight, 0.0), 6) * 1000000) AS BIGINT)
                          ORDER BY top.feature_index) AS v
         FROM docs CROSS JOIN top LEFT JOIN fw ON fw.id = docs.id AND fw.term = top.term GROUP BY docs.id)""",
            """named AS MATERIALIZED (SELECT processed_product_name, any_value(v) AS v, count(*) AS n
         FROM products JOIN vecs ON vecs.id = products.product_id WHERE processed_product_name IS NOT NULL
         GROUP BY processed_product_name)""",
            "x AS MATERIALIZED (SELECT v, CAST(sum(n) AS BIGINT) AS w FROM named GROUP BY v)",
            f"cand AS MATERIALIZED (SELECT v, w FROM x ORDER BY w DESC, v LIMIT {CANDIDATES})",
            "c1 AS MATERIALIZED (SELECT 0 AS c, v FROM (SELECT v FROM cand ORDER BY w DESC, v LIMIT 1))"]
    for j in range(2, k + 1):
        ctes.append(f"""c{j} AS MATERIALIZED (SELECT * FROM c{j - 1} UNION ALL SELECT {j - 1}, v FROM (
          SELECT v, CAST(w AS DOUBLE) * d AS score FROM (
            SELECT x.v, x.w, min({far}) AS d FROM cand x, c{j - 1} c GROUP BY x.v, x.w) WHERE d > 0 ORDER BY score DESC, v LIMIT 1))""")
    centres = f"c{k}"
    for t in range(steps):
        ctes.append(f"""m{t} AS MATERIALIZED (SELECT c, list(s ORDER BY i) AS v FROM (
          SELECT c, i, (2 * sum(w * e) + sum(w)) // (2 * sum(w)) AS s FROM (
            SELECT c, w, unnest(v) AS e, unnest(generate_series(1, len(v))) AS i FROM (
              SELECT x.v, x.w, arg_min(c.c, [CAST({near} AS BIGINT), c.c]) AS c FROM x, {centres} c GROUP BY x.v, x.w))
          GROUP BY c, i) GROUP BY c)""")
        ctes.append(f"""l{t} AS MATERIALIZED (SELECT c.c, CAST(coalesce(m.v, c.v) AS BIGINT[]) AS v FROM {centres} c LEFT JOIN m{t} m USING (c))""")
        centres = f"l{t}"
    ctes.append(f"""name_map AS MATERIALIZED (SELECT x.processed_product_name, CAST(arg_min(c.c, [CAST({near} AS BIGINT), c.c]) AS INTEGER) AS cluster
         FROM named x, {centres} c GROUP BY x.processed_product_name)""")
    return ",\n".join(ctes)


NAME_CLUSTERS = f"WITH {PRODUCTS},\n{_name_cluster_ctes()}"
NAME_MAP_SELECT = "SELECT processed_product_name, cluster, CAST(cluster + 1 AS INTEGER) AS virtual_product_id FROM name_map"
VIRTUAL = f"""{NAME_CLUSTERS}, {ITEMS},
virtual AS (SELECT products.*, CAST(cluster + 1 AS INTEGER) AS virtual_product_id
            FROM products LEFT JOIN name_map USING (processed_product_name)),
joined AS (SELECT * FROM items JOIN virtual ON items.order_product_id = virtual.product_id)"""

SEQ = f"""seq AS (
  SELECT order_id, department_id AS item,
         lag(department_id) OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS prev_item,
         lead(1) OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) IS NULL AS is_last,
         CASE WHEN {split_bucket_sql('order_id')} < {TEST_PERCENT} THEN 'test' ELSE 'train' END AS split
  FROM joined)"""
TRANSITIONS = """counts AS (SELECT prev_item, item, count(*) AS n FROM seq
                   WHERE split = 'train' AND prev_item IS NOT NULL GROUP BY prev_item, item)"""

TRANSITION_EVAL = f"""best AS (SELECT prev_item AS context_item, item AS best_next FROM (
                       SELECT *, row_number() OVER (PARTITION BY prev_item ORDER BY n DESC, item) AS rk FROM counts)
                     WHERE rk = 1),
            fb AS (SELECT item AS fallback_next FROM counts GROUP BY item ORDER BY sum(n) DESC, item LIMIT 1),
            t AS (SELECT order_id, prev_item AS context_item, item AS target_item FROM seq
                  WHERE split = 'test' AND is_last AND prev_item IS NOT NULL),
            p AS (SELECT t.*, coalesce(best.best_next, (SELECT fallback_next FROM fb)) AS predicted_item
                  FROM t LEFT JOIN best USING (context_item))
            SELECT count(*) AS n_baskets, CAST(coalesce(sum(CASE WHEN target_item = predicted_item THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_hits,
                   round(CAST(coalesce(sum(CASE WHEN target_item = predicted_item THEN 1 ELSE 0 END), 0) AS DOUBLE) / count(*), {DIGITS}) AS accuracy
            FROM p"""

DOC_FEATURES = """SELECT doc_id, lang,
            CAST(length(text) AS DOUBLE) AS f_chars,
            CAST(len(regexp_extract_all(text, '\\S+')) AS DOUBLE) AS f_words,
            CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS DOUBLE) AS f_lines,
            CAST(length(text) - length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')) AS DOUBLE) AS f_non_ascii
            FROM documents"""


def _forest_ctes() -> str:
    """CTEs up to ``pred`` (doc_id, lang, label, prediction) and ``nodes`` (tree, node,
    majority) with the splits ``best0`` ... of each level, repeating ``forest`` in SQL."""
    n = len(FEATURES)
    weight = " + ".join(f"CAST(h >= {p} AS INTEGER)" for p in POISSON)
    names = ", ".join(f"'{f}'" for f in FEATURES)
    places = ", ".join(f"(m.n * {j} + {RF_BINS - 1}) // {RF_BINS}" for j in range(1, RF_BINS))
    ctes = [f"feats AS MATERIALIZED (SELECT *, {split_bucket_sql('doc_id')} < {TEST_PERCENT} AS test FROM ({DOC_FEATURES}))",
            "labels AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label FROM (SELECT DISTINCT lang FROM feats WHERE lang IS NOT NULL))",
            "cells AS MATERIALIZED (SELECT doc_id, test, f, x FROM (" + " UNION ALL ".join(
                f"SELECT doc_id, test, {j} AS f, {f} AS x FROM feats" for j, f in enumerate(FEATURES)) + "))",
            f"""chosen AS (SELECT doc_id FROM feats WHERE NOT test
                ORDER BY {mixed_sql('doc_id', str(SAMPLE_TREE), SPLIT_SEED)}, doc_id LIMIT {SAMPLE})""",
            "ranked AS (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) AS rn FROM cells JOIN chosen USING (doc_id) WHERE x IS NOT NULL)",
            f"""picks AS (SELECT DISTINCT m.f, r.x FROM (SELECT f, count(*) AS n FROM ranked GROUP BY f) m
                JOIN ranked r ON r.f = m.f AND r.rn IN ({places}))""",
            "cuts AS MATERIALIZED (SELECT f, x, row_number() OVER (PARTITION BY f ORDER BY x) - 1 AS bin FROM picks)",
            """bins AS MATERIALIZED (SELECT c.doc_id, c.test, c.f, count(t.x) AS bin
                FROM cells c LEFT JOIN cuts t ON t.f = c.f AND t.x < c.x GROUP BY c.doc_id, c.test, c.f)""",
            f"""bag0 AS MATERIALIZED (SELECT * FROM (SELECT doc_id, label, CAST(tree AS BIGINT) AS tree, 1 AS node, {weight} AS w
                FROM (SELECT doc_id, label, tree, {mixed_sql('doc_id', 'tree', SPLIT_SEED)} AS h
                      FROM feats JOIN labels USING (lang), range({RF_TREES}) r(tree) WHERE NOT test)) WHERE w > 0)"""]
    for level in range(RF_DEPTH):
        ctes += [
            f"""open{level} AS (SELECT tree, node, f FROM (SELECT tree, node, f, row_number() OVER (PARTITION BY tree, node
                  ORDER BY {mixed_sql(f'node * {n} + f', f'tree + {SUBSET_TREE}', SPLIT_SEED)}, f) AS rk
                FROM (SELECT DISTINCT tree, CAST(node AS BIGINT) AS node FROM bag{level}), range({n}) r(f)) WHERE rk <= {subset_size(n)})""",
            f"""hist{level} AS (SELECT b.tree, b.node, s.f, s.bin, b.label, sum(b.w) AS n
                FROM bag{level} b JOIN open{level} o USING (tree, node) JOIN bins s ON s.doc_id = b.doc_id AND s.f = o.f GROUP BY ALL)""",
            f"""grid{level} AS (SELECT o.*, bin, label, coalesce(h.n, 0) AS n FROM open{level} o CROSS JOIN range({RF_BINS}) r(bin)
                CROSS JOIN labels LEFT JOIN hist{level} h USING (tree, node, f, bin, label))""",
            f"""sums{level} AS (SELECT *, sum(n) OVER (PARTITION BY tree, node, f, label ORDER BY bin) AS l,
                sum(n) OVER (PARTITION BY tree, node, f, label) AS t FROM grid{level})""",
            f"""best{level} AS MATERIALIZED (SELECT tree, node, f, bin FROM (
                SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY score DESC, f, bin) AS rk FROM (
                  SELECT tree, node, f, bin, CAST(sum(l * l) AS DOUBLE) / nullif(sum(l), 0)
                           + CAST(sum((t - l) * (t - l)) AS DOUBLE) / nullif(sum(t - l), 0) AS score,
                         CAST(sum(t * t) AS DOUBLE) / sum(t) AS bar
                  FROM sums{level} GROUP BY tree, node, f, bin) WHERE score > bar) WHERE rk = 1)""",
            f"""bag{level + 1} AS MATERIALIZED (SELECT b.doc_id, b.label, b.tree, 2 * b.node + CAST(s.bin > t.bin AS INTEGER) AS node, b.w
                FROM bag{level} b JOIN best{level} t USING (tree, node) JOIN bins s ON s.doc_id = b.doc_id AND s.f = t.f)"""]
    ctes.append("nodes AS MATERIALIZED (SELECT tree, node, arg_min(label, [-n, label]) AS majority FROM (" + " UNION ALL ".join(
        f"SELECT tree, node, label, CAST(sum(w) AS BIGINT) AS n FROM bag{i} GROUP BY ALL" for i in range(RF_DEPTH + 1)) + ") GROUP BY tree, node)")
    ctes.append(f"go0 AS (SELECT doc_id, CAST(tree AS BIGINT) AS tree, 1 AS node FROM feats, range({RF_TREES}) r(tree) WHERE test)")
    for level in range(RF_DEPTH):
        ctes.append(f"""go{level + 1} AS MATERIALIZED (SELECT g.doc_id, g.tree, CASE WHEN t.f IS NULL THEN g.node
                ELSE 2 * g.node + CAST(s.bin > t.bin AS INTEGER) END AS node
                FROM go{level} g LEFT JOIN best{level} t USING (tree, node) LEFT JOIN bins s ON s.doc_id = g.doc_id AND s.f = t.f)""")
    ctes.append(f"""votes AS (SELECT doc_id, arg_min(majority, [-n, majority]) AS prediction FROM (
                SELECT doc_id, majority, count(*) AS n FROM go{RF_DEPTH} JOIN nodes USING (tree, node) GROUP BY ALL) GROUP BY doc_id)""")
    ctes.append("""pred AS (SELECT doc_id, lang, CAST(label AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction
                FROM votes JOIN feats USING (doc_id) LEFT JOIN labels USING (lang))""")
    splits = " UNION ALL ".join(f"SELECT * FROM best{i}" for i in range(RF_DEPTH))
    ctes.append(f"""tree_nodes AS (SELECT CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, [{names}][f + 1] AS feature,
                c.x AS threshold, CAST(majority AS INTEGER) AS majority
                FROM nodes LEFT JOIN ({splits}) t USING (tree, node) LEFT JOIN cuts c USING (f, bin))""")
    return "WITH " + ",\n".join(ctes)


NULL_COUNTS_COLS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
CUSTOMER_NUMERIC = ("c_custkey", "c_nationkey", "c_acctbal")
CUSTOMER_TEXT = ("c_name", "c_mktsegment")


def _describe_sql() -> str:
    parts = []
    for c in CUSTOMER_NUMERIC:
        for stat, e in (("count", f"count({c})"), ("mean", f"avg({c})"), ("stddev", f"stddev_samp({c})"),
                        ("min", f"min({c})"), ("max", f"max({c})")):
            parts.append(f"SELECT '{c}' AS column_name, '{stat}' AS statistic, "
                         f"round(CAST({e} AS DOUBLE), {DIGITS}) AS num_value, CAST(NULL AS VARCHAR) AS str_value FROM customer")
    for c in CUSTOMER_TEXT:
        parts.append(f"SELECT '{c}', 'count', CAST(count({c}) AS DOUBLE), NULL FROM customer")
        parts.append(f"SELECT '{c}', 'mean', NULL, NULL")
        parts.append(f"SELECT '{c}', 'stddev', NULL, NULL")
        parts.append(f"SELECT '{c}', 'min', NULL, min({c}) FROM customer")
        parts.append(f"SELECT '{c}', 'max', NULL, max({c}) FROM customer")
    return "\nUNION ALL ".join(parts)


def _correlation_sql() -> str:
    parts = []
    for a in LINEITEM_MEASURES:
        for b in LINEITEM_MEASURES:
            if a != b:
                parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), {DIGITS}) AS corr FROM lineitem")
    return "\nUNION ALL ".join(parts)


def _fences(table: str, col: str) -> str:
    return f"""q AS (SELECT quantile_disc({col}, 0.25) AS q1, quantile_disc({col}, 0.75) AS q3 FROM {table}),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)"""


def _labels_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in RETURNFLAG_LABELS.items())
    return f"CASE {whens} END"


_SPARK_TYPES = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' " \
               "WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' WHEN 'BOOLEAN' THEN 'boolean' " \
               "WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(data_type) END"

PART_COLS = "CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice"

LKO_CTE = f"""k AS (
  SELECT *, CAST(CASE WHEN len(product_ids) <= 3 THEN 1 ELSE {key_bucket_sql('order_id', 2, 7)} + 1 END AS INTEGER) AS rc
  FROM baskets WHERE len(product_ids) >= 2)"""
LKO_SELECT = f"""SELECT order_id, rc AS remove_count,
       {_ints('product_ids[1:len(product_ids) - rc]')} AS product_ids,
       {_ints('aisle_ids[1:len(aisle_ids) - rc]')} AS aisle_ids,
       {_ints('department_ids[1:len(department_ids) - rc]')} AS department_ids,
       {_ints('product_names', '|')} AS product_names,
       {_ints('product_ids[len(product_ids) - rc + 1:len(product_ids)]')} AS removed_product_ids,
       {_ints('aisle_ids[len(aisle_ids) - rc + 1:len(aisle_ids)]')} AS removed_aisle_ids,
       {_ints('department_ids[len(department_ids) - rc + 1:len(department_ids)]')} AS removed_department_ids
FROM k"""

LLO_SELECT = f"""SELECT order_id, 1 AS remove_count,
       {_ints('product_ids[1:len(product_ids) - 1]')} AS product_ids,
       {_ints('aisle_ids[1:len(aisle_ids) - 1]')} AS aisle_ids,
       {_ints('department_ids[1:len(department_ids) - 1]')} AS department_ids,
       {_ints('product_names', '|')} AS product_names,
       {_ints('product_ids[len(product_ids):len(product_ids)]')} AS removed_product_ids,
       {_ints('aisle_ids[len(aisle_ids):len(aisle_ids)]')} AS removed_aisle_ids,
       {_ints('department_ids[len(department_ids):len(department_ids)]')} AS removed_department_ids
FROM baskets WHERE len(product_ids) >= 2"""


def oracle_sql() -> dict[str, str]:
    basket_cols = (f"order_id, CAST(len(product_ids) AS BIGINT) AS n_items, {_ints('product_ids')} AS product_ids, "
                   f"{_ints('aisle_ids')} AS aisle_ids, {_ints('department_ids')} AS department_ids, "
                   f"{_ints('product_names', '|')} AS product_names")
    return {
        "csv_scan_inferred": f"SELECT {PART_COLS} FROM part",
        "csv_scan_strings_cast": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
        "local_frame_source": """SELECT r_name, count(*) AS n_nations FROM nation
            JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
        "local_rows_schema": f"""SELECT l_returnflag, {_labels_case('l_returnflag')} AS flag_label, count(*) AS n
            FROM lineitem GROUP BY l_returnflag""",
        "train_test_by_date": f"""SELECT l_orderkey, l_linenumber, l_partkey,
            CASE WHEN o_orderdate >= DATE '{SPLIT_DATE}' THEN 'test' ELSE 'train' END AS split
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "schema_report": f"""SELECT CAST(ordinal_position AS INTEGER) AS ordinal, column_name,
            {_SPARK_TYPES} AS data_type, is_nullable = 'YES' AS nullable
            FROM information_schema.columns WHERE table_name = 'part'""",
        "head_rows": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
            FROM orders ORDER BY o_orderkey LIMIT 20""",
        "rdd_first_word_filter": f"""SELECT * FROM (
            SELECT p_partkey, nullif(regexp_extract(p_name, '^\\s*(\\S+)', 1), '') AS first_word FROM part)
            WHERE contains(lower(first_word), '{FIRST_WORD_NEEDLE}')""",
        "filter_eq_literal": "SELECT * FROM part WHERE p_partkey = 1",
        "group_sum_sorted": "SELECT p_name, CAST(sum(p_partkey) AS BIGINT) AS sum_p_partkey FROM part GROUP BY p_name",
        "describe_table": _describe_sql(),
        "row_counts": "\nUNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in
            ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings")),
        "class_counts": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag",
        "null_counts": "SELECT " + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in NULL_COUNTS_COLS)
                       + " FROM lineitem",
        "group_mean_stddev": f"""SELECT l_returnflag,
            round(avg(l_quantity), {DIGITS}) AS mean_quantity, round(avg(l_extendedprice), {DIGITS}) AS mean_extendedprice,
            round(stddev_samp(l_quantity), {DIGITS}) AS stddev_quantity,
            round(stddev_samp(l_extendedprice), {DIGITS}) AS stddev_extendedprice
            FROM lineitem GROUP BY l_returnflag""",
        "class_mean_lengths": f"""SELECT l_returnflag, {_labels_case('l_returnflag')} AS flag_label,
            round(avg(l_quantity), {DIGITS}) AS mean_quantity, round(avg(l_extendedprice), {DIGITS}) AS mean_extendedprice
            FROM lineitem GROUP BY l_returnflag""",
        "correlation_pairs": _correlation_sql(),
        "quartiles_exact": f"""WITH {_fences('customer', 'c_acctbal')}
            SELECT 'c_acctbal' AS column_name, round(q1, {DIGITS}) AS q1, round(q3, {DIGITS}) AS q3,
                   round(iqr, {DIGITS}) AS iqr, round(lower_fence, {DIGITS}) AS lower_fence,
                   round(upper_fence, {DIGITS}) AS upper_fence FROM f""",
        "iqr_outliers": f"""WITH {_fences('documents', 'n_chars')}
            SELECT doc_id, n_chars FROM documents, f WHERE n_chars < lower_fence OR n_chars > upper_fence""",
        "order_items_join_products": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED}
            SELECT order_id, order_product_id, product_id, product_name, aisle_id, department_id, line_no FROM joined""",
        "baskets": f"{BASKET_CTES}\nSELECT {basket_cols} FROM baskets",
        "baskets_min_size": f"{BASKET_CTES}\nSELECT {basket_cols} FROM baskets WHERE len(product_ids) >= 2",
        "basket_cast_elements": f"""{BASKET_CTES}
            SELECT order_id, {_ints('aisle_ids')} AS aisle_ids, {_ints('department_ids')} AS department_ids FROM baskets""",
        "basket_chunks": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED},
            pos AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS pos FROM joined)
            SELECT order_id, CAST((pos - 1) // {BASKET_CHUNK} AS BIGINT) AS chunk, min(pos) AS first_pos,
                   {_ints('list(order_product_id ORDER BY pos)')} AS product_ids,
                   {_ints('list(aisle_id ORDER BY pos)')} AS aisle_ids,
                   {_ints('list(department_id ORDER BY pos)')} AS department_ids,
                   {_ints('list(processed_product_name ORDER BY pos)', '|')} AS product_names
            FROM pos GROUP BY order_id, (pos - 1) // {BASKET_CHUNK}""",
        "basket_items_exploded": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED}
            SELECT order_id, row_number() OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS pos,
                   order_product_id AS product_id FROM joined""",
        "max_ids_from_arrays": f"""{BASKET_CTES}
            SELECT CAST(max(list_max(product_ids)) AS BIGINT) AS max_product,
                   CAST(max(list_max(aisle_ids)) AS BIGINT) AS max_aisle,
                   CAST(max(list_max(department_ids)) AS BIGINT) AS max_department,
                   CAST(max(list_max(product_ids)) AS BIGINT) + 1 AS product_vocab_size,
                   CAST(max(list_max(aisle_ids)) AS BIGINT) + 1 AS aisle_vocab_size,
                   CAST(max(list_max(department_ids)) AS BIGINT) + 1 AS department_vocab_size FROM baskets""",
        "vocab_size_distinct": f"""WITH {PRODUCTS}, {RULE_MAP}
            SELECT CAST(count(*) + 1 AS BIGINT) AS vocab_size FROM (
              SELECT DISTINCT m.virtual_product_id FROM products p LEFT JOIN rule_map m USING (processed_product_name))""",
        "leave_last_out": f"{BASKET_CTES}\n{LLO_SELECT}",
        "leave_k_out_variable": f"{BASKET_CTES},\n{LKO_CTE}\n{LKO_SELECT}",
        "leave_last_out_long": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED},
            s AS (SELECT order_id, order_product_id AS product_id, department_id,
                         row_number() OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS pos,
                         count(*) OVER (PARTITION BY order_id) AS n FROM joined)
            SELECT order_id, pos, product_id, department_id,
                   CASE WHEN pos = n THEN 'removed' ELSE 'history' END AS role FROM s WHERE n >= 2""",
        "leave_last_out_chunks": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED},
            s AS (SELECT order_id, order_product_id, aisle_id, department_id,
                         row_number() OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS pos,
                         count(*) OVER (PARTITION BY order_id) AS n FROM joined)
            SELECT order_id, CASE WHEN pos = n THEN 'removed' ELSE 'history' END AS part,
                   CAST((pos - 1) // {BASKET_CHUNK} AS BIGINT) AS chunk, min(pos) AS first_pos,
                   {_ints('list(order_product_id ORDER BY pos)')} AS product_ids,
                   {_ints('list(aisle_id ORDER BY pos)')} AS aisle_ids,
                   {_ints('list(department_id ORDER BY pos)')} AS department_ids
            FROM s WHERE n >= 2 GROUP BY order_id, pos = n, (pos - 1) // {BASKET_CHUNK}""",
        "one_hot_target": f"""{BASKET_CTES},
            llo AS (SELECT order_id, department_ids[len(department_ids)] AS target, department_ids FROM baskets
                    WHERE len(product_ids) >= 2),
            width AS (SELECT max(list_max(department_ids)) + 1 AS v FROM llo)
            SELECT order_id, target,
                   array_to_string(list_transform(range(0, width.v), lambda i: CASE WHEN i = target THEN 1 ELSE 0 END), ',')
                     AS one_hot
            FROM llo, width""",
        "text_clean": f"SELECT p_partkey AS product_id, {clean_sql('p_name')} AS processed_product_name FROM part",
        "text_clean_documents": f"SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents",
        "tokenize_names": f"SELECT p_partkey AS product_id, array_to_string({tokens_sql(clean_sql('p_name'))}, ' ') AS tokens FROM part",
        "tfidf_weights": f"WITH {_tfidf_ctes(PART_DOCS)}\nSELECT id AS product_id, term, round(weight, {DIGITS}) AS weight FROM w",
        "tfidf_top_words": _top_words(PART_DOCS),
        "tfidf_top_words_documents": _top_words(DOC_DOCS),
        "tfidf_fixed_vocab": FIXED_VOCAB,
        "frequent_words_documents": f"""SELECT term, count(*) AS total FROM (SELECT unnest({tokens_sql('txt')}) AS term FROM ({DOC_DOCS}))
            GROUP BY term ORDER BY total DESC, term LIMIT {MAX_FEATURES}""",
        "feature_sink_roundtrip": FIXED_VOCAB,
        "nearest_centroid": f"""WITH x AS (SELECT vec_id, label, unnest(embedding) AS e,
                                       unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
            c AS (SELECT label AS cid, i, avg(e) AS m FROM x GROUP BY label, i),
            d AS (SELECT x.vec_id, x.label, c.cid, sum((x.e - c.m) * (x.e - c.m)) AS dist
                  FROM x JOIN c ON x.i = c.i GROUP BY x.vec_id, x.label, c.cid),
            r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rk FROM d)
            SELECT vec_id, label, cid AS nearest_label, round(dist, {DIGITS}) AS distance FROM r WHERE rk = 1""",
        "confusion_matrix": """WITH x AS (SELECT vec_id, label, unnest(embedding) AS e,
                                       unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
            c AS (SELECT label AS cid, i, avg(e) AS m FROM x GROUP BY label, i),
            d AS (SELECT x.vec_id, x.label, c.cid, sum((x.e - c.m) * (x.e - c.m)) AS dist
                  FROM x JOIN c ON x.i = c.i GROUP BY x.vec_id, x.label, c.cid),
            r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cid) AS rk FROM d)
            SELECT label, cid AS prediction, count(*) AS n FROM r WHERE rk = 1 GROUP BY label, cid""",
        "cluster_map_left_join": f"""WITH {PRODUCTS}, {RULE_MAP}
            SELECT p.product_id, p.processed_product_name, m.virtual_product_id
            FROM products p LEFT JOIN rule_map m USING (processed_product_name)""",
        "cluster_map_fanout_count": f"""WITH {PRODUCTS},
            k AS (SELECT processed_product_name AS name, count(*) AS n FROM products GROUP BY processed_product_name)
            SELECT CAST(sum(n) AS BIGINT) AS n_products,
                   CAST(sum(CASE WHEN name IS NULL THEN n ELSE CAST(n AS HUGEINT) * n END) AS DECIMAL(38, 0))
                     AS n_rows_per_product_map,
                   CAST(sum(n) AS BIGINT) AS n_rows_distinct_map FROM k""",
        "assemble_features": DOC_FEATURES,
        "rf_nodes": f"{_forest_ctes()} SELECT * FROM tree_nodes",
        "rf_predictions": f"""{_forest_ctes()}
            SELECT pred.*, l.lang AS predicted_lang FROM pred LEFT JOIN labels l ON l.label = pred.prediction""",
        "rf_accuracy": f"""{_forest_ctes()},
            a AS (SELECT count(*) AS n, CAST(sum(CAST(label = prediction AS INTEGER)) AS BIGINT) AS n_correct FROM pred)
            SELECT n, n_correct, round(n_correct / n, {DIGITS}) AS accuracy, round(100 * (n_correct / n), {DIGITS}) AS accuracy_pct,
                   round(n_correct / n, {DIGITS}) AS evaluator_accuracy FROM a""",
        "rf_confusion_matrix": f"{_forest_ctes()} SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction",
        "train_test_split": f"""SELECT doc_id,
            CASE WHEN {split_bucket_sql('doc_id')} < {TEST_PERCENT} THEN 'test' ELSE 'train' END AS split,
            CAST({split_bucket_sql('doc_id')} AS BIGINT) AS split_bucket FROM documents""",
        "next_item_transition_topk": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED}, {SEQ}, {TRANSITIONS},
            r AS (SELECT *, row_number() OVER (PARTITION BY prev_item ORDER BY n DESC, item) AS rank FROM counts)
            SELECT prev_item, item, n, rank FROM r WHERE rank <= 3""",
        "next_item_transition_eval": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED}, {SEQ}, {TRANSITIONS},
            {TRANSITION_EVAL}""",
        "kmeans_clusters": f"{NAME_CLUSTERS}\n{NAME_MAP_SELECT}",
        "cluster_labels_sink": f"{NAME_CLUSTERS}\n{NAME_MAP_SELECT}",
        "centres_save_reload": f"""{NAME_CLUSTERS}
            SELECT processed_product_name, cluster, cluster AS cluster_reloaded, true AS same FROM name_map""",
        "cluster_members": f"""{NAME_CLUSTERS}
            SELECT CAST(cluster + 1 AS INTEGER) AS virtual_product_id, processed_product_name, count(*) AS n_products
            FROM products JOIN name_map USING (processed_product_name) GROUP BY ALL""",
        "vocab_size_clusters": f"""{NAME_CLUSTERS}
            SELECT CAST(count(*) + 1 AS BIGINT) AS vocab_size FROM (
              SELECT DISTINCT m.cluster FROM products p LEFT JOIN name_map m USING (processed_product_name))""",
        "virtual_product_baskets": f"""{VIRTUAL},
            b AS (SELECT order_id, list(virtual_product_id ORDER BY {ORDER_BY_ITEM}) AS v, list(product_id ORDER BY {ORDER_BY_ITEM}) AS p,
                         list(aisle_id ORDER BY {ORDER_BY_ITEM}) AS a, list(department_id ORDER BY {ORDER_BY_ITEM}) AS d,
                         list(processed_product_name ORDER BY {ORDER_BY_ITEM}) AS names
                  FROM joined GROUP BY order_id HAVING count(*) >= 2)
            SELECT order_id, {_ints('v[1:len(v) - 1]')} AS virtual_product_id, {_ints('p')} AS product_id,
                   {_ints('a[1:len(a) - 1]')} AS aisle_ids, {_ints('d[1:len(d) - 1]')} AS department_ids,
                   {_ints('names', '|')} AS processed_product_name, 1 AS remove_count,
                   {_ints('v[len(v):len(v)]')} AS removed_order_product_ids, {_ints('a[len(a):len(a)]')} AS removed_aisle_ids,
                   {_ints('d[len(d):len(d)]')} AS removed_department_ids FROM b""",
        "virtual_product_chunks": f"""{VIRTUAL},
            s AS (SELECT order_id, virtual_product_id, aisle_id, department_id,
                         row_number() OVER (PARTITION BY order_id ORDER BY {ORDER_BY_ITEM}) AS pos,
                         count(*) OVER (PARTITION BY order_id) AS n FROM joined)
            SELECT order_id, CASE WHEN pos = n THEN 'removed' ELSE 'history' END AS part,
                   CAST((pos - 1) // {BASKET_CHUNK} AS BIGINT) AS chunk, min(pos) AS first_pos,
                   {_ints('list(virtual_product_id ORDER BY pos)')} AS virtual_product_ids,
                   {_ints('list(aisle_id ORDER BY pos)')} AS aisle_ids,
                   {_ints('list(department_id ORDER BY pos)')} AS department_ids
            FROM s WHERE n >= 2 GROUP BY order_id, pos = n, (pos - 1) // {BASKET_CHUNK}""",
        "next_item_virtual_transition_eval": f"""{VIRTUAL},
            {SEQ.replace('department_id', 'virtual_product_id')}, {TRANSITIONS}, {TRANSITION_EVAL}""",
        "next_item_context_topk": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED}, {_context_ctes()},
            r AS (SELECT *, row_number() OVER (PARTITION BY context ORDER BY n DESC, item) AS rank FROM counts)
            SELECT context, item, n, rank FROM r WHERE rank <= 3""",
        "next_item_context_eval": f"""WITH {PRODUCTS}, {ITEMS}, {JOINED}, {_context_ctes()},
            best AS (SELECT context, item AS predicted_item FROM (
                       SELECT *, row_number() OVER (PARTITION BY context ORDER BY n DESC, item) AS rk FROM counts) WHERE rk = 1),
            p AS (SELECT order_id, target_item, len, predicted_item,
                         row_number() OVER (PARTITION BY order_id ORDER BY len DESC) AS rk FROM asked JOIN best USING (context))
            SELECT CAST(len AS INTEGER) AS context_len, count(*) AS n_baskets,
                   CAST(coalesce(sum(CASE WHEN target_item = predicted_item THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_hits,
                   round(CAST(coalesce(sum(CASE WHEN target_item = predicted_item THEN 1 ELSE 0 END), 0) AS DOUBLE) / count(*), {DIGITS})
                     AS accuracy
            FROM p WHERE rk = 1 GROUP BY ROLLUP (len)""",
        "cosine_topk": _cosine_topk(NAME_DOCS, NAME_COSINE, "processed_product_name", "similar_name"),
        "cosine_topk_documents": _cosine_topk(DOC_DOCS, DOCUMENT_COSINE, "doc_id", "similar_doc_id"),
        "repartition_counts": f"SELECT CAST({REPARTITION_N} AS BIGINT) AS n_partitions, count(*) AS n_rows FROM lineitem",
        "versioned_sink_history": "\nUNION ALL ".join(
            f"SELECT {v} AS version, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS sum_orderkey FROM orders WHERE {cond}"
            for v, cond in ((1, f"o_orderdate < DATE '{SPLIT_DATE}'"), (2, f"o_orderdate >= DATE '{SPLIT_DATE}'"), (3, "true"))),
        "run_params_json": f"""WITH {PRODUCTS}, {RULE_MAP}
            SELECT CAST(count(*) + 1 AS BIGINT) AS vocab_size, {NEXT_ITEM_PARAMS['embedding_dim']} AS embedding_dim,
                   {NEXT_ITEM_PARAMS['hidden_dim']} AS hidden_dim, CAST({NEXT_ITEM_PARAMS['learning_rate']} AS DOUBLE) AS learning_rate,
                   {NEXT_ITEM_PARAMS['epochs']} AS epochs, {NEXT_ITEM_PARAMS['batch_size']} AS batch_size,
                   CAST({NEXT_ITEM_PARAMS['dropout_prob']} AS DOUBLE) AS dropout_prob
            FROM (SELECT DISTINCT m.virtual_product_id FROM products p LEFT JOIN rule_map m USING (processed_product_name))""",
    }
