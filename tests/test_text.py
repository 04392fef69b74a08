from pyspark.sql import functions as F

from basketry.functions.text import clean_text, contains_ci, first_word, trailing_number


def _one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first()["x"]


def test_clean_hand_worked_cases(spark):
    cases = {
        "Gluten-Free 100% Crème   Brûlée Mix, 12 Pack": "glutenfree crme brle",
        "A the of": "",
        "Oil in Water & Vinegar": "oil water vinegar",
        "  Mix of\tNuts\n": "nuts",
        "123": "",
    }
    for raw, want in cases.items():
        assert _one(spark, clean_text("s"), raw) == want, raw
    assert _one(spark, clean_text("s"), None) is None


def test_clean_is_idempotent(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(clean_text("text").alias("c"))
    again = df.select(F.col("c"), clean_text("c").alias("c2"))
    assert again.where(F.col("c") != F.col("c2")).count() == 0


def test_first_word(spark):
    assert _one(spark, first_word("s"), "fresh  herbs") == "fresh"
    assert _one(spark, first_word("s"), " specialty cheeses") == "specialty"
    assert _one(spark, first_word("s"), "\tcold drinks") == "cold"
    assert _one(spark, first_word("s"), None) is None
    assert _one(spark, first_word("s"), "") is None
    assert _one(spark, first_word("s"), "   ") is None


def test_contains_and_trailing_number(spark):
    assert _one(spark, contains_ci("s", "Specialty"), "SPECIALTY cheese") is True
    assert _one(spark, trailing_number("s"), "Brand#17") == 17
    assert _one(spark, trailing_number("s"), "Brand#") is None


def test_rdd_route_equals_column_route(spark):
    """The row-lambda route (RDD map + filter) and the column route agree."""
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    rdd_words = (part.rdd.map(lambda r: (r["p_partkey"], r["p_name"].split()[0] if r["p_name"].split() else None))
                 .filter(lambda kv: kv[1] is not None and "cold" in kv[1].lower()).collect())
    col_words = (part.select("p_partkey", first_word("p_name").alias("w"))
                 .where(contains_ci("w", "cold")).collect())
    assert sorted(rdd_words) == sorted((r[0], r[1]) for r in col_words)
