from pyspark.sql import functions as F

from contigloom.llm.sample import first_by_hash


def test_the_sample_is_the_first_by_hash_with_each_value_once(spark):
    rows = spark.range(20_000).select((F.col("id") % 9_000).cast("string").alias("v"), F.lit(1).alias("hash_x"))
    want = [r["v"] for r in rows.distinct().orderBy(F.xxhash64("v")).limit(300).collect()]
    got = first_by_hash(rows.repartition(7), "v", 300)
    assert got.columns == rows.columns and [r["v"] for r in got.collect()] == want
    assert first_by_hash(rows.limit(50), "v", 300).count() == 50
    assert first_by_hash(rows.limit(0), "v", 300).count() == 0


def test_nulls_are_one_value(spark):
    rows = spark.createDataFrame([(None,), (None,), ("a",)], "v string")
    assert sorted(str(r["v"]) for r in first_by_hash(rows, "v", 5).collect()) == ["None", "a"]
