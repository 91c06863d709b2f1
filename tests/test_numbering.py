"""Numbers without a gap, in the order of a global sort."""

from pyspark.sql import functions as F

from kerbflow.operators import dense_numbers


def test_numbers_follow_the_order(spark):
    rows = spark.range(1_000_000).select("id", (F.xxhash64("id") % 1000).alias("score"), F.lit("x").alias("place"))
    got = dense_numbers(rows.repartition(7), [F.desc("score"), F.asc("id")], to="n")
    assert got.columns == ["id", "score", "place", "n"]
    rows.createOrReplaceTempView("scored")
    want = spark.sql("SELECT id, score, place, row_number() OVER (ORDER BY score DESC, id) AS n FROM scored")
    same = got.withColumn("n", F.col("n").cast("int"))
    assert same.exceptAll(want).isEmpty() and got.count() == 1_000_000


def test_numbers_go_on_and_replace_a_column(spark):
    rows = spark.createDataFrame([("b", 9), ("a", 9), (None, 9)], "name string, N int")
    got = dense_numbers(rows, [F.asc_nulls_last("name")], to="n", after=41)
    assert {(r.name, r.n) for r in got.collect() if True} == {("a", 42), ("b", 43), (None, 44)}
    assert dense_numbers(rows.limit(0), [F.asc("name")]).count() == 0


def test_one_very_frequent_value(spark):
    rows = spark.range(30_000).select("id", F.lit(1).alias("score"))
    got = dense_numbers(rows, [F.asc("score"), F.asc("id")], to="n")
    assert got.where("n <> id + 1").isEmpty()
