"""Blocks of a scan follow the bytes of the rows as well as their number."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from veilspark.operators import scan


def test_blocks_follow_bytes_and_positions_hold(spark):
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 10 != 0, F.when(F.col("id") % 3 == 0, "a").otherwise("b")).alias("k"),
        F.repeat(F.lit("x"), 2000).alias("text"), F.array(F.repeat(F.lit("y"), 500)).alias("nested"))
    rows = rows.unionByName(spark.createDataFrame([(5000, None, None, None)], "id long, k string, text string, nested array<string>"))
    spark.conf.set(scan.BLOCK_BYTES_CONF, str(1 << 20))
    try:
        assert scan.num_blocks(spark, df=rows) == 8  # 7.6 MB
        assert scan.num_blocks(spark, df=rows.select("id", "k")) == 1
        assert scan.num_blocks(spark, df=rows.limit(0)) == 1
        got = scan.keyed_row_number(rows, ["k"], ["id"], "rn")
        assert got.columns == [*rows.columns, "rn"]
        want = rows.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("long"))
        assert sorted(map(str, got.select("id", "k", "rn").collect())) == sorted(map(str, want.select("id", "k", "rn").collect()))
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()  # wide rows are shuffled once
    finally:
        spark.conf.unset(scan.BLOCK_BYTES_CONF)
