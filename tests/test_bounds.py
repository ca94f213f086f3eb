from pyspark.sql import functions as F

from exactsync.queries import jobs, writes
from exactsync.queries.registry import load
from exactsync.sources.split import KeyLayout, RangeSplit

SF = "/root/testdata/sf0.001"


def largest_share(keys, layout):
    counts = [r["count"] for r in keys.groupBy(layout.slice_id().alias("s")).count().collect()]
    return max(counts) / sum(counts)


def test_ranges_of_the_queries_follow_the_keys(spark, tmp_path):
    orders = load(spark, SF, "orders")
    moved = orders.withColumn("o_orderkey", (F.col("o_orderkey") + 10_000_000).cast(orders.schema["o_orderkey"].dataType))
    moved.write.parquet(f"{tmp_path}/orders.parquet")
    keys = load(spark, str(tmp_path), "orders").select(F.col("o_orderkey").alias("id"))
    for target in (jobs._job(spark, str(tmp_path), "upsert")[0].target, writes._priced_target(spark, str(tmp_path))):
        assert largest_share(keys, target.layout) < 0.3


def test_number_of_ranges_grows_and_is_bounded(spark):
    rows = spark.range(-50, 950)
    assert RangeSplit.over(rows, "id", 4) == RangeSplit("id", -50, 950, 4)
    assert KeyLayout.over(rows, "id", 4, rows_each=10) == KeyLayout("id", -50, 950, 100)
    assert RangeSplit.over(rows, "id", 4, rows_each=1).partitions == 1000
    assert RangeSplit.over(rows.where("id > 5000"), "id", 4).slices >= 1
