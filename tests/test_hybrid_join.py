"""J1-J3 with masters beyond the broadcast bound: hot and NULL keys are spread."""

import statistics

from pyspark.sql import functions as F

from tripmart.operators.enrich import HOT_SHARE, enrich_trips, hot_keys, hybrid_join


def trips(spark, n=60_000):
    """A third of the trips on zone 7, a fifth without a zone, the others spread."""
    k = F.col("id")
    return spark.range(0, n, 1, 8).select(
        k, F.when(k % 3 == 0, F.lit(7)).when(k % 5 == 0, F.lit(None)).otherwise(k % 5000)
        .cast("int").alias("pu_location_id"),
        (F.xxhash64(k) % 4000).cast("int").alias("do_location_id"),
        F.when(k % 2 == 0, F.lit(1)).otherwise(k % 3000).cast("int").alias("ratecode_id"))


def masters(spark):
    k = F.col("id")
    rates = spark.range(2000).select(k.cast("int").alias("ratecode_id"),
                                     F.concat(F.lit("rate "), k).alias("ratecode_name"))
    zones = spark.range(4500).select(
        k.cast("int").alias("location_id"), F.concat(F.lit("b"), k).alias("borough"),
        F.when(k % 9 != 0, F.concat(F.lit("z"), k)).alias("zone"),
        F.lit(None).cast("string").alias("service_zone"))
    return rates, zones


def test_hybrid_join_equals_the_broadcast_join(spark):
    rates, zones = masters(spark)
    small = enrich_trips(trips(spark), rates, zones)
    large = enrich_trips(trips(spark), rates, zones, max_broadcast_rows=0)
    assert large.columns == small.columns and large.count() == 60_000
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_hot_keys_are_few_and_all(spark):
    found = hot_keys(trips(spark), ["pu_location_id", "ratecode_id", "do_location_id"])
    assert found == {"pu_location_id": [7], "ratecode_id": [1], "do_location_id": []}
    assert all(len(v) <= 1 / HOT_SHARE for v in found.values())
    assert hot_keys(trips(spark).limit(0), ["ratecode_id"]) == {"ratecode_id": []}


def test_no_task_of_the_shuffle_join_is_hot(spark):
    _, zones = masters(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = hybrid_join(trips(spark), "pu_location_id", zones, "location_id",
                             {"zone": "pu_zone"}, [7])
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * statistics.median(sizes)
