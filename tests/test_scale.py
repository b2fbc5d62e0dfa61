from pyspark.sql import Window
from pyspark.sql import functions as F

from baitline.functions.strings import seeded_key
from baitline.plans.scale import (
    UNBOUNDED, cut_lineage, filter_late, lookup_join, measure, micros_of, shared_folder,
    with_exact_rank, with_neighbour,
)


def skewed(spark, n=2000):
    """One key holds more than half of the rows."""
    key = F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 7)
    return spark.range(n).withColumn("k", key)


def test_salted_join_equals_plain_join(spark):
    left = skewed(spark)
    right = spark.createDataFrame([(0, "a"), (2, "b"), (9, "c")], "k long, v string")
    for how in ("left", "inner"):
        want = sorted(map(str, left.join(right, "k", how).select("id", "v").collect()))
        salted = lookup_join(left, right, "k", ["id"], how, UNBOUNDED).select("id", "v")
        assert sorted(map(str, salted.collect())) == want


def test_hot_key_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = spark.createDataFrame([(0, "a")], "k long, v string")
        joined = lookup_join(skewed(spark), right, "k", ["id"], "inner", UNBOUNDED)
        assert joined.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measure_counts_rows_and_bytes(spark):
    size = measure(spark.createDataFrame([("ä",), (None,), ("bc",)], "v string"), "v")
    assert (size.rows, size.text_bytes) == (3, 4)
    assert size.fits_literal and size.fits_broadcast and not UNBOUNDED.fits_broadcast


def test_exact_rank_equals_row_number(spark):
    df = skewed(spark)
    key = seeded_key(1, F.col("id"))
    plain = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(key, "id")))
    for digits in (1, 4):
        got = with_exact_rank(df, "k", key, "id", "r", "n", digits)
        assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(
            map(tuple, plain.select("id", "r").collect()))
    sizes = {r["k"]: r["n"] for r in got.select("k", "n").distinct().collect()}
    assert sizes == {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}


def test_neighbour_shuffles_the_wide_rows_once(spark):
    df = skewed(spark).withColumn("ts", F.timestamp_seconds(F.col("id") * 50)).withColumn(
        "wide", F.lit("w"))
    plan = with_neighbour(df, "k", ["ts", "id"], F.col("id"), "before")
    text = plan._jdf.queryExecution().executedPlan().toString()
    carrying = [line for line in text.splitlines() if "Window" in line and "_inside" in line]
    assert len(carrying) == 1
    lag = F.lag("id").over(Window.partitionBy("k").orderBy("ts", "id"))
    assert sorted(map(str, plan.select("id", "before").collect())) == sorted(
        map(str, df.select("id", lag.alias("before")).collect()))


def test_late_filter_is_not_copied_below(spark):
    df = spark.range(10).withColumn("x", F.sqrt(F.col("id") * 1.0) + F.sqrt(F.col("id") + 1.0))
    kept = filter_late(df, F.col("x") > 3)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT") == 2 and kept.columns == ["id", "x"]
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.filter("x > 3").collect()))


def test_micros_do_not_depend_on_the_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:15.123456' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(micros_of(df, "ts")).first()[0] == 1711852215123456
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_checkpoints_go_to_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert named in shared_folder(spark)
    held = cut_lineage(spark.range(5))
    assert all(named in path for path in held.inputFiles())
    assert held.count() == 5
