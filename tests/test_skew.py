"""One key holding most of the rows must neither change results nor gather in one task."""

import contextlib

from pyspark.sql import functions as F

from quotelens.operators import rates, vehicles
from quotelens.operators.joins import lookup_join
from tests import frames
from verification.mapping import CONFIG


@contextlib.contextmanager
def settings(spark, **values):
    values = {"spark.sql." + k.replace("_", "."): v for k, v in values.items()}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in values:
            spark.conf.unset(k)


def final_plan(frame):
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_a_lookup_join_is_split(spark):
    rows = spark.range(400_000).select(
        F.when(F.col("id") < 300_000, -1).otherwise(F.col("id") % 999).alias("k"), F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("padding"))
    lookup = spark.range(5000).select((F.col("id") % 1000 - 1).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    with settings(
        spark, autoBroadcastJoinThreshold="-1", adaptive_autoBroadcastJoinThreshold="-1",
        adaptive_skewJoin_skewedPartitionThresholdInBytes="100KB", adaptive_skewJoin_skewedPartitionFactor="1.5",
        adaptive_advisoryPartitionSizeInBytes="200KB",
    ):
        for how, expected in {"left": 400_000, "left_semi": 400_000, "left_anti": 0, "inner": 400_000}.items():
            found, plan = final_plan(lookup_join(rows, lookup, ["k"], how))
            assert len(found) == expected, how
            assert "skew=true" in plan, how
        # what the helper is for: the aggregate by itself keeps the hot key in one task
        assert "skew=true" not in final_plan(rows.join(lookup, "k"))[1]


def test_small_lookup_is_broadcast_by_measured_size(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"))
    lookup = spark.range(7).select(F.col("id").alias("k")).groupBy("k").count()
    found, plan = final_plan(lookup_join(rows, lookup, ["k"], "left"))
    assert len(found) == 1000 and "BroadcastHashJoin" in plan


def test_hot_policy(spark):
    """Half a million iterations of one policy, in one job, against the closed form."""
    ids = spark.range(500_000)
    rate = frames.rate(spark, {}).drop("RateIteration", "RateId", "TotalPremium", "Purchased").crossJoin(
        ids.select(
            (F.col("id") + 1).cast("int").alias("RateIteration"), F.col("id").alias("RateId"),
            (F.col("id") + 1).cast("decimal(12,2)").alias("TotalPremium"),
            (F.col("id") == 499_999).cast("int").alias("Purchased")))
    [kept] = rates.clean_rates(rate, CONFIG).collect()
    assert (kept.RateId, kept.RateIteration, kept.PurchasedFinal) == (0, 1, 1)
    assert rates.drop_inconsistent_policies(rate).count() == 500_000
    plan = rates.clean_rates(rate, CONFIG)._jdf.queryExecution().executedPlan().toString()
    # partial aggregate below the only shuffle of raw quotes, the window above it
    assert plan.index("Window") < plan.rindex("Exchange hashpartitioning") < plan.rindex("partial_min")


def test_hot_rate_of_vehicles(spark):
    car = frames.car(spark, {}).drop("RateVehicleId").crossJoin(
        spark.range(300_000).select((300_000 - F.col("id")).alias("RateVehicleId")))
    [profile] = vehicles.car_profile(car).collect()
    assert (profile.NumVehicles, profile.CompPremium) == (300_000, 30_000_000.0)
