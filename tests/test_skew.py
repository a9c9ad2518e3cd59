"""Hot groups: results must not depend on how rows are cut, and no task may get a whole hot group."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sensorwatch.operators import skew


@pytest.fixture(scope="module")
def lopsided(spark):
    """One key holds two thirds of the rows; some keys have a single row."""
    rng = np.random.default_rng(7)
    keys = np.where(rng.random(3000) < 0.66, 0, rng.integers(1, 400, 3000))
    frame = pd.DataFrame({"k": keys, "seq": rng.permutation(3000), "v": np.round(rng.normal(50, 9, 3000), 2)})
    return frame, spark.createDataFrame(frame).repartition(5).cache()


AGGREGATES = {"ma": F.avg, "std": F.stddev_samp}


def plain_rolling(frame, keys, rows):
    ordered = frame.sort_values([*keys, "seq"])
    grouped = ordered.groupby(keys)["v"] if keys else ordered["v"]
    roll = grouped.rolling(rows, min_periods=1)
    ordered["ma"], ordered["std"] = roll.mean().to_numpy(), roll.std().to_numpy()
    return ordered.sort_values("seq").reset_index(drop=True)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("rows, limit", [(10, 10_000), (10, 100), (10, 7), (3, 25), (1, 100), (40, 20)])
def test_rolling_equals_plain_window(spark, lopsided, keys, rows, limit):
    frame, df = lopsided
    found = skew.rolling(df, {n: f("v") for n, f in AGGREGATES.items()}, keys, ["seq"], rows, limit).toPandas()
    wanted = plain_rolling(frame, keys, rows)
    found = found.sort_values("seq").reset_index(drop=True)
    assert list(found["seq"]) == list(wanted["seq"])
    np.testing.assert_allclose(found["ma"], wanted["ma"], rtol=1e-9)
    np.testing.assert_allclose(found["std"].astype(float), wanted["std"], rtol=1e-6, atol=1e-6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=60), limit=st.integers(1, 30))
def test_rolling_sums_of_random_series(spark, values, limit):
    df = spark.createDataFrame(list(enumerate(values)), "seq long, v long")
    found = skew.rolling(df, {"s": F.sum("v")}, [], ["seq"], 4, limit).orderBy("seq").collect()
    assert [r["s"] for r in found] == [sum(values[max(0, i - 3): i + 1]) for i in range(len(values))]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double"])
def test_rolling_by_other_order_types(spark, lopsided, kind):
    _, df = lopsided
    moved = {
        "date": F.expr("date_add(date'2000-01-01', cast(seq as int))"), "double": F.col("seq") / 7,
        "timestamp": F.timestamp_seconds(F.col("seq") * 50), "timestamp_ntz": F.expr("timestamp_ntz'2000-01-01' + make_interval(0,0,0,0,0,0,seq*50)"),
    }[kind]
    timed = df.withColumn("at", moved)
    split = skew.rolling(timed, {"ma": F.avg("v")}, ["k"], ["at"], 10, 100).select("seq", F.round("ma", 8).alias("ma"))
    plain = skew.rolling(timed, {"ma": F.avg("v")}, ["k"], ["at"], 10, 10**6).select("seq", F.round("ma", 8).alias("ma"))
    assert split.exceptAll(plain).count() == 0 and split.count() == 3000


def test_parts_of_a_hot_group_are_bounded(spark, lopsided):
    frame, df = lopsided
    hot = skew.hot_groups(df, ["k"], 100)
    assert sorted(r["_rows"] for r in hot.table.collect()) == sorted(n for n in frame.groupby("k").size() if n > 100)
    sizes = skew.split_hot_groups(df, ["k"], ["seq"], hot, 100).groupBy("k", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200


def test_hot_groups_are_cut_by_any_whole_order(spark):
    rows = [("g", "2024-01-01", f"b{k:04d}", float(k % 7)) for k in range(400)]
    df = spark.createDataFrame(rows, "k string, day string, bid string, v double")
    hot = skew.hot_groups(df, ["k"], 50)
    sizes = skew.split_hot_groups(df, ["k"], ["day", "bid"], hot, 50).groupBy("k", "_part").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
    split = skew.rolling(df, {"ma": F.avg("v")}, ["k"], ["day", "bid"], 10, 50).select("bid", F.round("ma", 9).alias("ma"))
    plain = skew.rolling(df, {"ma": F.avg("v")}, ["k"], ["day", "bid"], 10, 10**6).select("bid", F.round("ma", 9).alias("ma"))
    assert split.exceptAll(plain).count() == 0 and split.count() == 400


def test_rows_with_a_map_can_be_salted(spark):
    df = spark.range(300).select(F.lit(1).alias("k"), "id", F.create_map(F.lit("a"), "id").alias("m"))
    groups = spark.createDataFrame([(1, "x")], "k int, g string")
    joined = skew.attach(df, groups, ["k"], skew.hot_groups(df, ["k"], 50), 50)
    assert joined.filter("g = 'x'").count() == 300


def test_global_rolling_has_no_single_partition_on_rows(spark, lopsided):
    _, df = lopsided
    plan = skew.rolling(df, {"ma": F.avg("v")}, [], ["seq"], 10, 200)._jdf.queryExecution().executedPlan().toString()
    staged = plan[: plan.index("Union") if "Union" in plan else len(plan)]
    assert "hashpartitioning(_part" in plan and "SinglePartition" not in staged


LEVELS = {"p0": 0.0, "p1": 0.01, "p33": 1 / 3, "p5": 0.5, "p95": 0.95, "p100": 1.0}


@pytest.mark.parametrize("limit", [10**6, 150, 10])
def test_quantiles_equal_numpy(spark, lopsided, limit):
    frame, df = lopsided
    overall = skew.exact_quantiles(df, "v", LEVELS, (), limit).first()
    np.testing.assert_allclose([overall[n] for n in LEVELS], np.quantile(frame["v"], list(LEVELS.values())), rtol=1e-12)
    per_key = {r["k"]: [r[n] for n in LEVELS] for r in skew.exact_quantiles(df, "v", LEVELS, ["k"], limit).collect()}
    assert len(per_key) == frame["k"].nunique()
    for key, values in frame.groupby("k")["v"]:
        np.testing.assert_allclose(per_key[key], np.quantile(values, list(LEVELS.values())), rtol=1e-12)


def test_quantile_of_one_repeated_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4990, F.lit(3.0)).otherwise(F.col("id")).alias("v"))
    found = skew.exact_quantiles(df, "v", {"m": 0.5, "t": 0.9995}, (), 50).first()
    wanted = np.quantile([3.0] * 4990 + list(range(4990, 5000)), [0.5, 0.9995])
    np.testing.assert_allclose([found["m"], found["t"]], wanted)


def test_parts_without_a_wanted_rank_are_not_shuffled(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).cast("double").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = skew.exact_quantiles(df, "v", {"m": 0.5, "t": 0.95}, (), 100)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
        np.testing.assert_allclose(list(found.first()), [499.5, 949.05])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, lopsided, how):
    _, df = lopsided
    groups = spark.range(0, 300, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("g"))
    groups = groups.union(groups.filter("k = 0"))
    plain = df.join(groups, "k", how)
    salted = skew.attach(df, groups, ["k"], skew.hot_groups(df, ["k"], 100), 100, how)
    assert sorted(salted.columns) == sorted(plain.columns)
    salted = salted.select(*plain.columns)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_salts_follow_the_size_of_the_group(spark):
    sizes = {1: 101, 2: 250, 3: 1600, 4: 7, 5: 200}
    df = spark.createDataFrame([(k,) for k, n in sizes.items() for _ in range(n)], "k int")
    hot = skew.hot_groups(df, ["k"], 100)
    assert (hot.groups, hot.rows) == (4, 2151) and not skew.hot_groups(df, ["k"], 10_000)
    marked = skew._with_salts(df, ["k"], hot, 100).distinct().collect()
    assert {r["k"]: r["_salts"] for r in marked} == {1: 2, 2: 4, 3: 16, 4: 1, 5: 2}


def test_plans_do_not_grow_with_the_number_of_hot_keys(spark, monkeypatch):
    """Nearly a million hot keys are written and joined; the plan is that of a few."""
    df = spark.range(0, 2_000_000, 1, 8).select((F.col("id") % 999_000).alias("k"), "id")
    groups = spark.range(0, 999_000, 1, 4).select(F.col("id").alias("k"), F.lit(2).alias("g"))
    hot = skew.hot_groups(df, ["k"], 1)
    assert (hot.groups, hot.rows) == (999_000, 2_000_000)
    joined = skew.attach(df, groups, ["k"], hot, 1)
    text = joined._jdf.queryExecution().analyzed().toString()
    few = skew.attach(df, groups, ["k"], skew.hot_groups(df.filter("k < 5"), ["k"], 1), 1)._jdf.queryExecution().analyzed().toString()
    assert len(text) < 1.5 * len(few) + 2000
    assert joined.agg(F.count("*"), F.sum("g")).first()[:] == (2_000_000, 4_000_000)
    monkeypatch.setattr(skew, "BROADCAST_GROUPS", 10)
    assert skew.attach(df, groups, ["k"], hot, 1).count() == 2_000_000


def test_salts_carry_no_unread_columns_through_the_joins(spark):
    rows = spark.range(60).selectExpr("id % 3 AS k", "id % 4 AS m", "id AS v", "concat('w', id) AS wide")
    groups = spark.range(3).selectExpr("id AS k", "id * 10 AS g")
    cells = spark.range(4).selectExpr("id AS m", "id * 7 AS c")
    hot = skew.hot_groups_of(rows, [["k"], ["m"]], 4)
    spread = rows.withColumn("_spread", skew.row_hash(rows))
    joined = skew.attach(spread, groups, ["k"], hot[0], 4, spread="_spread")
    joined = skew.attach(joined, cells, ["m"], hot[1], 4, spread="_spread").select("v", "g", "c")
    assert sorted(map(tuple, joined.collect())) == [(i, i % 3 * 10, i % 4 * 7) for i in range(60)]
    for df in (joined, skew.attach(rows, groups, ["k"], hot[0], 4).select("v", "g")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        depths = [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines()]
        for i, line in enumerate(plan.splitlines()):  # only the scan's side of the joins names the column
            below = next((k for k in range(i + 1, len(depths)) if depths[k] <= depths[i]), len(depths))
            assert "wide" not in line or not any("Join" in other for other in plan.splitlines()[i:below])
