"""Thresholds from stored sketches: exact while small, of bounded rank error beyond, and without a raw read."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sensorwatch.operators import thresholds


def weeks_of(spark, frame, parts=7):
    return spark.createDataFrame(frame).repartition(parts)


def test_rank_error_over_many_merged_weeks(spark, folder):
    """A key with two thirds of all rows, ties and an outlier tail; 60 weeks appended in two batches, one of them twice."""
    rng = np.random.default_rng(11)
    n = 120_000
    frame = pd.DataFrame({"k": np.where(rng.random(n) < 0.66, 0, rng.integers(1, 6, n)), "v": np.round(rng.lognormal(3, 1, n), 1), "i": np.arange(n) % 60})
    frame["year"], frame["week"] = (2020 + frame.i // 52).astype("int32"), (1 + frame.i % 52).astype("int32")
    rows = weeks_of(spark, frame.drop(columns="i"))
    for chosen in ("year = 2020", "year = 2021", "year = 2021"):
        thresholds.sketch_history(rows.filter(chosen), folder, ["v"], ["k"])
    history = spark.read.parquet(folder)
    assert history.count() == 60 * 6
    found = thresholds.merged_thresholds(history, "v", ["k"], 0.01, 0.99)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "v_sketch" in plan
    error = 2 * thresholds.rank_error()
    for r in found.collect():
        values = np.sort(frame.v[frame.k == r["k"]])
        assert r["rows"] == len(values)
        for level, limit in ((0.01, r["lo_limit"]), (0.99, r["hi_limit"])):
            low, high = np.searchsorted(values, limit, "left") / len(values), np.searchsorted(values, limit, "right") / len(values)
            assert low - error <= level <= high + error
    part = thresholds.merged_thresholds(history.filter("year = 2021 and week <= 4"), "v", ["k"])
    assert {r["k"]: r["rows"] for r in part.collect()} == frame[(frame.year == 2021) & (frame.week <= 4)].groupby("k").size().to_dict()


def test_small_sketches_are_exact(spark):
    rows = spark.createDataFrame([("a", float(i), 2020, 1 + i % 5) for i in range(1, 101)] + [("b", None, 2020, 1), ("c", 7.0, 2020, 2), ("c", float("nan"), 2020, 3)], "k string, v double, year int, week int")
    found = {r["k"]: (r["lo_limit"], r["hi_limit"], r["rows"]) for r in thresholds.merged_thresholds(thresholds.period_sketches(rows, ["v"], ["k"]), "v", ["k"], 0.1, 0.905).collect()}
    assert found == {"a": (10.0, 91.0, 100), "c": (7.0, 7.0, 1)}
    assert thresholds.merged_thresholds(thresholds.period_sketches(rows.filter("false"), ["v"], ["k"]), "v", ["k"]).count() == 0
    assert thresholds.rank_error(2_000) < 0.0025
