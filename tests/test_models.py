import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorwatch.operators import forecast as fc
from sensorwatch.operators.forest import PRIME, ForestModel, IsolationForest, contamination_sweep, mean_unsuccessful_path, scrambled, tree_numbers


@pytest.fixture(scope="module")
def planted(spark):
    """1,000 points around the origin and 10 far away."""
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(0, 1, (1000, 2)), rng.normal(0, 1, (10, 2)) + [[25, -25]]])
    frame = pd.DataFrame(points, columns=["x", "y"]).assign(id=range(1010))
    return spark.createDataFrame(frame).cache()


def labels(rows):
    return {r["id"]: r["outlier"] for r in rows.collect()}


def test_planted_outliers_under_any_partitioning(spark, planted):
    forest = IsolationForest(["x", "y"], seed=11, contamination=0.01)
    found = [labels(forest.fit_score(planted.repartition(n), ["id"])[1]) for n in (1, 4, 17)]
    assert found[0] == found[1] == found[2]
    assert all(found[0][i] == -1 for i in range(1000, 1010))
    assert abs(sum(v == -1 for v in found[0].values()) - 0.01 * 1010) <= 1


def test_other_seed_other_trees(spark, planted):
    one, two = (IsolationForest(["x", "y"], seed=s, trees=5).fit(planted, ["id"]).nodes for s in (1, 2))
    assert one != two


def tickets(numbers, seed, tree):
    """The ticket of each whole number in a tree, with numbers of any size."""
    f1, o1, f2, o2, _ = tree_numbers(seed, tree)
    found = []
    for n in numbers:
        a = scrambled((scrambled((n % PRIME + seed) % PRIME) + n // PRIME) % PRIME)
        b = scrambled((a + 1) % PRIME)
        found.append(((a * f1 + o1) % PRIME + ((b * f2 + o2) % PRIME + 0.5) / PRIME) / PRIME)
    return np.array(found)


@pytest.mark.parametrize("size, parts", [(50, 3), (199_000, 5), (201_000, 9)])
def test_samples_are_the_smallest_tickets(spark, size, parts):
    """Whatever the number of rows and of partitions, and however low the first level."""
    numbers = np.arange(size) * 3_000_000_019 + 5
    rows = spark.range(0, size, 1, parts).select((F.col("id") * 3_000_000_019 + 5).alias("_id"))
    forest, wanted = IsolationForest([], seed=8, trees=3), min(64, size)
    for available in (size, 1000 * size):
        found = forest.draw(rows, wanted, available).collect()
        for tree in range(3):
            mine = [r["_id"] for r in sorted(found, key=lambda r: r["place"]) if r["tree"] == tree]
            assert mine == numbers[np.argsort(tickets(numbers.tolist(), 8, tree))[:wanted]].tolist()


def test_copies_stand_by_their_number(spark):
    """Two thirds of the rows are copies of one point, one pair is twice there; each has its share of the draws."""
    rng = np.random.default_rng(9)
    frame = pd.DataFrame(rng.normal(0, 1, (3000, 2)), columns=["x", "y"])
    frame.iloc[:2000] = 0.25
    frame.iloc[2990:] += 40
    frame.iloc[2100] = frame.iloc[2101]
    rows = spark.createDataFrame(frame)
    forest = IsolationForest(["x", "y"], seed=4, contamination=0.005, trees=30, sample_size=100)
    slim = forest._slim(rows, ["x", "y"], None)
    drawn = forest.draw(slim, 100, 3000)
    copied = slim.filter("x = 0.25").first()["_id"]
    by_tree = {r["tree"]: (r["n"], r["copies"]) for r in drawn.groupBy("tree").agg(F.count("*").alias("n"), F.count_if(F.col("_id") == copied).alias("copies")).collect()}
    assert len(by_tree) == 30 and all(n == 100 and 45 < c < 85 for n, c in by_tree.values())
    assert 0.63 < np.mean([c for _, c in by_tree.values()]) / 100 < 0.70
    everything = forest.draw(slim, 3000, 3000).filter("tree = 0").groupBy("_id").count().groupBy("count").count()
    assert {r[0]: r[1] for r in everything.collect()} == {2000: 1, 2: 1, 1: 998}
    found = [forest.fit_score(rows.repartition(n), ["x", "y"])[1] for n in (1, 7)]
    assert found[0].exceptAll(found[1].select(*found[0].columns)).count() == 0
    assert found[0].filter("x = 0.25 and outlier = -1").count() == 0
    assert found[0].filter("x > 30 and outlier = 1").count() == 0


def test_expression_and_numpy_score_the_same(spark, planted):
    rows = planted.unionByName(spark.createDataFrame([(None, float("nan"), 5000), (0.0, None, 5001)], "x double, y double, id long"))
    model = IsolationForest(["x", "y"], seed=3, trees=4, sample_size=32).fit(planted, ["id"])
    both = rows.select(model.score_column(spark, native=True).alias("a"), model.score_column(spark, native=False).alias("b"))
    assert both.count() == 1012 and both.filter("abs(a - b) > 1e-15 or a is null").count() == 0
    plan = model.score(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    same = rows.withColumn("c", F.expr(model.score_sql()))
    assert same.filter("c is null").count() == 0


def test_scores_follow_the_published_formula(spark):
    """A point alone in its leaf at depth 1 in every tree scores 2 ** (-1 / c(n))."""
    rows = spark.createDataFrame([(i, 0.0) for i in range(9)] + [(9, 100.0)], "id int, x double")
    model = IsolationForest(["x"], seed=1, trees=7).fit(rows, ["id"])
    scores = {r["id"]: r["score"] for r in model.score(rows).collect()}
    assert scores[9] == pytest.approx(2 ** (-1 / mean_unsuccessful_path(10)))
    assert scores[0] == pytest.approx(2 ** (-(1 + mean_unsuccessful_path(9)) / mean_unsuccessful_path(10)))


def test_missing_values_score_as_the_sentinel(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(50)] + [(50, None), (51, float("nan"))], "id int, x double")
    model = IsolationForest(["x"], seed=1, trees=20).fit(rows, ["id"])
    scores = {r["id"]: r["score"] for r in model.score(rows).collect()}
    assert scores[50] == scores[51] and scores[50] > scores[25]


def test_saved_model_scores_the_same(spark, planted, folder):
    forest = IsolationForest(["x", "y"], seed=11, contamination=0.01)
    model, labelled = forest.fit_score(planted, ["id"])
    model.save(spark, f"{folder}/model")
    again = ForestModel.load(spark, f"{folder}/model")
    assert again.cut == model.cut and again.nodes == model.nodes
    assert labels(again.predict(planted)) == labels(labelled)


def test_no_rows_to_fit(spark, planted):
    with pytest.raises(ValueError, match="no rows"):
        IsolationForest(["x"], seed=1).fit(planted.limit(0), ["id"])


def test_sweep_flags_strictly_beyond_the_cut(spark):
    scored = spark.range(1, 101).select(F.col("id").cast("double").alias("score"))
    found = {r["contamination"]: (r["rows"], r["cut"], r["flagged"]) for r in contamination_sweep(scored, [0.0, 0.1, 0.5]).collect()}
    assert found[0.0] == (100, 100.0, 0) and found[0.1][2] == 10 and found[0.5][2] == 50
    assert found[0.1][1] == pytest.approx(np.quantile(range(1, 101), 0.9))


def test_grouped_fit_equals_lstsq(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"week": rng.integers(1, 30, 900), "a": rng.normal(20, 4, 900), "b": rng.normal(5e4, 9e3, 900), "t": rng.integers(1, 500, 900) * 60.0})
    frame["y"] = 3 + 2 * frame.a - 1e-3 * frame.b + 0.01 * frame.t + rng.normal(0, 1, 900)
    features = ["week", "a", "b", "t"]
    fits = {r["week"]: r for r in fc.grouped_linear_fit(spark.createDataFrame(frame), "y", features, ["week"]).collect()}
    for week, group in frame.groupby("week"):
        x = group[features].to_numpy()
        weights, *_ = np.linalg.lstsq(x - x.mean(0), group.y - group.y.mean(), rcond=None)
        np.testing.assert_allclose(fits[week]["coefficients"], weights, rtol=1e-5, atol=1e-8)
        assert fits[week]["intercept"] == pytest.approx(group.y.mean() - x.mean(0) @ weights, rel=1e-5)
        assert fits[week]["coefficients"][0] == pytest.approx(0, abs=1e-9)


def test_grouped_fit_of_a_tiny_group(spark):
    rows = spark.createDataFrame([("one", 1.0, 2.0, 7.0), ("two", 1.0, 2.0, 3.0), ("two", 2.0, 4.0, 5.0)], "k string, a double, b double, y double")
    fits = {r["k"]: r for r in fc.grouped_linear_fit(rows, "y", ["a", "b"], ["k"]).collect()}
    assert list(fits["one"]["coefficients"]) == [0.0, 0.0] and fits["one"]["intercept"] == 7.0
    np.testing.assert_allclose(fits["two"]["coefficients"], [0.4, 0.8])


def test_grouped_prediction_with_a_hot_group(spark):
    rows = spark.range(600).select(F.when(F.col("id") < 500, 0).otherwise(F.col("id") % 5).alias("k"), F.col("id").cast("double").alias("a"))
    rows = rows.withColumn("y", F.col("k") + 2 * F.col("a"))
    fits = fc.grouped_linear_fit(rows, "y", ["a"], ["k"])
    predicted = fc.grouped_predict(rows, fits, ["a"], ["k"], "p", max_group_rows=50)
    assert predicted.count() == 600 and predicted.filter(F.abs(F.col("y") - F.col("p")) > 1e-6).count() == 0


def test_linear_model_ignores_a_constant_column(spark):
    rows = spark.range(50).select(F.lit(3.0).alias("c"), F.col("id").cast("double").alias("a"), (F.col("id") * 2 + 1).cast("double").alias("y"))
    model = fc.linear_model(rows, "y", ["c", "a"], "p").stages[-1]
    np.testing.assert_allclose(model.coefficients.toArray(), [0, 2], atol=1e-8)
    assert model.intercept == pytest.approx(1)


def test_split_is_repeatable(spark):
    rows = spark.range(1000)
    train, test = fc.split_rows(rows, "id")
    again, _ = fc.split_rows(rows.repartition(13), "id")
    assert train.count() + test.count() == 1000 and train.exceptAll(again).count() == 0
    assert train.count() == 800


def test_holdout_is_exact(spark):
    rows = spark.range(57).select((F.col("id") % 3).alias("year"), F.col("id").alias("week"))
    train, validation = fc.holdout(rows, ["year", "week"])
    assert (train.count(), validation.count()) == (46, 11)
    assert train.join(validation, ["year", "week"]).count() == 0


def test_boosted_model_survives_storage(spark, folder):
    rows = spark.range(80).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") * 3).cast("double").alias("y"))
    model = fc.boosted_model(rows, "y", "p", drop=["b"], iterations=3)
    fc.save_model(model, f"{folder}/m")
    one, two = fc.apply_model(model, rows), fc.apply_model(fc.load_model(f"{folder}/m"), rows)
    assert one.exceptAll(two).count() == 0 and "p" in one.columns
    assert [r["feature"] for r in fc.feature_importance(model, rows).collect()] == ["a"]


def test_band_forecaster_alarms(spark):
    rows = spark.range(40).select(F.col("id").cast("double").alias("week"), (F.col("id") * 4).cast("double").alias("ma"), (F.col("id") / 4).alias("std"))
    found = fc.level_alarms(rows, rows, {"ma": 115.0, "std": 10.0}, ["week"])
    assert found.filter("ma_alarm").count() == 11 and found.filter("std_alarm").count() == 0


def test_missing_features_still_get_a_forecast(spark):
    rows = spark.range(60).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") != 7, F.col("id") % 5).cast("double").alias("b"), (F.col("id") * 3).cast("double").alias("y"))
    boosted = fc.apply_model(fc.boosted_model(rows, "y", "p", iterations=2), rows)
    assert boosted.count() == 60 and boosted.filter("p is null").count() == 0
    linear = fc.apply_model(fc.linear_model(rows, "y", ["a", "b"], "p"), rows)
    assert [r["a"] for r in linear.filter("p is null").collect()] == [7.0]


def test_boosting_stops_at_the_smallest_held_out_error(spark):
    """The cut model is the whole one without its last trees, and the log agrees with its predictions."""
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"x": rng.normal(0, 1, 160), "z": rng.normal(0, 1, 160)})
    frame["y"] = np.sin(frame.x * 2) + rng.normal(0, 0.6, 160)
    rows = spark.createDataFrame(frame.assign(id=range(160))).coalesce(1)
    train, held_out = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    fit = fc.boosted_with_holdout(train, held_out, "y", "p", ["id"], iterations=12, depth=3)
    learn, test = [e[1] for e in fit.errors], [e[2] for e in fit.errors]
    assert len(test) == 12 and learn == sorted(learn, reverse=True) and fit.best < 12
    assert test[fit.best - 1] == min(test) and fit.model.stages[-1].getNumTrees == fit.best
    whole = fc.boosted_model(train, "y", "p", ["id"], iterations=12)
    cut = [t.toDebugString.split("\n", 1)[1] for t in fit.model.stages[-1].trees]
    assert cut == [t.toDebugString.split("\n", 1)[1] for t in whole.stages[-1].trees][: fit.best]
    error = fc.mean_squared_error(fc.apply_model(fit.model, held_out), "y", "p").first()["mse"] ** 0.5
    assert error == pytest.approx(min(test))
    log = fit.log(spark).orderBy("iteration").collect()
    assert [r["test"] for r in log] == test and log[0]["iteration"] == 1
    nothing = fc.boosted_with_holdout(train, held_out.filter("false"), "y", "p", ["id"], iterations=3)
    assert nothing.best == 3
