"""Outlier model and forecast model queries."""

from pyspark.sql import functions as F

from ...operators import forecast as fc
from ...operators import rollup, spc
from ...operators.alarms import band_point_alarms
from ...operators.encode import CategoryCodes
from ...operators.forest import ForestModel, IsolationForest, contamination_sweep
from ...operators.refine import fill_missing, model_columns
from ...operators.skew import NO_GROUPS, exact_quantiles
from ...schemas import CATEGORIES, WEEKLY
from ...session import scratch_path, staged
from . import bindings as b
from .forest_twin import draw_ctes, labelled_ctes
from .registry import query, rounded

SEED = 917


def _model_frame(spark, folder):
    """The 12 numeric model columns with category codes and sentinels."""
    rows = b.refined(spark, folder)
    return fill_missing(model_columns(CategoryCodes.fit(rows, CATEGORIES).encode(rows)))


_CODE = "CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {c}) - 1 END AS {c}"
MODEL_SQL = f"""{b.REFINED}, framed AS (SELECT week, year, batchid, tp_cell_name, domecasegap, stitcharea, test_time_sec, blister_id, day, stitcharea_limit, {", ".join(_CODE.format(c=c) for c in CATEGORIES)} FROM refined)"""
#: A whole number for each content, the same in both engines: the start of the digest of all columns, those with cents in cents.
CONTENT = ["week", "year", "batchid", "tp_cell_name", "domecasegap", "stitcharea", "bodytypeid", "dometypeid", "lotnumber", "test_time_sec", "error_code_number", "pass_failed"]


def digest_sql(columns):
    return "CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(f"CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)" for c in columns) + ")), 1, 15) AS BIGINT)"


def digest(columns):
    text = F.concat_ws("|", *[F.round(F.col(c).cast("double") * 100).cast("long").cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


SINGLE = lambda c: f"CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}"


@query(
    "F1_F2_outlier_labels",
    f"WITH RECURSIVE {MODEL_SQL}, numbered AS (SELECT *, {digest_sql(CONTENT)} AS _id FROM framed), {labelled_ctes('numbered', CONTENT, SEED, 0.05)} "
    f"SELECT batchid, week, year, domecasegap, stitcharea, {SINGLE('score')}, outlier FROM labelled",
)
def outlier_labels(spark, folder):
    """Draws, trees, scores, cut and labels of the 12-column model, all of them redone by the twin."""
    rows = _model_frame(spark, folder)
    _, labelled = IsolationForest(CONTENT, SEED, contamination=0.05).fit_score(rows, number=digest(CONTENT))
    return labelled.select("batchid", "week", "year", "domecasegap", "stitcharea", rounded("score").alias("score"), "outlier")


@query("F1_forest_draws", f"WITH RECURSIVE {b.SERIES}, numbered AS (SELECT seq AS _id FROM series), {draw_ctes('numbered', SEED, 20, 256)} SELECT tree, place, _id AS seq FROM chosen")
def forest_draws(spark, folder):
    """The sample of each tree: the rows with its smallest tickets."""
    rows = staged(b.series(spark, folder).select(F.col("seq").alias("_id")), "numbers")
    available = rows.count()
    drawn = IsolationForest([], SEED, trees=20).draw(rows, min(256, available), available)
    return drawn.select("tree", F.col("place").cast("long").alias("place"), F.col("_id").alias("seq"))


_THREE = ["domecasegap", "stitcharea", "test_time_sec"]


@query(
    "F4_three_feature_outliers",
    f"WITH RECURSIVE {b.REFINED}, numbered AS (SELECT batchid, {', '.join(_THREE)}, {digest_sql(['batchid', *_THREE])} AS _id FROM refined), {labelled_ctes('numbered', _THREE, SEED, 0.015)} "
    f"SELECT batchid, {', '.join(_THREE)}, {SINGLE('score')}, outlier FROM labelled",
)
def three_feature_outliers(spark, folder):
    rows = b.refined(spark, folder).select("batchid", *_THREE)
    _, labelled = IsolationForest(_THREE, SEED, contamination=0.015).fit_score(rows, number=digest(["batchid", *_THREE]))
    return labelled.select("batchid", *_THREE, rounded("score").alias("score"), "outlier")


#: A small model with levels fixed by hand: three trees over gap and area.
_SMALL = ForestModel.from_nodes(
    ["domecasegap", "stitcharea"],
    [
        (0, 0, 0, 25.0, 16, 0.0), (0, 1, 1, 40_000.0, 9, 1.0), (0, 2, -1, 0.0, 7, 4.25), (0, 3, -1, 0.0, 8, 5.5), (0, 4, -1, 0.0, 1, 2.0),
        (1, 0, 1, 90_000.0, 16, 0.0), (1, 1, -1, 0.0, 15, 5.0), (1, 2, -1, 0.0, 1, 1.0),
        (2, 0, 0, 2.5, 16, 0.0), (2, 1, -1, 0.0, 2, 2.0), (2, 2, 0, 48.5, 14, 1.0), (2, 5, -1, 0.0, 12, 6.125), (2, 6, -1, 0.0, 2, 3.0),
    ],
    16, 4, cut=0.6,
)


@query(
    "F2_X2_small_model_labels",
    f"WITH {b.RAW}, s AS (SELECT batchid, domecasegap, stitcharea, {_SMALL.score_sql()} AS score FROM raw) SELECT batchid, domecasegap, stitcharea, {SINGLE('score')}, CASE WHEN score > 0.6 THEN -1 ELSE 1 END AS outlier FROM s",
)
def small_model_labels(spark, folder):
    """A given model applied to every row, missing values included, as one expression in the JVM."""
    labelled = _SMALL.predict(b.raw(spark, folder).select("batchid", "domecasegap", "stitcharea"))
    return labelled.withColumn("score", rounded("score"))


def _cut_query(name, level, **options):
    @query(
        name,
        f"""WITH c AS (SELECT quantile_cont(l_extendedprice, {1 - level}) AS cut FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_extendedprice AS value, CASE WHEN l_extendedprice > cut THEN -1 ELSE 1 END AS outlier FROM lineitem, c""",
    )
    def run(spark, folder):
        rows = b.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("value"))
        cut = exact_quantiles(rows, "value", {"cut": 1 - level}, (), **options).select("cut").scalar()
        return rows.withColumn("outlier", F.when(F.col("value") > cut, F.lit(-1)).otherwise(F.lit(1)))


_cut_query("F3_contamination_cut", 0.05)
_cut_query("F3_contamination_cut_split", 0.015, max_group_rows=2_000)


@query(
    "F4_one_feature_outliers",
    f"WITH RECURSIVE {b.REFINED}, numbered AS (SELECT test_time_sec, CAST(test_time_sec AS BIGINT) AS _id FROM refined), {labelled_ctes('numbered', ['test_time_sec'], SEED, 0.015)} "
    "SELECT outlier, count(*) AS rows, CAST(CAST(avg(test_time_sec) AS FLOAT) AS DOUBLE) AS mean_time FROM labelled GROUP BY outlier",
)
def one_feature_outliers(spark, folder):
    """One feature of few values: nearly all rows are copies, drawn by their number."""
    rows = b.refined(spark, folder).select("test_time_sec")
    _, labelled = IsolationForest(["test_time_sec"], SEED, contamination=0.015).fit_score(rows, number=F.col("test_time_sec"))
    return labelled.groupBy("outlier").agg(F.count(F.lit(1)).alias("rows"), rounded(F.avg("test_time_sec")).alias("mean_time"))


_LEVELS = [0.001, 0.003, 0.005, 0.007, 0.009, 0.011, 0.013, 0.015, 0.017, 0.019]


@query(
    "F5_contamination_sweep",
    "WITH l AS (SELECT unnest([" + ", ".join(f"CAST({x} AS DOUBLE)" for x in _LEVELS) + "]) AS contamination), c AS ("
    + " UNION ALL ".join(f"SELECT CAST({x} AS DOUBLE) AS contamination, quantile_cont(l_extendedprice, {1 - x}) AS cut FROM lineitem" for x in _LEVELS)
    + """) SELECT (SELECT count(*) FROM lineitem) AS rows, contamination, CAST(CAST(cut AS FLOAT) AS DOUBLE) AS cut, (SELECT count(*) FROM lineitem WHERE l_extendedprice > cut) AS flagged
    FROM l JOIN c USING (contamination)""",
)
def contamination_levels(spark, folder):
    scored = b.table(spark, folder, "lineitem").select(F.col("l_extendedprice").alias("score"))
    return contamination_sweep(scored, _LEVELS).withColumn("cut", rounded("cut"))


@query("F6_S12_stored_model", f"WITH {b.REFINED} SELECT count(*) AS rows, CAST(0 AS BIGINT) AS changed FROM refined")
def stored_model(spark, folder):
    """Labels by a model that was saved and loaded again; none may change."""
    rows = b.refined(spark, folder).select("batchid", "domecasegap", "stitcharea", "test_time_sec")
    forest = IsolationForest(["domecasegap", "stitcharea", "test_time_sec"], SEED, contamination=0.015)
    model, labelled = forest.fit_score(rows, rows.columns)
    path = scratch_path(spark, "model")
    model.save(spark, path)
    again = ForestModel.load(spark, path).score_column(spark)
    rescored = labelled.withColumn("again", F.when(again > model.cut, -1).otherwise(1))
    return rescored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("again") != F.col("outlier")).alias("changed"))


_CHART = f"""{b.SERIES}, chart AS (SELECT seq, lot, week, domecasegap, stitcharea, avg(domecasegap) OVER w AS ma, stddev_samp(domecasegap) OVER w AS std FROM series
  WINDOW w AS (PARTITION BY lot ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)), full_rows AS (SELECT * FROM chart WHERE std IS NOT NULL)"""


def _chart(spark, folder):
    banded = spc.control_bands(b.series(spark, folder), ["domecasegap"], ["lot"], ["seq"])
    rows = banded.select("seq", "lot", "week", "domecasegap", "stitcharea", F.col("domecasegap_ma").alias("ma"), F.col("domecasegap_std").alias("std"))
    return rows.na.drop("any")


# Two-feature least squares in closed form, over x1 = domecasegap and x2 = stitcharea.
_SOLVED = """SELECT {keys} count(*) AS n, avg({y}) AS my, avg(domecasegap) AS m1, avg(stitcharea) AS m2,
  (covar_pop(domecasegap, {y}) * var_pop(stitcharea) - covar_pop(stitcharea, {y}) * covar_pop(domecasegap, stitcharea))
    / (var_pop(domecasegap) * var_pop(stitcharea) - covar_pop(domecasegap, stitcharea) ** 2) AS w1,
  (covar_pop(stitcharea, {y}) * var_pop(domecasegap) - covar_pop(domecasegap, {y}) * covar_pop(domecasegap, stitcharea))
    / (var_pop(domecasegap) * var_pop(stitcharea) - covar_pop(domecasegap, stitcharea) ** 2) AS w2 FROM {source} {group}"""


def _fitted_sql(target):
    return "fit_" + target + " AS (" + _SOLVED.format(keys="", y=target, source="full_rows WHERE (seq * 7919 + 42) % 100 < 80", group="") + ")"


@query(
    "M1_M4_M6_linear_bands",
    f"WITH {_CHART}, {_fitted_sql('ma')}, {_fitted_sql('std')} "
    + " UNION ALL ".join(
        f"""SELECT '{t}' AS target, count(*) AS rows, CAST(CAST(avg(({t} - (my + w1 * (domecasegap - m1) + w2 * (stitcharea - m2))) ** 2) AS FLOAT) AS DOUBLE) AS mse
        FROM full_rows, fit_{t} WHERE (seq * 7919 + 42) % 100 >= 80"""
        for t in ("ma", "std")
    ),
)
def linear_bands(spark, folder):
    """Moving average and deviation from gap and area: fit on 80 %, error on the rest."""
    train, test = fc.split_rows(_chart(spark, folder), "seq")
    found = None
    for target in ("ma", "std"):
        model = fc.linear_model(train, target, ["domecasegap", "stitcharea"], "predicted")
        scored = fc.apply_model(model, test)
        error = scored.agg(F.lit(target).alias("target"), F.count(F.lit(1)).alias("rows"),
                           rounded(F.avg(F.pow(F.col(target) - F.col("predicted"), 2))).alias("mse"))
        found = error if found is None else found.unionByName(error)
    return found


@query(
    "M2_regression_per_week",
    f"WITH {_CHART}, solved AS (" + _SOLVED.format(keys="week,", y="ma", source="full_rows", group="GROUP BY week")
    + """) SELECT CAST(week AS BIGINT) AS week, n AS rows, 0.0::DOUBLE AS week_weight, CAST(CAST(w1 AS FLOAT) AS DOUBLE) AS gap_weight, CAST(CAST(w2 AS FLOAT) AS DOUBLE) AS area_weight,
    CAST(CAST(my - w1 * m1 - w2 * m2 AS FLOAT) AS DOUBLE) AS intercept FROM solved""",
)
def regression_per_week(spark, folder):
    """The week itself is constant within a group and gets no weight."""
    fits = fc.grouped_linear_fit(_chart(spark, folder), "ma", ["week", "domecasegap", "stitcharea"], ["week"])
    weight = lambda i: rounded(F.col("coefficients")[i])
    return fits.select(
        F.col("week").cast("long").alias("week"), "rows", F.abs(weight(0)).alias("week_weight"), weight(1).alias("gap_weight"),
        weight(2).alias("area_weight"), rounded("intercept").alias("intercept"),
    )


@query(
    "M2_grouped_prediction_error",
    f"WITH {_CHART}, solved AS (" + _SOLVED.format(keys="lot,", y="std", source="full_rows", group="GROUP BY lot")
    + """) SELECT lot, CAST(CAST(avg((std - (my + w1 * (domecasegap - m1) + w2 * (stitcharea - m2))) ** 2) AS FLOAT) AS DOUBLE) AS mse FROM full_rows JOIN solved USING (lot) GROUP BY lot""",
)
def grouped_prediction_error(spark, folder):
    rows = _chart(spark, folder)
    fits = fc.grouped_linear_fit(rows, "std", ["domecasegap", "stitcharea"], ["lot"])
    predicted = fc.grouped_predict(rows, fits, ["domecasegap", "stitcharea"], ["lot"], "predicted")
    return fc.mean_squared_error(predicted, "std", "predicted", ["lot"]).withColumn("mse", rounded("mse"))


_FOUR = ["week", "domecasegap", "stitcharea", "test_time_sec"]
_CHART_FOUR = f"{_CHART}, four_rows AS (SELECT *, CAST((seq * 37) % 600 * 60 AS DOUBLE) AS test_time_sec FROM full_rows)"


def _chart_four(spark, folder):
    """The chart rows with all four features of the band models; the test time is made from the place in the series."""
    return _chart(spark, folder).withColumn("test_time_sec", (F.col("seq") * 37 % 600 * 60).cast("double"))


def _least_squares(name, source, target, features, keys=()):
    """Common table expressions that solve a regression by elimination: <name> with the keys, n, my, m0.. (means) and w0.. (weights)."""
    k, by = len(features), ", ".join(keys)
    head = f"{by}, " if keys else ""
    moments = [f"avg({f}) AS m{i}" for i, f in enumerate(features)] + [f"covar_pop({f}, {target}) AS b{i}" for i, f in enumerate(features)]
    moments += [f"covar_pop({f}, {g}) AS a{i}{j}" for i, f in enumerate(features) for j, g in enumerate(features) if j >= i]
    parts = [f"{name}_0 AS (SELECT {head}count(*) AS n, avg({target}) AS my, {', '.join(moments)} FROM {source} {'GROUP BY ' + by if keys else ''})"]
    for p in range(k - 1):  # below the pivot p; the rest of the matrix stays symmetric
        changed = [f"a{i}{j} - a{p}{i} * a{p}{j} / a{p}{p} AS a{i}{j}" for i in range(p + 1, k) for j in range(i, k)]
        changed += [f"b{i} - a{p}{i} * b{p} / a{p}{p} AS b{i}" for i in range(p + 1, k)]
        parts.append(f"{name}_{p + 1} AS (SELECT * REPLACE ({', '.join(changed)}) FROM {name}_{p})")
    back = [f"(b{i} - ({' + '.join([f'a{i}{j} * w{j}' for j in range(i + 1, k)] or ['0'])})) / a{i}{i} AS w{i}" for i in range(k - 1, -1, -1)]
    parts.append(f"{name} AS (SELECT *, {', '.join(back)} FROM {name}_{k - 1})")
    return ", ".join(parts)


def _foretold(fit, row, features):
    return f"({fit}.my + " + " + ".join(f"{fit}.w{i} * ({row}.{f} - {fit}.m{i})" for i, f in enumerate(features)) + ")"


@query(
    "M1_four_features",
    f"WITH {_CHART_FOUR}, " + ", ".join(_least_squares(f"fit_{t}", "(SELECT * FROM four_rows WHERE (seq * 7919 + 42) % 100 < 80)", t, _FOUR) for t in ("ma", "std"))
    + " " + " UNION ALL ".join(
        f"""SELECT '{t}' AS target, count(*) AS rows, CAST(CAST(avg(({t} - {_foretold(f"fit_{t}", "r", _FOUR)}) ** 2) AS FLOAT) AS DOUBLE) AS mse
        FROM four_rows r, fit_{t} WHERE (seq * 7919 + 42) % 100 >= 80""" for t in ("ma", "std")
    ),
)
def four_feature_bands(spark, folder):
    """Moving average and deviation from week, gap, area and test time: fit on 80 %, error on the rest."""
    train, test = fc.split_rows(_chart_four(spark, folder), "seq")
    found = None
    for target in ("ma", "std"):
        scored = fc.apply_model(fc.linear_model(train, target, _FOUR, "predicted"), test)
        error = scored.agg(F.lit(target).alias("target"), F.count(F.lit(1)).alias("rows"),
                           rounded(F.avg(F.pow(F.col(target) - F.col("predicted"), 2))).alias("mse"))
        found = error if found is None else found.unionByName(error)
    return found


@query(
    "M2_four_features_per_cell",
    f"WITH {_CHART_FOUR}, ten_rows AS (SELECT *, lot % 10 AS cell FROM four_rows), " + _least_squares("fit", "ten_rows", "ma", _FOUR, ["cell"])
    + f""" SELECT r.cell, count(*) AS rows, CAST(CAST(avg((ma - {_foretold("fit", "r", _FOUR)}) ** 2) AS FLOAT) AS DOUBLE) AS mse FROM ten_rows r JOIN fit ON fit.cell = r.cell GROUP BY r.cell""",
)
def four_features_per_cell(spark, folder):
    """A regression with all four features for each of ten cells, and its error."""
    rows = staged(_chart_four(spark, folder).withColumn("cell", F.col("lot") % 10), "chart")
    predicted = fc.grouped_predict(rows, fc.grouped_linear_fit(rows, "ma", _FOUR, ["cell"]), _FOUR, ["cell"], "predicted", hot=NO_GROUPS)
    error = F.avg(F.pow(F.col("ma") - F.col("predicted"), 2))
    return predicted.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), rounded(error).alias("mse"))


@query(
    "M9_four_feature_forecaster",
    f"WITH {_CHART_FOUR}, bands AS (SELECT lot, week, avg(domecasegap) AS domecasegap, avg(stitcharea) AS stitcharea, avg(test_time_sec) AS test_time_sec, avg(ma) AS ma, avg(std) AS std FROM four_rows GROUP BY lot, week), "
    + ", ".join(_least_squares(f"f{t}", "bands", t, _FOUR) for t in ("ma", "std"))
    + f""" SELECT lot, CAST(week AS BIGINT) AS week, CAST(CAST({_foretold("fma", "r", _FOUR)} AS FLOAT) AS DOUBLE) AS pred_ma, CAST(CAST({_foretold("fstd", "r", _FOUR)} AS FLOAT) AS DOUBLE) AS pred_std,
    {_foretold("fma", "r", _FOUR)} > 60 AS ma_alarm, {_foretold("fstd", "r", _FOUR)} > 55 AS std_alarm FROM bands r, fma, fstd""",
)
def four_feature_forecaster(spark, folder):
    """Weekly means of the bands foretold from the four features, with the alarm levels of both targets."""
    means = [F.avg(c).alias(c) for c in ("domecasegap", "stitcharea", "test_time_sec", "ma", "std")]
    weekly = staged(_chart_four(spark, folder).groupBy("lot", "week").agg(*means), "bands")
    found = fc.level_alarms(weekly, weekly, {"ma": 60.0, "std": 55.0}, _FOUR)
    return found.select("lot", F.col("week").cast("long").alias("week"), rounded("pred_ma").alias("pred_ma"), rounded("pred_std").alias("pred_std"), "ma_alarm", "std_alarm")


@query(
    "M1_one_feature_regression",
    """SELECT count(*) AS rows, CAST(CAST(regr_slope(l_extendedprice, l_quantity) AS FLOAT) AS DOUBLE) AS slope, CAST(CAST(regr_intercept(l_extendedprice, l_quantity) AS FLOAT) AS DOUBLE) AS intercept FROM lineitem""",
)
def one_feature_regression(spark, folder):
    fit = fc.grouped_linear_fit(b.table(spark, folder, "lineitem"), "l_extendedprice", ["l_quantity"], [])
    return fit.select("rows", rounded(F.col("coefficients")[0]).alias("slope"), rounded("intercept").alias("intercept"))


@query("M4_repeatable_split", f"WITH {b.SERIES} SELECT seq, (seq * 7919 + 42) % 100 < 80 AS train FROM series")
def repeatable_split(spark, folder):
    return b.series(spark, folder).select("seq", fc.in_training(F.col("seq")).alias("train"))


@query(
    "M5_holdout_sizes",
    f"WITH {b.WEEKLY}, n AS (SELECT count(*) AS n FROM weekly) SELECT CAST(floor(0.2 * n) AS BIGINT) AS validation, n - CAST(floor(0.2 * n) AS BIGINT) AS train FROM n",
)
def holdout_sizes(spark, folder):
    weekly = staged(b.weekly(spark, folder), "weekly")
    train, validation = fc.holdout(weekly, ["year", "week"])
    sizes = train.agg(F.count(F.lit(1)).alias("train"))
    return sizes.withColumn("validation", validation.agg(F.count(F.lit(1))).scalar())


@query(
    "M6_D10_squared_error",
    f"WITH {_CHART} SELECT lot, CAST(CAST(avg((domecasegap - ma) ** 2) AS FLOAT) AS DOUBLE) AS mse FROM chart GROUP BY lot",
)
def squared_error(spark, folder):
    chart = spc.control_bands(b.series(spark, folder), ["domecasegap"], ["lot"], ["seq"])
    return fc.mean_squared_error(chart, "domecasegap", "domecasegap_ma", ["lot"]).withColumn("mse", rounded("mse"))


MEAN, SPREAD = "stitcharea_week_mean", "stitcharea_week_stddev"


def _held_out_weeks(spark, folder):
    """Weeks with the statistics of the next one, training and held-out, the held-out ones by an arithmetic ticket."""
    weekly = rollup.lagged_weeks(b.weekly(spark, folder), [MEAN, SPREAD]).na.drop("any")
    weekly = staged(weekly.coalesce(1), "weekly")
    return fc.holdout(weekly, ["year", "week"], ticket=(F.col("year") * 53 + F.col("week")) * 7919 % 10007)


def _held_out_fit(train, validation, target):
    others = [f"next_{t}" for t in (MEAN, SPREAD) if t != target]
    return fc.boosted_with_holdout(train, validation, f"next_{target}", f"pred_{target}", [*others, f"pred_{MEAN}"])


_NEXT_WEEKS = f"""{b.WEEKLY}, rolled AS (SELECT *, CASE WHEN week >= {b.LAST_WEEK} THEN year + 1 ELSE year END AS ny, CASE WHEN week >= {b.LAST_WEEK} THEN 1 ELSE week + 1 END AS nw FROM weekly),
  ahead AS (SELECT r.year, r.week, n.{MEAN} AS next_{MEAN}, n.{SPREAD} AS next_{SPREAD} FROM rolled r JOIN weekly n ON n.year = ny AND n.week = nw
    WHERE r.domecasegap_week_stddev IS NOT NULL AND r.{SPREAD} IS NOT NULL AND n.{SPREAD} IS NOT NULL),
  ordered AS (SELECT *, row_number() OVER (ORDER BY (year * 53 + week) * 7919 % 10007, year, week) AS place, count(*) OVER () AS n FROM ahead)"""


@query(
    "M3_M7_boosted_validation",
    f"""WITH {_NEXT_WEEKS} SELECT CAST(year AS BIGINT) AS year, CAST(week AS BIGINT) AS week, {SINGLE("next_" + MEAN)}, {SINGLE("next_" + SPREAD)}, TRUE AS mean_within, TRUE AS spread_within
    FROM ordered WHERE place <= CAST(floor(0.2 * n) AS BIGINT)""",
)
def boosted_validation(spark, folder):
    """Actual weekly mean and deviation of the held-out weeks, one week ahead, and whether the predictions lie within the values learned from
    (half their range to either side allowed, as boosted trees may overshoot)."""
    train, validation = _held_out_weeks(spark, folder)
    for target in (MEAN, SPREAD):
        validation = fc.apply_model(_held_out_fit(train, validation, target).model, validation)
    learned = train.agg(*[f(f"next_{t}").alias(f"{n}_{t}") for t in (MEAN, SPREAD) for n, f in (("lo", F.min), ("hi", F.max))]).select(F.struct("*")).scalar()
    rows = validation.withColumn("_l", learned)
    within = lambda t: F.col(f"pred_{t}").between(
        1.5 * F.col(f"_l.lo_{t}") - 0.5 * F.col(f"_l.hi_{t}"), 1.5 * F.col(f"_l.hi_{t}") - 0.5 * F.col(f"_l.lo_{t}")
    )
    return rows.select(
        F.col("year").cast("long").alias("year"), F.col("week").cast("long").alias("week"), rounded(f"next_{MEAN}").alias(f"next_{MEAN}"),
        rounded(f"next_{SPREAD}").alias(f"next_{SPREAD}"), within(MEAN).alias("mean_within"), within(SPREAD).alias("spread_within"),
    )


@query(
    "M3_held_out_error_log",
    f"""WITH {_NEXT_WEEKS}, facts AS (SELECT max(n) - CAST(floor(0.2 * max(n)) AS BIGINT) AS train, CAST(floor(0.2 * max(n)) AS BIGINT) AS held_out, CAST(20 AS BIGINT) AS iterations FROM ordered)
    SELECT target, train, held_out, iterations, TRUE AS learn_falls, TRUE AS cut_at_smallest, TRUE AS error_confirmed FROM facts, (SELECT unnest(['{MEAN}', '{SPREAD}']) AS target)""",
)
def held_out_error_log(spark, folder):
    """What the error log must say: the learning error never rises, the model has as many trees as the iteration with the smallest held-out error,
    and its predictions have that error."""
    train, validation = (staged(df, "weeks") for df in _held_out_weeks(spark, folder))
    sizes, found = (train.count(), validation.count()), []
    for target in (MEAN, SPREAD):
        fit = _held_out_fit(train, validation, target)
        learn, test = [e[1] for e in fit.errors], [e[2] for e in fit.errors]
        error = fc.mean_squared_error(fc.apply_model(fit.model, validation), f"next_{target}", f"pred_{target}").first()["mse"] ** 0.5
        falls = all(b <= a * (1 + 1e-9) for a, b in zip(learn, learn[1:]))
        cut = fit.model.stages[-1].getNumTrees == fit.best and test[fit.best - 1] == min(test)
        found.append((target, *sizes, len(fit.errors), falls, cut, abs(error - min(test)) <= 1e-6 * min(test)))
    return spark.createDataFrame(found, "target string, train long, held_out long, iterations long, learn_falls boolean, cut_at_smallest boolean, error_confirmed boolean")


_WEEKLY_FEATURES = [f.name for f in WEEKLY.fields if f.name != MEAN]


@query(
    "M8_feature_importance",
    f"SELECT feature, TRUE AS not_negative, 1.0::DOUBLE AS total FROM (SELECT unnest({_WEEKLY_FEATURES!r}) AS feature) WHERE (SELECT count(*) FROM lineitem) > 0",
)
def feature_importance(spark, folder):
    """One row for each column of the model; the shares add up to one."""
    weekly = staged(b.weekly(spark, folder).coalesce(1), "weekly")
    found = fc.feature_importance(fc.boosted_model(weekly, MEAN, "predicted"), weekly)
    total = found.agg(F.sum("importance")).scalar()
    return found.select("feature", (F.col("importance") >= 0).alias("not_negative"), rounded(total).alias("total"))


@query(
    "M8_residual_summary",
    f"""WITH {_CHART} SELECT count(domecasegap - ma) AS rows, CAST(CAST(avg(domecasegap - ma) AS FLOAT) AS DOUBLE) AS mean, CAST(CAST(stddev_samp(domecasegap - ma) AS FLOAT) AS DOUBLE) AS stddev,
    CAST(CAST(min(domecasegap - ma) AS FLOAT) AS DOUBLE) AS lowest, CAST(CAST(max(domecasegap - ma) AS FLOAT) AS DOUBLE) AS highest,
    CAST(CAST(1 - avg((domecasegap - ma) ** 2) / var_pop(domecasegap) AS FLOAT) AS DOUBLE) AS r2 FROM chart""",
)
def residual_summary(spark, folder):
    chart = spc.control_bands(b.series(spark, folder), ["domecasegap"], ["lot"], ["seq"])
    summary = fc.residual_summary(chart, "domecasegap", "domecasegap_ma")
    return summary.withColumns({c: rounded(c) for c in ("mean", "stddev", "lowest", "highest", "r2")})


_BAND_MEANS = """, bands AS (SELECT lot, week, avg(domecasegap) AS domecasegap, avg(stitcharea) AS stitcharea, avg(ma) AS ma, avg(std) AS std FROM full_rows GROUP BY lot, week)"""


def _predicted_sql(fit):
    return f"({fit}.my + {fit}.w1 * (r.domecasegap - {fit}.m1) + {fit}.w2 * (r.stitcharea - {fit}.m2))"


@query(
    "M9_band_forecaster",
    f"WITH {_CHART}{_BAND_MEANS}, " + ", ".join(f"f{t} AS (" + _SOLVED.format(keys="", y=t, source="bands", group="") + ")" for t in ("ma", "std"))
    + f""" SELECT lot, CAST(week AS BIGINT) AS week, CAST(CAST({_predicted_sql("fma")} AS FLOAT) AS DOUBLE) AS pred_ma, CAST(CAST({_predicted_sql("fstd")} AS FLOAT) AS DOUBLE) AS pred_std,
    {_predicted_sql("fma")} > 60 AS ma_alarm, {_predicted_sql("fstd")} > 55 AS std_alarm FROM bands r, fma, fstd""",
)
def band_forecaster(spark, folder):
    """Weekly means of the bands, both targets predicted and held against their alarm levels."""
    weekly = _chart(spark, folder).groupBy("lot", "week").agg(*[F.avg(c).alias(c) for c in ("domecasegap", "stitcharea", "ma", "std")])
    weekly = staged(weekly, "bands")
    found = fc.level_alarms(weekly, weekly, {"ma": 60.0, "std": 55.0}, ["domecasegap", "stitcharea"])
    return found.select("lot", F.col("week").cast("long").alias("week"), rounded("pred_ma").alias("pred_ma"), rounded("pred_std").alias("pred_std"), "ma_alarm", "std_alarm")


_TRAIN, _TEST = "(seq * 7919 + 42) % 100 < 80", "(seq * 7919 + 42) % 100 >= 80"


@query(
    "M2_heldout_error_per_group",
    f"WITH {_CHART}, solved AS (" + _SOLVED.format(keys="lot,", y="ma", source=f"full_rows WHERE {_TRAIN}", group="GROUP BY lot")
    + f""") SELECT r.lot, CAST(CAST(avg((r.ma - {_predicted_sql("solved")}) ** 2) AS FLOAT) AS DOUBLE) AS mse FROM (SELECT * FROM full_rows WHERE {_TEST}) r JOIN solved ON solved.lot = r.lot
    WHERE (SELECT count(DISTINCT lot) FROM full_rows) > 20 GROUP BY r.lot""",
)
def heldout_error_per_group(spark, folder):
    """A regression for each group on 80 % of its rows, its error on the others; only with more than 20 groups."""
    errors = fc.holdout_errors(_chart(spark, folder), "ma", ["domecasegap", "stitcharea"], ["lot"], "seq")
    return errors.withColumn("mse", rounded("mse"))


@query(
    "L6_alarms_of_predictions",
    f"WITH {_CHART}, " + ", ".join(f"f{t} AS (" + _SOLVED.format(keys="lot,", y=t, source="full_rows", group="GROUP BY lot") + ")" for t in ("ma", "std"))
    + f""", g AS (SELECT avg(ma - 2 * std) AS lo, avg(ma + 2 * std) AS hi FROM full_rows), p AS (SELECT seq, {_predicted_sql("fma")} + 2 * {_predicted_sql("fstd")} AS predicted
    FROM full_rows r JOIN fma ON fma.lot = r.lot JOIN fstd ON fstd.lot = r.lot)
    SELECT seq, CAST(CAST(predicted AS FLOAT) AS DOUBLE) AS predicted, predicted < lo OR predicted > hi AS alarm FROM p, g""",
)
def alarms_of_predictions(spark, folder):
    """Predicted mean and deviation of each row's group, held against the mean band."""
    rows, features = staged(_chart(spark, folder), "chart"), ["domecasegap", "stitcharea"]
    predicted = rows
    for target in ("ma", "std"):
        predicted = fc.grouped_predict(predicted, fc.grouped_linear_fit(rows, target, features, ["lot"]), features, ["lot"], f"pred_{target}", hot=NO_GROUPS)
    band = rows.agg(F.avg(F.col("ma") - 2 * F.col("std")).alias("spc_lower"), F.avg(F.col("ma") + 2 * F.col("std")).alias("spc_upper"))
    found = band_point_alarms(predicted, "pred_ma", "pred_std", band)
    return found.select("seq", rounded("predicted").alias("predicted"), "alarm")


@query(
    "P19_features_but_drop_list",
    "SELECT count(*) AS rows, 'l_orderkey,l_partkey,l_linenumber,l_quantity,l_discount' AS features FROM lineitem",
)
def features_but_drop_list(spark, folder):
    rows = b.table(spark, folder, "lineitem")
    names = fc.model_features(rows, "l_extendedprice", ["l_suppkey", "l_tax"])
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("features", F.lit(",".join(names)))
