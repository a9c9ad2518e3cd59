"""Roll-ups, key figures, control charts, labels, alarms and thresholds."""

from pyspark.sql import functions as F

from ...operators import alarms, guard, kpi, rollup, spc, thresholds
from ...functions.calendar import with_calendar_parts
from ...functions.limits import parse_range
from ...operators.skew import attach, rolling
from ...schemas import ALARMS
from ...session import scratch_path, staged
from ...sources.files import read_snapshot
from . import bindings as b
from .registry import query, rounded

FEATURES = ["domecasegap", "stitcharea"]
STATS = [
    "maximum_domecasegap", "minimum_domecasegap", "domecasegap_week_mean", "domecasegap_week_stddev",
    "maximum_stitcharea", "minimum_stitcharea", "stitcharea_week_mean", "stitcharea_week_stddev",
]


def _round(df, *names):
    return df.withColumns({n: rounded(F.col(n)) for n in names})


def _longs(df, *names):
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def _fiftieth(rows):
    """A limit for hot groups that follows the table: a fiftieth of its rows."""
    return max(10, rows.count() // 50)


def _stored_weekly(spark, folder):
    """The weekly history as a written table, as the forecast and the guards find it."""
    return staged(b.weekly(spark, folder), "weekly")


_WEEK_KEYS = "CAST(year AS BIGINT) AS year, CAST(week AS BIGINT) AS week"


@query(
    "A1_weekly_rollup",
    f"WITH {b.WEEKLY} SELECT {_WEEK_KEYS}, " + ", ".join(f"CAST(CAST({s} AS FLOAT) AS DOUBLE) AS {s}" for s in STATS) + " FROM weekly",
)
def weekly_rollup(spark, folder):
    return _round(_longs(b.weekly(spark, folder), "year", "week"), *STATS)


@query(
    "A2_weekly_profile",
    f"""WITH {b.REFINED} SELECT {_WEEK_KEYS}, CAST(CAST(avg(domecasegap) AS FLOAT) AS DOUBLE) AS domecasegap, CAST(CAST(avg(stitcharea) AS FLOAT) AS DOUBLE) AS stitcharea,
    CAST(CAST(avg(test_time_sec) AS FLOAT) AS DOUBLE) AS test_time_sec FROM refined
    WHERE year = 1998 OR (year = 2000 AND week BETWEEN 1 AND 30) GROUP BY year, week""",
)
def weekly_profile(spark, folder):
    profile = rollup.weekly_profile(b.refined(spark, folder), 1998, 2000, 30)
    return _round(_longs(profile, "year", "week"), "domecasegap", "stitcharea", "test_time_sec")


_KPI = """count(*) FILTER (WHERE outlier = -1) AS bad, count(*) FILTER (WHERE outlier <> -1) AS good,
    avg({f}) FILTER (WHERE outlier = -1) AS bad_mean, avg({f}) FILTER (WHERE outlier <> -1) AS good_mean"""


@query(
    "A3_outlier_kpi",
    f"""WITH {b.SERIES}, k AS (SELECT lot, {_KPI.format(f="stitcharea")}, avg({b.LOW_SIDE.format(t="stitcharea_limit")}) AS lo,
    avg({b.HIGH_SIDE.format(t="stitcharea_limit")}) AS hi FROM series GROUP BY lot)
    SELECT lot, 'stitcharea' AS feature, printf('%.3f%%', bad / (good + 1) * 100.0) AS outlier_vs_normal, bad AS outlier_count,
    printf('%.3f', bad_mean) AS mean_outlier_feature, printf('%.3f', good_mean) AS mean_normal_feature,
    coalesce(lo, 0) AS lo_avg, coalesce(hi, 0) AS hi_avg FROM k""",
)
def outlier_kpi(spark, folder):
    figures = kpi.outlier_kpi(b.series(spark, folder), "stitcharea", keys=["lot"])
    return figures.select("*", "limit_feature.lo_avg", "limit_feature.hi_avg").drop("limit_feature")


@query(
    "A4_outlier_evaluation",
    f"WITH {b.SERIES}, "
    + ", ".join(f"k_{f} AS (SELECT {_KPI.format(f=f)} FROM series)" for f in FEATURES)
    + " "
    + " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, CAST(CAST(bad / good AS FLOAT) AS DOUBLE) AS ratio, bad AS amount, CAST(CAST(bad_mean AS FLOAT) AS DOUBLE) AS mean_outlier,
        CAST(CAST(good_mean AS FLOAT) AS DOUBLE) AS mean_normal, CAST(CAST(bad_mean / good_mean AS FLOAT) AS DOUBLE) AS mean_ratio FROM k_{f}"""
        for f in FEATURES
    ),
)
def outlier_evaluation(spark, folder):
    figures = kpi.outlier_evaluation(b.series(spark, folder), FEATURES)
    return _round(figures, "ratio", "mean_ratio", "mean_outlier", "mean_normal")


@query(
    "A5_K1_range_and_first_limit",
    f"""WITH {b.SERIES}, f AS (SELECT lot, min(domecasegap) AS lo_value, max(domecasegap) AS hi_value, min(seq) AS s FROM series
    GROUP BY lot) SELECT f.lot, lo_value, hi_value, {b.LOW_SIDE.format(t="domecasegap_limit")} AS lo_limit,
    {b.HIGH_SIDE.format(t="domecasegap_limit")} AS hi_limit FROM f JOIN series ON seq = s""",
)
def range_and_first_limit(spark, folder):
    rows = b.series(spark, folder)
    ranges = rows.groupBy("lot").agg(F.min("domecasegap").alias("lo_value"), F.max("domecasegap").alias("hi_value"))
    firsts = spc.first_limits(rows, ["domecasegap"], ["lot"], ["seq"], "skip")
    return ranges.join(firsts, "lot").withColumnsRenamed({"domecasegap_lo_limit": "lo_limit", "domecasegap_hi_limit": "hi_limit"})


@query(
    "A8_A10_large_groups",
    f"WITH {b.SERIES} SELECT lot, count(*) AS rows FROM series GROUP BY lot HAVING count(*) >= 70",
)
def large_groups(spark, folder):
    return rollup.groups_with_rows(b.series(spark, folder), ["lot"], 70)


@query(
    "A8_rows_of_large_groups",
    f"WITH {b.SERIES} SELECT seq, lot FROM series WHERE lot IN (SELECT lot FROM series GROUP BY lot HAVING count(*) >= 70)",
)
def rows_of_large_groups(spark, folder):
    rows = b.series(spark, folder).select("seq", "lot")
    return attach(rows, rollup.groups_with_rows(rows, ["lot"], 70).select("lot"), ["lot"], how="left_semi")


@query(
    "A9_mean_limits",
    f"""WITH {b.REFINED} SELECT tp_cell_name, CAST(CAST(avg(coalesce({b.LOW_SIDE.format(t="domecasegap_limit")}, 0)) AS FLOAT) AS DOUBLE) AS lo_limit,
    CAST(CAST(avg(coalesce({b.HIGH_SIDE.format(t="domecasegap_limit")}, 0)) AS FLOAT) AS DOUBLE) AS hi_limit FROM refined GROUP BY 1""",
)
def mean_limits(spark, folder):
    means = spc.mean_limits(b.refined(spark, folder), ["domecasegap"], ["tp_cell_name"])
    renamed = means.withColumnsRenamed({"domecasegap_lo_limit": "lo_limit", "domecasegap_hi_limit": "hi_limit"})
    return _round(renamed, "lo_limit", "hi_limit")


@query("A10_distinct_values", f"WITH {b.REFINED} SELECT DISTINCT lotnumber, tp_cell_name FROM refined")
def distinct_values(spark, folder):
    return b.refined(spark, folder).select("lotnumber", "tp_cell_name").distinct()


@query(
    "A11_row_count_gate",
    f"""WITH {b.WEEKLY} SELECT {_WEEK_KEYS}, (SELECT count(*) FROM weekly) AS known, (SELECT count(*) FROM weekly) >= 20 AS enough
    FROM weekly""",
)
def row_count_gate(spark, folder):
    weekly = _stored_weekly(spark, folder).select("year", "week")
    known = weekly.agg(F.count(F.lit(1))).scalar()
    return _longs(weekly, "year", "week").withColumn("known", known).withColumn("enough", F.col("known") >= 20)


@query(
    "A12_daily_rollup",
    """SELECT strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS period, max(l_quantity) AS maximum_l_quantity, min(l_quantity) AS minimum_l_quantity,
    CAST(CAST(avg(l_quantity) AS FLOAT) AS DOUBLE) AS l_quantity_week_mean, CAST(CAST(stddev_samp(l_quantity) AS FLOAT) AS DOUBLE) AS l_quantity_week_stddev FROM lineitem GROUP BY 1""",
)
def daily_rollup(spark, folder):
    daily = rollup.period_rollup(b.table(spark, folder, "lineitem"), "l_shipdate", ["l_quantity"], "day")
    return _round(daily.withColumn("period", F.col("period").cast("string")), "l_quantity_week_mean", "l_quantity_week_stddev")


@query(
    "A13_sigma_thresholds",
    """SELECT l_suppkey, CAST(CAST(avg(l_quantity) - 3 * stddev_samp(l_quantity) AS FLOAT) AS DOUBLE) AS lo_limit,
    CAST(CAST(avg(l_quantity) + 3 * stddev_samp(l_quantity) AS FLOAT) AS DOUBLE) AS hi_limit FROM lineitem GROUP BY 1""",
)
def sigma_thresholds(spark, folder):
    limits = thresholds.sigma_thresholds(b.table(spark, folder, "lineitem"), "l_quantity", ["l_suppkey"])
    return _round(limits, "lo_limit", "hi_limit")


_PERCENTILES = """SELECT l_suppkey, CAST(CAST(quantile_cont(l_extendedprice, 0.01) AS FLOAT) AS DOUBLE) AS lo_limit,
    CAST(CAST(quantile_cont(l_extendedprice, 0.99) AS FLOAT) AS DOUBLE) AS hi_limit FROM lineitem GROUP BY 1"""


@query("A13_percentile_thresholds", _PERCENTILES)
def percentile_thresholds(spark, folder):
    limits = thresholds.percentile_thresholds(b.table(spark, folder, "lineitem"), "l_extendedprice", ["l_suppkey"])
    return _round(limits, "lo_limit", "hi_limit")


@query("A13_percentile_thresholds_split", _PERCENTILES)
def percentile_thresholds_split(spark, folder):
    """The same with so low a limit that the groups are cut into value ranges."""
    rows = b.table(spark, folder, "lineitem")
    return _round(thresholds.percentile_thresholds(rows, "l_extendedprice", ["l_suppkey"], max_group_rows=300), "lo_limit", "hi_limit")


_ITEM_WEEKS = f"""items AS (SELECT l_suppkey, l_extendedprice AS price, CAST(year(l_shipdate) AS INTEGER) AS year, CAST({b.SERVER_WEEK.format(d="l_shipdate")} AS INTEGER) AS week FROM lineitem)"""


def _item_weeks(spark, folder):
    """Prices of suppliers with the week of their day."""
    rows = b.table(spark, folder, "lineitem").select("l_suppkey", F.col("l_extendedprice").alias("price"), F.col("l_shipdate").cast("date").alias("d"))
    return with_calendar_parts(rows, F.col("d")).select("l_suppkey", "price", "year", "week")


@query(
    "A13_thresholds_from_sketches",
    f"""WITH {_ITEM_WEEKS} SELECT l_suppkey, quantile_disc(price, 0.01) AS lo_limit, quantile_disc(price, 0.99) AS hi_limit, count(*) AS rows FROM items
    WHERE year BETWEEN 1996 AND 1997 GROUP BY l_suppkey""",
)
def thresholds_from_sketches(spark, folder):
    """Limits over two past years from the stored weekly sketches. So few rows of a supplier are all kept, and the limits are exact."""
    path = scratch_path(spark, "sketches")
    thresholds.sketch_history(_item_weeks(spark, folder), path, ["price"], ["l_suppkey"])
    history = spark.read.parquet(path).filter(F.col("year").between(1996, 1997))
    return thresholds.merged_thresholds(history, "price", ["l_suppkey"])


@query(
    "A13_sketch_rank_error",
    f"""WITH {_ITEM_WEEKS} SELECT CAST(year AS BIGINT) AS year, count(*) AS rows, TRUE AS low_within, TRUE AS high_within FROM items GROUP BY year""",
)
def sketch_rank_error(spark, folder):
    """Limits of whole years, merged from coarse weekly sketches of all suppliers: the share of prices up to a limit is the level, but for the stated error."""
    rows, size = staged(_item_weeks(spark, folder), "items"), 200
    sketches = thresholds.period_sketches(rows, ["price"], ["l_suppkey"], size=size)
    limits = thresholds.merged_thresholds(sketches.select("year", "price_sketch"), "price", ["year"], 0.05, 0.95)
    joined = rows.join(F.broadcast(limits.drop("rows")), "year")
    share = lambda limit: F.count_if(F.col("price") <= F.col(limit)) / F.count(F.lit(1))
    error = 2 * thresholds.rank_error(size)
    checked = joined.groupBy(F.col("year").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("rows"), share("lo_limit").alias("lo"), share("hi_limit").alias("hi"))
    return checked.select("year", "rows", (F.abs(F.col("lo") - 0.05) <= error).alias("low_within"), (F.abs(F.col("hi") - 0.95) <= error).alias("high_within"))


def _bands(feature, partition="PARTITION BY lot"):
    return f"""avg({feature}) OVER w AS {feature}_ma, stddev_samp({feature}) OVER w AS {feature}_std"""


_W = "WINDOW w AS (PARTITION BY lot ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
_SERIES_LINES = """CAST(CAST(ma AS FLOAT) AS DOUBLE) AS ma, CAST(CAST(std AS FLOAT) AS DOUBLE) AS std, CAST(CAST(ma - 2 * std AS FLOAT) AS DOUBLE) AS spc_lower, CAST(CAST(ma + 2 * std AS FLOAT) AS DOUBLE) AS spc_upper"""
_CHART = f"""WITH {b.SERIES}, m AS (SELECT seq, lot, domecasegap, avg(domecasegap) OVER w AS ma, stddev_samp(domecasegap) OVER w AS std
    FROM series {_W}) SELECT seq, lot, domecasegap AS value, {_SERIES_LINES} FROM m"""
LINES = ["ma", "std", "spc_lower", "spc_upper"]


@query("W1_W2_W5_chart_series", _CHART)
def chart_series(spark, folder):
    return _round(spc.chart_series(b.series(spark, folder), "domecasegap", ["lot"], ["seq"]), *LINES)


@query("W1_W2_chart_series_split", _CHART.replace("PARTITION BY lot", "PARTITION BY lot % 10"))
def chart_series_split(spark, folder):
    """Ten groups of lots, each far above the limit and cut into parts."""
    rows = staged(b.series(spark, folder).withColumn("ten", F.col("lot") % 10), "series")
    banded = spc.control_bands(rows, ["domecasegap"], ["ten"], ["seq"], max_group_rows=_fiftieth(rows))
    lines = [F.col(f"domecasegap_{n}").alias(n) for n in LINES]
    return _round(banded.select("seq", "lot", F.col("domecasegap").alias("value"), *lines), *LINES)


@query(
    "W8_global_rolling_window",
    f"""WITH {b.SERIES}, m AS (SELECT seq, domecasegap, avg(domecasegap) OVER w AS ma, stddev_samp(domecasegap) OVER w AS std
    FROM series WINDOW w AS (ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) SELECT seq, domecasegap AS value, {_SERIES_LINES} FROM m""",
)
def global_rolling_window(spark, folder):
    rows = b.series(spark, folder)
    chart = spc.chart_series(rows, "domecasegap", [], ["seq"], max_group_rows=_fiftieth(rows))
    return _round(chart, *LINES)


_COMPAT_RULE = """WHEN lo_value < lo_spc AND hi_value > hi_spc THEN '0:Within SPC limits'
          WHEN lo_value * 1.1 >= lo_spc OR hi_value * 0.9 <= hi_spc THEN '1:Approaching SPC limits'
          WHEN lo_value > lo_spc THEN '2:Below SPC limits' WHEN hi_value > hi_spc THEN '3:Above SPC limits'
          WHEN hi_value > hi_limit OR lo_value < lo_limit THEN '4:Above limits'"""
_STRICT_RULE = """WHEN hi_value > hi_limit OR lo_value < lo_limit THEN '4:Above limits'
          WHEN hi_value > hi_spc THEN '3:Above SPC limits' WHEN lo_value < lo_spc THEN '2:Below SPC limits'
          WHEN lo_value <= lo_spc + abs(lo_spc) * 0.1 OR hi_value >= hi_spc - abs(hi_spc) * 0.1 THEN '1:Approaching SPC limits'
          WHEN lo_value >= lo_spc AND hi_value <= hi_spc THEN '0:Within SPC limits'"""


def _trend_sql(keys, rows, rule=_COMPAT_RULE):
    """Trend rows over both features; keys is '' or 'lot'."""
    part, group, on = (f"PARTITION BY {keys} ", f"GROUP BY {keys}", f"USING ({keys})") if keys else ("", "", "ON TRUE")
    key = f"{keys}, " if keys else ""
    parts = []
    for f in FEATURES:
        low, high = b.LOW_SIDE.format(t=f"{f}_limit"), b.HIGH_SIDE.format(t=f"{f}_limit")
        parts.append(f"""(WITH m AS (SELECT *, avg({f}) OVER w AS ma, stddev_samp({f}) OVER w AS std FROM flagged
          WINDOW w AS ({part}ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
        g AS (SELECT {key}min({f}) AS lo_value, max({f}) AS hi_value, avg(ma - 2 * std) AS lo_spc, avg(ma + 2 * std) AS hi_spc,
          count(*) AS rows FROM m {group}),
        t AS (SELECT {key}arg_min(coalesce({low}, -1e300), seq) AS lo_limit, arg_min(coalesce({high}, 1e300), seq) AS hi_limit,
          arg_min({f}_limit, seq) AS limit_text FROM series {group}),
        l AS (SELECT g.*, t.* {"EXCLUDE (" + keys + ")" if keys else ""}, CASE
          {rule} ELSE '5:Unknown' END AS alarm
          FROM g JOIN t {on})
        {rows.format(f=f, key=key, on=on)})""")
    return f"WITH {b.SERIES}, flagged AS (SELECT * FROM series WHERE outlier = -1) " + " UNION ALL ".join(f"SELECT * FROM {p}" for p in parts)


_TREND_ROWS = """SELECT {key}seq, '{f}' AS feature, {f} AS value, CAST(CAST(ma AS FLOAT) AS DOUBLE) AS ma, CAST(CAST(std AS FLOAT) AS DOUBLE) AS std,
  CAST(CAST(ma - 2 * std AS FLOAT) AS DOUBLE) AS spc_lower, CAST(CAST(ma + 2 * std AS FLOAT) AS DOUBLE) AS spc_upper, alarm FROM m JOIN l {on} WHERE limit_text <> ''"""
_TREND_GROUPS = """SELECT {key}'{f}' AS feature, rows, lo_value, hi_value, CAST(CAST(lo_spc AS FLOAT) AS DOUBLE) AS lo_spc, CAST(CAST(hi_spc AS FLOAT) AS DOUBLE) AS hi_spc, alarm FROM l"""


def _flagged(rows):
    return rows.filter(F.col("outlier") == -1)


@query("W3_L1_trend_per_lot", _trend_sql("lot", _TREND_ROWS))
def trend_per_lot(spark, folder):
    rows = b.series(spark, folder)
    limits = spc.first_limits(rows, FEATURES, ["lot"], ["seq"])
    return _round(spc.spc_trend(_flagged(rows), limits, FEATURES, ["lot"], ["seq"]), *LINES)


@query("W3_L1_trend_of_all_outliers", _trend_sql("", _TREND_ROWS).replace("WHERE limit_text <> ''", ""))
def trend_of_all_outliers(spark, folder):
    """No key: one ordered series over all outliers, cut into parts, with one label per feature."""
    rows = b.series(spark, folder).withColumns(
        {f"{f}_limit": F.when(F.col(f"{f}_limit") == "", F.lit(":")).otherwise(F.col(f"{f}_limit")) for f in FEATURES}
    )
    limits = spc.first_limits(rows, FEATURES, [], ["seq"])
    return _round(spc.spc_trend(_flagged(rows), limits, FEATURES, [], ["seq"], max_group_rows=_fiftieth(rows)), *LINES)


@query("L1_A6_group_trend_labels", _trend_sql("lot", _TREND_GROUPS))
def group_trend_labels(spark, folder):
    rows = b.series(spark, folder)
    limits = spc.first_limits(rows, FEATURES, ["lot"], ["seq"])
    trends = spc.group_trends(_flagged(rows), limits, FEATURES, ["lot"], ["seq"])
    return _round(trends.drop("lo_limit", "hi_limit"), "lo_spc", "hi_spc")


@query("L1_strict_group_labels", _trend_sql("lot", _TREND_GROUPS, _STRICT_RULE))
def strict_group_labels(spark, folder):
    """The same groups by the rule that names what a range does to its band and limits."""
    rows = b.series(spark, folder)
    limits = spc.first_limits(rows, FEATURES, ["lot"], ["seq"])
    trends = spc.group_trends(_flagged(rows), limits, FEATURES, ["lot"], ["seq"], rule="strict")
    return _round(trends.drop("lo_limit", "hi_limit"), "lo_spc", "hi_spc")


@query(
    "W4_U3_trend_of_large_lots",
    f"""WITH {b.SERIES}, big AS (SELECT lot FROM series GROUP BY lot HAVING count(*) >= 70), m AS (SELECT seq, lot, domecasegap,
    avg(domecasegap) OVER w AS ma, stddev_samp(domecasegap) OVER w AS std FROM series WHERE outlier = -1 AND lot IN (SELECT lot FROM big)
    {_W}) SELECT seq, lot, domecasegap AS value, {_SERIES_LINES} FROM m""",
)
def trend_of_large_lots(spark, folder):
    rows = b.series(spark, folder)
    large = rollup.groups_with_rows(rows, ["lot"], 70).select("lot")
    chosen = attach(_flagged(rows).select("seq", "lot", "domecasegap"), large, ["lot"], how="left_semi")
    return _round(spc.chart_series(chosen, "domecasegap", ["lot"], ["seq"]), *LINES)


@query(
    "W6_weekly_moving_average",
    """WITH w AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS week_end, avg(l_quantity) AS weekly_mean FROM lineitem GROUP BY 1),
    s AS (SELECT CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end FROM w),
    j AS (SELECT s.week_end, weekly_mean, avg(weekly_mean) OVER o AS a, count(weekly_mean) OVER o AS n FROM s LEFT JOIN w ON w.week_end = s.week_end
    WINDOW o AS (ORDER BY s.week_end ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    SELECT strftime(week_end, '%Y-%m-%d') AS week_end, CAST(CAST(weekly_mean AS FLOAT) AS DOUBLE) AS weekly_mean, CAST(CAST(CASE WHEN n = 7 THEN a END AS FLOAT) AS DOUBLE) AS moving_average FROM j""",
)
def weekly_moving_average(spark, folder):
    rows = b.table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_quantity")
    weekly = spc.weekly_moving_average(rows, "day", "l_quantity")
    return _round(weekly.withColumn("week_end", F.col("week_end").cast("string")), "weekly_mean", "moving_average")


@query(
    "W7_drift_toward_limit",
    f"""WITH {b.SERIES}, d AS (SELECT lot, regr_slope(domecasegap, seq) AS slope, arg_max(domecasegap, seq) AS last_value, count(*) AS rows
    FROM series GROUP BY lot) SELECT lot, CAST(CAST(slope AS FLOAT) AS DOUBLE) AS slope, last_value, rows,
    CAST(CAST(slope / ((CASE WHEN slope > 0 THEN 95.0 WHEN slope < 0 THEN 5.0 END) - last_value) AS FLOAT) AS DOUBLE) AS steps_inverse FROM d""",
)
def drift_toward_limit(spark, folder):
    """The steps are compared by their inverse, which stays finite for a flat series."""
    moved = spc.drift(b.series(spark, folder), "domecasegap", "seq", ["lot"], 5.0, 95.0)
    moved = moved.withColumn("steps_inverse", F.try_divide(F.lit(1.0), F.col("steps_to_limit"))).drop("steps_to_limit")
    return _round(moved, "slope", "steps_inverse")


@query(
    "W7_rolling_drift",
    f"""WITH {b.SERIES} SELECT seq, lot, CAST(CAST(regr_slope(domecasegap, seq) OVER (PARTITION BY lot ORDER BY seq ROWS BETWEEN 9 PRECEDING
    AND CURRENT ROW) AS FLOAT) AS DOUBLE) AS slope FROM series""",
)
def rolling_drift(spark, folder):
    rows = b.series(spark, folder).select("seq", "lot", "domecasegap")
    return _round(spc.rolling_drift(rows, "domecasegap", "seq", ["lot"]), "slope").drop("domecasegap")


_ALERT_SQL = f"""WITH {b.SERIES}, m AS (SELECT lot, domecasegap, avg(domecasegap) OVER w AS ma, stddev_samp(domecasegap) OVER w AS std FROM series {_W}),
    s AS (SELECT lot, count(*) AS total, avg(ma - 2 * std) AS lo_spc, avg(ma + 2 * std) AS hi_spc FROM m GROUP BY lot),
    r AS (SELECT lot, min(domecasegap) AS lo_value, max(domecasegap) AS hi_value FROM series WHERE outlier = -1 GROUP BY lot),
    x AS (SELECT lot, avg(coalesce({b.LOW_SIDE.format(t="domecasegap_limit")}, 0)) AS lo_limit, avg(coalesce({b.HIGH_SIDE.format(t="domecasegap_limit")}, 0)) AS hi_limit
      FROM series GROUP BY lot),
    l AS (SELECT lot, total, CASE WHEN lo_value > lo_spc OR hi_value < hi_spc THEN
        CASE WHEN lo_value * 1.1 < lo_spc OR hi_value * 0.9 > hi_spc THEN 'Approaching SPC limits' ELSE 'Within SPC limits' END
      WHEN lo_value <= lo_spc OR hi_value >= hi_spc THEN CASE WHEN lo_value < lo_limit OR hi_value > hi_limit THEN 'Out of limits' ELSE 'Within limits' END END AS name
      FROM s JOIN r USING (lot) JOIN x USING (lot))
    SELECT lot, label, CASE WHEN name = label THEN total ELSE 0 END AS value, total FROM l
    CROSS JOIN (VALUES ('Within SPC limits'), ('Approaching SPC limits'), ('Out of SPC limits'), ('Out of limits'), ('Within limits')) v(label)"""


@query("A7_L2_alert_counts", _ALERT_SQL)
def alert_counts(spark, folder):
    rows = b.series(spark, folder)
    value_range = _flagged(rows).groupBy("lot").agg(F.min("domecasegap").alias("domecasegap_lo_value"), F.max("domecasegap").alias("domecasegap_hi_value"))
    limits = spc.mean_limits(rows, ["domecasegap"], ["lot"])
    return _longs(spc.alert_counts(rows, value_range, limits, "domecasegap", ["lot"], ["seq"]), "value", "total")


@query(
    "K2_latest_record",
    f"""WITH {b.WEEKLY} SELECT {_WEEK_KEYS}, maximum_domecasegap, CAST(CAST(stitcharea_week_mean AS FLOAT) AS DOUBLE) AS stitcharea_week_mean FROM weekly
    ORDER BY year DESC, week DESC LIMIT 1""",
)
def latest_record(spark, folder):
    last = rollup.latest(b.weekly(spark, folder), ["year", "week"])
    return _round(_longs(last, "year", "week"), "stitcharea_week_mean").select("year", "week", "maximum_domecasegap", "stitcharea_week_mean")


@query("K2_latest_per_key", f"WITH {b.SERIES} SELECT lot, max(seq) AS seq, arg_max(domecasegap, seq) AS domecasegap FROM series GROUP BY lot")
def latest_per_key(spark, folder):
    return rollup.latest(b.series(spark, folder).select("lot", "seq", "domecasegap"), ["seq"], ["lot"])


@query("K3_preview", f"WITH {b.SERIES} SELECT seq, lot, domecasegap FROM series ORDER BY seq LIMIT 3")
def preview(spark, folder):
    return b.series(spark, folder).select("seq", "lot", "domecasegap").orderBy("seq").limit(3)


@query(
    "K4_first_large_groups",
    f"""WITH {b.SERIES} SELECT lot, rows FROM (SELECT lot, count(*) AS rows, min(seq) AS s FROM series GROUP BY lot HAVING count(*) >= 60)
    ORDER BY s LIMIT 10""",
)
def first_large_groups(spark, folder):
    return rollup.first_groups(b.series(spark, folder), ["lot"], ["seq"], 60, 10)


@query(
    "K5_positional_split",
    f"WITH {b.SERIES}, p AS (SELECT *, row_number() OVER (ORDER BY seq) AS n FROM series) SELECT seq, domecasegap, n <= 1000 AS train FROM p",
)
def positional_split(spark, folder):
    head, rest = rollup.first_rows(b.series(spark, folder).select("seq", "domecasegap"), "seq", 1000)
    return head.withColumn("train", F.lit(True)).unionByName(rest.withColumn("train", F.lit(False)))


@query("U4_remainder_of_sample", f"WITH {b.SERIES} SELECT seq, lot FROM series WHERE (seq * 7919 + 42) % 100 >= 80")
def remainder_of_sample(spark, folder):
    from ...operators.forecast import in_training

    return b.series(spark, folder).select("seq", "lot").filter(~in_training(F.col("seq")))


@query("S9_J4_guard_skip_rows", f"WITH {b.WEEKLY} SELECT {_WEEK_KEYS} FROM weekly WHERE year > 1998")
def guard_skip_rows(spark, folder):
    weekly = _longs(_stored_weekly(spark, folder).select("year", "week"), "year", "week")
    return guard.new_period_rows(weekly.filter("year >= 1997"), weekly.filter("year <= 1998"), ["year", "week"], "skip_rows")


@query(
    "S9_guard_skip_batch",
    f"WITH {b.WEEKLY} SELECT 'apart' AS offered, {_WEEK_KEYS} FROM weekly WHERE year >= 1999",
)
def guard_skip_batch(spark, folder):
    """A batch that overlaps the stored periods adds nothing; one apart from them is added whole."""
    weekly = _longs(_stored_weekly(spark, folder).select("year", "week"), "year", "week")
    stored = weekly.filter("year <= 1998")
    apart = guard.new_period_rows(weekly.filter("year >= 1999"), stored, ["year", "week"])
    overlapping = guard.new_period_rows(weekly.filter("year >= 1998"), stored, ["year", "week"])
    return apart.select(F.lit("apart").alias("offered"), "*").unionByName(overlapping.select(F.lit("overlapping").alias("offered"), "*"))


# Predictions given from outside: here the statistics of the week itself.
_FORECAST = f"""{b.WEEKLY}, bands AS (SELECT year, week, avg(stitcharea) - 0.5 * stddev_samp(stitcharea) AS lower, avg(stitcharea) + 1.99 * stddev_samp(stitcharea)
  + (week % 3 - 1) * 500 AS upper FROM refined GROUP BY year, week),
forecast AS (SELECT week, year + CASE WHEN week >= {b.LAST_WEEK} THEN 1 ELSE 0 END AS pred_year, CASE WHEN week >= {b.LAST_WEEK} THEN 1 ELSE week + 1 END AS pred_week,
  stitcharea_week_mean + 2 * stitcharea_week_stddev AS predicted, lower, upper FROM weekly LEFT JOIN bands USING (year, week))"""


def _forecast(spark, folder):
    weekly = _stored_weekly(spark, folder)
    mean, spread = F.col("stitcharea_week_mean"), F.col("stitcharea_week_stddev")
    bands = weekly.select(
        "year", "week", (mean - 0.5 * spread).alias("spc_lower_limit"),
        (mean + 1.99 * spread + (F.col("week") % 3 - 1) * 500).alias("spc_upper_limit"),
    )
    predictions = weekly.select(
        "year", "week", F.col("stitcharea_week_mean").alias("pred_stitcharea_week_mean"),
        F.col("stitcharea_week_stddev").alias("pred_stitcharea_week_stddev"),
    )
    return weekly, alarms.forecast_rows(predictions, bands)


@query(
    "J5_L3_forecast_rows",
    f"""WITH {_FORECAST} SELECT CAST(week AS BIGINT) AS week, CAST(pred_year AS BIGINT) AS pred_year, CAST(pred_week AS BIGINT) AS pred_week,
    CAST(CAST(predicted AS FLOAT) AS DOUBLE) AS predicted, CAST(CAST(lower AS FLOAT) AS DOUBLE) AS lower, CAST(CAST(upper AS FLOAT) AS DOUBLE) AS upper FROM forecast""",
)
def forecast_rows(spark, folder):
    rows = _forecast(spark, folder)[1]
    named = rows.select("week", "pred_year", "pred_week", F.col("predicted_stitcharea_calculate").alias("predicted"),
                        F.col("spc_lower_limit").alias("lower"), F.col("spc_upper_limit").alias("upper"))
    return _round(_longs(named, "week", "pred_year", "pred_week"), "predicted", "lower", "upper")


def _message_parts():
    """The message with its numbers taken out, and its first and last number."""
    number = r"-?\d+\.\d+"
    at = lambda place: rounded(F.element_at(F.regexp_extract_all("message", F.lit(number), F.lit(0)), place).cast("double"))
    some = F.col("message").rlike(number)
    return [
        F.regexp_replace("message", number, "#").alias("message"), F.when(some, at(1)).alias("value"),
        F.when(some & ~F.col("message").endswith("nan"), at(-1)).alias("upper"),
    ]


def _state_query(name, few, many):
    @query(
        name,
        f"""WITH {_FORECAST}, c AS (SELECT *, (SELECT count(*) FROM weekly) AS n FROM forecast), s AS (SELECT *, coalesce(predicted < lower OR predicted > upper, FALSE) AS o
        FROM c) SELECT CAST(pred_year AS BIGINT) AS pred_year, CAST(pred_week AS BIGINT) AS pred_week,
        CASE WHEN n > {few} AND n < {many} AND o THEN 1 ELSE 0 END AS alarm, CASE WHEN n > {few} AND n >= {many} THEN 1 ELSE 0 END AS retrain_required,
        CASE WHEN n <= {few} THEN 1 ELSE 0 END AS additional_records_needed,
        CASE WHEN n <= {few} THEN 'Need to have more data for prediction model training....' WHEN n >= {many} THEN 'Need to re-train the data.....'
        WHEN o THEN 'Alarm: predicted_stitcharea # for week: ' || pred_week || ' is out of SPC limits '
        ELSE 'No Alarm: predicted_stitcharea ' || CASE WHEN predicted IS NULL THEN 'nan' ELSE '#' END || ' for week: ' || pred_week || ' is within SPC limits ' END
        || CASE WHEN n <= {few} OR n >= {many} THEN '' ELSE CASE WHEN lower IS NULL THEN 'nan' ELSE '#' END || ': ' || CASE WHEN upper IS NULL THEN 'nan' ELSE '#' END END AS message,
        CASE WHEN n > {few} AND n < {many} THEN CAST(CAST(predicted AS FLOAT) AS DOUBLE) END AS value, CASE WHEN n > {few} AND n < {many} THEN CAST(CAST(upper AS FLOAT) AS DOUBLE) END AS upper
        FROM s""",
    )
    def run(spark, folder):
        weekly, rows = _forecast(spark, folder)
        state = alarms.alarm_state(rows, weekly, few, many)
        flags = _longs(state, "pred_year", "pred_week", "alarm_pre_stitcharea", "retrain_required", "additional_records_needed")
        return flags.select(
            "pred_year", "pred_week", F.col("alarm_pre_stitcharea").alias("alarm"), "retrain_required", "additional_records_needed",
            *_message_parts(),
        )


_state_query("L4_alarm_state_checked", 20, 100_000)
_state_query("L4_alarm_state_more_data", 100_000, 200_000)
_state_query("L4_alarm_state_retrain", 20, 130)


@query(
    "L5_next_training",
    f"WITH {b.WEEKLY} SELECT n AS known, CASE WHEN n >= 130 THEN n + 12 ELSE 130 END AS next_training FROM (SELECT count(*) AS n FROM weekly)",
)
def next_training(spark, folder):
    known = b.weekly(spark, folder).agg(F.count(F.lit(1)).alias("known"))
    return known.withColumn("next_training", alarms.next_training_size(F.col("known"), 130).cast("long"))


@query(
    "L6_point_alarms",
    f"""WITH {b.SERIES}, m AS (SELECT seq, avg(domecasegap) OVER w AS ma, stddev_samp(domecasegap) OVER w AS std FROM series {_W}),
    g AS (SELECT avg(ma - 2 * std) AS lo, avg(ma + 2 * std) AS hi FROM m) SELECT seq, CAST(CAST(ma + 2 * std AS FLOAT) AS DOUBLE) AS predicted,
    coalesce(ma + 2 * std < (SELECT lo FROM g) OR ma + 2 * std > (SELECT hi FROM g), FALSE) AS alarm FROM m""",
)
def point_alarms(spark, folder):
    chart = spc.chart_series(b.series(spark, folder), "domecasegap", ["lot"], ["seq"])
    band = chart.agg(F.avg("spc_lower").alias("spc_lower"), F.avg("spc_upper").alias("spc_upper"))
    return _round(alarms.band_point_alarms(chart, "ma", "std", band).select("seq", "predicted", "alarm"), "predicted")


_TIED = """d AS (SELECT (l_orderkey * 8 + l_linenumber) * 100000 + l_partkey AS seq, strftime(l_shipdate, '%Y') AS year,
  strftime(l_shipdate, '%Y-%m') AS month, max(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3)"""


@query(
    "W3_trend_tied_dates_split",
    f"""WITH {_TIED} SELECT year, month, seq, CAST(CAST(avg(v) OVER w AS FLOAT) AS DOUBLE) AS ma, CAST(CAST(stddev_samp(v) OVER w AS FLOAT) AS DOUBLE) AS std FROM d
    WINDOW w AS (PARTITION BY year ORDER BY month, seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def trend_tied_dates_split(spark, folder):
    """Rolling lines of yearly groups ordered by month (as text, twelve values at most) and row, every group cut into parts."""
    seq = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100000 + F.col("l_partkey")
    keyed = b.table(spark, folder, "lineitem").groupBy(
        seq.alias("seq"), F.date_format("l_shipdate", "yyyy").alias("year"), F.date_format("l_shipdate", "yyyy-MM").alias("month")
    ).agg(F.max("l_quantity").alias("v"))
    keyed = staged(keyed, "keyed")
    lines = {"ma": F.avg("v"), "std": F.stddev_samp("v")}
    return _round(rolling(keyed, lines, ["year"], ["month", "seq"], 10, _fiftieth(keyed)).select("year", "month", "seq", "ma", "std"), "ma", "std")


@query(
    "L7_range_alarm",
    f"""WITH {b.RAW}, r AS (SELECT batchid, domecasegap AS a, {b.LOW_SIDE.format(t="domecasegap_limit")} AS lo, {b.HIGH_SIDE.format(t="domecasegap_limit")} AS hi
    FROM raw) SELECT batchid, CASE WHEN lo < a * 0.8 AND hi > a * 1.2 THEN 'Within SPC limits' WHEN lo >= a * 0.8 AND hi <= a * 1.2 THEN 'Approaching SPC limits'
    WHEN lo < a * 0.8 THEN 'Below SPC limits' WHEN hi > a * 1.2 THEN 'Above SPC limits' ELSE 'Unknown' END AS trend,
    CASE WHEN lo < a * 0.8 AND hi > a * 1.2 THEN 'No Alarm' WHEN lo >= a * 0.8 AND hi <= a * 1.2 THEN 'No Alarm'
    WHEN lo < a * 0.8 THEN 'Low Alarm' WHEN hi > a * 1.2 THEN 'High Alarm' ELSE 'Unknown' END AS alarm FROM r""",
)
def range_alarm(spark, folder):
    sides = parse_range(F.col("domecasegap_limit"), "skip")
    trend, alarm = alarms.range_alarm(F.col("domecasegap"), sides["lo"], sides["hi"])
    return b.raw(spark, folder).select("batchid", trend.alias("trend"), alarm.alias("alarm"))


@query(
    "L8_status",
    f"""WITH {_FORECAST}, l AS (SELECT * FROM forecast ORDER BY pred_year DESC, pred_week DESC LIMIT 1)
    SELECT CASE WHEN predicted < lower OR predicted > upper THEN 'red' ELSE 'green' END AS color, CAST(pred_year AS BIGINT) AS pred_year,
    CAST(pred_week AS BIGINT) AS pred_week, CASE WHEN predicted < lower OR predicted > upper THEN 'Alarm: ' ELSE 'No Alarm: ' END || 'predicted_stitcharea '
    || CASE WHEN predicted IS NULL THEN 'nan' ELSE '#' END || ' for week: ' || pred_week || CASE WHEN predicted < lower OR predicted > upper THEN ' is out of SPC limits '
    ELSE ' is within SPC limits ' END || CASE WHEN lower IS NULL THEN 'nan: nan' ELSE '#: #' END AS message,
    CAST(CAST(predicted AS FLOAT) AS DOUBLE) AS value, CAST(CAST(upper AS FLOAT) AS DOUBLE) AS upper FROM l""",
)
def status(spark, folder):
    weekly, rows = _forecast(spark, folder)
    last = _longs(alarms.status(alarms.alarm_state(rows, weekly, 20, 100_000)), "pred_year", "pred_week")
    return last.select("color", "pred_year", "pred_week", *_message_parts())


@query("L8_status_without_alarms", "SELECT 'yellow' AS color, CAST(NULL AS BIGINT) AS pred_year, CAST(NULL AS BIGINT) AS pred_week FROM (SELECT count(*) FROM lineitem)")
def status_without_alarms(spark, folder):
    """Before the first forecast the status is yellow, in one row: that of an alarm table that is not there yet."""
    none = read_snapshot(spark, scratch_path(spark, "no-alarms"), ALARMS)
    return _longs(alarms.status(none).drop("message"), "pred_year", "pred_week")


_ZONE = """CASE WHEN v < lo THEN 'below' WHEN v > hi THEN 'above' WHEN v <= lo + abs(lo) * 0.1 OR v >= hi - abs(hi) * 0.1 THEN 'near' ELSE 'inside' END"""


@query(
    "J6_L9_rows_against_limits",
    f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, s_nationkey / 4.0 AS lo, 30.0 + s_nationkey AS hi FROM lineitem
    JOIN supplier ON s_suppkey = l_suppkey) SELECT l_orderkey, l_linenumber, v AS value, {_ZONE} AS zone FROM r""",
)
def rows_against_limits(spark, folder):
    rows = b.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").alias("value"))
    limits = b.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") / 4.0).alias("lo_limit"), (F.col("s_nationkey") + 30.0).alias("hi_limit")
    )
    return thresholds.check_limits(thresholds.with_thresholds(rows, limits, ["l_suppkey"]), "value").select("l_orderkey", "l_linenumber", "value", "zone")


@query(
    "L10_user_thresholds",
    f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_quantity AS v, coalesce(CASE WHEN s_nationkey < 12 THEN s_nationkey / 4.0 END, 2.0) AS lo,
    coalesce(CASE WHEN s_nationkey < 12 THEN 30.0 + s_nationkey END, 48.0) AS hi FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
    SELECT l_orderkey, l_linenumber, v AS value, {_ZONE} AS zone FROM r WHERE {_ZONE} <> 'inside'""",
)
def user_thresholds(spark, folder):
    """Suppliers without a threshold of their own get the default pair."""
    rows = b.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").alias("value"))
    limits = b.table(spark, folder, "supplier").filter("s_nationkey < 12").select(
        F.col("s_suppkey").alias("l_suppkey"), (F.col("s_nationkey") / 4.0).alias("lo_limit"), (F.col("s_nationkey") + 30.0).alias("hi_limit")
    )
    checked = thresholds.with_thresholds(rows, limits, ["l_suppkey"], {"lo_limit": 2.0, "hi_limit": 48.0})
    return thresholds.limit_alerts(checked, "value").select("l_orderkey", "l_linenumber", "value", "zone")


@query(
    "J7_alarms_in_trend",
    f"""WITH {_FORECAST}
    SELECT batchid, testid, CAST(t.year AS BIGINT) AS year, CAST(t.week AS BIGINT) AS week, CASE WHEN pred_week IS NULL THEN NULL WHEN predicted < lower OR predicted > upper THEN 1 ELSE 0 END AS alarm
    FROM refined t LEFT JOIN forecast f ON f.pred_year = t.year AND f.pred_week = t.week""",
)
def alarms_in_trend(spark, folder):
    weekly, rows = _forecast(spark, folder)
    state = alarms.alarm_state(rows, weekly, 20, 100_000)
    rows = b.raw(spark, folder).filter("pass_failed = 'Pass' and domecasegap is not null and stitcharea is not null")
    joined = alarms.trend_with_alarms(rows.select("batchid", "testid", "year", "week"), state)
    return _longs(joined.select("batchid", "testid", "year", "week", F.col("alarm_pre_stitcharea").alias("alarm")), "year", "week", "alarm")
