"""Extract, clean-up, calendar and limit queries."""

from pyspark.sql import functions as F

from ...functions import calendar, limits as ranges, text
from ...operators import refine as clean
from ...operators.encode import CategoryCodes
from ...operators.extract import join_measurements, with_limits, with_spc_ranges
from ...operators.rollup import outliers_first, append_frames, slice_rows
from ...operators.skew import hot_groups_of
from ...schemas import CATEGORIES, NOT_MODELLED
from . import bindings as b
from .registry import query, rounded

PLAIN = ["testid", "batchid", "cell_id", "configid", "lotnumber", "pass_failed", "domecasegap", "stitcharea"]
PARTS = ["year", "quarter", "month", "week", "dayweek"]


def _longs(df, *names):
    return df.withColumns({n: F.col(n).cast("long") for n in names})


_PLAIN_SQL = "testid, batchid, cell_id, CAST(configid AS BIGINT) AS configid, lotnumber, pass_failed, domecasegap, stitcharea"
_PARTS_SQL = ", ".join(f"CAST({p} AS BIGINT) AS {p}" for p in PARTS)


@query(
    "S1_measurement_extract",
    f"""WITH {b.RAW} SELECT {_PLAIN_SQL}, {_PARTS_SQL}, domecasegap_limit, stitcharea_limit,
    laserpower AS laserpower_spc_orig FROM raw WHERE configid = 1 AND year = 1997""",
)
def measurement_extract(spark, folder):
    rows = b.stored(spark, folder, config_id=1, year=1997)
    extra = ["domecasegap_limit", "stitcharea_limit", "laserpower_spc_orig"]
    return _longs(rows.select(*PLAIN, *PARTS, *extra), "configid", *PARTS)


def _period_query(name, condition, **period):
    @query(name, f"WITH {b.RAW} SELECT {_PLAIN_SQL}, {_PARTS_SQL} FROM raw WHERE {condition}")
    def run(spark, folder):
        return _longs(b.stored(spark, folder, **period).select(*PLAIN, *PARTS), "configid", *PARTS)


_period_query("P12_period_quarter_over_month", "year = 1998 AND quarter = 2", year=1998, quarter=2, month=9, yearweek=3)
_period_query("P12_period_month_over_week", "year = 1998 AND month = 9", year=1998, month=9, yearweek=3, weekday=2)
_period_query("P12_period_week_and_weekday", "year = 1998 AND week = 30 AND dayweek = 4", year=1998, yearweek=30, weekday=4)
_period_query("P12_period_weekday_alone", "year = 1998 AND dayweek = 1", year=1998, weekday=1)
@query("P12_period_of_text_dates", f"WITH {b.RAW} SELECT {_PLAIN_SQL}, {_PARTS_SQL} FROM raw WHERE year = 1998 AND week = 30")
def period_of_text_dates(spark, folder):
    """The same without a store: the text date of each row is parsed."""
    return _longs(b.raw(spark, folder, year=1998, yearweek=30).select(*PLAIN, *PARTS), "configid", *PARTS)


_period_query("P13_configuration_and_year", "configid = 3 AND year = 1999", config_id=3, year=1999)


@query(
    "J1_batches_tests_cells",
    f"WITH {b.RAW} SELECT testid, batchid, CAST(configid AS BIGINT) AS configid, tp_cell_name, laserpower, minstitchwidth, leaktest FROM raw",
)
def batches_tests_cells(spark, folder):
    lowered = [text.lower_names(f(spark, folder)) for f in (b.batches, b.tests, b.cells)]
    rows = join_measurements(*lowered)
    return _longs(rows.select("testid", "batchid", "configid", "tp_cell_name", "laserpower", "minstitchwidth", "leaktest"), "configid")


@query(
    "J1_skewed_keys_salted",
    """SELECT o_orderpriority AS lot, count(*) AS rows, CAST(CAST(sum(l_quantity) AS FLOAT) AS DOUBLE) AS total
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1""",
)
def skewed_keys_salted(spark, folder):
    """The same join with so low a limit that the largest batches are spread over salts."""
    lowered = [text.lower_names(f(spark, folder)) for f in (b.batches, b.tests, b.cells)]
    hot = dict(zip(("batchid", "testid"), hot_groups_of(lowered[1], [["batchid"], ["testid"]], 4)))
    rows = join_measurements(*lowered, max_group_rows=4, hot=hot)
    gap = F.coalesce("domecasegap", F.lit(13.0))
    return rows.groupBy(F.trim("lotnumber").alias("lot")).agg(F.count(F.lit(1)).alias("rows"), rounded(F.sum(gap)).alias("total"))


@query(
    "J2_limits_repeat_rows",
    """SELECT l_orderkey AS batchid, l_linenumber AS line, l_suppkey AS cell_id, s_suppkey % 3 AS variant,
    l_quantity AS value FROM lineitem JOIN (SELECT s_suppkey FROM supplier UNION ALL SELECT s_suppkey FROM supplier
    WHERE s_suppkey % 3 = 1) ON s_suppkey = l_suppkey""",
)
def limits_repeat_rows(spark, folder):
    """Some keys have two limit rows; their rows are repeated."""
    rows = b.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("batchid"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("cell_id"),
        F.col("l_quantity").alias("value"),
    )
    single = b.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("cell_id"), (F.col("s_suppkey") % 3).alias("variant"))
    double = single.unionAll(single.filter("variant = 1"))
    joined = with_limits(rows, double, "cell_id")
    return joined.withColumnRenamed("variant_limit", "variant")


@query(
    "P1_P2_P3_names_and_trim",
    f"WITH {b.RAW} SELECT batchid, pass_failed, tp_cell_name, blister_id FROM raw",
)
def names_and_trim(spark, folder):
    rows = join_measurements(*[text.lower_names(f(spark, folder)) for f in (b.batches, b.tests, b.cells)])
    return text.strip_strings(rows).select("batchid", "pass_failed", "tp_cell_name", "blister_id")


@query(
    "P4_P6_P7_refined_rows",
    f"""WITH {b.REFINED} SELECT CAST(week AS BIGINT) AS week, CAST(year AS BIGINT) AS year, batchid, tp_cell_name, blister_id,
    domecasegap, domecasegap_limit, stitcharea, stitcharea_limit, minstitchwidth, CAST(bodytypeid AS BIGINT) AS bodytypeid,
    CAST(dometypeid AS BIGINT) AS dometypeid, leaktest, laserpower, lotnumber, CAST(test_time_sec AS BIGINT) AS test_time_sec,
    CAST(day AS VARCHAR) AS date, CAST(error_code_number AS BIGINT) AS error_code_number, pass_failed FROM refined""",
)
def refined_rows(spark, folder):
    rows = b.refined(spark, folder).drop("domecasegap_spc", "stitcharea_spc").withColumn("date", F.col("date").cast("string"))
    return _longs(rows, "week", "year", "bodytypeid", "dometypeid", "test_time_sec", "error_code_number")


@query("P6_passed_rows", f"WITH {b.RAW} SELECT count(*) AS rows, count(DISTINCT batchid) AS batches FROM raw WHERE pass_failed = 'Pass'")
def passed_rows(spark, folder):
    rows = clean.passed(b.raw(spark, folder))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("batchid").alias("batches"))


@query(
    "P8_drop_incomplete_rows",
    f"""WITH {b.RAW} SELECT testid, batchid, leaktest, CAST(dometypeid AS BIGINT) AS dometypeid, domecasegap FROM raw
    WHERE leaktest IS NOT NULL AND dometypeid IS NOT NULL AND domecasegap IS NOT NULL""",
)
def drop_incomplete_rows(spark, folder):
    rows = b.raw(spark, folder).select("testid", "batchid", "leaktest", "dometypeid", "domecasegap")
    return _longs(rows.na.drop("any"), "dometypeid")


@query(
    "P5_P9_sentinel_fill",
    f"""WITH {b.RAW} SELECT batchid, coalesce(domecasegap, -999) AS domecasegap, coalesce(leaktest, -999) AS leaktest,
    CAST(coalesce(dometypeid, -999) AS BIGINT) AS dometypeid, lotnumber FROM raw""",
)
def sentinel_fill(spark, folder):
    rows = b.raw(spark, folder).select("batchid", "domecasegap", "leaktest", "dometypeid", "lotnumber")
    return _longs(clean.fill_missing(rows), "dometypeid")


@query(
    "P5_model_columns",
    f"""WITH {b.REFINED} SELECT CAST(week AS BIGINT) AS week, CAST(year AS BIGINT) AS year, batchid, tp_cell_name, domecasegap,
    stitcharea, CAST(test_time_sec AS BIGINT) AS test_time_sec, pass_failed, CAST(dometypeid AS BIGINT) AS dometypeid, CAST(bodytypeid AS BIGINT) AS bodytypeid,
    CAST(error_code_number AS BIGINT) AS error_code_number, lotnumber FROM refined""",
)
def model_columns(spark, folder):
    rows = clean.model_columns(b.refined(spark, folder))
    assert len(rows.columns) == 12 and not set(rows.columns) & set(NOT_MODELLED)
    return _longs(rows, "week", "year", "test_time_sec", "dometypeid", "bodytypeid", "error_code_number")


@query("P10_integer_keys", f"WITH {b.RAW} SELECT CAST(batchid AS BIGINT) AS batchid, CAST(tp_cell_name AS BIGINT) AS cell FROM raw")
def integer_keys(spark, folder):
    return b.raw(spark, folder).select(F.col("batchid").cast("string").cast("long").alias("batchid"), F.col("tp_cell_name").cast("long").alias("cell"))


@query(
    "P11_category_codes",
    f"""WITH {b.REFINED} SELECT batchid, stitcharea, """
    + ", ".join(
        f"CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS {c}" for c in CATEGORIES
    )
    + " FROM refined",
)
def category_codes(spark, folder):
    rows = b.refined(spark, folder)
    coded = CategoryCodes.fit(rows, CATEGORIES).encode(rows)
    return _longs(coded.select("batchid", "stitcharea", *CATEGORIES), *CATEGORIES)


@query(
    "P11_category_codes_ranged",
    "SELECT p_partkey, dense_rank() OVER (ORDER BY p_name || p_brand) - 1 AS name_code, dense_rank() OVER (ORDER BY p_retailprice) - 1 AS price_code FROM part",
)
def category_codes_ranged(spark, folder):
    """Codes numbered in ranges, as for a column with very many values."""
    parts = b.table(spark, folder, "part").select("p_partkey", F.concat("p_name", "p_brand").alias("name_code"), F.col("p_retailprice").alias("price_code"))
    coded = CategoryCodes.fit(parts, ["name_code", "price_code"], max_group_rows=100).encode(parts)
    return _longs(coded.select("p_partkey", "name_code", "price_code"), "name_code", "price_code")


@query(
    "P14_week_and_cells",
    f"""WITH {b.REFINED} SELECT batchid, CAST(year AS BIGINT) AS year, tp_cell_name, domecasegap FROM refined
    WHERE week = 20 AND tp_cell_name IN (11.0, 12.0)""",
)
def week_and_cells(spark, folder):
    return _longs(slice_rows(b.refined(spark, folder), 20, [11.0, 12.0]).select("batchid", "year", "tp_cell_name", "domecasegap"), "year")


@query(
    "P15_split_by_label",
    f"WITH {b.SERIES} SELECT outlier = -1 AS flagged, count(*) AS rows, sum(seq) AS seqs FROM series GROUP BY 1",
)
def split_by_label(spark, folder):
    flagged = (F.col("outlier") == -1).alias("flagged")
    return b.series(spark, folder).groupBy(flagged).agg(F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seqs"))


_MEASURES = ["domecasegap", "stitcharea", "laserpower", "minstitchwidth", "leaktest"]


@query(
    "P17_ranges_around_values",
    f"WITH {b.RAW} SELECT testid, batchid, "
    + ", ".join(f"CAST(CAST({m} * 0.8 AS FLOAT) AS DOUBLE) AS {m}_lo, CAST(CAST({m} * 1.2 AS FLOAT) AS DOUBLE) AS {m}_hi, {m} AS {m}_spc_orig" for m in _MEASURES)
    + " FROM raw",
)
def ranges_around_values(spark, folder):
    rows = with_spc_ranges(b.raw(spark, folder))
    sides = []
    for m in _MEASURES:
        around = ranges.range_around(F.col(m))
        sides += [rounded(around["lo"]).alias(f"{m}_lo"), rounded(around["hi"]).alias(f"{m}_hi"), f"{m}_spc_orig"]
    return rows.select("testid", "batchid", *sides)


def _policy_query(policy, low, high, keep):
    lo, hi = b.LOW_SIDE.format(t="domecasegap_limit"), b.HIGH_SIDE.format(t="domecasegap_limit")

    @query(
        f"P18_limit_policy_{policy}",
        f"""WITH {b.RAW} SELECT cell_id, count(*) AS rows, {low.format(lo=lo)} AS lo, {high.format(hi=hi)} AS hi FROM raw
        {keep} GROUP BY cell_id, domecasegap_limit""",
    )
    def run(spark, folder):
        parsed = ranges.parse_range(F.col("domecasegap_limit"), policy)
        rows = b.raw(spark, folder).select("cell_id", parsed.alias("r"))
        if policy == "open":
            finite = lambda c: F.when(F.abs(c) < float("inf"), c).otherwise(F.when(c > 0, F.lit(1e9)).otherwise(F.lit(-1e9)))
            rows = rows.filter("r is not null").select("cell_id", finite(F.col("r.lo")).alias("lo"), finite(F.col("r.hi")).alias("hi"))
        else:
            rows = rows.select("cell_id", "r.lo", "r.hi")
        return rows.groupBy("cell_id", "lo", "hi").agg(F.count(F.lit(1)).alias("rows"))


_policy_query("open", "coalesce({lo}, -1e9)", "coalesce({hi}, 1e9)", "WHERE domecasegap_limit <> ''")
_policy_query("zero", "coalesce({lo}, 0)", "coalesce({hi}, 0)", "")
_policy_query("skip", "{lo}", "{hi}", "")


@query(
    "J3_attach_by_row_id",
    f"WITH {b.SERIES} SELECT seq, lot, CASE WHEN domecasegap > 100 THEN -1 ELSE 1 END AS label FROM series",
)
def attach_by_row_id(spark, folder):
    rows = b.series(spark, folder)
    labels = rows.select("seq", F.when(F.col("domecasegap") > 100, F.lit(-1)).otherwise(F.lit(1)).alias("label"))
    return rows.select("seq", "lot").join(labels, "seq")


@query(
    "D1_day_first_dates",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS day
    FROM lineitem""",
)
def day_first_dates(spark, folder):
    """Line 7 gets a day that does not exist, which reads as missing."""
    written = F.when(F.col("l_linenumber") == 7, F.lit("31/02/1999")).otherwise(F.date_format("l_shipdate", "dd/MM/yyyy"))
    rows = b.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", written.alias("t"))
    return rows.select("l_orderkey", "l_linenumber", calendar.day_first_date(F.col("t")).cast("string").alias("day"))


@query(
    "D2_calendar_parts",
    f"""SELECT l_orderkey, year(l_shipdate) AS year, quarter(l_shipdate) AS quarter, month(l_shipdate) AS month,
    {b.SERVER_WEEK.format(d="l_shipdate")} AS week, dayofweek(l_shipdate) + 1 AS dayweek FROM lineitem""",
)
def calendar_parts(spark, folder):
    rows = b.table(spark, folder, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("d"))
    return _longs(calendar.with_calendar_parts(rows, F.col("d")).drop("d"), *PARTS)


@query("D3_iso_week", "SELECT l_orderkey, weekofyear(l_shipdate) AS week FROM lineitem")
def iso_week(spark, folder):
    return b.table(spark, folder, "lineitem").select("l_orderkey", calendar.iso_week(F.col("l_shipdate").cast("date")).cast("long").alias("week"))


@query("D4_clock_seconds", f"WITH {b.RAW} SELECT batchid, CAST(test_time_sec AS BIGINT) AS seconds FROM raw")
def clock_seconds(spark, folder):
    return b.raw(spark, folder).select("batchid", calendar.clock_seconds(F.col("test_time_min")).cast("long").alias("seconds"))


@query("D5_epoch_time", "SELECT event_id, strftime(to_timestamp(event_id * 3600), '%Y-%m-%d %H:%M:%S') AS moment FROM events")
def epoch_time(spark, folder):
    moment = calendar.epoch_time(F.col("event_id") * 3600)
    return b.table(spark, folder, "events").select("event_id", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query(
    "D6_following_week",
    f"""WITH {b.RAW} SELECT DISTINCT CAST(year AS BIGINT) AS year, CAST(week AS BIGINT) AS week,
    CAST(year + CASE WHEN week >= {b.LAST_WEEK} THEN 1 ELSE 0 END AS BIGINT) AS next_year,
    CAST(CASE WHEN week >= {b.LAST_WEEK} THEN 1 ELSE week + 1 END AS BIGINT) AS next_week FROM raw""",
)
def following_week(spark, folder):
    weeks = b.raw(spark, folder).select("year", "week").distinct()
    year, week = calendar.following_week(F.col("year"), F.col("week"))
    return _longs(weeks.select("year", "week", year.alias("next_year"), week.alias("next_week")), "year", "week", "next_year", "next_week")


@query(
    "D7_json_round_trip",
    "SELECT event_id, user_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_round_trip(spark, folder):
    events = b.table(spark, folder, "events").select("event_id", "user_id", "value", F.from_json("props", "k long")["k"].alias("k"))
    written = events.select(F.to_json(F.struct(*events.columns)).alias("value"))
    return written.select(F.from_json("value", events.schema).alias("r")).select("r.*")


@query(
    "D8_number_text",
    f"""WITH {b.SERIES} SELECT lot, printf('%.3f%%', count(*) FILTER (WHERE outlier = -1) / count(*) * 100.0) AS share,
    printf('%.3f', avg(stitcharea)) AS mean, printf('%f', max(domecasegap)) AS highest FROM series GROUP BY lot""",
)
def number_text(spark, folder):
    rows = b.series(spark, folder).groupBy("lot").agg(
        F.count_if(F.col("outlier") == -1).alias("n"), F.count(F.lit(1)).alias("rows"), F.avg("stitcharea").alias("m"),
        F.max("domecasegap").alias("h"),
    )
    return rows.select(
        "lot", text.percent_text(F.col("n") / F.col("rows")).alias("share"),
        text.fixed_text(F.col("m")).alias("mean"), text.fixed_text(F.col("h"), 6).alias("highest"),
    )


@query(
    "D9_control_messages",
    "SELECT lot, expected FROM (SELECT user_id AS lot, count(*) AS expected FROM events GROUP BY 1)",
)
def control_messages(spark, folder):
    sizes = b.series(spark, folder).groupBy("lot").agg(F.count(F.lit(1)).alias("n"))
    messages = sizes.select("lot", F.concat(F.lit("file_size:"), F.col("n").cast("string")).alias("value"))
    return messages.select("lot", text.announced_rows(F.col("value")).alias("expected"))


@query(
    "U1_append_frames",
    """SELECT event_id, user_id, CAST(NULL AS DOUBLE) AS value, event_type FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, NULL, value, event_type FROM events WHERE event_type <> 'error'""",
)
def append_frames_query(spark, folder):
    events = b.table(spark, folder, "events")
    old = events.filter("event_type = 'error'").select("event_id", "user_id", "event_type")
    new = events.filter("event_type <> 'error'").select("event_id", "value", "event_type")
    return append_frames(old, new).select("event_id", "user_id", "value", "event_type")


@query("U2_outliers_first", f"WITH {b.SERIES} SELECT seq, outlier, domecasegap FROM series ORDER BY outlier, seq")
def outliers_first_query(spark, folder):
    return outliers_first(b.series(spark, folder).select("seq", "outlier", "domecasegap"), ["seq"])
