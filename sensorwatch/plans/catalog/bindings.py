"""The sample tables in the roles of the source tables, in Spark and as SQL common table expressions.

Orders play batches, line items play tests, parts play cells, suppliers play limits; events play an
ordered series of measurements. White space, missing values and empty range sides are put in by
rule, so that the clean-up steps have work to do.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ...functions.calendar import iso_week, iso_year
from ...operators.extract import extract
from ...operators.refine import refine
from ...operators.rollup import weekly_rollup
from ...session import scratch_path
from ...sources.daystore import DayStore


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def batches(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("BatchID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("ConfigID"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("LotNumber"),
        F.col("o_orderstatus").alias("Cell_Name"),
        (F.col("o_custkey") % 7).cast("int").alias("BodyTypeID"),
        F.nullif((F.col("o_custkey") % 5).cast("int"), F.lit(0)).alias("DomeTypeID"),
    )


def tests(spark: SparkSession, folder: str) -> DataFrame:
    two_digits = lambda c: F.lpad(F.col(c).cast("int").cast("string"), 2, "0")
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("TestID"),
        F.col("l_orderkey").alias("BatchID"),
        F.col("l_suppkey").alias("Cell_ID"),
        F.when(F.col("l_linestatus") == "F", F.lit(" Pass\t")).otherwise(F.lit("Fail")).alias("PASS_FAILED"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("Date"),
        F.concat(two_digits("l_linenumber"), F.lit(":"), two_digits("l_quantity")).alias("Test_Time_min"),
        F.round(F.col("l_discount") * 100).cast("int").alias("ERROR_Code_Number"),
        F.concat(F.lit("B"), F.col("l_suppkey").cast("string")).alias("Blister_Id"),
        (F.col("l_suppkey") % 5 + 10).cast("double").alias("Cell_Name"),
        F.nullif("l_quantity", F.lit(13.0)).alias("DomeCaseGap"),
        F.col("l_extendedprice").alias("StitchArea"),
    )


def cells(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("TestID"),
        F.col("p_retailprice").alias("LaserPower"),
        F.col("p_size").cast("double").alias("MinStitchWidth"),
        F.when(F.col("p_size") % 10 != 0, F.col("p_size") / 8).alias("LeakTest"),
    )


def limits(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    low = F.floor(F.abs("s_acctbal") / 1000).cast("string")
    high = (F.col("s_nationkey") + 30).cast("string")

    def text(scale: str):
        return (
            F.when(key % 13 == 0, F.lit(""))
            .when(key % 7 == 0, F.concat(F.lit(":"), high, F.lit(scale)))
            .when(key % 11 == 0, F.concat(low, F.lit(scale), F.lit(":")))
            .otherwise(F.concat(low, F.lit(scale), F.lit(":"), high, F.lit(scale)))
        )

    return table(spark, folder, "supplier").select(
        key.alias("Cell_ID"), text("").alias("DomeCaseGap"), text("000").alias("StitchArea")
    )


def raw(spark: SparkSession, folder: str, **period) -> DataFrame:
    """The whole extract unless a period or configuration is asked for."""
    return extract(
        batches(spark, folder), tests(spark, folder), cells(spark, folder), limits(spark, folder), limit_key="cell_id", **period
    )


_STORES: dict[tuple[str, str], DayStore] = {}


def day_store(spark: SparkSession, folder: str) -> DayStore:
    """The tests of a folder as a day store, written once in a session, as a daily job finds it."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORES:
        store = DayStore(scratch_path(spark, "days"))
        store.append(tests(spark, folder))
        _STORES[key] = store
    return _STORES[key]


def stored(spark: SparkSession, folder: str, **period) -> DataFrame:
    """The extract of a period over the day store."""
    store = day_store(spark, folder)
    return extract(batches(spark, folder), store, cells(spark, folder), limits(spark, folder), limit_key="cell_id", **period)


def refined(spark: SparkSession, folder: str) -> DataFrame:
    return refine(raw(spark, folder))


def weekly(spark: SparkSession, folder: str) -> DataFrame:
    return weekly_rollup(refined(spark, folder))


def series(spark: SparkSession, folder: str) -> DataFrame:
    """Events as measurements: seq is a unique order, lot a key; errors play the outliers."""
    lot = F.col("user_id")
    text = (
        F.when(lot % 11 == 0, F.lit(""))
        .when(lot % 5 == 0, F.concat(F.lit(":"), (lot % 60 + 90).cast("string")))
        .otherwise(F.concat((lot % 10).cast("string"), F.lit(":"), (lot % 60 + 90).cast("string")))
    )
    day = F.col("ts").cast("date")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        lot.alias("lot"),
        day.alias("day"),
        iso_year(day).alias("year"),
        iso_week(day).alias("week"),
        F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1)).alias("outlier"),
        F.col("value").alias("domecasegap"),
        F.get_json_object("props", "$.k").cast("double").alias("stitcharea"),
        text.alias("domecasegap_limit"),
        text.alias("stitcharea_limit"),
    )


# The same frames as SQL.
SERVER_WEEK = "((dayofyear({d}) - 1 + dayofweek(date_trunc('year', {d}))) // 7 + 1)"

LAST_WEEK = SERVER_WEEK.format(d="make_date(CAST(year AS INTEGER), 12, 31)")

_LIMIT_TEXT = """CASE WHEN s_suppkey % 13 = 0 THEN ''
  WHEN s_suppkey % 7 = 0 THEN ':' || (s_nationkey + 30) || '{z}'
  WHEN s_suppkey % 11 = 0 THEN CAST(floor(abs(s_acctbal) / 1000) AS INTEGER) || '{z}:'
  ELSE CAST(floor(abs(s_acctbal) / 1000) AS INTEGER) || '{z}:' || (s_nationkey + 30) || '{z}' END"""

RAW = f"""
raw AS (
  SELECT l_partkey AS testid, l_orderkey AS batchid, l_suppkey AS cell_id,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS configid, o_orderpriority AS lotnumber,
    CAST(o_custkey % 7 AS INTEGER) AS bodytypeid, CAST(nullif(o_custkey % 5, 0) AS INTEGER) AS dometypeid,
    CASE WHEN l_linestatus = 'F' THEN 'Pass' ELSE 'Fail' END AS pass_failed,
    CAST(l_shipdate AS DATE) AS day, l_linenumber, l_quantity,
    CAST((l_linenumber * 60 + CAST(l_quantity AS INTEGER)) * 60 AS INTEGER) AS test_time_sec,
    CAST(round(l_discount * 100) AS INTEGER) AS error_code_number, 'B' || l_suppkey AS blister_id,
    CAST(l_suppkey % 5 + 10 AS DOUBLE) AS tp_cell_name, nullif(l_quantity, 13.0) AS domecasegap,
    l_extendedprice AS stitcharea, p_retailprice AS laserpower, CAST(p_size AS DOUBLE) AS minstitchwidth,
    CASE WHEN p_size % 10 <> 0 THEN p_size / 8 END AS leaktest,
    {_LIMIT_TEXT.format(z="")} AS domecasegap_limit, {_LIMIT_TEXT.format(z="000")} AS stitcharea_limit,
    year(l_shipdate) AS year, quarter(l_shipdate) AS quarter, month(l_shipdate) AS month,
    {SERVER_WEEK.format(d="l_shipdate")} AS week, dayofweek(l_shipdate) + 1 AS dayweek
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey)"""

REFINED = RAW + """,
refined AS (SELECT * FROM raw WHERE pass_failed = 'Pass' AND domecasegap IS NOT NULL AND stitcharea IS NOT NULL)"""

WEEKLY = REFINED + """,
weekly AS (
  SELECT year, week, max(domecasegap) AS maximum_domecasegap, min(domecasegap) AS minimum_domecasegap,
    avg(domecasegap) AS domecasegap_week_mean, stddev_samp(domecasegap) AS domecasegap_week_stddev,
    max(stitcharea) AS maximum_stitcharea, min(stitcharea) AS minimum_stitcharea,
    avg(stitcharea) AS stitcharea_week_mean, stddev_samp(stitcharea) AS stitcharea_week_stddev
  FROM refined GROUP BY year, week)"""

_SERIES_TEXT = """CASE WHEN user_id % 11 = 0 THEN '' WHEN user_id % 5 = 0 THEN ':' || (user_id % 60 + 90)
    ELSE (user_id % 10) || ':' || (user_id % 60 + 90) END"""

SERIES = f"""
series AS (
  SELECT event_id AS seq, user_id AS lot, CAST(ts AS DATE) AS day, isoyear(ts) AS year, weekofyear(ts) AS week,
    CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS outlier, value AS domecasegap,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS stitcharea,
    {_SERIES_TEXT} AS domecasegap_limit, {_SERIES_TEXT} AS stitcharea_limit
  FROM events)"""

# Range sides of a limit text as SQL; NULL for an empty side.
LOW_SIDE = "CAST(nullif(split_part({t}, ':', 1), '') AS DOUBLE)"
HIGH_SIDE = "CAST(nullif(split_part({t}, ':', 2), '') AS DOUBLE)"
