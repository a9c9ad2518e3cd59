"""Declared schemas of the source and derived tables."""

from pyspark.sql import types as T

KINDS = {
    "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(),
}


def table(text: str) -> T.StructType:
    """Schema from `name type, name type, ...`; needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])

# The column names below are those of the source tables, in lower case.
BATCHES = table(
    "batchid long, batchname string, batchpath string, configid int, shift string, cell_name string, "
    "testtypeid int, lastinsertedrow long, starttime string, heads int, batterytypeid int, bodytypeid int, "
    "dometypeid int, pcatypeid int, pcbtypeid int, placementcontractorid int, employeid int, "
    "opticstypeid int, versions string, lotnumber string, sublot string"
)
TESTS = table(
    "testid long, batchid long, capsule_number string, initial_capsule_id_hex string, capsule_id_hex string, "
    "test_counter int, error_code_number int, capsule_id string, pass_failed string, start_time string, "
    "end_time string, test_time_min string, date string, history string, remark string, blister_id string, "
    "fail_tray string, fail_capsule_position string, error_code_description string, wtc string, "
    "cqc_num string, capsule_counter int, cell_name double"
)
CELLS = table(
    "testid long, domecasegap double, laserpower double, stitcharea double, minstitchwidth double, leaktest double"
)
LIMITS = table(
    "batchid long, domecasegap string, laserpower string, minstitchwidth string, stitcharea string, leaktest string"
)

# Measurements that carry a range and a limit.
MEASUREMENTS = ["domecasegap", "laserpower", "minstitchwidth", "stitcharea", "leaktest"]

# The columns kept by the clean-up step.
REFINED_COLUMNS = [
    "week", "year", "batchid", "tp_cell_name", "blister_id", "domecasegap", "domecasegap_limit",
    "domecasegap_spc", "stitcharea", "stitcharea_limit", "stitcharea_spc", "minstitchwidth", "bodytypeid",
    "dometypeid", "leaktest", "laserpower", "lotnumber", "test_time_sec", "date", "error_code_number",
    "pass_failed",
]

# The columns that do not enter the outlier model.
NOT_MODELLED = [
    "blister_id", "date", "domecasegap_limit", "domecasegap_spc", "stitcharea_limit", "stitcharea_spc",
    "leaktest", "laserpower", "minstitchwidth",
]
CATEGORIES = ["pass_failed", "dometypeid", "bodytypeid", "error_code_number", "lotnumber"]
FEATURES = ["domecasegap", "stitcharea"]

# Column names of the weekly history and of the alarm log.
WEEKLY = table(
    "year int, week int, maximum_domecasegap double, minimum_domecasegap double, "
    "domecasegap_week_mean double, domecasegap_week_stddev double, maximum_stitcharea double, "
    "minimum_stitcharea double, stitcharea_week_mean double, stitcharea_week_stddev double"
)
ALARMS = table(
    "week int, pred_year int, pred_week int, pred_stitcharea_week_mean double, "
    "pred_stitcharea_week_stddev double, spc_lower_limit double, spc_upper_limit double, "
    "predicted_stitcharea_calculate double, alarm_pre_stitcharea int, retrain_required int, "
    "additional_records_needed int, next_retraining_qty long, minimum_train_records_qty long, message string"
)
TREND_BANDS = table("year int, week int, feature string, spc_lower double, spc_upper double")
# Positional names of the measurement payload.
PAYLOAD_COLUMNS = ["blisterid", "domecasegap", "stitcharea", "testtimemin", "testtimesec", "material"]
