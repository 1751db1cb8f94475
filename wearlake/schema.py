"""Column layouts of the recordings, of the archive output and of the dictionary."""

from __future__ import annotations

from pyspark.sql import types as T

# One recording is one file: these columns identify it.
SERIES = ("participant_id", "signal", "side")

# ---- fixed values: signal names, wrist sides, sensor columns ------------------
SIGNALS = ("acc", "eda", "ibi", "temp")
SIDES = ("left", "right")

# signal -> (input column, output column), in output order
SENSORS = {
    "acc": (("x_g", "accel_x"), ("y_g", "accel_y"), ("z_g", "accel_z")),
    "eda": (("eda", "eda_us"),),
    "ibi": (("ibi", "ibi"),),
    "temp": (("temp", "skin_temp"),),
}

# ---- fixed values: columns shared by every output table, in order -------------
COMMON_OUTPUT = (
    "subjectkey", "src_subject_id", "interview_date", "interview_age", "sex",
    "mt_pilot_vib_device", "length_per", "max_devdays", "actual_devdays",
    "tlfb_daynum", "day_code", "site_time_zone", "utc_offset",
    "dc_start_date", "dc_start_time", "dc_end_date", "dc_end_time",
    "watch_device_type", "device_position", "device_timestamp",
)

# ---- fixed values: device type by subject number (first, last, device) --------
DEVICE_RULES = ((1, 83, "Empatica E4"),)

# ---- fixed values: data dictionary (element, type, size, allowed values) ------
DICTIONARY = (
    ("subjectkey", "GUID", None, "NDAR*"),
    ("src_subject_id", "String", 45, None),
    ("interview_date", "Date", None, None),
    ("interview_age", "Integer", None, "0::1440"),
    ("sex", "String", 20, "M;F; O; NR"),
    ("mt_pilot_vib_device", "String", 60, None),
    ("length_per", "String", 500, None),
    ("max_devdays", "Integer", None, None),
    ("actual_devdays", "Integer", None, None),
    ("tlfb_daynum", "Integer", None, None),
    ("day_code", "Integer", None, "0;1"),
    ("site_time_zone", "String", 20, None),
    ("utc_offset", "Integer", None, "-11 :: 12"),
    ("dc_start_date", "Date", None, None),
    ("dc_start_time", "String", 5, None),
    ("dc_end_date", "Date", None, None),
    ("dc_end_time", "String", 5, None),
    ("watch_device_type", "String", 100, None),
    ("device_position", "Integer", None, "0;1"),
    ("skin_temp", "Float", None, None),
    ("device_timestamp", "String", 20, None),
    ("accel_x", "Float", None, None),
    ("accel_y", "Float", None, None),
    ("accel_z", "Float", None, None),
    ("eda_us", "Float", None, None),
    ("ibi", "Float", None, None),
)

# Dictionary type -> Spark type
DICTIONARY_TYPES = {
    "GUID": T.StringType(),
    "String": T.StringType(),
    "Date": T.DateType(),
    "Integer": T.IntegerType(),
    "Float": T.DoubleType(),
    "File": T.StringType(),
}

# ---- fixed values: columns of recordings, subject metadata and visits ---------
# Columns a recording may carry besides its sensor columns, with canonical types.
RECORDING_TYPES = {
    "timestamp_utc": "timestamp",
    "timestamp_local": "timestamp_ntz",
    "timezone": "string",
    "day_of_study": "int",
    "device_worn": "int",
    "interview_age": "int",
    "mt_pilot_vib_device": "string",
}

METADATA_SCHEMA = "src_subject_id BIGINT, subjectkey STRING, sex STRING"
VISIT_COLUMNS = ("src_subject_id", "interview_date", "interview_age")


def output_columns(signal: str) -> list[str]:
    """Output column order of one signal, as the conversion writes it."""
    return [*COMMON_OUTPUT, *(out for _, out in SENSORS[signal])]


def template_columns(signal: str) -> list[str]:
    """Archive template of one signal: the output without the wrist position."""
    return [name for name in output_columns(signal) if name != "device_position"]
