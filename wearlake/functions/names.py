"""What a file name or a folder name says about a recording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: naming rules of recordings and participant folders
RECORDING_NAME = r"^SP(\d+)_e4_(acc|eda|ibi|temp)_(left|right)\.parquet$"
FOLDER_NAME = r"^SP(\d+)$"
UNKNOWN_PARTICIPANT = "UNKNOWN"
UNKNOWN_TYPE = "unknown"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def raw_subject(path: Column) -> Column:
    """First name token without leading S and P characters."""
    return F.regexp_replace(F.substring_index(base_name(path), "_", 1), "^[SP]+", "")


def subject_number(path: Column) -> Column:
    return raw_subject(path).try_cast("bigint")


def padded_subject(path: Column) -> Column:
    """Subject text padded to three characters, longer ones left whole."""
    raw = raw_subject(path)
    return F.lpad(raw, F.greatest(F.length(raw), F.lit(3)), F.lit("0"))


def participant(path: Column) -> Column:
    return F.concat(F.lit("SP"), raw_subject(path))


def data_type(path: Column) -> Column:
    """Signal and side, e.g. ``eda_left``; ``unknown`` for shorter names."""
    tokens = F.split(base_name(path), "_")
    side = F.replace(F.get(tokens, F.lit(3)), F.lit(".parquet"), F.lit(""))
    return F.when(
        F.size(tokens) >= 4, F.concat_ws("_", F.get(tokens, F.lit(2)), side)
    ).otherwise(UNKNOWN_TYPE)


def wrist_position(path: Column) -> Column:
    """0 if the lower-cased name says left, else 1 if it says right, else null."""
    name = F.lower(base_name(path))
    return F.when(name.contains("left"), 0).when(name.contains("right"), 1)


def participant_in_path(path: Column) -> Column:
    """First ``SP<digits>`` anywhere in a path, else ``UNKNOWN``."""
    digits = F.regexp_extract(path, r"SP(\d+)", 1)
    return F.when(digits != "", F.concat(F.lit("SP"), digits)).otherwise(
        UNKNOWN_PARTICIPANT
    )


def recording_part(path: Column, part: int) -> Column:
    """Subject (1), signal (2) or side (3) of a recording's name, else null."""
    return F.nullif(F.regexp_extract(base_name(path), RECORDING_NAME, part), F.lit(""))


def is_recording(path: Column) -> Column:
    return base_name(path).rlike(RECORDING_NAME)
