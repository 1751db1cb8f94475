"""A small study on disk with the awkward cases, and its expected output by pandas."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from dateutil.relativedelta import relativedelta

AS_OF = datetime(2024, 1, 15, 12, 0, tzinfo=timezone.utc)
SENSORS = {"acc": ["x_g", "y_g", "z_g"], "eda": ["eda"], "ibi": ["ibi"], "temp": ["temp"]}

METADATA = """sex,src_subject_id,subjectkey,note
F,1,NDARAA000001,first
M,1,NDARZZ999999,second row loses
M,2,NDARAA000002,
F,84,NDARAA000084,"a, comma"
F,1234,NDARAA001234,
"""

VISITS = """subjectkey,src_subject_id,interview_date,interview_age,sex
NDARAA000001,001--1,2021-06-14,310,F
NDARAA000001,001--1,2021-07-31,312,F
NDARAA000001,001--1,2021-10-09,314,F
NDARAA000001,001--1,2021-08-02,,F
NDARAA000002,002--1,2020-02-29,240,M
NDARAA000002,002--1,2020-03-31,241,M
NDARAA000002,002--1,2020-05-31,240,M
NDARAA000084,084--1,2020-03-01,300,F
NDARAA001234,1234--1,2019-12-31,1,F
"""


@dataclass
class MiniStudy:
    base: str
    metadata: str
    visits: str
    frames: dict[str, pd.DataFrame]  # recording stem -> what pandas sees


def _frame(signal: str, n: int, seed: int, start: str, zone, offset_h: int) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    utc = pd.Timestamp(start) + pd.to_timedelta(np.arange(n) * 6 * 3600, unit="s")
    utc = utc + pd.to_timedelta(rng.integers(0, 999_999, n), unit="us")
    local = utc + pd.Timedelta(hours=offset_h)
    frame = pd.DataFrame(
        {
            "timestamp_utc": utc.tz_localize("UTC"),
            "timestamp_local": local,
            "timezone": zone,
            "day_of_study": ((local - local[0].normalize()).days).astype("int64"),
            "device_worn": (rng.random(n) < 0.9).astype("int64"),
        }
    )
    for name in SENSORS[signal]:
        frame[name] = np.round(rng.normal(1.0, 0.5, n), 4)
    return frame


def build(base: Path) -> MiniStudy:
    frames: dict[str, pd.DataFrame] = {}
    tree = base / "tree"

    def put(folder, name, frame, unit="us", **options):
        (tree / folder).mkdir(parents=True, exist_ok=True)
        pq.write_table(
            pa.Table.from_pandas(frame, preserve_index=False),
            tree / folder / f"{name}.parquet",
            coerce_timestamps=None if unit == "ns" else unit,
            allow_truncated_timestamps=True,
            version="2.6",
            **options,
        )
        frames[name] = frame

    seed = 0
    for signal in SENSORS:
        for side in ("left", "right"):
            seed += 1
            frame = _frame(signal, 300 + seed, seed, "2020-01-26 22:30", "America/New_York", -5)
            put("SP1", f"SP1_e4_{signal}_{side}", frame, row_group_size=40)
        frame = _frame(signal, 90, 50 + seed, "2020-02-20 01:00", "Pacific/Auckland", 13)
        put("SP2", f"SP2_e4_{signal}_left", frame)
        frame = _frame(signal, 45, 90 + seed, "2020-05-01 00:00", "America/St_Johns", -3)
        put("SP84", f"SP84_e4_{signal}_right", frame)
        frame = _frame(signal, 30, 130 + seed, "2021-02-26 03:00", "Mars/Olympus", 0)
        put("SP1234", f"SP1234_e4_{signal}_left", frame)
        if signal != "ibi":
            put("SP10", f"SP10_e4_{signal}_left", _frame(signal, 10, 7, "2020-01-01", "UTC", 0))

    # Nanosecond timestamps; the last three digits have to go.
    frame = _frame("eda", 60, 500, "2020-02-20 01:00", "Pacific/Auckland", 13)
    frame["timestamp_utc"] = frame["timestamp_utc"] + pd.Timedelta(nanoseconds=789)
    frame["timestamp_local"] = frame["timestamp_local"] + pd.Timedelta(nanoseconds=789)
    put("SP2", "SP2_e4_eda_left", frame, unit="ns")

    # Nulls, unordered ends, worn shares on and above the threshold.
    frame = _frame("temp", 44, 501, "2020-02-20 01:00", "", 0)
    days = pd.to_datetime("2020-03-01") + pd.to_timedelta(np.repeat(np.arange(4), 11), unit="D")
    frame["timestamp_local"] = days
    frame["device_worn"] = 1.0
    frame.loc[[0, 11, 12], "device_worn"] = [0.0, 0.0, np.nan]  # 10/11 stays, 9/11 does not
    frame.loc[43, "timestamp_local"] = pd.NaT
    frame.loc[0, "timestamp_utc"] = pd.NaT
    frame.loc[43, "timestamp_utc"] = pd.Timestamp("2020-01-01 00:00", tz="UTC")
    frame.loc[5, "temp"] = np.nan
    put("SP2", "SP2_e4_temp_left", frame)

    # No day_of_study, no device_worn, no timezone.
    frame = _frame("acc", 30, 502, "2021-02-26 03:00", "UTC", 0)
    put("SP1234", "SP1234_e4_acc_left", frame.drop(columns=["day_of_study", "device_worn", "timezone"]))
    # day_of_study present but null throughout; no sensor column.
    frame = _frame("ibi", 12, 503, "2021-02-26 03:00", "UTC", 0)
    frame["day_of_study"] = None
    put("SP1234", "SP1234_e4_ibi_left", frame.drop(columns=["ibi"]))

    # Things to ignore.
    (tree / "SPx").mkdir()
    (tree / "SP7").mkdir()
    put("SP1", "SP1_e4_bvp_left", _frame("eda", 5, 1, "2020-01-01", "UTC", 0))
    (tree / "SP1" / "notes.txt").write_text("no recording")
    # Broken files of a participant of their own.
    for signal in SENSORS:
        put("SP3", f"SP3_e4_{signal}_left", _frame(signal, 200, 600, "2020-01-01", "UTC", 0))
    whole = (tree / "SP3" / "SP3_e4_acc_left.parquet").read_bytes()
    (tree / "SP3" / "SP3_e4_acc_left.parquet").write_bytes(whole[: len(whole) // 2])
    (tree / "SP3" / "SP3_e4_ibi_left.parquet").write_bytes(b"")

    (base / "metadata.csv").write_text(METADATA)
    (base / "visits.csv").write_text(VISITS)
    return MiniStudy(str(tree), str(base / "metadata.csv"), str(base / "visits.csv"), frames)


# ---- expected output, one recording at a time -------------------------------------

BIRTHS = {
    # 1: 310 and 312 and 314 months before -> 1995-08-14, 1995-07-31, 1995-08-09
    1: pd.Timestamp("1995-08-09"),
    # 2: 2000-02-29, 2000-02-29 (clipped), 2000-05-31
    2: pd.Timestamp("2000-02-29"),
    84: pd.Timestamp("1995-03-01"),
    1234: pd.Timestamp("2019-11-30"),
}
SUBJECTS = {
    1: ("NDARAA000001", "F"),
    2: ("NDARAA000002", "M"),
    84: ("NDARAA000084", "F"),
    1234: ("NDARAA001234", "F"),
}
ZONES = {
    "America/New_York": ("EST", -5),
    "America/St_Johns": ("NST", -3),
    "Pacific/Auckland": ("NZDT", None),
    "Mars/Olympus": ("Mars/Olympus", None),
    "UTC": ("UTC", 0),
    "": (None, None),
    None: (None, None),
}
OUT = {
    "acc": {"x_g": "accel_x", "y_g": "accel_y", "z_g": "accel_z"},
    "eda": {"eda": "eda_us"},
    "ibi": {"ibi": "ibi"},
    "temp": {"temp": "skin_temp"},
}


def expected(stem: str, frame: pd.DataFrame, first_rows: int = -1) -> list[dict]:
    if first_rows >= 0:
        frame = frame.head(first_rows)
    subject, signal, side = int(stem.split("_")[0][2:]), stem.split("_")[2], stem.split("_")[3]
    n = len(frame)
    blank = pd.Series([None] * n)
    local, utc = frame["timestamp_local"], frame["timestamp_utc"]
    zone = frame["timezone"].iloc[0] if "timezone" in frame else None
    if "day_of_study" in frame:
        top = pd.to_numeric(frame["day_of_study"]).max()
        length = None if pd.isna(top) else int(top) + 1
    else:
        length = 0
    worn = 0
    if "device_worn" in frame:
        flags = (frame["device_worn"] == 1).groupby(local.dt.date)
        worn = int((flags.sum() / flags.size() > 0.9).sum())
    birth = BIRTHS.get(subject)

    def text(moment, pattern):
        return None if pd.isna(moment) else moment.strftime(pattern)

    def age(moment):
        if birth is None or pd.isna(moment):
            return None
        span = relativedelta(moment.date(), birth.date())
        return span.years * 12 + span.months

    key, sex = SUBJECTS.get(subject, (None, None))
    device = "Empatica E4" if 1 <= subject <= 83 else ""
    rows = []
    for i in range(n):
        moment = local.iloc[i]
        day = frame["day_of_study"].iloc[i] if "day_of_study" in frame else 0
        row = {
            "participant_id": f"SP{subject}", "signal": signal, "side": side,
            "subjectkey": key, "src_subject_id": f"{subject:03d}", "sex": sex,
            "interview_date": text(moment, "%m/%d/%Y"), "interview_age": age(moment),
            "mt_pilot_vib_device": device, "watch_device_type": device,
            "length_per": length, "max_devdays": length, "actual_devdays": worn,
            "tlfb_daynum": None if pd.isna(day) else int(day) + 1,
            "day_code": None if pd.isna(moment) else int(moment.day_name() in ("Friday", "Saturday")),
            "site_time_zone": ZONES[zone][0], "utc_offset": ZONES[zone][1],
            "dc_start_date": text(utc.iloc[0], "%m/%d/%Y"), "dc_start_time": text(utc.iloc[0], "%H:%M"),
            "dc_end_date": text(utc.iloc[-1], "%m/%d/%Y"), "dc_end_time": text(utc.iloc[-1], "%H:%M"),
            "device_position": 0 if side == "left" else 1,
            "device_timestamp": text(utc.iloc[i], "%Y-%m-%d %H:%M:%S.%f"),
        }
        for source, out in OUT[signal].items():
            value = frame.get(source, blank).iloc[i]
            row[out] = None if pd.isna(value) else float(value)
        rows.append(row)
    return rows
