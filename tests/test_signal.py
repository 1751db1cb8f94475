"""Signal statistics and windows against pandas and numpy, series by series."""

import math
import struct
from datetime import datetime, timedelta
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.operators import quantiles, rolling, signal_stats
from wearlake.operators.keyed import positions

KEYS = ["series"]


@pytest.fixture(scope="module")
def frames():
    rng = np.random.default_rng(11)
    found = {}
    for name, n in {"long": 1500, "twenty": 20, "short": 19, "one": 1, "flat": 60, "steps": 400}.items():
        value = np.round(rng.normal(2, 1, n), 3)
        if name == "flat":
            value[:] = 3.25
        if name == "steps":
            value = np.round(np.repeat(rng.normal(2, 1, n // 8), 8), 3)
            value[rng.integers(0, n, 20)] = np.nan
        local = pd.Timestamp("2020-01-01") + pd.to_timedelta(
            np.cumsum(rng.choice([250, 250, 500, 125], n)), unit="ms"
        )
        found[name] = pd.DataFrame({"position": np.arange(n), "local": local, "value": value})
    return found


@pytest.fixture(scope="module")
def rows(spark, frames):
    whole = pd.concat([f.assign(series=name) for name, f in frames.items()])
    shuffled = whole.sample(frac=1.0, random_state=5)
    shuffled["value"] = shuffled["value"].astype(object).where(shuffled["value"].notna(), None)
    schema = "position bigint, local timestamp_ntz, value double, series string"
    df = spark.createDataFrame(shuffled, schema)
    return df.repartition(5).persist()


def by_series(df):
    return {name: part.sort_values("position").reset_index(drop=True)
            for name, part in df.toPandas().groupby("series")}


def same(found, expected):
    np.testing.assert_allclose(
        np.asarray(found, dtype=float), np.asarray(expected, dtype=float), rtol=1e-9, atol=1e-9
    )


CHUNKS = [1_000_000, 64, 7]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_differences(rows, frames, chunk):
    found = by_series(rolling.differences(rows, KEYS, "value", "position", chunk))
    for name, frame in frames.items():
        same(found[name]["diff"], frame["value"].diff())


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("window", [20, 5])
def test_rolling_band(rows, frames, chunk, window):
    found = by_series(rolling.rolling_band(rows, KEYS, "value", "position", window, chunk))
    for name, frame in frames.items():
        roll = frame["value"].rolling(window=window, center=True)
        same(found[name]["rolling_mean"], roll.mean())
        std = roll.std()
        if name != "flat":
            same(found[name]["rolling_std"], std)
            same(found[name]["band_lo"], roll.mean() - std)
            same(found[name]["band_hi"], roll.mean() + std)


def test_rolling_band_beside_large_steps(spark):
    """Bands right behind a step of ten million, and on an offset of a billion, keep six digits."""
    rng = np.random.default_rng(4)
    value = np.round(rng.normal(0, 0.01, 300), 4)
    value[100:150] += 1e7
    value[200:] += 1e9
    value[250] = np.nan
    frame = pd.DataFrame({"series": "a", "position": np.arange(300), "value": value})
    rows = spark.createDataFrame(frame, "series string, position long, value double")
    found = rolling.rolling_band(rows, KEYS, "value", "position", 20, 64).orderBy("position").toPandas()
    for at, got in zip(range(300), found["rolling_std"]):
        part = value[max(at - 10, 0) : at + 10]
        if len(part) < 20 or at > 290 or np.isnan(part).any():
            assert pd.isna(got)
        else:
            part = [Fraction(x) for x in part]
            mean = sum(part) / 20
            assert got == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in part) / 19), rel=1e-6)


def test_nan_is_a_missing_value(spark):
    frame = pd.DataFrame({"x": [1.0, np.nan, 3.0, None, 2.0], "row": range(5)})
    listed = [(None if r.x is None else float(r.x), int(r.row), datetime(2020, 1, 1)) for r in frame.astype(object).itertuples()]
    listed[3] = (None, 3, datetime(2020, 1, 1))
    rows = spark.createDataFrame(listed, "x double, row long, at timestamp_ntz").withColumn("series", F.lit("a"))
    told = signal_stats.describe_numeric(rows, KEYS, ["x"]).first()
    want = frame["x"].astype(float).describe()
    assert [told["count"], told["mean"], told["std"], told["q25"], told["q50"], told["q75"], told["max"]] == pytest.approx(
        [want[k] for k in ("count", "mean", "std", "25%", "50%", "75%", "max")]
    )
    bins = signal_stats.histogram(rows, KEYS, "x", "row", 4).orderBy("bin").collect()
    assert [b.n for b in bins] == np.histogram([1, 3, 2], 4)[0].tolist() and bins[0].bin_lo == 1 and bins[-1].bin_hi == 3
    box = signal_stats.box_stats(rows, KEYS, "x", "row").first()
    assert (box.q1, box.median, box.q3, box.n, box.n_outliers) == (1.5, 2.0, 2.5, 3, 0)
    summary = signal_stats.signal_summary(rows, KEYS, "x", "at", "row").first()
    assert (summary.n_rows, summary.mean, summary.min, summary.max) == (5, 2.0, 1.0, 3.0)


def test_order_keys_keep_the_order_of_doubles(spark):
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 2047 << 52, 500, dtype=np.int64)
    values = [float(x) for x in bits.view(np.float64)] + [0.0, 5e-324, 2.0**-1022, 1.7976931348623157e308, float("inf"), 1.0, 2.0, 0.1]
    values += [float(np.nextafter(2.0**k, 0)) for k in range(-1000, 1000, 50)]
    values += [-x for x in values]
    rows = quantiles.with_order_key(spark.createDataFrame([(x,) for x in values], "x double"), "x", "k")
    for r in rows.select("x", "k", quantiles.key_value(F.col("k")).alias("back")).collect():
        size = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.k == (-size if r.x < 0 else size) and r.back == r.x


@pytest.mark.parametrize("few", [0, 10, 10**9])
def test_percentiles_of_many_close_values(spark, monkeypatch, few):
    """Values that share their leading bits are told apart by the next ones."""
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", few)
    rng = np.random.default_rng(few % 7)
    values = {"near": 1 + rng.random(3000) * 1e-9, "wide": rng.standard_cauchy(3000) * 1e50, "tied": np.repeat([2.5, -2.5], 300)}
    listed = [(name, float(x)) for name, found in values.items() for x in found]
    rows = spark.createDataFrame(listed, "series string, x double")
    shares = (0.0, 0.01, 0.5, 0.77, 1.0)
    for r in quantiles.percentiles(rows, KEYS, "x", shares).collect():
        assert r.quantiles == pytest.approx(np.quantile(values[r.series], shares).tolist(), rel=1e-12)


@pytest.mark.parametrize("chunk", CHUNKS)
def test_flat_points(rows, frames, chunk):
    flagged = rolling.flat_points(rows, KEYS, "value", "position", chunk=chunk)
    found = by_series(flagged)
    counts = {r.series: r.n_flat for r in rolling.flat_count(flagged, KEYS).collect()}
    for name, frame in frames.items():
        tiny = (frame["value"].diff().abs() < 0.001).to_numpy()
        n = len(tiny)
        flat = [
            bool(0 < i < n - 1 and tiny[i - 1] and tiny[i] and tiny[i + 1]) for i in range(n)
        ]
        assert found[name]["flat"].tolist() == flat
        assert counts[name] == sum(flat)


@pytest.mark.parametrize("chunk", CHUNKS)
def test_high_variation(rows, frames, chunk):
    found = {r.series: r for r in rolling.high_variation(rows, KEYS, "value", "position", chunk=chunk).collect()}
    for name, frame in frames.items():
        step = frame["value"].diff().abs()
        high = step > 2 * step.std()
        assert found[name].n_high == int(high.sum()) and found[name].n_rows == len(frame)
        assert found[name].pct_high == pytest.approx(high.mean() * 100)


@pytest.mark.parametrize("chunk", [1_000_000, 7])
def test_sampling_rate(rows, frames, chunk):
    found = {r.series: r for r in signal_stats.sampling_rate(rows, KEYS, "local", "position", chunk).collect()}
    for name, frame in frames.items():
        steps = frame["local"].diff().dt.total_seconds().mode()
        if steps.empty:
            assert name not in found
        else:
            assert found[name].step_s == steps[0] and found[name].rate_hz == pytest.approx(1 / steps[0])


def test_sampling_rate_of_tied_and_zero_steps(spark):
    seconds = {"tie": [0, 2, 4, 5, 6], "zero": [0, 0, 0, 5]}
    data = [
        (name, i, datetime(2020, 1, 1) + timedelta(seconds=s))
        for name, all_ in seconds.items() for i, s in enumerate(all_)
    ]
    df = spark.createDataFrame(data, "series string, position bigint, local timestamp_ntz")
    found = {r.series: (r.step_s, r.rate_hz) for r in signal_stats.sampling_rate(df, KEYS, "local", "position").collect()}
    assert found == {"tie": (1.0, 1.0), "zero": (0.0, None)}


def test_signal_summary(rows, frames):
    found = {r.series: r for r in signal_stats.signal_summary(rows, KEYS, "value", "local", "position").collect()}
    for name, frame in frames.items():
        value, local, got = frame["value"], frame["local"], found[name]
        assert got.n_rows == len(frame) and got.n_columns == 4
        same([got.mean, got.min, got.max, got.range],
             [value.mean(), value.min(), value.max(), value.max() - value.min()])
        same([got.std if got.std is not None else np.nan], [value.std()])
        assert got.first_local == local.iloc[0] and got.last_local == local.iloc[-1]
        assert got.duration_s == pytest.approx((local.max() - local.min()).total_seconds())


def test_describe_numeric(rows, frames):
    found = signal_stats.describe_numeric(rows, KEYS, ["value", "position"])
    for row in found.collect():
        frame = frames[row.series][row.column].describe()
        got = [row["count"], row["mean"], row["std"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]]
        same([np.nan if g is None else g for g in got], frame.to_numpy())
    assert found.count() == 2 * len(frames)


def test_ranked_percentiles_of_repeated_and_missing_values(spark):
    data = [("a", 1.0)] * 700 + [("a", 2.0)] * 299 + [("a", 9.0)] + [("b", None)] * 3 + [("c", 5.0)]
    df = spark.createDataFrame(data, "series string, value double")
    shares = (0.0, 0.25, 0.7, 0.9995, 1.0)
    found = {r.series: r.quantiles for r in quantiles.percentiles(df, KEYS, "value", shares).collect()}
    values = np.array([v for s, v in data if s == "a"])
    same(found["a"], np.quantile(values, shares))
    assert found["c"] == [5.0] * 5 and found["b"] is None


def test_histogram(rows, frames):
    found = signal_stats.histogram(rows, KEYS, "value", "position").toPandas()
    for name, frame in frames.items():
        counts, edges = np.histogram(frame["value"].dropna(), bins=30)
        part = found[found.series == name].sort_values("bin")
        assert part["n"].tolist() == counts.tolist()
        same(part["bin_lo"], edges[:-1])
        same(part["bin_hi"], edges[1:])


def test_histogram_on_edges(spark):
    for step, n in ((0.1, 31), (0.07, 43), (0.01, 11)):
        values = [i * step for i in range(n)] * 2
        df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "series string, position long, value double")
        found = signal_stats.histogram(df, KEYS, "value", "position").toPandas().sort_values("bin")
        counts, edges = np.histogram(values, bins=30)
        assert found["n"].tolist() == counts.tolist()
        same(found["bin_hi"], edges[1:])


def box(values):
    values = np.sort(values)
    q1, median, q3 = np.percentile(values, [25, 50, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = values[(values >= low) & (values <= high)]
    ends = (min(inside.min(), q1), max(inside.max(), q3)) if len(inside) else (q1, q3)
    return q1, median, q3, *ends, len(values) - len(inside)


def test_box_stats(rows, frames):
    found = signal_stats.box_stats(rows, KEYS, "value", "position").collect()
    assert len(found) == len(frames)
    beyond = signal_stats.box_outliers(rows, KEYS, "value", "position").groupBy("series").count()
    outliers = {r.series: r["count"] for r in beyond.collect()}
    for row in found:
        expected = box(frames[row.series]["value"].dropna().to_numpy())
        same([row.q1, row.median, row.q3, row.whisker_lo, row.whisker_hi, row.n_outliers], expected)
        assert outliers.get(row.series, 0) == row.n_outliers


def test_distinct_values_keep_null_and_first_row(spark):
    data = [(0, "x"), (1, None), (2, "y"), (3, "x"), (4, None)]
    df = spark.createDataFrame(data, "position bigint, zone string")
    found = signal_stats.distinct_values(df, "zone", "position").orderBy("first_row").collect()
    assert [tuple(r) for r in found] == [("x", 0), (None, 1), ("y", 2)]


def test_positions_number_rows_despite_gaps(spark):
    data = [(s, i * i + 3) for s, n in (("a", 40), ("b", 3)) for i in range(n)]
    df = spark.createDataFrame(data, "series string, id bigint")
    found = positions(df, KEYS, "id").orderBy("series", "id").collect()
    assert [r.position for r in found] == [*range(40), *range(3)]
    whole = positions(df.where(F.col("series") == "a"), [], "id").orderBy("id")
    assert [r.position for r in whole.collect()] == list(range(40))
