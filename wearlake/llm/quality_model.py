"""A quality classifier on document statistics.

Statistics of a text are computed by Spark expressions, standardised, and mapped to
random Fourier features, whose products approximate a Gaussian kernel. Ridge scores come
from the normal equations: each partition adds up its own products, Spark adds the
partitions row by row, and the driver solves one system of ``FEATURES`` unknowns. The
scores are calibrated by isotonic regression over counted score steps.

Labels are looked up for training only. At most ``TRAIN_ROWS`` labelled rows are used, an
even sample by the hash of the id; everything else covers all rows.

Defined results: null and empty texts have the statistics zero and get a score like any
other. Labels that are null or for unknown documents do not count. Without any label of
either kind the score is the known kind's share, and one half without labels at all.
Rows that repeat an id are scored each by itself; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.llm.common import fresh, kept, words

TRAIN_ROWS = 200_000
FEATURES = 192
WIDTH = 3.0
RIDGE = 1e-3
STEPS = 2000
SEED = 20240101
ROWS_PER_SUM = 4000

STATISTICS = (
    "log_chars", "log_words", "word_chars", "letters", "capitals", "digits", "symbols", "marks",
    "shouts", "different_words", "lines_per_word", "different_lines", "repeats", "other_bytes",
)


def _left(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``x``, the statistics of the whole text in the order of ``STATISTICS``."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    parts, all_ = fresh(docs, "_w", "_t")
    base = docs.withColumns({parts: words(F.col(text)), all_: whole})
    w, t = F.col(parts), F.col(all_)
    n, chars = F.size(w), F.length(t)
    per_char = F.greatest(chars, F.lit(1))
    per_word = F.greatest(n, F.lit(1))
    lines = F.split(t, "\n")
    values = {
        "log_chars": F.log1p(chars.cast("double")),
        "log_words": F.log1p(n.cast("double")),
        "word_chars": F.length(F.array_join(w, "")) / per_word,
        "letters": _left(t, r"[^\p{L}]+") / per_char,
        "capitals": _left(t, r"[^\p{Lu}]+") / per_char,
        "digits": _left(t, r"[^\p{Nd}]+") / per_char,
        "symbols": (F.size(F.split(t, r"[#*$%&|<>]", -1)) - 1) / per_word,
        "marks": (F.size(F.split(t, r"[.,;:?]", -1)) - 1) / per_word,
        "shouts": (F.size(F.split(t, "!", -1)) - 1) / per_word,
        "different_words": F.size(F.array_distinct(w)) / per_word,
        "lines_per_word": F.size(lines) / per_word,
        "different_lines": F.size(F.array_distinct(lines)) / F.size(lines),
        # Words followed by themselves: the distinct words of each joined pair tell.
        "repeats": F.size(F.filter(w, lambda x, i: (i > 0) & x.eqNullSafe(F.get(w, i - 1)))) / per_word,
        "other_bytes": (F.octet_length(t) - chars) / per_char,
    }
    x = F.array(*(values[name].cast("double") for name in STATISTICS))
    return base.withColumn("x", x).drop(parts, all_)


@dataclass(frozen=True)
class Model:
    """What a task needs to score: bounded by ``FEATURES`` and ``STEPS``."""

    mean: np.ndarray
    scale: np.ndarray
    turns: np.ndarray
    shifts: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.turns + self.shifts) * np.sqrt(2 / self.turns.shape[1])
        return np.hstack([np.ones((len(x), 1)), waves])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), len(STATISTICS))


def _summed(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Normal equations of ``rows`` (``x`` and ``y``), added up by Spark."""
    size = model.turns.shape[1] + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = model.fourier(_matrix(batch["x"]))
            total += z.T @ np.column_stack([z, batch["y"].to_numpy(float)])
        yield pd.DataFrame({"row": np.arange(size), "sums": list(total)})

    def added(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": batch["row"].iloc[:1], "sums": [np.sum(np.stack(batch["sums"].to_list()), axis=0)]})

    shape = "row long, sums array<double>"
    found = rows.select("x", "y").mapInPandas(partial, shape).groupBy("row").applyInPandas(added, shape).toPandas()
    both = np.stack(found.sort_values("row")["sums"].to_list())
    return both[:, :size], both[:, size]


def _isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence closest to ``value``."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def fit(rows: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | float:
    """A model from ``x``, ``y`` (0 or 1) and ``key``, or the share of ones if all are alike.

    A fifth of the rows, chosen by the hash of the key, is kept from the equations and
    used for calibration.
    """
    counts = rows.agg(F.count("*").alias("n"), F.sum("y").alias("ones")).first()
    if not counts["n"]:
        return 0.5
    if counts["ones"] in (0, counts["n"]):
        return float(counts["ones"] > 0)
    place = F.pmod(F.xxhash64("key"), F.lit(1_000_000))
    share = min(1_000_000, int(1_000_000 * train_rows / counts["n"]) + 1)
    chosen = kept(rows.where(place < share).select("x", "y", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(5)).alias("fifth")))
    used = min(counts["n"], train_rows)
    dealt = chosen.where("fifth > 0").repartition(max(1, used // ROWS_PER_SUM))
    size = len(STATISTICS)
    moments = chosen.agg(*(f(F.col("x")[i]).alias(f"{f.__name__}{i}") for i in range(size) for f in (F.avg, F.stddev_pop))).first()
    mean = np.array([moments[f"avg{i}"] for i in range(size)])
    scale = np.array([moments[f"stddev_pop{i}"] for i in range(size)])
    random = np.random.default_rng(SEED)
    model = Model(
        mean,
        np.where(scale > 1e-9, scale, 1.0),
        random.normal(0, 1 / WIDTH, (size, FEATURES)),
        random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1),
        np.array([0.0]),
        np.array([0.5]),
    )
    left, right = _summed(dealt, model)
    weights = np.linalg.solve(left + RIDGE * max(1, used) / 100 * np.eye(len(left)), right)
    scored = Model(model.mean, model.scale, model.turns, model.shifts, weights, model.knots, model.levels)

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(scored.raw(_matrix(x)))

    steps = (
        chosen.where("fifth = 0")
        .select(F.round(F.least(F.greatest(raw("x"), F.lit(-1.0)), F.lit(2.0)) * (STEPS // 3)).alias("step"), "y")
        .groupBy("step")
        .agg(F.count("*").alias("n"), F.sum("y").alias("ones"))
        .toPandas()
        .sort_values("step")
    )
    if steps.empty:
        return Model(model.mean, model.scale, model.turns, model.shifts, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    levels = _isotonic((steps["ones"] / steps["n"]).to_numpy(float), steps["n"].to_numpy(float))
    # A little of the raw order is left inside flat steps, so that ties stay ranked.
    knots = steps["step"].to_numpy(float) / (STEPS // 3)
    levels = 0.98 * levels + 0.01 * (1 + np.clip(knots, 0, 1))
    return Model(model.mean, model.scale, model.turns, model.shifts, weights, knots, levels)


def scored(rows: DataFrame, model: Model | float) -> DataFrame:
    """``rows`` (with ``x``) plus ``score``."""
    if isinstance(model, float):
        return rows.withColumn("score", F.lit(model))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(np.clip(model.score(_matrix(x)), 0, 1))

    return rows.withColumn("score", score("x"))
