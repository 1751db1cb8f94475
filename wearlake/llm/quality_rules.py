"""Quality rules: a table of thresholds compiled into Spark expressions.

``RULES`` is data: each row names a measure and the least and greatest value that a
good text has. ``judge`` turns the table into one projection over the text; there are
no user functions and no shuffle, so a text of any length costs its own length only.

Defined results: a null text is a text without words; it fails the base rules and every
rule whose measure is null is passed (a ratio without a denominator). Repeated rows are
judged alike, each by itself. Columns of the input with the names of results are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlake.llm.common import fresh, words

# Frequent function words of the four languages.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of",
    "on", "or", "that", "the", "this", "to", "was", "with",
    "au", "aux", "avec", "dans", "de", "des", "du", "en", "et", "la", "le", "les", "par",
    "pour", "que", "qui", "sur", "un", "une",
    "con", "del", "el", "los", "las", "lo", "no", "para", "por", "se", "su", "y",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich",
    "und", "von", "zu",
)
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    name: str
    measure: str
    least: float | None = None
    greatest: float | None = None


RULES = (
    Rule("word_length", "mean_word_chars", least=2.5, greatest=15.0),
    Rule("symbols", "symbols_per_word", greatest=0.1),
    Rule("capitals", "capital_share", greatest=0.4),
    Rule("stop_words", "stop_word_share", least=0.01),
    Rule("repeated_lines", "repeated_line_share", greatest=0.5),
)


def _windows(w: str) -> Column:
    """A hash of each run of three words; the words are the column ``w``."""
    return F.expr(
        f"""CASE WHEN size({w}) < 3 THEN array()
            ELSE transform(sequence(0, size({w}) - 3),
                           i -> xxhash64({w}[i], {w}[i + 1], {w}[i + 2])) END"""
    ).cast("array<bigint>")


def _repeated_starts(h: str, packed: str, mask: str) -> str:
    """Starts of windows found twice or more, in order.

    ``packed`` holds the hashes in order, their low bits replaced by the start. Equal
    neighbours in the high bits are candidates; whole hashes decide.
    """
    candidates = f"""transform(filter({packed}, (p, j) ->
            (p & -{mask}) <=> (get({packed}, j - 1) & -{mask})
            OR (p & -{mask}) <=> (get({packed}, j + 1) & -{mask})),
        p -> struct({h}[CAST(p & ({mask} - 1) AS INT)] AS h, p & ({mask} - 1) AS at))"""
    return f"sort_array({candidates})"


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts the rules build on.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and
    ``measures``, a struct of the ratios named in ``RULES``.
    """
    w, h, packed, mask, twice, line = fresh(docs, "_w", "_h", "_packed", "_mask", "_twice", "_lines")
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    parted = docs.withColumns(
        {
            w: words(F.col(text)),
            line: F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    hashed = parted.withColumns(
        {
            h: _windows(w),
            mask: F.expr(f"CAST(shiftleft(1L, CAST(ceil(log2(size({w}) + 2)) AS INT)) AS BIGINT)"),
        }
    )
    sorted_once = hashed.withColumn(
        packed,
        F.expr(
            f"""CASE WHEN size(array_distinct({h})) = size({h}) THEN CAST(array() AS ARRAY<BIGINT>)
                ELSE sort_array(transform({h}, (x, i) -> (x & -{mask}) | CAST(i AS BIGINT))) END"""
        ),
    )
    found = sorted_once.withColumn(twice, F.expr(_repeated_starts(h, packed, mask)))
    starts = found.withColumn(
        twice,
        F.expr(
            f"""sort_array(transform(filter({twice}, (e, j) ->
                    e.h <=> get({twice}, j - 1).h OR e.h <=> get({twice}, j + 1).h), e -> e.at))"""
        ),
    )
    # Windows overlap: each start adds its three words up to the next start.
    covered = F.expr(
        f"""aggregate({twice}, named_struct('n', 0L, 'last', CAST(NULL AS BIGINT)),
                (acc, at) -> named_struct(
                    'n', acc.n + coalesce(least(at - acc.last, 3L), 3L), 'last', at),
                acc -> acc.n)"""
    )
    n = F.size(w).cast("long")
    chars = F.length(F.array_join(w, ""))
    counted = starts.withColumns(
        {
            "n_words": n,
            "word_chars": chars.cast("long"),
            "n_symbols": (F.size(F.split(whole, SYMBOLS, -1)) - 1).cast("long"),
            "n_dup_lines": (F.size(line) - F.size(F.array_distinct(line))).cast("long"),
            "n_repeat_words": covered,
        }
    )
    some = F.nullif(F.col("n_words"), F.lit(0))
    capitals = F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", ""))
    stopped = F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS)))
    return counted.withColumn(
        "measures",
        F.struct(
            (F.col("word_chars") / some).alias("mean_word_chars"),
            (F.col("n_symbols") / some).alias("symbols_per_word"),
            (capitals / F.nullif(F.col("word_chars"), F.lit(0))).alias("capital_share"),
            (stopped / some).alias("stop_word_share"),
            (F.col("n_dup_lines") / F.nullif(F.size(line), F.lit(0))).alias("repeated_line_share"),
        ),
    ).drop(w, h, packed, mask, twice, line)


def broken(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a measured row breaks."""
    verdicts = []
    for rule in rules:
        value = F.col("measures")[rule.measure]
        outside = F.lit(False)
        if rule.least is not None:
            outside = outside | (value < rule.least)
        if rule.greatest is not None:
            outside = outside | (value > rule.greatest)
        verdicts.append(F.when(outside, F.lit(rule.name)))
    return F.array_compact(F.array(*verdicts))


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with counts, ``measures``, ``base_failed``, ``broken`` and ``kept``.

    Base: fewer than 50 words, or more than half of the words in repeated windows.
    """
    found = measured(docs, text)
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        found.withColumn("base_failed", base)
        .withColumn("broken", broken(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
    )


def passing(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs`` only.

    The verdict is tied to a row number that is always at least 0, as Spark would else
    move the filter below the counts and work each of them out many times over.
    """
    (whole,) = fresh(docs, "_row")
    judged = judge(docs.select(F.struct("*").alias(whole), F.col(text).alias(text)), text, rules)
    fixed = F.when(F.monotonically_increasing_id() >= 0, F.col("kept"))
    return judged.select(whole, fixed.alias("kept")).where("kept").select(f"{whole}.*")
