"""Line dedup: later copies of repeated runs of lines are cut.

A run counts from ``least_words`` words on. From every line the shortest window of
following lines with that many words is taken, and the shortest window of preceding
lines that ends there; the least line hash of a window is its fingerprint (winnowing), so
two documents that share a run also share a window and its fingerprint. Windows whose
fingerprint turns up at one place only are dropped. The others are joined with the first
place of the same content; windows found later are cut, and as windows of a run overlap
or touch, the cut reaches as far both ways as the match does. No pairs of copies are made.

A line is a part of a text between line feeds, compared without blanks at its ends. Lines
without a word are skipped in matching and go if a cut run surrounds them. First means
least document id, then the least of the text hash, then the topmost line.

Defined results: null text stays null and has no lines; a document that is cut whole
becomes an empty text. Rows that repeat id and text are one document and come out alike;
null is an id like any other. Columns named ``n_lines``, ``n_removed`` and ``removed`` are
replaced, all other columns are handed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.common import BLANK_RUN, BLANKS, fresh, kept

LEAST_WORDS = 50


def _lines(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """``d``, ``t`` (id and text hash), ``at``, words and two hashes of each line with a word.

    Rows of one document stay in one partition, so the next steps move nothing.
    """
    split = docs.where(F.col(text).isNotNull()).select(
        F.col(doc).alias("d"), F.xxhash64(text).alias("t"), F.posexplode(F.split(text, "\n")).alias("at", "line")
    )
    bare = split.withColumn("line", F.btrim("line", F.lit(BLANKS))).where("line <> ''")
    hashed = bare.select(
        "d",
        "t",
        "at",
        F.size(F.split("line", BLANK_RUN)).cast("long").alias("words"),
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
    )
    return (
        hashed.repartition("d", "t").groupBy("d", "t", "at").agg(*(F.first(c).alias(c) for c in ("words", "h1", "h2")))
    )


def _shortest(lines: DataFrame, least_words: int) -> DataFrame:
    """The shortest windows that start or end at each line, with their fingerprints."""
    running = lines.withColumn("after", F.sum("words").over(Window.partitionBy("d", "t").orderBy("at")))
    placed = running.withColumn("before", F.col("after") - F.col("words"))
    # Line k is in the window from line i while fewer than the least words lie between.
    ahead = Window.partitionBy("d", "t").orderBy("before").rangeBetween(0, least_words - 1)
    back = Window.partitionBy("d", "t").orderBy("after").rangeBetween(-(least_words - 1), 0)

    def window(frame) -> Column:
        return F.struct(
            F.min("at").over(frame).alias("low"),
            F.max("at").over(frame).alias("high"),
            F.sum("words").over(frame).alias("words"),
            F.xxhash64(F.collect_list("h1").over(frame)).alias("k1"),
            F.xxhash64(F.collect_list("h2").over(frame)).alias("k2"),
            F.min(F.struct("h1", "at")).over(frame).alias("least"),
        )

    both = placed.select("d", "t", window(ahead).alias("ahead"), window(back).alias("back"))
    # Where both windows are the same lines, one of them is enough.
    same = (F.col("ahead.low") == F.col("back.low")) & (F.col("ahead.high") == F.col("back.high"))
    each = F.explode(F.when(same, F.array("ahead")).otherwise(F.array("ahead", "back"))).alias("w")
    return (
        both.select("d", "t", each)
        .select("d", "t", "w.low", "w.high", "w.words", "w.k1", "w.k2", F.col("w.least.h1").alias("fp"), F.col("w.least.at").alias("fp_at"))
        .where(F.col("words") >= least_words)
    )


def repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Windows of lines found before: ``d``, ``t``, ``low`` and ``high`` line numbers."""
    windows = kept(_shortest(_lines(docs, doc, text), least_words))
    place = F.struct("d", "t", "fp_at")
    recurring = windows.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("fp")
    shared = windows.join(recurring, "fp", "left_semi")
    start = F.struct(F.col("d").isNull().alias("nameless"), "d", "t", "low")
    first = shared.groupBy("k1", "k2").agg(F.min(start).alias("first"), F.max(start).alias("last"))
    # Written, so that Spark can split the copies of a common run in the join.
    first = kept(first.where("first < last").select("k1", "k2", "first"))
    later = shared.join(first, ["k1", "k2"]).where(start > F.col("first"))
    return later.select("d", "t", "low", "high")


def without_repeats(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """``docs`` with later repeated runs cut from the text.

    Adds ``n_lines``, ``n_removed`` and ``removed``, the numbers (from 0) of cut lines.
    """
    d, t, cut, line = fresh(docs, "_d", "_t", "_cut", "_line")
    gone = (
        repeats(docs, doc, text, least_words)
        .select("d", "t", F.explode(F.sequence("low", "high")).alias("at"))
        .groupBy("d", "t")
        .agg(F.sort_array(F.collect_set("at")).alias(cut))
        .select(F.col("d").alias(d), F.col("t").alias(t), cut)
    )
    same = docs[doc].eqNullSafe(gone[d]) & F.xxhash64(docs[text]).eqNullSafe(gone[t])
    joined = docs.join(gone, same, "left").withColumn(line, F.split(text, "\n"))
    n = F.coalesce(F.size(line), F.lit(0))
    left = F.array_except(F.sequence(F.lit(0), F.size(line) - 1), F.col(cut))
    remaining = F.array_join(F.transform(left, lambda i: F.get(F.col(line), i)), "\n")
    removed = F.coalesce(F.col(cut), F.array().cast("array<int>"))
    return joined.withColumns(
        {
            text: F.when(F.col(cut).isNull(), F.col(text)).otherwise(remaining),
            "n_lines": F.when(F.col(text).isNull(), F.lit(0)).otherwise(n).cast("long"),
            "n_removed": F.size(removed).cast("long"),
            "removed": removed,
        }
    ).drop(d, t, cut, line)


def cut_texts(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with its own columns only, repeated runs cut from ``text``.

    Documents of which no word is left are dropped; where there is a column ``n_chars``
    it is counted anew for texts that were cut.
    """
    (row,) = fresh(docs, "_row")
    done = without_repeats(docs.select(F.struct("*").alias(row), "doc_id", "text"), least_words=least_words)
    changed = F.col("n_removed") > 0
    whole = done.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    columns = []
    for name in docs.columns:
        value = F.col(row)[name]
        if name == "text":
            value = F.col("text")
        elif name == "n_chars":
            value = F.when(changed, F.length("text").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return whole.select(*columns)
