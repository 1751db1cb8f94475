"""CSV whose quoted fields may hold line feeds, cut into records over many splits.

Spark reads such files whole, one task for each file, or cuts records at every line feed.
Here lines are read in splits, twice. A line takes a reader that stands outside or inside a
quoted field to one of the two. The first pass puts these steps together along the lines of a
split, and one row for each split tells where a reader ends that enters it outside or inside.
Put together along a file, these rows tell how every split is entered and which record begins
there. The second pass then cuts each split into records where it is read: lines are neither
kept nor sent to other tasks. Only records that reach over a split's end are brought together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlake.operators.keyed import stored
from wearlake.session import settings
from wearlake.sources import sinks

# Bytes of lines or records that are handed to or from a Python task at a time.
BATCH_BYTES = 4 << 20

_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"

SPLIT = "file string, block long, outer boolean, inner boolean, n_outer long, n_inner long"
PIECE = "file string, block long, record long, part boolean, text binary"


def _reader() -> Callable[[bytes, bool], bool]:
    """Whether a reader that enters a line inside a quoted field, or outside, leaves it inside.

    Between two quotes of a line only commas matter. A quote opens a field only at its
    start; within a quoted field two quotes are one of the text. Like all that tasks call
    here this is made where it is used, so that it travels with them.
    """
    # Where a reader stands: before a field, in a bare field, in a quoted one, after a quote in it.
    field, bare, quoted, after = range(4)
    next_to_quote = {field: quoted, bare: bare, quoted: after, after: quoted}

    def inside(line: bytes, entered: bool) -> bool:
        if b'"' not in line:
            return entered
        at = quoted if entered else field
        for i, piece in enumerate(line.split(b'"')):
            if i:
                # Every piece but the first follows a quote.
                at = next_to_quote[at]
            if piece and at != quoted:
                at = field if piece.endswith(b",") else bare
        return at == quoted

    return inside


def _stepped(lines: DataFrame) -> DataFrame:
    """For each split: whether a reader ends inside a quoted field, and how many records begin.

    ``outer`` and ``n_outer`` are for a reader that enters it outside of quoted fields,
    ``inner`` and ``n_inner`` for one that enters it inside.
    """
    inside, names = _reader(), [part.split()[0] for part in SPLIT.split(", ")]

    def stepped(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at, done = None, []
        for batch in batches:
            for file, block, line in zip(*(column.to_pylist() for column in batch.columns)):
                if at is None or at[:2] != [file, block]:
                    at = [file, block, False, True, 0, 0]
                    done.append(at)
                outer, inner = at[2:4]
                if line.strip(b" \t\r"):
                    at[4] += not outer
                    at[5] += not inner
                at[2] = inside(line, outer)
                at[3] = at[2] if outer == inner else inside(line, inner)
        if done:
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*done), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return lines.mapInArrow(stepped, SPLIT)


def _cut(lines: DataFrame) -> DataFrame:
    """Records, or the parts of them that lie in one split, from lines with ``entry`` and ``start``.

    ``part`` tells that a record has lines in other splits, or is left open by the file's end.
    """
    inside, names, most = _reader(), [part.split()[0] for part in PIECE.split(", ")], BATCH_BYTES

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        done, size = [], 0
        at, held, record, part, state = None, [], 0, False, False

        def told() -> pa.RecordBatch:
            columns = [pa.array(values, kind) for values, kind in zip(zip(*done), kinds)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for file, block, entry, start, line in zip(*(column.to_pylist() for column in batch.columns)):
                if at != (file, block):
                    if held:
                        done.append((*at, record, part or state, b"\n".join(held)))
                    # What comes first belongs to the record that the splits before left open.
                    at, held, record, part, state = (file, block), [], start - 1, entry, entry
                if state:
                    held.append(line)
                elif line.strip(b" \t\r"):
                    if held:
                        done.append((*at, record, part, b"\n".join(held)))
                    held, record, part = [line], record + 1, False
                state = inside(line, state)
                size += len(line)
                if size >= most and done:
                    yield told()
                    done, size = [], 0
        if held:
            done.append((*at, record, part or state, b"\n".join(held)))
        if done:
            yield told()

    return lines.mapInArrow(cut, PIECE)


def _states(steps: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds ``settled`` and ``flips``: what the steps up to each row, in order, do to a reader.

    A step either settles the state whatever it was (``set``), or flips it (``flip``), or
    leaves it. ``settled`` is the last state set, null if none is; ``flips`` is the number of
    flips since.
    """
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    since = Window.partitionBy(*keys, "_sets").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    known = steps.withColumns({"settled": F.last("set", ignorenulls=True).over(upto), "_sets": F.count("set").over(upto)})
    return known.withColumn("flips", F.sum(F.col("flip").cast("int")).over(since)).drop("_sets", "set", "flip")


def _inside(settled: Column, flips: Column, entry: Column) -> Column:
    return F.coalesce(settled, entry) != (flips % 2 == 1)


def records(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """``file``, ``record`` (from 0 in each file, the header included) and ``text``.

    A record ends at a line feed outside of quoted fields, with or without a carriage return
    before it; blank lines between records are none. ``split_bytes`` sets the size of splits.
    One copy of the records is written, and nothing else of their size.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("line"),
    )
    # Both passes cut files at the same places, even if executors come or go between them.
    wide = ("spark.sql.files.minPartitionNum", "spark.sql.leafNodeDefaultParallelism")
    tasks = int(next((n for n in (spark.conf.get(name, None) for name in wide) if n), spark.sparkContext.defaultParallelism))
    usual = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_SPLIT_BYTES))
    held = {
        _SPLIT_BYTES: str(split_bytes or usual),
        "spark.sql.files.minPartitionNum": str(tasks),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    }
    split = ["file", "block"]
    with settings(spark, held):
        if split_bytes and split_bytes < usual:
            # A task reads so many small splits, one after another, as make a usual one.
            fewer = -(-lines.rdd.getNumPartitions() * split_bytes // usual)
            lines = lines.coalesce(max(fewer, tasks))
        steps = stored(_stepped(lines))
        # A split as one step: it settles the state, flips it, or leaves it.
        whole = steps.select(
            *split,
            F.when(F.col("outer") == F.col("inner"), F.col("outer")).alias("set"),
            (F.col("outer") & ~F.col("inner")).alias("flip"),
        )
        along = Window.partitionBy("file").orderBy("block")
        left = F.lag(_inside(F.col("settled"), F.col("flips"), F.lit(False))).over(along)
        entries = _states(whole, ["file"], "block").select(*split, F.coalesce(left, F.lit(False)).alias("entry"))
        begun = F.when(F.col("entry"), F.col("n_inner")).otherwise(F.col("n_outer"))
        earlier = along.rowsBetween(Window.unboundedPreceding, -1)
        starts = steps.join(entries, split).select(
            *split, "entry", F.coalesce(F.sum(begun).over(earlier), F.lit(0)).alias("start")
        )
        # One row for each split; a join that moved the lines would lose their order.
        entered = lines.join(F.broadcast(starts), split, "left")
        lost = F.raise_error(F.lit(f"files of {path} were cut otherwise the second time")).cast("boolean")
        pieces = stored(_cut(entered.select(*split, F.coalesce("entry", lost).alias("entry"), "start", "line")), compression="zstd")
    fragments = F.sort_array(F.collect_list(F.struct("block", F.col("text").cast("string").alias("text"))))
    joined = pieces.where("part").groupBy("file", "record").agg(F.array_join(fragments["text"], "\n").alias("text"))
    parts = stored(joined, compression="zstd")
    found = pieces.where("NOT part").select("file", "record", F.col("text").cast("string").alias("text")).unionByName(parts)
    text = F.regexp_replace("text", r"\r$", "")
    # A byte order mark is no text.
    bare = F.when((F.col("record") == 0) & text.startswith("\ufeff"), F.substr(text, F.lit(2))).otherwise(text)
    return found.select("file", "record", bare.alias("text"))


# Fields are parsed one record at a time; what is quoted stays as it is.
_PARSED = {**{k: str(v) for k, v in sinks.CSV.items() if k != "header"}, "multiLine": "true", "lineSep": "\n"}


def _names(header: str) -> list[str]:
    """Column names; the n-th column without a name or of a name that repeats gets a number."""
    import csv

    found: list[str] = []
    for i, name in enumerate(next(csv.reader([header], strict=False))):
        plain, again = name or f"column_{i}", 0
        name = plain
        while name.lower() in (x.lower() for x in found):
            again += 1
            name = f"{plain}.{again}"
        found.append(name)
    return found


def read_csv(
    spark: SparkSession, path: str, split_bytes: int | None = None, out: str = "row_index", file: str | None = None
) -> DataFrame:
    """All columns as texts, by the names of the header, and ``out``: the row's number in its file.

    ``file`` names a column for the file's path, if it is wanted.

    Every file begins with the header; files with other names are refused. Fields that a
    short record lacks are null, further ones are dropped; empty fields are null. A file
    without a header has no rows.
    """
    found = records(spark, path, split_bytes)
    headers = found.where("record = 0").select("text").distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"files of {path} have different headers")
    if not headers:
        return spark.createDataFrame([], f"{out} long" + (f", {file} string" if file else ""))
    names = _names(headers[0].text)
    schema = ", ".join(f"c{i} STRING" for i in range(len(names)))
    parsed = found.where("record > 0").select(
        F.from_csv("text", F.lit(schema), _PARSED).alias("r"), (F.col("record") - 1).alias("_row"), "file"
    )
    place = [F.col("file").alias(file)] if file else []
    return parsed.select(*(F.col(f"r.c{i}").alias(name) for i, name in enumerate(names)), F.col("_row").alias(out), *place)
