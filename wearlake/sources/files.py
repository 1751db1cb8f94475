"""Listing of a study tree and of Parquet footers, done by Spark tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.functions import names
from wearlake.operators.keyed import materialise

FILE_SCHEMA = "folder string, file_name string, path string, length bigint"
FOOTER_SCHEMA = (
    "readable boolean, error string, n_rows bigint, n_columns int, n_row_groups int, "
    "created_by string, columns array<struct<name: string, type: string>>"
)


# Rows of one footer task; a footer costs a few reads, so tasks stay short.
FILES_PER_TASK = 200


def qualified(spark: SparkSession, base: str) -> str:
    """``base`` as Spark spells it, whatever the caller wrote (``/x``, ``file:///x``, ...)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().rstrip("/")


def filesystem_root(spark: SparkSession, path: str) -> str:
    """The root of the file system that holds ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().toString() + "/"


def place_part(spark: SparkSession, folder: str, target: str) -> None:
    """Give the one part file that Spark wrote into ``folder`` the name ``target``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = [f.getPath() for f in system.listStatus(path(folder)) if f.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{folder} holds {len(parts)} part files")
    system.mkdirs(path(target).getParent())
    if not system.rename(parts[0], path(target)):
        raise OSError(f"{parts[0].toString()} could not become {target}")


def _opener(base: str):
    """Function for tasks: file system and the place of the qualified ``base`` in it."""

    def open_base():
        from urllib.parse import quote

        from pyarrow import fs

        if base.startswith("file:"):
            return fs.LocalFileSystem(), "/" + base.removeprefix("file:").lstrip("/")
        uri = "s3://" + base[6:] if base.startswith("s3a://") else base
        system, place = fs.FileSystem.from_uri(quote(uri, safe=":/@"))
        return system, place.rstrip("/")

    return open_base


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """Files of every folder directly under ``base``, empty files included.

    Files that begin with a dot or an underscore are none, as in Spark. A folder without
    files gives one row without file. Spark's own sources leave out
    empty files and folders, which an audit must name, so tasks list: one the folders,
    then each folder where it lands. Paths are spelled as Spark's scans spell them.
    """
    root = qualified(spark, base)
    open_base = _opener(root)

    def folders(batches):
        import pandas as pd
        from pyarrow import fs

        for _ in batches:
            system, place = open_base()
            found = system.get_file_info(fs.FileSelector(place, allow_not_found=True))
            kept = [f.base_name for f in found if f.type == fs.FileType.Directory]
            if kept:
                yield pd.DataFrame({"folder": kept})

    roots = spark.createDataFrame([(root,)], "base string")
    names_of = roots.mapInPandas(folders, "folder string")
    return _listed(names_of.repartition("folder"), root, open_base)


def _listed(folders: DataFrame, root: str, open_base) -> DataFrame:
    def files(batches):
        import pandas as pd
        from pyarrow import fs

        system, place = open_base()
        for batch in batches:
            for folder in batch["folder"]:
                below = f"/{folder}" if folder else ""
                found = system.get_file_info(fs.FileSelector(place + below))
                # Names that Spark's sources skip: checksums, marks of a finished job.
                kept = [f for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"]
                if not kept:
                    yield pd.DataFrame(
                        {"folder": [folder], "file_name": [None], "path": [None], "length": [None]}
                    )
                    continue
                yield pd.DataFrame(
                    {
                        "folder": folder,
                        "file_name": [f.base_name for f in kept],
                        "path": [f"{root}{below}/{f.base_name}" for f in kept],
                        "length": [f.size for f in kept],
                    }
                )

    return folders.mapInPandas(files, FILE_SCHEMA)


def single_level(spark: SparkSession, base: str, pattern: str = "%") -> DataFrame:
    """Files directly in ``base`` whose name is like ``pattern``, empty ones included."""
    root = qualified(spark, base)
    here = spark.createDataFrame([("",)], "folder string")
    return _listed(here, root, _opener(root)).where(F.col("file_name").like(pattern))


def with_footers(files: DataFrame, base: str) -> DataFrame:
    """Add what each file's Parquet footer says; no data page is read."""

    root = qualified(files.sparkSession, base)
    open_base = _opener(root)

    def footers(batches):
        import pandas as pd
        import pyarrow.parquet as pq

        system, place = open_base()

        def look(path, length):
            if path is None or not length:
                return (False, "empty file" if path else None, None, None, None, None, None)
            try:
                with system.open_input_file(place + path.removeprefix(root)) as source:
                    file = pq.ParquetFile(source)
                    about, schema = file.metadata, file.schema_arrow
                    stored = {file.schema.column(i).path: file.schema.column(i).physical_type for i in range(len(file.schema))}
                columns = [
                    {"name": f.name, "type": "timestamp[int96]" if stored.get(f.name) == "INT96" else str(f.type)} for f in schema
                ]
                return (
                    True, None, about.num_rows, len(schema), about.num_row_groups,
                    about.created_by, columns,
                )
            except Exception as problem:  # any failure is the finding itself
                return (False, str(problem), None, None, None, None, None)

        added = [
            "readable", "error", "n_rows", "n_columns", "n_row_groups", "created_by", "columns",
        ]
        for batch in batches:
            found = [look(p, n) for p, n in zip(batch["path"], batch["length"])]
            extra = pd.DataFrame(found, columns=added, index=batch.index, dtype=object)
            yield pd.concat([batch, extra], axis=1)

    # Rows this small would otherwise be merged into one task.
    listed = materialise(files)
    spread = listed.repartition(listed.count() // FILES_PER_TASK + 1, "path")
    return spread.mapInPandas(footers, f"{FILE_SCHEMA}, {FOOTER_SCHEMA}")


def participants(files: DataFrame) -> DataFrame:
    """Participant folders ``SP<number>``, one row each; others are left out."""
    number = F.regexp_extract("folder", names.FOLDER_NAME, 1)
    return (
        files.select("folder", F.nullif(number, F.lit("")).try_cast("bigint").alias("subject_id"))
        .where(F.col("subject_id").isNotNull())
        .distinct()
    )


def recordings(files: DataFrame) -> DataFrame:
    """Files named like a recording, with subject, signal and side from the name.

    ``misplaced`` marks a file whose own number differs from its folder's.
    """
    path = F.col("file_name")
    folder_number = F.nullif(F.regexp_extract("folder", names.FOLDER_NAME, 1), F.lit(""))
    subject = names.recording_part(path, 1)
    return (
        files.where(F.col("file_name").isNotNull() & names.is_recording(path))
        .withColumn("participant_id", names.participant(path))
        .withColumn("subject_id", subject.try_cast("bigint"))
        .withColumn("signal", names.recording_part(path, 2))
        .withColumn("side", names.recording_part(path, 3))
        .withColumn(
            "misplaced", ~F.col("subject_id").eqNullSafe(folder_number.try_cast("bigint"))
        )
    )


def paths_by_layout(checked: DataFrame, layout: Column) -> list[tuple[tuple, list[str]]]:
    """File paths grouped by their columns' names and types.

    Files written alike share a layout, so there are few. Paths have to come to the
    driver to be scanned: Spark's file index holds the same list there.
    """
    found: dict[tuple, list[str]] = {}
    for columns, path in checked.select(layout.alias("_layout"), "path").collect():
        found.setdefault(tuple((c["name"], c["type"]) for c in columns), []).append(path)
    return [(columns, sorted(paths)) for columns, paths in sorted(found.items())]


def scanned_path(uri: Column) -> Column:
    """The path of a scanned row (``_metadata.file_path``), as a listing spells it.

    Scans encode special characters but leave ``+`` alone.
    """
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
