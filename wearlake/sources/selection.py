"""Which participants to work on, and whether their recordings are complete."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.operators.keyed import positions
from wearlake.schema import SIGNALS


def parse_selection(spec: str) -> list[tuple[int, int]] | None:
    """Inclusive ranges named by a selection text; None means all participants.

    ``-1`` or ``all``, single numbers, ranges ``3-7`` and comma-separated mixes. Any
    part that is neither rejects the whole text.
    """
    text = spec.strip()
    if text.lower() in ("-1", "all"):
        return None
    ranges = []
    for part in text.split(","):
        match = re.fullmatch(r"\s*(\d+)\s*(?:-\s*(\d+)\s*)?", part)
        if not match:
            raise ValueError(f"invalid selection part {part.strip()!r}")
        first = int(match[1])
        ranges.append((first, int(match[2]) if match[2] else first))
    return ranges


def numbered(participants: DataFrame, subject: str = "subject_id") -> DataFrame:
    """Participants with ``ordinal``, their 1-based place in numeric order."""
    placed = positions(participants, [], subject, "ordinal")
    return placed.withColumn("ordinal", F.col("ordinal") + 1)


def select_participants(
    participants: DataFrame, spec: str, by: str = "ordinal", subject: str = "subject_id"
) -> DataFrame:
    """Participants a selection text names, by place in the list or by own number.

    Raises ValueError for a malformed text, a place outside the list or an empty
    selection.
    """
    ranges = parse_selection(spec)
    placed = numbered(participants, subject)
    if ranges is None:
        return placed
    if by == "ordinal":
        count = participants.count()
        for first, last in ranges:
            if not (1 <= first <= count and 1 <= last <= count):
                raise ValueError(f"selection {first}-{last} is outside 1-{count}")
    ranges = [(first, last) for first, last in ranges if first <= last]
    if not ranges:
        raise ValueError("selection names no participant")
    column = F.col("ordinal" if by == "ordinal" else subject)
    chosen = F.lit(False)
    for first, last in ranges:
        chosen = chosen | column.between(first, last)
    return placed.where(chosen)


def completeness(
    recordings: DataFrame, folders: DataFrame, key: str = "folder", required: str = "any_side"
) -> DataFrame:
    """Per folder: signals seen, signals missing, and whether all are there.

    ``any_side`` accepts either wrist for a signal; ``left`` needs the left one.
    """
    kept = recordings if required == "any_side" else recordings.where(F.col("side") == required)
    # One flag per signal: nothing grows with the number of files of a folder.
    seen = kept.groupBy(key).agg(
        *(F.max(F.col("signal") == name).alias(f"_{name}") for name in SIGNALS)
    )
    flags = [F.coalesce(F.col(f"_{name}"), F.lit(False)) for name in SIGNALS]
    pick = lambda wanted: F.array_compact(
        F.array(*(F.when(flag if wanted else ~flag, F.lit(n)) for n, flag in zip(SIGNALS, flags)))
    )
    return (
        folders.join(seen, key, "left")
        .withColumn("seen", pick(True))
        .withColumn("missing", pick(False))
        .withColumn("complete", F.size("missing") == 0)
        .drop(*(f"_{name}" for name in SIGNALS))
    )
