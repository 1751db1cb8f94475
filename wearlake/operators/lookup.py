"""Subject metadata, one row per subject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_subject(
    metadata: DataFrame,
    order: str,
    subject: str = "src_subject_id",
    keep: Sequence[str] = ("subjectkey", "sex"),
) -> DataFrame:
    """The first row in file order for each subject; ``order`` is the file order."""
    first = F.min(F.struct(order, *keep))
    return (
        metadata.where(F.col(subject).isNotNull())
        .groupBy(F.col(subject).alias("subject_id"))
        .agg(first.alias("_first"))
        .select("subject_id", *(F.col(f"_first.{name}").alias(name) for name in keep))
    )
