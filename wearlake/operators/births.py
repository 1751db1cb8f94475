"""Birth dates inferred from visits, and how well they fit the visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlake.functions.months import completed_months
from wearlake.operators.keyed import attach, broadcastable

# fixed values: tolerated and doubtful deviation in months, share that must fit
TOLERATED_MONTHS = 1
DOUBTFUL_MONTHS = 2
REQUIRED_RATE = 0.8


def _usable(visits: DataFrame) -> DataFrame:
    return visits.where(
        F.col("interview_date").isNotNull() & F.col("interview_age").isNotNull()
    )


def birth_dates(visits: DataFrame, subject: str = "src_subject_id") -> DataFrame:
    """One ``birth_date`` per subject: the upper median of its visits' estimates.

    A visit's estimate is its date less the reported age. Equal estimates are counted
    before anything is ordered, so a subject with very many visits brings no more
    rows to its window than there are calendar dates.
    """
    estimates = (
        _usable(visits)
        .withColumn("_born", F.add_months("interview_date", -F.col("interview_age")))
        .groupBy(subject, "_born")
        .agg(F.count(F.lit(1)).alias("_visits"))
    )
    per_subject = Window.partitionBy(subject)
    upto = per_subject.orderBy("_born").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.floor(F.sum("_visits").over(per_subject) / 2)
    return (
        estimates.withColumn("_upto", F.sum("_visits").over(upto))
        .withColumn("_middle", middle)
        .where(F.col("_upto") > F.col("_middle"))
        .groupBy(subject)
        .agg(F.min("_born").alias("birth_date"))
    )


def visit_deviations(visits: DataFrame, subject: str = "src_subject_id") -> DataFrame:
    """Each visit with its recomputed age, the deviation in months and a grade."""
    births = birth_dates(visits, subject)
    small = broadcastable(visits, [subject])
    recomputed = completed_months(F.col("birth_date"), F.col("interview_date"))
    deviation = F.abs(recomputed - F.col("interview_age"))
    grade = (
        F.when(F.col("deviation") <= TOLERATED_MONTHS, "ok")
        .when(F.col("deviation") <= DOUBTFUL_MONTHS, "warn")
        .when(F.col("deviation").isNotNull(), "bad")
    )
    return (
        attach(visits, births, [subject], visits.columns, small)
        .withColumn("calculated_age", recomputed)
        .withColumn("deviation", deviation)
        .withColumn("grade", grade)
    )


def birth_date_quality(deviations: DataFrame, subject: str = "src_subject_id") -> DataFrame:
    """Verdict per subject. A failed verdict leaves the birth date as it is."""
    fits = F.count_if(F.col("deviation") <= TOLERATED_MONTHS)
    used = F.count("deviation")
    return deviations.groupBy(subject).agg(
        F.max("birth_date").alias("birth_date"),
        used.alias("n_visits"),
        F.count_if(F.col("interview_date").isNull() | F.col("interview_age").isNull()).alias(
            "n_unusable"
        ),
        F.max("deviation").alias("max_deviation"),
        F.avg("deviation").alias("avg_deviation"),
        fits.alias("n_within"),
        F.try_divide(fits, used).alias("acceptance_rate"),
        F.coalesce(F.try_divide(fits, used) >= REQUIRED_RATE, F.lit(False)).alias("passed"),
    )


def visit_report(deviations: DataFrame, subject: str = "src_subject_id") -> DataFrame:
    """Visits in report order: by subject, then by date.

    The other columns break ties, so that equal dates can spread over tasks.
    """
    first = [subject, "interview_date"]
    return deviations.orderBy(*first, *(c for c in deviations.columns if c not in first))
