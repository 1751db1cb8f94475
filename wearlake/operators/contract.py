"""Conformance to an archive layout and to a data dictionary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearlake.functions.fields import DATE_FORMAT
from wearlake.operators.keyed import BROADCAST_SERIES, join_on, materialise
from wearlake.schema import DICTIONARY, DICTIONARY_TYPES

# First bad rows that are looked up by a filter; more of them by a join.
FEW_PLACES = 10_000


@dataclass(frozen=True)
class Element:
    """One dictionary entry."""

    name: str
    type: str
    size: int | None = None
    allowed: str | None = None
    required: bool = False


STANDARD = tuple(Element(*entry) for entry in DICTIONARY)


def read_dictionary(spark: SparkSession, path: str) -> list[Element]:
    """Dictionary file: one row per output column, so it fits the driver."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    blank = lambda name: F.nullif(F.trim(F.col(name)), F.lit(""))
    required = F.col("Required") == "Required" if "Required" in raw.columns else F.lit(False)
    listed = raw.select(
        F.trim("ElementName").alias("name"), F.trim("DataType").alias("type"),
        blank("Size").try_cast("int").alias("size"), blank("ValueRange").alias("allowed"),
        F.coalesce(required, F.lit(False)).alias("required"),
    )
    return [Element(**row.asDict()) for row in listed.collect()]


def conform(
    rows: DataFrame, columns: Sequence[str], dictionary: Sequence[Element] = STANDARD
) -> DataFrame:
    """Exactly ``columns`` in that order; a column that is missing becomes typed null."""
    types = {e.name: DICTIONARY_TYPES[e.type] for e in dictionary}
    return rows.select(
        *(
            F.col(name) if name in rows.columns
            else F.lit(None).cast(types.get(name, "string")).alias(name)
            for name in columns
        )
    )


def layout_differences(present: Sequence[str], columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns a layout asks for that are missing, and those it does not know."""
    return {
        "missing": [name for name in columns if name not in present],
        "extra": [name for name in present if name not in columns],
    }


def _allowed(text: Column, rule: str) -> tuple[str, Column]:
    """Kind of a value rule and the condition that a value breaks it."""
    if "::" in rule:
        low, high = (float(bound) for bound in rule.split("::"))
        number = text.try_cast("double")
        return "range", number.isNotNull() & ~number.between(low, high)
    if rule.endswith("*"):
        return "prefix", ~text.startswith(rule[:-1])
    choices = [choice.strip() for choice in rule.split(";")]
    return "choice", ~text.isin(*choices)


def _wrong_type(text: Column, wanted: str, stored: T.DataType) -> Column:
    """Condition that a value is not of the wanted type; constant if its column is."""
    whole = isinstance(stored, T.IntegralType)
    if wanted == "Integer":
        return F.lit(False) if whole else text.try_cast("bigint").isNull()
    if wanted == "Float":
        number = whole or isinstance(stored, T.FractionalType)
        return F.lit(False) if number else text.try_cast("double").isNull()
    dated = isinstance(stored, T.DateType)
    return F.lit(False) if dated else F.try_to_date(text, DATE_FORMAT).isNull()


def broken_rules(element: Element, stored: T.DataType) -> list[tuple[str, Column]]:
    """Conditions under which a value breaks one of the element's rules.

    A null breaks only the rule that a value is required. ``stored`` is the type of
    the column the values are in.
    """
    text = F.col(element.name).cast("string")
    rules = []
    if element.type in ("Integer", "Float", "Date"):
        rules.append(("type", _wrong_type(text, element.type, stored)))
    if element.size is not None:
        rules.append(("size", F.length(text) > element.size))
    if element.allowed is not None:
        rules.append(_allowed(text, element.allowed))
    found = [(kind, text.isNotNull() & broken) for kind, broken in rules]
    if element.required:
        found.append(("required", text.isNull()))
    return found


def validate(
    rows: DataFrame,
    keys: Sequence[str],
    order: str = "row_index",
    dictionary: Sequence[Element] = STANDARD,
) -> DataFrame:
    """Broken rows per series, column and rule, with the first of them and its value.

    All rules are one hash aggregation over one scan: it holds numbers only, the place
    of the first bad row among them. That small result is frozen, then the values at
    those places are looked up in ``rows`` again. Up to ``FEW_PLACES`` of them are a
    filter on the row order that reaches the scan; no copy of the rows is made.
    """
    keys = list(keys)
    present = [element for element in dictionary if element.name in rows.columns]
    rules = [
        (element.name, kind, broken)
        for element in present
        for kind, broken in broken_rules(element, rows.schema[element.name].dataType)
    ]
    # Each rule is worked out once per row, then only its flag is aggregated.
    flagged = rows.select(*keys, order, *(b.alias(f"_{i}") for i, (_, _, b) in enumerate(rules)))
    findings = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("rule"),
            F.count_if(F.col(f"_{i}")).alias("bad_rows"),
            F.min(F.when(F.col(f"_{i}"), F.col(order))).alias("first_bad_row"),
        )
        for i, (name, kind, _) in enumerate(rules)
    ]
    wide = flagged.groupBy(*keys).agg(F.array(*findings).alias("_findings"))
    tall = materialise(wide.select(*keys, F.inline("_findings")))
    places = (
        tall.where(F.col("first_bad_row").isNotNull())
        .select(*keys, F.col("first_bad_row").alias(order))
        .distinct()
    )
    small = tall.count() <= BROADCAST_SERIES
    first = [r[0] for r in places.select(order).distinct().limit(FEW_PLACES + 1).collect()]
    if len(first) <= FEW_PLACES:
        rows = rows.where(F.col(order).isin(first))
    values = F.array(
        *(
            F.struct(
                F.lit(element.name).alias("column"),
                F.col(element.name).cast("string").alias("sample"),
            )
            for element in present
        )
    )
    samples = join_on(rows, places, [*keys, order], small=small).select(
        *keys, F.col(order).alias("first_bad_row"), F.inline(values)
    )
    found = join_on(tall, samples, [*keys, "first_bad_row", "column"], "left", small=small)
    return found.select(
        *keys, "column", "rule", "bad_rows", "first_bad_row", "sample"
    )
