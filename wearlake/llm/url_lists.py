"""URL filters with dated lists.

List entries say from when a pattern is on or off a list; they become half-open
intervals. A capture is judged by the entries in force when it was fetched: its host,
each parent domain, and its host with each leading path are looked up by equality, the
time by the interval, to the microsecond; a day is its first moment. Captures of a busy host are split by Spark where the join is skewed.

Defined results: a capture without a readable host or without a time has no hits; an
entry with a null pattern, list or time is ignored; at one moment a removal wins over an
addition. Repeated captures get the same verdict each. Patterns match in lower case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.common import fresh

ADD, REMOVE = "add", "remove"


def validity(entries: DataFrame) -> DataFrame:
    """``pattern``, ``list``, ``since``, ``until`` (null: still) from dated entries.

    ``entries`` has ``pattern``, ``list``, ``action`` (add or remove) and ``dated``.
    """
    known = entries.where(
        F.col("pattern").isNotNull() & F.col("list").isNotNull() & F.col("dated").isNotNull()
        & F.col("action").isin(ADD, REMOVE)
    )
    states = known.groupBy(
        F.lower("pattern").alias("pattern"), "list", F.to_timestamp("dated").alias("since")
    ).agg(F.max("action").alias("action"))
    history = Window.partitionBy("pattern", "list").orderBy("since")
    return (
        states.withColumn("until", F.lead("since").over(history))
        .where(F.col("action") == ADD)
        .select("pattern", "list", "since", "until")
    )


def host(url: Column) -> Column:
    """The host of a URL in lower case, empty if there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def keys(url: Column) -> Column:
    """All patterns that cover a URL: parent domains, host, host with leading paths."""
    name = host(url)
    labels = F.split(name, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    path = F.lower(F.regexp_extract(url, r"^[^:]*://[^/?#]*/([^?#]*)", 1))
    steps = F.filter(F.split(path, "/"), lambda step: step != "")
    leading = F.when(
        F.size(steps) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(steps)),
            lambda i: F.concat(name, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(name != "", F.concat(domains, leading))


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with ``hits``, the ordered ``list:pattern`` in force, and ``blocked``."""
    address, moment, key, listed = fresh(captures, "_url", "_fetched", "_key", "_hits")
    visits = captures.select(F.col(url).alias(address), F.to_timestamp(fetched).alias(moment)).where(
        F.col(address).isNotNull() & F.col(moment).isNotNull()
    )
    wanted = visits.withColumn(key, F.explode(keys(F.col(address))))
    rules = validity(entries)
    during = (F.col(key) == F.col("pattern")) & (F.col(moment) >= F.col("since")) & (
        F.col("until").isNull() | (F.col(moment) < F.col("until"))
    )
    found = (
        wanted.join(rules, during)
        .select(address, moment, F.concat_ws(":", "list", "pattern").alias("_hit"))
        .groupBy(address, moment)
        .agg(F.sort_array(F.collect_set("_hit")).alias(listed))
    )
    same = (captures[url] == found[address]) & (F.to_timestamp(captures[fetched]) == found[moment])
    hits = F.coalesce(F.col(listed), F.array().cast("array<string>"))
    return captures.join(found, same, "left").withColumns(
        {"hits": hits, "blocked": F.size(hits) > 0}
    ).drop(address, moment, listed)
