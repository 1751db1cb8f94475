"""Time-zone fields.

Spark has no expression that gives a zone's abbreviation, and its zone functions
fail on an unknown name. These two therefore are vectorised Python functions. Use
them on the series summary (one row per recording), never on the samples.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: whole-hour offsets outside these bounds stay blank
OFFSET_BOUNDS = (-11, 12)


def _as_utc(as_of: datetime | None) -> datetime:
    if as_of is None:
        return datetime.now(timezone.utc)
    return as_of.replace(tzinfo=timezone.utc) if as_of.tzinfo is None else as_of


def zone_fields(zone: Column, as_of: datetime | None = None) -> Column:
    """Struct of ``abbreviation`` and ``utc_offset`` at ``as_of`` (default: now).

    An empty zone gives blanks; an unknown one gives its own text and no offset. The
    offset is in whole hours, cut towards zero, and null outside the bounds.
    """
    moment = _as_utc(as_of)
    lowest, highest = OFFSET_BOUNDS

    @F.pandas_udf("abbreviation string, utc_offset int")
    def resolve(zones):
        import zoneinfo

        import pandas as pd

        spelled = {name.lower(): name for name in zoneinfo.available_timezones()}

        def fields(name):
            if name is None or name == "":
                return None, None
            known = spelled.get(name.lower())
            if known is None:
                return name, None
            local = moment.astimezone(zoneinfo.ZoneInfo(known))
            hours = int(local.utcoffset().total_seconds() / 3600)
            return local.strftime("%Z"), hours if lowest <= hours <= highest else None

        found = {name: fields(name) for name in zones.unique()}
        return pd.DataFrame(
            {
                "abbreviation": [found[name][0] for name in zones],
                "utc_offset": pd.array([found[name][1] for name in zones], dtype="Int32"),
            }
        )

    return resolve(zone)
