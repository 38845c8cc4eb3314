"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO date with optional time of day and offset, in the long and the short form.
ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
SHORT = r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})?(Z|[+-]\d{2}:?\d{2})?)?$"

# Weekday names in calendar order.
WEEKDAYS = (
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
)


def parse_iso(text: Column) -> Column:
    """Written local time (the offset is dropped), or null for anything that is no
    ISO time."""
    local = F.regexp_replace(text, r"(Z|[+-]\d{2}:\d{2})$", "")
    part = lambda i, rest: F.coalesce(F.nullif(F.regexp_extract(text, SHORT, i), F.lit("")), F.lit(rest))
    short = F.concat(
        part(1, ""), F.lit("-"), part(2, ""), F.lit("-"), part(3, ""), F.lit("T"),
        part(4, "00"), F.lit(":"), part(5, "00"), F.lit(":"), part(6, "00"),
    )
    return F.when(text.rlike(ISO), local.try_cast("timestamp_ntz")).when(
        text.rlike(SHORT), short.try_cast("timestamp_ntz")
    )
