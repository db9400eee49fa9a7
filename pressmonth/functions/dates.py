"""Month arithmetic: parsing, bounds, labels and sargable month filters."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH_PATTERN = r"^[0-9]{4}-(0[1-9]|1[0-2])$"

# Month names of the es-AR locale, in calendar order.
MONTH_NAMES = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio",
    "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)


def month_from_string(value: str | None) -> dt.date:
    """First day of a ``YYYY-MM`` parameter; raises ``ValueError`` for anything else."""
    trimmed = (value or "").strip()
    if not re.match(MONTH_PATTERN, trimmed):
        raise ValueError(f"expected YYYY-MM, got {value!r}")
    return dt.date.fromisoformat(trimmed + "-01")


def month_bounds(month: dt.date) -> tuple[dt.date, dt.date]:
    """Half-open range ``[first day, first day of the next month)``."""
    first = month.replace(day=1)
    return first, (first + dt.timedelta(days=32)).replace(day=1)


def parse_month(value: Column) -> Column:
    """Column form of :func:`month_from_string`; null where the text is not a month."""
    trimmed = F.regexp_replace(value, r"^\s+|\s+$", "")
    return F.when(trimmed.rlike(MONTH_PATTERN), F.to_date(F.concat(trimmed, F.lit("-01"))))


def month_start(timestamp: Column) -> Column:
    return F.trunc(timestamp, "MM")


def in_month(timestamp: Column, month: dt.date) -> Column:
    """Range predicate on the raw column, so that it reaches the Parquet row-group statistics."""
    start, end = (F.lit(dt.datetime.combine(d, dt.time())).cast("timestamp_ntz") for d in month_bounds(month))
    return (timestamp >= start) & (timestamp < end)


def since(timestamp: Column, now: dt.datetime, hours: int) -> Column:
    """``timestamp`` lies within the ``hours`` before ``now``."""
    return timestamp >= F.lit(now - dt.timedelta(hours=hours)).cast("timestamp_ntz")


def month_label(month: Column) -> Column:
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.concat(F.element_at(names, F.month(month)), F.lit(" de "), F.year(month).cast("string"))


def month_key(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")
