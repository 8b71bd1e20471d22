"""Microsecond counts in larger units."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Microseconds per unit.
SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def whole_units(us: Column, unit: int) -> Column:
    """Completed units in a microsecond count."""
    return F.call_function("div", us, F.lit(unit).cast("bigint"))


def duration_parts(us: Column) -> list[Column]:
    """Days, hours, minutes and seconds that make up a microsecond count."""
    return [
        whole_units(us, DAY).alias("days"),
        whole_units(us % DAY, HOUR).alias("hours"),
        whole_units(us % HOUR, MINUTE).alias("minutes"),
        whole_units(us % MINUTE, SECOND).alias("seconds"),
    ]


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from one timestamp to a later one, free of time zones."""
    seconds = (end - start).cast("interval second").cast("decimal(20,6)")
    return (seconds * SECOND).cast("bigint")
