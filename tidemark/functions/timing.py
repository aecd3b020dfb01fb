"""Two notions of a day difference; the layers of the product use different ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_24h(later: Column, earlier: Column) -> Column:
    """Whole periods of 24 hours between two timestamps, rounded down (negative ones too)."""
    seconds = F.unix_timestamp(later) - F.unix_timestamp(earlier)
    return ((seconds - F.pmod(seconds, F.lit(86400))) / 86400).cast("int")


def days_calendar(later: Column, earlier: Column) -> Column:
    """Midnights between two timestamps."""
    return F.datediff(later, earlier)
