"""Dates and times as Columns: ISO text, the folder of a day, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso(when: Column) -> Column:
    """A time as ISO text with seconds."""
    return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss")


def day_folder(when: Column) -> Column:
    """Year/month/day, as archives are laid out."""
    return F.date_format(when, "yyyy/MM/dd")


def duration(seconds: Column) -> Column:
    """Whole seconds as HH:MM:SS, hours without end; negative ones count as none."""
    s = F.greatest(F.floor(seconds), F.lit(0)).cast("bigint")
    hours = F.floor(s / 3600).cast("string")
    wide = F.when(F.length(hours) < 2, F.lpad(hours, 2, "0")).otherwise(hours)
    part = lambda x: F.lpad(x.cast("bigint").cast("string"), 2, "0")
    return F.concat_ws(":", wide, part(F.floor(s / 60) % 60), part(s % 60))
