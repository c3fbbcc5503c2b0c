"""Times in milliseconds and seconds, and their texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cueflow.functions import fixed


def parse_time(text: Column) -> Column:
    """Milliseconds of ``HH:MM:SS,mmm`` or ``HH:MM:SS.mmm``; digits after the mark are a whole number; null if it isn't such a time."""
    part = lambda k: F.regexp_extract(text, "^\\s*(\\d+):(\\d+):(\\d+)[,.](\\d+)\\s*$", k).try_cast("long")
    return ((part(1) * 60 + part(2)) * 60 + part(3)) * 1000 + part(4)


def time_token(time_ms: Column, segment_start: Column, resolution: int = fixed.RESOLUTION_MS) -> Column:
    """``<|s.ss|>`` of a time within a segment, to the nearest step (halves to even); null outside."""
    after = time_ms - segment_start
    steps = F.bround(after / F.lit(float(resolution)), 0)
    return F.when(after.between(0, fixed.SEGMENT_MS), F.format_string("<|%.2f|>", (steps * resolution / F.lit(1000.0)).cast("double")))


def srt_time(seconds: Column) -> Column:
    """``HH:MM:SS.mmm`` of seconds, cut to milliseconds; days wrap around, also below zero."""
    micros = F.pmod(F.bround(seconds * 1_000_000, 0).cast("long"), F.lit(86_400_000_000))
    unit = lambda size, most: (F.floor(micros / F.lit(size)) % most).cast("long")
    return F.format_string("%02d:%02d:%02d.%03d", unit(3_600_000_000, 24), unit(60_000_000, 60), unit(1_000_000, 60), unit(1_000, 1000))
