"""Intervals of a track that must not be used, and the spans between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_intervals(intervals: DataFrame) -> DataFrame:
    """Intervals (track_id, start_ms, end_ms) as few: those that touch or overlap become one; empty and inverted ones go."""
    w = Window.partitionBy("track_id").orderBy("start_ms", "end_ms")
    reached = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    kept = intervals.filter("start_ms IS NOT NULL AND end_ms > start_ms").select("track_id", "start_ms", "end_ms", reached.alias("reached"))
    island = F.sum(F.when(F.col("start_ms") <= F.col("reached"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return kept.withColumn("island", island).groupBy("track_id", "island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")).drop("island")


def safe_spans(tracks: DataFrame, intervals: DataFrame) -> DataFrame:
    """Spans (track_id, span_idx, span_start, span_end) of tracks (track_id, audio_ms) outside all intervals; a track without any is one span."""
    blocked = merge_intervals(intervals).select("track_id", "start_ms", "end_ms")
    tail = tracks.select("track_id", F.col("audio_ms").alias("start_ms"), F.col("audio_ms").alias("end_ms"), F.lit(1).alias("tail"))
    marks = blocked.withColumn("tail", F.lit(0)).unionByName(tail).join(tracks, "track_id")
    w = Window.partitionBy("track_id").orderBy("tail", "start_ms")
    start = F.least(F.greatest(F.lag("end_ms", 1, 0).over(w), F.lit(0)), F.col("audio_ms"))
    spans = marks.select("track_id", start.cast("long").alias("span_start"), F.least(F.greatest("start_ms", F.lit(0)), "audio_ms").cast("long").alias("span_end")).filter("span_end > span_start")
    return spans.select("track_id", (F.row_number().over(Window.partitionBy("track_id").orderBy("span_start")) - 1).cast("long").alias("span_idx"), "span_start", "span_end")


def contained_cues(cues: DataFrame, spans: DataFrame) -> DataFrame:
    """Cues that lie within a span of their track, with its span_idx and bounds."""
    inside = (F.col("start_ms") >= F.col("span_start")) & (F.col("end_ms") <= F.col("span_end")) & (F.col("end_ms") > F.col("span_start")) & (F.col("start_ms") < F.col("span_end"))
    return cues.join(spans, "track_id").filter(inside)
