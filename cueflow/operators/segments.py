"""Cutting tracks into records of at most 30 seconds.

Where segments begin and end depends on cue times and validity alone, and is one recurrence a span; everything else about
records, their texts, token counts and prompts, is joins and windows over its result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cueflow.functions import fixed
from cueflow.functions.providers import token_count
from cueflow.functions.text import leading_space
from cueflow.functions.times import time_token
from cueflow.operators.cues import streamed

SEGMENT = pa.schema([("track_id", pa.string()), *((n, pa.int64()) for n in ("span_idx", "seg_idx", "seg_start", "seg_end", "first_pos", "last_pos")), ("valid", pa.bool_()), ("prompt_group", pa.int64())])


def boundaries(starts: list[int], ends: list[int], texts: list[str], begin: int, stop: int, cut_initial: bool = False, threshold: int = fixed.REPEAT_THRESHOLD) -> Iterator[tuple]:
    """(seg_start, seg_end, first, last, valid, prompt_group) of one span's cues in start order; ``last`` is before ``first`` in silence."""
    at = max(begin, starts[0] - 1000) if cut_initial else begin
    i, n, group = 0, len(starts), 0
    while i < n and at < (end := min(at + fixed.SEGMENT_MS, stop)):
        if starts[i] < end and ends[i] - starts[i] > fixed.SEGMENT_MS:
            at, i = ends[i], i + 1
            continue
        first, equal, valid = i, 1, True
        while i < n and starts[i] < end:
            valid &= at <= starts[i] <= ends[i]
            if i > first:
                equal = equal + 1 if texts[i] == texts[i - 1] else 1
                valid &= ends[i - 1] <= starts[i] and equal < threshold
            i += 1
        yield at, end, first, i - 1, valid, group
        if not valid:
            at, group = max(end, ends[i - 1]), group + 1
        elif i == first:
            at += fixed.SEGMENT_MS
        elif ends[i - 1] <= end:
            at = ends[i - 1]
        else:
            i -= 1
            at = starts[i]


def positioned(cues: DataFrame) -> DataFrame:
    """Cues within spans, with their position in start order."""
    w = Window.partitionBy("track_id", "span_idx").orderBy("start_ms", "cue_idx")
    return cues.filter("start_ms IS NOT NULL AND end_ms IS NOT NULL").withColumn("pos", (F.row_number().over(w) - 1).cast("long"))


def segment_boundaries(cues: DataFrame, cut_initial: bool = False) -> DataFrame:
    """Segments of positioned cues.  Cues stream through sorted by span, one span in memory at a time."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for (track, span, begin, stop), (_, *columns) in streamed(batches, 4):
            found += [(track, span, k, *x) for k, x in enumerate(boundaries(*columns, begin, stop, cut_initial and span == 0))]
            if len(found) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), SEGMENT.types)], schema=SEGMENT)
                found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), SEGMENT.types)], schema=SEGMENT)

    own = cues.select("track_id", "span_idx", "span_start", "span_end", "pos", "start_ms", "end_ms", "text")
    schema = "track_id string, span_idx long, seg_idx long, seg_start long, seg_end long, first_pos long, last_pos long, valid boolean, prompt_group long"
    return own.repartition("track_id").sortWithinPartitions("track_id", "span_idx", "pos").mapInArrow(cut, schema)


def segment_nodes(cues: DataFrame, segments: DataFrame) -> DataFrame:
    """One row for each cue of each valid segment: its text with time tokens, and token count.  A cue that ends later has only its start."""
    key = ["track_id", "span_idx"]
    each = segments.filter("valid").withColumn("pos", F.explode(F.expr("CASE WHEN last_pos >= first_pos THEN sequence(first_pos, last_pos) END")))
    joined = each.join(cues.select(*key, "pos", "start_ms", "end_ms", "text", "language"), [*key, "pos"])
    whole = F.col("end_ms") <= F.col("seg_end")
    start, end = time_token(F.col("start_ms"), F.col("seg_start")), time_token(F.col("end_ms"), F.col("seg_start"))
    text = F.when(whole, F.concat(start, leading_space(F.col("text"), F.col("language")), end)).otherwise(start)
    n = F.when(whole, token_count(F.col("text")) + 2).otherwise(1).cast("long")
    return joined.select(*key, "seg_idx", "prompt_group", "pos", text.alias("node_text"), n.alias("n_tokens"))


def prompts(nodes: DataFrame, limit: int = fixed.MAX_PROMPT_TOKENS) -> DataFrame:
    """(track_id, span_idx, seg_idx, prompt) at the last node of each segment: the texts up to it, back to the one that reaches the limit.

    Every node has a token, so the running count orders nodes, and a range of it is the prompt.
    """
    group = Window.partitionBy("track_id", "span_idx", "prompt_group")
    count = F.sum("n_tokens").over(group.orderBy("seg_idx", "pos").rowsBetween(Window.unboundedPreceding, 0))
    last = F.row_number().over(Window.partitionBy("track_id", "span_idx", "seg_idx").orderBy(F.desc("pos"))) == 1
    run = nodes.withColumn("reached", count).withColumn("last", last)
    parts = F.collect_list("node_text").over(group.orderBy("reached").rangeBetween(-(limit - 1), 0))
    return run.withColumn("parts", parts).filter("last").select("track_id", "span_idx", "seg_idx", F.array_join("parts", "").alias("so_far"))


def segment_records(cues: DataFrame, segments: DataFrame) -> DataFrame:
    """Records of valid segments: text, tokens and prompt; those with too many tokens have ``within`` false.

    ``cues`` have pos, span_idx and language.  All windows and joins share the key (track_id, span_idx).
    """
    nodes = segment_nodes(cues, segments)
    key = ["track_id", "span_idx", "seg_idx"]
    parts = F.array_sort(F.collect_list(F.struct("pos", "node_text")))
    texts = nodes.groupBy(*key).agg(F.array_join(F.transform(parts, lambda x: x["node_text"]), "").alias("text"), F.sum("n_tokens").alias("tokens"))
    valid = segments.filter("valid").join(texts, key, "left").join(prompts(nodes), key, "left")
    before = Window.partitionBy("track_id", "span_idx", "prompt_group").orderBy("seg_idx").rowsBetween(Window.unboundedPreceding, -1)
    return valid.select(
        *key, "seg_start", "seg_end", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"),
        F.coalesce(F.last("so_far", ignorenulls=True).over(before), F.lit("")).alias("prompt"),
    ).withColumn("within", F.col("tokens") <= fixed.MAX_RECORD_TOKENS)


def cut_list(segments: DataFrame, rate: int = fixed.SAMPLE_RATE) -> DataFrame:
    """What to cut from the audio: every segment, valid or not, with its samples."""
    per_ms = rate // 1000
    return segments.select("track_id", "seg_start", "seg_end", (F.col("seg_start") * per_ms).alias("start_sample"), (F.least(F.col("seg_end") * per_ms, F.col("seg_start") * per_ms + fixed.SEGMENT_MS * per_ms)).alias("end_sample"))
