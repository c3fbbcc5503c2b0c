"""Assembling long sequences from sentence clips.

The random choices are hashes of a seed and a key, in integer arithmetic that any SQL engine can repeat, so results don't depend on partitions or reruns.
Speakers are kept by runs: each speaker's clips, in hash order, are cut into runs whose lengths are geometric in the chance to go on, and runs
are put in hash order.  Every clip is used once and a speaker's order is kept, as in a chain of picks, without its one-at-a-time walk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueflow.operators.cues import repair_overlaps
from cueflow.functions.times import srt_time

_MODULUS = 2_147_483_647


def draw(key: Column, seed: int) -> Column:
    """A whole number in [0, 1,000,000) by two steps of a linear congruence."""
    first = F.pmod((F.pmod(key, F.lit(_MODULUS)) + seed) * 48_271 + 11, F.lit(_MODULUS))
    return F.pmod(F.pmod(first * 69_621 + 7, F.lit(_MODULUS)), F.lit(1_000_000))


def exact_sample(rows: DataFrame, key: str, per_mille: int, seed: int = 1, partitions: str | None = None) -> DataFrame:
    """``per_mille`` thousandths of the rows, to the nearest whole, by hash order; within each value of ``partitions`` if given.

    The draw up to which rows are taken comes from the counts of the million draws there are, and only the rows of
    that one draw are ranked, so no window holds all rows of a value.
    """
    own = rows.withColumn("_draw", draw(F.col(key), seed)).withColumn("_of", F.col(partitions) if partitions else F.lit(0))
    by = Window.partitionBy("_of")
    counts = own.groupBy("_of", "_draw").agg(F.count("*").alias("n")).withColumn("_total", F.sum("n").over(by.orderBy("_draw")))
    counts = counts.withColumn("_wanted", F.sum("n").over(by) * per_mille + 500)
    within = F.col("_total") * 1000 <= F.col("_wanted")
    cuts = counts.groupBy("_of").agg(F.min(F.when(~within, F.col("_draw"))).alias("_cut"), F.coalesce(F.max(F.when(within, F.col("_total"))), F.lit(0)).alias("_taken"), F.max("_wanted").alias("_wanted"))
    cuts = cuts.withColumnRenamed("_of", "_value")
    placed = own.join(cuts, own["_of"].eqNullSafe(cuts["_value"])).drop("_value")
    sure = placed.filter(F.col("_cut").isNull() | (F.col("_draw") < F.col("_cut")))
    border = placed.filter(F.col("_draw") == F.col("_cut")).withColumn("_nth", F.row_number().over(Window.partitionBy("_of").orderBy(key)))
    few = border.filter((F.col("_nth") + F.col("_taken")) * 1000 <= F.col("_wanted")).drop("_nth")
    return sure.unionByName(few).select(*rows.columns)


def speaker_runs(clips: DataFrame, keep_per_million: int, seed: int = 42, shards: int = 256) -> DataFrame:
    """Adds nth (within the speaker), run and run_key.  Clips without a speaker belong to speaker "0".

    A speaker's clips are counted by ranges of their draw, so no window holds all clips of one, such as of those without; the ranges' sums give where each begins.
    """
    place = draw(F.col("clip_id"), seed)
    own = clips.withColumn("client_id", F.coalesce(F.nullif(F.col("client_id"), F.lit("")), F.lit("0"))).withColumn("_place", place)
    own = own.withColumn("_shard", F.floor(F.col("_place") * shards / 1_000_000)).withColumn("_breaks", (draw(F.col("clip_id"), seed + 1) >= keep_per_million).cast("long"))
    sums = own.groupBy("client_id", "_shard").agg(F.count("*").alias("n"), F.sum("_breaks").alias("b"), F.min_by("_breaks", F.struct("_place", "clip_id")).alias("lead"))
    by = Window.partitionBy("client_id").orderBy("_shard")
    before = lambda c: F.coalesce(F.sum(c).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a speaker's first clip begins no new run
    starts = sums.select("client_id", "_shard", before("n").alias("_n"), (before("b") - F.first("lead").over(by)).alias("_b"))
    within = Window.partitionBy("client_id", "_shard").orderBy("_place", "clip_id")
    ends = own.withColumn("nth", F.row_number().over(within)).withColumn("run", F.sum("_breaks").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.join(starts, ["client_id", "_shard"]).withColumn("nth", (F.col("nth") + F.col("_n")).cast("long")).withColumn("run", (F.col("run") + F.col("_b")).cast("long"))
    first = F.min("clip_id").over(Window.partitionBy("client_id", "run"))
    return ends.select(*clips.columns, "nth", "run").withColumn("run_key", draw(first, seed + 2)).withColumn("run_first", first)


def chunk_sequences(runs: DataFrame, per_sequence: int, shards: int = 1000) -> DataFrame:
    """Adds seq_id and pos: runs in hash order, ``per_sequence`` clips each; only the last sequence of all is short.

    Runs are dealt to shards by ranges of their key, so no window holds all clips; a clip's place is its place in the shard after the clips of the shards before,
    whose counts, a row a shard, are broadcast.  The number of shards changes no result.
    """
    own = runs.withColumn("_shard", F.floor(F.col("run_key") * shards / 1_000_000))
    counts = own.groupBy("_shard").agg(F.count("*").alias("n"))
    before = counts.select("_shard", F.coalesce(F.sum("n").over(Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_shard").orderBy("run_key", "run_first", "client_id", "nth")
    placed = own.withColumn("_place", F.row_number().over(w) - 1).join(F.broadcast(before), "_shard").withColumn("_place", F.col("_place") + F.col("_before"))
    seq = F.floor(F.col("_place") / per_sequence).cast("string")
    return placed.withColumn("seq_id", seq).withColumn("pos", F.pmod("_place", F.lit(per_sequence)).cast("long")).drop("_shard", "_place", "_before", "run_key", "run_first")


def draw_overlaps(sequences: DataFrame, chance: int, most_chance: int, most_ms: int, seed: int = 7) -> DataFrame:
    """Adds overlap_ms: with ``chance`` (per million) a clip starts within the last one's, by up to the silence between them and ``most_ms``."""
    w = Window.partitionBy("seq_id").orderBy("pos")
    room = F.lag(F.col("dur_ms") - F.col("vad_end_ms")).over(w) + F.col("vad_start_ms") + most_ms
    part = F.when(draw(F.col("clip_id"), seed + 1) < most_chance, room).otherwise(F.floor(room * draw(F.col("clip_id"), seed + 2) / 1_000_000))
    return sequences.withColumn("overlap_ms", F.when((F.col("pos") > 0) & (draw(F.col("clip_id"), seed) < chance), part).otherwise(0).cast("long"))


def fused_offsets(sequences: DataFrame) -> DataFrame:
    """Adds start_ms and end_ms of each clip's speech in its sequence, and offset_ms, where the clip would begin without overlap."""
    w = Window.partitionBy("seq_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("dur_ms") - F.col("overlap_ms")).over(w), F.lit(0)).cast("long")
    moved = sequences.withColumn("offset_ms", offset)
    shift = F.col("offset_ms") - F.col("overlap_ms")
    end = F.when(F.col("vad_end_ms") > 0, F.col("vad_end_ms")).otherwise(F.col("dur_ms"))  # no speech found: the whole clip
    return moved.withColumn("start_ms", F.col("vad_start_ms") + shift).withColumn("end_ms", end + shift)


def srt_texts(captions: DataFrame) -> DataFrame:
    """(seq_id, srt): numbered captions with overlaps repaired."""
    fixed = repair_overlaps(captions)
    number = F.row_number().over(Window.partitionBy("seq_id").orderBy("pos"))
    block = F.format_string("%d\n%s --> %s\n%s\n", number, srt_time(F.col("start_s")), srt_time(F.col("end_s")), F.col("text"))
    blocks = fixed.select("seq_id", "pos", block.alias("block")).groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct("pos", "block"))).alias("all"))
    return blocks.select("seq_id", F.array_join(F.transform("all", lambda x: x["block"]), "\n").alias("srt"))


def subsample_silence(records: DataFrame, every: int, order: list[str]) -> DataFrame:
    """All records with text, and every k-th without, counted within a track."""
    nth = F.row_number().over(Window.partitionBy("track_id", F.col("text") == "").orderBy(*order))
    return records.withColumn("_nth", nth).filter((F.col("text") != "") | (F.pmod(F.col("_nth") - 1, F.lit(every)) == 0)).drop("_nth")
