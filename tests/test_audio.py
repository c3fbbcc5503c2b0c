"""Audio of many and of long recordings."""

import io
import wave

import numpy as np
from pyspark.sql import functions as F

from cueflow.functions import providers
from cueflow.sources import audio


def test_tones_of_one_partition_are_dealt_out(spark):
    made = audio.tones(spark.range(40, numPartitions=1).select(F.col("id").cast("string").alias("path"), (F.col("id") * 1700 + 1).alias("dur_ms")))
    found = made.select(F.col("path").cast("long").alias("id"), providers.wav_duration_ms("content").alias("ms"), F.octet_length("content").alias("n"), F.spark_partition_id().alias("part")).collect()
    assert sorted((r.id, r.ms, r.n) for r in found) == [(k, k * 1700 + 1, 44 + 32 * (k * 1700 + 1)) for k in range(40)]
    assert len({r.part for r in found}) > 4


def test_duration_needs_no_decoding(spark):
    file = io.BytesIO()
    with wave.open(file, "wb") as w:
        w.setnchannels(2), w.setsampwidth(3), w.setframerate(8_000)
        w.writeframes(bytes(6 * 4_010))
    rows = spark.createDataFrame([(file.getvalue(),), (None,), (file.getvalue()[: 44 + 6 * 800],)], "content binary")
    assert [r.ms for r in rows.select(providers.wav_duration_ms("content").alias("ms")).collect()] == [501, None, 100]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sequences_are_rendered_as_one_array_would_be():
    made = np.random.default_rng(5)
    clips = [made.uniform(-1, 1, n).astype(np.float32) for n in (800, 160, 1600, 0, 320, 4000, 16)]
    for overlaps in ([0, 5, 40, 3, 0, 200, 1], [0] * 7, [7, 1000, 1000, 1000, 1000, 1000, 1000]):
        assert bytes(providers.rendered(zip(clips, overlaps), max(overlaps))) == providers.wave_bytes(providers.overlaid(clips, overlaps))


def test_files_of_sequences_are_not_broadcast(spark):
    rows = spark.range(60).select((F.col("id") % 3).cast("string").alias("seq_id"), F.col("id").alias("pos"), F.col("id").cast("string").alias("path"), (100 + F.col("id")).alias("dur_ms"), (F.col("id") % 7).alias("overlap_ms"))
    out = audio.render_sequences(rows, audio.tones(rows))
    assert "BroadcastExchange" not in plan(out)
    clips = {k: [providers.peak_normalised(providers.wav_samples(audio.tone(100 + x))[0]) for x in range(k, 60, 3)] for k in range(3)}
    assert {r.seq_id: bytes(r.bytes) for r in out.collect()} == {str(k): providers.wave_bytes(providers.overlaid(own, [x % 7 for x in range(k, 60, 3)])) for k, own in clips.items()}


def test_more_audio_than_an_array_holds(spark):
    rows = spark.range(2300, numPartitions=1).select(F.col("id").cast("string").alias("track_id"), F.lit(30_000).alias("dur_ms"))
    recordings = audio.tones(rows.withColumnRenamed("track_id", "path")).withColumnRenamed("path", "track_id")
    assert recordings.agg(F.sum(F.octet_length("content"))).first()[0] == 2300 * (44 + 30_000 * 32)
    cuts = rows.filter("track_id < 40").select("track_id", F.lit(29_000).alias("seg_start"), F.lit(31_000).alias("seg_end"), F.concat("track_id", F.lit(".wav")).alias("path"))
    out = audio.segment_audio(cuts, recordings)
    assert "BroadcastExchange" not in plan(out)
    part = providers.wave_bytes(providers.peak_normalised(providers.wav_samples(audio.tone(30_000))[0])[29_000 * 16 :])
    assert {r.path: bytes(r.bytes) for r in out.collect()} == {f"{k}.wav": part for k in range(40)}
