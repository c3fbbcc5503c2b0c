"""Audio in and out: parts of recordings, rendered sequences, and files of bytes.

Only PCM wave files are read and written, as nothing else can be decoded offline.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueflow.functions import fixed
from cueflow.functions.providers import peak_normalised, peak_scale, pcm16, rendered, resampled, wav_samples, wave_bytes, wave_header
from cueflow.sources.subtitles import stem

WAVES = "*.{wav,WAV}"
BATCH = 1 << 22


def in_batches(rows: Iterable[tuple[str, bytes]], *names: str) -> Iterator[pa.RecordBatch]:
    """Rows (a name, bytes) as batches of about BATCH bytes, as an Arrow array can hold 2 GB at most."""
    found, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), (pa.string(), pa.binary()))], names=names)

    for row in rows:
        found.append(row)
        size += len(row[1])
        if size >= BATCH:
            yield batch()
            found, size = [], 0
    if found:
        yield batch()


def read_waves(spark: SparkSession, folders: str | list[str]) -> DataFrame:
    """(path, stem, content) of the wave files of folders; the content is read only where it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", WAVES).load(folders)
    return files.select("path", stem(F.col("path")).alias("stem"), "content")


def segment_audio(segments: DataFrame, recordings: DataFrame) -> DataFrame:
    """(path, bytes) of segments (track_id, seg_start, seg_end, path), as wave files, cut from recordings (track_id, content).

    A recording is decoded once for all its segments, whose times, a few numbers each, come to it; a segment is 30 seconds at most, and ends with the recording.
    Recordings are never broadcast, as they are far larger than Spark takes them to be.
    """
    cuts = segments.groupBy("track_id").agg(F.array_sort(F.collect_list(F.struct("seg_start", "seg_end", "path"))).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        per_ms = fixed.SAMPLE_RATE // 1000
        for content, own in (row for batch in batches for row in zip(*batch.columns)):
            samples = resampled(*wav_samples(content.as_py()), fixed.SAMPLE_RATE)
            scale = peak_scale(samples)
            for x in own.as_py():
                begin = x["seg_start"] * per_ms
                part = samples[begin : min(x["seg_end"] * per_ms, begin + fixed.SEGMENT_MS * per_ms)]
                yield x["path"], wave_bytes(part * scale)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(cut(batches), "path", "bytes")

    return recordings.join(cuts.hint("shuffle_hash"), "track_id").select("content", "cuts").mapInArrow(files, "path string, bytes binary")


def render_sequences(clips: DataFrame, files: DataFrame) -> DataFrame:
    """(seq_id, bytes) of sequences of clips (seq_id, pos, path, overlap_ms): the clips' files (path, content) end to end, each laid over the last by its overlap.

    Files are never broadcast, as they are far larger than Spark takes them to be; they stream to their sequence sorted, so a task holds one encoded
    clip and what it has rendered of one sequence, whose file must be below 2 GB.
    """
    reach = F.max("overlap_ms").over(Window.partitionBy("seq_id")).cast("double")
    timed = clips.select("seq_id", "pos", "path", F.col("overlap_ms").cast("double").alias("overlap_ms"), reach.alias("reach"))
    each = files.select("path", "content").join(timed.hint("shuffle_hash"), "path").select("seq_id", "pos", "overlap_ms", "reach", "content")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*batch.columns))
        for seq, own in groupby(rows, lambda row: row[0].as_py()):
            first = next(own)
            parts = ((peak_normalised(resampled(*wav_samples(content.as_py()), fixed.SAMPLE_RATE)), overlap.as_py()) for _, _, overlap, _, content in chain([first], own))
            data = rendered(parts, first[3].as_py())
            whole = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([pa.array([seq], pa.string()), whole], names=["seq_id", "bytes"])

    return each.repartition("seq_id").sortWithinPartitions("seq_id", "pos", "overlap_ms", "content").mapInArrow(render, "seq_id string, bytes binary")


def write_files(rows: DataFrame, folder: str) -> None:
    """Rows (name, bytes) as files below a folder, which may be in any store that pyarrow knows; a task that is run again writes the same files again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        made: set[str] = set()
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns)):
                path = f"{base}/{name}"
                parent = path.rpartition("/")[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(path) as out:
                    out.write(data)
            yield pa.RecordBatch.from_pydict({"files": [batch.num_rows]})

    rows.select("name", "bytes").mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()


def with_bytes(records: DataFrame, audio: DataFrame) -> DataFrame:
    """Records (audio_path, ...) with ``audio`` as (path, bytes), of audio (path, bytes); where there is none the bytes are null."""
    own = records.join(audio.select(F.col("path").alias("audio_path"), "bytes"), "audio_path", "left")
    return own.select(F.struct(F.col("audio_path").alias("path"), "bytes").alias("audio"), *[c for c in records.columns if c != "audio_path"])


def series_files(spark: SparkSession, folder: str, language: str = "de") -> tuple[DataFrame, DataFrame]:
    """Subtitle files (track_id, format, content) of series, a folder each, and (track_id, series, audio, srt, language) of them; a subtitle file without audio beside it is an error."""
    files = spark.read.option("pathGlobFilter", "*.srt").option("recursiveFileLookup", True).text(folder, wholetext=True)
    files = files.select(F.input_file_name().alias("path"), F.col("value").alias("content"))
    audio = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp3").option("recursiveFileLookup", True).load(folder).select("path")
    base = lambda c: F.regexp_replace(F.regexp_replace(c, "^[a-z0-9]+:/*", "/"), "\\.[^./]*$", "")
    both = files.select(base("path").alias("track_id"), "content").join(audio.select(base("path").alias("track_id"), F.col("path").alias("audio")), "track_id", "left")
    lone = both.filter("audio IS NULL").select("track_id").take(1)
    if lone:
        raise FileNotFoundError(f"no audio beside {lone[0]['track_id']}.srt")
    found = both.select("track_id", F.regexp_extract("track_id", "([^/]*)/[^/]*$", 1).alias("series"), "audio", F.col("content").alias("srt"), F.lit(language).alias("language"))
    return both.select("track_id", F.lit("srt").alias("format"), "content"), found


def tone(length_ms: int, known: dict[int, bytes] | None = None) -> bytes:
    """A wave file of a tone whose pitch depends on the length, made a block of samples at a time; ``known`` keeps the first 30 seconds of the few pitches there are."""

    def made(begin: int, stop: int) -> bytes:
        return pcm16((np.sin(np.arange(begin, stop) / pitch) * 0.5).astype(np.float32))

    n, pitch, block, known = length_ms * 16, 5 + length_ms % 7, fixed.SEGMENT_MS * 16, {} if known is None else known
    begun = known.get(pitch, b"")
    if len(begun) < 2 * min(n, block):
        begun = known[pitch] = begun + made(len(begun) // 2, min(n, block))
    return b"".join([wave_header(2 * n), memoryview(begun)[: 2 * n], *(made(k, min(k + block, n)) for k in range(block, n, block))])


def tones(rows: DataFrame, length_ms: str = "dur_ms") -> DataFrame:
    """(path, content) of rows (path, and a length): wave files of tones, as recordings where there are none.

    Rows are small and can all lie in one partition, so they are dealt out before they become files; files leave in batches of bounded size.
    """

    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, bytes] = {}
        yield from in_batches(((path, tone(n, known)) for batch in batches for path, n in zip(*(c.to_pylist() for c in batch.columns))), "path", "content")

    spark = rows.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.select("path", F.col(length_ms).cast("long")).repartition(parts).mapInArrow(play, "path string, content binary")
