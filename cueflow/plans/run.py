"""Running the pipelines over files, from a configuration: ``python -m cueflow.plans.run -c config.yaml``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueflow.functions.providers import hinted_language, wav_duration_ms
from cueflow.functions.text import english_hint, french_hint
from cueflow.operators import assembly, cues as cue_ops, quality
from cueflow.plans.pipelines import Config, parse_args, sequence_captions, split_recordings, timed_clips
from cueflow.sources import audio, subtitles, tables


def plain_path(path):
    """A path without its scheme, so that listings and manifests agree."""
    return F.regexp_replace(path, "^[a-z0-9]+:/*", "/")


def audio_files(spark: SparkSession, folder: str, durations: bool = True) -> DataFrame:
    """(stem, audio_path, audio_ms) of a folder's audio; durations are read from wave files and null for others."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{wav,mp3,flac,ogg,m4a}").load(folder)
    wave = F.lower("path").endswith(".wav")
    length = F.when(wave, wav_duration_ms(F.when(wave, F.col("content")))) if durations else F.lit(None).cast("long")
    return files.select(subtitles.stem(F.col("path")).alias("stem"), plain_path(F.col("path")).alias("audio_path"), length.alias("audio_ms"))


def tracks_of_manifest(spark: SparkSession, manifest: str, transcripts: str, language: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tracks and transcript files of a manifest, and its rows without a transcript."""
    rows = tables.read_manifest(spark, manifest, language)
    files = subtitles.read_subtitles(spark, transcripts).select(plain_path(F.col("path")).alias("srt_path"), "format", "content")
    own = rows.withColumn("srt_path", plain_path(F.col("srt_path")))
    found = own.join(files, "srt_path").select(F.col("id").alias("track_id"), "audio_path", "language", "format", "content")
    return found.drop("format", "content"), found.select("track_id", "format", "content"), own.join(files, "srt_path", "left_anti")


def tracks_of_folders(spark: SparkSession, audio: str, transcripts: str, language: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tracks and transcript files of two folders, matched by name, and audio without a transcript."""
    best, missing = subtitles.best_transcripts(audio_files(spark, audio, durations=False).drop("audio_ms"), subtitles.read_subtitles(spark, transcripts))
    tracks = best.select(F.col("stem").alias("track_id"), "audio_path", F.lit(language).alias("language"))
    return tracks, best.select(F.col("stem").alias("track_id"), F.col("transcript_format").alias("format"), F.col("transcript_content").alias("content")), missing


def split(spark: SparkSession, options: Mapping) -> DataFrame:
    """Records of recordings, each with its disposition, written below ``out_folder``, with their audio where the recordings are wave files.

    Options: ``transcripts_folder`` and either ``manifest`` or ``audio_folder``; those of :class:`Config` too.  What can't be used
    goes to side tables: ``missing``, ``parse_errors`` and ``diverted``.
    """
    config, out = Config.of({"audio_format": "wav"} | dict(options)), options["out_folder"].rstrip("/")
    if options.get("manifest"):
        tracks, files, missing = tracks_of_manifest(spark, options["manifest"], options["transcripts_folder"], config.language)
    else:
        tracks, files, missing = tracks_of_folders(spark, options["audio_folder"], options["transcripts_folder"], config.language)
    cues, wrong = subtitles.parse_errors(subtitles.parse_cues(files, bool(options.get("strict_srt_tail")), bool(options.get("normalize_unicode"))))
    missing.write.parquet(f"{out}/missing")
    wrong.write.parquet(f"{out}/parse_errors")
    if config.fuse_captions:
        fused = cue_ops.fuse_captions(cues, skip_words=config.filter_words)
        fused.write.parquet(f"{out}/cues_fused")
    if config.filter_words:
        tables.write_diverted(subtitles.split_diverted(cues, config.filter_words)[1], f"{out}/diverted")
    ends = cues.groupBy("track_id").agg(F.max("end_ms").alias("last_ms"))
    length = audio_files(spark, options["audio_folder"]).select(F.col("stem").alias("track_id"), "audio_ms") if options.get("audio_folder") else None
    timed = tracks.join(ends, "track_id")
    timed = timed.join(length, "track_id", "left") if length is not None else timed.withColumn("audio_ms", F.lit(None).cast("long"))
    whole = timed.select("track_id", F.coalesce("audio_ms", "last_ms").alias("audio_ms"), F.concat(F.lit(f"{out}/audio/"), "track_id").alias("audio_path"), "language")
    language = hinted_language(french_hint(F.col("text")), english_hint(F.col("text")))
    split_recordings(cues, whole, config, language).write.parquet(f"{out}/records")
    found = spark.read.parquet(f"{out}/records")  # written once, read by each sink
    kept = found.filter("disposition = 'kept'")
    quality.assert_none_left(kept, config.filter_words)
    tables.write_records(kept, f"{out}/jsonl")
    tables.write_rejects(found.select("audio_path", "text", "language", "prompt", "disposition"), f"{out}/rejects")
    own = kept.select("audio_path", "text", "language", "prompt")
    if config.audio_format != "wav":
        tables.write_dataset(tables.as_audio(own), f"{out}/dataset", options.get("split_name", "train"))
        return found
    folders = [options["audio_folder"]] if options.get("audio_folder") else [r[0] for r in tracks.select(F.regexp_extract("audio_path", "^(.*)/", 1)).distinct().collect()]
    recordings = tracks.select("track_id", "audio_path").join(audio.read_waves(spark, folders).select(plain_path(F.col("path")).alias("audio_path"), "content"), "audio_path")
    audio.segment_audio(kept.select("track_id", "seg_start", "seg_end", F.col("audio_path").alias("path")), recordings).write.parquet(f"{out}/segment_audio")
    parts = spark.read.parquet(f"{out}/segment_audio")
    audio.write_files(parts.select(F.expr(f"substr(path, {len(out) + 2})").alias("name"), "bytes"), out)
    tables.write_dataset(audio.with_bytes(own, parts), f"{out}/dataset", options.get("split_name", "train"))
    return found


def fuse(spark: SparkSession, options: Mapping) -> DataFrame:
    """Captions and audio of sequences of clips, written below ``out_folder``.

    Options: ``sentence_tsvs``, ``clips_folders`` and ``partials`` (parts of each to take, 1.0 for all), of which the shortest decides how many count; those of
    :class:`Config` too.  Clips must be wave files, for their durations and speech.
    """
    from cueflow.functions.providers import decode_wav, energy_activity

    config, out = Config.of(options), options["out_folder"].rstrip("/")
    parts: Sequence[float] = options.get("partials") or [1.0] * len(options["sentence_tsvs"])
    clips = tables.read_clips(spark, [(t, f, round(p * 1000)) for t, f, p in zip(options["sentence_tsvs"], options["clips_folders"], parts)], config.seed)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.wav").load(list(options["clips_folders"]))
    speech = files.select(plain_path(F.col("path")).alias("path"), wav_duration_ms("content").alias("dur_ms"), energy_activity(decode_wav("content")).alias("v")).select("path", "dur_ms", "v.*")
    timed_clips(clips.withColumn("path", plain_path(F.col("path"))).join(speech, "path"), config).write.parquet(f"{out}/sequences")
    timed = spark.read.parquet(f"{out}/sequences")  # written once, for captions and audio
    sequence_captions(timed).write.parquet(f"{out}/captions")
    found = spark.read.parquet(f"{out}/captions")
    texts = assembly.srt_texts(found)
    tables.write_subtitles(texts, f"{out}/srt")
    rendered = audio.render_sequences(timed, files.select(plain_path(F.col("path")).alias("path"), "content"))
    audio.write_files(rendered.select(F.concat(F.lit("audio/"), "seq_id", F.lit(".wav")).alias("name"), "bytes"), out)
    return found


def main(args: Sequence[str] | None = None) -> None:
    import yaml

    from cueflow.session import session

    path = parse_args(args).config
    Config.load(path)  # fails early on options that can't be
    with open(path, encoding="utf-8") as file:
        options = yaml.safe_load(file) or {}
    (fuse if options.get("sentence_tsvs") else split)(session(), options)


if __name__ == "__main__":
    main()
