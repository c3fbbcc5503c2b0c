"""The two pipelines, and what configures them."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueflow.functions import fixed
from cueflow.functions.text import normalize
from cueflow.operators import assembly, cues as cue_ops, quality, segments as seg_ops, spans as span_ops


@dataclass
class Config:
    """Options of the pipelines; times in milliseconds, chances per million."""

    language: str = "de"
    resolution_ms: int = fixed.RESOLUTION_MS
    fuse_captions: bool = False
    cut_initial_audio: bool = False
    filter_words: Sequence[str] = ()
    filter_french: bool = True
    filter_english: bool = False
    silence_every: int = 1
    audio_format: str = "mp3"
    clips_per_sequence: int = 16
    maintain_speaker: int = 500_000
    overlap_chance: int = 500_000
    max_overlap_chance: int = 200_000
    max_overlap_ms: int = 200
    seed: int = 42

    def __post_init__(self):
        self.filter_words = tuple(self.filter_words or ())
        if self.resolution_ms % 20 or self.resolution_ms <= 0:
            raise ValueError("resolution_ms must be a multiple of 20")
        if self.silence_every < 1 or self.clips_per_sequence < 1:
            raise ValueError("silence_every and clips_per_sequence must be at least 1")
        if not all(0 <= c <= 1_000_000 for c in (self.maintain_speaker, self.overlap_chance, self.max_overlap_chance)):
            raise ValueError("chances are per million")

    @classmethod
    def of(cls, options: Mapping) -> Config:
        """From a mapping that may hold other options too."""
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in options.items() if k in known})

    @classmethod
    def load(cls, path: str) -> Config:
        import yaml

        if not Path(path).is_file():
            raise FileNotFoundError(path)
        return cls.of(yaml.safe_load(Path(path).read_text()) or {})


def parse_args(args: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Prepare speech training records.")
    parser.add_argument("-c", "--config", required=True)
    return parser.parse_args(args)


def sanitized_where_invalid(cues: DataFrame) -> DataFrame:
    """Cues of valid tracks as they are, of others repaired; tracks beyond repair go.  Validity is a window over the shuffle that all later steps by track share."""
    marked = cue_ops.with_validity(cues).select("track_id", "cue_idx", "start_ms", "end_ms", "text", "valid")
    rest = cue_ops.sanitize_cues(marked.filter("NOT valid").drop("valid")).filter("error IS NULL").drop("error")
    return marked.filter("valid").drop("valid").unionByName(rest)


def split_recordings(cues: DataFrame, tracks: DataFrame, config: Config = Config(), language: Column | None = None) -> DataFrame:
    """Records of tracks (track_id, audio_ms, audio_path, language) with their cues, each with its disposition.

    Cues with a filter word block their time and go; captions are fused if asked for; invalid tracks are repaired.
    """
    marked = cue_ops.divert_words(cues, config.filter_words)
    kept = marked.filter("matched_word IS NULL").drop("matched_word")
    if config.fuse_captions:
        kept = cue_ops.fuse_captions(kept, skip_words=config.filter_words)
    spans = span_ops.safe_spans(tracks.select("track_id", "audio_ms"), marked.filter("matched_word IS NOT NULL").select("track_id", "start_ms", "end_ms"))
    ready = sanitized_where_invalid(kept).join(tracks.select("track_id", "language"), "track_id")
    placed = seg_ops.positioned(span_ops.contained_cues(ready, spans))
    found = seg_ops.segment_records(placed, seg_ops.segment_boundaries(placed, config.cut_initial_audio)).filter("within")
    thinned = assembly.subsample_silence(found, config.silence_every, ["span_idx", "seg_idx"]) if config.silence_every > 1 else found
    own = thinned.join(tracks, "track_id")
    path = F.concat_ws("/", "audio_path", F.concat(F.col("seg_start").cast("string"), F.lit(f".{config.audio_format}")))
    records = own.select("track_id", "span_idx", "seg_idx", "seg_start", "seg_end", path.alias("audio_path"), "text", "language", "prompt")
    return quality.disposed(records, config.filter_words, language, config.filter_french, config.filter_english)


def timed_clips(clips: DataFrame, config: Config = Config()) -> DataFrame:
    """Clips (clip_id, sentence, client_id, dur_ms, vad_start_ms, vad_end_ms, ...) in sequences: adds seq_id, pos, overlap_ms, offset_ms, start_ms and end_ms."""
    runs = assembly.speaker_runs(clips, config.maintain_speaker, config.seed)
    placed = assembly.chunk_sequences(runs, config.clips_per_sequence)
    return assembly.fused_offsets(assembly.draw_overlaps(placed, config.overlap_chance, config.max_overlap_chance, config.max_overlap_ms, config.seed))


def sequence_captions(timed: DataFrame) -> DataFrame:
    """Captions (seq_id, pos, clip_id, start_s, end_s, text) of clips in sequences."""
    seconds = lambda c: (F.col(c) / 1000.0).cast("double")
    return cue_ops.repair_overlaps(timed.select("seq_id", "pos", "clip_id", seconds("start_ms").alias("start_s"), seconds("end_ms").alias("end_s"), normalize(F.col("sentence")).alias("text")))


def fuse_clips(clips: DataFrame, config: Config = Config()) -> DataFrame:
    """Captions of sequences of clips."""
    return sequence_captions(timed_clips(clips, config))
