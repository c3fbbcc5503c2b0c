"""What depends on models or codecs: columns that callers can supply, with deterministic offline defaults."""

from __future__ import annotations

import io
import struct
import wave
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def token_count(text: Column) -> Column:
    """A stand-in for a tokenizer's count: runs of letters or digits, and other characters one by one.  Not equal to any byte-pair encoding."""
    return F.regexp_count(text, F.lit("[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\s]")).cast("long")


def hinted_language(french: Column, english: Column) -> Column:
    """A stand-in for language identification from word hints alone."""
    return F.when(french & ~english, "fr").when(english & ~french, "en").otherwise("de")


def wav_samples(data: bytes) -> tuple[np.ndarray, int]:
    """Mono samples in [-1, 1] and the rate of a PCM wave file."""
    with wave.open(io.BytesIO(data)) as file:
        width, channels, rate = file.getsampwidth(), file.getnchannels(), file.getframerate()
        raw = file.readframes(file.getnframes())
    if width == 1:
        samples = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    else:
        samples = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << (8 * width - 1))
    return (samples.reshape(-1, channels).mean(axis=1) if channels > 1 else samples), rate


def resampled(samples: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear resampling."""
    if rate == to or not len(samples):
        return samples
    at = np.arange(int(len(samples) * to / rate)) * (rate / to)
    return np.interp(at, np.arange(len(samples)), samples).astype(np.float32)


def peak_scale(samples: np.ndarray, headroom_db: float = 0.1) -> float:
    """What brings the loudest sample to just below the most there is; 1 in silence."""
    peak = max(samples.max(initial=0.0), -samples.min(initial=0.0))
    return 10 ** (-headroom_db / 20) / peak if peak > 0 else 1.0


def peak_normalised(samples: np.ndarray, headroom_db: float = 0.1) -> np.ndarray:
    return samples * peak_scale(samples, headroom_db)


@F.pandas_udf(T.ArrayType(T.FloatType()))
def decode_wav(content: pd.Series) -> pd.Series:
    """Mono, 16 kHz, peak-normalised samples of wave files' contents."""
    return content.map(lambda data: peak_normalised(resampled(*wav_samples(bytes(data)), 16_000)), na_action="ignore")


def wav_length_ms(data: bytes) -> int:
    """Whole milliseconds of what a PCM wave file holds, by its frames, which aren't decoded."""
    with wave.open(io.BytesIO(data)) as file:
        frames = len(file.readframes(file.getnframes())) // (file.getsampwidth() * file.getnchannels())
        return frames * 1000 // file.getframerate()


@F.arrow_udf(T.LongType())
def wav_duration_ms(content: pa.Array) -> pa.Array:
    return pa.array([wav_length_ms(x.as_py()) if x.is_valid else None for x in content], pa.int64())


def overlaid(clips: list[np.ndarray], overlaps_ms: list[float]) -> np.ndarray:
    """16 kHz clips end to end, each laid over the last ``overlap`` milliseconds of what is there."""
    out = np.zeros(sum(len(c) for c in clips), np.float32)
    end = 0
    for samples, overlap in zip(clips, overlaps_ms):
        n = min(int(round(overlap)) * 16, end, len(samples))
        out[end - n : end - n + len(samples)] += samples
        end += len(samples) - n
    return out[:end]


@F.pandas_udf(T.ArrayType(T.FloatType()))
def concatenate_overlaid(clips: pd.Series, overlaps_ms: pd.Series) -> pd.Series:
    """Arrays of clips as one each, see :func:`overlaid`."""
    return pd.Series([overlaid([np.asarray(x, np.float32) for x in p], list(o)) if p is not None else None for p, o in zip(clips, overlaps_ms)])


def cut_samples(samples: Column, start_ms: Column, end_ms: Column, rate: int = 16_000) -> Column:
    """The part of an array of samples between two times."""
    per_ms = rate // 1000
    return F.slice(samples, (start_ms * per_ms + 1).cast("int"), F.greatest((end_ms - start_ms) * per_ms, F.lit(0)).cast("int"))


@F.pandas_udf(T.StructType([T.StructField("vad_start_ms", T.LongType()), T.StructField("vad_end_ms", T.LongType())]))
def energy_activity(samples: pd.Series) -> pd.DataFrame:
    """First and last time, in 30 ms frames, at which the level is over a hundredth of the loudest; both 0 where it never is."""
    rows = []
    for own in samples:
        own = np.asarray(own if own is not None else [], np.float32)
        frames = own[: len(own) // 480 * 480].reshape(-1, 480)
        level = np.sqrt((frames**2).mean(axis=1)) if len(frames) else np.zeros(0)
        loud = np.flatnonzero(level > max(level.max(initial=0.0) / 100, 1e-5))
        rows.append((int(loud[0]) * 30, (int(loud[-1]) + 1) * 30) if len(loud) else (0, 0))
    return pd.DataFrame(rows, columns=["vad_start_ms", "vad_end_ms"])


def ring_speech(voiced: list[bool], frame_ms: int, padding_ms: int, total_ms: int, share: float = 0.9) -> tuple[int, int | None]:
    """When speech begins and ends by the frames of a sliding window.

    It is on once over ``share`` of a window is voiced, and off once as much is not; after each change the window fills anew.  The begin is the oldest
    frame of the window that first turned it on (0 without any); the end is the frame that last turned it off, or the whole length if it stays on.
    """
    size, since, on, begin, end = padding_ms // frame_ms, 0, False, None, None
    for k in range(len(voiced)):
        oldest = max(since, k - size + 1)
        if sum(flag != on for flag in voiced[oldest : k + 1]) > share * size:
            if not on and begin is None:
                begin = oldest * frame_ms
            end = k * frame_ms if on else end
            on, since = not on, k + 1
    return begin or 0, total_ms if on else end


def ring_activity(voiced: Column, total_ms: Column, frame_ms: int = 30, padding_ms: int = 300) -> Column:
    """(start_ms, end_ms) of speech in arrays of voiced flags, one a frame; end_ms is null where speech never ended."""

    @F.pandas_udf(T.StructType([T.StructField("start_ms", T.LongType()), T.StructField("end_ms", T.LongType())]))
    def one(flags: pd.Series, total: pd.Series) -> pd.DataFrame:
        rows = [ring_speech([bool(x) for x in own], frame_ms, padding_ms, int(t)) for own, t in zip(flags, total)]
        return pd.DataFrame({"start_ms": pd.Series([r[0] for r in rows], dtype="Int64"), "end_ms": pd.Series([r[1] for r in rows], dtype="Int64")})

    return one(F.coalesce(voiced, F.array().cast("array<boolean>")), F.coalesce(total_ms, F.lit(0)))


def voiced_frames(samples: Column, frame_ms: int = 30, rate: int = 16_000, level: float = 0.01) -> Column:
    """Whether the level of each whole frame is above ``level``; the last frame is left out, as it may be cut."""

    @F.pandas_udf(T.ArrayType(T.BooleanType()))
    def one(arrays: pd.Series) -> pd.Series:
        n = rate * frame_ms // 1000

        def flags(own) -> list[bool]:
            own = np.asarray(own, np.float32)
            whole = max((len(own) - 1) // n, 0)
            return (np.sqrt((own[: whole * n].reshape(-1, n) ** 2).mean(axis=1)) > level).tolist() if whole else []

        return arrays.map(flags, na_action="ignore")

    return one(samples)


def pcm16(samples: np.ndarray) -> bytes:
    return (np.clip(np.asarray(samples, np.float32), -1, 1) * 32767).astype("<i2").tobytes()


def wave_header(size: int) -> bytes:
    """What stands before ``size`` bytes of 16 kHz mono samples of two bytes in a wave file."""
    return struct.pack("<4sL4s4sLHHLLHH4sL", b"RIFF", 36 + size, b"WAVE", b"fmt ", 16, 1, 1, 16_000, 32_000, 2, 16, b"data", size)


def wave_bytes(samples: np.ndarray) -> bytes:
    """16 kHz mono samples as the bytes of a wave file."""
    data = pcm16(samples)
    return wave_header(len(data)) + data


def rendered(clips: Iterable[tuple[np.ndarray, float]], reach_ms: float) -> bytearray:
    """The wave file of (samples, overlap in milliseconds) laid over each other as :func:`overlaid` does, of which only what an overlap of ``reach_ms`` can still change are floats."""
    reach, data, tail = max(int(round(reach_ms)) * 16, 0), bytearray(wave_header(0)), np.zeros(0, np.float32)
    for samples, overlap in clips:
        n = min(int(round(overlap)) * 16, (len(data) - 44) // 2 + len(tail), len(samples))
        whole = np.zeros(len(tail) - n + len(samples), np.float32)
        whole[: len(tail)] = tail
        whole[len(tail) - n :] += samples
        sure = max(len(whole) - reach, 0)
        data += pcm16(whole[:sure])
        tail = whole[sure:]
    data += pcm16(tail)
    data[:44] = wave_header(len(data) - 44)
    return data


@F.pandas_udf(T.BinaryType())
def encode_wav(samples: pd.Series) -> pd.Series:
    """Samples as wave files' contents."""
    return samples.map(wave_bytes, na_action="ignore")


def mono(channels: np.ndarray) -> np.ndarray:
    """Samples of an array in either layout as one float channel; up to eight rows that are longer than many are channels."""
    own = np.asarray(channels)
    if own.ndim == 2:
        own = (own if own.shape[0] <= 8 and own.shape[1] > own.shape[0] else own.T).mean(axis=0)
    return own.astype(np.float32)
