"""Subtitle files as cues, parsed by array functions: one row a file, exploded to one row a cue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueflow.functions.text import nfkc, strip
from cueflow.functions.times import parse_time
from cueflow.operators.cues import divert_words


def file_lines(content: Column) -> Column:
    """Lines of a file's text, whatever ends them; the end of the last line begins no other."""
    plain = F.regexp_replace(content, "\r\n?", "\n")
    return F.split(F.regexp_replace(plain, "\n\\z", ""), "\n", -1)


def parse_cues(files: DataFrame, strict_srt_tail: bool = False, unicode: bool = False) -> DataFrame:
    """Cues (track_id, cue_idx, start_ms, end_ms, text) of files (track_id, format, content), format ``srt`` or ``vtt``.

    The lines between two time lines are a cue's text, but for what leads to the next: a blank and, in SRT, a number.  Empty texts go, in SRT those of
    one character too, in VTT a single dot.  ``strict_srt_tail``: an SRT file that doesn't end in a blank line loses its last line of text.
    A time that can't be read is null; see :func:`parse_errors`.
    """
    lines = files.filter("content IS NOT NULL").select("track_id", F.lower("format").alias("format"), file_lines(F.col("content")).alias("lines"))
    is_time = lambda i: F.contains(F.get("lines", i), F.lit(" --> "))
    marked = lines.withColumn("marks", F.filter(F.sequence(F.lit(0), F.size("lines") - 1), is_time))
    each = marked.select("track_id", "format", "lines", "marks", F.posexplode("marks").alias("cue_idx", "at"))
    srt = F.col("format") == "srt"
    last = F.size("lines") + (F.when(srt, 1) if strict_srt_tail else F.when(srt, 2)).otherwise(1)
    until = F.coalesce(F.get("marks", F.col("cue_idx") + 1), last) - F.when(srt, 2).otherwise(1)
    body = F.slice("lines", F.col("at") + 2, F.greatest(F.least(until, F.size("lines")) - F.col("at") - 1, F.lit(0)))
    text = strip(F.array_join(F.transform(body, strip), " "))
    times = F.split(strip(F.get("lines", F.col("at"))), " --> ", -1)
    cues = each.select(
        "track_id", F.col("cue_idx").cast("long").alias("cue_idx"), parse_time(F.get(times, 0)).alias("start_ms"), parse_time(F.when(F.size(times) == 2, F.get(times, 1))).alias("end_ms"),
        (nfkc(text) if unicode else text).alias("text"), srt.alias("srt"),
    )
    return cues.filter(F.when(F.col("srt"), F.length("text") > 1).otherwise((F.col("text") != "") & (F.col("text") != "."))).drop("srt")


def parse_errors(cues: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cues of tracks whose times could all be read, and the tracks of which one couldn't, with how many."""
    wrong = cues.filter("start_ms IS NULL OR end_ms IS NULL").groupBy("track_id").agg(F.count("*").alias("unreadable"))
    return cues.join(wrong, "track_id", "left_anti"), wrong


def split_diverted(cues: DataFrame, words: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Cues without any of the words, and those with one, as (speech_id, start_ms, end_ms, text, matched_word)."""
    marked = divert_words(cues, words)
    out = marked.filter("matched_word IS NOT NULL").select(F.col("track_id").alias("speech_id"), "start_ms", "end_ms", "text", "matched_word")
    return marked.filter("matched_word IS NULL").drop("matched_word"), out


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), "(?<=.)\\.[^.]*$", "")


def read_subtitles(spark: SparkSession, folder: str, glob: str = "*.{srt,vtt}") -> DataFrame:
    """(path, stem, format, content) of the subtitle files of a folder."""
    files = spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True)
    path = F.input_file_name()
    return files.select(path.alias("path"), stem(path).alias("stem"), F.lower(F.regexp_extract(path, "\\.([^.]*)$", 1)).alias("format"), F.col("value").alias("content"))


def best_transcripts(audio: DataFrame, transcripts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audio (stem) with its transcript, SRT before VTT; and audio without any."""
    best = transcripts.groupBy("stem").agg(F.min_by(F.struct(*transcripts.columns), F.when(F.col("format") == "srt", 0).otherwise(1)).alias("t"))
    own = best.select("stem", *(F.col(f"t.{c}").alias(f"transcript_{c}") for c in transcripts.columns if c != "stem"))
    return audio.join(own, "stem"), audio.join(own, "stem", "left_anti")
