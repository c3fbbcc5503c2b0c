"""Tables of clips, manifests and records, and where results go."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueflow.functions.providers import token_count
from cueflow.functions.text import finish_sentence, nfkc
from cueflow.operators.assembly import exact_sample
from cueflow.sources.subtitles import parse_cues, stem

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("audio_path", "text", "language", "prompt")])

#: How tab-separated files are written, so that :func:`read_tsv` finds the same values; an empty one is read as null unless told apart.
TSV = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

#: No field of a file is this, so that only a field with nothing between its tabs, not even quotes, is null.
_NO_FIELD = "\ufdd0null\ufdd0"

#: The reader drops this from quoted values, and U+0000 if not told another; a character that no text may hold.
_NO_CHARACTER = "\ufdd1"


def read_tsv(spark: SparkSession, path: str, empty: bool = False) -> DataFrame:
    """A tab-separated file with a header, all columns strings; rows that are short have nulls.  With ``empty``, a quoted empty value stays empty."""
    return spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, inferSchema=False, nullValue=_NO_FIELD if empty else None, charToEscapeQuoteEscaping=_NO_CHARACTER)


def read_clips(spark: SparkSession, sources: Sequence[tuple[str, str, int]], seed: int = 1) -> DataFrame:
    """(clip_id, path, sentence, client_id) of sentence files (path, clips folder, per mille to take); an empty sentence stays one."""
    found = []
    for k, (path, folder, per_mille) in enumerate(sources):
        rows = read_tsv(spark, path, empty=True)
        name = "path" if "path" in rows.columns else "clip_path"
        client = F.col("client_id") if "client_id" in rows.columns else F.lit("0")
        own = rows.select(F.xxhash64(F.lit(k), name, "sentence").alias("clip_id"), F.concat_ws("/", F.lit(folder.rstrip("/")), name).alias("path"), "sentence", client.alias("client_id"))
        found.append(exact_sample(own, "clip_id", per_mille, seed) if per_mille < 1000 else own)
    return reduce(DataFrame.unionByName, found)


def read_manifest(spark: SparkSession, path: str, language: str = "de") -> DataFrame:
    """(id, srt_path, audio_path, language) of a manifest; an id that is missing is the audio file's name."""
    rows = read_tsv(spark, path)
    own = lambda name: F.nullif(F.col(name), F.lit("")) if name in rows.columns else F.lit(None).cast("string")
    return rows.select(F.coalesce(own("id"), stem(F.col("audio_path"))).alias("id"), "srt_path", "audio_path", F.coalesce(own("language"), F.lit(language)).alias("language"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD).json(path)


def as_audio(records: DataFrame) -> DataFrame:
    """Records with their path as ``audio``."""
    return records.withColumnRenamed("audio_path", "audio")


def read_plain(spark: SparkSession, path: str, language: str = "de", most: int = 219, unicode: bool = False) -> DataFrame:
    """Records of ``audio<TAB>text`` lines; lines of other shapes and texts with too many tokens go."""
    parts = F.split("value", "\t", -1)
    rows = spark.read.text(path).filter(F.size(parts) == 2).select(F.get(parts, 0).alias("audio_path"), (nfkc(F.get(parts, 1)) if unicode else F.get(parts, 1)).alias("text"))
    return rows.filter(token_count(F.col("text")) <= most).select("audio_path", "text", F.lit(language).alias("language"), F.lit("").alias("prompt"))


def union_common(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables, with the columns that all have, in order of name."""
    common = sorted(set.intersection(*(set(t.columns) for t in tables)))
    return reduce(DataFrame.unionByName, [t.select(*common) for t in tables])


def without_paths(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if "path" not in c])


def read_metadata(spark: SparkSession, path: str, files: DataFrame | None = None, audio_column: str = "path") -> DataFrame:
    """Rows of a metadata file with their audio as ``audio``, each with its own transcript as ``srt``, and without columns of paths.

    ``files`` (srt_path, srt) are joined where the rows have an ``srt_path``, null where there is none; rows that have neither
    ``sentence`` nor ``text`` get the transcript's cues, a space apart, as ``sentence``.
    """
    rows = read_tsv(spark, path).withColumnRenamed(audio_column, "audio")
    if files is not None and "srt_path" in rows.columns:
        if not {"sentence", "text"} & set(rows.columns):
            cues = parse_cues(files.select(F.col("srt_path").alias("track_id"), F.lit("srt").alias("format"), F.col("srt").alias("content")))
            rows = rows.join(sentences(cues).withColumnRenamed("track_id", "srt_path"), "srt_path", "left")
        rows = rows.join(files.select("srt_path", "srt"), "srt_path", "left")
    return without_paths(rows)


def sentences(cues: DataFrame) -> DataFrame:
    """(track_id, sentence): the texts of a track's cues, a space apart."""
    parts = F.array_sort(F.collect_list(F.struct("cue_idx", "text")))
    return cues.groupBy("track_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), " ").alias("sentence"))


def series(cues: DataFrame, files: DataFrame) -> DataFrame:
    """(audio, sentence, series, srt, language) of files (track_id, series, audio, srt, language): sentence is all their cues."""
    return files.join(sentences(cues), "track_id").select("audio", "sentence", "series", "srt", "language")


def exported(rows: DataFrame) -> DataFrame:
    """Sentences that end in punctuation, with the audio's file name as mp3."""
    return rows.withColumn("sentence", finish_sentence(F.col("sentence"))).withColumn("path", F.concat(stem(F.col("path")), F.lit(".mp3")))


def materialised(examples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Examples with a transcript, and those with just a sentence; speakers that are missing are "0"."""
    sentences = examples.filter("srt IS NULL").withColumn("client_id", F.coalesce(F.nullif("client_id", F.lit("")), F.lit("0")) if "client_id" in examples.columns else F.lit("0"))
    return examples.filter("srt IS NOT NULL"), sentences


def write_records(records: DataFrame, path: str) -> None:
    """JSON lines with the four columns of a record; an output that exists is an error."""
    records.select(*RECORD.names).write.mode("errorifexists").json(path, ignoreNullFields=False)


def write_rejects(disposed: DataFrame, path: str) -> None:
    """What filters took, tab-separated, a folder for each; one pass."""
    disposed.filter("disposition != 'kept'").write.partitionBy("disposition").options(**TSV).csv(path)


def write_diverted(cues: DataFrame, path: str) -> None:
    """Cues taken out while parsing, a folder for each word."""
    cues.write.partitionBy("matched_word").options(**TSV).csv(path)


def write_dataset(records: DataFrame, path: str, split: str = "train") -> None:
    """Parquet with audio as (path, bytes), in a folder for each split; records whose ``audio`` is just a path have no bytes."""
    bare = records.schema["audio"].dataType.typeName() == "string"
    audio = F.struct(F.col("audio").alias("path"), F.lit(None).cast("binary").alias("bytes")) if bare else F.col("audio")
    records.withColumn("audio", audio).withColumn("split", F.lit(split)).write.partitionBy("split").parquet(path)


def write_tsv(rows: DataFrame, path: str) -> None:
    """Rows as tab-separated text with a header, without what can't be text."""
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("binary", "array", "struct", "map")]
    rows.select(*plain).write.options(**TSV).csv(path)


def write_subtitles(texts: DataFrame, path: str) -> None:
    """(seq_id, srt) as text, a folder for each sequence."""
    texts.select("seq_id", F.col("srt").alias("value")).write.partitionBy("seq_id").text(path)
