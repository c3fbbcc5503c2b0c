"""Filters on records, as one disposition that says which filter takes a record first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueflow.functions import fixed
from cueflow.functions.text import compression_ratio, english_hint, french_hint, words


def few_words(text: Column, most: int = fixed.FEW_WORDS) -> Column:
    """Whether a text has few words; time tokens that stand alone count."""
    return F.size(words(text)) <= most


def too_regular(text: Column, ratio: float = fixed.MAX_COMPRESSION) -> Column:
    return compression_ratio(text) >= ratio


def first_word(text: Column, forbidden: Sequence[str]) -> Column:
    """The first of the forbidden words in a text, compared in capitals, or null."""
    return F.get(F.filter(F.array(*map(F.lit, forbidden)).cast("array<string>"), lambda w: F.contains(F.upper(text), F.upper(w))), 0)


def french(records: DataFrame, language: Column) -> DataFrame:
    """Records with a French word or elision that the language column confirms; conjuncts of one filter, so the cheap one runs first."""
    return records.filter(french_hint(F.col("text")) & (language == "fr"))


def english(records: DataFrame, language: Column) -> DataFrame:
    return records.filter(english_hint(F.col("text")) & (language == "en"))


def disposed(records: DataFrame, forbidden: Sequence[str] = (), language: Column | None = None, drop_french: bool = True, drop_english: bool = True, bad: Column | None = None) -> DataFrame:
    """Adds disposition: bad_examples, french_examples, english_examples, filtered_<word>_examples, or kept.

    One pass decides all, in the filters' order; split it by ``disposition`` at the sink.
    """
    text = F.col("text")
    bad = bad if bad is not None else few_words(text) | too_regular(text)
    word = first_word(text, forbidden)
    choice = F.when(bad, "bad_examples")
    if language is not None and drop_french:
        choice = choice.when(french_hint(text) & (language == "fr"), "french_examples")
    if language is not None and drop_english:
        choice = choice.when(english_hint(text) & (language == "en"), "english_examples")
    choice = choice.when(word.isNotNull(), F.concat(F.lit("filtered_"), word, F.lit("_examples")))
    return records.withColumn("disposition", choice.otherwise("kept"))


def residual(records: DataFrame, forbidden: Sequence[str]) -> DataFrame:
    """The records that have a forbidden word, with the first of these as ``word``."""
    return records.withColumn("word", first_word(F.col("text"), forbidden)).filter("word IS NOT NULL")


def assert_none_left(records: DataFrame, forbidden: Sequence[str]) -> None:
    """Fails if any kept record has a forbidden word."""
    if not residual(records, forbidden).isEmpty():
        raise ValueError("records with forbidden words are left")


def allowed_only(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a list of ids; Spark broadcasts the list if it is small."""
    own = ids.select(F.trim(F.col(ids.columns[0]).cast("string")).alias("_id")).filter("_id != ''").distinct()
    return rows.join(own, rows[key].cast("string") == own["_id"], "left_semi")
