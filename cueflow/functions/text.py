"""Text normalisation as column expressions: everything but NFKC and compression stays in the JVM."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueflow.functions import fixed

#: White space as Python's ``str.strip`` and ``split`` have it.
_SPACE = "[\\s\\x1c-\\x1f\\x85]"


def strip(text: Column) -> Column:
    """Without white space at either end, of any kind."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def words(text: Column) -> Column:
    """The runs of characters that aren't white space."""
    return F.regexp_extract_all(text, F.lit("(?U)([^\\s\\x1c-\\x1f\\x85]+)"), 1)


def replaced(text: Column, pairs: Mapping[str, str]) -> Column:
    """Literal replacements, one after another."""
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), pairs.items(), text)


def unseen(pairs: Mapping[str, str]) -> set[str]:
    """The abbreviations that one look at a text may miss: those that an earlier expansion may create, and those that share a word with one of several words."""
    found, brought, gaps = set(), set(), False
    for short, full in pairs.items():
        own = set(short.lower().split())
        shares = any(own & set(other.lower().split()) for other in pairs if other != short and max(len(own), len(other.split())) > 1)
        if shares or brought & own or (gaps and len(own) > 1):
            found.add(short)
        brought |= set(full.lower().split())
        gaps |= not full.strip()
    return found


def expand_abbreviations(text: Column, pairs: Mapping[str, str] = fixed.ABBREVIATIONS) -> Column:
    """Abbreviations that stand alone between white space, whatever their case, in the order of the table.

    One pass finds which of them a text holds; only the patterns of these are applied.
    """
    if not pairs:
        return text
    literal = lambda t: "\\Q" + t + "\\E"
    key = lambda t: F.lower(F.upper(F.translate(t, "\u0130", "i")))
    steps = F.array(*(F.struct(F.lit(f"(?iuU)(^|\\s){literal(short)}(?=\\s|$)").alias("pattern"), F.lit("$1" + full.replace("\\", "\\\\").replace("$", "\\$")).alias("full")) for short, full in pairs.items()))
    numbers_of: dict[str, list[int]] = {}
    for k, short in enumerate(pairs):
        numbers_of.setdefault(short.upper().lower(), []).append(k)
    numbers_map = F.create_map(*(x for name, own in numbers_of.items() for x in (key(F.lit(name)), F.array(*map(F.lit, own)))))
    every, late = F.array(*map(F.lit, range(len(pairs)))), unseen(pairs)
    always = F.array(*(F.lit(k) for k, short in enumerate(pairs) if short in late)).cast("array<int>")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?iuU)(?:^|\\s)({'|'.join(map(literal, pairs))})(?=\\s|$)"), 1))
    due = F.array_sort(F.array_union(F.flatten(F.transform(found, lambda t: F.coalesce(numbers_map[key(t)], every))), always))
    return F.aggregate(due, text, lambda t, k: F.regexp_replace(t, F.get(steps, k)["pattern"], F.get(steps, k)["full"]))


def standardize(text: Column) -> Column:
    """Typographic characters as plain ones."""
    return F.regexp_replace(replaced(text, fixed.REPLACEMENTS), f"[{fixed.ODD_SPACES}]+", " ")


def fix_capitals(text: Column) -> Column:
    """Words of over four letters with exactly two capitals get just the first; words end up a space apart."""

    def one(w: Column) -> Column:
        odd = (F.length(w) > 4) & F.rlike(w, F.lit("^\\P{Lu}*(?:\\p{Lu}\\P{Lu}*){2}$"))
        return F.when(odd, F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))).otherwise(w)

    return F.array_join(F.transform(words(text), one), " ")


def tidy_dots(text: Column) -> Column:
    """Ellipses, bracketed or long, as three dots, and no space before punctuation."""
    bracketed = F.regexp_replace(text, "(?U)\\[\\s*(?:\\.{3,}|…+)\\s*\\]", "...")
    return strip(replaced(F.regexp_replace(bracketed, "\\.{3,}|…+", "..."), fixed.PUNCTUATION_SPACING))


def remove_bracketed(text: Column) -> Column:
    """Without what stands in brackets or between asterisks, and without font tags."""
    for pattern in ("(?d)\\[.*?\\]", "(?d)\\(.*?\\)", "(?d)\\*.*?\\*", "(?i)</?font[^>]*>"):
        text = F.regexp_replace(text, pattern, "")
    return strip(text)


def tokens(text: Column) -> Column:
    """Words, with three dots as a token of their own where they begin one."""
    return F.regexp_extract_all(text, F.lit("(?U)(\\.\\.\\.|[^\\s\\x1c-\\x1f\\x85]+)"), 1)


def currencies(text: Column) -> Column:
    return replaced(text, fixed.CURRENCIES)


def comma_decimals(text: Column) -> Column:
    return F.regexp_replace(text, "(?U)(?<=\\d),(?=\\d)", ".")


def join_groups(text: Column) -> Column:
    """Digit groups of three, a space or an apostrophe apart, as one number."""
    return F.regexp_replace(F.regexp_replace(text, "[\u00a0\u202f]", " "), "(?U)(?<=\\d)[ '](?=\\d{3}\\b)", "")


#: How many texts, or words of them, are Python objects at once.
_ROWS, _WORDS = 64, 1 << 16


def arrow_map(function: Callable, kind: pa.DataType = pa.string()) -> Callable[[pa.Array], pa.Array]:
    """A function of a text as one of an Arrow array, with few texts as Python objects at a time: a batch can hold 64 MB, and several steps of a plan run side by side."""

    def mapped(texts: pa.Array) -> pa.Array:
        parts = (texts[k : k + _ROWS] for k in range(0, len(texts), _ROWS))
        return joined((pa.array([function(t) if t is not None else None for t in part.to_pylist()], kind) for part in parts), kind)

    return mapped


def joined(parts: Iterator[pa.Array], kind: pa.DataType) -> pa.Array:
    found = list(parts)
    return pa.concat_arrays(found) if found else pa.array([], kind)


_FRACTION, _NUMBER = re.compile(r"(\d+)[⁄/](\d+)"), re.compile(r"\b(\d+)(\.\d+)?\b")


def number_forms(text: str) -> str:
    """Fractions as decimals, currencies in words, decimal points, and thousands grouped."""

    def value(match: re.Match) -> str:
        above, below = int(match[1]), int(match[2])
        return str(above / below) if below else match[0]

    text = _FRACTION.sub(value, text)
    for old, new in fixed.CURRENCIES.items():
        text = text.replace(old, new)
    text = re.sub(r"(?<=\d),(?=\d)", ".", text)
    return _NUMBER.sub(lambda m: f"{int(m[1]):,}".replace(",", "'") + (m[2] or ""), text)


@F.arrow_udf(T.StringType())
def _number_forms(text: pa.Array) -> pa.Array:
    return arrow_map(number_forms)(text)


def numbers(text: Column) -> Column:
    """Numbers in one form: groups joined, fractions as decimals, currencies in words, decimal points, thousands grouped.

    A fraction over zero stays as it is.  Two steps need a function of what matched, so all but the first run on Arrow batches, as one step with one worker.
    """
    return _number_forms(join_groups(text))


@F.arrow_udf(T.StringType())
def nfkc(text: pa.Array) -> pa.Array:
    return arrow_map(lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t))(text)


def normalize(text: Column) -> Column:
    """All steps, in the order that results depend on."""
    text = F.translate(nfkc(text), fixed.APOSTROPHES, "'" * len(fixed.APOSTROPHES))
    text = numbers(standardize(fix_capitals(expand_abbreviations(tidy_dots(remove_bracketed(text))))))
    return strip(F.regexp_replace(F.replace(text, F.lit("\n"), F.lit(" ")), f"(?U){_SPACE}{{2,}}", " "))


def collapsed(tokens: list[str], longest: int = 3) -> list[str]:
    """One copy of each run of equal tokens, else of the longest n-gram that repeats at once."""
    out, i, n = [], 0, len(tokens)
    while i < n:
        width = 1 if tokens[i : i + 1] == tokens[i + 1 : i + 2] else next((w for w in range(longest, 1, -1) if i + 2 * w <= n and tokens[i : i + w] == tokens[i + w : i + 2 * w]), 0)
        if not width:
            out.append(tokens[i])
            i += 1
            continue
        own = tokens[i : i + width]
        out += own
        while i + width <= n and tokens[i : i + width] == own:
            i += width
    return out


def _pieces(lists: pa.ListArray) -> Iterator[pa.ListArray]:
    """Parts of lists with about _WORDS words each, one list at least."""
    ends, begin, words = lists.offsets.to_pylist(), 0, 0
    for k in range(len(lists)):
        words += ends[k + 1] - ends[k]
        if words >= _WORDS or k + 1 == len(lists):
            yield lists[begin : k + 1]
            begin, words = k + 1, 0


def _collapsed(lists: pa.ListArray) -> pa.Array:
    words, at, found = lists.flatten().to_numpy(zero_copy_only=False).tolist(), 0, []
    for n in lists.value_lengths().to_pylist():
        found.append(" ".join(collapsed(words[at : at + n])) if n is not None else None)
        at += n or 0
    return pa.array(found, pa.string())


@F.arrow_udf(T.StringType())
def _collapse(found: pa.Array) -> pa.Array:
    return joined(map(_collapsed, _pieces(found)), pa.string())


def collapse_repeats(text: Column) -> Column:
    """The tokens of a text without immediate repeats of one to three of them."""
    return _collapse(tokens(text))


def finish_sentence(text: Column) -> Column:
    """Without quotes around it, and with a full stop where no sentence ends; an empty one stays empty."""
    bare = F.when(F.startswith(text, F.lit('"')) & F.endswith(text, F.lit('"')) & (F.length(text) >= 1), text.substr(F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))).otherwise(text)
    return F.when((F.length(bare) > 0) & ~F.right(bare, F.lit(1)).isin(".", "?", "!"), F.concat(bare, F.lit("."))).otherwise(bare)


def safe_id(value: Column) -> Column:
    """A name fit for a file."""
    plain = F.regexp_replace(F.translate(strip(value.cast("string")), "/\\", "__"), "[^A-Za-z0-9._-]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(plain, "^[._]+|[._]+$", ""), F.lit("")), F.lit("sample"))


def leading_space(text: Column, language: Column) -> Column:
    return F.when(language.isin(*fixed.UNSPACED_LANGUAGES), text).otherwise(F.concat(F.lit(" "), text))


def without_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<\\|[^|]+\\|>", "")


@F.arrow_udf(T.DoubleType())
def _ratio(text: pa.Array) -> pa.Array:
    return arrow_map(lambda t: len(t) / len(zlib.compress(t.encode())), pa.float64())(text)


def compression_ratio(text: Column) -> Column:
    """Characters without tags over the bytes that zlib makes of them."""
    return _ratio(without_tags(text))


def hints(text: Column, vocabulary: list[str], elisions: list[str]) -> Column:
    """Whether a text has one of some words, or an elision before an apostrophe."""
    plain = F.replace(without_tags(text), F.lit("’"), F.lit("'"))
    return F.rlike(plain, F.lit(f"(?iuU)\\b(?:{'|'.join(vocabulary)})\\b|\\b(?:{'|'.join(elisions)})\\s*'"))


def french_hint(text: Column) -> Column:
    return hints(text, fixed.FRENCH_WORDS, fixed.FRENCH_ELISIONS)


def english_hint(text: Column) -> Column:
    return hints(text, fixed.ENGLISH_WORDS, fixed.ENGLISH_ELISIONS)
