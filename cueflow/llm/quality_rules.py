"""Quality rules combined by weak supervision, in DataFrame operations only.

Each rule votes for (1) or against (-1) a document or abstains (0).  Expectation-maximisation estimates, without labels, the share
of good documents and for each rule how often it votes for a good and against a bad one (Dawid and Skene, 1979); a
document is kept when the posterior probability that it is good is one half or more (a tie is kept).  Bad documents are of several kinds, each seen by a few rules, so without more
the estimate would call just one kind bad: before any vote, each rule is held to be right for ``GOOD`` of the good and ``BAD`` of the bad, with ``HOLD`` of all rows' weight.
The rules look at what the base counts don't: symbols, capitals, exclamations, how words end, how many differ.  Documents with equal votes have equal posteriors,
so the estimate runs on the counts of vote patterns (some hundred, ``3**11`` at most), and its size doesn't grow with the corpus.

Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text.  A null or empty text has no words and fails the base rules; very long
texts cost their length times its logarithm; repeated rows are judged alike; other columns are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueflow.llm.mixing import let
from cueflow.llm.shared import materialise

_GAP = "[\\x20\\x09-\\x0D]+"
_COUNTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["repeated_lines", "symbols", "symbol_ends", "word_length", "capitals", "shouting", "exclamations", "exclaimed_ends", "sentences", "punctuation", "distinct"]
ROUNDS = 25
GOOD, BAD, HOLD = 0.97, 0.3, 0.05
#: What follows a word's last character.
END = "(?:[\\x20\\x09-\\x0D]|\\z)"


#: What is counted in a text, besides symbols.
COUNTS = {
    "n_capitals": "\\p{Lu}", "n_shouts": "\\p{Lu}{2}", "n_exclamations": "!", "n_symbol_ends": "[#*$%&|<>]" + END, "n_exclaimed_ends": "!" + END, "n_sentence_ends": "[.!?]" + END,
    "n_punctuated_ends": "[.,;:!?]" + END,
}


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs at least twice: of sorted windows, by 64-bit hash, equal ones are neighbours."""

    def covered(windows: Column) -> Column:
        same = lambda x, k: F.coalesce(x["w"] == F.get(windows, k - 1)["w"], F.lit(False)) | F.coalesce(x["w"] == F.get(windows, k + 1)["w"], F.lit(False))
        hit = F.filter(windows, same)
        return F.size(F.array_distinct(F.flatten(F.transform(hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    window = lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i"))
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)
    return F.when(F.size(words) > 3, let(F.sort_array(windows), covered)).otherwise(0)


def measures(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the counts of the base rules, and those that only the votes need."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"), F.length(F.array_join(words, "")).cast("long").alias("word_chars"), F.size(F.array_distinct(words)).cast("long").alias("n_distinct"), repeated_words(words).cast("long").alias("n_repeat_words")
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    words = F.filter(F.split(text, _GAP), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return docs.select(
        "doc_id", let(words, of_words).alias("w"), let(lines, of_lines).alias("l"), count("[#*$%&|<>]").alias("n_symbols"),
        *(count(pattern).alias(name) for name, pattern in COUNTS.items()),
    ).select("doc_id", "w.*", "l.*", "n_symbols", *COUNTS)



def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def votes() -> Column:
    """The rules' votes, in the order of ``RULES``.  Ratios are compared by multiplication, in whole numbers."""
    n, c = F.col("n_words"), F.col
    return F.array(
        vote(4 * c("n_dup_lines") > c("n_lines"), c("n_dup_lines") == 0),
        vote(20 * c("n_symbols") > n, 100 * c("n_symbols") <= n),
        vote(10 * c("n_symbol_ends") > n, 100 * c("n_symbol_ends") <= n),
        vote((2 * c("word_chars") < 5 * n) | (c("word_chars") > 15 * n), (c("word_chars") >= 3 * n) & (c("word_chars") <= 12 * n)),
        vote(10 * c("n_capitals") > 3 * c("word_chars"), 10 * c("n_capitals") <= c("word_chars")),
        vote(5 * c("n_shouts") > n, 50 * c("n_shouts") <= n),
        vote(10 * c("n_exclamations") > n, 50 * c("n_exclamations") <= n),
        vote(10 * c("n_exclaimed_ends") > n, 50 * c("n_exclaimed_ends") <= n),
        vote((n >= 50) & ((50 * c("n_sentence_ends") < n) | (4 * c("n_sentence_ends") > n)), (30 * c("n_sentence_ends") >= n) & (5 * c("n_sentence_ends") <= n)),
        vote((20 * c("n_punctuated_ends") < n) | (3 * c("n_punctuated_ends") > n), (12 * c("n_punctuated_ends") >= n) & (4 * c("n_punctuated_ends") <= n)),
        vote(2 * c("n_distinct") < n, 5 * c("n_distinct") >= 3 * n),
    )


def clip(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(0.995)), F.lit(0.005))


def log_odds(v: Column, prior: Column, good: Column, bad: Column) -> Column:
    """Log odds that a document with votes ``v`` is good; ``good`` and ``bad``: each rule's share of right votes."""
    part = lambda x, j: F.when(x == 1, F.log(F.get(good, j) / (1 - F.get(bad, j)))).when(x == -1, F.log((1 - F.get(good, j)) / F.get(bad, j))).otherwise(0.0)
    return F.aggregate(F.transform(v, part), F.log(prior / (1 - prior)), lambda s, x: s + x)


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """prior, good, bad: the estimate from (votes, rows), one row a pattern; a single row of 23 numbers goes to the driver."""
    k = len(RULES)
    table = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "rows"))).alias("all"))

    def step(state: Column, _: Column) -> Column:
        judged = F.transform("all", lambda x: F.struct(x["votes"].alias("v"), x["rows"].cast("double").alias("n"), (1 / (1 + F.exp(-log_odds(x["votes"], state["prior"], state["good"], state["bad"])))).alias("p")))
        return let(judged, again)

    def again(rows: Column) -> Column:
        total = lambda weigh: F.aggregate(rows, F.lit(0.0), lambda s, x: s + weigh(x))
        is_good, is_bad = lambda x: x["n"] * x["p"], lambda x: x["n"] * (1 - x["p"])

        rows_all = F.greatest(total(lambda x: x["n"]), F.lit(1.0))

        def right(weigh, value, held):
            def share(j):
                cast = total(lambda x: F.when(F.get(x["v"], j) != 0, weigh(x)).otherwise(0.0))
                agree = total(lambda x: F.when(F.get(x["v"], j) == value, weigh(x)).otherwise(0.0))
                return clip((agree + rows_all * (HOLD * held)) / (cast + rows_all * HOLD))

            return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), share)

        return F.struct(clip(total(is_good) / rows_all).alias("prior"), right(is_good, 1, GOOD).alias("good"), right(is_bad, -1, BAD).alias("bad"))

    start = F.struct(F.lit(0.8).cast("double").alias("prior"), F.array_repeat(F.lit(0.9), k).alias("good"), F.array_repeat(F.lit(0.6), k).alias("bad"))
    got = table.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("m")).select("m.*").first()
    return {"prior": got["prior"], "good": list(got["good"]), "bad": list(got["bad"])}


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, kept, and the posterior ``p_good``."""
    found = materialise(measures(docs), "measures").withColumn("votes", votes())
    model = estimate(found.groupBy("votes").agg(F.count("*").alias("rows")))
    weight = [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(model["good"], model["bad"])]
    odds = F.lit(math.log(model["prior"] / (1 - model["prior"])))
    for j, (up, down) in enumerate(weight):
        v = F.get("votes", F.lit(j))
        odds = odds + F.when(v == 1, up).when(v == -1, down).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    p = 1 / (1 + F.exp(-odds))
    return found.select("doc_id", *_COUNTED, failed.alias("base_failed"), (~failed & (p >= 0.5)).alias("kept"), p.alias("p_good"))
