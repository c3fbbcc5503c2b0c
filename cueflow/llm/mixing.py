"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only.

A source's target words over its words is the expected number of copies of each of its documents.  The whole part is
taken; the fractional parts are rounded by the pivotal method: two documents meet, words move from one
to the other in a random direction until either's probability is 0 or 1, the chance of each direction being such that
no expectation changes; the one left undecided meets the next (Deville and Tille, 1998).  As words move, not probability, a
source's taken words keep their sum: they end within one document of the target.

Documents meet in small random groups, whose undecided ones meet in the groups of the next level: a reduction tree
whose every level shuffles a part of about ``1 / GROUP`` of the last.  All draws are hashes, so reruns agree.

A null or empty text has size 0 and takes nothing.  Rows that repeat a doc_id, source and size are told apart by their number; a
null source is a source, the last.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueflow.llm.shared import materialise, ranked

#: Documents that meet in one group, on average.
GROUP = 64
MOST = 3.0
WEIGHTS = (5.0, 2.0, 1.0)
WORD = "[^\\x20\\x09-\\x0D]+"
_EPS = 1e-9


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Per source: source_size, documents (with words) and target.

    Words are shared by weight; a source stops at ``most`` times its size, and what is above goes to the others, until none is above.  Each round is one
    aggregate over the sources, of which two numbers go to the driver.
    """
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("rows")).otherwise(0)).alias("documents"))
    at = F.col("rank") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (at + 1).cast("int"))
    sources = materialise(ranked(totals, "source").withColumn("weight", weight).drop("rank"), "weights")
    limit = F.col("source_size") * F.lit(most)
    level, held = 0.0, -1
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    while total:
        capped = F.col("weight") * F.lit(level) >= limit if held >= 0 else F.lit(False)
        full, open_weight, count = sources.agg(F.sum(F.when(capped, limit).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.sum(capped.cast("int"))).first()
        if count == held or not open_weight:
            break
        held, level = count, (total - full) / open_weight
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(level)))


def draw(*parts: Column) -> Column:
    """A number in [0, 1) that is a hash of its arguments."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def meet(first: Column, second: Column, seed: Column) -> Column:
    """The struct (left, decided) of two documents that meet: (doc_id, copy, size, p) each."""

    def moved(m: Column) -> Column:
        rise = m["chance"] >= m["fall"]  # the first gives words to the second
        shift = F.when(rise, -m["down"]).otherwise(m["up"])
        return let(F.struct((first["p"] + shift / first["size"]).alias("p1"), (second["p"] - shift / second["size"]).alias("p2")), sorted_out)

    def snap(p: Column) -> Column:
        return F.when(p < _EPS, 0.0).when(p > 1 - _EPS, 1.0).otherwise(p)

    def sorted_out(n: Column) -> Column:
        one = F.struct(first["doc_id"].alias("doc_id"), first["copy"].alias("copy"), first["size"].alias("size"), snap(n["p1"]).alias("p"))
        two = F.struct(second["doc_id"].alias("doc_id"), second["copy"].alias("copy"), second["size"].alias("size"), snap(n["p2"]).alias("p"))
        return let(F.struct(one.alias("one"), two.alias("two")), lambda o: F.when(o["one"]["p"].isin(0.0, 1.0), F.struct(o["two"].alias("left"), o["one"].alias("decided"))).otherwise(F.struct(o["one"].alias("left"), o["two"].alias("decided"))))

    up = F.least((1 - first["p"]) * first["size"], second["p"] * second["size"])
    down = F.least(first["p"] * first["size"], (1 - second["p"]) * second["size"])
    chance = draw(seed, first["doc_id"], first["copy"], second["doc_id"], second["copy"])
    # up is drawn with chance down / (up + down): then no expected probability changes
    fall = F.when(up + down > 0, down / (up + down)).otherwise(0.0)
    return let(F.struct(up.alias("up"), down.alias("down"), chance.alias("chance"), fall.alias("fall")), moved)


def rounded(docs: DataFrame, largest: int, seed: int, group: int = GROUP) -> DataFrame:
    """Decides (source, doc_id, copy, size, p, documents) rows: the same with ``p`` 0 or 1.

    ``documents`` is the number of rows of the source, ``largest`` the most of any.
    """
    item = F.struct("doc_id", "copy", "size", "p")
    done, level, rows, kind = None, 0, docs, docs.select(item.alias("x")).schema["x"].dataType.simpleString()
    while True:
        groups = F.ceil(F.col("documents") / F.lit(float(group) ** (level + 1)))
        bucket = F.pmod(F.xxhash64(F.lit(seed + level), "doc_id", "copy", "size"), F.greatest(groups, F.lit(1)))
        last = largest <= group ** (level + 1)
        gathered = rows.groupBy("source", "documents", (F.lit(0).cast("long") if last else bucket).alias("bucket")).agg(F.sort_array(F.collect_list(item)).alias("all"))
        start = F.struct(F.element_at("all", 1).alias("left"), F.array().cast(f"array<{kind}>").alias("decided"))
        salt = F.lit(seed * 1000 + level)
        folded = F.aggregate(
            F.slice("all", 2, F.size("all")), start, lambda s, x: let(meet(s["left"], x, salt), lambda m: F.struct(m["left"].alias("left"), F.array_append(s["decided"], m["decided"]).alias("decided")))
        )
        level_out = materialise(gathered.select("source", "documents", folded.alias("f")), f"round{level}")
        decided = level_out.select("source", F.explode("f.decided").alias("x")).select("source", "x.*")
        done = decided if done is None else done.unionByName(decided)
        left = level_out.select("source", "documents", "f.left.*")
        if last:
            p = F.when(F.col("p").isin(0.0, 1.0), F.col("p")).otherwise((draw(F.lit(seed - 1), F.col("doc_id"), F.col("copy")) < F.col("p")).cast("double"))
            return done.unionByName(left.withColumn("p", p).drop("documents"))
        rows, level = left, level + 1


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = 17) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, copies, taken (``copies * size``)."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = materialise(docs.select("doc_id", "source", size.alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")), "sizes")
    sources = materialise(source_targets(sized, weights, most), "targets")
    largest = sources.agg(F.max("documents")).first()[0] or 0
    each = sized.alias("d").join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "weight")
    each = each.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    each = each.withColumn("rate", F.when(F.abs(rate - F.round(rate)) < _EPS, F.round(rate)).otherwise(rate))
    each = each.withColumn("whole", F.floor("rate")).withColumn("p", F.col("rate") - F.col("whole"))
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    decided = rounded(each.filter(open_).select("source", "doc_id", "copy", "size", "p", "documents"), largest, seed)
    facts = sources.select(F.col("source").alias("of"), "source_size", "target")
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    back = decided.join(facts, F.col("source").eqNullSafe(F.col("of"))).select("doc_id", "source", "size", "source_size", "target", (whole + F.col("p")).cast("long").alias("copies"))
    rest = each.filter(~open_).select("doc_id", "source", "size", "source_size", "target", F.when(F.col("size") > 0, F.col("whole")).otherwise(0).cast("long").alias("copies"))
    return back.unionByName(rest).withColumn("taken", F.col("copies") * F.col("size"))
