"""A pipeline over ``documents``: toxic ones go, one of each group of near copies stays, long repeats are cut, benchmark leaks go, sources are mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``.  All but the last return the columns of ``documents``; the last returns what the mix takes, with how often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueflow.llm.decontamination import without_contaminated
from cueflow.llm.jaccard_join import one_of_each
from cueflow.llm.mixing import WORD, mix
from cueflow.llm.shared import documents, materialise, release, tables_written
from cueflow.llm.suffix_dedup import remove_long_repeats
from cueflow.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return without_toxic(docs, documents(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by Jaccard similarity, the one with the smallest doc_id stays."""
    return one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in long repeated strings are cut from the texts; characters cut in two go whole, and n_chars follows.

    A document of which nothing is left stays as an empty one, which the mix takes no copies of.
    """
    found = remove_long_repeats(docs, [c for c in docs.columns if c not in ("doc_id", "text")], as_text=True)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return found.select(*(new.get(c, F.col("carried")[c]).alias(c) for c in docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``copies`` (how often), ``taken`` words, and their source's size and target.

    A column of the documents that has one of these names stays, and the mix's own is called ``mix_...``.
    """
    key = ["doc_id", "source", "size"]
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", size.alias("size"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("row.text")))
    picked = mix(docs).withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("copies")))).filter("copies > 0")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in (*key, "nth")]
    joined = rows.alias("d").join(picked.alias("m"), same[0] & same[1] & same[2] & same[3])
    own = [F.col(f"m.{c}").alias(f"mix_{c}" if c in docs.columns else c) for c in ("size", "source_size", "target", "copies", "taken")]
    return joined.select(*(F.col("d.row")[c].alias(c) for c in docs.columns), *own)


STAGES = [("toxicity", drop_toxic), ("jaccard", drop_near_copies), ("suffix_dedup", cut_repeats), ("decontamination", drop_leaks), ("mixing", mix_sources)]
#: The models have no form in SQL, and the mix is drawn; the tests hold the operators against brute force, and the stages against the operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on its way goes once its result is written."""
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        before = set(tables_written(spark))
        docs = materialise(stage(spark, docs, sf_dir), name)
        own = [t for t in tables_written(spark) if t not in before]
        release(spark, own[:-1] + ([last] if last else []))
        last = own[-1]
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES, ORACLE = {"pipeline": run}, {}
