"""Queries of the training-data operators over the tables of one folder, each over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cueflow.llm.decontamination import contaminated
from cueflow.llm.jaccard_join import jaccard_components
from cueflow.llm.mixing import mix
from cueflow.llm.oracle import ORACLE  # noqa: F401
from cueflow.llm.quality_classifier import quality_scores
from cueflow.llm.quality_rules import quality_rules
from cueflow.llm.shared import documents
from cueflow.llm.substring_dedup import remove_repeats
from cueflow.llm.suffix_dedup import remove_long_repeats
from cueflow.llm.token_counts import token_counts
from cueflow.llm.toxicity import toxicity_scores
from cueflow.llm.url_filters import url_filters

QUERIES: dict = {}


def op8_quality_classifier(spark, sf_dir):
    return quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op9_toxicity(spark, sf_dir):
    return toxicity_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op10_token_counts(spark, sf_dir):
    return token_counts(documents(spark, sf_dir))


QUERIES |= {"op8_quality_classifier": op8_quality_classifier, "op9_toxicity": op9_toxicity, "op10_token_counts": op10_token_counts}


def op2_mixing(spark, sf_dir):
    return mix(documents(spark, sf_dir))


def op3_quality_rules(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir)).drop("p_good")


def op6_url_filters(spark, sf_dir):
    return url_filters(documents(spark, sf_dir, "pages"))


QUERIES |= {"op2_mixing": op2_mixing, "op3_quality_rules": op3_quality_rules, "op6_url_filters": op6_url_filters}


def op7_substring_dedup(spark, sf_dir):
    found = remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


QUERIES |= {"op7_substring_dedup": op7_substring_dedup}


def op5_suffix_dedup(spark, sf_dir):
    found = remove_long_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES |= {"op5_suffix_dedup": op5_suffix_dedup}


def op4_jaccard_join(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir))


QUERIES |= {"op4_jaccard_join": op4_jaccard_join}


def op1_decontamination(spark, sf_dir):
    return contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontamination": op1_decontamination} | QUERIES
