"""The bounded sample of labelled rows that a classifier is fitted on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the sample, a class: its rows, and the bytes of their texts together.  They bound the driver's memory; a text of any length
#: can be in it, whole, and scoring has no bound.
ROWS_PER_CLASS = 2000
SAMPLE_BYTES = 16_000_000


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key written as text, modulo ``modulus``: which fold a row is in."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = ROWS_PER_CLASS, size: int = SAMPLE_BYTES) -> DataFrame:
    """Whole texts of at most ``rows`` labelled documents and ``size`` bytes a class, as (doc_id, label, text).

    Rows are taken in the order of a hash of the key, so reruns agree; ``allowed`` says over ``labels`` which rows may be learned
    from.  The ids, ``2 * rows`` at most, are broadcast to the scan of the documents.  The bounds hold for what that finds, as documents may repeat an id.
    """
    own = labels.filter(allowed & labels["doc_id"].isNotNull() & labels[label].isin(0, 1))
    own = own.select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    picked = [own.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in (0, 1)]
    few = F.broadcast(picked[0].unionByName(picked[1]))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(few, "doc_id")
    by = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    first = texts.withColumn("nth", F.row_number().over(by)).filter(F.col("nth") <= rows)
    bytes_so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("label").orderBy("nth"))
    return first.withColumn("bytes", bytes_so_far).filter(F.col("bytes") <= size).select("doc_id", "label", "text")


def logistic(margin: np.ndarray, target: np.ndarray, mass: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit by Newton steps, the slope lightly held at 2."""
    slope, shift = 2.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + shift, -500, 500)))
        e, v = mass * (p - target), mass * p * (1 - p)
        g = np.array([e @ margin + slope - 2, e.sum()])
        h = np.array([[v @ margin**2 + 1.0, v @ margin], [v @ margin, v.sum() + 1e-6]])
        d = np.clip(np.linalg.solve(h, g), -5, 5)
        slope, shift = slope - d[0], shift - d[1]
        if np.abs(d).max() < 1e-8:
            break
    return slope, shift
