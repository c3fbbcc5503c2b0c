"""Quality classifier: a linear hinge-loss model over n-gram indicators scaled by class log-count ratios.

Features are the distinct words, word pairs and byte triples of a whole text, hashed into ``DIMENSIONS`` indicators.
Each is scaled by its log-count ratio between the classes (naive Bayes), rows are brought to about unit length, and dual coordinate descent fits
the linear model, without a constant, so that no evidence decides nothing (Wang and Manning, 2012; Hsieh et al., 2008).  A logistic curve turns its margin into a probability.

A null or empty text has no features and gets the score of a zero margin; without rows of both classes all scores are
0.5; very long texts are read whole; repeated rows score alike; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.llm.labelled import ROWS_PER_CLASS, labelled_sample, logistic, remainder
from cueflow.llm.words import Piece, pieces

DIMENSIONS = 1 << 16
#: Added to a row's squared length, so that a few features alone decide little.
REST = 200.0


def features(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each document of a piece: their ids, in order of document, and where each begins."""
    piece.words()
    words, data = piece.hashes(), piece.data
    pairs, fits = piece.windows(words, 2)
    owner = np.repeat(np.arange(piece.n), np.diff(piece.at))
    top = np.uint64(48)
    keys = [owner << 16 | (words >> top).astype(np.int64), owner[fits] << 16 | (pairs[fits] >> top).astype(np.int64)]
    if len(data) >= 3:
        code = data[:-2].astype(np.uint32) << np.uint32(16) | data[1:-1].astype(np.uint32) << np.uint32(8) | data[2:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
        of = np.repeat(np.arange(piece.n), np.diff(piece.bounds))
        keys.append((of[:-2] << 16 | code.astype(np.int64))[of[:-2] == of[2:]])
    found = np.sort(np.concatenate(keys))
    found = found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found
    return (found & 0xFFFF).astype(np.uint16), np.searchsorted(found, np.arange(piece.n + 1) << 16)


def fit(rows: list[np.ndarray], labels: np.ndarray, odds: float = 1.0, penalty: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float, float]:
    """Scaled weights per feature (ratio times weight), the ratios' squares, and the logistic curve's slope and shift.

    ``odds`` are those of label 1 among all rows that may be learned from; the sample has as many of either.
    """
    zero = np.zeros(DIMENSIONS)
    if len(set(labels.tolist())) < 2:
        return np.stack([zero, zero]), 0.0, 0.0
    counts = np.ones((2, DIMENSIONS))
    for row, label in zip(rows, labels):
        counts[label, row] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    sign = np.where(labels == 1, 1.0, -1.0)
    scaled = [ratio[row] / np.sqrt((ratio[row] ** 2).sum() + REST) for row in rows]
    weight, alpha = np.zeros(DIMENSIONS), np.zeros(len(rows))
    order, rng = np.arange(len(rows)), np.random.default_rng(7)
    share = np.array([(labels == 0).mean(), (labels == 1).mean()])
    bound = penalty * 0.5 / share[labels]  # the rarer class weighs more
    for _ in range(rounds):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            if not len(rows[i]):
                continue
            gradient = sign[i] * (weight[rows[i]] @ scaled[i]) - 1
            new = min(max(alpha[i] - gradient, 0.0), bound[i])  # rows are of unit length at most
            if (step := (new - alpha[i]) * sign[i]) != 0:
                weight[rows[i]] += step * scaled[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    margin = np.array([weight[r] @ s for r, s in zip(rows, scaled)])
    slope, shift = logistic(margin, labels.astype(float), 1 / share[labels])
    return np.stack([weight * ratio, ratio**2]), slope, shift + np.log(odds)


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.  Fitted on at most ``rows`` labelled documents a class.

    One scan gathers the sample's features (at most 128 KB a row), one scores; neither shuffles a text.  The model, of fixed size, is broadcast.
    """
    spark = docs.sparkSession

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for piece in pieces(batch.column(2)):
                ids, at = features(piece)
                lists += [ids[at[i] : at[i + 1]].tobytes() for i in range(piece.n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.binary())], ["doc_id", "label", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    allowed = remainder(F.col("doc_id"), 3) != 1
    sample = labelled_sample(docs, labels, "quality", allowed, rows)
    got = sorted(sample.mapInArrow(collect, f"doc_id {kind}, label int, ids binary").collect(), key=lambda r: (r["doc_id"], r["label"], bytes(r["ids"])))
    share = labels.filter(allowed).agg(F.sum(F.col("quality").isin(1).cast("int")), F.sum(F.col("quality").isin(0).cast("int"))).first()
    odds = (share[0] or 1) / (share[1] or 1)
    table, slope, shift = fit([np.frombuffer(r["ids"], np.uint16) for r in got], np.array([r["label"] for r in got], dtype=int), odds)
    shared = spark.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, squares = shared.value
        for batch in batches:
            out = [np.zeros(0)]
            for piece in pieces(batch.column(2)):
                ids, at = features(piece)
                sums = [np.concatenate([[0.0], np.cumsum(v[ids])])[at] for v in (weight, squares)]
                margin = np.diff(sums[0]) / np.sqrt(np.maximum(np.diff(sums[1]), 0) + REST)
                out.append(1 / (1 + np.exp(-(slope * margin + shift))))
            p = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    source = docs.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), docs["text"])
    return source.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
