"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its byte n-grams of 3 to 6, with marks at both ends, and of itself, each hashed to an embedding; its vector is their
mean, a document's the mean over its distinct words and ``REST`` zero vectors, so a few words alone decide little (ASCII letters in
lower case).  In these means a subword weighs as surely as the training rows tell its classes apart: the log ratio of its shares in both, times the root of
how many rows have it, so the many subwords of one or two texts can't outweigh those that recur.  Embeddings and softmax are trained jointly in numpy, on all words of
the rows, by Adam with a floor under each parameter's rate (after Joulin et al., 2017), so an unseen misspelling shares most vectors with the word it comes from.  As the model is linear in the bag,
scoring needs one number a bucket: its weight times the embedding's part in the difference of the two logits.

A null or empty text scores as its bias alone; without labelled rows of both classes all scores are 0.5; very long texts are read whole; repeated
rows score alike, and so do any that tie; a null id is learned from by no label; other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.llm.labelled import ROWS_PER_CLASS, labelled_sample, remainder
from cueflow.llm.words import Piece, pieces, trim

BITS = 18
BUCKETS, WIDTH, REST, CARE = 1 << BITS, 4, 30, 1.25
#: The least a parameter's gradient counts for in its rate, as a share of the largest; and bytes of text whose subwords are worked on at once.
FLOOR, TRAIN_BYTES = 0.1, 250_000
#: Shares are kept in two bytes each, times this, which keeps all there can be well within their range.
SCALE = 1024
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def subwords(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The distinct words of a piece as bags: (buckets, bag of each), then the bag of every word occurrence, and the number of bags."""
    piece.words()
    piece.data = _LOWER[piece.data]
    words = piece.hashes()
    _, index, back = np.unique(words, return_index=True, return_inverse=True)
    start, length = piece.start[index], (piece.end - piece.start)[index]
    size = length + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    marked = np.zeros(begin[-1], np.uint8)
    at = np.repeat(np.arange(len(size)), length)
    within = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    marked[begin[:-1][at] + 1 + within] = piece.data[start[at] + within]
    marked[begin[:-1]], marked[begin[1:] - 1] = 0x01, 0x02
    of = np.repeat(np.arange(len(size), dtype=np.int32), size)
    left = np.repeat(begin[1:], size) - np.arange(len(marked))
    ids, bags = [(words[index] >> np.uint64(64 - BITS)).astype(np.int32)], [np.arange(len(size), dtype=np.int32)]
    code = np.zeros(len(marked), np.uint64)
    for n in range(6):
        if n:
            code = code[:-1]
        code = (code * np.uint64(0x100000001B3)) ^ (marked[n:].astype(np.uint64) + np.uint64(1))
        if n >= 2:
            fits = left[: len(code)] > n
            mixed = (code[fits] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
            ids.append(mixed.astype(np.int32))
            bags.append(of[: len(code)][fits])
    return np.concatenate(ids), np.concatenate(bags), back, len(size)


def bags_of(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents of a piece as bags of all their words: buckets, how much each is of the document's mean, and where each document begins."""
    ids, bags, words, n = subwords(piece)
    ids = ids[np.argsort(bags, kind="stable")]
    size = np.bincount(bags, minlength=n)
    key = np.unique(np.repeat(np.arange(piece.n), np.diff(piece.at)) * n + words)
    doc, word = key // max(n, 1), key % max(n, 1)
    own = size[word]
    at = np.repeat((np.cumsum(size) - size)[word] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))
    share = np.repeat(1 / (own * (np.bincount(doc, minlength=piece.n)[doc] + REST)), own)
    found, inverse = np.unique(np.repeat(doc, own) * BUCKETS + ids[at], return_inverse=True)
    return (found % BUCKETS).astype(np.int32), np.bincount(inverse, share, len(found)).astype(np.float32), np.searchsorted(found, np.arange(piece.n + 1) * BUCKETS)


class Rows:
    """The training rows as sparse rows of subwords, kept and multiplied a piece at a time."""

    def __init__(self, texts: Iterable[Piece]):
        self.parts, self.n = [], 0
        for piece in texts:
            ids, shares, at = bags_of(piece)
            self.parts.append((slice(self.n, self.n + piece.n), ids, (shares * SCALE).astype(np.float16), np.diff(at)))
            self.n += piece.n

    def having(self, labels: np.ndarray) -> np.ndarray:
        """How many rows of each class have a subword in each bucket."""
        out = np.zeros((2, BUCKETS))
        for rows, ids, _, sizes in self.parts:
            own = np.repeat(labels[rows], sizes)
            for k in (0, 1):
                out[k] += np.bincount(ids[own == k], minlength=BUCKETS)
        return out

    def weigh(self, weight: np.ndarray) -> None:
        for _, ids, shares, _ in self.parts:
            shares[:] = shares * weight[ids]

    def forward(self, table: np.ndarray) -> np.ndarray:
        out = np.empty((self.n, len(table)))
        for rows, ids, shares, sizes in self.parts:
            of = np.repeat(np.arange(len(sizes)), sizes)
            for k, vector in enumerate(table):
                out[rows, k] = np.bincount(of, vector[ids] * shares, len(sizes))
        return out / SCALE

    def backward(self, error: np.ndarray) -> np.ndarray:
        out = np.zeros((error.shape[1], BUCKETS))
        for rows, ids, shares, sizes in self.parts:
            for k in range(len(out)):
                out[k] += np.bincount(ids, np.repeat(error[rows, k], sizes) * shares, BUCKETS)
        return out / SCALE


def fit(texts: Iterable[Piece], labels: np.ndarray, rounds: int = 40, rate: float = 0.5, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """The part of each bucket in the difference of logits, and the bias.

    The classes weigh alike, but that a clean document taken for toxic counts as ``CARE`` misses.  The rate falls to zero.
    """
    if len(set(labels.tolist())) < 2:
        return np.zeros(BUCKETS), 0.0
    rows = Rows(texts)
    having, total = rows.having(labels), np.array([(labels == 0).sum(), (labels == 1).sum()])
    ratio = np.log((having[1] + 1) / (total[1] + 2)) - np.log((having[0] + 1) / (total[0] + 2))
    weight = (np.abs(ratio) * np.sqrt(having.sum(0))).astype(np.float32)
    rows.weigh(weight)
    rng = np.random.default_rng(11)
    params = [rng.normal(0, 0.1, (WIDTH, BUCKETS)) * (weight > 0), rng.normal(0, 0.5, (WIDTH, 2)), np.zeros(2)]
    table, soft, bias = params
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    mass = np.where(labels == 1, 1.0, CARE) * 0.5 / total[labels]
    one_hot = np.stack([labels == 0, labels == 1], 1).astype(float)
    for t in range(1, rounds + 1):
        hidden = rows.forward(table)
        logits = hidden @ soft + bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        error = (p - one_hot) * mass[:, None]
        grads = [rows.backward(error @ soft.T), hidden.T @ error, error.sum(0)]
        for k, (value, gradient) in enumerate(zip(params, grads)):
            gradient = gradient + decay * value * (k < 2)
            first[k] += 0.1 * (gradient - first[k])
            second[k] += 0.01 * (gradient**2 - second[k])
            size = np.sqrt(second[k] / (1 - 0.99**t))
            value -= rate * (1 - (t - 1) / rounds) * (first[k] / (1 - 0.9**t)) / (size + (FLOOR * size.max() if k == 0 else 0) + 1e-12)
    return (soft[:, 1] - soft[:, 0]) @ table * weight, float(bias[1] - bias[0])


def margins(piece: Piece, part: np.ndarray, bias: float) -> np.ndarray:
    """The difference of the two logits for each document of a piece."""
    ids, bags, words, n = subwords(piece)
    value = np.bincount(bags, part[ids], n) / np.maximum(np.bincount(bags, minlength=n), 1)
    key = np.unique(np.repeat(np.arange(piece.n), np.diff(piece.at)) * n + words)
    doc, word = key // max(n, 1), key % max(n, 1)
    return np.bincount(doc, value[word], piece.n) / (np.bincount(doc, minlength=piece.n) + REST) + bias


def trained(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS):
    """The broadcast (part, bias) of a model fitted on at most ``rows`` labelled documents a class.

    The sample's texts (see :mod:`cueflow.llm.labelled` for the bounds) go to the driver.
    """
    sample = labelled_sample(docs, labels, "toxic", remainder(F.col("doc_id"), 5) != 0, rows).toArrow()
    sample = sample.sort_by([(c, "ascending") for c in ("doc_id", "label", "text")])
    model = fit(pieces(sample["text"], TRAIN_BYTES), sample["label"].to_numpy())
    del sample
    trim()
    return docs.sparkSession.sparkContext.broadcast(model)


def probabilities(texts: pa.Array, model: tuple[np.ndarray, float]) -> np.ndarray:
    margin = np.concatenate([np.zeros(0), *(margins(piece, *model) for piece in pieces(texts))])
    return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.  Scoring is one scan without a shuffle, with the model, of fixed size, broadcast."""
    shared = trained(docs, labels, rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = probabilities(batch.column(2), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), docs["text"])
    return source.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame, rows: int = ROWS_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, in one scan."""
    shared, place = trained(docs, labels, rows), docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(probabilities(batch.column(place), shared.value) < 0.5))

    return docs.mapInArrow(clean, docs.schema)
