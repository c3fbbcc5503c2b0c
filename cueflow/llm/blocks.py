"""Exchange of keys between blocks of documents.

Documents are dealt to blocks by a hash of their id and text; a block is some megabytes of text, worked on whole by one task.  To learn
something about its keys (64-bit hashes) from all blocks, a block sends each part of the key space one packed row with its
distinct keys, in order, and how often it has each.  Whoever gathers a part adds up, and answers each block with a byte a key in the same order; since
the block's next pass finds the same distinct keys again, no key travels back.

A part is a key's leading bits.  How many bits follows from how much is sent, not from the number of blocks, and a sender
never splits its keys by more than ``FAN_BITS`` of them at once: beyond that, a part's rows first meet in relays, each of which adds up the keys of some of the blocks,
asks on by the next bits as if it were a block, and hands the answers back.  So rows grow in proportion to the blocks, however many
there are, and each stays some hundred bytes long or more.

A key reaches its part at most once from each block, however many documents share it: a hot key costs what any other costs.  Spark
sees packed rows instead of one row a key, shuffled by ``part`` and by ``block``, and can redo any lost task, as all
passes depend on a block's contents only, not on the order of its rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.llm.words import Piece, pieces, trim

#: Text in a block, on average; keys that one part gathers; and the bits by which a sender splits its keys at most.
BLOCK_BYTES = 6_000_000
PART_BYTES = 16_000_000
FAN_BITS = 11
PACKED = "part long, block long, a binary, b binary, c binary"
REPLY = "block long, part long, kind int, a binary, b binary"

#: Of each key: the byte to answer, from how often all blocks have it, and whether the asking block has it first.
Verdict = Callable[[np.ndarray, np.ndarray], np.ndarray]


@dataclass
class Dealt:
    """``frame`` (doc_id, text, block, and what is carried along), shuffled once by block; the bytes of all texts, and the partitions of shuffles."""

    frame: DataFrame
    total: int
    partitions: int

    def bits(self, size: float) -> int:
        """Bits of the key space for parts of ``PART_BYTES``, if all blocks send ``size`` bytes, and a part a partition at least."""
        return max(1, math.ceil(math.log2(max(size / PART_BYTES, self.partitions))))


def dealt(docs: DataFrame, carry: Sequence[str] = (), place: str | None = None) -> Dealt:
    """Deals documents to blocks.  Columns to carry along are fields of ``carried``; ``place`` is a column of its own."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(math.ceil(total / BLOCK_BYTES), partitions)))
    more = ([F.struct(*carry).alias("carried")] if carry else []) + ([F.col(place).alias("place")] if place else [])
    return Dealt(docs.select("doc_id", F.col("text").cast("string").alias("text"), block.alias("block"), *more), total, partitions)


def ranges(keys: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of the parts that sorted keys fall in."""
    if len(keys):
        part = keys >> np.uint64(64 - bits)
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            yield int(part[i]), i, j


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.table([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields])


def packed(rows: list[tuple]) -> pa.Table:
    return _table(rows, PACKED)


def replies(rows: list[tuple]) -> pa.Table:
    return _table(rows, REPLY)


def ordered(table: pa.Table, by: str = "doc_id") -> pa.Table:
    """The block's rows by doc_id, null last; rows that share an id by text, null last."""
    return table.take(pc.sort_indices(table, sort_keys=[(by, "ascending"), ("text", "ascending")]))


def ask(block: int, keys: np.ndarray, bits: int, counts: np.ndarray | None = None, order: np.ndarray | None = None, fan: int = FAN_BITS) -> pa.Table:
    """A block's keys, on their way to the parts.

    With ``counts`` they are sorted and distinct.  ``order`` says which block has a key first, the smallest; else the block's number does.
    """
    if counts is None:
        keys, counts = np.unique(keys, return_counts=True)
    bits, counts = min(bits, fan), np.minimum(counts, 2**32 - 1).astype(np.uint32)
    return packed([(p, block, keys[i:j].tobytes(), counts[i:j].tobytes(), None if order is None else order[i:j].tobytes()) for p, i, j in ranges(keys, bits)])


class _Sum:
    """The rows of one part, or of one relay, added up by key."""

    def __init__(self, table: pa.Table):
        table = table.take(pc.sort_indices(table["block"]))
        self.blocks, self.parts = table["block"].to_pylist(), table["part"].to_pylist()
        keys = [np.frombuffer(v, np.uint64) for v in table["a"].to_pylist()]
        self.sizes = np.array([len(k) for k in keys])
        own, order, who = table["c"].to_pylist(), [], []
        for block, n, c in zip(self.blocks, self.sizes.tolist(), own):
            # a relay says for each key which block has it first; a block speaks for itself
            both = np.frombuffer(c, np.int64) if c is not None else np.full(n, block)
            order.append(both[:n])
            who.append(both[n:] if len(both) > n else np.full(n, block))
        key, counts = np.concatenate(keys), np.frombuffer(b"".join(table["b"].to_pylist()), np.uint32)
        self.order, self.who = np.concatenate(order), np.concatenate(who)
        # rows are in order of their blocks, so a stable sort keeps that order where nothing else is said
        by = np.argsort(key, kind="stable") if all(c is None for c in own) else np.lexsort([self.who, self.order, key])
        new = np.ones(len(key), bool)
        new[1:] = key[by[1:]] != key[by[:-1]]
        at = np.flatnonzero(new)
        self.keys, self.totals = key[by[at]], np.add.reduceat(counts[by].astype(np.int64), at)
        self.first = np.stack([self.order[by[at]], self.who[by[at]]])
        self.group = np.empty(len(key), np.int64)
        self.group[by] = np.cumsum(new) - 1

    def answers(self, verdict: Verdict | None, totals: np.ndarray, first: np.ndarray, kind: int) -> pa.Table:
        """What each sender hears of its keys; without a verdict, the sum itself and who is first."""
        cuts = np.cumsum(self.sizes)[:-1]
        if verdict is None:
            values = np.split(totals[self.group], cuts)
            firsts = [np.split(f[self.group], cuts) for f in first]
            rows = [(b, p, kind, v.tobytes(), np.concatenate([o, w]).tobytes()) for b, p, v, o, w in zip(self.blocks, self.parts, values, *firsts)]
        else:
            mine = (first[0][self.group] == self.order) & (first[1][self.group] == self.who)
            said = verdict(totals[self.group], mine).astype(np.uint8)
            rows = [(b, p, kind, v.tobytes(), None) for b, p, v in zip(self.blocks, self.parts, np.split(said, cuts))]
        return replies(rows)


def exchange(sent: DataFrame, bits: int, verdict: Verdict | None, kind: int = 1, fan: int = FAN_BITS, split: int | None = None) -> DataFrame:
    """The answers to what blocks :func:`ask`; ``split`` is by how many bits the rows' keys have been split so far."""
    split = min(bits, fan) if split is None else split

    def answer(table: pa.Table) -> pa.Table:
        own = _Sum(table)
        return own.answers(verdict, own.totals, own.first, kind)

    if split >= bits:
        return by_part(sent, answer)
    further = min(bits, split + fan)
    relays = 1 << (bits - split)
    met = sent.withColumn("relay", F.col("part") * relays + F.pmod(F.xxhash64("block"), F.lit(relays)))

    def ask_on(table: pa.Table) -> pa.Table:
        own = _Sum(table)
        relay = table["relay"][0].as_py()
        return packed([(p, relay, own.keys[i:j].tobytes(), np.minimum(own.totals[i:j], 2**32 - 1).astype(np.uint32).tobytes(), own.first[:, i:j].tobytes()) for p, i, j in ranges(own.keys, further)])

    def hand_back(table: pa.Table, back: pa.Table) -> pa.Table:
        own = _Sum(table)
        totals, first = np.zeros(len(own.keys), np.int64), np.zeros((2, len(own.keys)), np.int64)
        said = {p: (a, b) for p, a, b in zip(back["part"].to_pylist(), back["a"].to_pylist(), back["b"].to_pylist())}
        for p, i, j in ranges(own.keys, further):
            totals[i:j] = np.frombuffer(said[p][0], np.int64)
            first[:, i:j] = np.frombuffer(said[p][1], np.int64).reshape(2, -1)
        return own.answers(verdict, totals, first, kind)

    heard_on = exchange(met.groupBy("relay").applyInArrow(ask_on, PACKED), bits, None, kind, fan, further)
    return met.groupBy("relay").cogroup(heard_on.groupBy("block")).applyInArrow(hand_back, REPLY)


def heard(table: pa.Table, kind: int, keys: np.ndarray, bits: int, fan: int = FAN_BITS) -> np.ndarray:
    """The bytes that came back for sorted distinct keys."""
    out = np.zeros(len(keys), np.uint8)
    own = {p: v for p, k, v in zip(table["part"].to_pylist(), table["kind"].to_pylist(), table["a"].to_pylist()) if k == kind}
    for p, i, j in ranges(keys, min(bits, fan)):
        out[i:j] = np.frombuffer(own[p], np.uint8)
    return out


def by_block(docs: DataFrame, function: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    return docs.groupBy("block").applyInArrow(lambda table: _then_trim(function(table["block"][0].as_py(), table)), schema)


def with_replies(docs: DataFrame, answers: DataFrame, function: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Each block's documents with the answers to it; a block without documents asked nothing."""
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda own, back: _then_trim(function(own["block"][0].as_py(), own, back)), schema)


def by_part(sent: DataFrame, function: Callable[[pa.Table], pa.Table], schema: str = REPLY) -> DataFrame:
    return sent.groupBy("part").applyInArrow(lambda table: _then_trim(function(table)), schema)


def _then_trim(result: pa.Table) -> pa.Table:
    trim()
    return result


class BlockWords:
    """The words of a block's documents: hash, bytes (within ``data``) and, at ``at``, where each document begins."""

    def __init__(self, table: pa.Table, lower: bool = False):
        found, starts, ends, counts, shift = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for piece in pieces(table["text"]):
            piece.words()
            if lower:
                upper = (piece.data >= 65) & (piece.data <= 90)
                piece.data = piece.data + upper.astype(np.uint8) * np.uint8(32)
            found.append(piece.hashes())
            starts.append(piece.start + shift)
            ends.append(piece.end + shift)
            counts.append(np.diff(piece.at))
            shift += len(piece.data)
        self.hashes, self.start, self.end = np.concatenate(found), np.concatenate(starts), np.concatenate(ends)
        self.counts = np.concatenate(counts)
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
        self.n = len(self.counts)
        self.doc = np.repeat(np.arange(self.n), self.counts)
        self.index = np.arange(len(self.hashes)) - self.at[self.doc]

    windows = Piece.windows
