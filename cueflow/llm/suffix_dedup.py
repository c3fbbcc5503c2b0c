"""Removal of long repeated byte strings by the interval tree of an enhanced suffix array.

A byte goes when a 200-byte string that covers it also starts anywhere else.  The suffix array is sparse: of the 50-byte
strings in each 200-byte window, the one with the smallest hash (the leftmost of equals) is an anchor, about one position in 75, and two equal windows have
their anchor at the same place.  Anchors that repeat anywhere are gathered by their hash, each with the bytes around it that
a window can reach: 150 before and 200 from its start.  There the suffixes from the anchors are sorted, a stack scan over their common
prefixes gives the tree of intervals, and in each interval the occurrences are ordered by the bytes before the anchor, read
backwards: where neighbours differ, the common left extension ends.  So each interval yields its maximal repeats with all occurrences, and a repeat
of 200 bytes or more covers its bytes in every one of them.

A context that is found twice repeats as far as it goes, so of all equal contexts, wherever they are, one goes into the tree, and only for the sake of those
that are like it but not equal; copies and shared passages cost an anchor's two hashes each.  An anchor with more than ``HOT``
occurrences may still have more different contexts than a task should hold.  Their parts are split by a further hash of the bytes on either side
down to the tree's nodes of 200 bytes: each window of such an anchor is a node, named by its hash, and repeats if the node has two members, which the block exchange adds up.
Equal windows have the same anchor, so each is judged in one way or the other, and the union of the nodes of 200 bytes is that of all maximal repeats.
Texts are UTF-8 bytes; a null text is empty; matches never cross rows; ids may be of any type; rows that share a doc_id, or have none, are separate texts; repeated rows repeat
every string of theirs.  Other columns are not read; an empty table gives an empty result.  A task holds one block (about 6 MB, or one longer text) or the contexts of one
part of the hash space.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cueflow.llm.blocks import PACKED, REPLY, ask, by_block, by_part, dealt, exchange, heard, ordered, packed, ranges, replies, with_replies
from cueflow.llm.shared import materialise
from cueflow.llm.words import Prefix, mix, pieces, text_buffers

LENGTH, GRAM = 200, 50
BEFORE = LENGTH - GRAM
#: Occurrences of an anchor from which on its parts are split down to single windows.
HOT = 10_000
_SLICE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
_ODD_KEY, _ODD_CODE = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: What a block hears of a key or a context: it repeats; this block has it first; it is hot.
REPEATS, FIRST, IS_HOT = np.uint8(1), np.uint8(2), np.uint8(4)
CONTEXT = np.dtype([("key", np.uint64), ("left", np.uint16), ("right", np.uint16)])
MARK = np.dtype([("which", np.uint32), ("left", np.uint16), ("right", np.uint16)])
OUT = "n_bytes long, n_removed long, n_spans long, kept binary"


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values: of a prefix and a suffix minimum in blocks of ``width``."""
    n = len(values)
    filled = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    filled[:n] = values
    rows = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Anchors:
    """A block's anchors: place (byte in ``data``), doc, key, reach to either side, hash of the context, and the first and last
    start of the windows they are the anchor of."""

    def __init__(self, table: pa.Table):
        data, bounds = text_buffers(table["text"])
        self.data, self.bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
        found: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64)]
        for piece in pieces(table["text"]):
            base = int(self.bounds[piece.first])
            n = len(piece.data)
            ends = np.repeat(piece.bounds[1:], np.diff(piece.bounds)) if n else piece.bounds[:0]
            parts: list[tuple[np.ndarray, ...]] = []
            for low in range(0, max(n - LENGTH + 1, 0), _SLICE):
                high = min(n - LENGTH + 1, low + _SLICE)
                begin = max(low - BEFORE, 0)  # of the bytes that contexts of this slice reach
                hashes = Prefix(piece.data[begin : high + BEFORE + LENGTH])
                start = np.arange(low - begin, high + BEFORE - begin)
                code = hashes.ranges(start, start + GRAM)
                packed_ = (code & ~_PLACE) | (start - start[0]).astype(np.uint64)
                least = smallest(packed_, BEFORE + 1)
                windows = np.flatnonzero(np.arange(low, high) + LENGTH <= ends[low:high])
                at = (least[windows] & _PLACE).astype(np.int64) + low
                change = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
                at, opens = at[change], windows[change] + low
                first = piece.bounds[np.searchsorted(piece.bounds, at, side="right") - 1]
                left, right = np.minimum(BEFORE, at - first), np.minimum(LENGTH, ends[at] - at)
                own = at - begin
                # as anchors have small hashes, keys need others
                key = mix(hashes.ranges(own, own + GRAM) ^ _ODD_KEY)
                parts.append((at, opens, key, hashes.ranges(own - left, own + right) ^ (left.astype(np.uint64) << np.uint64(8))))
            if not parts:
                continue
            at, opens, key, code = (np.concatenate([p[k] for p in parts]) for k in range(4))
            change = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
            at, opens = at[change], opens[change]
            # an anchor's windows end before the next one's begin, or with its document
            closes = np.minimum(np.append(opens[1:], n) - 1, ends[at] - LENGTH) if len(at) else at
            for k, column in enumerate((at + base, key[change], code[change], opens + base, closes + base)):
                found[k].append(column)
        self.place, self.key, self.code, self.opens, self.closes = map(np.concatenate, found)
        self.doc = np.searchsorted(self.bounds, self.place, side="right") - 1
        self.left = np.minimum(BEFORE, self.place - self.bounds[self.doc])
        self.right = np.minimum(LENGTH, self.bounds[self.doc + 1] - self.place)

    def asked(self) -> np.ndarray:
        """The keys, then the hashes of the whole contexts."""
        return np.concatenate([self.key, mix(self.code ^ self.key ^ _ODD_CODE)])

    def hear(self, back: pa.Table, bits: int) -> None:
        """Sets which anchors' contexts are ``whole`` repeats, which go into the ``tree``, and which are ``hot`` and go by windows."""
        distinct, inverse = np.unique(self.asked(), return_inverse=True)
        of_key, of_context = np.split(heard(back, 1, distinct, bits)[inverse], 2)
        self.whole = of_context & REPEATS > 0
        sent = (of_key & REPEATS > 0) & (of_context & FIRST > 0)
        self.hot = np.flatnonzero(sent & (of_key & IS_HOT > 0))
        tree = np.flatnonzero(sent & (of_key & IS_HOT == 0))
        # a first context that its block has twice is sent once
        order = tree[np.lexsort([self.code[tree], self.key[tree]])]
        new = np.ones(len(order), bool)
        new[1:] = (self.key[order[1:]] != self.key[order[:-1]]) | (self.code[order[1:]] != self.code[order[:-1]])
        self.tree = order[new]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of hot anchors."""
        use = self.hot
        starts, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for low in range(0, len(use), 20_000):
            some = use[low : low + 20_000]
            size = self.closes[some] - self.opens[some] + 1
            begin = np.cumsum(size) - size
            start = np.repeat(self.opens[some] - begin, size) + np.arange(int(size.sum()))
            for first in range(0, len(start), 5_000):
                own = start[first : first + 5_000]
                if len(own):
                    hashes = Prefix(self.data[own[0] : own[-1] + LENGTH]) if own[-1] - own[0] < _SLICE else None
                    if hashes is None:
                        rows = Prefix(self.data[(own[:, None] + np.arange(LENGTH)).ravel()])
                        at = np.arange(len(own)) * LENGTH
                        code = rows.ranges(at, at + LENGTH)
                    else:
                        code = hashes.ranges(own - own[0], own - own[0] + LENGTH)
                    codes.append(mix(code ^ _ODD_KEY))
                    starts.append(own)
        return np.concatenate(starts), np.concatenate(codes)

    def around(self, which: np.ndarray) -> np.ndarray:
        """The bytes of some contexts, one after another."""
        size = self.left[which] + self.right[which]
        begin = np.cumsum(size) - size
        return self.data[np.repeat(self.place[which] - self.left[which] - begin, size) + np.arange(int(size.sum()))]


def agreement(rows: np.ndarray, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of pairs of rows, each at most ``most``."""
    out = np.zeros(len(one), np.int64)
    for low in range(0, len(one), 20_000):
        s = slice(low, low + 20_000)
        differ = rows[one[s]] != rows[two[s]]
        first = differ.argmax(axis=1)
        out[s] = np.where(differ[np.arange(len(first)), first], first, rows.shape[1])
    return np.minimum(out, most)


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the intervals of a suffix array, from the common prefix of each suffix with the one before.

    One scan with a stack; depths below an anchor's length end all open intervals.
    """
    stack: list[tuple[int, int]] = []
    for i in range(1, len(common) + 1):
        depth = common[i] if i < len(common) else 0
        first = i - 1
        while stack and stack[-1][0] > depth:
            at, first = stack.pop()
            yield at, first, i - 1
        if depth >= GRAM and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeats_around(right_rows: np.ndarray, left_rows: np.ndarray, right: np.ndarray, left: np.ndarray, chunk: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(context, left, right) triples: bytes from ``left`` before to ``right`` after the anchor repeat elsewhere, 200 or more."""
    n = len(right)
    array = np.argsort(right_rows.view(f"S{LENGTH}").ravel(), kind="stable")
    common = np.zeros(n, np.int64)
    if n > 1:
        common[1:] = agreement(right_rows, array[1:], array[:-1], np.minimum(right[array[1:]], right[array[:-1]]))
    rank = np.empty(n, np.int64)
    rank[np.argsort(left_rows.view(f"S{BEFORE}").ravel(), kind="stable")] = np.arange(n)
    pending: list[tuple[int, int, int]] = []
    held = 0

    def resolve() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        depth, first, last = np.array(pending, np.int64).T
        size = last - first + 1
        of = np.repeat(np.arange(len(size)), size)
        member = array[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(len(of))]
        order = np.lexsort([rank[member], of])
        member = member[order]
        same = of[1:] == of[:-1]
        near = np.zeros(len(of) + 1, np.int64)
        at = np.flatnonzero(same)
        near[at + 1] = agreement(left_rows, member[at], member[at + 1], np.minimum(left[member[at]], left[member[at + 1]]))
        reach, deep = np.maximum(near[:-1], near[1:]), depth[of]
        hit = reach + deep >= LENGTH
        return member[hit], reach[hit], deep[hit]

    for found in intervals(common.tolist()):
        pending.append(found)
        held += found[2] - found[1] + 1
        if held >= chunk:
            yield resolve()
            pending, held = [], 0
    if pending:
        yield resolve()


def answer_repeats(table: pa.Table) -> pa.Table:
    """For each block, which of its contexts repeat, and how far to either side."""
    heads = [np.frombuffer(v, CONTEXT) for v in table["a"].to_pylist()]
    head = np.concatenate(heads)
    left, right = head["left"].astype(np.int64), head["right"].astype(np.int64)
    text = np.frombuffer(b"".join(table["b"].to_pylist()), np.uint8)
    anchor = np.cumsum(left + right) - right
    n = len(head)
    right_rows, left_rows = np.zeros((n, LENGTH), np.uint8), np.zeros((n, BEFORE), np.uint8)
    for rows, size, sign in ((right_rows, right, 1), (left_rows, left, -1)):
        at = np.arange(rows.shape[1])
        for low in range(0, n, 20_000):
            s = slice(low, low + 20_000)
            inside = at < size[s, None]
            place = anchor[s, None] + (at if sign > 0 else -1 - at)
            rows[s][inside] = text[place[inside]]
    # all repeats of a context hold its anchor, so together they cover from the furthest left to the furthest right
    far_left, far_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for member, reach, deep in repeats_around(right_rows, left_rows, right, left):
        np.maximum.at(far_left, member, reach)
        np.maximum.at(far_right, member, deep)
    rows, base = [], 0
    for block, part, own in zip(table["block"].to_pylist(), table["part"].to_pylist(), heads):
        which = np.flatnonzero(far_right[base : base + len(own)])
        out = np.empty(len(which), MARK)
        out["which"], out["left"], out["right"] = which, far_left[base + which], far_right[base + which]
        rows.append((block, part, 2, out.tobytes(), None))
        base += len(own)
    return replies(rows)


def remove_long_repeats(docs: DataFrame, carry: Sequence[str] = (), as_text: bool = False, hot: int = HOT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (the bytes left), and, if columns are to be carried along, ``carried`` with them.

    ``as_text``: kept is a string, without the characters that a removal cut in two.
    """
    deal = dealt(docs, carry)
    blocks, more = deal.frame, ["carried"] if carry else []
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, {OUT.replace('binary', 'string') if as_text else OUT}" + "".join(f", {c} {blocks.schema[c].dataType.simpleString()}" for c in more)
    # an anchor of about 75 bytes has two hashes, counts, and at most 350 bytes of context
    bits, context_bits, window_bits = deal.bits(0.35 * deal.total), deal.bits(8.0 * deal.total), deal.bits(deal.total)

    def verdict(total: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.where(total > 1, REPEATS, 0) | np.where(first, FIRST, 0) | np.where(total > hot, IS_HOT, 0)

    def send_anchors(block: int, table: pa.Table) -> pa.Table:
        return ask(block, Anchors(table).asked(), bits)

    def send_contexts(block: int, table: pa.Table, back: pa.Table) -> pa.Table:
        anchors = Anchors(ordered(table))
        anchors.hear(back, bits)
        rows = []
        for p, i, j in ranges(anchors.key[anchors.tree], context_bits):
            own = anchors.tree[i:j]
            head = np.empty(j - i, CONTEXT)
            head["key"], head["left"], head["right"] = anchors.key[own], anchors.left[own], anchors.right[own]
            rows.append((p, block, head.tobytes(), anchors.around(own).tobytes(), b"tree"))
        return pa.concat_tables([packed(rows), ask(block, anchors.windows()[1], window_bits)])

    def cut(block: int, table: pa.Table, back: pa.Table) -> pa.Table:
        table = ordered(table)
        anchors = Anchors(table)
        anchors.hear(back, bits)
        own = {p: v for p, k, v in zip(back["part"].to_pylist(), back["kind"].to_pylist(), back["a"].to_pylist()) if k == 2}
        whole = np.flatnonzero(anchors.whole)
        which, reach, deep = [whole], [anchors.left[whole]], [anchors.right[whole]]
        for p, i, j in ranges(anchors.key[anchors.tree], context_bits):
            mark = np.frombuffer(own[p], MARK)
            which.append(anchors.tree[mark["which"].astype(np.int64) + i])
            reach.append(mark["left"].astype(np.int64))
            deep.append(mark["right"].astype(np.int64))
        which, reach, deep = np.concatenate(which), np.concatenate(reach), np.concatenate(deep)
        depth = np.zeros(len(anchors.data) + 1, np.int32)
        np.add.at(depth, anchors.place[which] - reach, 1)
        np.add.at(depth, anchors.place[which] + deep, -1)
        starts, codes = anchors.windows()
        distinct, inverse = np.unique(codes, return_inverse=True)
        again = starts[(heard(back, 3, distinct, window_bits) > 0)[inverse]]
        np.add.at(depth, again, 1)
        np.add.at(depth, again + LENGTH, -1)
        gone = np.zeros(len(anchors.data) + 1, bool)
        gone[:-1] = np.cumsum(depth[:-1], out=depth[:-1]) > 0
        starts = gone[:-1].copy()
        starts[1:] &= ~gone[:-2]
        inner = anchors.bounds[:-1][np.diff(anchors.bounds) > 0]
        starts[inner] = gone[inner]
        total, runs = np.concatenate([[0], np.cumsum(gone[:-1])]), np.concatenate([[0], np.cumsum(starts)])
        removed, spans = np.diff(total[anchors.bounds]), np.diff(runs[anchors.bounds])
        left = anchors.data[~gone[:-1]]
        stays = np.concatenate([[0], np.cumsum(np.diff(anchors.bounds) - removed)])
        kept = pa.Array.from_buffers(pa.large_binary(), len(removed), [None, pa.py_buffer(stays.astype(np.int64)), pa.py_buffer(left)]).cast(pa.binary())
        if as_text:
            kept = pa.array([v.decode("utf-8", "ignore") for v in kept.to_pylist()], pa.string())
        columns = [table["doc_id"], pa.array(np.diff(anchors.bounds)), pa.array(removed), pa.array(spans), kept, *(table[c] for c in more)]
        return pa.table(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *more])

    repeated = exchange(by_block(blocks, send_anchors, PACKED), bits, verdict)
    sent = materialise(with_replies(blocks, repeated, send_contexts, PACKED), "contexts")
    marks = by_part(sent.filter("c IS NOT NULL"), answer_repeats)
    windows = exchange(sent.filter("c IS NULL"), window_bits, lambda total, first: total > 1, kind=3)
    return with_replies(blocks, repeated.unionByName(marks).unionByName(windows), cut, out)
