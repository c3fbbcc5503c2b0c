"""Removal of repeated word windows, found from difference-cover anchors.

A window of 20 words goes when the same words also start earlier (smaller doc_id, or earlier in the document).  Anchors are
runs of 8 words, hashed only at positions that lie, modulo 13, in the cover {0, 1, 3, 9}.  As every difference modulo 13
is one of two members of the cover, two equal windows anywhere have some offset from 0 to 12 at which both are at a cover
position, and the anchor there lies within the windows.  So a window none of whose anchors repeats cannot repeat, and less than a third of the
positions are exchanged.  The other windows extend their anchors to the full 20 words and are compared whole; the first of equals stays.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A null or empty text has no words.  Ids may be numbers or strings, which are ranked first.  Rows that share
a doc_id, or have none and so come last, are spread like any others; they count as in the order of their blocks, and within a block of their texts, which reruns repeat.
Other columns are not read; an empty table gives an empty result.  A task holds one block of documents (about 6 MB, or one longer text), whatever repeats in it.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.llm.blocks import PACKED, BlockWords, ask, by_block, dealt, exchange, heard, ordered, with_replies
from cueflow.llm.shared import ranked
from cueflow.llm.words import text_buffers

#: Words in a window, and the cover's period and members; the anchor is as long as any offset leaves within a window.
WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
_LAST = np.int64(2**63 - 1)
OUT = "n_words long, n_removed long, kept_text string"


def anchors(words: BlockWords) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the block's anchors, and their hashes."""
    cover = np.zeros(PERIOD, bool)
    cover[list(COVER)] = True
    code, fits = words.windows(words.hashes, ANCHOR)
    at = np.flatnonzero(fits & cover[words.index % PERIOD])
    return at, code[at]


def candidates(words: BlockWords, back: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the windows that hold a repeated anchor, and their hashes."""
    at, code = anchors(words)
    distinct, inverse = np.unique(code, return_inverse=True)
    repeated = np.zeros(len(words.hashes) + 1, np.int64)
    repeated[1:][at] = heard(back, 1, distinct, bits)[inverse]
    total = np.cumsum(repeated)
    whole, fits = words.windows(words.hashes, WINDOW)
    starts = np.flatnonzero(fits)
    starts = starts[total[starts + PERIOD] > total[starts]]
    return starts, whole[starts]


def placed(docs: DataFrame) -> DataFrame:
    """Adds ``_place``: a whole number in the order of doc_id; null for null, which comes last."""
    if docs.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long"):
        return docs.select("doc_id", "text", F.col("doc_id").cast("long").alias("_place"))
    ranks = ranked(docs.select(F.col("doc_id").alias("_id")).filter("_id IS NOT NULL").distinct(), "_id")
    return docs.select("doc_id", "text").join(ranks, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", F.col("rank").alias("_place"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_text (the words left, joined by one space)."""
    deal = dealt(placed(docs), place="_place")
    blocks = deal.frame
    # of an anchor, its hash for about a third of the words of six bytes each; of a window, hash and owner
    bits, window_bits = deal.bits(0.4 * deal.total), deal.bits(deal.total)

    def send_anchors(block: int, table: pa.Table) -> pa.Table:
        return ask(block, anchors(BlockWords(table))[1], bits)

    def send_windows(block: int, table: pa.Table, back: pa.Table) -> pa.Table:
        table = ordered(table, "place")
        words = BlockWords(table)
        starts, code = candidates(words, back, bits)
        distinct, first, counts = np.unique(code, return_index=True, return_counts=True)
        place = table["place"].fill_null(int(_LAST)).to_numpy()
        return ask(block, distinct, window_bits, counts, place[words.doc[starts[first]]])

    def cut(block: int, table: pa.Table, back: pa.Table) -> pa.Table:
        table = ordered(table, "place")
        words = BlockWords(table)
        starts, code = candidates(words, back, bits)
        distinct, first, inverse = np.unique(code, return_index=True, return_inverse=True)
        goes = (heard(back, 2, distinct, window_bits) > 0)[inverse] | (first[inverse] != np.arange(len(starts)))
        depth = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(depth, starts[goes], 1)
        np.add.at(depth, starts[goes] + WINDOW, -1)
        stays = np.cumsum(depth[:-1]) == 0
        left = np.concatenate([[0], np.cumsum(stays)])
        removed = words.counts - (left[words.at[1:]] - left[words.at[:-1]])
        data, bounds = text_buffers(table["text"])
        kept = []
        for i in range(words.n):
            own = data[bounds[i] : bounds[i + 1]].tobytes().split()
            kept.append(b" ".join(compress(own, stays[words.at[i] : words.at[i + 1]].tolist()) if removed[i] else own))
        return pa.table([table["doc_id"], pa.array(words.counts), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    repeated = exchange(by_block(blocks, send_anchors, PACKED), bits, lambda total, first: total > 1)
    later = exchange(with_replies(blocks, repeated, send_windows, PACKED), window_bits, lambda total, first: ~first, kind=2)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_replies(blocks, repeated.unionByName(later), cut, f"doc_id {kind}, {OUT}")
