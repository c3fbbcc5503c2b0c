"""Benchmark decontamination: a BM25 index of the test items, searched with every passage of the training texts.

The index holds, for each term, the items with it and their impacts, in blocks with the largest impact of each.  Impacts are BM25
weights over the score of the item against itself, so a passage that holds all of an item scores 1 whatever its length.  Each
passage is a query; block-max WAND (Ding and Suel, 2011) returns every item that scores enough.  As nearly all passages
reach no item, the bounds are first taken for many passages at once: the largest impacts of a passage's terms are summed for each block of items, with the
most common terms counted as if all were there, and only in the blocks where that is enough for some item the items' own impacts.  Passages in which
some item's sum may be enough are searched one by one, so none is lost.

An item's question and answer (what follows its last question mark, else its last third) must then each have
``OVERLAP`` of their 3-word shingles in the passage.  That alone decides: the score that is enough is each item's own, the least that a
passage with both shares can have (``Index.least``), so the index misses no passage that the shingles would match.

Words are runs of letters and digits in lower case; passages are twice as long as the longest item (128 words at least) and
advance by half, so each item's length lies whole in some passage.  Whole texts are read.  A null or empty text, or item, matches nothing;
repeated rows and items each match; items that tie are all returned; other columns are not read; an empty table gives an empty result.
The index is broadcast in shards of at most ``SHARD_BYTES`` of item text, each with the statistics of all items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.llm.words import Piece, pieces

OVERLAP = 0.6
K1, B = 1.2, 0.75
BLOCK, SHARD_BYTES, LEAST_PASSAGE = 4, 16_000_000, 128
#: What the terms that are left out of the first bound can bring together, at most, and at most half of the least score that is enough.
SLACK = 0.05
OUT = "item_id long, score double, question_overlap double, answer_overlap double"
_SEPARATORS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(texts)


def item_words(texts: list[str | None]) -> list[tuple[list[int], int]]:
    """Word hashes of each item, and how many of them are the question's."""
    out = []
    for text in texts:
        head, mark, tail = (text or "").rpartition("?")
        both = []
        for part in ((head + mark, tail) if tail.strip() and head else (text or "", "")):
            piece = next(pieces(lowered(pa.array([part], pa.large_string())), 1 << 62))
            piece.words(_SEPARATORS)
            both.append(piece.hashes().tolist())
        words = both[0] + both[1]
        out.append((words, len(both[0]) if both[1] else len(words) - len(words) // 3))
    return out


class Statistics:
    """Of all items, whatever their shard: how many, their mean length, how many have each term, and the longest."""

    def __init__(self):
        self.items, self.length, self.longest, self.having = 0, 0, 0, {}

    def add(self, words: list[int]) -> None:
        self.items += 1
        self.length += len(words)
        self.longest = max(self.longest, len(words))
        for term in set(words):
            self.having[term] = self.having.get(term, 0) + 1


class Index:
    """The inverted index of one shard.

    ``terms`` are sorted hashes.  Of term t, ``items[at[t]:at[t + 1]]`` ascend, with ``impacts``; ``block_top[t]`` has its largest impact
    in each block of ``BLOCK`` items it occurs in, and ``most[t]`` its largest.  ``enough`` has the score each item needs, or infinity for one without words.
    """

    def __init__(self, ids: list, texts: list[str | None], stats: Statistics, threshold: float | None = None, overlap: float = OVERLAP):
        parsed = item_words(texts)
        self.ids, self.split = ids, parsed
        mean = stats.length / max(stats.items, 1)
        postings: dict[int, list[tuple[int, float]]] = {}
        enough = []
        for item, (words, _) in enumerate(parsed):
            weight = {}
            for term in set(words):
                tf, n = words.count(term), stats.having[term]
                weight[term] = math.log(1 + (stats.items - n + 0.5) / (n + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            total = sum(weight.values())
            for term, w in weight.items():
                postings.setdefault(term, []).append((item, w / total))
            share = {term: w / total for term, w in weight.items()}
            enough.append((self.least(item, share, overlap) if threshold is None else threshold) if share else math.inf)
        self.enough = np.array(enough)
        self.lowest = float(self.enough.min(initial=math.inf))
        self.slack = min(SLACK, self.lowest / 2)
        self.terms = np.array(sorted(postings), dtype=np.uint64)
        lists = [postings[int(t)] for t in self.terms]
        self.at = np.concatenate([[0], np.cumsum([len(p) for p in lists])]).astype(np.int64)
        self.items = [i for p in lists for i, _ in p]
        self.impacts = [w for p in lists for _, w in p]
        self.posting_items, self.posting_impacts = np.array(self.items, dtype=np.int64), np.array(self.impacts)
        tops: list[dict[int, float]] = []
        for p in lists:
            own: dict[int, float] = {}
            for item, w in p:
                own[item // BLOCK] = max(own.get(item // BLOCK, 0.0), w)
            tops.append(own)
        self.block_top = tops
        self.blocks_at = np.concatenate([[0], np.cumsum([len(t) for t in tops])]).astype(np.int64)
        self.blocks, self.tops = np.array([b for t in tops for b in t], dtype=np.int64), np.array([w for t in tops for w in t.values()])
        self.block_enough = np.minimum.reduceat(self.enough, np.arange(0, len(self.enough), BLOCK)) if len(self.enough) else self.enough
        self.most = [max(t.values()) for t in tops]
        order = np.argsort(self.most)
        self.rare = np.ones(len(lists), bool)
        self.rare[order[np.cumsum(np.array(self.most)[order]) <= self.slack]] = False
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.terms[self.rare] >> np.uint64(44)).astype(np.int64)] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are terms, and which term each is."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hit = np.flatnonzero(self.terms[at] == words)
        return hit, at[hit]

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All (item, score) of at least ``threshold`` for a set of terms, by block-max WAND."""
        cursors = [[self.items[self.at[t]], int(self.at[t]), int(self.at[t + 1]), t] for t in terms]  # item, place, end, term
        found, slack = [], threshold - 1e-9

        def advance(cursor: list, item: int) -> bool:
            place, end = cursor[1], cursor[2]
            while place < end and self.items[place] < item:
                place += 1
            cursor[1] = place
            if place < end:
                cursor[0] = self.items[place]
            return place < end

        while cursors:
            cursors.sort(key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += self.most[c[3]]
                if bound >= slack:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(self.block_top[c[3]].get(block, 0.0) for c in cursors[: pivot + 1]) < slack:
                # no item of this block can do, up to where another list begins
                to = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                keep = [advance(c, to) for c in cursors[: pivot + 1]]
            elif cursors[0][0] == item:
                score = sum(self.impacts[c[1]] for c in cursors[: pivot + 1])
                if score >= slack:
                    found.append((item, score))
                keep = [advance(c, item + 1) for c in cursors[: pivot + 1]]
            else:
                keep = [advance(c, item) if c[0] < item else True for c in cursors[: pivot + 1]]
            cursors = [c for c, k in zip(cursors, keep) if k] + cursors[pivot + 1 :]
        return found

    def shingles(self, item: int) -> list[set[tuple[int, ...]]]:
        """The different shingles of the question and of the answer."""
        words, cut = self.split[item]
        out = []
        for part in (words[:cut], words[cut:]):
            n = min(3, len(part))
            out.append({tuple(part[i : i + n]) for i in range(len(part) - n + 1)} if n else set())
        return out

    def least(self, item: int, impacts: dict[int, float], overlap: float) -> float:
        """A score that every passage has with ``overlap`` of the item's shingles of both parts.

        A word's impact is dealt out equally to the shingles with it.  A passage with some of them has their words, so it scores what
        they hold or more, and that is no less than what as many of the lightest hold.
        """
        parts, score = self.shingles(item), 0.0
        having = Counter(term for part in parts for own in part for term in set(own))
        for part in parts:
            most = next(k for k in range(len(part) + 1) if not part or k / len(part) >= min(overlap, 1.0))
            score += sum(sorted(sum(impacts[term] / having[term] for term in set(own)) for own in part)[:most])
        return score

    def overlaps(self, item: int, passage: list[int]) -> tuple[float, float]:
        """The shares of the question's and of the answer's shingles that the passage has."""
        shares = []
        for own in self.shingles(item):
            n = len(next(iter(own), ()))
            there = {tuple(passage[i : i + n]) for i in range(len(passage) - n + 1)} if n else set()
            shares.append(len(own & there) / len(own) if own else 1.0)
        return shares[0], shares[1]

    def reached(self, unit: np.ndarray, term: np.ndarray, lists: tuple[np.ndarray, np.ndarray, np.ndarray], enough: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
        """Unit * cells + cell where the impacts of the unit's terms and the next one's may be enough; cells are items or blocks of them.

        ``lists``: where each term's entries begin, their cells and impacts.  ``among``: the block keys, sorted, of the items that count.
        """
        at, cells, impacts = lists
        size, n = at[term + 1] - at[term], len(enough)
        place = np.repeat(at[term] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        of, cell, part = np.repeat(unit, size), cells[place], impacts[place]
        if among is not None:
            block = of * len(self.block_enough) + cell // BLOCK
            found = np.minimum(np.searchsorted(among, block), max(len(among) - 1, 0))
            stays = among[found] == block if len(among) else np.zeros(len(block), bool)
            of, cell, part = of[stays], cell[stays], part[stays]
        key = of * n + cell
        if not len(key):
            return key
        order = np.argsort(key)
        key, part = key[order], part[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, part = key[new], np.add.reduceat(part, new)
        after = np.searchsorted(key, key + n)
        after[after == len(key)] = 0
        both, least = part + np.where(key[after] == key + n, part[after], 0.0), enough[key % n] - self.slack - 1e-9
        starts = np.unique(np.concatenate([key[both >= least], key[part >= least] - n]))
        return starts[starts >= 0]

    def passages(self, piece: Piece, words: np.ndarray, half: int) -> list[tuple[int, int, int]]:
        """(document, first word, end) of the passages in which some item's bound is enough."""
        rough = np.flatnonzero(self.maybe[(words >> np.uint64(44)).astype(np.int64)])
        hit, term = self.find(words[rough])
        hit, keep = rough[hit], self.rare[term]
        hit, term = hit[keep], term[keep]
        counts = np.diff(piece.at)
        units = -(-counts // half) + 1  # one more, so that no passage reaches into another document
        base = np.cumsum(units) - units
        doc = np.searchsorted(piece.at, hit, side="right") - 1
        unit = base[doc] + (hit - piece.at[doc]) // half
        # a term counts once in a half
        once = np.unique(unit * len(self.terms) + term) if len(hit) else hit
        unit, term = once // max(len(self.terms), 1), once % max(len(self.terms), 1)
        n = len(self.block_enough)
        blocks = self.reached(unit, term, (self.blocks_at, self.blocks, self.tops), self.block_enough) if n else unit[:0]
        if not len(blocks):
            return []
        blocks = np.unique(np.concatenate([blocks, blocks + n]))
        alive = np.unique(blocks // n)
        some = alive[np.minimum(np.searchsorted(alive, unit), len(alive) - 1)] == unit
        starts = np.unique(self.reached(unit[some], term[some], (self.at, self.posting_items, self.posting_impacts), self.enough, blocks) // len(self.enough))
        out = []
        for u in starts.tolist():
            d = int(np.searchsorted(base, u, side="right")) - 1
            first = int(piece.at[d]) + (u - int(base[d])) * half
            if first < piece.at[d + 1]:
                out.append((d, first, min(first + 2 * half, int(piece.at[d + 1]))))
        return out

    def matches(self, piece: Piece, half: int, overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
        """(document, item, score, shares) of the verified matches, the best passage of each."""
        piece.words(_SEPARATORS)
        words, best = piece.hashes(), {}
        for d, first, end in self.passages(piece, words, half):
            own = words[first:end]
            _, terms = self.find(own)
            for item, score in self.search(np.unique(terms).tolist(), self.lowest):
                if score < self.enough[item] - 1e-9:
                    continue
                shares = self.overlaps(item, own.tolist())
                if min(shares) >= overlap:
                    best[d, item] = max(best.get((d, item), (0.0, (0.0, 0.0))), (score, shares))
        for (d, item), (score, shares) in best.items():
            yield d, item, min(score, 1.0), *shares


def indexes(benchmark: DataFrame, threshold: float | None, overlap: float) -> tuple[list[Index], int]:
    """One index a shard, made one after another on the driver, and half the length of a passage."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))
    own = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards))

    def shard(k: int) -> list[tuple]:
        rows = benchmark.filter(own == k).select("item_id", "text").collect()
        return sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))

    stats = Statistics()
    for k in range(shards):
        for words, _ in item_words([text for _, text in shard(k)]):
            stats.add(words)
    made = (Index([i for i, _ in rows], [t for _, t in rows], stats, threshold, overlap) for rows in map(shard, range(shards)))
    share = benchmark.sparkSession.sparkContext.broadcast
    return [share(index) for index in made], max(LEAST_PASSAGE // 2, stats.longest)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float | None = None, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap) of each document that holds a benchmark item, with ``threshold`` of a score that is no less.

    One scan of the documents a shard, without a shuffle.
    """
    shards, half = indexes(benchmark, threshold, overlap)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = None
    for shared in shards:

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                which, rest = [], []
                for piece in pieces(lowered(batch.column(1))):
                    for d, item, *shares in index.matches(piece, half, overlap):
                        which.append(piece.first + d)
                        rest.append((index.ids[item], *shares))
                columns = list(zip(*rest)) if rest else [[]] * 4
                kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(which, pa.int64())), *map(pa.array, columns, kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        part = docs.select("doc_id", "text").mapInArrow(search, f"doc_id {kind}, {OUT}")
        found = part if found is None else found.unionByName(part)
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float | None = None, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, in one scan."""
    shards, half = indexes(benchmark, threshold, overlap)
    place = docs.columns.index("text")
    for shared in shards:

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                stays = np.ones(batch.num_rows, bool)
                for piece in pieces(lowered(batch.column(place))):
                    for d, *_ in shared.value.matches(piece, half, overlap):
                        stays[piece.first + d] = False
                yield batch.filter(pa.array(stays))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
