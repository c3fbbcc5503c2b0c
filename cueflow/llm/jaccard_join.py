"""N-gram Jaccard join by a prefix tree over globally ordered shingle sets.

A document's set holds the hashes of its distinct 5-word shingles; two sets link when their Jaccard similarity is 0.8 or
more.  The join loses no link between different components:

1. Equal sets are one class.  Of each class a sample of its shingles, those with a hash below ``SAMPLE`` of the range (all of a short one's), is
   counted over all blocks.  A linked set lacks at most a fifth of the other's shingles, so one that has more than that among its sampled
   shingles which nothing else holds has no link; most documents end here.
2. The others are each compared with the most central set (the one with least that nothing else holds) of those with the same smallest shingle, under two orders.
   What links there gets one label.  This costs as much as there are sets, however many of them are near copies of one text, and is only to spare the next steps work.
3. All order their sampled shingles by frequency, the rarest first.  Of two linked sets, the prefixes that are one longer than a
   fifth of the set share a shingle, and their sizes are at most a quarter apart.  Where all sets of a shingle have one label nothing is left to find.  Sets of several labels that
   share a shingle and a band of sizes are brought together through the smallest that has both, and contracted to groups.
4. Each group's sets go into a trie in one global order (sampled shingles before others, the common ones first), so common parts are shared.  Each set
   but those of the label with most walks the trie with its overlap so far, and leaves a subtree when the remaining lengths cannot bring enough, or when it has one label with all
   of it already.  A group beyond ``GROUP_BYTES`` or ``GROUP_ROWS`` is dealt into pieces, those of the label with most apart from the rest, and each pair of pieces that may have a link
   is a task of its own.

Texts have A-Z in lower case; words are ``[^\\x20\\x09-\\x0D]+``; fewer than five words are one shingle; without words or text the set is empty and
links with nothing.  Ids may be of any type that has an order.  Rows that share a doc_id keep their own sets; a null doc_id is the smallest of a component only where all are null.  Other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueflow.llm.blocks import PACKED, BlockWords, ask, by_block, dealt, exchange, heard, with_replies
from cueflow.llm.components import components
from cueflow.llm.shared import materialise
from cueflow.llm.words import mix

SHINGLE, SAMPLE = 5, 0.4
#: Two sets up to the first size are compared by all their shingles, other pairs by their samples.  Up to the second, as large as a
#: partner of those can be, all are counted; from the third on, as small as a partner of larger ones, a set also has a prefix of its sample.
SHORT, COUNTED, JOINT = 400, 500, 320
#: What a task compares with itself at once, or piece with piece.
GROUP_ROWS, GROUP_BYTES = 1024, 16_000_000
FOUND = "n_shingles long, node long, block long, bare boolean, prefix array<long>, spare double, low long, other_low long, tokens binary, levels binary"


def shingle_sets(table: pa.Table) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a block."""
    words = BlockWords(table, lower=True)
    code, fits = words.windows(words.hashes, SHINGLE)
    for n in range(1, SHINGLE):
        few = np.flatnonzero(words.counts == n)
        if len(few):
            code[words.at[few]] = words.windows(words.hashes, n)[0][words.at[few]]
    out = []
    for i in range(words.n):
        n = words.counts[i]
        own = code[words.at[i] : words.at[i] + max(n - SHINGLE + 1, min(n, 1))]
        out.append(np.unique(own))
    return out


def node_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set, signed."""
    value = (int((tokens * np.uint64(0x9E3779B97F4A7C15)).sum()) ^ int(np.bitwise_xor.reduce(tokens)) * 0xD6E8FEB86659FD93) % 2**64
    return value - 2**64 if value >= 2**63 else value


def sampled(tokens: np.ndarray, share: float, whole: int) -> np.ndarray:
    """The part of a set below ``share`` of the range of hashes; all of it up to ``whole``."""
    if share >= 1 or len(tokens) <= whole:
        return tokens
    return tokens[: np.searchsorted(tokens, np.uint64(int(share * 2**64)))]


def classes(table: pa.Table) -> tuple[list[np.ndarray], list[int], dict[int, int]]:
    """The sets, their names, and the first row of each name."""
    sets = shingle_sets(table)
    names = [node_of(s) if len(s) else 0 for s in sets]
    first: dict[int, int] = {}
    for i, (s, name) in enumerate(zip(sets, names)):
        if len(s):
            first.setdefault(name, i)
    return sets, names, first


def counted(sets: list[np.ndarray], first: dict[int, int], share: float) -> tuple[np.ndarray, np.ndarray]:
    every = [sampled(sets[i], share, COUNTED) for i in first.values()]
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *every]), return_counts=True)


class Trie:
    """A static path-compressed trie of sets, each a sorted array of ranks, as arrays over its nodes, parents first.

    A node has, in ``tokens[start:start + length]``, the ranks that all its sets have after its parent's; ``depth`` ranks lead to its end; ``low`` and ``high`` bound its
    sets in ``order``, and ``least`` and ``most`` their sizes.  A leaf is one set, any other node has children, which follow each other.
    """

    def __init__(self, sets: list[np.ndarray]):
        size = np.array([len(s) for s in sets])
        self.order = np.array(sorted(range(len(sets)), key=lambda m: sets[m].astype(">u4").tobytes()))
        common = np.zeros(len(sets), np.int64)
        for i, (m, k) in enumerate(zip(self.order, self.order[1:]), 1):
            n = min(size[m], size[k])
            differ = sets[m][:n] != sets[k][:n]
            common[i] = differ.argmax() if differ.any() else n
        nodes, segments, todo = [], [], [(0, len(sets), 0)]
        for low, high, begin in todo:  # grows
            own = sets[self.order[low]]
            end = int(common[low + 1 : high].min()) if high > low + 1 else len(own)
            cuts = [low, *(low + 1 + np.flatnonzero(common[low + 1 : high] == end)).tolist(), high] if high > low + 1 else []
            nodes.append((low, high, end, len(todo), max(len(cuts) - 1, 0)))
            segments.append(own[begin:end])
            todo += [(i, j, end) for i, j in pairwise(cuts)]
        self.low, self.high, self.depth, self.child, self.children = np.array(nodes).T
        self.length = np.array([len(s) for s in segments])
        self.start, self.tokens = np.cumsum(self.length) - self.length, np.concatenate(segments)
        ordered = size[self.order]
        self.least, self.most = (np.array([f(ordered[i:j]) for i, j in zip(self.low, self.high)]) for f in (np.min, np.max))

    def walk(self, own: np.ndarray, has: np.ndarray, differs: np.ndarray) -> np.ndarray:
        """The sets that link with ``own``, whose ranks ``has`` marks, among those that differ in label: a level of the trie at a time, without the subtrees that cannot."""
        size = len(own)
        shortest, longest = -(-size * 4 // 5), size * 5 // 4
        left = np.concatenate([[0], np.cumsum(differs[self.order])])
        at, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(at):
            stays = (self.most[at] >= shortest) & (self.least[at] <= longest) & (left[self.high[at]] > left[self.low[at]])
            at, overlap = at[stays], overlap[stays]
            length = self.length[at]
            ends = np.cumsum(length)
            held = np.concatenate([[0], np.cumsum(has[self.tokens[np.repeat(self.start[at] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)]], dtype=np.int64)])
            overlap = overlap + held[ends] - held[ends - length]
            last = self.tokens[np.maximum(self.start[at] + length - 1, 0)]
            after = np.where(self.depth[at] > 0, size - np.searchsorted(own, last, side="right"), size)
            after = np.where(length > 0, after, size)
            need = -(-4 * (size + np.maximum(self.least[at], shortest)) // 9)
            stays = overlap + np.minimum(np.minimum(self.most[at], longest) - self.depth[at], after) >= need
            at, overlap = at[stays], overlap[stays]
            leaf = self.children[at] == 0
            found.append(self.order[self.low[at[leaf]]][9 * overlap[leaf] >= 4 * (size + self.most[at[leaf]])])
            at, overlap = at[~leaf], overlap[~leaf]
            n = self.children[at]
            overlap = np.repeat(overlap, n)
            at = np.repeat(self.child[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.concatenate(found) if found else at


def trie_links(sets: list[np.ndarray], levels: list[np.ndarray] | None = None, labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join the same sets together as all links would, beyond what labels join: a set that has one label with all of a subtree skips it.

    ``levels`` has the frequency, as a logarithm, of each set's sampled shingles, which come first.  Linked: 100 * intersection >= 80 * union, that is 9 *
    intersection >= 4 * (size + size).
    """
    every, at = np.unique(np.concatenate(sets), return_index=True)
    level = np.concatenate([x for s, own in zip(sets, levels) for x in (own.astype(np.int16), np.full(len(s) - len(own), -1, np.int16))])[at] if levels else np.zeros(len(every), np.int16)
    rank = np.empty(len(every), np.int32)
    rank[np.lexsort([every, -level])] = np.arange(len(every))
    ranked = [np.sort(rank[np.searchsorted(every, s)]) for s in sets]
    trie, links = Trie(ranked), []
    label = np.arange(len(sets)) if labels is None else np.unique(labels, return_inverse=True)[1]
    members: dict[int, list[int]] = {}
    for x, own in enumerate(label.tolist()):
        members.setdefault(own, []).append(x)
    has = np.zeros(len(every), np.int8)

    def walk(x: int) -> None:
        has[ranked[x]] = 1
        for y in trie.walk(ranked[x], has, label != label[x]).tolist():
            if label[x] != label[y]:
                links.append((x, y))
                few, many = sorted((int(label[x]), int(label[y])), key=lambda k: len(members[k]))
                label[members[few]] = many  # the fewer change, so each changes as often as a logarithm of all
                members[many] += members.pop(few)
        has[ranked[x]] = 0

    # central sets first, as others link with them rather than with each other; then all but those of the label with most, which are linked already
    counts = np.bincount(np.concatenate(ranked), minlength=len(every))
    alone = np.array([(counts[r] == 1).mean() for r in ranked])
    order = np.argsort(alone, kind="stable").tolist()
    early = min(len(order), 2 * int(len(order) ** 0.5))
    for x in order[:early]:
        walk(x)
    most = max(members.values(), key=len)[0]
    for x in order[early:]:
        if label[x] != label[most]:
            walk(x)
    return links


def links_table(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])


def linked(table: pa.Table) -> pa.Table:
    """Links (a, b) between the classes of the groups of one task."""
    groups, nodes, labels = (table[c].to_numpy() for c in ("root", "node", "label"))
    order = np.argsort(groups, kind="stable")
    out = []
    for own in np.split(order, np.flatnonzero(np.diff(groups[order])) + 1):
        if len(own) > 1:
            sets, levels = ([np.frombuffer(table[c][int(i)].as_py(), kind) for i in own] for c, kind in (("tokens", np.uint64), ("levels", np.uint8)))
            out += [(int(nodes[own[i]]), int(nodes[own[j]])) for i, j in trie_links(sets, levels, labels[own])]
    return links_table(out)


def with_central(sets: DataFrame, key: str) -> DataFrame:
    """Links (a, b) between each class and the most central one that has the same ``key``."""
    central = sets.groupBy(key).agg(F.min(F.struct("spare", "node")).alias("central"), F.count("*").alias("rows")).filter("rows > 1")
    central = central.select(key, F.col("central.node").alias("b"))
    central = materialise(central.join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("other")), "b"), "central")
    pairs = sets.select(key, F.col("node").alias("a"), "tokens").join(central, key).filter("a != b").select("a", "b", "tokens", "other")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (one, two))
                short, long = sorted((len(x), len(y)))
                keep.append(5 * short >= 4 * long and 9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(verify, "a long, b long")


def sift(docs: DataFrame, share: float) -> DataFrame:
    """Step 1: all documents with their class, and, once a block, the prefixes and sets of the classes that may have a link."""
    deal = dealt(docs)
    bits = deal.bits(2 * share * deal.total)  # a hash and a count for each word of six bytes
    below = 2**64 - 1 if share >= 1 else int(share * 2**64)

    def send(block: int, table: pa.Table) -> pa.Table:
        sets, _, first = classes(table)
        keys, counts = counted(sets, first, share)
        return ask(block, keys, bits, counts)

    def keep(block: int, table: pa.Table, back: pa.Table) -> pa.Table:
        sets, names, first = classes(table)
        keys, _ = counted(sets, first, share)
        level = heard(back, 1, keys, bits)
        n = len(sets)
        prefix, spare, tokens, levels, lows, others = ([None] * n for _ in range(6))
        bare = np.zeros(n, bool)
        for i in first.values():
            size, lacks, shared = len(sets[i]), len(sets[i]) // 5, []
            for part in [sets[i]] * (size <= SHORT) + [sampled(sets[i], share, 0)] * (size >= JOINT):
                bare[i] |= len(part) <= lacks  # the sample is too small to tell
                its = level[np.searchsorted(keys, part)]
                if (its > 0).sum() >= len(part) - lacks:
                    order = np.lexsort([part, its])[: lacks + 1]
                    shared.append(part[order][its[order] > 0])
                    spare[i] = float((its == 0).mean())
            if sum(map(len, shared)):
                prefix[i], tokens[i] = np.unique(np.concatenate(shared)).view(np.int64), sets[i].tobytes()
                own = sets[i][: np.searchsorted(sets[i], np.uint64(below))]
                levels[i] = level[np.searchsorted(keys, own)].tobytes()
                lows[i], others[i] = int(sets[i][:1].view(np.int64)[0]), int(mix(sets[i].copy()).min().view(np.int64))
        node = pa.array(names, pa.int64(), mask=np.array([not len(s) for s in sets], bool))
        columns = [
            table["doc_id"], pa.array([len(s) for s in sets], pa.int64()), node, table["block"], pa.array(bare), pa.array(prefix, pa.list_(pa.int64())), pa.array(spare, pa.float64()),
            pa.array(lows, pa.int64()), pa.array(others, pa.int64()), pa.array(tokens, pa.binary()), pa.array(levels, pa.binary()),
        ]
        return pa.table(columns, ["doc_id", *(f.split()[0] for f in FOUND.split(", "))])

    answers = exchange(by_block(deal.frame, send, PACKED), bits, lambda total, first: np.log2(total))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialise(with_replies(deal.frame, answers, keep, f"doc_id {kind}, {FOUND}"), "sets")


def link_groups(found: DataFrame) -> DataFrame:
    """Steps 2 to 4: links (a, b) between classes."""
    named = found.filter("tokens IS NOT NULL")
    own = named.groupBy("node").agg(F.min("block").alias("block"))
    each = named.join(own, ["node", "block"], "left_semi")
    labels = materialise(components(with_central(each, "low").unionByName(with_central(each, "other_low"))), "labels")
    label = F.coalesce("label", "node").alias("label")
    known = labels.select("node", F.col("root").alias("label"))
    postings = each.select("node", "n_shingles", "prefix").join(known, "node", "left").select("node", label, "n_shingles", F.explode("prefix").alias("token"))
    several = F.min("label") < F.max("label")
    mixed = materialise(postings.groupBy("token").agg(several.alias("several")).filter("several").select("token"), "mixed")
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1.25)) + 1e-9).cast("int")
    banded = postings.join(mixed, "token", "left_semi").select("node", "label", "token", F.explode(F.array(band, band + 1)).alias("band"))
    banded = materialise(banded, "postings")
    hubs = materialise(banded.groupBy("token", "band").agg(F.min("node").alias("hub"), several.alias("several")).filter("several").drop("several"), "hubs")
    groups = components(banded.join(hubs, ["token", "band"]).select(F.col("node").alias("a"), F.col("hub").alias("b")))
    groups = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct())
    placed = materialise(groups, "groups")
    where = placed.join(known, "node", "left").select("node", "root", label)
    sizes = each.select("node", F.octet_length("tokens").alias("bytes")).join(where, "node").groupBy("root", "label").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows"))
    both = sizes.groupBy("root").agg(F.max(F.struct("rows", "label", "bytes")).alias("top"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).filter("rows > top.rows")
    pieces = lambda rows, size: F.ceil(F.greatest(rows / F.lit(float(GROUP_ROWS)), size / F.lit(float(GROUP_BYTES)))).cast("int")
    top, rest = pieces(F.col("top.rows"), F.col("top.bytes")), pieces(F.col("rows") - F.col("top.rows"), F.col("bytes") - F.col("top.bytes"))
    sized = materialise(both.select("root", "bytes", F.col("top.label").alias("most"), pieces(F.col("rows"), F.col("bytes")).alias("all"), top.alias("top"), rest.alias("rest")), "group_sizes")
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(4 * int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // (GROUP_BYTES // 4))
    own = materialise(where.join(sized.drop("bytes"), "root"), "places")
    dealt_to = each.select("node", "tokens", "levels").join(own, "node")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    in_top, in_rest = F.pmod(F.hash("node"), F.col("top")), F.pmod(F.hash("node"), F.col("rest"))
    task = (
        F.when(F.col("all") == 1, F.array(F.pmod(F.hash("root"), F.lit(tasks)).cast("long")))
        .when(F.col("label") == F.col("most"), F.transform(every(F.col("rest")), lambda k: F.xxhash64("root", F.lit(0), in_top, k)))
        .otherwise(
            F.concat(
                F.transform(every(F.col("top")), lambda k: F.xxhash64("root", F.lit(0), k, in_rest)),
                F.transform(every(F.col("rest")), lambda k: F.xxhash64("root", F.lit(1), F.least(k, in_rest), F.greatest(k, in_rest))),
            )
        )
    )
    exact = dealt_to.select("root", "node", "label", "tokens", "levels", F.explode(task).alias("task")).groupBy("task").applyInArrow(linked, "a long, b long")
    return exact.unionByName(labels.select(F.col("node").alias("a"), F.col("root").alias("b")))


def rooted(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, node, block and root, the name of its component; null for empty sets."""
    found = sift(docs, SAMPLE)
    if not found.filter("bare").isEmpty():  # with whole sets no sample is too small
        found = sift(docs, 1.0)
    roots = materialise(components(link_groups(found)), "roots")
    own = found.select("doc_id", "n_shingles", "node", "block").join(roots, "node", "left")
    return own.withColumn("root", F.coalesce("root", "node"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id.

    The smallest ids are a table of their own, without those of single documents, so that Spark can split a component of very many when it joins them.
    """
    own = rooted(docs)
    least = own.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows"))
    least = materialise(least.filter("rows > 1").drop("rows"), "least")
    return own.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, but of each component only one with the smallest doc_id; rows with an empty set all stay."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "block")).alias("first")
    stay = rooted(docs).filter("root IS NOT NULL").groupBy("root").agg(first).select("first.doc_id", "first.node", "first.block")
    carry = [c for c in docs.columns if c not in ("doc_id", "text")]
    blocks = dealt(docs, carry).frame
    more = ["carried"] if carry else []

    def keep(block: int, table: pa.Table, back: pa.Table) -> pa.Table:
        wanted = set(zip(back["doc_id"].to_pylist(), back["node"].to_pylist()))
        sets, names, _ = classes(table)
        rows = []
        for i, (doc, name, own) in enumerate(zip(table["doc_id"].to_pylist(), names, sets)):
            if not len(own) or (doc, name) in wanted:
                wanted.discard((doc, name))
                rows.append(i)
        return table.select(["doc_id", "text", *more]).take(pa.array(rows, pa.int64()))

    schema = ", ".join(f"{c} {blocks.schema[c].dataType.simpleString()}" for c in ("doc_id", "text", *more))
    kept = with_replies(blocks, stay, keep, schema)
    return kept.select(*(F.col("carried")[c].alias(c) if c in carry else c for c in docs.columns))
