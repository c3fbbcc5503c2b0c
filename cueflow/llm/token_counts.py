"""Token counts by greedy longest match in time linear in the text.

The pieces of a vocabulary form a trie.  Each node knows its failure link, the node that remains after the longest
pieces that must be emitted are popped off its string, and how many pieces that pops.  A word is read once, byte by
byte: on a missing child the popped count is added and the failure link is followed.  So lengths come without any piece
being built (Song et al., "Fast WordPiece Tokenization", 2021).

Words are ``[^\\x20\\x09-\\x0D]+``, each led by one space as in byte-level vocabularies, whose later pieces follow
without one.  The vocabulary must hold each single byte, so every word can be split.  A null or empty text has no words and no
tokens; very long words cost their length; repeated rows are counted alike; other columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cueflow.llm.words import pieces

#: The default vocabulary file, a parameter of the operator.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def printable_bytes() -> dict[str, int]:
    """The characters by which byte-level vocabulary files name bytes: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, extra = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in set(plain):
            names[chr(extra)] = b
            extra += 1
    return names


def load_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The pieces of a byte-level vocabulary file, without special tokens; the driver reads it, from a path of its own."""
    if not os.path.isfile(path):
        raise FileNotFoundError(f"{path}: pass the path of a byte-level tokenizer file (JSON with model.vocab) as the vocabulary")
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {token["content"] for token in content.get("added_tokens", [])}
    names = printable_bytes()
    return [bytes(names[c] for c in piece) for piece in content["model"]["vocab"] if piece not in special]


class LongestMatch:
    """The automaton.  ``keys`` (sorted ``node * 256 + byte``) and ``targets`` hold the trie's edges."""

    def __init__(self, vocabulary: list[bytes]):
        children: list[dict[int, int]] = [{}]
        final: list[bool] = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                nxt = children[node].get(byte)
                if nxt is None:
                    nxt = children[node][byte] = len(children)
                    children.append({})
                    final.append(False)
                node = nxt
            final[node] = node != 0
        if not all(b in children[0] and final[children[0][b]] for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte")
        fail, popped = [0] * len(children), [0] * len(children)
        level = [(0, byte, node) for byte, node in children[0].items()]
        while level:
            below = []
            for parent, byte, node in level:
                if final[node]:
                    fail[node], popped[node] = 0, 1
                else:
                    back, count = fail[parent], popped[parent]
                    while byte not in children[back]:
                        count += popped[back]
                        back = fail[back]
                    fail[node], popped[node] = children[back][byte], count
                below += [(node, b, n) for b, n in children[node].items()]
            level = below
        edges = sorted((node * 256 + byte, nxt) for node, own in enumerate(children) for byte, nxt in own.items())
        self.keys = np.array([k for k, _ in edges], dtype=np.int64)
        self.targets = np.array([t for _, t in edges], dtype=np.int32)
        self.fail, self.popped = np.array(fail, dtype=np.int32), np.array(popped, dtype=np.int64)
        self.first = self.step(np.zeros(1, np.int32), np.array([0x20]))[0][0]


    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The child of each state for each byte, and whether there is one."""
        key = state.astype(np.int64) * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return self.targets[at], self.keys[at] == key

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word of a buffer; all words advance together, a byte at a time."""
        order = np.argsort(start - end, kind="stable")  # the longest first, so those still running are a prefix
        begin, length = start[order], (end - start)[order]
        state, count = np.full(len(begin), self.first, np.int32), np.zeros(len(begin), np.int64)
        for k in range(int(length[0]) if len(length) else 0):
            alive = int(np.searchsorted(-length, -k, side="left"))
            todo, byte = np.arange(alive), data[begin[:alive] + k]
            while len(todo):
                nxt, found = self.step(state[todo], byte)
                state[todo[found]] = nxt[found]
                todo, byte = todo[~found], byte[~found]
                count[todo] += self.popped[state[todo]]
                state[todo] = self.fail[state[todo]]
        while (left := np.flatnonzero(state)).size:
            count[left] += self.popped[state[left]]
            state[left] = self.fail[state[left]]
        out = np.empty_like(count)
        out[order] = count
        return out


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_words`` and ``n_tokens``.  One pass, no shuffle.

    The automaton is built on the driver from the vocabulary file and broadcast; its size is that of the vocabulary
    (about 15 MB for 50,000 pieces), whatever the corpus.
    """
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatch(load_vocabulary(vocabulary)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            n_words, n_tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for piece in pieces(batch.column(1)):
                piece.words()
                _, index, back = np.unique(piece.hashes(), return_index=True, return_inverse=True)
                each = automaton.counts(piece.data, piece.start[index], piece.end[index])[back]
                total = np.concatenate([[0], np.cumsum(each)])
                n_words.append(np.diff(piece.at))
                n_tokens.append(np.diff(total[piece.at]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(n_words)), pa.array(np.concatenate(n_tokens))], ["key", "n_words", "n_tokens"]
            )

    source = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(count, f"key {kind}, n_words long, n_tokens long").withColumnRenamed("key", key)
