"""Word-piece token counts by a linear longest-match automaton (operator 9).

A word is matched greedily: the longest vocabulary entry at its start, then the longest
continuation entry, and so on. The vocabulary trie gets failure links, as in LinMaxMatch:
when no child fits, the pieces that the greedy choice must emit are popped and the
automaton jumps to where the rest of the input so far stands. Only the number of popped
pieces is stored per node, so counts need one pass over the bytes and no piece is built.

The vocabulary is that of a byte-level file: tokens that begin with a space start words
(a word is read with one space before it), all others continue them. Every byte is an
entry and so is the space, so each word has pieces.

The words of a batch step through the automaton side by side in numpy. Counts of short
words are remembered per worker, up to ``pieces.LIMIT``.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has 0 words and
tokens; null doc_ids stay; equal rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchboard.llm.merge_replay import read_ranks
from matchboard.llm.pieces import Memory

SCHEMA = "doc_id bigint, n_words bigint, n_tokens bigint"
SPACE = 0x20


class LongestMatch:
    """Trie with failure links over start entries and continuation entries."""

    def __init__(self, start: list[bytes], more: list[bytes]):
        """``start`` may begin a word, ``more`` may follow; both non-empty byte strings."""
        self.child: dict[int, int] = {}  # node << 8 | byte
        entry = [False, False]
        depth = [0, 0]
        parents: list[tuple[int, int]] = [(-1, 0), (-1, 0)]
        # node 0 is the root of starts, node 1 the root of continuations
        for root, words in ((0, start), (1, more)):
            for word in words:
                node = root
                for byte in word:
                    key = node << 8 | byte
                    after = self.child.get(key)
                    if after is None:
                        after = self.child[key] = len(entry)
                        entry.append(False)
                        depth.append(depth[node] + 1)
                        parents.append((node, byte))
                    node = after
                entry[node] = True
        n = len(entry)
        fail = [-1] * n
        pops = [0] * n
        for node in sorted(range(2, n), key=depth.__getitem__):
            if entry[node]:
                fail[node], pops[node] = 1, 1
                continue
            parent, byte = parents[node]
            at, popped = fail[parent], pops[parent]
            while at >= 0 and (at << 8 | byte) not in self.child:
                popped += pops[at]
                at = fail[at]
            if at >= 0:
                fail[node], pops[node] = self.child[at << 8 | byte], popped
        self.fail = np.array(fail, dtype=np.int64)
        self.pops = np.array(pops, dtype=np.int64)
        keys = np.fromiter(self.child.keys(), dtype=np.int64, count=len(self.child))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.nodes = np.fromiter(self.child.values(), dtype=np.int64, count=len(self.child))[order]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Number of greedy pieces of each word; -1 where the vocabulary has none."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int64)
        begin = np.cumsum(lengths) - lengths
        total = np.zeros(len(words), dtype=np.int64)
        state = np.zeros(len(words), dtype=np.int64)
        live = np.flatnonzero(lengths > 0)
        live = live[np.argsort(-lengths[live], kind="stable")]  # words that end drop off the tail
        step = 0
        while len(live):
            live = live[: int(np.searchsorted(-lengths[live], -step, side="left"))]
            if not len(live):
                break
            at, byte = live, data[begin[live] + step]
            while len(at):
                now = state[at]
                key = now << 8 | byte
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = (self.keys[place] == key) & (now >= 0)
                state[at[hit]] = self.nodes[place[hit]]
                rest = ~hit & (now >= 0)
                at, byte, now = at[rest], byte[rest], now[rest]
                total[at] += self.pops[now]
                state[at] = self.fail[now]
                gone = state[at] < 0
                at, byte = at[~gone], byte[~gone]
            step += 1
        # what is left in a state is popped as if the word ended with a byte of no entry
        at = np.flatnonzero(state >= 2)
        while len(at):
            now = state[at]
            total[at] += self.pops[now]
            state[at] = self.fail[now]
            at = at[state[at] >= 2]
        total[state < 0] = -1
        return total


def _split(ranks: dict[bytes, int]) -> tuple[list[bytes], list[bytes]]:
    start = [t for t in ranks if t[0] == SPACE]
    return start, [t for t in ranks if t[0] != SPACE]


_loaded: dict[str, Memory] = {}


def _counter(path: str) -> Memory:
    if path not in _loaded:
        automaton = LongestMatch(*_split(read_ranks(path)))

        def encode(new: list[bytes]) -> list[int]:
            return automaton.counts([b" " + word for word in new]).tolist()

        _loaded[path] = Memory(encode)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _counter(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                words = [(text or "").encode().split() for text in part.column(1).to_pylist()]
                known = memory.look_up(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([sum([known[x] for x in w]) for w in words], pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    return rows.mapInArrow(run, SCHEMA)
