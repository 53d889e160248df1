"""Byte-level BPE by replaying merges over many words at once (operator 10).

Each task cuts its documents into pattern matches and gathers the distinct ones that it
has not seen. They are laid end to end as byte symbols, and an index holds the rank of
every adjacent pair that the vocabulary can join, by its position. Merges are then applied
in waves over all words together: a wave joins the pairs of least rank in each word, and only
the two neighbours of a joined symbol get new entries. Words do not touch, so each sees its
merges in the order of their ranks. A pair is known by the rank of its concatenation, as in
the tiktoken library; a match that is itself in the vocabulary is its own token.

The ids of a match are remembered, and those of a chunk of matches; a document's ids are put
together from those of its chunks. Both memories are bounded (``pieces.LIMIT``). The ids of many
documents are then decoded, and written as text, by one look at a table of all tokens.

Defined results: a null or empty text has no tokens and the digests of empty strings;
null doc_ids stay; equal rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from matchboard.llm.pieces import Memory, chunks, collector_paused

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

WORDS_AT_ONCE = 50_000
PAIR = 24  # bits of an id
NONE = np.int64(1) << 62  # no rank
ID = "<u4"


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ranks from a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _table(entries: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes by id: all laid end to end, and where those of an id start and how many they are."""
    lengths = np.zeros(max(entries, default=-1) + 1, dtype=np.int64)
    ids = sorted(entries)
    lengths[ids] = [len(entries[k]) for k in ids]
    return np.frombuffer(b"".join([entries[k] for k in ids]), np.uint8), np.cumsum(lengths) - lengths, lengths


def _spell(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a sequence of ids, and the ends of each id in them."""
    flat, starts, lengths = table
    n = lengths[ids]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[ids] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)], ends


class MergeReplay:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = _table({rank: token for token, rank in ranks.items()})
        self.text_of = _table({rank: b"%d " % rank for rank in ranks.values()})
        byte = [ranks.get(bytes([b])) for b in range(256)]
        if None in byte:
            raise ValueError("the vocabulary lacks single bytes")
        joined: dict[int, int] = {}  # left << PAIR | right, to the rank of both together
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    joined[left << PAIR | right] = rank
        keys = np.fromiter(joined, dtype=np.int64, count=len(joined))
        order = np.argsort(keys)
        self.pairs = keys[order]
        self.pair_ranks = np.fromiter(joined.values(), dtype=np.int64, count=len(keys))[order]
        self.byte_ids = np.array(byte, dtype=np.int64)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, in 32 bits each."""
        whole = map(self.ranks.get, words)
        out = [b"" if rank is None else rank.to_bytes(4, "little") for rank in whole]
        todo = [k for k, coded in enumerate(out) if not coded and words[k]]
        for first in range(0, len(todo), WORDS_AT_ONCE):
            part = todo[first : first + WORDS_AT_ONCE]
            for k, ids in zip(part, self._replay([words[k] for k in part]), strict=True):
                out[k] = ids
        return out

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NONE for those the vocabulary cannot join."""
        if not len(self.pairs):
            return np.full(len(left), NONE)
        keys = left << PAIR | right
        place = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[place] == keys, self.pair_ranks[place], NONE)

    def _replay(self, words: list[bytes]) -> list[bytes]:
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        symbol = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbol), NONE)  # of each symbol with the one after it in its word
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self._rank(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            begin = np.flatnonzero(np.diff(word, prepend=-1))
            size = np.diff(begin, append=len(word))
            least = np.repeat(np.minimum.reduceat(rank, begin), size)
            over = least == NONE
            if over.any():  # words that no merge is left for
                done.append((word[over], symbol[over]))
                symbol, word, rank, least = symbol[~over], word[~over], rank[~over], least[~over]
                continue
            at = np.flatnonzero(rank == least)
            # In a run such as aaa, every other pair from its left is joined.
            fresh = np.diff(at, prepend=-2) != 1
            offset = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            at = at[offset % 2 == 0]
            symbol[at] = rank[at]
            stay = np.ones(len(symbol), dtype=bool)
            stay[at + 1] = False
            symbol, word, rank = symbol[stay], word[stay], rank[stay]
            at -= np.arange(len(at))  # one symbol fewer before each
            touched = np.concatenate([at, at - 1])
            touched = touched[touched >= 0]
            rank[touched] = NONE
            touched = touched[touched + 1 < len(word)]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self._rank(symbol[touched], symbol[touched + 1])
        word, symbol = (np.concatenate(x) for x in zip(*done)) if done else (np.zeros(0, int), np.zeros(0, int))
        raw = symbol[np.argsort(word, kind="stable")].astype(ID).tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def decode(self, ids: np.ndarray) -> bytes:
        return _spell(self.bytes_of, ids)[0].tobytes()


def _cut_matches(new: list[str], split: Callable[[str], list[str]]) -> tuple[list[str], np.ndarray]:
    """Pattern matches of all chunks, one after the other, and the bounds of each chunk in them.

    Chunks that begin with a space are cut alike alone and after one that ends without white
    space, so a row of them is cut at once; the others are cut one by one.
    """
    alike = np.array([c[0] == " " and not c[-1].isspace() for c in new], dtype=bool)
    row = list(compress(new, alike))
    found = split("".join(row))
    ends = np.cumsum([0, *map(len, found)])
    wanted = np.cumsum([0, *map(len, row)])
    last = np.searchsorted(ends, wanted)
    if ends[-1] != wanted[-1] or (ends[last] != wanted).any():  # a pattern that leaves out characters
        alike[:], found, last = False, [], last[:1]
    counts = np.zeros(len(new), dtype=np.int64)
    counts[alike] = np.diff(last)
    alone = [split(chunk) for chunk in compress(new, ~alike)]
    counts[~alike] = [len(part) for part in alone]
    bounds = np.cumsum([0, *counts])
    out: list[str] = []
    together = iter(found)
    for k, part in zip(np.flatnonzero(~alike), alone, strict=True):
        out += islice(together, int(bounds[k]) - len(out))
        out += part
    out += together
    return out, bounds


_loaded: dict[tuple[str, str], tuple[MergeReplay, Callable]] = {}


def _encoder(path: str, pattern: str) -> tuple[MergeReplay, Memory]:
    """Merges, and a memory of chunks as little-endian 32-bit ids.

    The memory is the caller's, so that a worker that waits for its next task holds none.
    """
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = MergeReplay(read_ranks(path)), regex.compile(pattern).findall
    replay, split = _loaded[path, pattern]
    matches = Memory(lambda new: replay.encode([match.encode() for match in new]))

    def encode(new: list[str]) -> list[bytes]:
        found, bounds = _cut_matches(new, split)
        known = matches.look_up([found])
        coded = list(map(known.__getitem__, found))
        sizes = np.cumsum([0, *map(len, coded)])[bounds].tolist()
        raw = b"".join(coded)
        return [raw[a:b] for a, b in zip(sizes, sizes[1:])]

    return replay, Memory(encode)


def _coded(texts: list[str | None], memory: Memory) -> list[bytes]:
    """Ids of whole texts, in 32 bits each."""
    with collector_paused():
        parts = [chunks(text or "") for text in texts]
        known = memory.look_up(parts)
        return [b"".join(map(known.__getitem__, p)) for p in parts]


def encode_texts(texts: list[str | None], path: str, pattern: str, memory: Memory | None = None) -> list[list[int]]:
    """Token ids of whole texts, for use inside tasks; ``memory`` is kept between calls."""
    memory = memory or _encoder(path, pattern)[1]
    return [np.frombuffer(raw, ID).tolist() for raw in _coded(texts, memory)]


def decode_ids(ids: list[int], path: str, pattern: str) -> bytes:
    return _encoder(path, pattern)[0].decode(np.array(ids, dtype=np.int64))


def _pieces(column: pa.Array, rows: int = 500, size: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of a column of texts with at most so many rows and about so many bytes."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(lengths)])
    first = 0
    while first < len(column):
        after = int(np.searchsorted(total, total[first] + size, side="right")) - 1
        after = min(max(after, first + 1), first + rows, len(column))
        yield first, after - first
        first = after


def _hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(starts.tolist(), ends.tolist())], pa.string())


def _runner(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, memory = _encoder(path, pattern)
        for batch in batches:
            for first, rows in _pieces(batch.column(1)):
                part = batch.slice(first, rows)
                coded = _coded(part.column(1).to_pylist(), memory)
                ids = np.frombuffer(b"".join(coded), ID)
                cuts = np.cumsum([0, *map(len, coded)]) // 4
                texts, text_ends = _spell(replay.text_of, ids)
                read, read_ends = _spell(replay.bytes_of, ids)
                text_cuts, read_cuts = (np.append(0, ends)[cuts] for ends in (text_ends, read_ends))
                # a space follows each id, also the last one of a text
                shown = np.maximum(text_cuts[1:] - 1, text_cuts[:-1])
                columns = [
                    part.column(0),
                    pa.array(np.diff(cuts)),
                    _hashes(texts, text_cuts[:-1], shown),
                    _hashes(read, read_cuts[:-1], read_cuts[1:]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.view(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def bpe_digests(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: number of ids, digests of the ids and of the decoded bytes, and the ids if wanted."""
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    return rows.mapInArrow(_runner(path, pattern, with_ids), SCHEMA + (", ids array<int>" if with_ids else ""))


def decode_documents(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text of rows with a column ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, _ = _encoder(path, pattern)
        for batch in batches:
            texts = [replay.decode(np.array(ids or (), dtype=np.int64)).decode(errors="replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def bpe_encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, memory = _encoder(path, pattern)
        for batch in batches:
            for first, rows in _pieces(batch.column(1)):
                part = batch.slice(first, rows)
                ids = encode_texts(part.column(1).to_pylist(), path, pattern, memory)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
                )

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")
