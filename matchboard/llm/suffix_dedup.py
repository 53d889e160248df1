"""Removal of long byte strings that occur again, by suffix sorting (operator 2).

Every byte covered by a ``width``-byte string that also starts anywhere else is removed.
``shared_windows`` first drops, without loss, all text that cannot hold such a string and
judges pieces that are met again as a whole. What is left is sorted by suffixes, spread
by minimizer, so that equal strings meet in one task. There the difference-cover
algorithm orders the suffixes of many pieces at once: the suffixes at places 1 and 2
modulo 3 are sorted by their triples, named, and ordered by recursion on the names; the
others are sorted by first symbol and the rank that follows; both orders are merged; and
the ``width``-byte prefixes of neighbours are compared.

Defined results: a null or empty text has no bytes; a text shorter than the window keeps
all; equal rows are documents that repeat each other; null doc_ids are documents like
others; other columns are ignored by ``repeat_digests`` and kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.llm import kernel
from matchboard.llm.shared_windows import (
    Windows,
    pack_text,
    packed_texts,
    removed_windows,
    unpack_text,
    unpacked,
    window_runs,
    with_document,
)

WIDTH = 200
GRAM = 48

# helper columns beside a caller's own
_ID, _HASH, _OWN, _SPANS = "__repeat_doc_id", "__repeat_hash", "__repeat_own", "__repeat_spans"

SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _keys(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Single integers that order like tuples of the columns; columns come as (left, right) pairs of equal order."""
    key, room = columns[0], int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        top = int(column.max(initial=0)) + 1
        if room * top >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            room = int(key.max(initial=0)) + 1
        key = key * top + column
        room *= top
    return key


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a sequence of positive integers, by difference covers modulo 3."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), dtype=np.int64)
    padded = np.concatenate((text, np.zeros(3, dtype=text.dtype)))
    # a place n of class 1 keeps the two sampled classes apart in the recursion
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate((ones, twos))
    triple = _keys(padded[sample], padded[sample + 1], padded[sample + 2])
    order = np.argsort(triple, kind="stable")
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = triple[order[1:]] != triple[order[:-1]]
    name = np.empty(len(order), dtype=np.int64)
    name[order] = np.cumsum(fresh)
    if not fresh.all():
        order = suffix_array(name)
    rank = np.zeros(n + 4, dtype=np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    zeros = np.arange(0, n, 3)
    first = _keys(padded[:n], rank[1 : n + 1])
    zeros = zeros[np.argsort(first[zeros], kind="stable")]
    second = _keys(padded[:n], padded[1 : n + 1], rank[2 : n + 2])
    in_one, in_two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    place = (
        np.arange(len(zeros))
        + np.searchsorted(first[in_one], first[zeros])
        + np.searchsorted(second[in_two], second[zeros])
    )
    out = np.empty(n, dtype=np.int64)
    taken = np.zeros(n, dtype=bool)
    taken[place] = True
    out[place] = zeros
    out[~taken] = sampled
    return out


def _resolver(width: int):
    def resolve(
        data: np.ndarray, bounds: np.ndarray, group: np.ndarray, first: np.ndarray, times: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces = len(bounds) - 1
        owner = kernel.owners(bounds)
        # every piece ends with a symbol of its own, which no prefix of ``width`` bytes crosses
        text = np.empty(len(data) + pieces, dtype=np.int64)
        at = np.arange(len(data)) + owner
        text[at] = data.astype(np.int64) + 1
        ends = bounds[1:] + np.arange(pieces)
        text[ends] = 257 + np.arange(pieces)
        order = suffix_array(text)
        room = np.zeros(len(text), dtype=np.int64)
        room[at] = bounds[1:][owner] - np.arange(len(data))
        order = order[room[order] >= width]
        symbols = kernel.mix(text.astype(np.uint64))
        head = kernel.Prefix(symbols).all(width)[order] if len(order) else np.zeros(0, np.uint64)
        same = head[1:] == head[:-1]
        repeated = np.zeros(len(text), dtype=bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        inside = np.arange(len(data)) - bounds[:-1][owner]
        return window_runs(owner, inside, repeated[at])

    return resolve


def _spans(batch: pa.RecordBatch, k: int, n: int, width: int, name: str = "spans") -> np.ndarray:
    """True at the removed bytes of row ``k``."""
    spans = batch.column(name)[k].as_py() or []
    low = np.array([s["low"] for s in spans], dtype=np.int64)
    high = np.array([s["high"] for s in spans], dtype=np.int64)
    return kernel.covered(low, high + width - 1, n)


def _digester(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for k in range(batch.num_rows):
                (raw,) = unpacked(batch.column("packed")[k : k + 1])
                data = np.frombuffer(raw, dtype=np.uint8)
                gone = _spans(batch, k, len(data), width)
                kept = data[~gone].tobytes()
                row = (len(data), int(gone.sum()), len(kernel.runs(gone)[0]), hashlib.sha256(kept).hexdigest())
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types, strict=True))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def _removed(docs: DataFrame, width: int, gram: int) -> DataFrame:
    return removed_windows(docs, Windows(width, gram, words=False), _resolver(width), earlier=False)


def repeat_digests(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    both = with_document(packed_texts(docs), _removed(docs, width, gram), "left")
    return both.select("doc_id", "packed", "spans").mapInArrow(_digester(width), SCHEMA)


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with repeated strings taken out of ``text``; a character cut in two goes with them.

    A column ``n_chars`` is set to the new length. Null texts stay null.
    """
    found = _removed(docs, width, gram).withColumnsRenamed({"doc_id": _ID, "text_hash": _HASH, "spans": _SPANS})
    own = pack_text(docs.withColumn(_OWN, F.hash(docs.text.cast("string"))))
    same = own.doc_id.cast("bigint").eqNullSafe(found[_ID]) & own[_OWN].eqNullSafe(found[_HASH])
    both = own.join(found, same, "left").drop(_ID, _HASH, _OWN)

    def edit(raw: bytes, batch: pa.RecordBatch, k: int) -> bytes:
        if not batch.column(_SPANS)[k].is_valid:
            return raw
        data = np.frombuffer(raw, dtype=np.uint8)
        return data[~_spans(batch, k, len(data), width, _SPANS)].tobytes()

    out = unpack_text(both, edit).drop(_SPANS)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
