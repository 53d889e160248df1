"""Removal of long word sequences met in an earlier document (operator 8).

A window of ``width`` words is an edge of the de Bruijn graph of the corpus. Consecutive
edges of a document with one minimizer form a piece, which stands for a path; pieces of equal
content are brought to one row by joins on minimizer and content (``shared_windows``). Degrees
are not counted and paths are not contracted edge by edge. Where pieces with one minimizer
differ, one copy of each is fetched by its source coordinates and opened into edges, which are
compared by hash. Each word covered by an edge that also starts in a document with a smaller
doc_id is removed.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text, or one with fewer
words than a window, loses nothing; rows with one doc_id never remove each other; a null
doc_id is after all others; other columns are ignored, and ``remove_earlier`` returns doc_id
and text, a null text as an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchboard.llm import kernel
from matchboard.llm.shared_windows import (
    Windows,
    packed_texts,
    removed_windows,
    unpacked,
    window_runs,
    with_document,
)

WIDTH = 50
GRAM = 12

SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def _resolver(kind: Windows):
    def resolve(
        data: np.ndarray, bounds: np.ndarray, group: np.ndarray, first: np.ndarray, times: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        symbols, marks = kind.symbols(data, bounds)
        edges = kernel.Prefix(symbols).all(kind.width) if len(symbols) >= kind.width else np.zeros(0, np.uint64)
        n = np.maximum(np.diff(marks) - kind.width + 1, 0)
        owner = np.repeat(np.arange(len(n)), n)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        edge, where = edges[marks[:-1][owner] + offset], group[owner]
        order = np.lexsort((edge, where))
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (edge[order[1:]] != edge[order[:-1]]) | (where[order[1:]] != where[order[:-1]])
        removed = np.zeros(len(order), dtype=bool)
        if len(order):
            least = np.minimum.reduceat(first[owner[order]], np.flatnonzero(fresh))
            removed[order] = least[np.cumsum(fresh) - 1] < first[owner[order]]
        return window_runs(owner, offset, removed)

    return resolve


def _kept(batch: pa.RecordBatch, k: int, words: list[bytes], width: int) -> list[bytes]:
    spans = batch.column("spans")[k].as_py() or []
    low = np.array([s["low"] for s in spans], dtype=np.int64)
    high = np.array([s["high"] for s in spans], dtype=np.int64)
    gone = kernel.covered(low, high + width - 1, len(words))
    return [word for word, out in zip(words, gone.tolist(), strict=True) if not out]


def _digester(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for k in range(batch.num_rows):
                (raw,) = unpacked(batch.column("packed")[k : k + 1])
                words = raw.split()
                kept = _kept(batch, k, words, width) if batch.column("spans")[k].is_valid else words
                out[0].append(len(words))
                out[1].append(len(words) - len(kept))
                out[2].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def earlier_digests(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    kind = Windows(width, gram, words=True)
    found = removed_windows(docs, kind, _resolver(kind), earlier=True)
    both = with_document(packed_texts(docs), found, "left")
    return both.select("doc_id", "packed", "spans").mapInArrow(_digester(width), SCHEMA)


def remove_earlier(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """doc_id and text of every document, without words met in an earlier one, joined by one space."""
    kind = Windows(width, gram, words=True)
    found = removed_windows(docs, kind, _resolver(kind), earlier=True)
    both = with_document(packed_texts(docs), found, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for k in range(batch.num_rows):
                (raw,) = unpacked(batch.column("packed")[k : k + 1])
                texts.append(b" ".join(_kept(batch, k, raw.split(), width)).decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return both.select("doc_id", "packed", "spans").mapInArrow(run, "doc_id bigint, text string")
