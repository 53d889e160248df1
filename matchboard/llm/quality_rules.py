"""Quality rules with a suffix array per document (operator 1).

Words are ``[^\\x20\\x09-\\x0D]+``. The words of each document get a suffix array with
longest common prefixes (``kernel.suffix_ranks``). A suffix lies in the LCP intervals on
its two sides; the depth of the deeper one, ``max(lcp before, lcp after)``, is the
longest substring from there that occurs again. Maximal repeats are these substrings
(one that extends another to the left covers it), so the union of the spans of length
``min_repeat`` or more is the part of the text that maximal repeats cover. A document is
rejected if that part, or the longest repeat, is beyond its limit.

Defined results: a null or empty text has no words, fails the base rule (too short) and
is not kept; a null doc_id stays null; equal rows give equal rows; other columns are
ignored; an empty table gives an empty table. Whole texts are read, of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchboard.llm import kernel

SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_covered bigint, longest_repeat bigint"
)

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_words_pct: int = 50  # of words inside repeated 3-word windows
    min_repeat: int = 10  # words of a repeat that counts as covering
    max_covered_pct: int = 30  # of words covered by such repeats
    max_longest: int = 100  # words of the longest repeat


def _duplicate_lines(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per document, lines with a word that equal an earlier line."""
    if not len(data):
        return np.zeros(len(bounds) - 1, dtype=np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.concatenate((bounds[:-1], breaks + 1))
    ends = np.concatenate((breaks, bounds[1:]))
    starts.sort()
    ends.sort()
    # a document of n breaks has n + 1 lines, so sorted starts and ends pair up
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(~kernel.SPACE[data], out=marks[1:])
    lines_before = np.searchsorted(breaks, bounds) + np.arange(len(bounds))
    doc = kernel.owners(lines_before)
    worded = marks[ends] > marks[starts]
    prefix = kernel.Prefix(kernel.byte_symbols(data))
    key = prefix.of(starts[worded], ends[worded])
    doc = doc[worded]
    order = np.lexsort((key, doc))
    again = (key[order[1:]] == key[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    return np.bincount(doc[order[1:]][again], minlength=len(bounds) - 1)


def _measure(data: np.ndarray, bounds: np.ndarray, rules: Rules) -> list[np.ndarray]:
    starts, ends, wb = kernel.words(data, bounds)
    n_words = np.diff(wb)
    letters = ~kernel.SPACE[data] & ((data & 0xC0) != 0x80)
    symbols = kernel.Prefix(kernel.byte_symbols(data)).of(starts, ends)
    order, lcp = kernel.suffix_ranks(symbols, wb)
    n = len(symbols)
    longest = np.zeros(n, dtype=np.int64)
    if n:
        longest[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    at = np.flatnonzero(longest >= 3)
    repeat_words = kernel.per_document(kernel.covered(at, at + 3, n), wb)
    at = np.flatnonzero(longest >= rules.min_repeat)
    n_covered = kernel.per_document(kernel.covered(at, at + longest[at], n), wb)
    most = np.zeros(len(n_words), dtype=np.int64)
    np.maximum.at(most, kernel.owners(wb), longest)
    base_failed = (n_words < rules.min_words) | (100 * repeat_words > rules.max_repeat_words_pct * n_words)
    good = (100 * n_covered <= rules.max_covered_pct * n_words) & (most <= rules.max_longest)
    return [
        n_words,
        kernel.per_document(letters, bounds),
        kernel.per_document(_SYMBOL[data], bounds),
        _duplicate_lines(data, bounds),
        repeat_words,
        base_failed,
        ~base_failed & good,
        n_covered,
        most,
    ]


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: base counts, verdicts, covered words and longest repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, after, data, bounds in kernel.slices(batch.column(1)):
                columns = [pa.array(c) for c in _measure(data, bounds, rules)]
                yield pa.RecordBatch.from_arrays([ids[first:after], *columns], names=names)

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)


def good_documents(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the rules keep."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, bounds in kernel.slices(batch.column(at)):
                kept = _measure(data, bounds, rules)[6]
                yield batch.slice(first, after - first).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
