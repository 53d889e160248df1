"""Where windows of symbols occur again, over a corpus (base of operators 2 and 8).

A document is a sequence of symbols (bytes or words); a window is ``width`` of them in a
row. The text is never shuffled window by window. Instead:

1. *Pieces.* Each window takes the least hash of the ``gram``-symbol grams inside it, its
   minimizer, which depends on its content only. Consecutive windows with one minimizer
   are a piece. Equal windows thus lie in pieces of one minimizer, and there are about
   2 / (width - gram) pieces a symbol.
2. *Compaction.* Pieces are counted by minimizer, with partial sums before the shuffle. A
   minimizer met once holds no repeat, and its pieces are dropped. Where all pieces of a
   minimizer are equal they are one path without branches, and are judged as a whole.
3. *Branches.* Where pieces of a minimizer differ, one copy of each different content is
   fetched from its document and resolved window by window: by ``resolve`` inside a task
   for up to ``HOT`` contents of a minimizer, and by one row per window, grouped and joined
   by Spark, for larger groups. Both are exact; no group is cut.
4. Removed windows go back by content to all places of their pieces, and by document to
   the texts.

The repeated joins carry hashes and positions; texts move twice, compressed. Contents of one
minimizer are told apart by the 62 bits of their hash (``kernel.Prefix``). Joins with counts by
minimizer or content leave a hot key of the pieces splittable (``skew``).

Row identity is doc_id and a hash of the text, compared null-safely, so that repeated
doc_ids are documents of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from matchboard.llm import kernel
from matchboard.llm.skew import join_split
from matchboard.sources.staging import stage

HOT = 2000  # different contents of one minimizer that one task resolves together
GROUP_BYTES = 1 << 19  # content that a task resolves at once, whole minimizers

CUT_BYTES = 1 << 16  # text that is cut into pieces at once, whole documents; its arrays fit a core's cache

NO_ID = (1 << 63) - 1  # stands for a null doc_id, after all others

PIECE = "doc_id bigint, text_hash int, at int, n int, minimizer bigint, content bigint, inner boolean"
RUNS = "minimizer bigint, content bigint, runs array<struct<low:int,high:int>>"


@dataclass(frozen=True)
class Windows:
    """What a document is made of. ``words``: symbols are words, else bytes."""

    width: int
    gram: int
    words: bool

    def symbols(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64-bit symbols of a slice and their bounds per document."""
        if not self.words:
            return kernel.byte_symbols(data), bounds
        starts, ends, word_bounds = kernel.words(data, bounds)
        return kernel.Prefix(kernel.byte_symbols(data)).of(starts, ends), word_bounds


def cut_pieces(kind: Windows, symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, start in it, windows, minimizer, content hash, and whether the minimizer is met twice inside."""
    n = len(symbols) - kind.width + 1
    if n <= 0:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64, bool))
    prefix = kernel.Prefix(symbols)
    grams, span = kernel.gram_hashes(symbols, kind.gram), kind.width - kind.gram + 1
    least = kernel.sliding_min(grams, span)
    fits = np.diff(bounds) >= kind.width
    valid = kernel.covered(bounds[:-1][fits], bounds[1:][fits] - kind.width + 1, len(symbols))[:n]
    change = np.ones(n, dtype=bool)
    change[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(valid & change)
    ends = np.flatnonzero(valid & np.append(change[1:] | ~valid[1:], True)) + 1
    doc = np.searchsorted(bounds, starts, side="right") - 1
    content = prefix.of(starts, ends + kind.width - 1)

    # grams that are the least of some window; two equal ones in a row within one piece make it repeat itself
    most = ~kernel.sliding_min(np.pad(~np.where(valid, least, 0), span - 1, constant_values=~np.uint64(0)), span)
    chosen = np.flatnonzero((grams == most) & (most > 0))
    first, second = chosen[:-1], chosen[1:]
    same = grams[first] == grams[second]
    first, second = first[same], second[same]
    piece = np.searchsorted(starts, np.maximum(second - span + 1, 0), side="right") - 1
    piece = np.maximum(piece, np.searchsorted(starts, bounds[np.searchsorted(bounds, second, side="right") - 1]))
    if len(starts):
        piece = np.clip(piece, 0, len(starts) - 1)
        twice = (starts[piece] <= first) & (second < ends[piece] + span - 1) & (least[starts[piece]] == grams[first])
        inner = np.bincount(piece[twice], minlength=len(starts)) > 0
    else:
        inner = np.zeros(0, dtype=bool)
    return doc, starts - bounds[doc], ends - starts, least[starts].view(np.int64), content.view(np.int64), inner


def _pieces(kind: Windows):
    names = [part.split()[0] for part in PIECE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, bounds in kernel.slices(batch.column(2), CUT_BYTES):
                doc, at, n, minimizer, content, inner = cut_pieces(kind, *kind.symbols(data, bounds))
                ids = batch.column(0)[first:after].take(pa.array(doc))
                hashes = batch.column(1)[first:after].take(pa.array(doc))
                yield pa.RecordBatch.from_arrays(
                    [ids, hashes, pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(minimizer), pa.array(content), pa.array(inner)],
                    names=names,
                )

    return run


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.hash(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            part = batch.slice(first, 500)
            packed = [squeeze((text or "").encode()) for text in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(packed, pa.binary())], names=["doc_id", "text_hash", "packed"]
            )


def packed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and the compressed text, the form in which texts are shuffled."""
    return keyed(docs).mapInArrow(_squeeze, "doc_id bigint, text_hash int, packed binary")


PART = 250  # rows whose texts a task holds at once when it packs or unpacks them


def pack_text(docs: DataFrame) -> DataFrame:
    """``docs`` with the column ``text`` compressed to binary, for a shuffle of whole rows."""
    at, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for first in range(0, batch.num_rows, PART):
                part = batch.slice(first, PART)
                columns = list(part.columns)
                packed = [None if t is None else squeeze(t.encode()) for t in columns[at].to_pylist()]
                columns[at] = pa.array(packed, pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [StructField("text", BinaryType()) if f.name == "text" else f for f in docs.schema]
    return docs.mapInArrow(run, StructType(fields))


def unpack_text(rows: DataFrame, edit: Callable[[bytes, pa.RecordBatch, int], bytes] | None = None) -> DataFrame:
    """The reverse of ``pack_text``; ``edit`` may change the bytes of a row's text first."""
    at, names = rows.columns.index("text"), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for first in range(0, batch.num_rows, PART):
                part = batch.slice(first, PART)
                texts: list[str | None] = []
                for k, packed in enumerate(part.column(at).to_pylist()):
                    raw = None if packed is None else expand(packed)
                    if raw and edit:
                        raw = edit(raw, part, k)
                    texts.append(None if raw is None else raw.decode(errors="ignore"))
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [StructField("text", StringType()) if f.name == "text" else f for f in rows.schema]
    return rows.mapInArrow(run, StructType(fields))


def unpacked(packed: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(p) for p in packed.to_pylist()]


def with_document(texts: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``texts`` joined with per-document ``rows`` on doc_id and text_hash."""
    right = rows.withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"})
    same = texts.doc_id.eqNullSafe(right._d) & texts.text_hash.eqNullSafe(right._h)
    return texts.join(right, same, how).drop("_d", "_h")


def _fetch(kind: Windows):
    """Content of each wanted piece, from its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (text,) = unpacked(batch.column("packed")[k : k + 1])
                wanted = batch.column("wanted")[k].as_py()
                if kind.words:
                    words = text.split()
                    cut = [b" ".join(words[w["at"] : w["at"] + w["n"] + kind.width - 1]) for w in wanted]
                else:
                    cut = [text[w["at"] : w["at"] + w["n"] + kind.width - 1] for w in wanted]
                columns = [pa.array([w[c] for w in wanted], pa.int64()) for c in ("minimizer", "content", "first", "times", "contents")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cut, pa.binary())], names=names)

    names = ["minimizer", "content", "first", "times", "contents", "piece"]
    return run


FETCHED = "minimizer bigint, content bigint, first bigint, times bigint, contents bigint, piece binary"

#: (bytes, bounds of pieces, group of each piece, least doc_id, occurrences) to (piece, low, high) of removed windows
Resolve = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def window_runs(owner: np.ndarray, offset: np.ndarray, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, low, high) of the runs of removed windows; rows are ordered by owner and offset."""
    before = np.zeros(len(removed), dtype=bool)
    before[1:] = removed[:-1] & (owner[1:] == owner[:-1])
    after = np.zeros(len(removed), dtype=bool)
    after[:-1] = removed[1:] & (owner[1:] == owner[:-1])
    low, high = np.flatnonzero(removed & ~before), np.flatnonzero(removed & ~after)
    return owner[low], offset[low], offset[high] + 1


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows of about ``GROUP_BYTES``, cut between minimizers only."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        minimizers = batch.column("minimizer").to_numpy()
        sizes = np.diff(kernel.buffers(batch.column("piece"))[1])
        edges = [*(np.flatnonzero(minimizers[1:] != minimizers[:-1]) + 1).tolist(), batch.num_rows]
        low, done = 0, 0
        if held and batch.num_rows and held[-1].column("minimizer")[-1].as_py() != int(minimizers[0]) and size >= GROUP_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        total = np.concatenate(([0], np.cumsum(sizes)))
        for edge in edges[:-1]:
            if size + int(total[edge] - total[done]) >= GROUP_BYTES:
                held.append(batch.slice(low, edge - low))
                yield pa.Table.from_batches(held)
                held, size, low, done = [], 0, edge, edge
        if low < batch.num_rows:
            held.append(batch.slice(low))
            size += int(total[-1] - total[done])
    if held:
        yield pa.Table.from_batches(held)


def _resolver(resolve: Resolve):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches):
            data, bounds = kernel.buffers(pa.concat_arrays(table["piece"].chunks))
            data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
            minimizers, contents = table["minimizer"].to_numpy(), table["content"].to_numpy()
            group = np.cumsum(np.concatenate(([0], minimizers[1:] != minimizers[:-1])))
            piece, low, high = resolve(data, bounds, group, table["first"].to_numpy(), table["times"].to_numpy())
            where = np.unique(piece)
            edges = np.searchsorted(piece, np.append(where, len(minimizers)))
            runs = [
                [{"low": int(a), "high": int(b)} for a, b in zip(low[x:y], high[x:y], strict=True)]
                for x, y in zip(edges[:-1], edges[1:], strict=True)
            ]
            kind_of = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(minimizers[where]), pa.array(contents[where]), pa.array(runs, kind_of)],
                names=["minimizer", "content", "runs"],
            )

    return run


def _opened(kind: Windows):
    """One row per window of a content: for minimizers with more contents than a task should hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, bounds in kernel.slices(batch.column("piece")):
                symbols, marks = kind.symbols(data, bounds)
                if len(symbols) < kind.width:
                    continue
                hashes = kernel.Prefix(symbols).all(kind.width)
                n = np.maximum(np.diff(marks) - kind.width + 1, 0)
                owner = np.repeat(np.arange(after - first), n)
                offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                take = pa.array(owner)
                columns = [batch.column(c)[first:after].take(take) for c in ("minimizer", "content", "first", "times")]
                window = pa.array(hashes[marks[:-1][owner] + offset].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(offset, pa.int32()), window],
                    names=["minimizer", "content", "first", "times", "offset", "window"],
                )

    return run


OPENED = "minimizer bigint, content bigint, first bigint, times bigint, offset int, window bigint"


def removed_windows(docs: DataFrame, kind: Windows, resolve: Resolve, earlier: bool) -> DataFrame:
    """doc_id, text_hash and the runs [low, high) of removed window starts of each document with any.

    A window is removed if it occurs anywhere else, or with ``earlier`` if it occurs in a
    document with a smaller doc_id (a null one comes last).
    """
    pieces = keyed(docs).mapInArrow(_pieces(kind), PIECE)
    # partial sums first: a minimizer of many rows reaches the shuffle once per task
    shared = (
        pieces.groupBy("minimizer")
        .agg(
            F.count("*").alias("times"),
            F.min("content").alias("one"),
            F.max("content").alias("other"),
            F.max(F.col("inner") & F.lit(not earlier)).alias("inner"),
        )
        .where("times > 1 or inner")
        .select("minimizer", (F.expr("one <> other or inner")).alias("branches"))
    )
    met = stage(join_split(pieces.drop("inner"), shared, ["minimizer"]), "pieces")
    rank = F.coalesce("doc_id", F.lit(NO_ID))
    source = F.struct(rank.alias("rank"), "text_hash", "at", "doc_id", "n")
    contents = met.groupBy("minimizer", "content", "branches").agg(
        F.count("*").alias("times"), F.min(rank).alias("first"), F.min(source).alias("source")
    )
    # a whole piece is removed if it is met again; what stays open are single contents of branching minimizers
    sizes = contents.where("branches").groupBy("minimizer").agg(F.count("*").alias("contents"))
    open_ = join_split(contents.where("branches"), sizes, ["minimizer"])
    wanted = open_.groupBy(F.col("source.doc_id").alias("doc_id"), F.col("source.text_hash").alias("text_hash")).agg(
        F.collect_list(
            F.struct("source.at", "source.n", "minimizer", "content", "first", "times", "contents")
        ).alias("wanted")
    )
    fetched = with_document(packed_texts(docs), wanted, "inner").select("packed", "wanted").mapInArrow(_fetch(kind), FETCHED)
    fetched = stage(fetched.dropDuplicates(["minimizer", "content"]), "contents")
    usual = fetched.where(F.col("contents") <= HOT).repartition("minimizer").sortWithinPartitions("minimizer", "content")
    runs = usual.mapInArrow(_resolver(resolve), RUNS)
    runs = runs.unionByName(_resolve_rows(fetched.where(F.col("contents") > HOT), kind, earlier))
    runs = runs.dropDuplicates(["minimizer", "content"])

    whole = F.col("first") < rank if earlier else F.col("times") > 1
    # equal contents of one minimizer meet in a partial aggregate, so this side has one row for each
    judged = contents.select("minimizer", "content", "first", "times").join(runs, ["minimizer", "content"], "left")
    spans = join_split(met.select("doc_id", "text_hash", "at", "n", "minimizer", "content"), judged, ["minimizer", "content"])
    spans = spans.select(
        "doc_id",
        "text_hash",
        F.explode(
            F.when(whole, F.array(F.struct(F.col("at").alias("low"), (F.col("at") + F.col("n")).alias("high")))).otherwise(
                F.transform("runs", lambda r: F.struct((r.low + F.col("at")).alias("low"), (r.high + F.col("at")).alias("high")))
            )
        ).alias("span"),
    )
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans"))


def _resolve_rows(fetched: DataFrame, kind: Windows, earlier: bool) -> DataFrame:
    """The same as ``resolve``, with windows spread over the cluster by their hash."""
    rows = fetched.mapInArrow(_opened(kind), OPENED)
    found = rows.groupBy("minimizer", "window").agg(F.min("first").alias("least"), F.sum("times").alias("met"))
    joined = join_split(rows, found, ["minimizer", "window"])
    removed = joined.where(F.col("least") < F.col("first") if earlier else F.col("met") > F.lit(1))
    # offsets of one content: at most its own windows
    return removed.groupBy("minimizer", "content").agg(
        F.collect_list(F.struct(F.col("offset").alias("low"), (F.col("offset") + 1).alias("high"))).alias("runs")
    )
