"""Token ids in fixed-width bit-packed files (operator 4).

Documents are range-partitioned and sorted by doc_id, then encoded, so that each
partition writes one run of the order. A run is a sequence of blocks of whole documents
with about ``BLOCK_IDS`` ids. A block stores its ids in ``width`` bits each, the least
that hold the vocabulary, low bits first, in one binary value, with the number of ids
before it in its run and the place of each document inside it. So any id is found by
arithmetic, and numpy unpacks any range without a loop.

File format, one row per block: run int, block int, first_id long (ids of the run before
the block), width int, n_ids long, doc_ids array<long>, starts array<long> (in the
block), packed binary. Blocks are written as Parquet rows, so any store that Spark
writes will do, and lost tasks are written again by Spark's commit.

Defined results: a null or empty text is only the end id; documents with a null doc_id
come first; equal doc_ids are ordered by a hash of the text, then arbitrarily but once;
the written name of an added token in a text becomes that token, as in the tokenizer's
library; other columns are ignored; an empty table writes an empty file set.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchboard.llm.pieces import Memory, chunks, collector_paused
from matchboard.sources.staging import scratch_path

BLOCK_IDS = 1 << 16
END = 0
LIMIT_CHUNKS = 300_000
LIMIT_MARKS = 10_000
# perhaps a space, Latin letters (the same in every Unicode version), and ASCII marks
_WORD = re.compile(r"( ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+)([!-/:-@\[-`{-~]*)").fullmatch

# how byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = iter(range(256, 512))
_LETTERS = {b: chr(b if b in _PRINTABLE else next(_OTHERS)) for b in range(256)}

FILE_SCHEMA = (
    "run int, block int, first_id bigint, width int, n_ids bigint, first_doc bigint, last_doc bigint, "
    "doc_ids array<bigint>, starts array<bigint>, packed binary"
)
ROW_SCHEMA = "run int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def bits_for(vocabulary: int) -> int:
    """Least number of bits that tell ``vocabulary`` ids apart."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, low bits first."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint64)[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(packed: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from id ``start`` of a block, reading only their bytes."""
    first = start * width
    low, high = first // 8, (first + count * width + 7) // 8
    raw = np.frombuffer(packed, dtype=np.uint8)[low:high]
    if width in (8, 16, 32):
        return raw.view(f"<u{width // 8}").astype(np.uint32)
    bits = np.unpackbits(raw, bitorder="little")[first - low * 8 :][: count * width]
    weights = np.uint32(1) << np.arange(width, dtype=np.uint32)
    return (bits.reshape(count, width).astype(np.uint32) * weights).sum(axis=1, dtype=np.uint32)


_loaded: dict[str, tuple[Memory, int, re.Pattern | None]] = {}


def _tokenizer(path: str) -> tuple[Memory, int, re.Pattern | None]:
    """Memory of chunks as little-endian 32-bit ids, vocabulary size, pattern of added tokens."""
    if path not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("added tokens that depend on their neighbours are not supported")
        names = sorted((t.content for t in added), key=len, reverse=True)
        # one group, so that a split keeps the names
        special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

        word_ids = tokenizer.model.tokenize
        marks: dict[str, bytes] = {"": b""}

        def whole(texts: list[str]) -> list[bytes]:
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [array("I", e.ids).tobytes() for e in found]

        def encode(new: list[str]) -> list[bytes]:
            """A word of letters and the marks after it are encoded apart, as the pattern cuts
            between them; all other chunks go through the library as they are. Words are not
            remembered beside the chunks: few come back with other marks."""
            if len(marks) > LIMIT_MARKS:
                marks.clear()
                marks[""] = b""
            out: list[bytes | None] = []
            others = []
            for chunk in new:
                cut = _WORD(chunk)
                if cut is None:
                    others.append(chunk)
                    out.append(None)
                    continue
                word, tail = cut.groups()
                if tail not in marks:
                    (marks[tail],) = whole([tail])
                letters = word.replace(" ", "Ġ") if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
                out.append(array("I", [t.id for t in word_ids(letters)]).tobytes() + marks[tail])
            if others:
                rest = iter(whole(others))
                out = [next(rest) if coded is None else coded for coded in out]
            return out

        _loaded[path] = Memory(encode, LIMIT_CHUNKS), tokenizer.get_vocab_size(with_added_tokens=True), special
    return _loaded[path]


def _chunks(text: str, special: re.Pattern | None) -> list[str]:
    """Chunks of a text, each added token being one; the text beside it is cut on its own."""
    if special is None or special.search(text) is None:
        return chunks(text)
    out: list[str] = []
    for k, part in enumerate(special.split(text)):
        out += [part] if k % 2 else chunks(part)
    return out


def _encode(texts: list[str], path: str) -> list[bytes]:
    memory, _, special = _tokenizer(path)
    with collector_paused():
        parts = [_chunks(t, special) for t in texts]
        known = memory.look_up(parts)
        return [b"".join(map(known.__getitem__, p)) for p in parts]


def _writer(path: str, end: int, block_ids: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = bits_for(max(_tokenizer(path)[1], end + 1))
        tail = np.array([end], dtype="<u4").tobytes()
        run, block, first_id = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, first_id, size
            counts = np.array([len(x) // 4 for x in held], dtype=np.int64)
            values = np.frombuffer(b"".join(held), dtype="<u4")
            row = {
                "run": [run],
                "block": [block],
                "first_id": [first_id],
                "width": [width],
                "n_ids": [len(values)],
                "first_doc": [next((x for x in ids if x is not None), None)],
                "last_doc": [ids[-1]],
                "doc_ids": [list(ids)],
                "starts": [(np.cumsum(counts) - counts).tolist()],
                "packed": [pack(values, width)],
            }
            block, first_id, size = block + 1, first_id + len(values), 0
            ids.clear()
            held.clear()
            return pa.RecordBatch.from_pydict(row, schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, coded in zip(part.column(0).to_pylist(), _encode(texts, path), strict=True):
                    ids.append(doc)
                    held.append(coded + tail)
                    size += len(coded) // 4 + 1
                    if size >= block_ids:
                        yield flush()
        if held:
            yield flush()

    arrow = pa.schema(
        [
            ("run", pa.int32()),
            ("block", pa.int32()),
            ("first_id", pa.int64()),
            ("width", pa.int32()),
            ("n_ids", pa.int64()),
            ("first_doc", pa.int64()),
            ("last_doc", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("starts", pa.list_(pa.int64())),
            ("packed", pa.binary()),
        ]
    )
    return blocks


def write_packed(docs: DataFrame, path: str, tokenizer: str, end: int = END, block_ids: int = BLOCK_IDS) -> None:
    """Encode every text and write the packed files in ascending doc_id order."""
    spark = docs.sparkSession
    runs = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text", "xxhash64(text) tie")
    ordered = rows.repartitionByRange(runs, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    ordered.mapInArrow(_writer(tokenizer, end, block_ids), FILE_SCHEMA).write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for row in batch.to_pylist():
            ids = unpack(row["packed"], row["width"], 0, row["n_ids"]).astype("<u4")
            raw = memoryview(ids.tobytes())
            ends = chain(row["starts"][1:], [row["n_ids"]])
            for doc, start, stop in zip(row["doc_ids"], row["starts"], ends, strict=True):
                values = (row["run"], doc, row["first_id"] + start, stop - start, zlib.crc32(raw[4 * start : 4 * stop]))
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, types, strict=True)],
            names=["run", "doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start over all runs, n_tokens, ids_crc32."""
    files = spark.read.parquet(path)
    sizes = files.groupBy("run").agg(F.sum("n_ids").alias("ids"))
    # one row per written run, that is per partition of the writing job
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("run", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    rows = files.mapInArrow(_digests, ROW_SCHEMA)
    return rows.join(F.broadcast(base), "run").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def _ids_of(wanted: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                ends = [*row["starts"][1:], row["n_ids"]]
                for doc, start, stop in zip(row["doc_ids"], row["starts"], ends, strict=True):
                    if doc == wanted:
                        found.append(unpack(row["packed"], row["width"], start, stop - start).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], names=["ids"])

    return read


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """Ids of one document: the filter on first and last documents is pushed down, so only
    blocks around it are read, only those that hold it are unpacked, and only its range."""
    wanted = F.lit(doc_id).cast("bigint")
    blocks = spark.read.parquet(path).where((F.col("first_doc") <= wanted) & (F.col("last_doc") >= wanted))
    blocks = blocks.where(F.array_contains("doc_ids", wanted))
    return blocks.mapInArrow(_ids_of(doc_id), "ids array<bigint>")


def token_digests(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """Write the packed files into the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "packed-tokens")
    write_packed(docs, path, tokenizer, end)
    return read_digests(docs.sparkSession, path)
