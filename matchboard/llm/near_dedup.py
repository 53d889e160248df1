"""Near-duplicate documents by bottom-k sketches of one hash function (operator 5).

1. Each text becomes its set of hashed word shingles. Equal sets are represented by their
   least doc_id, so copies cost one row each and no pair.
2. The sketch of a set is its ``k`` least hashes. Sketches are inverted: value to sets. A
   linked pair shares ``least_shared`` retained values (all but certainly, see below), so
   ordered from rare to frequent, the first ``k - least_shared + 1`` values of both sets have
   one in common. Only these enter a list, which keeps frequent shingles out of it.
3. Inside a list, pairs are filtered by length and by the same ``least_shared`` retained
   values (by exact similarity if both sets are wholly retained), and each pair is looked
   at in the list of its rarest common value only. A list emits the sets that still have a
   partner, never pairs.
4. Full sets of these are fetched and verified exactly in the same lists, and a list emits
   a spanning forest of the verified links: one link a set at most.
5. Links are contracted to components.

Lists longer than ``BLOCK`` are dealt into blocks, and every two blocks are one unit of work,
so no task holds an unbounded list and no pair is left out.

With similarity s >= 0.85 the number of shared retained values of two large sets is at
least about binomial (k, s); fewer than 28 of 48 has a probability of 1.8e-6 at s = 0.85 and
falls steeply above. Steps 2 and 3 miss a pair by this one event only, so that is their
joint loss. Sets of up to ``small`` shingles use the exact bound instead.

Defined results: words are lower-cased (A-Z) ``[^\\x20\\x09-\\x0D]+``; null or empty texts have
an empty set and are linked with nothing; rows that share a doc_id are linked; a null
doc_id is linked with nothing, has a null component and is kept; other columns are
ignored by ``near_duplicates`` and kept by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.llm import kernel
from matchboard.llm.components import components
from matchboard.llm.shared_windows import pack_text, packed_texts, unpack_text, unpacked
from matchboard.llm.skew import join_split
from matchboard.sources.staging import stage

BLOCK = 512
# helper columns beside a caller's own
_NODE, _OWNER, _FIRST = "__near_node", "__near_owner", "__near_first"


@dataclass(frozen=True)
class Similarity:
    shingle: int = 3
    percent: int = 85  # 100 * intersection >= percent * union
    k: int = 48
    least_shared: int = 28  # of k, for larger sets
    small: int = 40  # sets up to this size, and all partners of theirs, are wholly in their sketch


#: Five words and 80 percent; fewer than 24 of 48 shared values has a probability of 7.8e-7 at 0.80.
FIVE_WORDS = Similarity(shingle=5, percent=80, k=48, least_shared=24, small=38)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (63 bits, ascending and distinct in a document) and their bounds per document."""
    data = kernel.LOWER[data]
    starts, ends, wb = kernel.words(data, bounds)
    prefix = kernel.Prefix(kernel.Prefix(kernel.byte_symbols(data)).of(starts, ends))
    n = np.diff(wb)
    some = np.flatnonzero(n)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    owner = np.repeat(np.arange(len(n)), count)
    at = wb[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    width = np.minimum(n, shingle)[owner]
    hashes = (prefix.of(at, at + width) >> np.uint64(1)).astype(np.int64) if len(some) else np.zeros(0, np.int64)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(n) + 1))


def _lists(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    sizes = high - low
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    at = np.arange(offsets[-1]) + np.repeat(low - offsets[:-1], sizes)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[at]))


SKETCHED = "doc_id bigint, n int, one bigint, other bigint, sketch array<bigint>"


def _sketcher(how: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, after, data, bounds in kernel.slices(batch.column(1)):
                hashes, sb = shingle_sets(data, bounds, how.shingle)
                mixed = kernel.mix(hashes.view(np.uint64) + np.uint64(1))
                total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed)))
                again = np.concatenate((np.zeros(1, np.uint64), np.cumsum(kernel.mix(mixed + np.uint64(7)))))
                one, other = total[sb[1:]] - total[sb[:-1]], again[sb[1:]] - again[sb[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:after],
                        pa.array(np.diff(sb), pa.int32()),
                        pa.array(one.view(np.int64)),
                        pa.array(other.view(np.int64)),
                        _lists(hashes, sb[:-1], np.minimum(sb[:-1] + how.k, sb[1:])),
                    ],
                    names=["doc_id", "n", "one", "other", "sketch"],
                )

    return run


def _joint_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets of distinct values."""
    m = len(sets)
    joint = np.zeros((m, m), dtype=np.float32)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    column = np.cumsum(fresh) - 1
    times = np.bincount(column)
    often = times[column] > 1
    owner, column = owner[often], column[often]
    column = np.unique(column, return_inverse=True)[1]
    width = 4096
    for low in range(0, int(column.max(initial=-1)) + 1, width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((m, int(column[b - 1]) - low + 1), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        joint += part @ part.T
    return joint.astype(np.int64)


def _alike(sketches: list[np.ndarray], n: np.ndarray, how: Similarity) -> np.ndarray:
    """Pairs that share as many retained values as linked sets do; whole sets are compared exactly."""
    joint = _joint_counts(sketches)
    whole = n <= how.k
    exact = 100 * joint >= how.percent * (n[:, None] + n[None, :] - joint)
    return np.where(whole[:, None] & whole[None, :], exact, joint >= how.least_shared)


def _pairs(rows: list[dict], how: Similarity) -> tuple[np.ndarray, list[np.ndarray]]:
    """Pairs of one unit of work that may be linked, as a matrix, and the sets or sketches."""
    n = np.array([r["n"] for r in rows], dtype=np.int64)
    block = np.array([r["block"] for r in rows])
    sets = [r["values"] for r in rows]
    may = 100 * np.minimum(n[:, None], n[None, :]) >= how.percent * np.maximum(n[:, None], n[None, :])
    if rows[0]["low"] != rows[0]["high"]:
        may &= block[:, None] != block[None, :]
    may &= np.tri(len(rows), k=-1, dtype=bool)
    if may.any():
        rarer = [r["rarer"] for r in rows]
        if sum(map(len, rarer)):
            may &= _joint_counts(rarer) == 0
    if may.any():
        may &= _alike([s[: how.k] for s in sets], n, how)
    return may, sets


UNIT = ["value", "low", "high"]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Consecutive rows of one unit of work; hashes stay numpy views of the batch."""
    held: list[dict] = []
    at: tuple | None = None
    for batch in batches:
        plain = [c for c in batch.schema.names if c not in ("rarer", "values")]
        columns = {c: batch.column(c).to_pylist() for c in plain}
        for c in ("rarer", "values"):
            found = batch.column(c)
            flat, cuts = found.values.to_numpy(), found.offsets.to_numpy()
            columns[c] = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for values in zip(*columns.values(), strict=True):
            row = dict(zip(columns, values, strict=True))
            key = (row["value"], row["low"], row["high"])
            if key != at:
                if len(held) > 1:
                    yield held
                held, at = [], key
            held.append(row)
    if len(held) > 1:
        yield held


PARTNERED = "value bigint, low int, high int, doc_id bigint, n int"


def _partnered(how: Similarity):
    names = [part.split()[0] for part in PARTNERED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            out.clear()
            return batch

        for rows in _units(batches):
            may, _ = _pairs(rows, how)
            for k in np.flatnonzero(may.any(axis=0) | may.any(axis=1)):
                out.append(tuple(rows[k][c] for c in names))
            if len(out) > 10_000:
                yield flush()
        if out:
            yield flush()

    return run


def _linked(how: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _units(batches):
            may, sets = _pairs(rows, how)
            left, right = np.nonzero(may)
            if not len(left):
                continue
            n = np.array([len(s) for s in sets])
            if len(left) > 4 * len(rows):
                joint = _joint_counts(sets)[left, right]
            else:
                joint = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right)])
            sure = 100 * joint >= how.percent * (n[left] + n[right] - joint)
            root = list(range(len(rows)))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for a, b in zip(left[sure].tolist(), right[sure].tolist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
            found = [(rows[k]["doc_id"], rows[find(k)]["doc_id"]) for k in range(len(rows)) if find(k) != k]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


FULL = "value bigint, low int, high int, doc_id bigint, n int, block int, rarer array<bigint>, values array<bigint>"


def _full_sets(how: Similarity):
    """A row per unit of work of a document, with its full set."""
    names = [part.split()[0] for part in FULL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (raw,) = unpacked(batch.column("packed")[k : k + 1])
                data = np.frombuffer(raw, dtype=np.uint8)
                hashes, _ = shingle_sets(data, np.array([0, len(data)]), how.shingle)
                units = batch.column("units")[k].as_py()
                own = pa.array(hashes)
                doc_id = batch.column("doc_id")[k].as_py()
                for u in units:
                    if u["n"] != len(hashes):
                        continue  # another text of the same doc_id
                    row = {**u, "doc_id": doc_id, "n": len(hashes)}
                    columns = [pa.array([row[c]], t) for c, t in zip(names[:-1], types, strict=True)]
                    columns.append(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
    return run


def _prefix_length(how: Similarity) -> Column:
    """Rare retained values of which a linked pair must share one."""
    kept = F.least(F.col("n"), F.lit(how.k))
    needed = F.when(F.col("n") <= how.small, F.ceil(F.col("n") * how.percent / 100)).otherwise(how.least_shared)
    return (kept - needed + 1).cast("int")


def _units_of(entries: DataFrame) -> DataFrame:
    """Blocks and unit of work of every list entry; lists of one set are dropped."""
    sizes = entries.groupBy("value").agg(F.count("*").alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = join_split(entries, sizes, ["value"]).withColumn("parts", parts)
    dealt = dealt.withColumn("block", F.pmod(F.hash("doc_id", "n"), F.col("parts")))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.select(
        "value",
        F.least("block", "with").alias("low"),
        F.greatest("block", "with").alias("high"),
        "doc_id",
        "n",
        "block",
        "rarer",
    )


def near_duplicates(docs: DataFrame, how: Similarity = Similarity()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept."""
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    sketched = rows.mapInArrow(_sketcher(how), SKETCHED)
    identity = ["n", "one", "other"]
    classes = sketched.where("n > 0 and doc_id is not null").groupBy(identity).agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("doc_id") == F.col("least"), F.col("sketch"))
    members = stage(
        join_split(sketched, classes, identity, "left").select("doc_id", "n", "least", own.alias("sketch")), "sketches"
    )
    sets = members.where("sketch is not null").select("doc_id", "n", "sketch")
    retained = sets.select("doc_id", "n", F.explode("sketch").alias("value"))
    shared = retained.groupBy("value").agg(F.count("*").alias("sets")).where("sets > 1")
    lists = join_split(retained, shared, ["value"]).groupBy("doc_id", "n").agg(
        F.array_sort(F.collect_set(F.struct("sets", "value"))).alias("common")
    )
    # values of this set alone come first in the order; what is left of the prefix goes to lists
    alone = F.least(F.col("n"), F.lit(how.k)) - F.size("common")
    taken = F.greatest(_prefix_length(how) - alone, F.lit(0))
    prefixes = lists.select("doc_id", "n", F.slice(F.col("common.value"), F.lit(1), taken).alias("prefix")).where("size(prefix) > 0")
    entries = prefixes.select("doc_id", "n", "prefix", F.posexplode("prefix").alias("at", "value")).select(
        "value", "doc_id", "n", F.slice("prefix", F.lit(1), F.col("at")).alias("rarer")
    )
    units = stage(_units_of(entries), "units")
    with_sketch = units.join(sets.withColumnRenamed("sketch", "values"), ["doc_id", "n"])
    ordered = with_sketch.repartition(*UNIT).sortWithinPartitions(*UNIT, "doc_id", "n")
    partnered = ordered.mapInArrow(_partnered(how), PARTNERED).distinct()
    wanted = units.join(partnered, [*UNIT, "doc_id", "n"], "left_semi")
    wanted = wanted.groupBy("doc_id").agg(F.collect_set(F.struct("value", "low", "high", "n", "block", "rarer")).alias("units"))
    texts = packed_texts(docs).join(wanted, "doc_id")
    full = texts.select("doc_id", "packed", "units").mapInArrow(_full_sets(how), FULL)
    again = full.repartition(*UNIT).sortWithinPartitions(*UNIT, "doc_id", "n")
    links = again.mapInArrow(_linked(how), "a bigint, b bigint")
    several = members.where("least is not null").groupBy("doc_id").agg(F.min("least").alias("b"), F.max("least").alias("most"))
    same_id = join_split(members, several.where("b <> most"), ["doc_id"]).select(F.col("least").alias("a"), "b")
    found = components(links.unionByName(same_id))
    labelled = members.join(found.withColumnRenamed("node", "least"), "least", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "least", "doc_id"))
    return labelled.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each different row of doc_id and text, null for a null doc_id.

    It is the doc_id, but for further texts of one doc_id, which get numbers from 2**62 on by a
    hash of both, so that they come after the first text of every other document.
    """
    doc, text = F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string"), F.isnull("text"))
    hashed = docs.select(doc.alias(_OWNER), text.alias("text")).where(F.col(_OWNER).isNotNull())
    texts = hashed.groupBy(_OWNER).agg(F.min("text").alias(_FIRST), F.max("text").alias("most"))
    # staged, so that its size is known to the join; as a rule it is empty
    several = stage(texts.where(F.col(_FIRST) != F.col("most")).select(_OWNER, _FIRST), "shared-ids")
    rows = join_split(docs.withColumn(_OWNER, doc), several, [_OWNER], "left")
    further = F.lit(1 << 62).bitwiseOR(F.xxhash64(F.col(_OWNER), text).bitwiseAND(F.lit((1 << 62) - 1)))
    number = F.when(F.col(_FIRST).isNull() | (text == F.col(_FIRST)), F.col(_OWNER)).otherwise(further)
    return rows.select(*docs.columns, number.alias(_NODE))


def drop_near_duplicates(docs: DataFrame, how: Similarity = Similarity(), *more: Similarity) -> DataFrame:
    """The rows of ``docs`` that are the least of their component, with all their columns.

    With several rules, documents linked by any of them are in one component. Rows that share a
    doc_id are documents of their own unless their texts are equal: of those with both equal
    one stays. Rows with a null doc_id all stay.
    """
    numbered = _numbered(docs)
    nodes = numbered.select(F.col(_NODE).alias("doc_id"), "text")
    found = near_duplicates(nodes, how)
    if more:
        found = stage(found, "near")
        links = found.selectExpr("doc_id a", "component_id b")
        for other in more:
            links = links.unionByName(near_duplicates(nodes, other).selectExpr("doc_id a", "component_id b"))
        joined = components(links).where("node <> component").select(F.col("node").alias("doc_id"))
        found = found.join(joined, "doc_id", "left_anti")
    kept = found.where("kept and doc_id is not null").select(F.col("doc_id").alias(_NODE)).distinct()
    known = pack_text(numbered.where(F.col(_NODE).isNotNull()))
    one = join_split(known, kept, [_NODE], "left_semi").dropDuplicates([_NODE]).drop(_NODE)
    return unpack_text(one).unionByName(docs.where("doc_id is null"))
