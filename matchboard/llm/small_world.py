"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one per shard.

Vectors of one label and dimension are compared with each other only. Exact copies become
one class first. The classes of a label are dealt by hash to shards of about ``shard``
classes; each shard builds a graph over its classes and is queried by them and by the
classes of every shard before it, so each pair of shards meets once. Links found are
verified by cosine in double precision. Nothing is capped: a query whose beam is still full
of links at its end is compared with the whole shard.

Every shard audits its own recall against brute force before it answers: by a sample of its
vectors, and by as many made-up queries that lie exactly at the threshold from an indexed
vector, so that an audit never passes for want of links. The beam doubles until both
recalls reach ``recall``; a beam as wide as the shard is a full comparison.

A task holds one shard, its graph and a block of queries. It gives link counts and, for each
vector with a link, one vector of its component in that shard, never pairs. Vectors are
sent to each shard from their own on, so the rows sent are vectors times half the shards of
their label: larger shards cost memory (a graph takes about 200 bytes and two copies of its
vectors) and save shuffle.

Null label, null, empty or zero vectors, and vectors with null or non-finite components: no
links. Rows are vectors of their own, also when a vec_id is repeated; a null vec_id takes
part and is never kept, and a component of such rows only has a null component_id. Empty
table: no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchboard.llm.components import components
from matchboard.sources.staging import stage

BLOCK = 256  # queries that walk a graph side by side
STEP = 4  # vertices that a query expands at once


@dataclass(frozen=True)
class SmallWorld:
    cosine: float = 0.93
    shard: int = 16_384  # classes of a graph, about
    links: int = 16  # neighbours of a vertex; twice as many on the ground layer
    width: int = 48  # first beam, also while building
    recall: float = 0.99  # of the audits
    audit: int = 128  # vectors a shard is audited by


class Graph:
    """A navigable graph over unit vectors (float32, one row each)."""

    def __init__(self, unit: np.ndarray, settings: SmallWorld):
        n = len(unit)
        self.unit, self.width = unit, min(settings.width, max(n, 1))
        # The level of a vertex is drawn by its place; equal input gives an equal graph.
        draw = np.random.default_rng(n).random(n)
        level = (-np.log(np.maximum(draw, 1e-12)) / np.log(settings.links)).astype(int)
        order = np.argsort(-level, kind="stable")  # upper layers first: a prefix of the order
        self.layers: list[np.ndarray] = []
        self.entry = order[:1]
        for height in range(int(level.max()), -1, -1) if n else ():
            members = order[: int((level >= height).sum())]
            degree = settings.links * (2 if height == 0 else 1)
            self.layers.append(self._build(members, degree, settings.links))

    def _build(self, members: np.ndarray, degree: int, pick: int) -> np.ndarray:
        """Neighbour lists (vertex, degree) of one layer, -1 where there is none."""
        near = np.full((len(self.unit), degree), -1, dtype=np.int32)
        done = 0
        while done < len(members):
            batch = members[done : done + min(max(64, done // 2), 2048)]
            found = np.empty((len(batch), 0), dtype=np.int32)
            if done:
                found = np.vstack(
                    [
                        self._walk(near, self.unit[batch[k : k + BLOCK]], self._descend(self.unit[batch[k : k + BLOCK]]), self.width)[0]
                        for k in range(0, len(batch), BLOCK)
                    ]
                )
            # Vertices of a batch do not meet by walking, so they are compared at once.
            beside = self.unit[batch] @ self.unit[batch].T
            np.fill_diagonal(beside, -2)
            top = min(len(batch) - 1, degree)
            if top > 0:
                nearest = np.argpartition(-beside, top - 1, axis=1)[:, :top]
                found = np.hstack([found, batch[nearest].astype(np.int32)])
            near[batch] = self._spread(batch, found, degree)
            self._point_back(near, batch, degree)
            done += len(batch)
        return near

    def _spread(self, vertices: np.ndarray, found: np.ndarray, degree: int) -> np.ndarray:
        """Up to ``degree`` of the found vertices, those first that no chosen one is nearer to."""
        out = np.full((len(vertices), degree), -1, dtype=np.int32)
        for k in range(0, len(vertices), BLOCK):
            out[k : k + BLOCK] = self._spread_block(vertices[k : k + BLOCK], found[k : k + BLOCK], degree)
        return out

    def _spread_block(self, vertices: np.ndarray, found: np.ndarray, degree: int) -> np.ndarray:
        rows = np.arange(len(vertices))
        here = (found >= 0) & (found != vertices[:, None])
        sims = np.where(here, np.einsum("ad,akd->ak", self.unit[vertices], self.unit[found]), -2).astype(np.float32)
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * degree]
        found, sims = np.take_along_axis(found, order, 1), np.take_along_axis(sims, order, 1)
        width = found.shape[1]
        if not width:
            return np.full((len(vertices), degree), -1, dtype=np.int32)
        between = np.matmul(self.unit[found], self.unit[found].transpose(0, 2, 1))
        real = sims > -2
        kept = np.zeros((len(vertices), width), dtype=bool)
        for k in range(width):
            rival = np.where(kept, between[:, k, :], -2).max(axis=1)
            kept[:, k] = real[:, k] & (rival < sims[:, k])
        # Chosen ones by similarity, then the others by similarity.
        place = np.argsort(np.where(kept, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :degree]
        out = np.full((len(vertices), degree), -1, dtype=np.int32)
        picked = np.take_along_axis(np.where(real, found, -1), place, 1)
        out[rows[:, None], np.arange(picked.shape[1])] = picked
        return out

    def _point_back(self, near: np.ndarray, batch: np.ndarray, degree: int) -> None:
        """Add the links of a batch to the lists of the vertices they lead to."""
        source = np.repeat(batch, near.shape[1])
        target = near[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        sims = np.einsum("ad,ad->a", self.unit[source], self.unit[target])
        order = np.lexsort((-sims, target))
        source, target = source[order], target[order]
        first = np.r_[True, target[1:] != target[:-1]]
        begin = np.flatnonzero(first)
        place = np.arange(len(target)) - begin[np.cumsum(first) - 1]
        ends = target[begin]
        row = np.cumsum(first) - 1
        fits = place < degree  # the nearest newcomers; all others keep their own link to it
        new = np.full((len(ends), degree), -1, dtype=np.int32)
        new[row[fits], place[fits]] = source[fits]
        both = np.hstack([near[ends], new])
        both = np.sort(both, axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        near[ends] = self._spread(ends, both, degree)

    def _descend(self, queries: np.ndarray) -> np.ndarray:
        """For each query, vertices to start from on the layer below those that are built."""
        start = np.broadcast_to(self.entry[:1], (len(queries), 1))
        for near in self.layers:
            start = self._walk(near, queries, start, 4)[0]
        return start

    def _walk(self, near: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries side by side: (vertices, similarities), best first."""
        count = len(queries)
        ids = np.full((count, width), -1, dtype=np.int32)
        sims = np.full((count, width), -2, dtype=np.float32)
        open_ = np.zeros((count, width), dtype=bool)
        seen = np.zeros((count, len(self.unit)), dtype=bool)
        rows, new = np.arange(count), np.array(start, dtype=np.int32)
        while len(rows):
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            fresh = (new >= 0) & ~seen[rows[:, None], new]
            at, place = np.nonzero(fresh)
            seen[rows[at], new[at, place]] = True
            close = np.full(new.shape, -2, dtype=np.float32)
            close[at, place] = np.einsum("ad,ad->a", queries[rows[at]], self.unit[new[at, place]])
            all_ids = np.hstack([ids[rows], np.where(fresh, new, -1)])
            all_sims = np.hstack([sims[rows], close])
            all_open = np.hstack([open_[rows], fresh])
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[rows] = np.take_along_axis(all_ids, best, 1)
            sims[rows] = np.take_along_axis(all_sims, best, 1)
            open_[rows] = np.take_along_axis(all_open, best, 1)
            rows = rows[open_[rows].any(axis=1)]
            if not len(rows):
                break
            chosen = np.argsort(~open_[rows], axis=1, kind="stable")[:, :STEP]
            usable = np.take_along_axis(open_[rows], chosen, 1)
            open_[rows[:, None], chosen] = False
            step = near[np.where(usable, np.take_along_axis(ids[rows], chosen, 1), 0)]
            new = np.where(usable[:, :, None], step, -1).reshape(len(rows), -1)
        return ids, sims

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.broadcast_to(self.entry[:1], (len(queries), 1))
        for near in self.layers[:-1]:
            start = self._walk(near, queries, start, 4)[0]
        return self._walk(self.layers[-1], queries, start, width)


class Shard:
    """Links of the classes of one shard, and of queries to it."""

    def __init__(self, nodes: list[bytes], vectors: np.ndarray, weights: np.ndarray, settings: SmallWorld):
        self.settings, self.nodes, self.weights = settings, nodes, weights
        self.exact = _units(vectors)
        self.graph = Graph(self.exact.astype(np.float32), settings)
        self.links = np.zeros(len(nodes), dtype=np.int64)
        self.root = np.arange(len(nodes))
        self.width, self.measured = self._audit()

    def _audit(self) -> tuple[int, float]:
        """The first beam that passes, and its recall."""
        s, n = self.settings, len(self.nodes)
        rng = np.random.default_rng(n)
        own = np.unique(np.linspace(0, n - 1, min(n, s.audit)).astype(int))
        noise = rng.standard_normal((len(own), self.exact.shape[1]))
        noise -= (noise * self.exact[own]).sum(axis=1, keepdims=True) * self.exact[own]
        noise = _units(noise)
        # a hair above the threshold, so that rounding does not decide
        level = min(s.cosine + 1e-9, 1.0)
        asked = np.vstack([self.exact[own], level * self.exact[own] + np.sqrt(1 - level**2) * noise])
        if not n or self.exact.shape[1] < 2:
            return max(n, 1), 1.0
        truth = asked @ self.exact.T >= s.cosine
        width = min(s.width, n)
        while True:
            hits = self._hits(asked, width)
            found = sum(int(truth[k, where].sum()) for k, where, _ in hits)
            recall = found / max(int(truth.sum()), 1)
            planted = np.mean([own[k - len(own)] in set(where.tolist()) for k, where, _ in hits if k >= len(own)])
            if (recall >= s.recall and planted >= s.recall) or width >= n:
                return width, min(recall, float(planted))
            width = min(2 * width, n)

    def _hits(self, queries: np.ndarray, width: int) -> list[tuple[int, np.ndarray, bool]]:
        """(query, linked classes, compared with all) of each query.

        A beam that is full of links gives way to a comparison with all classes.
        """
        out = []
        for k in range(0, len(queries), BLOCK):
            block = queries[k : k + BLOCK]
            n = len(self.nodes)
            if width >= n:
                full = np.ones(len(block), dtype=bool)
            else:
                ids, sims = self.graph.search(block.astype(np.float32), width)
                full = (sims[:, -1] >= self.settings.cosine - 1e-5) & (ids[:, -1] >= 0)
                at, place = np.nonzero((sims >= self.settings.cosine - 1e-5) & (ids >= 0) & ~full[:, None])
                known = ids[at, place]
                true = np.einsum("ad,ad->a", block[at], self.exact[known]) >= self.settings.cosine
                at, known = at[true], known[true]
                bounds = np.searchsorted(at, np.arange(len(block) + 1))
            dense = np.flatnonzero(full)
            every = block[dense] @ self.exact.T >= self.settings.cosine
            row = dict(zip(dense.tolist(), range(len(dense))))
            for q in range(len(block)):
                if q in row:
                    out.append((k + q, np.flatnonzero(every[row[q]]), True))
                elif bounds[q] < bounds[q + 1]:
                    out.append((k + q, np.sort(known[bounds[q] : bounds[q + 1]]), False))
                else:
                    out.append((k + q, known[:0], False))
        return out

    def _join(self, linked: np.ndarray) -> None:
        """Put linked classes into one component."""
        roots = np.unique(self.root[linked])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots)] = roots[0]

    def own_links(self) -> None:
        """Count and join the links inside the shard; one found from either end counts at both."""
        n = len(self.nodes)
        few: set[tuple[int, int]] = set()  # links with an end that was not compared with all
        whole = np.zeros(n, dtype=bool)
        many: list[tuple[int, np.ndarray]] = []
        for k in range(0, n, BLOCK):
            for q, linked, compared in self._hits(self.exact[k : k + BLOCK], self.width):
                q += k
                linked = linked[linked != q]
                if not len(linked):
                    continue
                self._join(np.append(linked, q))
                if compared:
                    whole[q] = True
                    self.links[q] = self.weights[linked].sum()
                    many.append((q, linked.astype(np.int32)))
                else:
                    few.update((min(q, x), max(q, x)) for x in linked.tolist())
            # Of those compared with all, only links to short lists are kept on.
            if sum(len(x) for _, x in many) > 1 << 22:
                many = self._short_ends(many, few, whole, k + BLOCK)
        for q, linked in many:
            few.update((min(q, x), max(q, x)) for x in linked[~whole[linked]].tolist())
        for a, b in few:
            if not whole[a]:
                self.links[a] += self.weights[b]
            if not whole[b]:
                self.links[b] += self.weights[a]

    @staticmethod
    def _short_ends(many: list, few: set, whole: np.ndarray, done: int) -> list:
        """Settle links to classes already asked; keep those to classes still to come."""
        later = []
        for q, linked in many:
            past = linked[linked < done]
            few.update((min(q, x), max(q, x)) for x in past[~whole[past]].tolist())
            if len(linked) > len(past):
                later.append((q, linked[linked >= done]))
        return later

    def foreign(self, nodes: list[bytes], vectors: np.ndarray, weights: np.ndarray) -> Iterator[tuple[bytes, int, bytes]]:
        """(query, links, a class it is linked with) for queries of other shards."""
        for q, linked, _ in self._hits(_units(vectors), self.width):
            if len(linked):
                self._join(linked)
                self.links[linked] += weights[q]
                yield nodes[q], int(self.weights[linked].sum()), self.nodes[linked[0]]

    def members(self) -> Iterator[tuple[bytes, int, bytes]]:
        for k in np.flatnonzero(self.links):
            yield self.nodes[k], int(self.links[k]), self.nodes[self.root[k]]


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest part first, so that no square overflows."""
    if not vectors.size:
        return vectors.astype(np.float64)
    large = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / np.where(large > 0, large, 1)
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(length > 0, length, 1)


_ROWS = "vec_id bigint, label string, dim int, node binary, vector binary"


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and bytes of each comparable vector; null for the others."""
    for batch in batches:
        ids, labels, lists = batch.column(0), batch.column(1), batch.column(2)
        out: list[tuple] = []
        parts = lists.values.to_numpy(zero_copy_only=False).astype(np.float64) if len(lists.values) else np.zeros(0)
        offsets = lists.offsets.to_numpy()
        present = lists.is_valid().to_numpy(zero_copy_only=False)
        for k, label in enumerate(labels.to_pylist()):
            vector = parts[offsets[k] : offsets[k + 1]]
            if label is None or not present[k] or not np.isfinite(vector).all() or not vector.any():
                out.append((None, None, None, None))
                continue
            raw = vector.tobytes()
            node = hashlib.sha256(f"{len(label)}:{label}".encode() + raw).digest()[:16]
            out.append((label, len(vector), node, raw))
        columns = list(zip(*out)) if out else [(), (), (), ()]
        kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary()]
        arrays = [ids, *[pa.array(c, kind) for c, kind in zip(columns, kinds)]]
        yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "dim", "node", "vector"])


def _search(settings: SmallWorld):
    """Rows of shards, members before queries, to counts and a class of the same component."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [(), (), ()]
        kinds = [pa.binary(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["node", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, shard, waiting = None, None, []

        def answer() -> list[tuple]:
            """Use what is waiting: as members if the shard is not built yet, else as queries."""
            nonlocal shard, waiting
            rows, waiting = waiting, []
            if not rows:
                return []
            nodes = [r[0] for r in rows]
            vectors = np.frombuffer(b"".join(r[1] for r in rows)).reshape(len(rows), -1)
            weights = np.array([r[2] for r in rows], dtype=np.int64)
            if shard is None:
                shard = Shard(nodes, vectors, weights, settings)
                shard.own_links()
                return []
            return list(shard.foreign(nodes, vectors, weights))

        def close() -> list[tuple]:
            rows = answer()
            return rows + (list(shard.members()) if shard is not None else [])

        kind = None
        for batch in batches:
            for label, dim, number, query, node, vector, weight in zip(*[c.to_pylist() for c in batch.columns]):
                if (label, dim, number) != group:
                    if group is not None:
                        yield out(close())
                    group, shard, kind = (label, dim, number), None, False
                if query and not kind:
                    yield out(answer())
                    kind = True
                waiting.append((node, vector, weight))
                if kind and len(waiting) >= 4096:
                    yield out(answer())
        if group is not None:
            yield out(close())

    return run


def near_vectors(vectors: DataFrame, settings: SmallWorld = SmallWorld()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    plain = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>"))
    rows = stage(plain.mapInArrow(_prepare, _ROWS), "vectors")
    # Copies meet once; the map side counts them before the shuffle.
    classes = rows.where("node is not null").groupBy("label", "dim", "node", "vector")
    classes = stage(classes.agg(F.count("*").alias("weight"), F.min("vec_id").alias("least")), "classes")
    sizes = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / settings.shard).cast("int").alias("shards"))
    # One more key column: both inputs are then plain shuffles, and a hot label is split.
    probe = F.xxhash64("label", "dim").alias("probe")
    placed = classes.withColumn("probe", probe).join(sizes.withColumn("probe", probe), ["label", "dim", "probe"])
    home = F.expr("pmod(xxhash64(node), shards)").cast("int")
    placed = placed.withColumn("home", home).withColumn("shard", F.explode(F.expr("sequence(home, shards - 1)")))
    dealt = placed.select(
        "label", "dim", "shard", (F.col("shard") != F.col("home")).alias("query"), "node", "vector", "weight"
    )
    dealt = dealt.repartition("label", "dim", "shard").sortWithinPartitions("label", "dim", "shard", "query", "node")
    found = stage(dealt.mapInArrow(_search(settings), "node binary, links bigint, other binary"), "links")

    joined = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = classes.select("node", "weight", "least").join(joined, "node", "left").join(linked, "node", "left")
    grouped = stage(
        grouped.select(
            "node",
            F.coalesce("component", "node").alias("component"),
            "least",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "classes",
    )
    least = stage(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "components")
    known = stage(grouped.join(least, "component").select("node", "n_links", "component_id"), "classes")
    alone = F.col("known_node").isNull()
    result = rows.select("vec_id", "node").join(
        known.withColumnRenamed("node", "known_node"), F.col("node") == F.col("known_node"), "left"
    )
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
    SELECT vec_id, vec_id AS other FROM vectors
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), components AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), counts AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT c.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM components c LEFT JOIN counts n ON n.a = c.vec_id
"""
