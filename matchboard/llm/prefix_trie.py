"""The trie of conversation prefixes, with subtree totals rolled up in depth bands.

Every conversation is rebuilt first: it borrows opening turns from the first of each five
ids, which gives the shared openings that a trie of real chat logs has. A node is a distinct
sequence of first turns. It is named by a chain of SHA-256 digests (16 bytes of each), so
texts are hashed once where they are read and never shuffled again.

Subtree totals need every node at all its ancestors. Nodes are exploded only to ancestors
inside their band of ``HEIGHT`` depths; the roots of bands then form a trie that is
``HEIGHT`` times flatter, which is rolled up in bands in turn, and so on until one band
holds all depths. On the way back, completed totals of band roots are added to the ancestors
in the band above. So a node is sent at most ``HEIGHT`` times per pass, and the passes grow
with the logarithm of the depth. Sums are combined before each shuffle, so a node with a third
of all conversations below it is a few rows per task.

The chain and the hash over the ids that end at a node are sequential by definition. Both are
streamed in order through one task per conversation or node and hold one digest at a time;
ids come to that task in joined pieces, not as rows.

Null role or text: empty. Null turn: before the others. Equal turns of a conversation: by the
first 64 characters of role and text, then by digest. Repeated rows: turns of their own. Null
conv_id: left out, as it has no number to rebuild from. Empty table: no rows. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchboard.sources.staging import stage

HEIGHT = 16  # depths of a band
GROUP, OPENING = 5, 9  # ids that share openings, and the bound of an opening's length
PIECE = 1 << 16  # characters of joined ids in a row
ROOT = hashlib.sha256(b"").digest()[:16]


def digest(*parts: Column) -> Column:
    """16 bytes of the SHA-256 of some texts, with their lengths."""
    sized = [x for p in parts for x in (F.octet_length(p).cast("string"), F.lit(":"), p)]
    return F.unhex(F.substring(F.sha2(F.concat(*sized).cast("binary"), 256), 1, 32))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), mark, n_bytes of every turn in its order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.substring(role, 1, 64).alias("role"),
        F.substring(text, 1, 64).alias("opening"),
        digest(role, text).alias("mark"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "opening", "mark")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("place"), "mark", "n_bytes")


def rebuild(ordered: DataFrame) -> DataFrame:
    """Turns with the openings exchanged, and one row at place -1 for each conversation."""
    opening = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % OPENING).cast("int")
    ids = ordered.select("conv_id").distinct()
    wanted = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), opening.alias("h"))
    first = ordered.where(F.col("place") < OPENING).withColumnRenamed("conv_id", "base")
    borrowed = wanted.join(first, "base").where("place < h").drop("base", "h")
    own = ordered.where(F.col("place") >= opening)
    roots = ids.select("conv_id", F.lit(-1).alias("place"), F.lit(None).cast("binary").alias("mark"), F.lit(0).cast("bigint").alias("n_bytes"))
    return roots.unionByName(borrowed).unionByName(own)


_ROWS = (
    "conv_id bigint, depth bigint, node binary, parent binary, n_bytes bigint, ends boolean, "
    "near array<array<binary>>, above array<array<binary>>"
)


def _chain(height: int):
    """Turns in order to nodes: digest of the prefix, and the ancestors to send totals to.

    ``near[l]`` are the ancestors in the node's band at level l, itself included: depths that
    are multiples of height**l. ``above[l]`` are those of the band before, for a node that
    is a band root at level l + 1.
    """
    kinds = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("depth", pa.int64()),
            ("node", pa.binary()),
            ("parent", pa.binary()),
            ("n_bytes", pa.int64()),
            ("ends", pa.bool_()),
            ("near", pa.list_(pa.list_(pa.binary()))),
            ("above", pa.list_(pa.list_(pa.binary()))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, depth, node, parent = None, 0, ROOT, None
        bands: list[list[bytes]] = []
        rows: list[list] = []

        def place() -> tuple[list, list]:
            near, above, step, level = [], [], 1, 0
            while depth % step == 0:
                if level == len(bands):
                    # a level starts with the root and goes on with the first node at its step
                    bands.append([ROOT] if depth else [])
                band = bands[level]
                if (depth // step) % height == 0:
                    above.append(list(band))
                    band.clear()
                band.append(node)
                near.append(list(band))
                if depth == 0:
                    break
                step, level = step * height, level + 1
            return near, above

        for batch in batches:
            for c, _, mark, n_bytes in zip(*[x.to_pylist() for x in batch.columns]):
                if c != conv:
                    conv, depth, node, parent, bands = c, 0, ROOT, None, []
                else:
                    depth, parent = depth + 1, node
                    node = hashlib.sha256(node + mark).digest()[:16]
                    rows[-1][5] = False
                near, above = place()
                rows.append([conv, depth, node, parent, n_bytes, True, near, above])
            if len(rows) > 1:  # the last row waits until it is known whether it ends
                yield _batch(rows[:-1], kinds)
                rows = rows[-1:]
        yield _batch(rows, kinds)

    return run


def _batch(rows: list, kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)


def roll_up(nodes: DataFrame, values: list[str], deepest: int, height: int = HEIGHT) -> DataFrame:
    """Subtree sums of ``values`` for nodes with node, depth, near and above.

    ``deepest`` is the largest depth; it sets the number of passes.
    """
    level, step, sums = 0, 1, []
    current = nodes.select("node", *values, "near")
    roots = nodes
    while True:  # up: sums inside the bands of each level
        # the root is its own and only ancestor at every level
        near = F.coalesce(F.get("near", F.lit(level)), F.array("node"))
        sent = current.select(F.explode(near).alias("node"), *values)
        inside = stage(sent.groupBy("node").agg(*[F.sum(v).alias(v) for v in values]), "bands")
        sums.append(inside)
        if step * height > deepest:
            break
        step, level = step * height, level + 1
        roots = roots.where(F.col("depth") % step == 0)
        current = roots.select("node", "near").join(inside, "node")
    total = sums[-1]
    while level:  # down: totals of band roots to the ancestors in the band above
        level -= 1
        complete = nodes.where((F.col("depth") % step == 0) & (F.col("depth") > 0))
        sent = complete.select("node", F.col("above")[level].alias("band")).join(total, "node")
        sent = sent.select(F.explode("band").alias("node"), *values)
        both = sent.unionByName(sums[level])
        total = stage(both.groupBy("node").agg(*[F.sum(v).alias(v) for v in values]), "bands")
        step //= height
    return total


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) to pieces of comma-joined ids."""
    kinds = pa.schema([("node", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
    node, first, ids, size, out = None, None, [], 0, []
    for batch in batches:
        for n, c in zip(*[x.to_pylist() for x in batch.columns]):
            if n != node or size > PIECE:
                if ids:
                    out.append((node, first, ",".join(ids)))
                node, first, ids, size = n, c, [], 0
            ids.append(str(c))
            size += len(ids[-1]) + 1
        if out:
            yield _batch(out, kinds)
            out = []
    if ids:
        yield _batch([(node, first, ",".join(ids))], kinds)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one hash per node, fed piece by piece."""
    kinds = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, running, out = None, None, []
    for batch in batches:
        for n, _, ids in zip(*[x.to_pylist() for x in batch.columns]):
            if n != node:
                if node is not None:
                    out.append((node, running.hexdigest()))
                node, running = n, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if out:
            yield _batch(out, kinds)
            out = []
    if node is not None:
        yield _batch([(node, running.hexdigest())], kinds)


def ending_hashes(ends: DataFrame, slices: int) -> DataFrame:
    """node and the hash of the sorted ids that end there, from (node, conv_id)."""
    ordered = ends.repartitionByRange(slices, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ordered.mapInArrow(_join_ids, "node binary, first bigint, ids string")
    pieces = pieces.repartition("node").sortWithinPartitions("node", "first")
    return pieces.mapInArrow(_hash_ids, "node binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node."""
    spark = conversations.sparkSession
    ordered = stage(turns(conversations), "turns")
    streams = rebuild(ordered).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    rows = stage(streams.mapInArrow(_chain(height), _ROWS), "prefixes")

    counted = rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("depth").alias("depth"), F.max("n_bytes").alias("n_bytes")
    )
    # The row of the smallest member has the ancestors; a unique key on both sides.
    places = rows.select("conv_id", "depth", "parent", "near", "above")
    nodes = stage(counted.join(places, ["conv_id", "depth"]), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    children = stage(children, "children")
    saved = ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")
    leaf = F.col("n_children").isNull().cast("bigint").alias("n_leaves")
    own = nodes.join(children, "node", "left").select("node", "depth", "near", "above", saved, leaf)
    own = stage(own, "own")
    deepest = own.agg(F.max("depth")).first()[0] or 0
    totals = roll_up(own, ["saved_tokens", "n_leaves"], deepest, height)

    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashes = stage(ending_hashes(rows.where("ends").select("node", "conv_id"), slices), "ends")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.select("node", "parent", "conv_id", "depth", "n_convs")
        .join(parents, "parent", "left")
        .join(children, "node", "left")
        .join(totals, "node")
        .join(hashes, "node", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
            F.col("n_leaves").cast("bigint").alias("n_leaves"),
            F.col("saved_tokens").cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )


# crc32 of a number's digits, bit by bit, as DuckDB has no such function.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::BIGINT[]),
            lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)),
        4294967295::BIGINT)"""

SQL = f"""
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT c, c - c % 5 AS base, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
    SELECT c, -1 AS place, NULL AS role, NULL AS text FROM convs
    UNION ALL
    SELECT v.c, t.place, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.place < v.h
    UNION ALL
    SELECT v.c, t.place, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.place >= v.h
), prefixes AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY place) - 1 AS depth, coalesce(octet_length(encode(text)), 0) AS n_bytes,
        sha256(string_agg(CASE WHEN place < 0 THEN '' ELSE
            length(role)::VARCHAR || ':' || role || length(text)::VARCHAR || ':' || text || ';' END, '')
            OVER (PARTITION BY c ORDER BY place ROWS UNBOUNDED PRECEDING)) AS node,
        lead(place) OVER (PARTITION BY c ORDER BY place) IS NULL AS ends
    FROM rebuilt
), nodes AS (
    SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes,
        sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
    FROM prefixes GROUP BY node, depth
), linked AS (
    SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN prefixes p ON p.c = n.conv_id AND p.depth = n.depth - 1
), children AS (
    SELECT parent AS node, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), totals AS (
    SELECT p.node, sum((n.n_convs - 1) * n.n_bytes) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
    FROM nodes n JOIN prefixes p ON p.c = n.conv_id AND p.depth <= n.depth LEFT JOIN children k ON k.node = n.node
    GROUP BY p.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
    t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM linked n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children k ON k.node = n.node JOIN totals t ON t.node = n.node
"""
