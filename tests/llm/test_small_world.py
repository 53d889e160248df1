"""Vector links by graphs against all pairs."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchboard.llm.small_world import Graph, Shard, SmallWorld, near_vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def _vectors():
    rng = np.random.default_rng(8)
    rows, number = [], 0

    def add(vector, label):
        nonlocal number
        rows.append((number, None if vector is None else [None if x is None else float(np.float32(x)) for x in vector], label))
        number += 1

    for label, count in ((0, 400), (1, 60), (2, 1)):
        for _ in range(count):
            add(rng.standard_normal(16), label)
    for spread in (0.02, 0.1, 0.2):  # chains and clusters around some points
        for _ in range(6):
            center = rng.standard_normal(16)
            for _ in range(12):
                add(center + spread * rng.standard_normal(16), 0)
    center = rng.standard_normal(16)
    for _ in range(150):  # one large group of near copies, more than a beam holds
        add(center + 0.01 * rng.standard_normal(16), 0)
    for _ in range(120):  # and of exact ones
        add(center, 0)
    twice = rng.standard_normal(16)
    add(twice, 1)
    add(2 * twice, 1)
    add(twice, None)
    add(twice, 0)
    for odd in (None, [], [0.0] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, [1e38] * 16, [1e38] * 16, [1.0, 2.0]):
        add(odd, 1)
    rows.append((3, rows[3][1], 0))  # a repeated row
    rows.append((None, rows[10][1], 0))
    rows.append((None, None, None))
    return rows


def _brute(rows, cosine=0.93):
    usable = []
    for k, (_, v, label) in enumerate(rows):
        fine = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        usable.append(np.array(v) / np.linalg.norm(np.array(v)) if fine else None)
    least, links = list(range(len(rows))), [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if usable[a] is None or usable[b] is None or rows[a][2] != rows[b][2] or len(usable[a]) != len(usable[b]):
                continue
            if usable[a] @ usable[b] >= cosine:
                links[a] += 1
                links[b] += 1
                low, high = sorted((least[a], least[b]))
                least = [low if x == high else x for x in least] if low != high else least
    names = {}
    for k, root in enumerate(least):
        if rows[k][0] is not None:
            names[root] = min(names.get(root, rows[k][0]), rows[k][0])
    out = []
    for k, root in enumerate(least):
        name = names.get(root)
        out.append((rows[k][0], links[k], name, rows[k][0] is not None and rows[k][0] == name))
    return Counter(out)


@pytest.mark.parametrize("shard", [16_384, 90])
def test_links_equal_all_pairs(spark, shard):
    rows = _vectors()
    clash = [F.lit(1).alias(c) for c in ("node", "weight", "probe", "home", "shard", "n_links", "dim")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4).select("*", *clash)
    got = Counter(map(tuple, near_vectors(frame, SmallWorld(shard=shard, width=24)).collect()))
    assert got == _brute(rows)


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_graph_finds_neighbours_without_looking_at_all():
    """Recall of links and of planted queries, with far fewer comparisons than all pairs."""
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((3000, 32))
    vectors[1500:1600] = vectors[1500] + 0.05 * rng.standard_normal((100, 32))
    shard = Shard([str(k).encode() for k in range(3000)], vectors, np.ones(3000, dtype=int), SmallWorld())
    assert shard.measured >= 0.99 and shard.width < 3000
    shard.own_links()
    truth = shard.exact @ shard.exact.T >= 0.93
    assert shard.links.sum() >= 0.99 * (truth.sum() - 3000)
    assert (shard.links <= truth.sum(axis=1) - 1).all()
    assert len(set(shard.root[1500:1600])) == 1
    ids, _ = shard.graph.search(shard.graph.unit[:50], 32)
    assert (ids[:, 0] == np.arange(50)).all()
    assert all(layer.shape[1] <= 32 for layer in shard.graph.layers)


def test_beam_widens_until_the_audit_passes():
    vectors = np.random.default_rng(2).standard_normal((2000, 64))
    narrow = SmallWorld(width=1, links=2)
    shard = Shard([str(k).encode() for k in range(2000)], vectors, np.ones(2000, dtype=int), narrow)
    assert shard.width > 1 and shard.measured >= narrow.recall


def test_equal_input_gives_an_equal_graph():
    unit = np.random.default_rng(3).standard_normal((500, 8)).astype(np.float32)
    one, two = Graph(unit, SmallWorld()), Graph(unit, SmallWorld())
    assert all((a == b).all() for a, b in zip(one.layers, two.layers))
