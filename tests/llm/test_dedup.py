"""Operators 2, 5 and 8 against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchboard.llm import near_dedup, shared_windows, substring_dedup, suffix_dedup
from matchboard.llm.components import components
from matchboard.llm.skew import join_split

NONE = float("inf")


def _marks(n, starts, width):
    mask = [False] * n
    for k in starts:
        mask[k : k + width] = [True] * width
    return mask


def _repeats(rows, width):
    counts = Counter()
    for _, t in rows:
        raw = (t or "").encode()
        counts.update(raw[k : k + width] for k in range(len(raw) - width + 1))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = _marks(len(raw), [k for k in range(len(raw) - width + 1) if counts[raw[k : k + width]] > 1], width)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _earlier(rows, width):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            first[key] = min(first.get(key, NONE), NONE if i is None else i)
    out = []
    for i, w in split:
        own = NONE if i is None else i
        gone = _marks(len(w), [k for k in range(len(w) - width + 1) if first[tuple(w[k : k + width])] < own], width)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width,gram", [(200, 48), (64, 20), (30, 29)])
def test_repeats(docs, corpus, rows, width, gram):
    assert rows(suffix_dedup.repeat_digests(docs, width, gram)) == _repeats(corpus, width)


def test_repeats_of_odd_rows(odd_docs, odd_rows, rows):
    assert rows(suffix_dedup.repeat_digests(odd_docs)) == _repeats(odd_rows, 200)


def test_repeats_with_every_group_hot(docs, corpus, rows, monkeypatch):
    monkeypatch.setattr(shared_windows, "HOT", 0)
    assert rows(suffix_dedup.repeat_digests(docs)) == _repeats(corpus, 200)


def test_removed_text(docs, corpus):
    kept = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    digests = {r.doc_id: r for r in suffix_dedup.repeat_digests(docs).collect()}
    for i, text in corpus:
        assert kept[i].source == "s"
        if text is None:
            assert kept[i].text is None
        elif digests[i].n_removed == 0:
            assert (kept[i].text, kept[i].n_chars) == (text, len(text))
        else:
            assert len(kept[i].text.encode()) <= digests[i].n_bytes - digests[i].n_removed


@pytest.mark.parametrize("width,gram", [(50, 12), (8, 3), (5, 5)])
def test_earlier(docs, corpus, rows, width, gram):
    assert rows(substring_dedup.earlier_digests(docs, width, gram)) == _earlier(corpus, width)


def test_earlier_of_odd_rows(odd_docs, odd_rows, rows):
    assert rows(substring_dedup.earlier_digests(odd_docs)) == _earlier(odd_rows, 50)


def test_earlier_with_every_group_hot(docs, corpus, rows, monkeypatch):
    monkeypatch.setattr(shared_windows, "HOT", 0)
    assert rows(substring_dedup.earlier_digests(docs)) == _earlier(corpus, 50)


def _thue_morse(n, zero, one):
    return [(zero, one)[k.bit_count() & 1] for k in range(n)]


def test_sequences_made_to_collide(spark, rows):
    """Thue-Morse sequences and their complements have one hash modulo 2**64; they differ all the same."""
    one, other = ("".join(_thue_morse(4096, *pair)) for pair in ("ab", "ba"))
    around = [f"w{k}" for k in range(30)]
    data = [(k, " ".join([*around, middle, *around])) for k, middle in enumerate((one, other))]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    assert rows(substring_dedup.earlier_digests(docs)) == _earlier(data, 50)
    assert rows(near_dedup.near_duplicates(docs)) == _near(data)
    words = [(k, " ".join(_thue_morse(2048, *pair))) for k, pair in enumerate((("a", "b"), ("b", "a")))]
    assert rows(substring_dedup.earlier_digests(spark.createDataFrame(words, docs.schema), 1024, 12)) == _earlier(words, 1024)


def test_hot_minimizers_are_split(spark):
    """A minimizer with a third of the pieces is dealt to several tasks by the joins with its counts."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("value")
        entries = spark.range(0, 100_000, 1, 16).select(hot, F.sha2(F.col("id").cast("string"), 256).alias("text"))
        counts = entries.groupBy("value").agg(F.count("*").alias("sets"))
        out = join_split(entries, counts, ["value"]).agg(F.sum("sets").alias("total"), F.max("text"))
        assert out.collect()[0].total == 33_335**2 + 66_665
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_kept_words(docs):
    texts = {r.doc_id: r.text for r in substring_dedup.remove_earlier(docs).collect()}
    for r in substring_dedup.earlier_digests(docs).collect():
        assert hashlib.sha256(texts[r.doc_id].encode()).hexdigest() == r.kept_sha256


def _near(rows):
    sets = []
    for i, t in rows:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets.append((i, {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for b, (j, u) in enumerate(sets[:a]):
            near = 100 * len(s & u) >= 85 * len(s | u) or i == j
            if s and u and i is not None and j is not None and near:
                root[find(a)] = find(b)
    out = []
    for a, (i, s) in enumerate(sets):
        ids = [j for b, (j, _) in enumerate(sets) if find(b) == find(a)]
        least = None if i is None else min(ids)
        out.append((i, len(s), least, least == i))
    return sorted(out, key=repr)


def test_near(docs, corpus, rows):
    expected = _near(corpus)
    assert sum(not kept for *_, kept in expected) > 10
    assert rows(near_dedup.near_duplicates(docs)) == expected


def _few_retained(width, edits, retained, salt):
    """Two texts of 1000 words, one with ``edits`` other words, ``retained`` of them in the least hashes."""
    words = [f"{salt}w{k}" for k in range(1000)]
    grams = [" ".join(words[k : k + width]).encode() for k in range(1000 - width + 1)]
    order = sorted(range(len(grams)), key=lambda k: near_dedup.shingle_sets(*_bytes(grams[k]), width)[0][0])
    chosen = []
    for k in [*order[:48], *order[100:]]:
        if all(abs(k - c) >= width for c in chosen) and width <= k < 1000 - width:
            if len(chosen) < retained or order.index(k) >= 100:
                chosen.append(k)
    other = list(words)
    for k in chosen[:edits]:
        other[k] = f"x{k}"
    return " ".join(words), " ".join(other)


def _bytes(raw):
    return np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)])


def test_near_with_few_shared_retained_values(spark, rows):
    def shared(pair):
        left, right = (set(near_dedup.shingle_sets(*_bytes(t.encode()), 3)[0][:48].tolist()) for _, t in pair)
        return len(left & right)

    pairs = (list(enumerate(_few_retained(3, 26, 13, salt))) for salt in range(100))
    pair = next(p for p in pairs if 28 <= shared(p) <= 30)
    expected = _near(pair)
    assert [kept for *_, kept in expected] == [True, False]
    assert rows(near_dedup.near_duplicates(spark.createDataFrame(pair, "doc_id bigint, text string"))) == expected


def test_near_in_small_blocks(docs, corpus, rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    assert rows(near_dedup.near_duplicates(docs)) == _near(corpus)


def test_near_of_odd_rows(odd_docs, odd_rows, rows):
    assert rows(near_dedup.near_duplicates(odd_docs)) == _near(odd_rows)


def test_dropped_near_duplicates(odd_docs, odd_rows):
    found = near_dedup.drop_near_duplicates(odd_docs)
    assert found.columns == odd_docs.columns
    # rows equal in doc_id and text are one document, other texts of a doc_id are documents of their own
    other = (31, "another text with the same id")
    known = [(10**6 + 31, t) if (i, t) == other else (i, t) for i, t in {r for r in odd_rows if r[0] is not None}]
    wanted = sorted(i % 10**6 for i, _, _, keep in _near(known) if keep)
    ids = [r.doc_id for r in found.collect()]
    assert sorted(i for i in ids if i is not None) == wanted and wanted.count(31) == 2 and ids.count(None) == 2


def test_texts_of_one_id_that_differ(spark, rows):
    """Unlike texts of one doc_id stay, near copies and equal rows of them go, whatever their number."""
    base = [f"w{k}" for k in range(300)]
    one, near, other, third = " ".join(base), " ".join([*base, "z"]), " ".join(base[::-1]), "a b c d e f"
    data = [(7, one), (7, other), (7, one), (7, near), (8, third), (8, other), (9, one), (None, one)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id bigint, text string, source string")
    found = near_dedup.drop_near_duplicates(docs, near_dedup.Similarity(), near_dedup.FIVE_WORDS).collect()
    texts = sorted((r.text for r in found if r.doc_id is not None), key=len)
    assert [len(t.split()) for t in texts][0] == 6 and len(texts) == 3
    assert {frozenset(t.split()) - {"z"} for t in texts} == {frozenset(third.split()), frozenset(base)}
    assert sorted(str(r.doc_id) for r in found if r.text == third) == ["8"] and sum(r.doc_id is None for r in found) == 1


def test_empty(empty_docs):
    for query in (suffix_dedup.repeat_digests, suffix_dedup.remove_repeats, substring_dedup.earlier_digests):
        assert query(empty_docs).count() == 0
    assert near_dedup.near_duplicates(empty_docs).count() == 0
    assert near_dedup.drop_near_duplicates(empty_docs).count() == 0


def test_clashing_columns(docs):
    more = docs.selectExpr("*", "1 spans", "2 n", "3 block", "4 minimizer", "5 component")
    assert set(suffix_dedup.remove_repeats(more).columns) == set(more.columns)
    assert near_dedup.drop_near_duplicates(more).count() == near_dedup.drop_near_duplicates(docs).count()


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (103, 101), (7, 7), (200, None)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    expected = {k: 0 for k in range(41)} | {100: 100, 101: 100, 103: 100}
    assert {r.node: r.component for r in found.collect()} == expected
