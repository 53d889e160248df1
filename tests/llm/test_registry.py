"""Registered queries and the pipeline on the smallest tables."""

import random

import pytest
from oracle_compare import connect, difference

import corpus_pipeline
from matchboard.llm.decontamination import contamination
from matchboard.llm.near_dedup import near_duplicates
from matchboard.llm.quality_rules import quality_rules
from matchboard.llm.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_returns_a_row_for_each_input(spark, name):
    table = {"op3": "pages", "op13": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    rows = rows.select("conv_id").distinct() if table == "conversations" else rows
    assert QUERIES[name](spark, FOLDER).count() == rows.count()


def test_stages(spark):
    """Each stage keeps what its operator decides on the stage's own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    columns = docs.columns
    (_, quality), (_, near), (_, repeats), (_, benchmark), (_, tokens) = corpus_pipeline.STAGES
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())

    good = quality(spark, docs, FOLDER).cache()
    assert good.columns == columns and ids(good) == ids(quality_rules(docs).where("kept"))
    one = near(spark, good, FOLDER).cache()
    assert one.columns == columns and ids(one) == ids(near_duplicates(good).where("kept"))
    cut = repeats(spark, one, FOLDER).cache()
    assert cut.columns == columns and ids(cut) == ids(one)
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    clean = benchmark(spark, cut, FOLDER).cache()
    assert clean.columns == columns and ids(clean) == ids(contamination(cut, items).where("not contaminated"))
    coded = tokens(spark, clean, FOLDER)
    assert ids(coded) == ids(clean) and 0 < len(ids(clean)) < docs.count()
    assert ids(corpus_pipeline.run(spark, FOLDER)) == ids(clean)


def _components(texts, rules):
    """Ids that stay when any rule (words, percent) links two texts, by brute force."""
    least = list(range(len(texts)))
    for width, percent in rules:
        words = [t.lower().split() for t in texts]
        sets = [{tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} for w in words]
        for a, s in enumerate(sets):
            for b, u in enumerate(sets[:a]):
                if 100 * len(s & u) >= percent * len(s | u) and least[a] != least[b]:
                    low, high = sorted((least[a], least[b]))
                    least = [low if x == high else x for x in least]
    return [k for k, x in enumerate(least) if k == x]


def test_near_stage_links_five_words(spark):
    """The stage keeps what brute force keeps, with the links of 5 words at 0.80 beside those of operator 5."""
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    base, many, short = text(1000), text(600), text(30)
    scattered = [f"x{k}" if k % 42 == 20 else w for k, w in enumerate(many)]
    texts = [base, base + text(220), base[:830], text(500), many, scattered, short, short[:24] + text(1), text(3)]
    texts = [" ".join(t) for t in texts]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in corpus_pipeline.near(spark, docs, "").collect())
    assert kept == _components(texts, [(3, 85), (5, 80)])
    assert kept != _components(texts, [(3, 85)]) and kept != _components(texts, [(5, 80)])
