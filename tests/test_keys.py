import pytest
from pyspark.sql import functions as F

from matchboard.operators.keys import (
    anti_join,
    attach,
    distinct_count,
    duplicate_keys,
    duplicate_rows,
    missing_keys,
    presence,
    reconcile,
    semi_join,
)


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "id string, v int")
    right = spark.createDataFrame([("a", 1), ("a", 1), ("c", 2), (None, 3)], "id string, w int")
    return left, right


def test_semi_and_anti_join(sides, rows):
    left, right = sides
    assert rows(semi_join(left, right, "id")) == [("a", 1), ("a", 2)]
    assert rows(anti_join(left, right, "id")) == [("b", 3), (None, 4)]


def test_reconcile_keeps_common_ids(sides, rows):
    left, right = reconcile(*sides, "id")
    assert rows(left) == [("a", 1), ("a", 2)]
    assert rows(right) == [("a", 1), ("a", 1)]


def test_attach(sides, rows):
    left, right = sides
    assert rows(attach(left, right, "id", ["w"])) == [("a", 1, 1), ("a", 2, 1)]


def test_duplicates(sides, rows):
    left, _ = sides
    assert rows(duplicate_keys(left, "id")) == [("a", 2)]
    assert rows(duplicate_rows(left, "id")) == [("a", 1), ("a", 2)]


def test_distinct_count_takes_null_as_a_value(sides, rows):
    left, _ = sides
    assert rows(distinct_count(left, "id", "v")) == [("id", 4, 3, 1), ("v", 4, 4, 0)]


def test_presence_equals_pairwise_sets(spark):
    ids = {"a": [1, 2, 2, None], "b": [2, 3], "c": [None, 3, 4]}
    tables = {n: spark.createDataFrame([(i,) for i in v], "id int") for n, v in ids.items()}
    for row in presence(tables, "id").collect():
        for name, values in ids.items():
            assert row[f"in_{name}"] == (row["id"] in values)


def test_missing_keys(sides, rows):
    assert rows(missing_keys(*sides, "id")) == [("b", True, False), ("c", False, True)]


def _settings(spark, values):
    before = {k: spark.conf.get(k) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    return before


@pytest.mark.parametrize("join", [semi_join, anti_join, lambda l, r, k: attach(l, r, k, ["w"])])
def test_hot_key_is_split(spark, join):
    """A third of the rows, and of the key side, has one key: the join splits it."""
    before = _settings(
        spark,
        {
            "spark.sql.shuffle.partitions": "32",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        },
    )
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k")
        left = spark.range(0, 100_000, 1, 16).select(hot, F.sha2(F.col("id").cast("string"), 256))
        right = spark.range(0, 150_000, 1, 16).select(hot, F.lit(1).alias("w"))
        out = join(left.toDF("k", "text"), right, "k").agg(F.count("text"))
        count = out.collect()[0][0]
        assert count == (0 if join is anti_join else 100_000)
        if join is not anti_join:
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        _settings(spark, before)


def test_small_key_side_is_broadcast(sides):
    left, right = sides
    out = semi_join(left, right, "id")
    out.collect()
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


PAIRS = [
    ("int", "bigint"), ("date", "timestamp"), ("timestamp_ntz", "date"), ("decimal(5,1)", "decimal(12,3)"),
    ("float", "double"), ("string collate utf8_lcase", "string collate utf8_lcase"),
]


@pytest.mark.parametrize("left,right", [*PAIRS, *[(b, a) for a, b in PAIRS]])
def test_keys_of_different_types_match(spark, left, right, rows):
    texts = {"date": "2025-01-0{}", "timestamp": "2025-01-0{}", "timestamp_ntz": "2025-01-0{}"}
    frames = [
        spark.createDataFrame([(texts.get(kind, "{}").format(k), k) for k in keys], "k string, n int").withColumn(
            "k", F.expr("k collate utf8_lcase") if "collate" in kind else F.col("k").cast(kind)
        )
        for kind, keys in ((left, (1, 2, 3)), (right, (2, 3, 3, 4)))
    ]
    assert rows(semi_join(*frames, "k"), "n") == [(2,), (3,)]
    assert rows(anti_join(*frames, "k"), "n") == [(1,)]
    assert rows(attach(frames[0], frames[1].withColumnRenamed("n", "m"), "k", ["m"]), "n", "m") == [(2, 2), (3, 3)]


def test_distinct_count_of_zeros(spark, rows):
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert rows(distinct_count(zeros, "x")) == [("x", 2, 1, 1)]
