from datetime import datetime

import pytest
from pyspark.sql import functions as F

from matchboard.quality import (
    Between,
    Differ,
    HasSchema,
    NotNull,
    OncePer,
    OneOf,
    SameCount,
    SameIds,
    TimeBetween,
    Unique,
    ValidationError,
    enforce,
    failures,
    sample_values,
    validate,
    violations,
)
from matchboard.schemas import layout


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(
        [
            ("1", "1", "A", "B", "0", "2025-01-01"),
            ("2", "1", "A", "A", "-1", "2025-01-03"),
            ("2", "2", None, None, "x", "2025-01-05"),
            (None, "2", "C", "B", None, "soon"),
            (None, "2", "C", None, "3.5", None),
        ],
        "id string, round string, home string, away string, goals string, at string",
    )


def counts(df, *checks, by=()):
    metrics = validate(df, checks, by).orderBy("check_no").collect()
    return [(row["check"], row["violations"], row["passed"]) for row in metrics]


def test_row_checks(games):
    assert counts(games, NotNull("id"), NotNull("round")) == [
        ("not_null", 2, False), ("not_null", 0, True),
    ]
    # Null and text that is no number are out of any range.
    assert counts(
        games,
        Between("goals"),
        Between("goals", 0),
        Between("goals", high=3),
        Between("goals", 0, 3),
        Between("goals", 0, F.col("round").cast("int")),
    ) == [("between", n, False) for n in (2, 3, 3, 4, 4)]
    # Two nulls are equal, one null is different.
    assert counts(games, Differ("home", "away")) == [("differ", 2, False)]
    # Null passes.
    assert counts(games, OneOf("home", ["A"])) == [("one_of", 2, False)]


def test_time_check_counts_unreadable_apart(games):
    check = TimeBetween("at", datetime(2025, 1, 1), datetime(2025, 1, 3))
    assert counts(games, check) == [("time_parses", 2, False), ("time_between", 1, False)]
    assert violations(games, check).count() == 3


def test_typed_times_and_naive_times(spark):
    check = TimeBetween("at", datetime(2025, 1, 1), datetime(2025, 1, 3))
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([("2025-01-03",), ("2025-01-04",)], "t string")
        typed = df.select(F.col("t").cast(kind).alias("at"))
        assert counts(typed, check)[1] == ("time_between", 1, False)


def test_group_checks(games):
    # 5 rows, values 1, 2 and null.
    assert counts(games, Unique("id"), OncePer(("round",), "home"), Unique("at")) == [
        ("unique", 2, False), ("once_per", 2, False), ("unique", 0, True),
    ]


def test_allowed_values_from_a_frame(spark, games):
    allowed = spark.createDataFrame([("A",)], "name string")
    check = OneOf("home", allowed)
    assert counts(games, check) == [("one_of", 2, False)]
    assert violations(games, check).count() == 2
    everything = games.select("home").distinct()
    assert counts(games, OneOf("home", everything)) == [("one_of", 0, True)]


def test_missing_columns_fail_without_an_error(games):
    assert counts(games, Differ("home", "nope"), OneOf("nope", [1])) == [
        ("differ", None, False), ("one_of", None, False),
    ]


def test_schema_check(games):
    ok = HasSchema(layout("id string, round string"))
    wrong = HasSchema(layout("id int, round string"))
    missing = HasSchema(layout("id string, extra string"))
    assert [c[2] for c in counts(games, ok, wrong, missing)] == [True, False, False]
    target = validate(games, [missing]).first()["target"]
    assert target == "extra is missing"


def test_id_sets_and_counts(spark):
    a, b, c = (
        spark.createDataFrame([(i,) for i in ids], "game_id int")
        for ids in ([1, 2, 2], [2, 3], [1, 2])
    )
    check = SameIds({"a": a, "b": b, "c": c})
    metrics = validate(a, [check]).collect()
    assert {r["target"]: r["violations"] for r in metrics} == {
        "a vs b": 2, "a vs c": 0, "b vs c": 2,
    }
    assert {r["game_id"] for r in violations(a, check).collect()} == {1, 3}
    assert counts(a, SameCount(c)) == [("same_count", 1, False)]


def test_empty_frames_pass(games):
    empty = games.limit(0)
    checks = [NotNull("id"), Unique("id"), OncePer(("round",), "home"), SameCount(empty)]
    assert [c[1:] for c in counts(empty, *checks)] == [(0, True)] * 4


def test_by_group(games):
    metrics = validate(games, [NotNull("id"), Unique("home"), SameCount(games)], by=["round"])
    got = {(r["round"], r["check"]): r["violations"] for r in metrics.collect()}
    assert got == {
        ("1", "not_null"): 0, ("1", "unique"): 1, ("1", "same_count"): 0,
        ("2", "not_null"): 2, ("2", "unique"): 1, ("2", "same_count"): 0,
    }


def test_frame_check_by_group(spark, games):
    allowed = spark.createDataFrame([("A",)], "name string")
    metrics = validate(games, [OneOf("home", allowed)], by=["round"]).collect()
    assert {r["round"]: r["violations"] for r in metrics} == {"1": 0, "2": 2}


def test_enforce(games):
    metrics = validate(games, [NotNull("round"), NotNull("id"), Unique("id")])
    assert [r["check"] for r in failures(metrics).orderBy("check_no").collect()] == ["not_null", "unique"]
    assert len(enforce(metrics, "soft")) == 2
    with pytest.raises(ValidationError) as error:
        enforce(metrics)
    assert "not_null id" in str(error.value) and "unique id" in str(error.value)
    with pytest.raises(ValueError):
        enforce(metrics, "loud")


def test_violating_groups_and_samples(games, rows):
    assert rows(violations(games, OncePer(("round",), "home"))) == [
        ("1", "A", 2), ("2", "C", 2),
    ]
    assert sample_values(games, OneOf("home", ["A"]), 1).collect() == [("C",)]


def test_checks_of_a_kind_share_a_pass(games, spark):
    """One scan for all row checks, and one for all group checks."""
    checks = [NotNull(c) for c in games.columns] + [Unique(c) for c in games.columns]
    path = spark.conf.get("spark.checkpoint.dir") + "/passes"
    games.write.mode("overwrite").parquet(path)
    plan = validate(spark.read.parquet(path), checks)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Relation [") == 2


def test_all_failures_are_reported(spark):
    groups = spark.range(12_000).select("id", F.lit(None).cast("string").alias("v"))
    metrics = validate(groups, [NotNull("v")], by=["id"])
    assert failures(metrics).count() == 12_000
    (row,) = enforce(metrics, "soft")
    assert (row["violations"], row["groups"]) == (12_000, 12_000)


def test_null_in_an_allowed_list(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    assert counts(df, OneOf("k", [1, None])) == [("one_of", 2, False)]


def test_allowed_frame_of_another_type(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert counts(df, OneOf("k", spark.createDataFrame([(1,), (2,)], "v bigint"))) == [("one_of", 1, False)]


def test_unique_compares_values_of_their_own_type(spark):
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert counts(zeros, Unique("x")) == [("unique", 1, False)]
