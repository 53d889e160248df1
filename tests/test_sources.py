from datetime import datetime

import pytest
from pyspark.sql import functions as F

from matchboard.schemas import RAW_SCORES
from matchboard.sources.staging import scratch_path, shared_folder, stage
from matchboard.sources.tables import (
    CORRUPT,
    clear_snapshot,
    export_csv,
    named_teams,
    read_raw,
    read_snapshot,
    read_table,
    write_snapshots,
    write_table,
)

FIRST, SECOND = datetime(2025, 8, 25, 8), datetime(2025, 9, 1, 8)


def weekly(spark, rows, kind="timestamp"):
    df = spark.createDataFrame(rows, "team string, updated_at timestamp")
    return df.withColumn("updated_at", F.col("updated_at").cast(kind))


def test_raw_csv_is_text(spark, tmp_path, rows):
    folder = tmp_path / "scores.csv"
    folder.write_text("game_id,home_goals,away_goals,ingestion_time\n1,3.0,,soon\n2,1\n")
    df = read_raw(spark, str(folder), RAW_SCORES)
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows(df) == [("1", "3.0", None, "soon"), ("2", "1", None, None)]
    kept = read_raw(spark, str(folder), RAW_SCORES, keep_corrupt=True)
    assert rows(kept, "game_id", CORRUPT) == [("1", None), ("2", "2,1")]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rewriting_a_snapshot_replaces_it(spark, tmp_path, rows, kind):
    path = str(tmp_path / "table")
    write_snapshots(weekly(spark, [("A", FIRST), ("B", SECOND)], kind), path)
    write_snapshots(weekly(spark, [("C", SECOND), ("D", SECOND)], kind), path)
    schema = weekly(spark, [], kind).schema
    table = read_table(spark, path, schema)
    assert rows(table) == [("A", FIRST), ("C", SECOND), ("D", SECOND)]
    assert table.schema["updated_at"].dataType.simpleString() == kind
    assert rows(read_snapshot(spark, path, SECOND, schema), "team") == [("C",), ("D",)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_snapshot_filter_prunes_folders(spark, tmp_path, kind):
    path = str(tmp_path / "table")
    write_snapshots(weekly(spark, [("A", FIRST), ("B", SECOND)], kind), path)
    schema = weekly(spark, [], kind).schema
    one = read_snapshot(spark, path, SECOND, schema)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(updated_at" in plan
    assert len(one.inputFiles()) <= len(read_table(spark, path, schema).inputFiles())
    assert one.count() == 1


def test_clearing_a_snapshot(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    df = weekly(spark, [("A", FIRST), ("B", SECOND)])
    write_snapshots(df, path)
    clear_snapshot(df, path, SECOND)
    assert rows(read_table(spark, path, df.schema)) == [("A", FIRST)]


def test_replace_all(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    write_snapshots(weekly(spark, [("A", FIRST)]), path)
    second = weekly(spark, [("B", SECOND)])
    write_snapshots(second, path, replace_all=True)
    assert rows(read_table(spark, path, second.schema)) == [("B", SECOND)]


def test_overwrite_and_export(spark, tmp_path):
    path, out = str(tmp_path / "table"), str(tmp_path / "out")
    write_table(spark.range(5).repartition(3), path)
    write_table(spark.range(100).repartition(4), path)
    table = read_table(spark, path)
    assert table.count() == 100
    export_csv(table, out, ["id"])
    text = spark.read.option("header", True).csv(out)
    assert text.columns == ["id"] and text.count() == 100
    parts = [sorted(int(r["id"]) for r in part) for part in text.rdd.glom().collect() if part]
    assert sorted(sum(parts, [])) == list(range(100))


def test_named_teams(spark, rows):
    assert rows(named_teams(spark, ["B", "A"])) == [("A",), ("B",)]


def test_stage_writes_once_below_the_shared_folder(spark, rows):
    staged = stage(spark.range(3), "numbers")
    assert rows(staged) == [(0,), (1,), (2,)]
    assert shared_folder(spark) in staged.inputFiles()[0]
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
