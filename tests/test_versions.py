"""Layers published together, raw files landed once, and what a weekly run reads."""

import os
import pathlib
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_jobs import TEAMS, season_matches, write_source

from matchboard.functions.casts import to_time
from matchboard.functions.periods import DEFAULT_SEASON as SEASON
from matchboard.functions.periods import week_index
from matchboard.operators.facts import guarded_facts
from matchboard.operators.form import form_of_states, form_states, recent_form
from matchboard.operators.keys import semi_join
from matchboard.operators.standings import standings, standings_history
from matchboard.plans import jobs
from matchboard.quality import Between, NotNull, OncePer, OneOf, Unique, ValidationError, validate, violating_rows
from matchboard.schemas import RAW_SCORES
from matchboard.sources.landing import LEDGER, WEEK, land
from matchboard.sources.tables import named_teams
from matchboard.sources.versions import ConflictError, Transaction, latest, snapshot_key, transaction, vacuum


def frame(spark, *rows):
    return spark.createDataFrame(rows, "id int, updated_at timestamp")


WEEKS = [SEASON.start + timedelta(weeks=k) for k in range(4)]


def files(folder):
    return {p for p in pathlib.Path(folder).rglob("*.parquet")}


def test_parts_are_replaced_cleared_and_left_out(spark, tmp_path):
    base = str(tmp_path)
    with transaction(spark, base) as tx:
        schema = tx.write_parts(frame(spark, (1, WEEKS[0]), (2, WEEKS[1]), (3, WEEKS[2])), "t").schema
        assert tx.read("t", schema).count() == 3 and latest(spark, base) == (0, {})
    reader = Transaction(spark, base)
    with transaction(spark, base) as tx:
        tx.write_parts(frame(spark, (9, WEEKS[1])), "t", clear=[snapshot_key(WEEKS[0])])
        tx.leave_out("t", [snapshot_key(WEEKS[2])])
    now = Transaction(spark, base)
    assert [r["id"] for r in now.read("t", schema).collect()] == [9] and now.version == 2
    assert now.read("t", schema, [snapshot_key(WEEKS[0])]).isEmpty()
    # who began before reads what was there
    assert sorted(r["id"] for r in reader.read("t", schema).collect()) == [1, 2, 3]
    assert vacuum(spark, base) == 1 and now.read("t", schema).count() == 1


def test_failure_between_layers_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path)
    with transaction(spark, base) as tx:
        schema = tx.write(frame(spark, (1, WEEKS[0])), "a").schema
        tx.write(frame(spark, (1, WEEKS[0])), "b")
    before, listed = latest(spark, base), files(base)
    with pytest.raises(RuntimeError), transaction(spark, base) as tx:
        tx.write(frame(spark, (2, WEEKS[0])), "a")
        tx.write(frame(spark, (2, WEEKS[0])), "new/layer")
        raise RuntimeError("between two layers")
    assert latest(spark, base) == before and files(base) == listed and not (tmp_path / "new").exists()
    assert [r["id"] for r in Transaction(spark, base).read("a", schema).collect()] == [1]


def test_one_of_two_runs_loses(spark, tmp_path):
    one, two = Transaction(spark, str(tmp_path)), Transaction(spark, str(tmp_path))
    one.write(frame(spark, (1, WEEKS[0])), "a")
    two.write(frame(spark, (2, WEEKS[0])), "a")
    one.commit()
    with pytest.raises(ConflictError):
        two.commit()
    assert latest(spark, str(tmp_path))[0] == 1


def test_files_land_once_and_weeks_are_pruned(spark, tmp_path):
    source = tmp_path / "scores"
    source.mkdir()
    header = "game_id,home_goals,away_goals,ingestion_time\n"
    (source / "a.csv").write_text(header + "g1,1,0,2025-08-20 11:00:00\ng2,2,2,2025-08-27 11:00:00\n")
    week = week_index(to_time("ingestion_time"), SEASON)

    def run():
        with transaction(spark, str(tmp_path / "base")) as tx:
            rows = land(spark, tx, "raw/scores", str(source), RAW_SCORES, week)
            return rows, tx.tables, sorted(tuple(r) for r in rows.select("game_id", "home_goals", WEEK).collect())

    rows, first, got = run()
    assert got == [("g1", "1", 0), ("g2", "2", 1)]
    plan = rows.filter(F.col(WEEK) == 1)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({WEEK}" in plan
    assert run()[1] == first  # nothing new, nothing written
    # an added file with its columns in another order is read by its own header, and alone
    (source / "b.csv").write_text("away_goals,game_id,note,ingestion_time,home_goals\n5,g3,x,no time,7\n")
    _, second, got = run()
    assert got == [("g1", "1", 0), ("g2", "2", 1), ("g3", "7", None)]
    assert set(first["raw/scores"]) < set(second["raw/scores"]) and len(second["raw/scores"]) == 2
    # a changed file replaces its rows, and one that is gone takes them with it
    (source / "a.csv").write_text(header + "g1,4,0,2025-08-20 11:00:00\n")
    os.utime(source / "a.csv", (2_000_000_000, 2_000_000_000))
    assert run()[2] == [("g1", "4", 0), ("g3", "7", None)]
    (source / "b.csv").unlink()
    _, last, got = run()
    assert got == [("g1", "4", 0)] and len(last["raw/scores"]) == 1 and LEDGER in last


def test_a_week_reads_one_snapshot_and_the_facts_after_it(spark, tmp_path, monkeypatch):
    source = write_source(tmp_path / "source", season_matches())
    cfg = jobs.Config(source, str(tmp_path / "tables"), str(tmp_path / "out"), named_teams(spark, TEAMS))
    for week in (0, 1):
        jobs.run_week(spark, cfg, week)
    seen, plain = [], Transaction.read

    def read(self, name, schema, keys=None):
        seen.append((name, None if keys is None else list(keys)))
        return plain(self, name, schema, keys)

    monkeypatch.setattr(Transaction, "read", read)
    jobs.run_week(spark, cfg, 3)
    keys = [snapshot_key(SEASON.start + timedelta(weeks=k + 1)) for k in range(4)]
    by_name = {name: keys for name, keys in seen if not name.startswith("raw/")}
    assert by_name[f"{jobs.GOLD_STANDINGS}_hist"] == by_name[f"{jobs.FORM_STATES}_hist"] == [keys[1]]
    assert by_name[f"{jobs.SILVER_FACTS}_hist"] == [keys[3]]
    stored = jobs.read_history(spark, cfg)
    fresh = standings_history(
        jobs.read_layer(spark, cfg, jobs.SILVER_FACTS, True), cfg.teams, SEASON.start + timedelta(weeks=1), SEASON.start + timedelta(weeks=4)
    ).filter(F.col("updated_at") != SEASON.start + timedelta(weeks=3))
    assert stored.exceptAll(fresh.select(*stored.columns)).isEmpty() and stored.count() == fresh.count() == 12
    form = form_of_states(jobs.read_layer(spark, cfg, jobs.FORM_STATES, True), 2, None)
    full = recent_form(stored, 2, None)
    assert form.exceptAll(full).isEmpty() and form.count() == full.count() > 0


def test_a_stopped_week_leaves_all_layers(spark, tmp_path):
    source = write_source(tmp_path / "source", season_matches())
    cfg = jobs.Config(source, str(tmp_path / "tables"), str(tmp_path / "out"), named_teams(spark, TEAMS))
    jobs.run_week(spark, cfg, 0)
    before = latest(spark, cfg.base)
    with pytest.raises(ValidationError):  # bronze and silver pass, gold does not
        jobs.run_week(spark, replace(cfg, teams=named_teams(spark, TEAMS[:3])), 1)
    assert latest(spark, cfg.base) == before


def test_teams_that_never_played_are_not_carried_on(spark):
    facts = spark.createDataFrame(
        [("A", "B", "home_win", 1, 0, WEEKS[1])],
        "home_team string, away_team string, match_outcome string, home_goals int, away_goals int, updated_at timestamp",
    )
    opening = standings(facts, named_teams(spark, ["A", "B", "gone"]))
    later = standings_history(facts.limit(0), named_teams(spark, ["A", "new"]), WEEKS[2], WEEKS[2], opening=opening)
    assert [(r["team"], r["points"]) for r in later.orderBy("ranking").collect()] == [("A", 3), ("new", 0), ("B", 0)]


def test_states_of_no_snapshot(spark):
    empty = spark.createDataFrame([], "team string, updated_at timestamp, wins bigint, draws bigint, losses bigint, goals_for bigint, goals_against bigint, points bigint")
    assert form_states(empty).isEmpty()


def test_a_hot_id_on_both_sides_does_not_multiply(spark):
    ids = spark.range(20_000).select(F.lit("hot").alias("game_id"))
    one = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "game_id string")
    times = [F.lit(WEEKS[0]).alias(c) for c in ("updated_at", "ingestion_time")]
    schedule = ids.union(one).select("game_id", F.lit(1).alias("round"), F.lit("A").alias("home_team"), F.lit("B").alias("away_team"), F.lit(WEEKS[0]).alias("game_start_time"))
    scores = ids.union(one.distinct()).select("game_id", F.lit(1).alias("home_goals"), F.lit(0).alias("away_goals"), *times, F.lit(WEEKS[0]).cast("date").alias("ingestion_date"))
    facts, repeated = guarded_facts(schedule, scores)
    assert sorted(r["game_id"] for r in facts.collect()) == ["x", "y", "y"]
    assert [tuple(r) for r in repeated.collect()] == [("hot", 20_000, 20_000)]


ROWS = [("a", 1, "x"), ("a", 2, "y"), (None, 3, "y"), (None, 4, None), ("c", -5, "z")]


def test_rows_are_tagged_with_every_check_they_break(spark):
    df = spark.createDataFrame(ROWS, "id string, n int, team string").repartition(3)
    allowed = spark.createDataFrame([("x",), ("y",)], "t string")
    checks = [Unique("id"), NotNull("team"), OneOf("team", allowed), Between("n", 0), OncePer(("team",), "id"), NotNull("nowhere")]
    got = {(r["id"], r["n"]): r["broken"] for r in violating_rows(df, checks).collect()}
    assert got == {("a", 1): [1], ("a", 2): [1], (None, 3): [1], (None, 4): [1, 2], ("c", -5): [3, 4]}
    assert violating_rows(df, [Unique("n")]).isEmpty() and violating_rows(df, []).isEmpty()


def test_group_checks_by_snapshot_share_a_pass(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "a", 1), (2, None, 1), (2, None, 2)], "s int, id string, r int")
    checks = [Unique("id"), OncePer(("r",), "id"), OncePer(("r",), "s"), Unique("s")]
    got = {(r["s"], r["check_no"]): r["violations"] for r in validate(df, checks, ["s"]).collect()}
    assert got == {(1, 1): 1, (1, 2): 0, (1, 3): 0, (1, 4): 1, (2, 1): 1, (2, 2): 0, (2, 3): 1, (2, 4): 2}


def test_columns_with_the_names_of_keys_come_back_as_they_were(spark):
    df = spark.createDataFrame([(1, "mine", 5), (2, "other", 6)], "id int, _key_0 string, _key_hash int")
    assert [tuple(r) for r in semi_join(df, spark.createDataFrame([(1,)], "id int"), "id").collect()] == [(1, "mine", 5)]
