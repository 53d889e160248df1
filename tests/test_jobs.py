"""The jobs on hand-made CSV files."""

from dataclasses import replace
from datetime import timedelta

import pathlib

import pytest
from pyspark.sql import functions as F

from matchboard.functions.periods import DEFAULT_SEASON as SEASON
from matchboard.plans import jobs
from matchboard.quality import ValidationError
from matchboard.sources.tables import named_teams

TEAMS = ["A", "B", "C", "D"]
ROUNDS = [
    [("A", "B", 2, 0), ("C", "D", 1, 1)],
    [("B", "C", 0, 3), ("D", "A", 2, 2)],
    [],
    [("A", "C", 1, 0), ("B", "D", 0, 0)],
]


def write_source(folder, matches, extra_scores=(), extra_schedule=()):
    """``matches``: (id, week, round, home, away, home goals, away goals)."""
    folder.mkdir(exist_ok=True)
    schedule = ["game_id,round,home_team,away_team,game_start_time"]
    scores = ["game_id,home_goals,away_goals,ingestion_time"]
    for game, week, number, home, away, hg, ag in matches:
        start = SEASON.start + timedelta(weeks=week, days=2)
        schedule.append(f"{game},{number},{home},{away},{start}")
        scores.append(f"{game},{hg}.0,{ag}.0,{start + timedelta(hours=3)}")
    (folder / "schedule.csv").write_text("\n".join([*schedule, *extra_schedule]) + "\n")
    (folder / "scores.csv").write_text("\n".join([*scores, *extra_scores]) + "\n")
    return str(folder)


def season_matches():
    out, game = [], 0
    for week, games in enumerate(ROUNDS):
        for home, away, hg, ag in games:
            game += 1
            out.append((f"g{game}", week, week + 1, home, away, hg, ag))
    return out


@pytest.fixture
def config(spark, tmp_path):
    source = write_source(
        tmp_path / "source",
        season_matches(),
        extra_scores=[
            "g1,2.0,0.0,2025-08-20 11:00:00",
            "gX,1.0,1.0,2025-08-20 11:00:00",
            "g9,,1.0,2025-08-20 11:00:00",
            "g8,1,1,",
        ],
        extra_schedule=["g99,7,A,B,2025-10-01 10:00:00"],
    )
    teams = named_teams(spark, TEAMS)
    return jobs.Config(source, str(tmp_path / "tables"), str(tmp_path / "output"), teams)


def table(df):
    columns = [c for c in df.columns if c != "updated_at"]
    return [tuple(r) for r in df.orderBy("ranking").select(*columns).collect()]


EXPECTED = [
    (1, "A", 2, 1, 0, 5, 2, 7),
    (2, "C", 1, 1, 1, 4, 2, 4),
    (3, "D", 0, 3, 0, 3, 3, 3),
    (4, "B", 0, 1, 2, 0, 5, 1),
]


def test_season(spark, config):
    reports = jobs.run_season(spark, config)
    assert table(jobs.read_standings(spark, config)) == EXPECTED
    broken = reports[0].broken
    # The copy, the gap and the unmatched id are reported for the raw scores only.
    assert {r["check"] for r in broken["raw_scores"]} == {"unique", "not_null", "between"}
    assert all(not failed for layer, failed in broken.items() if layer != "raw_scores")
    exported = spark.read.option("header", True).csv(f"{config.output}/{jobs.FINAL_CSV}")
    assert exported.columns == jobs.read_standings(spark, config).columns
    assert exported.count() == 4
    jobs.export_table(spark, config, jobs.SILVER_FACTS, "facts.csv")
    assert spark.read.option("header", True).csv(f"{config.output}/facts.csv").count() == 6


def test_weeks_one_by_one_equal_the_backfill(spark, config, tmp_path):
    for week in range(4):
        jobs.run_week(spark, config, week)
    weekly = jobs.read_history(spark, config)
    backfill = replace(config, base=str(tmp_path / "backfill"))
    jobs.run_backfill(spark, backfill, weeks=4)
    at_once = jobs.read_history(spark, backfill)
    assert weekly.count() == at_once.count() == 16
    assert weekly.exceptAll(at_once).isEmpty()
    last = weekly.filter(F.col("updated_at") == SEASON.start + timedelta(weeks=4))
    assert table(last) == EXPECTED
    for name in (jobs.BRONZE_SCORES, jobs.BRONZE_SCHEDULE, jobs.SILVER_FACTS):
        one, other = (
            jobs.read_layer(spark, c, name, True) for c in (config, backfill)
        )
        assert one.count() == 6
        assert one.select(*other.columns).exceptAll(other).isEmpty()

    # An earlier week again: nothing doubles, and later weeks do not leak in.
    before = sorted(map(tuple, weekly.collect()))
    jobs.run_week(spark, config, 1)
    assert sorted(map(tuple, jobs.read_history(spark, config).collect())) == before

    jobs.build_form(spark, config, n=2, k=1)
    form = spark.read.option("header", True).csv(f"{config.output}/{jobs.FORM_CSV}")
    got = form.select("team", "form", "form_ranking").collect()
    assert got == [("A", "DW", "1")]


def test_week_that_becomes_empty_is_cleared(spark, config, tmp_path):
    jobs.run_week(spark, config, 0)
    jobs.run_week(spark, config, 1)
    kept = [m for m in season_matches() if m[1] != 1]
    emptied = replace(config, source=write_source(tmp_path / "again", kept))
    jobs.run_week(spark, emptied, 1)
    facts = jobs.read_layer(spark, config, jobs.SILVER_FACTS, True)
    assert {r["game_id"] for r in facts.select("game_id").collect()} == {"g1", "g2"}
    history = jobs.read_history(spark, config)
    weeks = history.groupBy("updated_at").agg(F.sum("wins").alias("wins")).collect()
    assert [r["wins"] for r in weeks] == [1, 1]


@pytest.mark.parametrize(
    "bad, layer",
    [
        # The same id with another score survives cleaning and breaks uniqueness.
        ("g1,3,3,2025-08-20 11:00:00", "bronze_scores"),
        ("g1,-1,3,2025-08-20 11:00:00", "bronze_scores"),
    ],
)
def test_strict_checks_write_nothing(spark, tmp_path, bad, layer):
    source = write_source(tmp_path / "source", season_matches(), extra_scores=[bad])
    teams = named_teams(spark, TEAMS)
    strict = jobs.Config(source, str(tmp_path / "tables"), str(tmp_path / "output"), teams)
    with pytest.raises(ValidationError) as error:
        jobs.run_season(spark, strict)
    assert error.value.failed
    assert [p.name for p in (tmp_path / "tables").iterdir()] == ["quality"]
    stored = spark.read.parquet(strict.table(jobs.QUALITY.format(layer), False))
    assert stored.filter("not passed").count() == len(error.value.failed)


def test_unlisted_team_is_refused(spark, config):
    strict = replace(config, teams=named_teams(spark, ["A", "B", "C"]))
    with pytest.raises(ValidationError) as error:
        jobs.run_season(spark, strict)
    assert "one_of team" in str(error.value)


def test_unreadable_values_are_kept_apart(spark, tmp_path):
    source = write_source(
        tmp_path / "source",
        season_matches(),
        extra_scores=["g7,x,1,2025-08-20 11:00:00"],
        extra_schedule=["g7,1,A,D,2025-08-20 10:00:00"],
    )
    teams = named_teams(spark, TEAMS)
    cfg = jobs.Config(source, str(tmp_path / "tables"), str(tmp_path / "output"), teams)
    report = jobs.run_season(spark, cfg)[0]
    rejected = spark.read.parquet(report.rejected["raw_scores"])
    assert [(r["game_id"], r["rejected_columns"]) for r in rejected.collect()] == [("g7", ["home_goals"])]
    assert spark.read.parquet(report.rejected["raw_schedule"]).isEmpty()
    assert table(jobs.read_standings(spark, cfg)) == EXPECTED


BAD_WEEK = "g1,3,3,2025-08-20 11:00:00"  # the same id with another score


def test_backfill_leaves_out_what_weekly_runs_leave_out(spark, tmp_path):
    source = write_source(tmp_path / "source", season_matches(), extra_scores=[BAD_WEEK])
    teams = named_teams(spark, TEAMS)
    weekly, at_once = (
        jobs.Config(source, str(tmp_path / name), str(tmp_path / f"{name}-out"), teams)
        for name in ("weekly", "backfill")
    )
    failed = []
    for week in range(2):
        try:
            jobs.run_week(spark, weekly, week)
        except ValidationError:
            failed.append(week)
    assert failed == [0]
    with pytest.raises(ValidationError) as error:
        jobs.run_backfill(spark, at_once, weeks=2)
    assert "unique game_id" in str(error.value)
    one, other = jobs.read_history(spark, weekly), jobs.read_history(spark, at_once)
    assert one.count() == other.count() == 4 and one.exceptAll(other).isEmpty()
    facts = [jobs.read_layer(spark, c, jobs.SILVER_FACTS, True) for c in (weekly, at_once)]
    assert facts[0].select(*facts[1].columns).exceptAll(facts[1]).isEmpty()


def test_old_week_again_refreshes_later_snapshots(spark, config, tmp_path):
    for week in range(2):
        jobs.run_week(spark, config, week)
    changed = [(*m[:5], m[5] + 7, m[6]) if m[0] == "g1" else m for m in season_matches()]
    again = replace(config, source=write_source(tmp_path / "again", changed))
    jobs.run_week(spark, again, 0)
    fresh = replace(again, base=str(tmp_path / "fresh"))
    jobs.run_backfill(spark, fresh, weeks=2)
    ours, wanted = jobs.read_history(spark, config), jobs.read_history(spark, fresh)
    assert ours.count() == wanted.count() == 8 and ours.exceptAll(wanted).isEmpty()


def test_nothing_staged_is_left(spark, config, tmp_path):
    scratch = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "matchboard"
    before = set(scratch.glob("*")) if scratch.exists() else set()
    jobs.run_season(spark, config)
    broken = write_source(tmp_path / "broken", season_matches(), extra_scores=[BAD_WEEK])
    with pytest.raises(ValidationError):
        jobs.run_season(spark, replace(config, source=broken))
    assert set(scratch.glob("*")) == before


def test_malformed_lines_are_rejected(spark, tmp_path):
    source = write_source(tmp_path / "source", season_matches(), extra_scores=["g1,9,9,2025-08-20 11:00:00,7,8", "g2,1"])
    cfg = jobs.Config(source, str(tmp_path / "tables"), str(tmp_path / "output"), named_teams(spark, TEAMS))
    report = jobs.run_season(spark, cfg)[0]
    rejected = spark.read.parquet(report.rejected["raw_scores"]).collect()
    assert sorted((r["game_id"], *r["rejected_columns"]) for r in rejected) == [
        ("g1", jobs.MALFORMED), ("g2", jobs.MALFORMED),
    ]
    assert table(jobs.read_standings(spark, cfg)) == EXPECTED


def test_missing_column_is_a_broken_check(spark, tmp_path):
    source = write_source(tmp_path / "source", season_matches())
    path = pathlib.Path(source) / jobs.SCORES_FILE
    lines = path.read_text().splitlines()
    path.write_text("\n".join(",".join(line.split(",")[:1] + line.split(",")[2:]) for line in lines))
    cfg = jobs.Config(source, str(tmp_path / "tables"), str(tmp_path / "output"), named_teams(spark, TEAMS))
    with pytest.raises(ValidationError) as error:
        jobs.run_season(spark, cfg)
    assert "home_goals is missing" in str(error.value)


def test_exported_history_keeps_wall_clock_times(spark, config):
    ntz = replace(config, time="timestamp_ntz")
    jobs.run_backfill(spark, ntz, weeks=4)
    jobs.export_table(spark, ntz, f"{jobs.GOLD_STANDINGS}{jobs.HISTORY}", "table.csv")
    by_table, by_job = (
        spark.read.option("header", True).csv(f"{ntz.output}/{name}") for name in ("table.csv", jobs.HISTORY_CSV)
    )
    assert by_table.count() == 16
    assert by_table.select(*by_job.columns).exceptAll(by_job).isEmpty()
