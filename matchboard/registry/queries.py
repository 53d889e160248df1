"""One query per operator, over the matches of ``matchboard.fixtures``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchboard.fixtures import SEASON, TIME, Matches
from matchboard.functions.casts import at, to_int, to_time
from matchboard.functions.periods import (
    WEEK,
    calendar,
    season_period,
    week_columns,
    week_index,
    week_period,
)
from matchboard.operators.cleaning import REASONS, clean_schedule, clean_scores, slice_period
from matchboard.operators.facts import guarded_facts, repeated_ids
from matchboard.operators.facts import match_facts as build_facts
from matchboard.operators.form import (
    form_of_states,
    form_states,
    form_table,
    last_matches,
    matches_from_deltas,
    recent_form,
    weekly_deltas,
)
from matchboard.operators.keys import (
    anti_join,
    distinct_count,
    duplicate_keys,
    duplicate_rows,
    missing_keys,
    presence,
    reconcile,
    semi_join,
)
from matchboard.operators.standings import (
    absent_teams,
    standings,
    standings_history,
    team_results,
)
from matchboard.plans import jobs
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
    failures,
    sample_values,
    suites,
    validate,
    violating_rows,
    violations,
)
from matchboard.quality.suites import PeriodBounds
from matchboard.schemas import RAW_SCORES, STANDINGS, layout
from matchboard.sources.landing import WEEK as LANDED_WEEK
from matchboard.sources.landing import land
from matchboard.sources.staging import scratch_path, stage
from matchboard.sources.tables import export_csv, read_raw, read_table, write_snapshots
from matchboard.sources.versions import transaction

WEEK_NUMBER = 100
AS_OF = SEASON.start + (WEEK_NUMBER + 1) * WEEK
RANGE = (datetime(1996, 1, 1), datetime(1999, 12, 31))
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[Matches], DataFrame]) -> Callable[[Matches], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Matches(spark, folder))
    return build


# Periods


@query
def slice_week(m: Matches) -> DataFrame:
    period = week_period(SEASON, WEEK_NUMBER)
    _, schedule = slice_period(m.scores(), m.schedule(), period)
    return schedule.drop("updated_at")


@query
def slice_week_scores(m: Matches) -> DataFrame:
    period = week_period(SEASON, WEEK_NUMBER)
    scores, _ = slice_period(m.scores(), m.schedule(), period)
    return scores.drop("updated_at", "ingestion_date")


@query
def week_of_match(m: Matches) -> DataFrame:
    week = week_index(F.col("ingestion_time"), SEASON, TIME)
    return m.scores().select(
        "game_id", week.alias("week"), *week_columns(week, SEASON, TIME)[:-1]
    )


@query
def week_calendar(m: Matches) -> DataFrame:
    """Every week from the first to the last match, with its number of matches."""
    played = m.facts().groupBy("updated_at").agg(F.count("*").alias("n"))
    step = F.expr("interval '7' day")
    # One row per week reaches this window.
    following = F.lead("updated_at").over(Window.orderBy("updated_at"))
    until = F.coalesce(following - step, F.col("updated_at"))
    weeks = played.withColumn("until", until).select(
        "n", F.posexplode(F.sequence("updated_at", "until", step)).alias("gap", "updated_at")
    )
    week = week_index(F.col("updated_at"), SEASON, TIME)
    return weeks.select(
        week.alias("week"),
        *week_columns(week, SEASON, TIME)[:-1],
        F.when(F.col("gap") == 0, F.col("n")).otherwise(0).alias("matches"),
    )


@query
def season_calendar(m: Matches) -> DataFrame:
    """Every week of the season, with its number of matches."""
    played = m.facts().groupBy("updated_at").agg(F.count("*").alias("n"))
    weeks = calendar(m.spark, SEASON, time=TIME).join(played, "updated_at", "left")
    return weeks.withColumn("matches", F.coalesce("n", F.lit(0))).drop("n")


# Cleaning and keys


def _rejected(df: DataFrame) -> DataFrame:
    return df.withColumn(REASONS, F.array_join(REASONS, ","))


@query
def clean_scores_rows(m: Matches) -> DataFrame:
    return clean_scores(m.raw_scores(), SEASON.end, TIME)[0]


@query
def clean_schedule_rows(m: Matches) -> DataFrame:
    return clean_schedule(m.raw_schedule(), SEASON.end, TIME)[0]


@query
def rejected_scores(m: Matches) -> DataFrame:
    return _rejected(clean_scores(m.raw_scores(), SEASON.end, TIME)[1])


@query
def rejected_schedule(m: Matches) -> DataFrame:
    return _rejected(clean_schedule(m.raw_schedule(), SEASON.end, TIME)[1])


@query
def cast_rounds(m: Matches) -> DataFrame:
    return m.raw_schedule().agg(
        F.count("*").alias("rows"),
        F.count(F.col("game_id").try_cast("int")).alias("plain_integers"),
        F.count(F.col("round").try_cast("int")).alias("plain_rounds"),
        F.count(to_int("round")).alias("through_double"),
        F.sum(to_int("round")).alias("round_sum"),
    )


@query
def try_cast_range(m: Matches) -> DataFrame:
    checks = [
        Between("value", 1, 300),
        Between("value", low=10),
        Between("user_id", high=50),
        Between("event_type"),
        Between("props", 0, 1),
    ]
    return validate(m.table("events"), checks)


@query
def reconcile_ids(m: Matches) -> DataFrame:
    scores = m.goals().filter(F.col("o_orderstatus") != "P")
    schedule, scores = reconcile(m.schedule(), scores, "game_id")
    return schedule.select(F.lit("schedule").alias("side"), "game_id").unionByName(
        scores.select(F.lit("scores").alias("side"), "game_id")
    )


@query
def mismatched_ids(m: Matches) -> DataFrame:
    scores = m.goals().filter(F.col("o_orderstatus") != "P")
    return missing_keys(m.schedule(), scores, "game_id")


@query
def exclude_ids(m: Matches) -> DataFrame:
    finished = m.goals().filter(F.col("o_orderstatus") == "F")
    return anti_join(m.schedule(), finished, "game_id")


def _order_ids(m: Matches) -> dict[str, DataFrame]:
    return {
        "orders": m.table("orders").select(F.col("o_orderkey").cast("string").alias("game_id")),
        "lineitem": m.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("game_id")
        ),
        "matches": m.schedule(),
    }


@query
def id_presence_mask(m: Matches) -> DataFrame:
    flags = presence(_order_ids(m), "game_id")
    return flags.groupBy("in_orders", "in_lineitem", "in_matches").agg(F.count("*").alias("ids"))


@query
def pairwise_id_match(m: Matches) -> DataFrame:
    tables = _order_ids(m)
    return validate(tables["orders"], [SameIds(tables)])


@query
def duplicate_line_keys(m: Matches) -> DataFrame:
    return duplicate_keys(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def duplicate_line_rows(m: Matches) -> DataFrame:
    return duplicate_rows(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def duplicate_score_rows(m: Matches) -> DataFrame:
    return duplicate_rows(m.raw_scores(), "game_id")


@query
def distinct_rows(m: Matches) -> DataFrame:
    return m.raw_scores().dropDuplicates()


@query
def distinct_values(m: Matches) -> DataFrame:
    return distinct_count(m.raw_schedule(), "game_id", "round", "home_team", "away_team")


# Quality


@query
def null_counts(m: Matches) -> DataFrame:
    raw = m.raw_scores()
    return validate(raw, [NotNull(c) for c in raw.columns])


@query
def unique_ids(m: Matches) -> DataFrame:
    return validate(m.raw_scores(), [Unique("game_id"), Unique("ingestion_time")])


@query
def unique_within_round(m: Matches) -> DataFrame:
    return violations(m.facts(), OncePer(("round",), "home_team"))


@query
def differing_columns(m: Matches) -> DataFrame:
    pairings = m.pairings().drop("o_orderstatus", "o_orderpriority", "updated_at")
    return violations(pairings, Differ("home_team", "away_team"))


@query
def datetime_range(m: Matches) -> DataFrame:
    return violations(m.raw_scores(), TimeBetween("ingestion_time", *RANGE))


@query
def datetime_range_counts(m: Matches) -> DataFrame:
    return validate(m.raw_scores(), [TimeBetween("ingestion_time", *RANGE)])


@query
def allowed_values(m: Matches) -> DataFrame:
    unknown = violations(m.table("events"), OneOf("event_type", ["click", "view", "signup"]))
    return unknown.groupBy("event_type").agg(F.count("*").alias("rows"))


@query
def allowed_values_sample(m: Matches) -> DataFrame:
    known = OneOf("event_type", ["click", "view"])
    return sample_values(m.table("events"), known, 5)


@query
def allowed_values_frame_mixed(m: Matches) -> DataFrame:
    """The allowed values have another number type than the column."""
    nation = m.table("nation").filter(F.col("n_regionkey") < 2)
    known = nation.select(F.col("n_nationkey").cast("bigint").alias("key"))
    return validate(m.table("customer"), [OneOf("c_nationkey", known)])


@query
def semi_join_mixed_types(m: Matches) -> DataFrame:
    """Customers of nations of two regions, by an int against a bigint key."""
    nation = m.table("nation").filter(F.col("n_regionkey") < 2)
    keys = nation.select(F.col("n_nationkey").cast("bigint").alias("c_nationkey"))
    return semi_join(m.table("customer").select("c_custkey", "c_nationkey"), keys, "c_nationkey")


@query
def failure_report(m: Matches) -> DataFrame:
    """Every broken check of a suite per snapshot."""
    checks = [Unique("game_id"), Between("home_goals", 1, 5), Differ("home_goals", "away_goals")]
    return failures(validate(m.facts(), checks, by=["updated_at"])).drop("passed")


@query
def schema_mismatch(m: Matches) -> DataFrame:
    """A table against a layout of which it lacks two columns."""
    wanted = layout("n_nationkey int, n_name string, n_continent string, n_code int")
    return validate(m.table("nation"), [HasSchema(wanted)])


@query
def allowed_teams(m: Matches) -> DataFrame:
    nation = m.table("nation")
    some = nation.filter(F.col("n_regionkey") < 2).select("n_name")
    return validate(m.facts(), [OneOf("home_team", some), OneOf("away_team", some)])


@query
def row_count_match(m: Matches) -> DataFrame:
    return validate(m.schedule(), [SameCount(m.scores()), SameCount(m.facts())])


@query
def raw_scores_report(m: Matches) -> DataFrame:
    return validate(m.raw_scores(), suites.raw_scores(_bounds()))


@query
def raw_schedule_report(m: Matches) -> DataFrame:
    return validate(m.raw_schedule(), suites.raw_schedule(_bounds()))


@query
def validate_report(m: Matches) -> DataFrame:
    schedule, scores = stage(m.schedule()), stage(m.scores())
    facts = stage(build_facts(schedule, scores))
    tables = {"schedule": schedule, "scores": scores, "matches": facts}
    return validate(facts, suites.match_facts(_bounds(), tables, TIME))


@query
def validate_by_snapshot(m: Matches) -> DataFrame:
    checks = [
        Unique("game_id"),
        OncePer(("round",), "away_team"),
        Between("home_goals", 1, 5),
        Differ("home_goals", "away_goals"),
    ]
    return validate(m.facts(), checks, by=["updated_at"])


@query
def bronze_scores_report(m: Matches) -> DataFrame:
    typed, _ = clean_scores(m.raw_scores(), SEASON.end, TIME)
    return validate(stage(typed), suites.bronze_scores(_bounds(), TIME))


@query
def bronze_schedule_report(m: Matches) -> DataFrame:
    typed, _ = clean_schedule(m.raw_schedule(), SEASON.end, TIME)
    return validate(stage(typed), suites.bronze_schedule(_bounds(), TIME))


@query
def violations_by_suite(m: Matches) -> DataFrame:
    """Every raw score that breaks a check, with the numbers of the checks it breaks."""
    rows = violating_rows(m.raw_scores(), suites.raw_scores(_bounds()))
    return rows.withColumn("broken", F.array_join("broken", ","))


@query
def violations_of_facts(m: Matches) -> DataFrame:
    """The same for facts, with checks by group, on listed values and on ids of other tables."""
    some = m.table("nation").filter(F.col("n_regionkey") < 2).select("n_name")
    urgent = m.goals().filter(F.col("o_orderpriority") != "1-URGENT")
    checks = [
        OncePer(("round",), "home_team"),
        OneOf("away_team", some),
        SameIds({"facts": m.facts(), "others": urgent}),
        Between("home_goals", 1, 5),
        Unique("match_time"),
    ]
    rows = violating_rows(m.facts(), checks, by=["updated_at"])
    return rows.select("game_id", F.array_join("broken", ",").alias("broken"))


@query
def standings_report(m: Matches) -> DataFrame:
    """Checks of every snapshot; a team has at most as many results of a kind as rounds."""
    teams = m.teams()
    week = week_index(F.col("updated_at"), SEASON, TIME)
    history = stage(m.history())
    bounded = history.select(*history.columns, *week_columns(week, SEASON, TIME)[:-1])
    checks = suites.standings(teams, teams.count(), PeriodBounds.by_row().max_round)
    return validate(bounded, checks, by=["updated_at"])


def _bounds() -> PeriodBounds:
    return PeriodBounds.of(season_period(SEASON))


# Facts and standings


@query
def match_facts(m: Matches) -> DataFrame:
    return m.facts()


def _repeating(m: Matches) -> tuple[DataFrame, DataFrame]:
    """Schedule and scores with copies: finished orders on both sides, urgent ones on one."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    twice = m.pairings().filter((F.col("home_team") != F.col("away_team")) & (status == "F"))
    schedule = m.schedule().unionByName(twice.drop("o_orderstatus", "o_orderpriority"))
    more = m.goals().filter((status == "F") | (priority == "1-URGENT"))
    more = more.withColumn("ingestion_date", F.to_date("ingestion_time"))
    scores = m.scores().unionByName(more.drop("o_orderstatus", "o_orderpriority"))
    return schedule, scores


@query
def facts_repeated_ids(m: Matches) -> DataFrame:
    """Facts of frames with copies; ids that repeat on both sides are left out."""
    return guarded_facts(*_repeating(m))[0]


@query
def ids_left_out(m: Matches) -> DataFrame:
    return repeated_ids(*_repeating(m))


@query
def one_match_lookup(m: Matches) -> DataFrame:
    return m.facts().filter(F.col("game_id") == "100")


@query
def home_and_away_results(m: Matches) -> DataFrame:
    return team_results(m.facts(), ["game_id"])


@query
def standings_table(m: Matches) -> DataFrame:
    return standings(m.facts(), m.teams()).orderBy("ranking")


@query
def standings_as_of(m: Matches) -> DataFrame:
    return standings(m.facts(), m.teams(), as_of=AS_OF)


@query
def standings_with_absent(m: Matches) -> DataFrame:
    week = m.facts().filter(F.col("updated_at") == at(AS_OF, TIME))
    return standings(week, m.teams())


@query
def absent_in_week(m: Matches) -> DataFrame:
    """Teams without a win in one week."""
    week = m.facts().filter(F.col("updated_at") == at(AS_OF, TIME))
    return absent_teams(team_results(week).filter("wins = 1"), m.teams())


@query
def standings_by_year(m: Matches) -> DataFrame:
    """Every year is a competition of its own; ranks go through the sliced path."""
    facts = m.facts().withColumn("year", F.year("match_date"))
    years = [row["year"] for row in facts.select("year").distinct().collect()]
    teams = m.teams().withColumn("year", F.explode(F.array(*map(F.lit, years))))
    return standings(facts, teams, ["year"], slices=8)


@query
def standings_history_rows(m: Matches) -> DataFrame:
    return m.history()


@query
def snapshot_lookup(m: Matches) -> DataFrame:
    return m.history().filter(F.col("updated_at") == at(AS_OF, TIME))


@query
def history_by_side(m: Matches) -> DataFrame:
    """Two leagues by match outcome side: finished orders and all others."""
    scores = m.goals().drop("o_orderpriority").withColumnRenamed("o_orderstatus", "league")
    scores = scores.withColumn("ingestion_date", F.to_date("ingestion_time"))
    facts = build_facts(m.schedule(), scores, extra=("updated_at", "league"))
    leagues = [row["league"] for row in scores.select("league").distinct().collect()]
    teams = m.teams().withColumn("league", F.explode(F.array(*map(F.lit, leagues))))
    return standings_history(facts, teams, SEASON.start + WEEK, SEASON.end, ["league"])


@query
def standings_carried_on(m: Matches) -> DataFrame:
    """The history after one snapshot, from that snapshot and the facts after it."""
    facts = m.facts()
    later = facts.filter(F.col("updated_at") > at(AS_OF, TIME))
    opening = standings(facts, m.teams(), as_of=AS_OF)
    return standings_history(later, m.teams(), AS_OF + WEEK, SEASON.end, opening=opening)


# Recent form


@query
def form_carried_on(m: Matches) -> DataFrame:
    """Best form after one snapshot, from the states stored with it and later standings."""
    moment = at(AS_OF, TIME)
    history = m.history()
    kept = form_states(history.filter(F.col("updated_at") <= moment)).filter(F.col("updated_at") == moment)
    later = history.filter(F.col("updated_at") >= moment)
    return form_of_states(form_states(later, opening=stage(kept), since=AS_OF))


@query
def recent_form_ranked(m: Matches) -> DataFrame:
    """All teams with five matches, ranked at every snapshot."""
    return recent_form(m.history(), k=None)


@query
def weekly_delta_rows(m: Matches) -> DataFrame:
    return weekly_deltas(m.history())


@query
def matches_from_history(m: Matches) -> DataFrame:
    return matches_from_deltas(weekly_deltas(m.history()))


@query
def last5_matches(m: Matches) -> DataFrame:
    return last_matches(weekly_deltas(m.history()))


@query
def form_aggregate(m: Matches) -> DataFrame:
    return form_table(weekly_deltas(m.history()))


@query
def recent_form_top3(m: Matches) -> DataFrame:
    return recent_form(m.history()).orderBy("updated_at", "form_ranking")


@query
def recent_form_all_weeks(m: Matches) -> DataFrame:
    """Best ten over the last three matches, the first snapshot included."""
    return recent_form(m.history(), n=3, k=10, include_first=True)


# Sources, sinks and jobs


def _write_source(m: Matches) -> str:
    folder = scratch_path(m.spark, "source")
    scores, schedule = m.raw_scores(), m.raw_schedule()
    jobs.together(
        lambda: export_csv(scores, f"{folder}/{jobs.SCORES_FILE}"),
        lambda: export_csv(schedule, f"{folder}/{jobs.SCHEDULE_FILE}"),
    )
    return folder


def _config(m: Matches, source: str) -> jobs.Config:
    # Nations play several times a week, which the strict checks refuse.
    base = scratch_path(m.spark, "tables")
    return jobs.Config(
        source, base, f"{base}/output", m.teams(), SEASON, time=TIME, mode="soft"
    )


@query
def csv_round_trip(m: Matches) -> DataFrame:
    path = scratch_path(m.spark, "csv")
    export_csv(m.raw_scores(), path)
    return read_raw(m.spark, path, RAW_SCORES)


@query
def csv_reordered_columns(m: Matches) -> DataFrame:
    """A file with its columns in another order, and one more."""
    path = scratch_path(m.spark, "csv")
    raw = m.raw_scores()
    export_csv(raw.select("ingestion_time", F.lit("x").alias("note"), "away_goals", "game_id", "home_goals"), path)
    return read_raw(m.spark, path, RAW_SCORES)


@query
def snapshot_overwrite(m: Matches) -> DataFrame:
    """A history of which one snapshot was written again; the others stay."""
    path = scratch_path(m.spark, "history")
    history = stage(m.history())
    write_snapshots(history, path, replace_all=True)
    again = history.filter(F.col("updated_at") == at(AS_OF, TIME))
    write_snapshots(again.withColumn("ranking", F.col("ranking") + 100), path)
    return read_table(m.spark, path, history.schema)


@query
def landed_week(m: Matches) -> DataFrame:
    """The raw scores of one week, out of rows that have landed by week."""
    folder, base = scratch_path(m.spark, "source"), scratch_path(m.spark, "tables")
    export_csv(m.raw_scores(), folder)
    week = week_index(to_time("ingestion_time", TIME), SEASON, TIME)
    with transaction(m.spark, base) as tx:
        rows = land(m.spark, tx, "raw/scores", folder, RAW_SCORES, week)
    return rows.filter(F.col(LANDED_WEEK) == WEEK_NUMBER).drop(LANDED_WEEK, "_corrupt_record")


def _calm_matches(m: Matches) -> DataFrame:
    """Facts in which a team plays once at home and once away in a round, as strict checks ask."""
    first = lambda team: F.row_number().over(Window.partitionBy("round", team).orderBy("game_id"))
    marked = m.facts().withColumns({"_home": first("home_team"), "_away": first("away_team")})
    return marked.filter("_home = 1 and _away = 1").drop("_home", "_away")


def _calm_config(m: Matches, facts: DataFrame, more: DataFrame | None = None) -> jobs.Config:
    """A strict configuration over files of these facts; ``more`` are further score rows."""
    folder, base = scratch_path(m.spark, "source"), scratch_path(m.spark, "tables")
    text = lambda *names: [F.col(c).cast("string").alias(c) for c in names]
    scores = facts.select(*text("game_id", "home_goals", "away_goals", "ingestion_time"))
    export_csv(scores if more is None else scores.unionByName(more), f"{folder}/{jobs.SCORES_FILE}")
    schedule = facts.withColumnRenamed("match_time", "game_start_time")
    columns = text("game_id", "round", "home_team", "away_team", "game_start_time")
    export_csv(schedule.select(*columns), f"{folder}/{jobs.SCHEDULE_FILE}")
    return jobs.Config(folder, base, f"{base}/output", m.teams(), SEASON, time=TIME)


def _second_score(facts: DataFrame) -> DataFrame:
    """Every match of one week once more, with another score."""
    week = facts.filter(F.col("updated_at") == at(AS_OF, TIME))
    return week.select("game_id", F.lit("77").alias("home_goals"), F.lit("0").alias("away_goals"), F.col("ingestion_time").cast("string").alias("ingestion_time"))


@query
def strict_season_job(m: Matches) -> DataFrame:
    cfg = _calm_config(m, stage(_calm_matches(m)))
    jobs.run_season(m.spark, cfg)
    return jobs.read_standings(m.spark, cfg)


@query
def row_count_gate(m: Matches) -> DataFrame:
    """The stored row counts of a strict run that they stop: every match of a week has two scores."""
    facts = stage(_calm_matches(m))
    cfg = _calm_config(m, facts, _second_score(facts))
    try:
        reports = jobs.run_season(m.spark, cfg)
    except ValidationError:
        return m.spark.read.parquet(cfg.table(jobs.QUALITY.format("row_counts"), False))
    return m.spark.read.parquet(reports[0].metrics["row_counts"])


@query
def rerun_week_job(m: Matches) -> DataFrame:
    """Two weeks, then the first again with other scores: both snapshots follow."""
    weeks = [WEEK_NUMBER, WEEK_NUMBER + 1]
    facts = stage(_calm_matches(m))
    cfg = _calm_config(m, facts)
    for week in weeks:
        jobs.run_week(m.spark, cfg, week)
    in_week = F.col("updated_at") == at(AS_OF, TIME)
    changed = facts.withColumn("home_goals", F.col("home_goals") + F.when(in_week, 2).otherwise(0))
    again = _calm_config(m, changed)
    jobs.run_week(m.spark, replace(cfg, source=again.source), WEEK_NUMBER)
    return jobs.read_history(m.spark, cfg)


@query
def backfill_one_bad_week(m: Matches) -> DataFrame:
    """A strict backfill in which the matches of one week have two scores: it is left out."""
    facts = stage(_calm_matches(m))
    cfg = _calm_config(m, facts, _second_score(facts))
    try:
        jobs.run_backfill(m.spark, cfg, SEASON.weeks)
    except ValidationError:
        pass  # names the week; all others are published
    return jobs.read_history(m.spark, cfg)


@query
def season_job(m: Matches) -> DataFrame:
    cfg = _config(m, _write_source(m))
    jobs.run_season(m.spark, cfg)
    return jobs.read_standings(m.spark, cfg)


@query
def backfill_job(m: Matches) -> DataFrame:
    cfg = _config(m, _write_source(m))
    jobs.run_backfill(m.spark, cfg, SEASON.weeks)
    return jobs.read_history(m.spark, cfg)


@query
def export_history_csv(m: Matches) -> DataFrame:
    """The exported history of a backfill, read back."""
    cfg = _config(m, _write_source(m))
    jobs.run_backfill(m.spark, cfg, SEASON.weeks)
    schema = layout(STANDINGS, TIME, "updated_at {time}")
    return m.spark.read.schema(schema).option("header", True).csv(f"{cfg.output}/{jobs.HISTORY_CSV}")


@query
def job_rejects(m: Matches) -> DataFrame:
    """The stored rejected scores of a season run."""
    cfg = _config(m, _write_source(m))
    reports = jobs.run_season(m.spark, cfg)
    rejected = m.spark.read.parquet(reports[0].rejected["raw_scores"])
    return _rejected(rejected).drop("updated_at")


@query
def form_export(m: Matches) -> DataFrame:
    base = scratch_path(m.spark, "tables")
    cfg = jobs.Config("", base, f"{base}/output", m.teams(), SEASON, time=TIME)
    jobs.store_layer(m.spark, cfg, jobs.GOLD_STANDINGS, True, m.history())
    jobs.build_form(m.spark, cfg)
    schema = (
        "updated_at timestamp_ntz, team string, goals_for bigint, goals_against bigint, "
        "form string, last5_points bigint, form_ranking int"
    )
    return m.spark.read.schema(schema).option("header", True).csv(f"{cfg.output}/{jobs.FORM_CSV}")
