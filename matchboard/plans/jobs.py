"""The jobs: ingest, match facts, standings, recent form, and runs of all of them.

Each layer is written once, checked where it was written and published by a commit, which
takes all layers of a run together; see ``sources.versions``. Raw files are parsed once each
and kept by week. A weekly run reads its own week of the raw rows, the standings and form
states of the snapshot before it and the facts after that; only snapshots it makes out of date
are computed again. Metrics of the checks are stored whether a run is published or not.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce, wraps

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchboard.functions.casts import at, to_time
from matchboard.functions.periods import WEEK as WEEK_LENGTH
from matchboard.functions.periods import (
    DEFAULT_SEASON,
    Period,
    Season,
    run_time,
    season_period,
    week_columns,
    week_end,
    week_index,
    week_period,
)
from matchboard.operators.cleaning import REASONS, clean_schedule, clean_scores, in_period
from matchboard.operators.facts import guarded_facts
from matchboard.operators.form import form_of_states, form_states, recent_form
from matchboard.operators.keys import attach, reconcile, semi_join
from matchboard.operators.standings import standings, standings_history
from matchboard.quality import suites
from matchboard.quality.checks import HasSchema, SameCount
from matchboard.quality.suites import PeriodBounds
from matchboard.quality.validate import ValidationError, enforce, failures, validate
from matchboard.schemas import (
    MATCH_FACTS,
    RAW_SCHEDULE,
    RAW_SCORES,
    SCHEDULE,
    SCORES,
    STANDINGS,
    column_names,
    layout,
)
from matchboard.sources.landing import WEEK, land
from matchboard.sources.staging import run_folder, stage
from matchboard.sources.tables import (
    CORRUPT,
    FORMAT,
    SNAPSHOT,
    export_csv,
    read_table,
    write_snapshots,
    write_table,
)
from matchboard.sources.versions import Transaction, snapshot_key, transaction

# Places of the source files, stored tables and exports.
SCORES_FILE, SCHEDULE_FILE = "scores.csv", "schedule.csv"
BRONZE_SCORES, BRONZE_SCHEDULE = "bronze/scores", "bronze/schedule"
SILVER_FACTS = "silver/match_facts"
REPEATED_IDS = "silver/repeated_ids"
GOLD_STANDINGS = "gold/standings"
FORM_STATES = "gold/form_states"
REJECTED_SCORES, REJECTED_SCHEDULE = "bronze/rejected_scores", "bronze/rejected_schedule"
RAW_TABLES = {SCORES_FILE: "raw/scores", SCHEDULE_FILE: "raw/schedule"}
QUALITY = "quality/{}"
MALFORMED = "malformed line"
HISTORY = "_hist"
FINAL_CSV = "standings_final.csv"
HISTORY_CSV = "standings_historical.csv"
FORM_CSV = "recent_form.csv"
# Layers whose checks never stop a run, and those that stop it together.
SOFT = ("raw_scores", "raw_schedule")
STRICT_BRONZE = ("row_counts", "bronze_scores", "bronze_schedule")


def _named(name: str, weekly: bool) -> str:
    return f"{name}{HISTORY if weekly else ''}"


@dataclass(frozen=True)
class Config:
    """Where a league lives and how strict its checks are.

    ``mode`` "soft" reports broken checks of the stored layers instead of raising.
    """

    source: str
    base: str
    output: str
    teams: DataFrame
    season: Season = DEFAULT_SEASON
    fmt: str = FORMAT
    time: str = "timestamp"
    mode: str = "strict"
    rank_slices: int = 1  # tasks that number one ranking; see ``rank_rows``
    form_matches: int = 5  # matches a stored form state holds

    def table(self, name: str, weekly: bool) -> str:
        return f"{self.base}/{_named(name, weekly)}"


@dataclass
class Report:
    """Broken checks by layer, one row for each check; the metrics of all are stored.

    ``metrics`` names the stored tables, ``rejected`` the folders of this run.
    """

    broken: dict[str, list[Row]] = field(default_factory=dict)
    metrics: dict[str, str] = field(default_factory=dict)
    rejected: dict[str, str] = field(default_factory=dict)
    left_out: list = field(default_factory=list)  # snapshots that a backfill did not publish

    def note(
        self, cfg: Config, layer: str, metrics: DataFrame, period: Period | None, replace_all: bool = True
    ) -> DataFrame:
        """Store metrics and list what is broken.

        ``period`` is the snapshot of a weekly run; metrics by snapshot have their own, and
        replace all that are stored or only those of the same snapshots.
        """
        if period is not None:
            metrics = metrics.withColumn(SNAPSHOT, at(period.updated_at, cfg.time))
        weekly = SNAPSHOT in metrics.columns
        path = cfg.table(QUALITY.format(layer), weekly)
        self.metrics[layer] = path
        if weekly:
            write_snapshots(metrics, path, cfg.fmt, replace_all=replace_all and period is None)
        else:
            write_table(metrics, path, cfg.fmt)
        stored = read_table(metrics.sparkSession, path, metrics.schema, cfg.fmt)
        if period is not None:
            stored = stored.filter(F.col(SNAPSHOT) == at(period.updated_at, cfg.time))
        self.broken[layer] = enforce(stored, "soft")
        return stored

    def failed(self, *layers: str) -> list[Row]:
        """The broken checks of some layers; one that two layers share is listed once."""
        rows = {(r["check"], r["target"], r["violations"]): r for layer in layers for r in self.broken.get(layer, [])}
        return list(rows.values())

    def enforce(self, cfg: Config, *layers: str) -> None:
        """In strict mode, raise with all broken checks of the layers."""
        if cfg.mode not in ("soft", "strict"):
            raise ValueError(f"mode must be soft or strict, not {cfg.mode}")
        failed = self.failed(*layers)
        if failed and cfg.mode == "strict":
            raise ValidationError(failed)


def together(*tasks: Callable) -> list:
    """Run tasks that do not need each other's results side by side."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        # each with the run's own staging folder
        return [done.result() for done in [pool.submit(copy_context().run, task) for task in tasks]]


def _job(job: Callable) -> Callable:
    """Run within the transaction given as ``tx``, or in one of its own, and clean up."""

    @wraps(job)
    def run(spark: SparkSession, cfg: Config, *args, tx: Transaction | None = None):
        with run_folder(spark):
            if tx is not None:
                return job(spark, cfg, *args, tx)
            with transaction(spark, cfg.base, cfg.fmt) as own:
                return job(spark, cfg, *args, own)

    return run


@_job
def ingest(spark: SparkSession, cfg: Config, period: Period, weekly: bool, tx: Transaction) -> Report:
    """Raw files to checked, typed bronze tables for one period."""
    report = Report()
    snapshot = period if weekly else None
    raw_scores, raw_schedule = _read_source(spark, cfg, report, snapshot, tx)
    first = (period.start - cfg.season.start) // WEEK_LENGTH
    last = -((cfg.season.start - period.end) // WEEK_LENGTH) - 1
    # Rows before the first week have no week, as have those without a readable time.
    week = F.col(WEEK)
    inside = week.between(first, last) | week.isNull()
    raw_scores = raw_scores.filter(inside).drop(WEEK)
    unread = F.col(CORRUPT).isNotNull() & to_time("ingestion_time", cfg.time).isNull()
    slice_ = in_period(raw_scores, period).unionByName(raw_scores.filter(unread))
    scores = stage(slice_, "raw-scores")
    schedule = stage(semi_join(raw_schedule, scores, "game_id"), "raw-schedule")
    bounds = PeriodBounds.of(period)
    stamp = at(period.updated_at, cfg.time)
    _bronze(cfg, report, tx, scores, schedule, bounds, stamp, (), snapshot)
    report.enforce(cfg, *STRICT_BRONZE)
    return report


@_job
def build_facts(spark: SparkSession, cfg: Config, period: Period, weekly: bool, tx: Transaction) -> Report:
    """Bronze tables of one period to checked match facts."""
    keys = [snapshot_key(period.updated_at)] if weekly else None
    schedule = _read(tx, cfg, BRONZE_SCHEDULE, weekly, keys)
    scores = _read(tx, cfg, BRONZE_SCORES, weekly, keys)
    joined, repeated = guarded_facts(schedule, scores)
    stamp = at(period.updated_at, cfg.time)
    _, facts = together(
        lambda: _store(tx, cfg, repeated.withColumn(SNAPSHOT, stamp), REPEATED_IDS, weekly, period),
        lambda: _store(tx, cfg, joined, SILVER_FACTS, weekly, period),
    )
    tables = {"schedule": schedule, "scores": scores, "matches": facts}
    report = Report()
    checks = suites.match_facts(PeriodBounds.of(period), tables, cfg.time)
    report.note(cfg, "match_facts", validate(facts, checks), period if weekly else None)
    report.enforce(cfg, "match_facts")
    return report


@_job
def build_standings(spark: SparkSession, cfg: Config, period: Period, weekly: bool, tx: Transaction) -> Report:
    """Facts up to the period's end to checked standings.

    A weekly run carries on the totals of the snapshot before it. Snapshots after its own,
    whose totals include this week, are out of date then and computed again with it, so an old
    week may be run again.
    """
    report = Report()
    now = at(period.updated_at, cfg.time)
    if not weekly:
        table = standings(_read(tx, cfg, SILVER_FACTS, False), cfg.teams, as_of=period.updated_at, slices=cfg.rank_slices)
        table = tx.write(table, GOLD_STANDINGS)
        checks = suites.standings(cfg.teams, cfg.teams.count(), period.max_round)
        report.note(cfg, "standings", validate(table, checks), None)
        report.enforce(cfg, "standings")
        return report

    own = snapshot_key(period.updated_at)
    stored = list(tx.parts(_named(GOLD_STANDINGS, True)))
    before = [key for key in stored if key < own][-1:]
    wanted = [own, *(key for key in stored if key > own)]
    since = before[0] if before else ""
    new_facts = [key for key in tx.parts(_named(SILVER_FACTS, True)) if since < key <= wanted[-1]]
    facts = _read(tx, cfg, SILVER_FACTS, True, new_facts)
    opening = _read(tx, cfg, GOLD_STANDINGS, True, before) if before else None
    moments = [_moment(key) for key in wanted]
    table = standings_history(
        facts, cfg.teams, period.updated_at, moments[-1], slices=cfg.rank_slices, opening=opening
    )
    if len(wanted) > 1:
        table = table.filter(F.col(SNAPSHOT).isin([at(m, cfg.time) for m in moments]))
    table = tx.write_parts(table, _named(GOLD_STANDINGS, True), clear=wanted)

    history = table if opening is None else opening.unionByName(table.select(*opening.columns))
    states = form_states(
        history,
        cfg.form_matches,
        opening=_read(tx, cfg, FORM_STATES, True, before) if before else None,
        since=_moment(since) if before else None,
    )
    checks = suites.standings(cfg.teams, cfg.teams.count(), PeriodBounds.by_row().max_round)
    metrics = validate(_with_period(table, cfg), checks, (SNAPSHOT,))
    together(
        lambda: tx.write_parts(states, _named(FORM_STATES, True), clear=wanted),
        lambda: report.note(cfg, "standings", metrics, None, replace_all=False),
    )
    report.enforce(cfg, "standings")
    return report


def build_form(spark: SparkSession, cfg: Config, n: int = 5, k: int | None = 3) -> DataFrame:
    """Recent form of every stored snapshot, exported as sorted CSV.

    From the stored states where they hold enough matches, else from the whole history.
    """
    tx = Transaction(spark, cfg.base, cfg.fmt)
    if n <= cfg.form_matches and _named(FORM_STATES, True) in tx.tables:
        form = form_of_states(_read(tx, cfg, FORM_STATES, True), n, k)
    else:
        form = recent_form(read_history(spark, cfg), n, k)
    export_csv(form, f"{cfg.output}/{FORM_CSV}", [SNAPSHOT, "form_ranking"])
    return form


def read_layer(spark: SparkSession, cfg: Config, name: str, weekly: bool) -> DataFrame:
    """A published layer, such as ``SILVER_FACTS``; no rows where there is none."""
    return _read(Transaction(spark, cfg.base, cfg.fmt), cfg, name, weekly)


def read_history(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_layer(spark, cfg, GOLD_STANDINGS, True)


def read_standings(spark: SparkSession, cfg: Config) -> DataFrame:
    return read_layer(spark, cfg, GOLD_STANDINGS, False)


def store_layer(spark: SparkSession, cfg: Config, name: str, weekly: bool, df: DataFrame) -> None:
    """Publish a layer made elsewhere, such as a history to take form from."""
    with transaction(spark, cfg.base, cfg.fmt) as tx:
        if weekly:
            tx.write_parts(df, _named(name, True), replace_all=True)
        else:
            tx.write(df, name)


def export_standings(spark: SparkSession, cfg: Config, weekly: bool) -> str:
    """Gold standings, or their history, as CSV; returns the folder written."""
    if weekly:
        path = f"{cfg.output}/{HISTORY_CSV}"
        export_csv(read_history(spark, cfg), path, [SNAPSHOT, "ranking"])
    else:
        path = f"{cfg.output}/{FINAL_CSV}"
        export_csv(read_standings(spark, cfg), path, ["ranking"])
    return path


def export_table(spark: SparkSession, cfg: Config, name: str, file: str) -> None:
    """Any published layer, such as "gold/standings_hist", as CSV in the output folder.

    Histories are sorted by snapshot.
    """
    df = read_layer(spark, cfg, name.removesuffix(HISTORY), name.endswith(HISTORY))
    order = [c for c in (SNAPSHOT, "ranking", "game_id") if c in df.columns]
    export_csv(df, f"{cfg.output}/{file}", order)


def run_season(spark: SparkSession, cfg: Config) -> list[Report]:
    """The whole season in one slice, up to the CSV export; all layers appear together."""
    period = season_period(cfg.season)
    with transaction(spark, cfg.base, cfg.fmt) as tx:
        reports = [step(spark, cfg, period, False, tx=tx) for step in (ingest, build_facts, build_standings)]
    export_standings(spark, cfg, weekly=False)
    return reports


def run_week(spark: SparkSession, cfg: Config, week: int) -> list[Report]:
    """One weekly increment; running it again replaces that week. All layers appear together."""
    period = week_period(cfg.season, week)
    with transaction(spark, cfg.base, cfg.fmt) as tx:
        return [step(spark, cfg, period, True, tx=tx) for step in (ingest, build_facts, build_standings)]


@_job
def _backfill(spark: SparkSession, cfg: Config, weeks: int, tx: Transaction) -> Report:
    first, last = run_time(cfg.season, 1), run_time(cfg.season, weeks)
    report = Report()
    raw_scores, raw_schedule = _read_source(spark, cfg, report, None, tx)
    ingested = to_time("ingestion_time", cfg.time)
    unread = F.when(F.col(CORRUPT).isNotNull() & ingested.isNull(), at(last, cfg.time))
    week = F.when(F.col(WEEK).isNotNull(), week_end(F.col(WEEK), cfg.season, cfg.time))
    scores = raw_scores.filter((F.col(WEEK) < weeks) | F.col(WEEK).isNull())
    scores = scores.withColumn(SNAPSHOT, F.coalesce(week, unread)).drop(WEEK)
    scores = stage(scores.filter(F.col(SNAPSHOT).isNotNull()), "raw-scores")
    schedule = stage(attach(raw_schedule, scores, "game_id", [SNAPSHOT]), "raw-schedule")

    by = (SNAPSHOT,)
    bounds = PeriodBounds.by_row()
    metrics = _bronze(cfg, report, tx, scores, schedule, bounds, F.col(SNAPSHOT), by, None)
    _leave_out(cfg, report, tx, (BRONZE_SCORES, BRONZE_SCHEDULE), metrics)
    scores = _read(tx, cfg, BRONZE_SCORES, True)
    schedule = _read(tx, cfg, BRONZE_SCHEDULE, True)
    facts, repeated = guarded_facts(schedule, scores, ("game_id", SNAPSHOT))
    tx.write_parts(repeated, _named(REPEATED_IDS, True), replace_all=True)
    facts = tx.write_parts(facts, _named(SILVER_FACTS, True), replace_all=True)
    tables = {"schedule": schedule, "scores": scores, "matches": facts}
    checks = suites.match_facts(bounds, tables, cfg.time)
    metrics = report.note(cfg, "match_facts", validate(_with_period(facts, cfg), checks, by), None)
    # A week stopped by its facts would not have published its bronze tables either.
    _leave_out(cfg, report, tx, (BRONZE_SCORES, BRONZE_SCHEDULE, SILVER_FACTS), [metrics])
    facts = _read(tx, cfg, SILVER_FACTS, True)

    history = standings_history(facts, cfg.teams, first, last, slices=cfg.rank_slices)
    if report.left_out:
        history = history.filter(~F.col(SNAPSHOT).isin([at(m, cfg.time) for m in report.left_out]))
    history = tx.write_parts(history, _named(GOLD_STANDINGS, True), replace_all=True)
    checks = suites.standings(cfg.teams, cfg.teams.count(), bounds.max_round)
    metrics = report.note(cfg, "standings", validate(_with_period(history, cfg), checks, by), None)
    _leave_out(cfg, report, tx, (GOLD_STANDINGS,), [metrics])
    states = form_states(_read(tx, cfg, GOLD_STANDINGS, True), cfg.form_matches)
    tx.write_parts(states, _named(FORM_STATES, True), replace_all=True)
    return report


def run_backfill(spark: SparkSession, cfg: Config, weeks: int | None = None) -> Report:
    """All weekly increments at once; equal to ``run_week`` for each week in turn.

    The default number of weeks is one more than the season has, for results that
    arrive after its end. History tables are replaced as a whole. In strict mode a week
    with a broken check is left out, as a weekly run would have stopped, and all others
    are published; ``ValidationError`` names the broken checks afterwards.
    """
    weeks = cfg.season.weeks + 1 if weeks is None else weeks
    report = _backfill(spark, cfg, weeks)
    export_standings(spark, cfg, weekly=True)
    if report.left_out:
        raise ValidationError(report.failed(*[layer for layer in report.broken if layer not in SOFT]))
    return report


def _leave_out(cfg: Config, report: Report, tx: Transaction, names: tuple[str, ...], metrics: list[DataFrame]) -> None:
    """In strict mode, take snapshots that break a check out of the tables of this run."""
    if cfg.mode != "strict":
        return
    bad = reduce(DataFrame.unionByName, [failures(m).select(SNAPSHOT) for m in metrics]).distinct()
    # weeks, at most; as wall-clock time
    rows = bad.select(F.col(SNAPSHOT).cast("timestamp_ntz").alias(SNAPSHOT)).orderBy(SNAPSHOT).collect()
    found = [row[SNAPSHOT] for row in rows]
    report.left_out.extend(moment for moment in found if moment not in report.left_out)
    for name in names:
        tx.leave_out(_named(name, True), [snapshot_key(moment) for moment in found])


def _read_source(
    spark: SparkSession, cfg: Config, report: Report, period: Period | None, tx: Transaction
) -> tuple[DataFrame, DataFrame]:
    """Both raw tables, after new files have landed, with their malformed lines.

    A column that a file lacks is a broken check. Scores have their ingestion week.
    """
    frames = []
    week = week_index(to_time("ingestion_time", cfg.time), cfg.season, cfg.time)
    for layer, file, columns in (
        ("raw_scores_schema", SCORES_FILE, RAW_SCORES),
        ("raw_schedule_schema", SCHEDULE_FILE, RAW_SCHEDULE),
    ):
        by = week if file == SCORES_FILE else None
        df = land(spark, tx, RAW_TABLES[file], f"{cfg.source}/{file}", columns, by)
        report.note(cfg, layer, validate(df, [HasSchema(layout(columns))]), period)
        report.enforce(cfg, layer)
        absent = {c: F.lit(None).cast("string") for c in column_names(columns) if c not in df.columns}
        frames.append(df.withColumns(absent) if absent else df)
    return frames[0], frames[1]


def _bronze(cfg, report, tx, scores, schedule, bounds, stamp, by, period) -> list[DataFrame]:
    """Soft checks, cleaning and reconciliation of a staged slice, written as bronze tables.

    All strict checks are computed and stored, the row counts as a table of their own too;
    the caller decides on them. Returns their metrics.
    """
    weekly = bool(by) or period is not None
    good, tasks = [], []

    def write(df: DataFrame, name: str) -> Callable:
        return lambda: _store(tx, cfg, df, name, weekly, period, replace_all=bool(by))

    def note(layer: str, df: DataFrame, checks: list) -> Callable:
        return lambda: report.note(cfg, layer, validate(_bounded(df, cfg, by), checks, by), period)

    wholes = [df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) for df in (scores, schedule)]
    # Distinct rows are computed once: the rejected rows and both bronze tables read them.
    cleaned = together(
        lambda: clean_scores(wholes[0], stamp, cfg.time, keep=lambda rows: stage(rows, "whole-scores")),
        lambda: clean_schedule(wholes[1], stamp, cfg.time, keep=lambda rows: stage(rows, "whole-schedule")),
    )
    for layer, df, suite, whole, (typed, bad), name in (
        ("raw_scores", scores, suites.raw_scores, wholes[0], cleaned[0], REJECTED_SCORES),
        ("raw_schedule", schedule, suites.raw_schedule, wholes[1], cleaned[1], REJECTED_SCHEDULE),
    ):
        malformed = df.filter(F.col(CORRUPT).isNotNull())
        broken = malformed.drop(CORRUPT).withColumn(REASONS, F.array(F.lit(MALFORMED)))
        bad = bad.withColumn(SNAPSHOT, stamp).unionByName(broken.withColumn(SNAPSHOT, stamp))
        tasks += [write(bad, name), note(layer, whole, suite(bounds))]
        good.append(typed)
    kept = reconcile(*good, ["game_id", *by])
    tasks += [write(df, name) for df, name in zip(kept, (BRONZE_SCORES, BRONZE_SCHEDULE))]
    *_, scores, schedule = together(*tasks)
    for layer, name in (("raw_scores", REJECTED_SCORES), ("raw_schedule", REJECTED_SCHEDULE)):
        report.rejected[layer] = tx.folders[_named(name, weekly)]
    metrics = together(
        note("bronze_scores", scores, [*suites.bronze_scores(bounds, cfg.time), SameCount(schedule)]),
        note("bronze_schedule", schedule, suites.bronze_schedule(bounds, cfg.time)),
    )
    counts = metrics[0].filter(F.col("check") == SameCount.name)
    report.note(cfg, "row_counts", counts.drop(SNAPSHOT) if period is not None else counts, period)
    return metrics


def _bounded(df: DataFrame, cfg: Config, by: tuple) -> DataFrame:
    return _with_period(df, cfg) if by else df


def _with_period(df: DataFrame, cfg: Config) -> DataFrame:
    """Add the limits of the week each row's snapshot closes."""
    week = week_index(F.col(SNAPSHOT), cfg.season, cfg.time)
    return df.select(*df.columns, *week_columns(week, cfg.season, cfg.time)[:-1])


_STATE = "team string, updated_at {time}, recent array<struct<result: string, pts: int, gf: bigint, ga: bigint>>"


def _schema(cfg: Config, name: str, weekly: bool) -> StructType:
    columns, extra = {
        BRONZE_SCORES: (SCORES, "ingestion_date date, updated_at {time}"),
        BRONZE_SCHEDULE: (SCHEDULE, "updated_at {time}"),
        SILVER_FACTS: (MATCH_FACTS, "updated_at {time}"),
        REPEATED_IDS: ("game_id string, schedule_rows bigint, score_rows bigint", "updated_at {time}"),
        GOLD_STANDINGS: (STANDINGS, "updated_at {time}" if weekly else ""),
        FORM_STATES: (_STATE, ""),
        REJECTED_SCORES: (f"{RAW_SCORES}, {REASONS} array<string>", "updated_at {time}"),
        REJECTED_SCHEDULE: (f"{RAW_SCHEDULE}, {REASONS} array<string>", "updated_at {time}"),
    }[name]
    return layout(columns, cfg.time, extra)


def _read(tx: Transaction, cfg: Config, name: str, weekly: bool, keys: list[str] | None = None) -> DataFrame:
    return tx.read(_named(name, weekly), _schema(cfg, name, weekly), keys)


def _moment(key: str) -> datetime:
    return datetime.fromisoformat(key.split("=", 1)[1].replace("%3A", ":"))


def _store(
    tx: Transaction, cfg: Config, df: DataFrame, name: str, weekly: bool, period: Period | None, replace_all: bool = False
) -> DataFrame:
    """Write a layer; a weekly run replaces its own snapshot, also by nothing."""
    if not weekly:
        return tx.write(df, name)
    clear = [snapshot_key(period.updated_at)] if period is not None else []
    return tx.write_parts(df, _named(name, True), clear=clear, replace_all=replace_all)
