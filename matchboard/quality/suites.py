"""The check suites of each layer. Periods give the bounds; see ``PeriodBounds``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.functions.periods import Period
from matchboard.quality.checks import (
    Between,
    Differ,
    HasSchema,
    NotNull,
    OncePer,
    OneOf,
    SameIds,
    TimeBetween,
    Unique,
)
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


@dataclass(frozen=True)
class PeriodBounds:
    """Limits of one period, or columns of that name when many periods are mixed."""

    start: datetime | Column
    end: datetime | Column
    min_round: int | Column
    max_round: int | Column
    updated_at: datetime | Column

    @classmethod
    def of(cls, period: Period) -> PeriodBounds:
        return cls(
            period.start, period.end, period.min_round, period.max_round, period.updated_at
        )

    @classmethod
    def by_row(cls) -> PeriodBounds:
        names = ("period_start", "period_end", "min_round", "max_round", "updated_at")
        return cls(*[F.col(name) for name in names])


def raw_scores(bounds: PeriodBounds) -> list:
    return [HasSchema(layout(RAW_SCORES)), *_scores(bounds, RAW_SCORES)]


def raw_schedule(bounds: PeriodBounds) -> list:
    return [HasSchema(layout(RAW_SCHEDULE)), *_schedule(bounds, RAW_SCHEDULE)]


def bronze_scores(bounds: PeriodBounds, time: str = "timestamp") -> list:
    stamp = TimeBetween("updated_at", bounds.updated_at, bounds.updated_at)
    extra = "updated_at {time}, ingestion_date date"
    return [HasSchema(layout(SCORES, time)), *_scores(bounds, f"{SCORES}, {extra}"), stamp]


def bronze_schedule(bounds: PeriodBounds, time: str = "timestamp") -> list:
    stamp = TimeBetween("updated_at", bounds.updated_at, bounds.updated_at)
    columns = f"{SCHEDULE}, updated_at {{time}}"
    return [HasSchema(layout(SCHEDULE, time)), *_schedule(bounds, columns), stamp]


def match_facts(
    bounds: PeriodBounds, tables: Mapping[str, DataFrame], time: str = "timestamp"
) -> list:
    """``tables`` are the frames whose ids must agree: schedule, scores, matches."""
    return [
        HasSchema(layout(MATCH_FACTS, time)),
        Differ("home_team", "away_team"),
        Unique("game_id"),
        *_not_null(f"{MATCH_FACTS}, updated_at {{time}}"),
        *_once_per_round(),
        Between("round", bounds.min_round, bounds.max_round),
        Between("home_goals", 0),
        Between("away_goals", 0),
        TimeBetween("match_time", bounds.start, bounds.end),
        TimeBetween("ingestion_time", bounds.start, bounds.end),
        TimeBetween("updated_at", bounds.updated_at, bounds.updated_at),
        SameIds(tables),
    ]


def standings(teams: DataFrame, team_count: int, max_round: int | Column) -> list:
    """``team_count`` bounds the ranking, ``max_round`` the results of a team."""
    return [
        HasSchema(layout(STANDINGS)),
        Unique("team"),
        *_not_null(STANDINGS),
        Between("ranking", 1, team_count),
        Between("wins", 0, max_round),
        Between("draws", 0, max_round),
        Between("losses", 0, max_round),
        OneOf("team", teams.select("team")),
    ]


def _scores(bounds: PeriodBounds, columns: str) -> list:
    return [
        Unique("game_id"),
        *_not_null(columns),
        Between("home_goals", 0),
        Between("away_goals", 0),
        TimeBetween("ingestion_time", bounds.start, bounds.end),
    ]


def _schedule(bounds: PeriodBounds, columns: str) -> list:
    return [
        Differ("home_team", "away_team"),
        Unique("game_id"),
        *_not_null(columns),
        *_once_per_round(),
        Between("round", bounds.min_round, bounds.max_round),
        TimeBetween("game_start_time", bounds.start, bounds.end),
    ]


def _not_null(columns: str) -> list:
    return [NotNull(name) for name in column_names(columns)]


def _once_per_round() -> list:
    return [OncePer(("round",), "home_team"), OncePer(("round",), "away_team")]
