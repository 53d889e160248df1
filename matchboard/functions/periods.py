"""Weekly periods of a season, as Python values and as columns."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchboard.functions.casts import at

WEEK = timedelta(weeks=1)


@dataclass(frozen=True)
class Season:
    """First run time, end and number of rounds."""

    start: datetime
    end: datetime
    rounds: int

    @property
    def weeks(self) -> int:
        return -((self.start - self.end) // WEEK)


@dataclass(frozen=True)
class Period:
    """A half-open slice ``(start, end]`` and the rounds allowed in it."""

    start: datetime
    end: datetime
    min_round: int
    max_round: int
    updated_at: datetime


# The default season and its teams.
DEFAULT_SEASON = Season(datetime(2025, 8, 18, 8, 0), datetime(2026, 5, 18, 8, 0), 38)
DEFAULT_TEAMS = (
    "Chelsea", "Arsenal", "Liverpool", "Manchester City", "Aston Villa", "Nottingham",
    "Manchester Utd", "Newcastle", "Tottenham Hotspur", "Brighton", "Crystal Palace",
    "Everton", "West Ham", "Sunderland", "Wolves", "Fulham", "Burnley", "Leeds United",
    "Brentford", "Bournemouth",
)


def run_time(season: Season, week: int) -> datetime:
    """Run time of week ``week`` (0-based)."""
    if week < 0:
        raise ValueError(f"week must not be negative: {week}")
    return season.start + week * WEEK


def week_period(season: Season, week: int) -> Period:
    """One week; its rounds are ``week`` and ``week + 1``, but only 1 in week 0."""
    end = run_time(season, week + 1)
    return Period(run_time(season, week), end, max(week, 1), week + 1, end)


def season_period(season: Season) -> Period:
    """The whole season in one slice, stamped with its end."""
    return Period(season.start, season.end, 1, season.rounds, season.end)


def week_index(moment: Column, season: Season, time: str = "timestamp") -> Column:
    """0-based week of a moment under ``(start, end]``; null at or before the start."""
    anchor = at(season.start, time)
    step = F.expr("interval '0.000001' second")
    elapsed = moment - anchor - step
    # The interval division has no function of its own in the DataFrame API.
    weeks = F.call_function("div", elapsed, F.expr("interval '7' day"))
    return F.when(moment > anchor, weeks)


def week_end(week: Column, season: Season, time: str = "timestamp") -> Column:
    """Snapshot time of a 0-based week."""
    days = ((week + 1) * 7).cast("int")
    return at(season.start, time) + F.make_dt_interval(days)


def calendar(
    spark: SparkSession, season: Season, weeks: int | None = None, time: str = "timestamp"
) -> DataFrame:
    """One row per week: bounds, allowed rounds and snapshot time."""
    frame = spark.range(season.weeks if weeks is None else weeks)
    return frame.select(F.col("id").alias("week"), *week_columns(F.col("id"), season, time))


def week_columns(week: Column, season: Season, time: str = "timestamp") -> list[Column]:
    """The period of a week index as columns."""
    return [
        week_end(week - 1, season, time).alias("period_start"),
        week_end(week, season, time).alias("period_end"),
        F.greatest(week, F.lit(1)).cast("int").alias("min_round"),
        (week + 1).cast("int").alias("max_round"),
        week_end(week, season, time).alias("updated_at"),
    ]
