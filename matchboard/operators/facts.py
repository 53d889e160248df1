"""One row per played match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.operators.keys import anti_join
from matchboard.sources.staging import stage


def outcome(home: str | Column = "home_goals", away: str | Column = "away_goals") -> Column:
    """Result seen from the home side; unknown goals count as a draw."""
    home = F.col(home) if isinstance(home, str) else home
    away = F.col(away) if isinstance(away, str) else away
    return F.when(home > away, "home_win").when(home < away, "away_win").otherwise("draw")


def repeated_ids(
    schedule: DataFrame, scores: DataFrame, keys: Sequence[str] = ("game_id",)
) -> DataFrame:
    """Keys met more than once in both frames, with their counts.

    Joined, such a key would give the product of its rows. Only keys that repeat on their own
    side, counted before the shuffle, meet here.
    """
    sides = []
    for df, name in ((schedule, "schedule_rows"), (scores, "score_rows")):
        counts = df.groupBy(*keys).agg(F.count("*").alias(name))
        sides.append(counts.filter(F.col(name) > 1))
    return sides[0].join(sides[1], list(keys))


def guarded_facts(
    schedule: DataFrame, scores: DataFrame, keys: Sequence[str] = ("game_id",)
) -> tuple[DataFrame, DataFrame]:
    """Match facts, and the keys left out of them because they repeat on both sides.

    An id that repeats on one side gives a row for each of its rows, as a join does.
    """
    repeated = stage(repeated_ids(schedule, scores, keys), "repeated")
    left, right = (anti_join(df, repeated, keys) for df in (schedule, scores))
    return match_facts(left, right, keys), repeated


def match_facts(
    schedule: DataFrame,
    scores: DataFrame,
    keys: Sequence[str] = ("game_id",),
    extra: Sequence[str] = ("updated_at",),
) -> DataFrame:
    """Join schedule and scores and derive date, difference and outcome.

    ``extra`` names columns carried along (snapshot, league, season); those that are
    not part of the key come from ``scores``.
    """
    fixtures = schedule.drop(*[c for c in extra if c not in keys])
    fixtures = fixtures.withColumnRenamed("game_start_time", "match_time")
    return fixtures.join(scores, list(keys), "inner").select(
        "game_id",
        "round",
        "home_team",
        "away_team",
        "match_time",
        F.to_date("match_time").alias("match_date"),
        "home_goals",
        "away_goals",
        "ingestion_time",
        "ingestion_date",
        (F.col("home_goals") - F.col("away_goals")).alias("goal_difference"),
        outcome().alias("match_outcome"),
        *extra,
    )
