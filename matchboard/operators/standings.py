"""Ranked standings, for one snapshot or for every week at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchboard.functions.casts import at, time_type
from matchboard.operators.keys import anti_join
from matchboard.operators.ranking import rank_rows

WEEK_MICROSECONDS = 7 * 24 * 3600 * 1_000_000
# Measures of a table, its rank keys, and the outcomes of a match.
MEASURES = ("wins", "draws", "losses", "goals_for", "goals_against")
RANK_ORDER = (
    ("points", "desc"),
    ("goal_difference", "desc"),
    ("goals_for", "desc"),
    ("team", "asc"),
)


@dataclass(frozen=True)
class Points:
    win: int = 3
    draw: int = 1
    loss: int = 0

    def total(self) -> Column:
        return F.col("wins") * self.win + F.col("draws") * self.draw + F.col("losses") * self.loss


def team_results(facts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Two rows per match, one for each side, out of a single scan."""
    sides = F.array(
        _side("home_team", "home_win", "away_win", "home_goals", "away_goals"),
        _side("away_team", "away_win", "home_win", "away_goals", "home_goals"),
    )
    return facts.select(*keep, F.inline(sides))


def standings(
    facts: DataFrame,
    teams: DataFrame,
    group_cols: Sequence[str] = (),
    as_of: datetime | None = None,
    points: Points = Points(),
    slices: int = 1,
) -> DataFrame:
    """Standings over the facts up to ``as_of``, with a zero row for idle teams.

    ``teams`` holds ``team`` and the group columns. Its rows join the sums as zero
    results, so no team is looked up or missed. Teams it does not list are ranked as
    well, but the job checks refuse them. ``slices`` splits the ranking of one group;
    see ``rank_rows``.
    """
    if as_of is not None:
        kind = time_type(facts, "updated_at")
        facts = facts.filter(F.col("updated_at") <= at(as_of, kind))
    rows = team_results(facts, group_cols).unionByName(_idle(teams, group_cols))
    totals = _scored(rows.groupBy(*group_cols, "team").agg(*_sums()), points)
    ranked = rank_rows(totals, group_cols, RANK_ORDER, slices=slices)
    return ranked.select(*group_cols, "ranking", "team", *MEASURES, "points")


def absent_teams(table: DataFrame, teams: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Teams of the dimension that have no row in ``table``."""
    keys = [*group_cols, "team"]
    return anti_join(teams.select(*keys), table, keys)


def standings_history(
    facts: DataFrame,
    teams: DataFrame,
    first: datetime,
    last: datetime,
    group_cols: Sequence[str] = (),
    points: Points = Points(),
    slices: int = 1,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Standings of every weekly snapshot from ``first`` to ``last`` in one job.

    ``opening`` are the standings of an earlier snapshot; ``facts`` are then only those after
    it, and its totals are carried on. Totals of teams that have not played are not, as the
    team may have left the list.

    A match whose ``updated_at`` is off the weekly grid of ``first`` counts from the
    next snapshot on. Matches are summed per team and week, running sums give the totals,
    and the weeks in which a team does not play are filled after the running sum, so only
    weeks with matches are shuffled.
    """
    kind = time_type(facts, "updated_at")
    begin, end = at(first, kind), at(last, kind)
    entity = [*group_cols, "team"]

    # Earlier matches count from the first snapshot on.
    late = F.expr("timestampdiff(MICROSECOND, _begin, updated_at)") / F.lit(WEEK_MICROSECONDS)
    snapped = begin + F.make_dt_interval(days=(F.ceil(late) * 7).cast("int"))
    played = facts.withColumn("_begin", begin).withColumn("updated_at", F.greatest(snapped, begin))
    played = played.drop("_begin").filter(F.col("updated_at") <= end)
    idle = _idle(teams, group_cols).withColumn("updated_at", begin)
    rows = team_results(played, [*group_cols, "updated_at"]).unionByName(idle)
    if opening is not None:
        active = opening.filter(F.col("wins") + F.col("draws") + F.col("losses") > 0)
        rows = rows.unionByName(active.select(*entity, *MEASURES, begin.alias("updated_at")))
    weekly = rows.groupBy(*entity, "updated_at").agg(*_sums())

    timeline = Window.partitionBy(*entity).orderBy("updated_at")
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week = F.expr("interval '7' day")
    following = F.coalesce(F.lead("updated_at").over(timeline) - week, end)
    changes = weekly.select(
        *entity,
        "updated_at",
        *[F.sum(m).over(so_far).alias(m) for m in MEASURES],
        following.alias("valid_to"),
    )
    snapshots = changes.withColumn(
        "updated_at", F.explode(F.sequence("updated_at", "valid_to", week))
    ).drop("valid_to")
    totals = _scored(snapshots, points)
    snapshot = [*group_cols, "updated_at"]
    ranked = rank_rows(totals, snapshot, RANK_ORDER, slices=slices)
    return ranked.select(*group_cols, "ranking", "team", *MEASURES, "points", "updated_at")


def _side(team: str, won: str, lost: str, scored: str, conceded: str) -> Column:
    result = F.col("match_outcome")
    flag = lambda value: F.when(result == value, 1).otherwise(0)
    return F.struct(
        F.col(team).alias("team"),
        flag(won).alias("wins"),
        flag("draw").alias("draws"),
        flag(lost).alias("losses"),
        F.col(scored).alias("goals_for"),
        F.col(conceded).alias("goals_against"),
    )


def _idle(teams: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    return teams.select(*group_cols, "team", *[F.lit(0).alias(m) for m in MEASURES])


def _sums() -> list[Column]:
    return [F.sum(m).alias(m) for m in MEASURES]


def _scored(totals: DataFrame, points: Points) -> DataFrame:
    return totals.withColumns(
        {
            "points": points.total(),
            "goal_difference": F.col("goals_for") - F.col("goals_against"),
        }
    )
