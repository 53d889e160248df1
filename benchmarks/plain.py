"""The same results in the plain way, to test and time the library against."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchboard.functions.casts import at, time_type
from matchboard.operators.form import matches_from_deltas, weekly_deltas
from matchboard.operators.standings import standings
from matchboard.quality import validate


def last_matches_by_range_join(history: DataFrame, n: int = 5) -> DataFrame:
    """Join every snapshot with all earlier matches of the team, then keep ``n``."""
    matches = matches_from_deltas(weekly_deltas(history)).alias("m")
    snapshots = history.select("team", "updated_at").alias("s")
    earlier = (F.col("m.team") == F.col("s.team")) & (
        F.col("m.updated_at") <= F.col("s.updated_at")
    )
    latest = Window.partitionBy("m.team", "s.updated_at").orderBy(
        F.desc("m.updated_at"), F.desc("m.pts")
    )
    numbered = matches.join(snapshots, earlier).withColumn("rn", F.row_number().over(latest))
    return numbered.filter(F.col("rn") <= n).select(
        "m.team",
        "s.updated_at",
        "m.result",
        "m.pts",
        F.col("m.gf").alias("gf_per_match"),
        F.col("m.ga").alias("ga_per_match"),
        "rn",
    )


def history_by_repetition(
    facts: DataFrame, teams: DataFrame, snapshots: Sequence[datetime]
) -> DataFrame:
    """One standings run per snapshot."""
    kind = time_type(facts, "updated_at")
    runs = [
        standings(facts, teams, as_of=moment).withColumn("updated_at", at(moment, kind))
        for moment in snapshots
    ]
    return reduce(DataFrame.unionByName, runs)


def validate_one_by_one(df: DataFrame, checks: Sequence) -> list:
    """One action per check."""
    return [row for check in checks for row in validate(df, [check]).collect()]
