"""Table layouts, raw to gold.

Fixed values: column names and types of the stored tables.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW_SCORES = "game_id string, home_goals string, away_goals string, ingestion_time string"
RAW_SCHEDULE = (
    "game_id string, round string, home_team string, away_team string, game_start_time string"
)
SCORES = "game_id string, home_goals int, away_goals int, ingestion_time {time}"
SCHEDULE = (
    "game_id string, round int, home_team string, away_team string, game_start_time {time}"
)
MATCH_FACTS = (
    "game_id string, round int, home_team string, away_team string, match_time {time}, "
    "match_date date, home_goals int, away_goals int, ingestion_time {time}, "
    "ingestion_date date, goal_difference int, match_outcome string"
)
STANDINGS = (
    "ranking int, team string, wins bigint, draws bigint, losses bigint, "
    "goals_for bigint, goals_against bigint, points bigint"
)


def layout(ddl: str, time: str = "timestamp", extra: str = "") -> StructType:
    """Schema of a DDL string above, with ``time`` as its timestamp type."""
    text = ddl.format(time=time)
    if extra:
        text = f"{text}, {extra.format(time=time)}"
    return StructType.fromDDL(text)


def column_names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]
