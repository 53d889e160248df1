"""Raw text rows to typed rows, with rejected rows kept apart."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchboard.functions.casts import at, time_type, to_int, to_time
from matchboard.functions.periods import Period
from matchboard.operators.keys import semi_join

REASONS = "rejected_columns"
Keep = Callable[[DataFrame], DataFrame]  # such as ``sources.staging.stage``


def in_period(scores: DataFrame, period: Period) -> DataFrame:
    """Scores ingested in ``(start, end]``; an unreadable time is in no period."""
    kind = time_type(scores, "ingestion_time")
    ingested = to_time("ingestion_time", kind)
    return scores.filter((ingested > at(period.start, kind)) & (ingested <= at(period.end, kind)))


def slice_period(
    scores: DataFrame, schedule: DataFrame, period: Period
) -> tuple[DataFrame, DataFrame]:
    """Scores of a period and the schedule rows they belong to."""
    kept = in_period(scores, period)
    return kept, semi_join(schedule, kept, "game_id")


def clean_scores(
    raw: DataFrame, updated_at: datetime | Column, time: str = "timestamp", keep: Keep | None = None
) -> tuple[DataFrame, DataFrame]:
    """Typed scores and the rows that would not cast; ``keep`` computes what both are taken from once."""
    casts = {
        "home_goals": to_int("home_goals"),
        "away_goals": to_int("away_goals"),
        "ingestion_time": to_time("ingestion_time", time),
    }
    clean, rejected = _typed(raw, casts, keep)
    stamped = clean.withColumn("updated_at", at(updated_at, time))
    return stamped.withColumn("ingestion_date", F.to_date("ingestion_time")), rejected


def clean_schedule(
    raw: DataFrame, updated_at: datetime | Column, time: str = "timestamp", keep: Keep | None = None
) -> tuple[DataFrame, DataFrame]:
    """Typed schedule and the rows that would not cast; ``keep`` as for scores."""
    casts = {
        "round": to_int("round"),
        "game_start_time": to_time("game_start_time", time),
    }
    clean, rejected = _typed(raw, casts, keep)
    return clean.withColumn("updated_at", at(updated_at, time)), rejected


def _typed(raw: DataFrame, casts: dict[str, Column], keep: Keep | None) -> tuple[DataFrame, DataFrame]:
    # Copies go first, rows with a null after them; what is null after the casts
    # was text of the wrong form.
    whole = raw.dropDuplicates().na.drop("any")
    if keep is not None:
        whole = keep(whole)
    bad = F.array_compact(F.array(*[F.when(v.isNull(), F.lit(n)) for n, v in casts.items()]))
    clean = whole.filter(F.size(bad) == 0).withColumns(casts)
    rejected = whole.withColumn(REASONS, bad).filter(F.size(REASONS) > 0)
    return clean, rejected
