from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchboard.functions.periods import (
    DEFAULT_SEASON,
    DEFAULT_TEAMS,
    Season,
    calendar,
    run_time,
    season_period,
    week_end,
    week_index,
    week_period,
)


def test_season_constants():
    assert DEFAULT_SEASON.weeks == 39
    assert len(set(DEFAULT_TEAMS)) == 20


def test_run_time():
    assert run_time(DEFAULT_SEASON, 0) == datetime(2025, 8, 18, 8)
    assert run_time(DEFAULT_SEASON, 39) == datetime(2026, 5, 18, 8)
    with pytest.raises(ValueError):
        run_time(DEFAULT_SEASON, -1)


def test_week_period_rounds():
    first, third = week_period(DEFAULT_SEASON, 0), week_period(DEFAULT_SEASON, 2)
    assert (first.min_round, first.max_round) == (1, 1)
    assert (third.min_round, third.max_round) == (2, 3)
    assert third.start == datetime(2025, 9, 1, 8)
    assert third.end == third.updated_at == datetime(2025, 9, 8, 8)


def test_season_period():
    whole = season_period(DEFAULT_SEASON)
    assert (whole.start, whole.end) == (DEFAULT_SEASON.start, DEFAULT_SEASON.end)
    assert (whole.min_round, whole.max_round, whole.updated_at) == (1, 38, whole.end)


def test_weeks_round_up():
    start = datetime(2025, 1, 6)
    assert Season(start, start + timedelta(days=8), 2).weeks == 2


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_week_index_is_open_at_the_start(spark, kind):
    moments = [
        ("2025-08-18 08:00:00", None),
        ("2025-08-18 07:00:00", None),
        ("2025-08-18 08:00:00.000001", 0),
        ("2025-08-25 08:00:00", 0),
        ("2025-08-25 08:00:00.000001", 1),
        ("2026-05-18 08:00:00", 38),
        (None, None),
    ]
    df = spark.createDataFrame(moments, "text string, expected bigint")
    week = week_index(F.col("text").cast(kind), DEFAULT_SEASON, kind)
    out = df.select("text", "expected", week.alias("week"), week_end(week, DEFAULT_SEASON, kind))
    assert dict(out.dtypes)["week"] == "bigint"
    for row in out.collect():
        assert row["week"] == row["expected"], row


def test_calendar_equals_single_periods(spark):
    frame = calendar(spark, DEFAULT_SEASON, weeks=40, time="timestamp_ntz").orderBy("week")
    assert frame.count() == 40
    for row in frame.collect():
        period = week_period(DEFAULT_SEASON, row["week"])
        assert tuple(row)[1:] == (
            period.start, period.end, period.min_round, period.max_round, period.updated_at,
        )
