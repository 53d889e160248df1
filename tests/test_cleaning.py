"""The dirty cases a source file may hold."""

from datetime import date, datetime

from matchboard.functions.periods import DEFAULT_SEASON, week_period
from matchboard.operators.cleaning import clean_schedule, clean_scores, slice_period
from matchboard.schemas import RAW_SCHEDULE, RAW_SCORES

STAMP = datetime(2025, 8, 25, 8)
DAY = "2025-08-20 10:00:00"


def test_clean_scores(spark, rows):
    raw = spark.createDataFrame(
        [
            ("1", "3.0", "3.7", DAY),
            ("1", "3.0", "3.7", DAY),
            ("2", "1", "1", DAY),
            ("2", "1", "2", DAY),
            ("3", None, "1", DAY),
            ("4", "1", "1", None),
            ("5", "x", "1", DAY),
            ("6", "-1", "1", DAY),
            ("7", "1", "y", "no time"),
            ("8", "NaN", "99999999999", DAY),
        ],
        RAW_SCORES,
    )
    clean, rejected = clean_scores(raw, STAMP)
    assert rows(clean, "game_id", "home_goals", "away_goals") == [
        ("1", 3, 3), ("2", 1, 1), ("2", 1, 2), ("6", -1, 1),
    ]
    assert dict(clean.dtypes)["home_goals"] == "int"
    assert {(r["updated_at"], r["ingestion_date"]) for r in clean.collect()} == {
        (STAMP, date(2025, 8, 20))
    }
    assert rows(rejected, "game_id", "rejected_columns") == [
        ("5", ["home_goals"]),
        ("7", ["away_goals", "ingestion_time"]),
        ("8", ["home_goals", "away_goals"]),
    ]


def test_clean_schedule(spark, rows):
    raw = spark.createDataFrame(
        [
            ("1", "1.0", "A", "B", DAY),
            ("1", "1.0", "A", "B", DAY),
            ("2", "first", "A", "B", DAY),
            ("3", "2", None, "B", DAY),
            ("4", "2", "C", "D", "soon"),
        ],
        RAW_SCHEDULE,
    )
    clean, rejected = clean_schedule(raw, STAMP)
    assert rows(clean, "game_id", "round", "updated_at") == [("1", 1, STAMP)]
    assert rows(rejected, "game_id", "rejected_columns") == [
        ("2", ["round"]), ("4", ["game_start_time"]),
    ]


def test_slice_is_half_open_and_drops_null_times(spark, rows):
    period = week_period(DEFAULT_SEASON, 0)
    scores = spark.createDataFrame(
        [
            ("start", "1", "1", "2025-08-18 08:00:00"),
            ("inside", "1", "1", "2025-08-18 08:00:01"),
            ("end", "1", "1", "2025-08-25 08:00:00"),
            ("after", "1", "1", "2025-08-25 08:00:01"),
            ("null", "1", "1", None),
            ("text", "1", "1", "later"),
        ],
        RAW_SCORES,
    )
    schedule = spark.createDataFrame(
        [(g, "1", "A", "B", DAY) for g in ("start", "end", "end", "inside", "unplayed")],
        RAW_SCHEDULE,
    )
    kept, fixtures = slice_period(scores, schedule, period)
    assert rows(kept, "game_id") == [("end",), ("inside",)]
    assert rows(fixtures, "game_id") == [("end",), ("end",), ("inside",)]


def test_distinct_rows_are_kept_once(spark):
    """Clean and rejected rows are taken from what ``keep`` computed, and are the same as without."""
    columns = "game_id string, home_goals string, away_goals string, ingestion_time string"
    rows = [("1", "2", "1", "2024-01-01 10:00:00")] * 2 + [("2", "x", "1", "2024-01-01 10:00:00"), (None, "1", "1", "no")]
    raw = spark.createDataFrame(rows, columns)
    kept = []

    def keep(df):
        kept.append(df)
        return spark.createDataFrame(df.collect(), df.schema)

    found = clean_scores(raw, datetime(2024, 1, 7), keep=keep)
    plain = clean_scores(raw, datetime(2024, 1, 7))
    assert [sorted(df.collect()) for df in found] == [sorted(df.collect()) for df in plain]
    assert len(kept) == 1 and kept[0].count() == 2
    for df in found:
        assert "LogicalRDD" in df._jdf.queryExecution().logical().toString()
        assert "Deduplicate" not in df._jdf.queryExecution().logical().toString()
