from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from matchboard.functions.periods import week_end, week_index, DEFAULT_SEASON as SEASON
from matchboard.operators.facts import match_facts
from matchboard.operators.standings import (
    Points,
    absent_teams,
    standings,
    standings_history,
    team_results,
)
from matchboard.schemas import MATCH_FACTS, SCHEDULE, SCORES, STANDINGS, layout

WEEK = timedelta(weeks=1)
TEAMS = ["A", "B", "C", "D"]


def moment(week):
    return SEASON.start + (week + 1) * WEEK


@pytest.fixture(scope="module")
def teams(spark):
    return spark.createDataFrame([(t,) for t in TEAMS], "team string")


def facts_of(spark, matches):
    """Facts from (week, home, away, home goals, away goals)."""
    data = [
        (str(i), moment(w), h, a, hg, ag) for i, (w, h, a, hg, ag) in enumerate(matches)
    ]
    df = spark.createDataFrame(
        data,
        "game_id string, updated_at timestamp, home_team string, away_team string, "
        "home_goals int, away_goals int",
    )
    from matchboard.operators.facts import outcome

    return df.withColumn("match_outcome", outcome())


def expected(matches, teams=TEAMS):
    """The table by a plain loop."""
    table = defaultdict(lambda: [0] * 5)
    for team in teams:
        table[team]
    for _, home, away, hg, ag in matches:
        for team, ours, theirs in ((home, hg, ag), (away, ag, hg)):
            row = table[team]
            row[0 if ours > theirs else 1 if ours == theirs else 2] += 1
            row[3] += ours
            row[4] += theirs
    order = sorted(
        table.items(),
        key=lambda t: (-(3 * t[1][0] + t[1][1]), -(t[1][3] - t[1][4]), -t[1][3], t[0]),
    )
    return [
        (i, team, *row, 3 * row[0] + row[1]) for i, (team, row) in enumerate(order, start=1)
    ]


def test_match_facts(spark):
    schedule = spark.createDataFrame(
        [("1", 1, "A", "B", datetime(2025, 8, 19, 20)), ("2", 1, "C", "D", None)],
        layout(SCHEDULE),
    )
    scores = spark.createDataFrame(
        [
            ("1", 2, 0, datetime(2025, 8, 20), moment(0), date(2025, 8, 20)),
            ("2", None, 1, None, moment(0), None),
            ("9", 1, 1, None, moment(0), None),
        ],
        layout(SCORES, extra="updated_at timestamp, ingestion_date date"),
    )
    facts = match_facts(schedule, scores)
    assert facts.columns == [*layout(MATCH_FACTS).names, "updated_at"]
    first, second = facts.orderBy("game_id").collect()
    assert (first["match_date"], first["goal_difference"], first["match_outcome"]) == (
        date(2025, 8, 19), 2, "home_win",
    )
    # Unknown goals are a draw; ids of one side only are gone.
    assert (second["goal_difference"], second["match_outcome"]) == (None, "draw")


def test_outcome_and_points(spark, teams):
    matches = [(0, "A", "B", 2, 0), (0, "C", "A", 1, 1), (1, "B", "A", 0, 1)]
    table = standings(facts_of(spark, matches), teams)
    assert table.dtypes == [(f.name, f.dataType.simpleString()) for f in layout(STANDINGS)]
    assert [tuple(r) for r in table.orderBy("ranking").collect()] == expected(matches)
    early = standings(facts_of(spark, matches), teams, as_of=moment(0))
    assert [tuple(r) for r in early.orderBy("ranking").collect()] == expected(matches[:2])


def test_idle_teams_rank_by_name(spark, teams):
    table = standings(facts_of(spark, []), teams)
    assert [tuple(r) for r in table.orderBy("ranking").collect()] == expected([])


def test_full_tie_is_decided_by_name(spark, teams, rows):
    matches = [(0, "D", "C", 1, 1), (0, "B", "A", 1, 1)]
    table = standings(facts_of(spark, matches), teams)
    assert rows(table, "ranking", "team") == [(1, "A"), (2, "B"), (3, "C"), (4, "D")]


def test_unlisted_team_is_kept(spark, teams):
    matches = [(0, "A", "Z", 0, 3)]
    table = standings(facts_of(spark, matches), teams)
    assert [tuple(r) for r in table.orderBy("ranking").collect()] == expected(matches)


def test_other_points_rule(spark, teams, rows):
    matches = [(0, "A", "B", 2, 0), (0, "C", "D", 1, 1)]
    table = standings(facts_of(spark, matches), teams, points=Points(win=2, draw=1))
    assert dict(rows(table, "team", "points")) == {"A": 2, "B": 0, "C": 1, "D": 1}


def test_absent_teams(spark, teams, rows):
    facts = facts_of(spark, [(0, "A", "B", 1, 0)])
    assert rows(absent_teams(team_results(facts), teams)) == [("C",), ("D",)]


def test_both_sides_come_from_one_scan(spark, teams):
    path = spark.conf.get("spark.checkpoint.dir") + "/facts"
    facts_of(spark, [(0, "A", "B", 1, 0)]).write.mode("overwrite").parquet(path)
    table = standings(spark.read.parquet(path), teams)
    assert table._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_groups_are_ranked_apart(spark, rows):
    matches = [(0, "A", "B", 1, 0), (0, "B", "A", 2, 0)]
    facts = facts_of(spark, matches).withColumn(
        "league", F.when(F.col("game_id") == "0", "x").otherwise("y")
    )
    teams = spark.createDataFrame(
        [("A", "x"), ("B", "x"), ("A", "y"), ("B", "y")], "team string, league string"
    )
    for slices in (1, 4):
        table = standings(facts, teams, ["league"], slices=slices)
        assert rows(table, "league", "ranking", "team") == [
            ("x", 1, "A"), ("x", 2, "B"), ("y", 1, "B"), ("y", 2, "A"),
        ]


MATCHES = st.lists(
    st.tuples(
        st.integers(0, 6),
        st.sampled_from(["A", "B"]),
        st.sampled_from(["C", "D", "Z"]),
        st.integers(0, 3),
        st.integers(0, 3),
    ),
    max_size=12,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(matches=MATCHES, first=st.integers(0, 2))
def test_history_equals_single_snapshots(spark, teams, matches, first):
    """One set-based job gives what a loop over the weeks gives, unlisted teams too."""
    facts = facts_of(spark, matches)
    history = standings_history(facts, teams, moment(first), moment(6))
    got = defaultdict(list)
    for row in history.orderBy("updated_at", "ranking").collect():
        got[row["updated_at"]].append(tuple(row)[:-1])
    want = {
        moment(w): expected([m for m in matches if m[0] <= w]) for w in range(first, 7)
    }
    assert got == want


def test_history_invariants(spark):
    from matchboard.fixtures import Matches

    history = Matches(spark, "/root/testdata/sf0.001").history()
    per_week = history.groupBy("updated_at").agg(
        F.count("*").alias("n"),
        F.count_distinct("team").alias("teams"),
        F.max("ranking").alias("last"),
        F.count_distinct("ranking").alias("ranks"),
        F.sum(F.col("wins") - F.col("losses")).alias("results"),
        F.sum(F.col("goals_for") - F.col("goals_against")).alias("goals"),
        F.sum(F.col("points") - 3 * F.col("wins") - F.col("draws")).alias("points"),
    )
    bad = per_week.filter(
        "n <> 25 or teams <> 25 or last <> 25 or ranks <> 25 "
        "or results <> 0 or goals <> 0 or points <> 0"
    )
    assert per_week.count() == 345 and bad.isEmpty()
