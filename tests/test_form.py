from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import matchboard.operators.form as form_module
from benchmarks.plain import last_matches_by_range_join
from matchboard.operators.form import (
    form_table,
    last_matches,
    matches_from_deltas,
    recent_form,
    weekly_deltas,
)

START = datetime(2025, 8, 25, 8)
HISTORY = (
    "team string, updated_at timestamp, wins bigint, draws bigint, losses bigint, "
    "goals_for bigint, goals_against bigint, points bigint"
)


def snapshot(week):
    return START + timedelta(weeks=week)


def history_of(spark, weekly):
    """Cumulative history from {team: [(wins, draws, losses, gf, ga), ...] per week}."""
    data = []
    for team, weeks in weekly.items():
        total = [0] * 5
        for week, increments in enumerate(weeks):
            total = [t + i for t, i in zip(total, increments)]
            data.append((team, snapshot(week), *total, 3 * total[0] + total[1]))
    return spark.createDataFrame(data, HISTORY)


def expected_last(weekly, n, include_first=False):
    """Last matches per team and snapshot by a plain loop, oldest first."""
    out = {}
    for team, weeks in weekly.items():
        played = []
        for week, (w, d, lost, gf, ga) in enumerate(weeks):
            count = w + d + lost
            if count and (week or include_first):
                for letter, points, k in (("L", 0, lost), ("D", 1, d), ("W", 3, w)):
                    played += [(letter, points, gf // count, ga // count)] * k
            out[team, snapshot(week)] = played[-n:]
    return out


def expected_form(weekly, n=5, k=3, include_first=False):
    by_week = defaultdict(list)
    for (team, week), last in expected_last(weekly, n, include_first).items():
        if len(last) == n:
            gf, ga = sum(m[2] for m in last), sum(m[3] for m in last)
            by_week[week].append(
                (team, gf, ga, "".join(m[0] for m in last), sum(m[1] for m in last))
            )
    rows = []
    for week, teams in sorted(by_week.items()):
        teams.sort(key=lambda t: (-t[4], -(t[1] - t[2]), t[2], t[0]))
        rows += [(week, *t, i) for i, t in enumerate(teams[:k], start=1)]
    return rows


def test_first_snapshot_never_counts(spark):
    history = history_of(spark, {"A": [(3, 0, 0, 9, 0), (1, 0, 0, 2, 1)]})
    deltas = weekly_deltas(history).orderBy("updated_at").collect()
    assert deltas[0]["wins_inc"] is None and deltas[1]["wins_inc"] == 1
    assert matches_from_deltas(weekly_deltas(history)).count() == 1
    assert matches_from_deltas(weekly_deltas(history, include_first=True)).count() == 4


def test_goals_per_match_are_whole_numbers(spark, rows):
    history = history_of(spark, {"A": [(0,) * 5, (1, 0, 1, 3, 5), (0,) * 5]})
    matches = matches_from_deltas(weekly_deltas(history))
    assert rows(matches, "result", "pts", "gf", "ga") == [("L", 0, 1, 2), ("W", 3, 1, 2)]


def test_results_read_oldest_first(spark):
    weeks = [(0,) * 5] + [
        {"W": (1, 0, 0, 1, 0), "D": (0, 1, 0, 0, 0), "L": (0, 0, 1, 0, 1)}[r] for r in "WDLWW"
    ]
    table = form_table(weekly_deltas(history_of(spark, {"A": weeks}))).collect()
    assert [(r["form"], r["last5_points"], r["match_count"]) for r in table] == [("WDLWW", 10, 5)]


def test_large_counts_become_rows_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(form_module, "_BLOCK", 10)
    history = history_of(spark, {"A": [(0,) * 5, (25, 10, 0, 35, 0)]})
    matches = matches_from_deltas(weekly_deltas(history))
    assert dict(matches.groupBy("result").count().collect()) == {"W": 25, "D": 10}


WEEKLY = st.dictionaries(
    st.sampled_from("ABCDE"),
    st.lists(
        st.tuples(
            st.integers(0, 3), st.integers(0, 2), st.integers(0, 3),
            st.integers(0, 9), st.integers(0, 9),
        ) | st.just((0, 0, 0, 0, 0)),
        min_size=1,
        max_size=9,
    ),
    min_size=1,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(weekly=WEEKLY, n=st.integers(1, 5), first=st.booleans())
def test_form_equals_a_plain_loop(spark, weekly, n, first):
    history = history_of(spark, weekly)
    form = recent_form(history, n, 3, include_first=first)
    got = [tuple(r) for r in form.orderBy("updated_at", "form_ranking").collect()]
    assert got == expected_form(weekly, n, 3, first)
    last = defaultdict(list)
    numbered = last_matches(weekly_deltas(history, include_first=first), n)
    for r in numbered.orderBy("rn", ascending=False).collect():
        last[r["team"], r["updated_at"]].append(
            (r["result"], r["pts"], r["gf_per_match"], r["ga_per_match"])
        )
    assert last == {k: v for k, v in expected_last(weekly, n, first).items() if v}


def test_last_matches_equal_the_range_join(spark):
    from matchboard.fixtures import Matches

    path = spark.conf.get("spark.checkpoint.dir") + "/history"
    Matches(spark, "/root/testdata/sf0.001").history().write.mode("overwrite").parquet(path)
    history = spark.read.parquet(path)
    fast, plain = last_matches(weekly_deltas(history)), last_matches_by_range_join(history)
    assert fast.count() == plain.count() > 0
    assert fast.exceptAll(plain.select(*fast.columns)).isEmpty()


def test_form_chain_shuffles_once_per_key(spark):
    """One shuffle by team for the whole chain and one by snapshot for the rank."""
    history = history_of(spark, {"A": [(0,) * 5, (1, 0, 0, 1, 0)]})
    plan = recent_form(history, 5, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 2


@pytest.mark.parametrize("groups", [[], ["league"]])
def test_leagues_do_not_mix(spark, groups):
    weekly = {"A": [(0,) * 5, (5, 0, 0, 5, 0)], "B": [(0,) * 5, (0, 0, 5, 0, 5)]}
    history = history_of(spark, weekly).withColumn("league", F.col("team"))
    ranks = dict(recent_form(history, 5, 3, groups).select("team", "form_ranking").collect())
    assert ranks == ({"A": 1, "B": 1} if groups else {"A": 1, "B": 2})
