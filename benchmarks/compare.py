"""Times of the library's forms against the plain ones, on staged inputs.

Same environment variables as ``bench.py``. Prints one line of JSON per comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from benchmarks.plain import (
    history_by_repetition,
    last_matches_by_range_join,
    validate_one_by_one,
)
from matchboard.fixtures import SEASON, TIME, Matches
from matchboard.functions.periods import WEEK, run_time, season_period
from matchboard.operators.facts import match_facts
from matchboard.operators.form import last_matches, weekly_deltas
from matchboard.operators.standings import standings_history
from matchboard.quality import suites, validate
from matchboard.session import build_session
from matchboard.sources.staging import stage


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def measure(spark, name: str, **forms) -> None:
    out = {"comparison": name}
    for form, run in forms.items():
        run()
        seconds = []
        for attempt in range(3):
            group = f"{name}-{form}-{attempt}"
            spark.sparkContext.setJobGroup(group, group)
            start = time.perf_counter()
            run()
            seconds.append(time.perf_counter() - start)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        out[form] = {"seconds": round(statistics.median(seconds), 2), "jobs": jobs}
    print(json.dumps(out), flush=True)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "8",
    }
    spark = build_session("matchboard-compare", f"local[{cpus}]", conf)
    spark.sparkContext.setLogLevel("ERROR")
    m = Matches(spark, folder)
    schedule, scores, teams = stage(m.schedule()), stage(m.scores()), stage(m.teams())
    facts = stage(match_facts(schedule, scores))
    first = run_time(SEASON, 1)
    history = stage(standings_history(facts, teams, first, SEASON.end))

    measure(
        spark,
        "last five matches",
        windows=lambda: sink(last_matches(weekly_deltas(history))),
        range_join=lambda: sink(last_matches_by_range_join(history)),
    )
    bounds = suites.PeriodBounds.of(season_period(SEASON))
    tables = {"schedule": schedule, "scores": scores, "matches": facts}
    checks = suites.match_facts(bounds, tables, TIME)
    measure(
        spark,
        "match facts suite",
        together=lambda: validate(facts, checks).collect(),
        one_by_one=lambda: validate_one_by_one(facts, checks),
    )
    some = [first + k * WEEK for k in range(12)]
    measure(
        spark,
        "standings of 12 weeks",
        at_once=lambda: sink(standings_history(facts, teams, first, some[-1])),
        repeated=lambda: sink(history_by_repetition(facts, teams, some)),
    )
    spark.stop()


if __name__ == "__main__":
    main()
