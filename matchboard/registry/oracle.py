"""The queries as SQL for DuckDB, written apart from the Spark operators."""

from __future__ import annotations

from matchboard.schemas import (
    MATCH_FACTS,
    RAW_SCHEDULE,
    RAW_SCORES,
    SCHEDULE,
    SCORES,
    STANDINGS,
    column_names,
)

ANCHOR = "TIMESTAMP '1994-12-26 08:00:00'"
END = "TIMESTAMP '2001-08-06 08:00:00'"
AS_OF = "TIMESTAMP '1996-12-02 08:00:00'"
RANGE = "TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'"
WEEKS = 345


def _week(moment: str) -> str:
    return f"((epoch_us({moment}) - epoch_us({ANCHOR}) - 1) // 604800000000)"


def _week_end(week: str) -> str:
    return f"({ANCHOR} + to_days(CAST(7 * ({week} + 1) AS INTEGER)))"


ORDER_WEEK = _week("o_orderdate + INTERVAL 3 HOUR")

_COMMON = {
    "first_line": """
        SELECT l_orderkey, l_suppkey FROM (
            SELECT l_orderkey, l_suppkey, row_number() OVER (
                PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS rn
            FROM lineitem) WHERE rn = 1""",
    "pairings": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id,
               CAST({ORDER_WEEK} + 1 AS INTEGER) AS round,
               hn.n_name AS home_team, an.n_name AS away_team,
               o_orderdate AS game_start_time,
               {_week_end(ORDER_WEEK)} AS updated_at,
               o_orderstatus, o_orderpriority
        FROM orders
        JOIN first_line ON l_orderkey = o_orderkey
        JOIN customer ON c_custkey = o_custkey
        JOIN nation hn ON hn.n_nationkey = c_nationkey
        JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation an ON an.n_nationkey = s_nationkey""",
    "goals": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id, home_goals, away_goals,
               o_orderdate + INTERVAL 3 HOUR AS ingestion_time,
               {_week_end(ORDER_WEEK)} AS updated_at, o_orderstatus, o_orderpriority
        FROM orders JOIN (
            SELECT l_orderkey,
                   CAST(count(*) FILTER (l_linestatus = 'O') AS INTEGER) AS home_goals,
                   CAST(count(*) FILTER (l_linestatus = 'F') AS INTEGER) AS away_goals
            FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "schedule": """
        SELECT game_id, round, home_team, away_team, game_start_time, updated_at
        FROM pairings WHERE home_team <> away_team""",
    "scores": """
        SELECT game_id, home_goals, away_goals, ingestion_time, updated_at,
               CAST(ingestion_time AS DATE) AS ingestion_date FROM goals""",
    "facts": """
        SELECT game_id, round, home_team, away_team, game_start_time AS match_time,
               CAST(game_start_time AS DATE) AS match_date, home_goals, away_goals,
               ingestion_time, ingestion_date, home_goals - away_goals AS goal_difference,
               CASE WHEN home_goals > away_goals THEN 'home_win'
                    WHEN home_goals < away_goals THEN 'away_win'
                    ELSE 'draw' END AS match_outcome,
               scores.updated_at
        FROM schedule JOIN scores USING (game_id)""",
    "raw_scores": """
        SELECT game_id, home_goals || '.0' AS home_goals, away_goals,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM' THEN 'no time'
                    ELSE strftime(ingestion_time, '%Y-%m-%d %H:%M:%S') END AS ingestion_time
        FROM (
            SELECT * REPLACE (CASE
                WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
                WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'x'
                ELSE CAST(away_goals AS VARCHAR) END AS away_goals) FROM goals
            UNION ALL
            SELECT * REPLACE (CAST(away_goals AS VARCHAR) AS away_goals) FROM goals
            WHERE o_orderstatus = 'F'
            UNION ALL
            SELECT * REPLACE ('9' AS away_goals) FROM goals
            WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')""",
    "raw_schedule": """
        SELECT game_id,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'
                    THEN 'first' ELSE round || '.7' END AS round,
               home_team,
               CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
                    THEN NULL ELSE away_team END AS away_team,
               strftime(game_start_time, '%Y-%m-%d %H:%M:%S') AS game_start_time
        FROM (SELECT * FROM pairings
              UNION ALL SELECT * FROM pairings WHERE o_orderstatus = 'F')""",
    "whole_scores": """
        SELECT DISTINCT * FROM raw_scores
        WHERE game_id IS NOT NULL AND home_goals IS NOT NULL
          AND away_goals IS NOT NULL AND ingestion_time IS NOT NULL""",
    "whole_schedule": """
        SELECT DISTINCT * FROM raw_schedule
        WHERE game_id IS NOT NULL AND round IS NOT NULL AND home_team IS NOT NULL
          AND away_team IS NOT NULL AND game_start_time IS NOT NULL""",
    "typed_scores": f"""
        SELECT game_id, CAST(trunc(CAST(home_goals AS DOUBLE)) AS INTEGER) AS home_goals,
               CAST(trunc(CAST(away_goals AS DOUBLE)) AS INTEGER) AS away_goals,
               CAST(ingestion_time AS TIMESTAMP) AS ingestion_time, {END} AS updated_at,
               CAST(CAST(ingestion_time AS TIMESTAMP) AS DATE) AS ingestion_date
        FROM whole_scores WHERE away_goals <> 'x' AND ingestion_time <> 'no time'""",
    "typed_schedule": f"""
        SELECT game_id, CAST(trunc(CAST(round AS DOUBLE)) AS INTEGER) AS round,
               home_team, away_team,
               CAST(game_start_time AS TIMESTAMP) AS game_start_time, {END} AS updated_at
        FROM whole_schedule WHERE round <> 'first'""",
    "job_facts": f"""
        SELECT home_team, away_team, home_goals, away_goals,
               CASE WHEN home_goals > away_goals THEN 'home_win'
                    WHEN home_goals < away_goals THEN 'away_win'
                    ELSE 'draw' END AS match_outcome,
               {_week_end(_week('ingestion_time'))} AS updated_at
        FROM typed_schedule JOIN typed_scores USING (game_id)""",
    "calendar": f"SELECT {_week_end('week')} AS updated_at FROM range({WEEKS}) t(week)",
}


def _sides(facts: str, keep: str = "") -> str:
    return f"""
        SELECT {keep}home_team AS team,
               CASE WHEN match_outcome = 'home_win' THEN 1 ELSE 0 END AS wins,
               CASE WHEN match_outcome = 'draw' THEN 1 ELSE 0 END AS draws,
               CASE WHEN match_outcome = 'away_win' THEN 1 ELSE 0 END AS losses,
               home_goals AS goals_for, away_goals AS goals_against FROM {facts}
        UNION ALL
        SELECT {keep}away_team,
               CASE WHEN match_outcome = 'away_win' THEN 1 ELSE 0 END,
               CASE WHEN match_outcome = 'draw' THEN 1 ELSE 0 END,
               CASE WHEN match_outcome = 'home_win' THEN 1 ELSE 0 END,
               away_goals, home_goals FROM {facts}"""


_MEASURES = ("wins", "draws", "losses", "goals_for", "goals_against")


def _ranked(totals: str, group: str = "") -> str:
    """Standings out of a relation with team, group and summed measures."""
    keys = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""
        SELECT {keys}CAST(row_number() OVER ({part}ORDER BY 3 * wins + draws DESC,
                   goals_for - goals_against DESC, goals_for DESC, team) AS INTEGER) AS ranking,
               team, {", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in _MEASURES)},
               CAST(3 * wins + draws AS BIGINT) AS points
        FROM ({totals})"""


def _totals(facts: str) -> str:
    sums = ", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in _MEASURES)
    return f"""
        SELECT n_name AS team, {sums} FROM nation
        LEFT JOIN ({_sides(facts)}) s ON s.team = n_name GROUP BY n_name"""


def _history(facts: str, extra: str = "", extra_values: str = "") -> str:
    keys = f"{extra}, " if extra else ""
    match = f"AND s.{extra} = g.{extra}" if extra else ""
    sums = ", ".join(
        f"sum(coalesce({m}, 0)) OVER (PARTITION BY {keys}team ORDER BY updated_at) AS {m}"
        for m in _MEASURES
    )
    weekly = ", ".join(f"sum({m}) AS {m}" for m in _MEASURES)
    side_keys = f"{keys}updated_at, "
    grid = "SELECT n_name AS team, updated_at FROM nation CROSS JOIN calendar"
    if extra:
        grid = f"SELECT g0.*, {extra} FROM ({grid}) g0 CROSS JOIN ({extra_values}) v({extra})"
    group = f"{extra + ', ' if extra else ''}updated_at"
    return _ranked(
        f"""
        SELECT {keys}team, updated_at, {sums} FROM (
            SELECT g.*, s.* EXCLUDE (team, updated_at{", " + extra if extra else ""})
            FROM ({grid}) g LEFT JOIN (
                SELECT {keys}updated_at, team, {weekly}
                FROM ({_sides(facts, side_keys)}) GROUP BY ALL) s
            ON s.team = g.team AND s.updated_at = g.updated_at {match})""",
        group,
    )


_COMMON["history"] = _history("facts")
_LAGS = {
    "wins": "wins_inc", "draws": "draws_inc", "losses": "losses_inc",
    "goals_for": "gf_inc", "goals_against": "ga_inc", "points": "pts_inc",
}


def _deltas(default: str) -> str:
    window = "OVER (PARTITION BY team ORDER BY updated_at)"
    lags = ", ".join(f"{m} - lag({m}, 1, {default}) {window} AS {d}" for m, d in _LAGS.items())
    return f"SELECT team, updated_at, {lags} FROM history"


def _matches(deltas: str) -> str:
    parts = [
        f"""SELECT team, updated_at, '{letter}' AS result, {pts} AS pts,
                   gf_inc // n AS gf, ga_inc // n AS ga
            FROM (SELECT *, wins_inc + draws_inc + losses_inc AS n,
                         unnest(range(coalesce({count}, 0))) AS i FROM {deltas})"""
        for letter, pts, count in (
            ("W", 3, "wins_inc"), ("D", 1, "draws_inc"), ("L", 0, "losses_inc"))
    ]
    return " UNION ALL ".join(parts)


def _last(matches: str, n: int) -> str:
    return f"""
        SELECT team, updated_at, result, pts, gf AS gf_per_match, ga AS ga_per_match, rn FROM (
            SELECT m.team, s.updated_at, m.result, m.pts, m.gf, m.ga,
                   CAST(row_number() OVER (PARTITION BY m.team, s.updated_at
                        ORDER BY m.updated_at DESC, m.pts DESC) AS INTEGER) AS rn
            FROM {matches} m JOIN history s
              ON s.team = m.team AND m.updated_at <= s.updated_at)
        WHERE rn <= {n}"""


def _form(last: str, n: int) -> str:
    return f"""
        SELECT updated_at, team, CAST(sum(pts) AS BIGINT) AS last5_points,
               CAST(sum(gf_per_match) AS BIGINT) AS goals_for,
               CAST(sum(ga_per_match) AS BIGINT) AS goals_against,
               string_agg(result, '' ORDER BY rn DESC) AS form, count(*) AS match_count
        FROM {last} GROUP BY updated_at, team HAVING count(*) = {n}"""


def _best(form: str, k: int) -> str:
    return f"""
        SELECT * EXCLUDE (match_count) FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY updated_at
                ORDER BY last5_points DESC, goals_for - goals_against DESC,
                         goals_against, team) AS INTEGER) AS form_ranking FROM {form})
        WHERE form_ranking <= {k}"""


_COMMON["deltas"] = _deltas("NULL")
_COMMON["matches"] = _matches("deltas")
_COMMON["last5"] = _last("matches", 5)
_COMMON["form5"] = _form("last5", 5)
_COMMON["deltas0"] = _deltas("0")
_COMMON["matches0"] = _matches("deltas0")
_COMMON["last3"] = _last("matches0", 3)
_COMMON["form3"] = _form("last3", 3)
_COMMON["finished"] = "SELECT * FROM goals WHERE o_orderstatus <> 'P'"
_COMMON["ids_flagged"] = """
    SELECT game_id, bool_or(o) AS in_orders, bool_or(l) AS in_lineitem, bool_or(m) AS in_matches
    FROM (SELECT CAST(o_orderkey AS VARCHAR) AS game_id, true AS o, false AS l, false AS m
          FROM orders
          UNION ALL SELECT CAST(l_orderkey AS VARCHAR), false, true, false FROM lineitem
          UNION ALL SELECT game_id, false, false, true FROM schedule)
    GROUP BY game_id"""


def _report(rows: list[tuple[int, str, str, str]]) -> str:
    """Metrics of (number, check, target, scalar query) rows."""
    selects = [
        f"SELECT CAST({no} AS INTEGER) AS check_no, '{check}' AS \"check\", "
        f"'{target}' AS target, CAST(({count}) AS BIGINT) AS violations"
        for no, check, target, count in rows
    ]
    union = " UNION ALL ".join(selects)
    return f"SELECT *, violations = 0 AS passed FROM ({union})"


def _count(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _surplus(table: str, column: str) -> str:
    return (
        f"SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {table} "
        f"GROUP BY {column})"
    )


def _repeated(table: str, columns: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {columns} HAVING count(*) > 1)"
    )


def _number(column: str, low: float | None, high: float | None) -> str:
    value = f"TRY_CAST({column} AS DOUBLE)"
    parts = [f"{value} IS NULL"]
    if low is not None:
        parts.append(f"{value} < {low}")
    if high is not None:
        parts.append(f"{value} > {high}")
    return " OR ".join(parts)


def _time(column: str, start: str, end: str) -> str:
    value = f"TRY_CAST({column} AS TIMESTAMP)"
    return f"{value} < {start} OR {value} > {end}"


def _numbered(rows: list[tuple[str, str, str]]) -> str:
    return _report([(i, *row) for i, row in enumerate(rows, start=1)])


def _not_null(table: str, names: list[str]) -> list[tuple[str, str, str]]:
    return [("not_null", name, _count(table, f"{name} IS NULL")) for name in names]


def _time_rows(table: str, column: str, start: str, end: str) -> list[tuple[str, str, str]]:
    unreadable = f"TRY_CAST({column} AS TIMESTAMP) IS NULL"
    return [
        ("time_parses", column, _count(table, unreadable)),
        ("time_between", column, _count(table, _time(column, start, end))),
    ]


def _id_pair(a: str, b: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT DISTINCT game_id, 1 AS x FROM {a}) "
        f"FULL JOIN (SELECT DISTINCT game_id, 1 AS y FROM {b}) USING (game_id) "
        f"WHERE x IS NULL OR y IS NULL"
    )


_RAW_SCORES_REPORT = _numbered([
    ("schema", "", "SELECT 0"),
    ("unique", "game_id", _surplus("raw_scores", "game_id")),
    *_not_null("raw_scores", column_names(RAW_SCORES)),
    ("between", "home_goals", _count("raw_scores", _number("home_goals", 0, None))),
    ("between", "away_goals", _count("raw_scores", _number("away_goals", 0, None))),
    *_time_rows("raw_scores", "ingestion_time", ANCHOR, END),
])
_RAW_SCHEDULE_REPORT = _numbered([
    ("schema", "", "SELECT 0"),
    ("differ", "home_team,away_team",
     _count("raw_schedule", "home_team IS NOT DISTINCT FROM away_team")),
    ("unique", "game_id", _surplus("raw_schedule", "game_id")),
    *_not_null("raw_schedule", column_names(RAW_SCHEDULE)),
    ("once_per", "round,home_team", _repeated("raw_schedule", "round, home_team")),
    ("once_per", "round,away_team", _repeated("raw_schedule", "round, away_team")),
    ("between", "round", _count("raw_schedule", _number("round", 1, WEEKS))),
    *_time_rows("raw_schedule", "game_start_time", ANCHOR, END),
])
_FACTS_ROWS = [
    ("schema", "", "SELECT 0"),
    ("differ", "home_team,away_team",
     _count("facts", "home_team IS NOT DISTINCT FROM away_team")),
    ("unique", "game_id", _surplus("facts", "game_id")),
    *_not_null("facts", [*column_names(MATCH_FACTS), "updated_at"]),
    ("once_per", "round,home_team", _repeated("facts", "round, home_team")),
    ("once_per", "round,away_team", _repeated("facts", "round, away_team")),
    ("between", "round", _count("facts", _number("round", 1, WEEKS))),
    ("between", "home_goals", _count("facts", _number("home_goals", 0, None))),
    ("between", "away_goals", _count("facts", _number("away_goals", 0, None))),
    *_time_rows("facts", "match_time", ANCHOR, END),
    *_time_rows("facts", "ingestion_time", ANCHOR, END),
    *_time_rows("facts", "updated_at", END, END),
]
_ID_PAIRS = (("schedule", "scores"), ("schedule", "matches"), ("scores", "matches"))
_FACTS_REPORT = _report(
    [(i, *row) for i, row in enumerate(_FACTS_ROWS, start=1)]
    + [
        (
            len(_FACTS_ROWS) + 1,
            "same_ids",
            f"{a} vs {b}",
            _id_pair(*[{"matches": "facts"}.get(t, t) for t in (a, b)]),
        )
        for a, b in _ID_PAIRS
    ]
)
_ROUNDS = f"({_week('updated_at')} + 1)"
_STANDINGS_ROWS = [
    ("schema", "", "0"),
    ("unique", "team", "count(*) - count(DISTINCT team)"),
    *[("not_null", name, f"count(*) FILTER ({name} IS NULL)") for name in column_names(STANDINGS)],
    ("between", "ranking", "count(*) FILTER (ranking < 1 OR ranking > (SELECT count(*) FROM nation))"),
    *[("between", name, f"count(*) FILTER ({name} < 0 OR {name} > {_ROUNDS})") for name in ("wins", "draws", "losses")],
    ("one_of", "team", "count(*) FILTER (team NOT IN (SELECT n_name FROM nation))"),
]
_STANDINGS_REPORT = "SELECT *, violations = 0 AS passed FROM (" + " UNION ALL ".join(
    f"""SELECT updated_at, CAST({number} AS INTEGER) AS check_no, '{check}' AS "check", '{target}' AS target,
        CAST({count} AS BIGINT) AS violations FROM history GROUP BY updated_at"""
    for number, (check, target, count) in enumerate(_STANDINGS_ROWS, start=1)
) + ")"
_BRONZE_SCORES_ROWS = [
    ("schema", "", "SELECT 0"),
    ("unique", "game_id", _surplus("typed_scores", "game_id")),
    *_not_null("typed_scores", [*column_names(SCORES), "updated_at", "ingestion_date"]),
    ("between", "home_goals", _count("typed_scores", _number("home_goals", 0, None))),
    ("between", "away_goals", _count("typed_scores", _number("away_goals", 0, None))),
    *_time_rows("typed_scores", "ingestion_time", ANCHOR, END),
    *_time_rows("typed_scores", "updated_at", END, END),
]
_BRONZE_SCHEDULE_ROWS = [
    ("schema", "", "SELECT 0"),
    ("differ", "home_team,away_team",
     _count("typed_schedule", "home_team IS NOT DISTINCT FROM away_team")),
    ("unique", "game_id", _surplus("typed_schedule", "game_id")),
    *_not_null("typed_schedule", [*column_names(SCHEDULE), "updated_at"]),
    ("once_per", "round,home_team", _repeated("typed_schedule", "round, home_team")),
    ("once_per", "round,away_team", _repeated("typed_schedule", "round, away_team")),
    ("between", "round", _count("typed_schedule", _number("round", 1, WEEKS))),
    *_time_rows("typed_schedule", "game_start_time", ANCHOR, END),
    *_time_rows("typed_schedule", "updated_at", END, END),
]
_COMMON["calm"] = """
    SELECT * FROM facts
    QUALIFY row_number() OVER (PARTITION BY round, home_team ORDER BY game_id) = 1
        AND row_number() OVER (PARTITION BY round, away_team ORDER BY game_id) = 1"""
_COMMON["changed"] = f"""
    SELECT *, CASE WHEN home_goals > away_goals THEN 'home_win' WHEN home_goals < away_goals THEN 'away_win'
        ELSE 'draw' END AS match_outcome
    FROM (SELECT * EXCLUDE (match_outcome) REPLACE (
        home_goals + CASE WHEN updated_at = {AS_OF} THEN 2 ELSE 0 END AS home_goals) FROM calm)"""
_NEXT = f"({AS_OF} + INTERVAL 7 DAY)"


def _snapshot(facts: str, moment: str) -> str:
    return f"SELECT *, {moment} AS updated_at FROM ({_ranked(_totals(facts))})"


_SCORE_FAULTS = [
    (2, "count(*) OVER (PARTITION BY game_id) > 1"),
    *[(3 + k, f"{name} IS NULL") for k, name in enumerate(column_names(RAW_SCORES))],
    (7, _number("home_goals", 0, None)),
    (8, _number("away_goals", 0, None)),
    (9, "TRY_CAST(ingestion_time AS TIMESTAMP) IS NULL"),
    (10, _time("ingestion_time", ANCHOR, END)),
]
_FACT_FAULTS = [
    (1, "count(*) OVER (PARTITION BY updated_at, round, home_team) > 1"),
    (2, "away_team NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 2)"),
    (3, "game_id NOT IN (SELECT game_id FROM goals WHERE o_orderpriority <> '1-URGENT')"),
    (4, "home_goals < 1 OR home_goals > 5"),
    (5, "count(*) OVER (PARTITION BY updated_at, match_time) > 1"),
]


def _faulty(table: str, faults: list[tuple[int, str]], columns: str = "*") -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN '{number}' END" for number, condition in faults)
    return f"SELECT * FROM (SELECT {columns}, concat_ws(',', {cases}) AS broken FROM {table}) WHERE broken <> ''"


_BY_SNAPSHOT = """
    WITH per_team AS (SELECT updated_at, count(*) - 1 AS again FROM facts
                      GROUP BY updated_at, round, away_team),
    counts AS (
        SELECT updated_at, count(*) - count(DISTINCT game_id) AS c1,
               (SELECT count(*) FROM per_team p
                WHERE p.updated_at = f.updated_at AND again > 0) AS c2,
               count(*) FILTER (home_goals < 1 OR home_goals > 5) AS c3,
               count(*) FILTER (home_goals = away_goals) AS c4
        FROM facts f GROUP BY updated_at)
    SELECT updated_at, check_no, "check", target, CAST(v AS BIGINT) AS violations, v = 0 AS passed
    FROM (
        SELECT updated_at, 1 AS check_no, 'unique' AS "check", 'game_id' AS target, c1 AS v
        FROM counts
        UNION ALL SELECT updated_at, 2, 'once_per', 'round,away_team', c2 FROM counts
        UNION ALL SELECT updated_at, 3, 'between', 'home_goals', c3 FROM counts
        UNION ALL SELECT updated_at, 4, 'differ', 'home_goals,away_goals', c4 FROM counts)"""


def _distinct_row(column: str) -> str:
    return f"""
        SELECT '{column}' AS "column", count(*) AS "rows",
               count(DISTINCT {column}) + CAST(bool_or({column} IS NULL) AS BIGINT)
                   AS distinct_values,
               count(*) - count(DISTINCT {column}) - CAST(bool_or({column} IS NULL) AS BIGINT)
                   AS surplus
        FROM raw_schedule"""


def _period_columns(week: str) -> str:
    return f"""
        {_week_end(f"({week} - 1)")} AS period_start, {_week_end(week)} AS period_end,
        CAST(greatest({week}, 1) AS INTEGER) AS min_round,
        CAST({week} + 1 AS INTEGER) AS max_round"""


_SLICE = (
    f"ingestion_time > {AS_OF} - INTERVAL 7 DAY AND ingestion_time <= {AS_OF}"
)
_WEEK_FACTS = f"(SELECT * FROM facts WHERE updated_at = {AS_OF})"

_BODIES = {
    "slice_week": f"""SELECT * EXCLUDE (updated_at) FROM schedule
        WHERE game_id IN (SELECT game_id FROM scores WHERE {_SLICE})""",
    "slice_week_scores": f"""SELECT * EXCLUDE (updated_at, ingestion_date) FROM scores
        WHERE {_SLICE}""",
    "week_of_match": f"""SELECT game_id, week, {_period_columns("week")}
        FROM (SELECT game_id, {_week("ingestion_time")} AS week FROM scores)""",
    "week_calendar": f"""SELECT week, {_period_columns("week")}, coalesce(n, 0) AS matches
        FROM (SELECT unnest(range(min({_week("updated_at")}), max({_week("updated_at")}) + 1))
                  AS week FROM facts)
        LEFT JOIN (SELECT {_week("updated_at")} AS week, count(*) AS n FROM facts GROUP BY 1)
        USING (week)""",
    "season_calendar": f"""SELECT week, {_period_columns("week")}, {_week_end("week")} AS updated_at,
            coalesce(n, 0) AS matches
        FROM (SELECT unnest(range({WEEKS})) AS week)
        LEFT JOIN (SELECT {_week("updated_at")} AS week, count(*) AS n FROM facts GROUP BY 1)
        USING (week)""",
    "clean_scores_rows": "SELECT * FROM typed_scores",
    "clean_schedule_rows": "SELECT * FROM typed_schedule",
    "rejected_scores": """SELECT *, concat_ws(',',
            CASE WHEN away_goals = 'x' THEN 'away_goals' END,
            CASE WHEN ingestion_time = 'no time' THEN 'ingestion_time' END) AS rejected_columns
        FROM whole_scores WHERE away_goals = 'x' OR ingestion_time = 'no time'""",
    "rejected_schedule": """SELECT *, 'round' AS rejected_columns FROM whole_schedule
        WHERE round = 'first'""",
    "cast_rounds": """SELECT count(*) AS "rows", count(TRY_CAST(game_id AS INTEGER)) AS plain_integers,
               count(*) FILTER (regexp_full_match(round, '[0-9]+')) AS plain_rounds,
               count(TRY_CAST(round AS DOUBLE)) AS through_double,
               CAST(sum(trunc(TRY_CAST(round AS DOUBLE))) AS BIGINT) AS round_sum
        FROM raw_schedule""",
    "try_cast_range": _numbered([
        ("between", "value", _count("events", _number("value", 1, 300))),
        ("between", "value", _count("events", _number("value", 10, None))),
        ("between", "user_id", _count("events", _number("user_id", None, 50))),
        ("between", "event_type", _count("events", _number("event_type", None, None))),
        ("between", "props", _count("events", _number("props", 0, 1))),
    ]),
    "reconcile_ids": """SELECT 'schedule' AS side, game_id FROM schedule
        WHERE game_id IN (SELECT game_id FROM finished)
        UNION ALL SELECT 'scores', game_id FROM finished
        WHERE game_id IN (SELECT game_id FROM schedule)""",
    "mismatched_ids": """SELECT game_id, l IS NOT NULL AS in_left, r IS NOT NULL AS in_right
        FROM (SELECT DISTINCT game_id, 1 AS l FROM schedule)
        FULL JOIN (SELECT DISTINCT game_id, 1 AS r FROM finished) USING (game_id)
        WHERE l IS NULL OR r IS NULL""",
    "exclude_ids": """SELECT * FROM schedule
        WHERE game_id NOT IN (SELECT game_id FROM goals WHERE o_orderstatus = 'F')""",
    "id_presence_mask": """SELECT in_orders, in_lineitem, in_matches, count(*) AS ids
        FROM ids_flagged GROUP BY ALL""",
    "pairwise_id_match": _report([
        (1, "same_ids", f"{a} vs {b}", _count("ids_flagged", f"in_{a} <> in_{b}"))
        for a, b in (("orders", "lineitem"), ("orders", "matches"), ("lineitem", "matches"))
    ]),
    "duplicate_line_keys": """SELECT l_orderkey, l_linenumber, count(*) AS copies
        FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_line_rows": """SELECT * FROM lineitem
        QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
    "duplicate_score_rows": """SELECT * FROM raw_scores
        QUALIFY count(*) OVER (PARTITION BY game_id) > 1""",
    "distinct_rows": "SELECT DISTINCT * FROM raw_scores",
    "distinct_values": " UNION ALL ".join(
        _distinct_row(c) for c in ("game_id", "round", "home_team", "away_team")
    ),
    "null_counts": _numbered(_not_null("raw_scores", column_names(RAW_SCORES))),
    "unique_ids": _numbered([
        ("unique", c, _surplus("raw_scores", c)) for c in ("game_id", "ingestion_time")
    ]),
    "unique_within_round": """SELECT round, home_team, count(*) AS copies FROM facts
        GROUP BY ALL HAVING count(*) > 1""",
    "differing_columns": """
        SELECT * EXCLUDE (updated_at, o_orderstatus, o_orderpriority) FROM pairings
        WHERE home_team = away_team""",
    "datetime_range": f"""SELECT * FROM raw_scores
        WHERE (TRY_CAST(ingestion_time AS TIMESTAMP) BETWEEN {RANGE}) IS NOT TRUE""",
    "datetime_range_counts": _numbered(
        _time_rows("raw_scores", "ingestion_time", *RANGE.split(" AND "))
    ),
    "allowed_values": """SELECT event_type, count(*) AS "rows" FROM events
        WHERE event_type NOT IN ('click', 'view', 'signup') GROUP BY ALL""",
    "allowed_values_sample": """SELECT DISTINCT event_type FROM events
        WHERE event_type NOT IN ('click', 'view') ORDER BY event_type LIMIT 5""",
    "allowed_values_frame_mixed": _numbered([
        ("one_of", "c_nationkey", _count(
            "customer", "c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)"))
    ]),
    "semi_join_mixed_types": """SELECT c_custkey, c_nationkey FROM customer
        WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)""",
    "failure_report": """
        SELECT updated_at, CAST(2 AS INTEGER) AS check_no, 'between' AS "check", 'home_goals' AS target,
               count(*) AS violations
        FROM facts WHERE home_goals < 1 OR home_goals > 5 GROUP BY updated_at
        UNION ALL
        SELECT updated_at, 3, 'differ', 'home_goals,away_goals', count(*)
        FROM facts WHERE home_goals = away_goals GROUP BY updated_at
        UNION ALL
        SELECT updated_at, 1, 'unique', 'game_id', count(*) - count(DISTINCT game_id)
        FROM facts GROUP BY updated_at HAVING count(*) > count(DISTINCT game_id)""",
    "schema_mismatch": """SELECT CAST(1 AS INTEGER) AS check_no, 'schema' AS "check",
        string_agg(name || ' is missing', ', ' ORDER BY name) AS target, count(*) AS violations,
        false AS passed
        FROM (VALUES ('n_nationkey'), ('n_name'), ('n_continent'), ('n_code')) wanted(name)
        WHERE name NOT IN (SELECT column_name FROM (DESCRIBE nation))""",
    "allowed_teams": _numbered([
        ("one_of", c, _count(
            "facts", f"{c} NOT IN (SELECT n_name FROM nation WHERE n_regionkey < 2)"))
        for c in ("home_team", "away_team")
    ]),
    "row_count_match": _numbered([
        ("same_count", "rows",
         f"SELECT abs((SELECT count(*) FROM schedule) - (SELECT count(*) FROM {other}))")
        for other in ("scores", "facts")
    ]),
    "raw_scores_report": _RAW_SCORES_REPORT,
    "raw_schedule_report": _RAW_SCHEDULE_REPORT,
    "validate_report": _FACTS_REPORT,
    "validate_by_snapshot": _BY_SNAPSHOT,
    "standings_report": _STANDINGS_REPORT,
    "match_facts": "SELECT * FROM facts",
    "one_match_lookup": "SELECT * FROM facts WHERE game_id = '100'",
    "home_and_away_results": _sides("facts", "game_id, "),
    "standings_table": _ranked(_totals("facts")),
    "standings_as_of": _ranked(
        _totals(f"(SELECT * FROM facts WHERE updated_at <= {AS_OF})")
    ),
    "standings_with_absent": _ranked(_totals(_WEEK_FACTS)),
    "absent_in_week": f"""SELECT n_name AS team FROM nation
        WHERE n_name NOT IN (SELECT home_team FROM {_WEEK_FACTS} WHERE home_goals > away_goals)
          AND n_name NOT IN (SELECT away_team FROM {_WEEK_FACTS} WHERE away_goals > home_goals)""",
    "standings_by_year": _ranked(
        f"""SELECT CAST(y.year AS INTEGER) AS year, n_name AS team,
                   {", ".join(f"coalesce(sum({m}), 0) AS {m}" for m in _MEASURES)}
            FROM nation CROSS JOIN (SELECT DISTINCT year(match_date) AS year FROM facts) y
            LEFT JOIN ({_sides("(SELECT *, year(match_date) AS year FROM facts)", "year, ")}) s
              ON s.team = n_name AND s.year = y.year
            GROUP BY y.year, n_name""",
        "year",
    ),
    "standings_history_rows": "SELECT * FROM history",
    "snapshot_lookup": f"SELECT * FROM history WHERE updated_at = {AS_OF}",
    "history_by_side": _history(
        "(SELECT facts.*, o_orderstatus AS league FROM facts JOIN goals USING (game_id))",
        "league",
        "VALUES ('F'), ('O'), ('P')",
    ),
    "weekly_delta_rows": "SELECT * FROM deltas",
    "matches_from_history": "SELECT * FROM matches",
    "last5_matches": "SELECT * FROM last5",
    "form_aggregate": "SELECT * FROM form5",
    "recent_form_top3": _best("form5", 3),
    "recent_form_all_weeks": _best("form3", 10),
    "csv_round_trip": "SELECT * FROM raw_scores",
    "season_job": _ranked(_totals("job_facts")),
    "backfill_job": _history("job_facts"),
    "export_history_csv": _history("job_facts"),
    "csv_reordered_columns": "SELECT * FROM raw_scores",
    "job_rejects": """SELECT *, 'away_goals' AS rejected_columns
        FROM whole_scores WHERE away_goals = 'x' AND ingestion_time <> 'no time'""",
    "form_export": _best("form5", 3),
    "bronze_scores_report": _numbered(_BRONZE_SCORES_ROWS),
    "bronze_schedule_report": _numbered(_BRONZE_SCHEDULE_ROWS),
    "violations_by_suite": _faulty("raw_scores", _SCORE_FAULTS),
    "violations_of_facts": _faulty("facts", _FACT_FAULTS, "game_id"),
    "facts_repeated_ids": """SELECT facts.* FROM facts JOIN goals USING (game_id)
        WHERE o_orderstatus <> 'F'
        UNION ALL SELECT facts.* FROM facts JOIN goals USING (game_id)
        WHERE o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT'""",
    "ids_left_out": """SELECT game_id, CAST(2 AS BIGINT) AS schedule_rows, CAST(2 AS BIGINT) AS score_rows
        FROM schedule JOIN goals USING (game_id) WHERE o_orderstatus = 'F'""",
    "standings_carried_on": f"SELECT * FROM history WHERE updated_at > {AS_OF}",
    "form_carried_on": f"SELECT * FROM ({_best('form5', 3)}) WHERE updated_at > {AS_OF}",
    "recent_form_ranked": _best("form5", 1_000_000),
    "snapshot_overwrite": f"""SELECT * REPLACE (CAST(ranking + CASE WHEN updated_at = {AS_OF}
        THEN 100 ELSE 0 END AS INTEGER) AS ranking) FROM history""",
    "landed_week": f"""SELECT * FROM raw_scores
        WHERE {_week("TRY_CAST(ingestion_time AS TIMESTAMP)")} = 100""",
    "strict_season_job": _ranked(_totals("calm")),
    "row_count_gate": f"""SELECT CAST(15 AS INTEGER) AS check_no, 'same_count' AS "check", 'rows' AS target,
            count(*) AS violations, count(*) = 0 AS passed
        FROM calm WHERE updated_at = {AS_OF}""",
    "rerun_week_job": " UNION ALL ".join([
        _snapshot(f"(SELECT * FROM changed WHERE updated_at = {AS_OF})", AS_OF),
        _snapshot(f"(SELECT * FROM changed WHERE updated_at IN ({AS_OF}, {_NEXT}))", _NEXT),
    ]),
    "backfill_one_bad_week": f"""SELECT * FROM (
        {_history(f"(SELECT * FROM calm WHERE updated_at <> {AS_OF})")})
        WHERE updated_at <> {AS_OF} OR NOT EXISTS (SELECT 1 FROM calm WHERE updated_at = {AS_OF})""",
}


def _with_common(body: str) -> str:
    needed = ",\n".join(f"{name} AS ({sql})" for name, sql in _COMMON.items())
    return f"WITH {needed}\nSELECT * FROM ({body})"


ORACLE = {name: _with_common(body) for name, body in _BODIES.items()}
