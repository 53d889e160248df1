"""Recent form from cumulative standings: results of the last matches per snapshot.

The history has one row per team and snapshot, so a window over one team holds as
many rows as there are snapshots. Matches of one team and week differ by result
only (W, D, L) and share the goals per match; within a week the better result
counts as the later one, which makes the order total.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchboard.functions.casts import at, time_type
from matchboard.operators.ranking import rank_rows, top_rows

# Result letters, their points and the delta that counts them.
RESULTS = (("W", 3, "wins_inc"), ("D", 1, "draws_inc"), ("L", 0, "losses_inc"))
DELTAS = {
    "wins": "wins_inc",
    "draws": "draws_inc",
    "losses": "losses_inc",
    "goals_for": "gf_inc",
    "goals_against": "ga_inc",
    "points": "pts_inc",
}
FORM_ORDER = (
    ("last5_points", "desc"),
    ("goal_balance", "desc"),
    ("goals_against", "asc"),
    ("team", "asc"),
)
# Rows made from one array at a time when a count becomes rows.
_BLOCK = 65_536


def weekly_deltas(
    history: DataFrame, group_cols: Sequence[str] = (), include_first: bool = False
) -> DataFrame:
    """Change of every measure since the team's previous snapshot.

    The first snapshot has no previous one: its deltas are null, and its matches
    never count. ``include_first`` takes them from zero instead.
    """
    entity = [*group_cols, "team"]
    timeline = Window.partitionBy(*entity).orderBy("updated_at")
    start = 0 if include_first else None
    return history.select(
        *entity,
        "updated_at",
        *[
            (F.col(m) - F.lag(m, 1, start).over(timeline)).alias(d) for m, d in DELTAS.items()
        ],
    )


def matches_from_deltas(deltas: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """One row per match.

    A count becomes rows in blocks, spread over the tasks between the two steps, so
    a week with very many matches neither builds a long array nor fills one task.
    """
    keys = [*group_cols, "team", "updated_at"]
    runs = F.array(
        *[
            F.struct(
                F.lit(letter).alias("result"),
                F.lit(points).alias("pts"),
                F.coalesce(F.col(count), F.lit(0)).alias("n"),
            )
            for letter, points, count in RESULTS
        ]
    )
    per_match = {"gf": _per_match("gf_inc"), "ga": _per_match("ga_inc")}
    counted = (
        deltas.withColumns(per_match)
        .select(*keys, "gf", "ga", F.inline(runs))
        .filter(F.col("n") > 0)
    )
    blocks = F.sequence(F.lit(0), F.expr(f"(n - 1) div {_BLOCK}"))
    spread = counted.withColumn("block", F.explode(blocks)).repartition(*keys, "result", "block")
    in_block = F.least(F.lit(_BLOCK), F.col("n") - F.col("block") * _BLOCK).cast("int")
    return spread.select(
        *keys, "result", "pts", "gf", "ga", F.explode(F.array_repeat(F.lit(1), in_block)).alias("_")
    ).drop("_")


def last_matches(
    deltas: DataFrame, n: int = 5, group_cols: Sequence[str] = ()
) -> DataFrame:
    """The last ``n`` matches of each team at each snapshot, ``rn`` 1 being the latest."""
    recent = _with_recent(deltas, n, group_cols)
    size = F.size("recent")
    numbered = recent.select(*group_cols, "team", "updated_at", size.alias("n"), F.posexplode("recent"))
    return numbered.select(
        *group_cols,
        "team",
        "updated_at",
        "col.result",
        "col.pts",
        F.col("col.gf").alias("gf_per_match"),
        F.col("col.ga").alias("ga_per_match"),
        (F.col("n") - F.col("pos")).cast("int").alias("rn"),
    )


def form_table(deltas: DataFrame, n: int = 5, group_cols: Sequence[str] = ()) -> DataFrame:
    """Points, goals and result string (oldest first) over the last ``n`` matches.

    Teams with fewer than ``n`` matches so far are left out.
    """
    return _form_rows(_with_recent(deltas, n, group_cols), n, group_cols)


def _form_rows(states: DataFrame, n: int, group_cols: Sequence[str]) -> DataFrame:
    return states.filter(F.size("recent") == n).select(
        "updated_at",
        *group_cols,
        "team",
        _total("pts").alias("last5_points"),
        _total("gf").alias("goals_for"),
        _total("ga").alias("goals_against"),
        F.array_join(F.col("recent.result"), "").alias("form"),
        F.size("recent").cast("bigint").alias("match_count"),
    )


def form_states(
    history: DataFrame,
    n: int = 5,
    group_cols: Sequence[str] = (),
    opening: DataFrame | None = None,
    since: datetime | None = None,
) -> DataFrame:
    """``recent``, the last ``n`` matches (oldest first), of each team at each snapshot.

    This is all that later snapshots need of earlier ones: ``history`` may begin with the
    snapshot ``since`` if ``opening`` holds its states, and the states after it are returned.
    Teams without a match so far have no state.
    """
    states = _with_recent(weekly_deltas(history, group_cols), n, group_cols, opening)
    if since is None:
        return states
    return states.filter(F.col("updated_at") > at(since, time_type(history, "updated_at")))


def form_of_states(
    states: DataFrame, n: int = 5, k: int | None = 3, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Recent form from stored states of at least ``n`` matches; see ``recent_form``."""
    newest = F.reverse(F.slice(F.reverse("recent"), 1, n))
    return _ranked_form(_form_rows(states.withColumn("recent", newest), n, group_cols), k, group_cols)


def recent_form(
    history: DataFrame,
    n: int = 5,
    k: int | None = 3,
    group_cols: Sequence[str] = (),
    include_first: bool = False,
) -> DataFrame:
    """The ``k`` teams in best form at each snapshot; all of them with ``k=None``."""
    deltas = weekly_deltas(history, group_cols, include_first)
    return _ranked_form(form_table(deltas, n, group_cols), k, group_cols)


def _ranked_form(table: DataFrame, k: int | None, group_cols: Sequence[str]) -> DataFrame:
    table = table.withColumn("goal_balance", F.col("goals_for") - F.col("goals_against"))
    snapshot = [*group_cols, "updated_at"]
    if k is None:
        best = rank_rows(table, snapshot, FORM_ORDER, "form_ranking")
    else:
        best = top_rows(table, snapshot, FORM_ORDER, k, "form_ranking")
    return best.select(
        "updated_at",
        *group_cols,
        "team",
        "goals_for",
        "goals_against",
        "form",
        "last5_points",
        "form_ranking",
    )


def _with_recent(
    deltas: DataFrame, n: int, group_cols: Sequence[str], opening: DataFrame | None = None
) -> DataFrame:
    """Add ``recent``: up to ``n`` last matches per snapshot, oldest first.

    A match that is not among the last ``n`` of its own week can never be among the
    last ``n`` at any later snapshot, and every week with a match adds at least one,
    so ``n`` matches of each of the last ``n`` such weeks are all that is needed.
    Every window keeps the partitioning by team, hence one shuffle for the chain.
    """
    entity = [*group_cols, "team"]
    gf, ga = _per_match("gf_inc"), _per_match("ga_inc")
    room: Column = F.lit(n)
    runs = []
    for letter, points, count in RESULTS:
        take = F.greatest(F.least(F.coalesce(F.col(count), F.lit(0)), room), F.lit(0))
        match = F.struct(
            F.lit(letter).alias("result"),
            F.lit(points).alias("pts"),
            gf.alias("gf"),
            ga.alias("ga"),
        )
        runs.insert(0, F.array_repeat(match, take.cast("int")))
        room = room - take
    weeks = deltas.select(*entity, "updated_at", F.concat(*runs).alias("week"))
    if opening is not None:
        # A state stands for a week with just these matches.
        weeks = weeks.unionByName(opening.select(*entity, "updated_at", F.col("recent").alias("week")))
    weeks = weeks.withColumn("played", F.size("week") > 0)

    own_weeks = Window.partitionBy(*entity, "played").orderBy("updated_at")
    joined = F.flatten(F.collect_list("week").over(own_weeks.rowsBetween(-(n - 1), 0)))
    newest = F.reverse(F.slice(F.reverse(joined), 1, n))
    timeline = Window.partitionBy(*entity).orderBy("updated_at")
    carried = F.last(F.when(F.col("played"), F.col("newest")), ignorenulls=True)
    until_now = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        weeks.withColumn("newest", newest)
        .withColumn("recent", carried.over(until_now))
        .filter(F.col("recent").isNotNull())
        .select(*entity, "updated_at", "recent")
    )


def _per_match(total: str) -> Column:
    return F.expr(f"{total} div nullif(wins_inc + draws_inc + losses_inc, 0)")


def _total(field: str) -> Column:
    return F.aggregate(
        "recent", F.lit(0).cast("bigint"), lambda acc, match: acc + match[field]
    )
