"""Matches derived from the order tables: every order is a match of two nations.

The customer's nation plays at home against the nation of the supplier on the
order's first line; open and finished lines are the goals. The raw frames carry
the same matches as text, with copies, gaps and unreadable values.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchboard.functions.periods import WEEK, Season, week_end, week_index
from matchboard.operators.facts import match_facts
from matchboard.operators.standings import standings_history

TIME = "timestamp_ntz"
# Monday before the first order, and the end of the week of the last one.
_WEEKS = 345
_START = datetime(1994, 12, 26, 8, 0)
SEASON = Season(_START, _START + timedelta(weeks=_WEEKS), _WEEKS)
INGEST_DELAY = "interval '3' hour"

LAYOUTS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
        "c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
}


def once(build: Callable[[Matches], DataFrame]) -> Callable[[Matches], DataFrame]:
    """Build a frame the first time it is asked for; building it means analysing it."""

    @wraps(build)
    def get(self: Matches) -> DataFrame:
        if build.__name__ not in self.frames:
            self.frames[build.__name__] = build(self)
        return self.frames[build.__name__]

    return get


@dataclass(frozen=True)
class Matches:
    """Frames derived from one data folder."""

    spark: SparkSession
    folder: str
    frames: dict[str, DataFrame] = field(default_factory=dict, compare=False)

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(LAYOUTS[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @once
    def teams(self) -> DataFrame:
        return self.table("nation").select(F.col("n_name").alias("team"))

    @once
    def pairings(self) -> DataFrame:
        """Who plays whom and when, also a nation against itself."""
        first = F.min_by("l_suppkey", F.struct("l_linenumber", "l_suppkey"))
        lines = self.table("lineitem").groupBy("l_orderkey").agg(first.alias("s_suppkey"))
        nation = self.table("nation").select("n_nationkey", "n_name")
        home = (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", F.col("n_name").alias("home_team"))
        )
        away = (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", F.col("n_name").alias("away_team"))
        )
        week = _week(F.col("o_orderdate"))
        return (
            self.table("orders")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(home, F.col("o_custkey") == F.col("c_custkey"))
            .join(away, "s_suppkey")
            .select(
                F.col("o_orderkey").cast("string").alias("game_id"),
                (week + 1).cast("int").alias("round"),
                "home_team",
                "away_team",
                F.col("o_orderdate").alias("game_start_time"),
                week_end(week, SEASON, TIME).alias("updated_at"),
                "o_orderstatus",
                "o_orderpriority",
            )
        )

    @once
    def goals(self) -> DataFrame:
        """Goals of every order with lines, also of those without two nations."""
        lines = (
            self.table("lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.count_if(F.col("l_linestatus") == "O").cast("int").alias("home_goals"),
                F.count_if(F.col("l_linestatus") == "F").cast("int").alias("away_goals"),
            )
        )
        orders = self.table("orders")
        ingested = F.col("o_orderdate") + F.expr(INGEST_DELAY)
        return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
            F.col("o_orderkey").cast("string").alias("game_id"),
            "home_goals",
            "away_goals",
            ingested.alias("ingestion_time"),
            week_end(_week(F.col("o_orderdate")), SEASON, TIME).alias("updated_at"),
            "o_orderstatus",
            "o_orderpriority",
        )

    @once
    def schedule(self) -> DataFrame:
        between_nations = F.col("home_team") != F.col("away_team")
        return self.pairings().filter(between_nations).drop("o_orderstatus", "o_orderpriority")

    @once
    def scores(self) -> DataFrame:
        return (
            self.goals()
            .drop("o_orderstatus", "o_orderpriority")
            .withColumn("ingestion_date", F.to_date("ingestion_time"))
        )

    @once
    def facts(self) -> DataFrame:
        return match_facts(self.schedule(), self.scores())

    @once
    def history(self) -> DataFrame:
        first = SEASON.start + WEEK
        return standings_history(self.facts(), self.teams(), first, SEASON.end)

    @once
    def raw_scores(self) -> DataFrame:
        """Scores as text. Orders shipped in part carry gaps and unreadable values,
        finished ones come twice, urgent open ones again with another score."""
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        partly = status == "P"
        away = (
            F.when(partly & (priority == "1-URGENT"), F.lit(None))
            .when(partly & (priority == "2-HIGH"), "x")
            .otherwise(F.col("away_goals").cast("string"))
        )
        versions = (
            F.when(status == "F", F.array(away, away))
            .when((status == "O") & (priority == "1-URGENT"), F.array(away, F.lit("9")))
            .otherwise(F.array(away))
        )
        return self.goals().select(
            "game_id",
            F.concat(F.col("home_goals").cast("string"), F.lit(".0")).alias("home_goals"),
            F.explode(versions).alias("away_goals"),
            F.when(partly & (priority == "3-MEDIUM"), "no time")
            .otherwise(F.col("ingestion_time").cast("string"))
            .alias("ingestion_time"),
        )

    @once
    def raw_schedule(self) -> DataFrame:
        """Schedule as text, of the same kind."""
        status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
        partly = status == "P"
        number = F.when(partly & (priority == "4-NOT SPECIFIED"), "first").otherwise(
            F.concat(F.col("round").cast("string"), F.lit(".7"))
        )
        versions = F.when(status == "F", F.array(number, number)).otherwise(F.array(number))
        return self.pairings().select(
            "game_id",
            F.explode(versions).alias("round"),
            "home_team",
            F.when(partly & (priority == "5-LOW"), F.lit(None))
            .otherwise(F.col("away_team"))
            .alias("away_team"),
            F.col("game_start_time").cast("string").alias("game_start_time"),
        )


def _week(order_date: Column) -> Column:
    return week_index(order_date + F.expr(INGEST_DELAY), SEASON, TIME)
