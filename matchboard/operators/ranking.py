"""Row numbers within groups of any size.

A plain ``row_number`` window sends a whole group to one task. ``rank_rows`` cuts
the sort order into slices first, numbers rows within (group, slice) and adds the
count of the earlier slices of the group. Spark's range partitioning makes the
slices. They are written with the rows, so every later read sees the same ones,
whatever is lost and run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchboard.sources.staging import stage


def rank_rows(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[tuple[str, str]],
    name: str = "ranking",
    slices: int = 1,
) -> DataFrame:
    """Add ``name``: the row number in each group under ``order``.

    ``order`` lists (column, "asc" | "desc"); it must be total within a group.
    ``slices=1`` is the plain window, in which one task streams a group from a sort.
    Give more, for example ``spark.sql.shuffle.partitions``, where a group is too large
    for that; the input is then written once while this function runs.
    """
    by = _sorting(order)
    if slices == 1:
        window = Window.partitionBy(*group_cols).orderBy(*by)
        return df.withColumn(name, F.row_number().over(window))

    # A struct of the group columns equals itself also where they are null.
    group = F.struct(*group_cols) if group_cols else F.lit(0)
    ranged = df.repartitionByRange(slices, *group_cols, *by)
    placed = stage(
        ranged.withColumns({"_slice": F.spark_partition_id(), "_group": group}), "ranking"
    )
    numbered = placed.withColumn(
        "_number", F.row_number().over(Window.partitionBy("_group", "_slice").orderBy(*by))
    )
    sizes = placed.groupBy("_group", "_slice").agg(F.count("*").alias("_size"))
    # At most one row per slice and group reaches this window.
    earlier = (
        Window.partitionBy("_group")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        "_group", "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    ranked = numbered.join(offsets, ["_group", "_slice"])
    rank = (F.col("_number") + F.col("_before")).cast("int")
    return ranked.select(*df.columns, rank.alias(name))


def top_rows(
    df: DataFrame,
    group_cols: Sequence[str],
    order: Sequence[tuple[str, str]],
    k: int,
    name: str = "ranking",
) -> DataFrame:
    """The first ``k`` rows of each group.

    Spark drops rows beyond ``k`` before the shuffle, so a task receives at most
    ``k`` rows of a group from each map task.
    """
    window = Window.partitionBy(*group_cols).orderBy(*_sorting(order))
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def _sorting(order: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.desc(c) if way == "desc" else F.asc(c) for c, way in order]
