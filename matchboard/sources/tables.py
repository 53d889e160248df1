"""Reading and writing of raw files, stored tables and exports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchboard.functions.casts import at, time_type
from matchboard.schemas import column_names

FORMAT = "parquet"
SNAPSHOT = "updated_at"
CORRUPT = "_corrupt_record"


def read_raw(
    spark: SparkSession, path: str | list[str], columns: str, keep_corrupt: bool = False
) -> DataFrame:
    """Headered CSV, every column text, matched by name without an inference pass.

    The header gives the columns and their order; those of ``columns`` that it has are
    returned, others are left out. Files of one call share a header; ``sources.landing``
    reads folders in which they differ. ``keep_corrupt`` adds the source line of rows with
    the wrong number of fields.
    """
    header = spark.read.option("header", True).csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in [*header, CORRUPT]])
    # A pruned read does not look at the fields it skips.
    reader = spark.read.schema(schema).option("header", True).option("columnPruning", False)
    rows = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    present = [name for name in column_names(columns) if name in header]
    return rows.select(*present, *([CORRUPT] if keep_corrupt else []))


def read_table(
    spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = FORMAT
) -> DataFrame:
    """A stored table by path.

    Give the schema for tables partitioned by snapshot: the type of a partition
    column is otherwise guessed from the folder names.
    """
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_snapshot(
    spark: SparkSession, path: str, moment: datetime, schema: StructType, fmt: str = FORMAT
) -> DataFrame:
    """One snapshot of a history table; the filter prunes to its folder."""
    df = read_table(spark, path, schema, fmt)
    return df.filter(F.col(SNAPSHOT) == at(moment, time_type(df, SNAPSHOT)))


def write_table(df: DataFrame, path: str, fmt: str = FORMAT) -> None:
    """Replace the whole table."""
    df.write.format(fmt).mode("overwrite").save(path)


def write_snapshots(
    df: DataFrame, path: str, fmt: str = FORMAT, replace_all: bool = False
) -> None:
    """Replace the snapshots present in ``df`` and leave the others, or replace all.

    Rows of a snapshot are brought together to avoid small files; the rebalance
    splits a snapshot that is too large for one file.
    """
    writer = df.hint("rebalance", SNAPSHOT).write.format(fmt).partitionBy(SNAPSHOT)
    scope = "static" if replace_all else "dynamic"
    writer.mode("overwrite").option("partitionOverwriteMode", scope).save(path)


def clear_snapshot(df: DataFrame, path: str, moment: datetime, fmt: str = FORMAT) -> None:
    """Replace one snapshot by nothing.

    A dynamic overwrite with no rows leaves the old folder as it is, so a rerun that
    comes out empty replaces that folder by an empty file of the same layout. A
    format with a log of its own is told which snapshot to replace.
    """
    text = moment.isoformat(sep=" ")
    empty = df.limit(0)
    if fmt == "delta":
        scope = f"{SNAPSHOT} = '{text}'"
        empty.write.format(fmt).mode("overwrite").option("replaceWhere", scope).save(path)
    else:
        folder = f"{SNAPSHOT}={text}".replace(":", "%3A")
        empty.drop(SNAPSHOT).write.format(fmt).mode("overwrite").save(f"{path}/{folder}")


def export_csv(df: DataFrame, path: str, order_by: Sequence[str] = ()) -> None:
    """Headered CSV files, written by the executors; sorted across files if asked."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").option("header", True).csv(path)


def named_teams(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """A short list of teams as a relation."""
    return spark.createDataFrame([(name,) for name in names], "team string")
