"""Raw files, parsed once each and kept as stored rows of their ingestion week.

A ledger lists the files already read, with size, time of change and header. A run parses the
files that the ledger does not have as they are now, and adds them as one batch. Where a file
of a batch has changed or is gone, the batch is dropped and its other files are parsed again
with the new ones; so the rows always are those of the files there are. Nothing is written
when nothing has changed.

Files are read by header: those of another column order, or with more columns, are read by
their own. A column that any file lacks is left out, which the schema check reports.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from matchboard.operators.keys import anti_join
from matchboard.schemas import column_names
from matchboard.sources.tables import CORRUPT, read_raw
from matchboard.sources.versions import Transaction, _path

LEDGER = "raw/ledger"
WEEK = "ingestion_week"
_LEDGER = "source string, path string, length bigint, changed timestamp, header string, batch string"
_FILE = ["path", "length", "changed"]


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, changed of the files of a folder, or of one file; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("changed"))


def land(
    spark: SparkSession, tx: Transaction, name: str, path: str, columns: str, week: Column | None = None
) -> DataFrame:
    """The rows of all files of a source, as text; see above.

    ``week`` partitions them, as column ``ingestion_week``; null where it is unknown.
    """
    layout = StructType.fromDDL(_LEDGER)
    ledger = tx.read(LEDGER, layout)
    mine = ledger.where(F.col("source") == name)
    files = source_files(spark, path)
    outdated = {row["batch"] for row in anti_join(mine, files, _FILE).select("batch").distinct().collect()}
    valid = mine.where(~F.col("batch").isin(list(outdated))) if outdated else mine
    new = [tuple(row) for row in anti_join(files, valid, _FILE).collect()]  # file names, never rows
    if new or outdated:
        tx.leave_out(name, outdated)
        entries = []
        if new:
            headers = _headers(spark, [file for file, _, _ in new])
            batch = tx.add_batch(_parsed(spark, headers, columns, week), name, WEEK if week is not None else None)
            entries = [(name, *file, headers[file[0]], batch) for file in new]
        kept = ledger.where(F.col("source") != name).unionByName(valid)
        tx.write(kept.unionByName(spark.createDataFrame(entries, layout)), LEDGER)
        valid = tx.read(LEDGER, layout).where(F.col("source") == name)
    headers = [set(row["header"].split("\n")) for row in valid.select("header").distinct().collect()]
    present = [c for c in column_names(columns) if all(c in header for header in headers)]
    fields = [StructField(c, StringType()) for c in [*column_names(columns), CORRUPT]]
    schema = StructType(fields)
    if week is not None:
        schema = schema.add(WEEK, LongType())
    rows = tx.read(name, schema)
    return rows.select(*present, CORRUPT, *([WEEK] if week is not None else []))


def _parsed(spark: SparkSession, headers: dict[str, str], columns: str, week: Column | None) -> DataFrame:
    """New files, each read by its own header; one scan for all that share one."""
    parts = []
    for header in sorted(set(headers.values())):
        paths = [path for path, own in headers.items() if own == header]
        part = read_raw(spark, paths, columns, keep_corrupt=True)
        absent = {c: F.lit(None).cast("string") for c in column_names(columns) if c not in part.columns}
        parts.append(part.withColumns(absent) if absent else part)
    rows = reduce(DataFrame.unionByName, parts).select(*column_names(columns), CORRUPT)
    return rows if week is None else rows.withColumn(WEEK, week.cast("bigint"))


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """The column names of each file, one to a line; only its beginning is read."""

    def header(path: str) -> str:
        fs, place = _path(spark, path)
        names = spark.read.option("header", True).csv(path).columns if fs.getFileStatus(place).getLen() else []
        return "\n".join(names)

    with ThreadPoolExecutor(8) as pool:
        return dict(zip(paths, pool.map(header, paths)))
