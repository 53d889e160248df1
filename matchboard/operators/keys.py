"""Key joins and key checks that hold when one key owns a large part of the rows.

``semi_join`` and ``anti_join`` reduce the key side to distinct keys, which the
map-side aggregate does before the shuffle. A hot key on the row side is left to
the skew split of adaptive execution. That split needs both inputs of the
sort-merge join to be plain shuffles, and a distinct would otherwise feed its own
shuffle straight into the join; joining on the key and its hash makes Spark shuffle
the distinct keys once more, which is cheap, and the row side becomes splittable.
A small key side still becomes a broadcast join, by Spark's own size check.

Both sides are cast to their common type before the hash is taken, as equal values of
two types hash apart. Text with a collation compares equal where its bytes differ, so
such keys are joined without the hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType



def semi_join(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    return _probe(df, other, key, "left_semi")


def anti_join(df: DataFrame, other: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; null keys stay."""
    return _probe(df, other, key, "left_anti")


def _probe(df: DataFrame, other: DataFrame, key: str | Sequence[str], how: str) -> DataFrame:
    left, right, on = _aligned(df, other.select(*_names(key)), _names(key), ())
    return left.join(right, on, how).select(*df.columns)


def attach(
    df: DataFrame, other: DataFrame, key: str | Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows of ``df`` once for each distinct value of ``columns`` their key has in ``other``."""
    left, right, on = _aligned(df, other, _names(key), columns)
    return left.join(right, on).select(*df.columns, *columns)


def mark_keys(df: DataFrame, keys: DataFrame, key: str | Sequence[str], flag: str) -> DataFrame:
    """``df`` with a column ``flag``: true where its key occurs in ``keys``, null keys included.

    ``keys`` are distinct and have the types of ``df``; the hash keeps a hot key splittable.
    """
    names = _names(key)
    taken = {c.lower() for c in df.columns} | {flag}
    on = [_free(f"_key_{i}", taken) for i in range(len(names))]
    hashed, probe = _free("_key_hash", taken), _free("_probe", taken)
    right = keys.select(*[F.col(c).alias(n) for c, n in zip(names, on)], F.lit(True).alias(flag))
    right = right.withColumn(hashed, F.xxhash64(*on))
    left = df.withColumn(probe, F.xxhash64(*names))
    same = F.col(probe) == F.col(hashed)
    for name, other in zip(names, on):
        same = same & F.col(name).eqNullSafe(F.col(other))
    joined = left.join(right, same, "left")
    return joined.select(*df.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _aligned(
    df: DataFrame, other: DataFrame, keys: list[str], columns: Sequence[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with equal-typed key columns to join on, the right one distinct."""
    common = df.select(*keys).limit(0).union(other.select(*keys).limit(0)).schema
    taken = {c.lower() for c in (*df.columns, *columns)}
    on = [_free(f"_key_{i}", taken) for i in range(len(keys))]
    typed = {name: F.col(key).cast(field.dataType) for name, key, field in zip(on, keys, common)}
    right = other.select(*[c.alias(n) for n, c in typed.items()], *columns).distinct()
    left = df.withColumns(typed)
    if all(not isinstance(f.dataType, StringType) or _binary(f.dataType) for f in common):
        name, probe = _free("_key_hash", taken), F.xxhash64(*on)
        left, right = left.withColumn(name, probe), right.withColumn(name, probe)
        on = [*on, name]
    return left, right, on


def _free(name: str, taken: set[str]) -> str:
    """The name, with underscores in front as long as a column has it."""
    while name in taken:
        name = f"_{name}"
    return name


def _binary(kind: StringType) -> bool:
    return kind.collation == "UTF8_BINARY"


def reconcile(
    left: DataFrame, right: DataFrame, key: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both frames without the rows whose key the other one lacks."""
    return semi_join(left, right, key), semi_join(right, left, key)


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    return counts.filter(F.col("copies") > 1)


def duplicate_rows(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once."""
    return semi_join(df, duplicate_keys(df, key), key)


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    """Rows, distinct values (null is one value) and surplus rows of each column.

    Each column is grouped by its own type, so 0.0 and -0.0 are one value, and Spark
    merges equal values before the shuffle.
    """
    parts = [
        df.groupBy(c)
        .agg(F.count("*").alias("n"))
        .agg(
            F.lit(c).alias("column"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count("*").alias("distinct_values"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"),
        )
        for c in columns
    ]
    return reduce(DataFrame.unionByName, parts)


def presence(tables: dict[str, DataFrame], key: str | Sequence[str]) -> DataFrame:
    """One row per distinct key with a flag ``in_<name>`` for each table.

    One aggregation over the union of the key columns, whatever the number of
    tables; a null key is a key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    tagged = None
    for name, df in tables.items():
        part = df.select(*keys, *[F.lit(n == name).alias(f"in_{n}") for n in tables])
        tagged = part if tagged is None else tagged.unionByName(part)
    flags = [F.bool_or(f"in_{name}").alias(f"in_{name}") for name in tables]
    return tagged.groupBy(*keys).agg(*flags)


def missing_keys(
    left: DataFrame, right: DataFrame, key: str | Sequence[str]
) -> DataFrame:
    """Distinct keys that only one side has, with flags ``in_left`` and ``in_right``."""
    both = presence({"left": left, "right": right}, key)
    return both.filter(F.col("in_left") != F.col("in_right"))
