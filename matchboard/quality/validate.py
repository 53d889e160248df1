"""Metrics of a check suite, the rows behind them, and what to do about them.

However many checks a suite has, a frame is read once for its row checks, which become
counters of one aggregate, and once for its group checks, which become grouping sets of
another. Checks against other tables take one pass each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from matchboard.operators.keys import anti_join, duplicate_keys, mark_keys, presence
from matchboard.quality.checks import (
    HasSchema,
    OncePer,
    OneOf,
    SameCount,
    SameIds,
    TimeBetween,
    TimeParses,
    Unique,
)


class ValidationError(AssertionError):
    """A strict suite failed; ``failed`` holds the metrics of the broken checks."""

    def __init__(self, failed: list[Row]):
        self.failed = failed
        super().__init__("; ".join(_describe(row) for row in failed))


def validate(df: DataFrame, checks: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """One row per check: check, target, violations, passed.

    With ``by`` the row, group and id checks are computed per group, for example
    per snapshot, and the group columns lead the result. A check on a column the
    frame does not have fails with null violations. ``check_no`` gives the order.
    """
    row_checks, group_checks, parts = [], [], []
    for number, check in enumerate(_unfold(checks), start=1):
        absent = [c for c in check.columns if c not in df.columns]
        if absent or isinstance(check, HasSchema):
            parts.append(_constant(df, number, check, absent, by))
        elif isinstance(check, SameIds):
            parts.append(_same_ids(number, check, by))
        elif isinstance(check, SameCount):
            parts.append(_same_count(df, number, check, by))
        elif isinstance(check, OneOf) and isinstance(check.allowed, DataFrame):
            parts.append(_one_of(df, number, check, by))
        elif isinstance(check, (Unique, OncePer)):
            group_checks.append((number, check))
        else:
            row_checks.append((number, check))
    if row_checks:
        parts.append(_row_metrics(df, row_checks, by))
    if group_checks:
        parts.append(_group_metrics(df, group_checks, by))
    metrics = reduce(DataFrame.unionByName, parts)
    passed = F.coalesce(F.col("violations") == 0, F.lit(False))
    return metrics.withColumn("passed", passed)


def violations(df: DataFrame, check) -> DataFrame:
    """What breaks a check: rows, or values with their count, or one-sided ids."""
    if isinstance(check, SameIds):
        return _one_sided(presence(check.tables, check.id_column), check)
    if isinstance(check, (Unique, OncePer)):
        return duplicate_keys(df, check.columns)
    if isinstance(check, OneOf) and isinstance(check.allowed, DataFrame):
        known = df.filter(F.col(check.column).isNotNull())
        return anti_join(known, check.allowed.toDF(check.column), check.column)
    if isinstance(check, TimeBetween):
        unreadable = TimeParses(check.column).broken(df)
        return df.filter(unreadable | check.broken(df))
    if isinstance(check, (HasSchema, SameCount)):
        raise TypeError(f"{check.name} has no violating rows")
    return df.filter(check.broken(df))


def violating_rows(df: DataFrame, checks: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Every row that breaks a check of a suite, once, with ``broken``: the check numbers.

    Numbers are those of ``validate``. Row checks are conditions on the scan. For a group
    check the keys that repeat (within ``by``) are joined to the rows, for a list of allowed
    values the values that are not on it, for ids the ids that a table lacks: all are reduced
    to distinct keys first, and null is a key like any other. Checks without rows of their
    own (schema, row counts, a column that is missing) are left out.
    """
    broken, frame = [], df
    for number, check in enumerate(_unfold(checks), start=1):
        if isinstance(check, (HasSchema, SameCount)) or any(c not in df.columns for c in check.columns):
            continue
        if isinstance(check, (Unique, OncePer)):
            keys = list(dict.fromkeys([*by, *check.columns]))
            bad = duplicate_keys(df, keys)
        elif isinstance(check, OneOf) and isinstance(check.allowed, DataFrame):
            keys = [check.column]
            known = df.select(check.column).where(F.col(check.column).isNotNull()).distinct()
            bad = anti_join(known, check.allowed.toDF(check.column), check.column)
        elif isinstance(check, SameIds):
            keys = [*by, check.id_column]
            if any(c not in df.columns for c in keys):
                continue
            bad = _one_sided(presence(check.tables, keys), check)
        else:
            broken.append(F.when(check.broken(df), number))
            continue
        flag = f"_broken_{number}"
        frame = mark_keys(frame, bad, keys, flag)
        broken.append(F.when(F.col(flag), number))
    if not broken:
        return df.limit(0).withColumn("broken", F.array().cast("array<int>"))
    tagged = frame.withColumn("broken", F.array_compact(F.array(*broken)))
    return tagged.where(F.size("broken") > 0).select(*df.columns, "broken")


def sample_values(df: DataFrame, check, n: int = 5) -> DataFrame:
    """The first ``n`` of the different values that break a check, in their order."""
    return violations(df, check).select(*check.columns).distinct().orderBy(*check.columns).limit(n)


def failures(metrics: DataFrame) -> DataFrame:
    """The broken checks, one row for each check and group."""
    return metrics.filter(~F.col("passed"))


def summary(metrics: DataFrame) -> list[Row]:
    """The broken checks in suite order, with all violations and the number of broken groups.

    One row per check reaches the driver, however many groups there are.
    """
    broken = failures(metrics).groupBy("check_no", "check", "target")
    exact = broken.agg(F.sum("violations").alias("violations"), F.count("*").alias("groups"))
    return exact.orderBy("check_no", "target").collect()


def enforce(metrics: DataFrame, mode: str = "strict") -> list[Row]:
    """Return the summary of broken checks; in strict mode raise with all of them."""
    if mode not in ("soft", "strict"):
        raise ValueError(f"mode must be soft or strict, not {mode}")
    failed = summary(metrics)
    if failed and mode == "strict":
        raise ValidationError(failed)
    return failed


def _unfold(checks: Sequence) -> list:
    out = []
    for check in checks:
        if isinstance(check, TimeBetween):
            out.append(TimeParses(check.column))
        out.append(check)
    return out


def _row_metrics(df: DataFrame, checks: list, by: Sequence[str]) -> DataFrame:
    counters = [F.count_if(check.broken(df)).alias(f"n{number}") for number, check in checks]
    return _unpivot(df.groupBy(*by).agg(*counters), checks, by)


def _group_metrics(df: DataFrame, checks: list, by: Sequence[str]) -> DataFrame:
    """Counters of all group checks from one pass: a grouping set for each different key.

    Values are grouped by their own types, and equal ones are merged before the shuffle.
    """
    keys = [tuple(c for c in dict.fromkeys(check.columns) if c not in by) for _, check in checks]
    different = list(dict.fromkeys(frozenset(key) for key in keys))
    columns = list(dict.fromkeys(c for key in keys for c in key))
    if len(different) == 1:
        copies = df.groupBy(*by, *columns).agg(F.count("*").alias("_copies"))
        copies = copies.withColumn("_set", F.lit(0))
    else:
        # A column by another name may be grouped and checked at once, also if it is one of ``by``.
        sets = [[*by, *(c for c in columns if c in key)] for key in different]
        grouped = df.select(*by, *columns).groupingSets(sets, *by, *columns)
        copies = grouped.agg(F.count("*").alias("_copies"), F.grouping_id(*by, *columns).alias("_id"))
        # grouping_id has a bit for each column that is not part of the set
        width = len(columns)
        ids = [sum(1 << (width - 1 - k) for k, c in enumerate(columns) if c not in key) for key in different]
        copies = copies.withColumn("_set", F.coalesce(*[F.when(F.col("_id") == x, k) for k, x in enumerate(ids)]))
    counters = []
    for (number, check), key in zip(checks, keys):
        own = F.when(F.col("_set") == different.index(frozenset(key)), check.surplus(F.col("_copies")))
        counters.append(F.coalesce(F.sum(own), F.lit(0)).alias(f"n{number}"))
    return _unpivot(copies.groupBy(*by).agg(*counters), checks, by)


def _same_ids(number: int, check: SameIds, by: Sequence[str]) -> DataFrame:
    ids = presence(check.tables, [*by, check.id_column])
    pairs = list(combinations(check.tables, 2))
    counters = [
        F.count_if(F.col(f"in_{a}") != F.col(f"in_{b}")).alias(f"n{i}")
        for i, (a, b) in enumerate(pairs)
    ]
    rows = [(number, check.name, f"{a} vs {b}", f"n{i}") for i, (a, b) in enumerate(pairs)]
    return _metrics(ids.groupBy(*by).agg(*counters), rows, by)


def _one_sided(ids: DataFrame, check: SameIds) -> DataFrame:
    flags = [F.col(f"in_{name}") for name in check.tables]
    return ids.filter(~reduce(Column.__and__, flags))


def _same_count(df: DataFrame, number: int, check: SameCount, by: Sequence[str]) -> DataFrame:
    ours = df.groupBy(*by).agg(F.count("*").alias("n"))
    theirs = check.other.groupBy(*by).agg((-F.count("*")).alias("n"))
    difference = ours.unionByName(theirs).groupBy(*by).agg(F.abs(F.sum("n")).alias("n"))
    return _metrics(difference, [(number, check.name, "rows", "n")], by)


def _one_of(df: DataFrame, number: int, check: OneOf, by: Sequence[str]) -> DataFrame:
    # Counted per value before the join, so a frequent value is one row in it.
    counts = df.groupBy(*by, check.column).agg(F.count("*").alias("n"))
    unknown = anti_join(counts, check.allowed.toDF(check.column), check.column)
    bad = F.sum(F.when(F.col(check.column).isNotNull(), F.col("n")))
    total = unknown.groupBy(*by).agg(F.coalesce(bad, F.lit(0)).alias("n"))
    if by:
        groups = counts.select(*by, F.lit(0).cast("bigint").alias("n"))
        total = total.unionByName(groups).groupBy(*by).agg(F.sum("n").alias("n"))
    return _metrics(total, [(number, check.name, _target(check), "n")], by)


def _constant(
    df: DataFrame, number: int, check, absent: list[str], by: Sequence[str]
) -> DataFrame:
    if absent:
        target, count = _target(check), "null"
    else:
        faults = check.faults(df)
        target, count = ", ".join(faults), str(len(faults))
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1)
    return _metrics(groups, [(number, check.name, target, count)], by)


def _unpivot(wide: DataFrame, checks: list, by: Sequence[str]) -> DataFrame:
    rows = [(number, check.name, _target(check), f"n{number}") for number, check in checks]
    return _metrics(wide, rows, by)


def _metrics(wide: DataFrame, rows: list[tuple], by: Sequence[str]) -> DataFrame:
    """Turn counters in columns into one metrics row each.

    One SQL expression, since building a long array column by column takes a call to
    the JVM for every piece.
    """
    structs = [
        f"struct({number} as check_no, {_quoted(name)} as check, {_quoted(target)} as target, "
        f"cast({count} as bigint) as violations)"
        for number, name, target, count in rows
    ]
    return wide.select(*by, F.expr(f"inline(array({', '.join(structs)}))"))


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _target(check) -> str:
    return ",".join(check.columns)


def _describe(row: Row) -> str:
    seen = "column missing" if row["violations"] is None else f"{row['violations']} violations"
    where = row.asDict()
    groups = where.get("groups", 1)
    return f"{row['check']} {row['target']}: {seen}" + (f" in {groups} groups" if groups > 1 else "")
