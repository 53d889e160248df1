"""The checks a suite is made of.

Row checks say which rows violate them, group checks which values must not repeat,
table checks compare the frame with others. ``validate`` computes all checks of a
kind together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from matchboard.functions.casts import at, time_type, to_number, to_time


@dataclass(frozen=True)
class NotNull:
    column: str
    name = "not_null"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def broken(self, df: DataFrame) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between:
    """Numeric and within the closed range; null or text that is no number fails.

    Bounds may be columns, for limits that differ by row. Without bounds the check
    is "is a number".
    """

    column: str
    low: Any = None
    high: Any = None
    name = "between"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def broken(self, df: DataFrame) -> Column:
        value = to_number(self.column)
        bad = value.isNull()
        if self.low is not None:
            bad = bad | (value < _literal(self.low))
        if self.high is not None:
            bad = bad | (value > _literal(self.high))
        return bad


@dataclass(frozen=True)
class Differ:
    """Two columns differ in every row; two nulls are equal."""

    left: str
    right: str
    name = "differ"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.left, self.right)

    def broken(self, df: DataFrame) -> Column:
        return F.col(self.left).eqNullSafe(F.col(self.right))


@dataclass(frozen=True)
class TimeParses:
    """First half of ``TimeBetween``: the value is a timestamp."""

    column: str
    name = "time_parses"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def broken(self, df: DataFrame) -> Column:
        return to_time(self.column, time_type(df, self.column)).isNull()


@dataclass(frozen=True)
class TimeBetween:
    """A timestamp within the closed range; unreadable values are counted apart."""

    column: str
    start: datetime | Column
    end: datetime | Column
    name = "time_between"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def broken(self, df: DataFrame) -> Column:
        kind = time_type(df, self.column)
        moment = to_time(self.column, kind)
        outside = (moment < at(self.start, kind)) | (moment > at(self.end, kind))
        return F.coalesce(outside, F.lit(False))


@dataclass(frozen=True)
class OneOf:
    """Known values only; null passes, and a null in the list allows nothing else.

    ``allowed`` is a short list, or a one-column frame for lists of any length.
    """

    column: str
    allowed: Sequence[Any] | DataFrame
    name = "one_of"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def broken(self, df: DataFrame) -> Column:
        known = [value for value in self.allowed if value is not None]
        return F.col(self.column).isNotNull() & ~F.col(self.column).isin(known)


@dataclass(frozen=True)
class Unique:
    """No value twice; null counts as one value."""

    column: str
    name = "unique"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.column,)

    def surplus(self, copies: Column) -> Column:
        """Violations of a value that occurs ``copies`` times."""
        return copies - 1


@dataclass(frozen=True)
class OncePer:
    """Each value at most once per group, such as a team in a round."""

    group_cols: tuple[str, ...]
    column: str
    name = "once_per"

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.group_cols, self.column)

    def surplus(self, copies: Column) -> Column:
        return F.when(copies > 1, 1).otherwise(0)


@dataclass(frozen=True)
class HasSchema:
    """The expected columns exist with the expected types; others may exist too."""

    expected: StructType
    name = "schema"
    columns = ()

    def faults(self, df: DataFrame) -> list[str]:
        actual = {f.name: f.dataType.simpleString() for f in df.schema}
        wanted = {f.name: f.dataType.simpleString() for f in self.expected}
        missing = [f"{name} is missing" for name in sorted(set(wanted) - set(actual))]
        return missing or [
            f"{name} is {actual[name]}, not {kind}"
            for name, kind in wanted.items()
            if actual[name] != kind
        ]


@dataclass(frozen=True)
class SameIds:
    """The tables hold the same set of ids, checked for every pair of them."""

    tables: Mapping[str, DataFrame]
    id_column: str = "game_id"
    name = "same_ids"
    columns = ()


@dataclass(frozen=True)
class SameCount:
    """The frame has as many rows as another one."""

    other: DataFrame
    name = "same_count"
    columns = ()


def _literal(bound: Any) -> Column:
    return bound if isinstance(bound, Column) else F.lit(float(bound))
