"""Declarative data-quality checks, computed in a fixed number of passes."""

from matchboard.quality.checks import (
    Between,
    Differ,
    HasSchema,
    NotNull,
    OncePer,
    OneOf,
    SameCount,
    SameIds,
    TimeBetween,
    Unique,
)
from matchboard.quality.validate import (
    ValidationError,
    enforce,
    failures,
    sample_values,
    summary,
    validate,
    violating_rows,
    violations,
)

__all__ = [
    "Between",
    "Differ",
    "HasSchema",
    "NotNull",
    "OncePer",
    "OneOf",
    "SameCount",
    "SameIds",
    "TimeBetween",
    "Unique",
    "ValidationError",
    "enforce",
    "failures",
    "sample_values",
    "summary",
    "validate",
    "violating_rows",
    "violations",
]
