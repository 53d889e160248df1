"""Joins with an aggregate, where one key may own a large part of the rows.

Adaptive execution splits a hot partition of a sort-merge join only if both inputs are plain
shuffles. An aggregate by the join key would feed its own shuffle into the join, so both
sides are joined on the key and its hash: the aggregate, one row a key, is shuffled once
more, and the rows become splittable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH = "__key_hash"


def join_split(rows: DataFrame, single: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``single``, which has one row a key. Null keys match nothing."""
    probe = F.xxhash64(*keys)
    return rows.withColumn(HASH, probe).join(single.withColumn(HASH, probe), [*keys, HASH], how).drop(HASH)
