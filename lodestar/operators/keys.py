"""Join keys that do not collect null rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 4096


def with_spread_key(df: DataFrame, name: str, key: Column) -> DataFrame:
    """``df`` with the column ``name``: ``key`` as text, with nulls replaced by
    one of ``SPREAD`` values that no real key has (they start with a NUL), taken
    in turn by the rows of a partition.

    In a left or anti join a null key matches nothing, yet all null rows of a
    shuffled join meet in one task; with this key they are dealt evenly,
    whatever the other columns hold.  A rerun may deal them otherwise, which
    changes no result."""
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("string")
    return df.withColumn(name, F.coalesce(key.cast("string"), F.concat(F.lit("\u0000"), turn)))
