"""Joins with a lookup table of measured size, and with another large table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows as text, added up by one aggregation.

    The optimizer's estimate can be ten times too small or too large for
    compressed files and for results of joins, so it can't bound a broadcast.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    broadcast_limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Join rows to a lookup table, which is broadcast if it measures under the limit.

    Beyond it, it is a join like any other: adaptive execution splits the
    partition of a hot key among tasks, whatever its size against the rest.
    """
    few = measured_bytes(lookup) <= broadcast_limit
    return rows.join(F.broadcast(lookup) if few else lookup, on, how)


def join_large(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join two tables of any size.

    Adaptive execution broadcasts a side that turns out small and splits the
    partitions of hot keys; no size is guessed beforehand.
    """
    return left.join(right, on, how)
