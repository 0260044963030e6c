"""Row filters on result and prompt tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pollwright.functions.text import strip
from pollwright.operators.evaluate import is_skipped


def valid_cases(results: DataFrame) -> DataFrame:
    """Rows whose case id, blanks aside, starts with ``case_``."""
    return results.filter(strip(F.col("case_id")).startswith("case_"))


def not_skipped(results: DataFrame) -> DataFrame:
    return results.filter(~is_skipped(F.col("skip")))


def in_slice(results: DataFrame, **wanted: str | None) -> DataFrame:
    """Keep one model, dataset, task or format; these prune partitions."""
    for name, value in wanted.items():
        if value is not None:
            results = results.filter(F.col(name) == value)
    return results


def case_number(case_id: Column) -> Column:
    """The number a case id ends in, null where it ends in none."""
    return F.regexp_extract(strip(case_id), r"(\d+)$", 1).try_cast("long")


def case_window(
    rows: DataFrame,
    group: list[str],
    tie_break: list[str],
    start_case: int = 2,
    max_cases: int | None = None,
    salts: int = 64,
) -> DataFrame:
    """Cases from number ``start_case`` on, at most ``max_cases`` per group.

    The rank limit is applied inside each map task first, so a group holding
    much of the table sends only ``max_cases`` rows per task to its ranking.
    Spark does that by itself up to its rank threshold; above it the group is
    ranked in salted parts before the parts are ranked together.
    """
    numbered = rows.withColumn("case_no", case_number(F.col("case_id"))).filter(F.col("case_no") >= start_case)
    if max_cases is None:
        return numbered
    order = ["case_no", *tie_break]

    def limit(df: DataFrame, keys: list) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("_rank", rank).filter(F.col("_rank") <= max_cases).drop("_rank")

    threshold = rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if max_cases > int(threshold):
        salt = F.pmod(F.xxhash64(*order), F.lit(salts))
        numbered = limit(numbered.withColumn("_salt", salt), [*group, "_salt"]).drop("_salt")
    return limit(numbered, group)
