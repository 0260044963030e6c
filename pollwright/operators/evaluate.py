"""Scoring result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollwright.functions.answers import answer_section, identifier_set, with_items
from pollwright.functions.scoring import (
    DEFAULT_RULE,
    RULES,
    SET_TASKS,
    Reply,
    dispatch,
    rule_name,
)
from pollwright.functions.text import is_blank, normalise, strip


def is_skipped(skip: Column) -> Column:
    """``TRUE`` in any case and padding; null (no such column) means keep."""
    return F.coalesce(F.upper(strip(skip)) == "TRUE", F.lit(False))


_INPUTS = ["_raw", "_clean", "_found", "_expected", "_wanted", "_items", "_is_list"]


def _reply() -> Reply:
    return Reply(*map(F.col, _INPUTS))


def _prepared(results: DataFrame, answer: Column, name: Column) -> DataFrame:
    """Add a rule's inputs as columns.

    Each is used several times, so Catalyst keeps these projections apart
    instead of repeating their regular expressions inside the rules.
    """
    expected = F.coalesce(F.col("expected_answer"), F.lit(""))
    sets = F.col("_rule").isin(SET_TASKS)
    rows = (
        results.withColumns({"_raw": answer, "_rule": name, "_expected": expected})
        .withColumns(
            {
                "_clean": normalise(F.col("_raw")),
                "_wanted": F.when(~sets, F.lower(normalise(F.col("_expected")))),
            }
        )
        .withColumn("_found", F.when(sets, identifier_set(F.col("_clean"))))
    )
    return with_items(rows, F.col("expected_answer"), "_is_list", "_items")


def _judged(rows: DataFrame, right: Column) -> DataFrame:
    """Blank answers are wrong whatever the rule."""
    verdict = F.when(is_blank(F.col("_raw")), False).otherwise(right)
    return rows.withColumn("is_correct", verdict).drop("_rule", *_INPUTS)


def apply_rule(results: DataFrame, task: str) -> DataFrame:
    """Add boolean ``is_correct`` by one task's rule, on the response as it is."""
    rows = _prepared(results, F.col("Response"), F.lit(task))
    return _judged(rows, RULES.get(task, DEFAULT_RULE)(_reply()))


def score(results: DataFrame, task: str = "task") -> DataFrame:
    """Add boolean ``is_correct`` by each row's own task; map-only, no shuffle."""
    rows = _prepared(results, answer_section(F.col("Response")), rule_name(F.col(task)))
    return _judged(rows, dispatch(F.col("_rule"), _reply()))


def update_flags(scored: DataFrame) -> DataFrame:
    """New ``Correct`` text and ``changed``; skipped rows keep their old value."""
    old = F.col("Correct")
    new = F.when(is_skipped(F.col("skip")), old).otherwise(
        F.when(F.col("is_correct"), "True").otherwise("False")
    )
    return scored.withColumns({"Correct": new, "changed": ~new.eqNullSafe(old)})
