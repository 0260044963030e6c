"""Prompt tables: question items joined with survey documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollwright.constants import (
    APPROACHES,
    EXAMPLE_MISSING,
    FORMATS,
    PROMPT_COLUMNS,
    VARIANTS,
)
from pollwright.functions import templates
from pollwright.operators.joining import join_large, join_lookup

CASE = ["dataset", "task", "case_id"]
SPREAD = ["dataset", "task", "case_id", "pos"]


def items_with_documents(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Each item with its document in every format there is one.

    ``documents`` has one row per case and format, so the formats multiply in
    the join and items without a document drop out.
    """
    return join_large(items, documents, CASE)


def missing_documents(items: DataFrame, documents: DataFrame, formats=FORMATS) -> DataFrame:
    """Items and formats without a document; reads document keys only."""
    wanted = items.select(
        *SPREAD, F.explode(F.array(*map(F.lit, formats))).alias("format")
    )
    return join_large(wanted, documents.select(*CASE, "format"), [*CASE, "format"], "left_anti")


def with_skip_flag(rows: DataFrame, skip_list: DataFrame, **limits) -> DataFrame:
    """``skip`` is TRUE for cases on the list, FALSE otherwise."""
    listed = skip_list.select(*CASE).distinct().withColumn("_listed", F.lit(True))
    joined = join_lookup(rows, listed, CASE, "left", **limits)
    flag = F.when(F.col("_listed"), "TRUE").otherwise("FALSE")
    return joined.withColumn("skip", flag).drop("_listed")


def worked_examples(items: DataFrame, documents: DataFrame) -> DataFrame:
    """Example text per dataset, task and format, from the first ``case_1`` item."""
    first = (
        items.filter(F.col("case_id") == "case_1")
        .groupBy("dataset", "task")
        .agg(F.min_by(F.struct("question", "expected_answer"), "pos").alias("item"))
    )
    shown = documents.filter(F.col("case_id") == "case_1")
    return shown.join(first, ["dataset", "task"]).select(
        "dataset",
        "task",
        "format",
        templates.example_text(
            F.col("content"), F.col("item.question"), F.col("item.expected_answer")
        ).alias("example"),
    )


def with_example(rows: DataFrame, items: DataFrame, documents: DataFrame, **limits) -> DataFrame:
    """Add ``example``, with a fixed note for groups that have none."""
    examples = worked_examples(items, documents)
    joined = join_lookup(rows, examples, ["dataset", "task", "format"], "left", **limits)
    return joined.withColumn(
        "example", F.coalesce("example", F.lit(EXAMPLE_MISSING))
    )


def examples_by_format(items: DataFrame, documents: DataFrame) -> DataFrame:
    """``example`` for each dataset, task and format that has documents."""
    formats = documents.select("dataset", "task", "format").distinct()
    examples = worked_examples(items, documents)
    return formats.join(examples, ["dataset", "task", "format"], "left").withColumn(
        "example", F.coalesce("example", F.lit(EXAMPLE_MISSING))
    )


def filled_prompts(
    items: DataFrame, documents: DataFrame, skip_list: DataFrame, **limits
) -> DataFrame:
    """Items with document, skip flag and filled template, sections untouched.

    The narrow item rows get skip flag and example before the wide documents
    join, so no document is shuffled for a lookup.
    """
    rows = join_lookup(
        with_skip_flag(items, skip_list, **limits),
        examples_by_format(items, documents), ["dataset", "task"], "inner", **limits,
    )
    rows = join_large(rows, documents, [*CASE, "format"])
    filled = templates.fill_placeholders(
        F.coalesce("prompt", F.lit("")),
        F.col("fields"),
        F.col("question"),
        F.col("case_id"),
        F.col("content"),
        F.col("example"),
    )
    return rows.withColumn("prompt", filled).drop("fields", "example")


def base_prompts(filled: DataFrame) -> DataFrame:
    """The plain prompt: the request section is left out."""
    return filled.withColumn("prompt", templates.drop_section(F.col("prompt"), "request"))


def variant_prompts(filled: DataFrame, variants=VARIANTS) -> DataFrame:
    """One row per ablation variant; the filled prompt is computed once."""
    names = F.explode(F.array(*map(F.lit, variants))).alias("variant")
    rows = filled.select("*", names)
    return rows.withColumn("prompt", templates.choose_variant(F.col("prompt"), F.col("variant")))


def augmented_prompts(filled: DataFrame, kinds=tuple(APPROACHES)) -> DataFrame:
    """One row per self-augmentation; sections are taken apart before the fan-out."""
    parts = filled.withColumns(
        {"_task": templates.task_body(F.col("prompt")), "_rest": templates.without_task(F.col("prompt"))}
    ).withColumn("_position", templates.output_position(F.col("_rest")))
    rows = parts.select("*", F.explode(F.array(*map(F.lit, kinds))).alias("self_aug"))
    prompt = templates.augment(
        F.col("_rest"), F.col("_position"), F.col("_task"), templates.approach_text(F.col("self_aug"))
    )
    return rows.withColumn("prompt", prompt).drop("_task", "_rest", "_position")


def prompt_layout(rows: DataFrame, *partition_columns: str) -> DataFrame:
    """Fixed columns in fixed order, response and verdict blank, after partition columns."""
    text = {
        "questionnaire": F.col("content"),
        "Response": F.lit(""),
        "Correct": F.lit(""),
        "question": F.coalesce("question", F.lit("")),
        "expected_answer": F.coalesce("expected_answer", F.lit("")),
    }
    columns = [text.get(c, F.col(c)).alias(c) for c in PROMPT_COLUMNS]
    return rows.select(*partition_columns, *columns)
