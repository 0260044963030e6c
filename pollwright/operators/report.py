"""Accuracy tables.

:func:`accuracy` passes over the scored rows. It aggregates inside the map
tasks, so one row per group and task reaches the shuffle however skewed the
groups are. Its cells are lazy: for several reports, write them as a table and
derive the reports from that, or the rows are scored again for each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pollwright.constants import FORMATS
from pollwright.operators.evaluate import is_skipped

GROUP = ["dataset", "dir_task", "format"]


def percentage(correct: Column, total: Column) -> Column:
    """Share in percent, 0 for an empty group, not rounded."""
    return F.when(total > 0, correct / F.nullif(total, F.lit(0)) * 100).otherwise(F.lit(0.0))


def percentage_text(correct: Column, total: Column) -> Column:
    """One decimal and a percent sign, rounded from the exact binary value."""
    return F.concat(F.format_number(percentage(correct, total), 1), F.lit("%"))


def accuracy(scored: DataFrame, group: list[str] | None = None, file: str | None = None) -> DataFrame:
    """Correct and total of the rows not skipped, per group.

    A group whose rows are all skipped stays, with total 0. Rows of several files
    of one group are added up; where ``file`` names a column with the file of a row, the
    last file of each group, by its name, counts alone.
    """
    group = group or GROUP
    counted = ~is_skipped(F.col("skip"))
    totals = scored.groupBy(*group, *([file] if file else [])).agg(
        F.count_if(counted & F.col("is_correct")).alias("correct"),
        F.count_if(counted).alias("total"),
    )
    if file:
        # rows without a file come before all others
        place = F.struct(F.col(file).isNotNull(), F.col(file))
        last = F.max_by(F.struct("correct", "total"), place)
        totals = totals.groupBy(*group).agg(last.alias("_last")).select(*group, "_last.*")
    return totals.withColumn("percentage", percentage(F.col("correct"), F.col("total")))


def summarise(cells: DataFrame, *keys: str) -> DataFrame:
    """Add accuracy cells up by fewer keys, or to one grand total without any."""
    totals = cells.groupBy(*keys).agg(
        F.coalesce(F.sum("correct"), F.lit(0)).alias("correct"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
    )
    return totals.withColumn("percentage", percentage(F.col("correct"), F.col("total")))


def report_levels(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group, per task and overall in one pass, told apart by ``level``; all of it per ``by``."""
    by = list(by)
    sets = [[*by, *GROUP], [*by, GROUP[1]], by]
    totals = cells.groupingSets(sets, *by, *GROUP).agg(
        F.sum("correct").alias("correct"),
        F.sum("total").alias("total"),
        F.grouping_id().alias("level"),
    )
    return totals.withColumn("percentage", percentage(F.col("correct"), F.col("total")))


def _table(
    cells: DataFrame, cell: Column, tasks: Sequence[str] | None, formats: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Formats by the tasks seen, per ``by``; cells without questions read ``N/A``.

    Only the names of the tasks are brought to the driver, as they become columns.
    """
    by = list(by)
    if tasks is None:
        seen = cells.select("dir_task").filter("dir_task is not null").distinct().collect()
        tasks = sorted(r["dir_task"] for r in seen)
    totals = summarise(cells, *by, "format", "dir_task").filter(F.col("total") > 0)
    groups = cells.select(*by).distinct() if by else cells.sparkSession.range(1)
    each = F.explode(F.array(*(F.lit(f) for f in formats)))
    empty = groups.withColumn("format", each).withColumns(
        {"dir_task": F.lit(None).cast("string"), "shown": F.lit(None).cast("string")}
    )
    names = [*by, "format", "dir_task", "shown"]
    rows = totals.withColumn("shown", cell).filter(F.col("format").isin(*formats)).select(*names).unionByName(
        empty.select(*names)
    ).groupBy(*by, "format")
    shown = [
        F.coalesce(F.max(F.when(F.col("dir_task") == t, F.col("shown"))), F.lit("N/A")).alias(t) for t in tasks
    ]
    return (rows.agg(*shown) if shown else rows.agg(F.count("*")).select(*by, "format")).orderBy(*by, "format")


def count_table(cells: DataFrame, tasks=None, formats=FORMATS, by=()) -> DataFrame:
    """``correct/total`` per format and task, over all datasets."""
    text = F.concat_ws("/", F.col("correct").cast("string"), F.col("total").cast("string"))
    return _table(cells, text, tasks, formats, by)


def percentage_table(cells: DataFrame, tasks=None, formats=FORMATS, by=()) -> DataFrame:
    return _table(cells, percentage_text(F.col("correct"), F.col("total")), tasks, formats, by)


def distinct_sorted(rows: DataFrame, *names: str) -> DataFrame:
    """Distinct values in order, e.g. the models, datasets or tasks present."""
    return rows.select(*names).distinct().orderBy(*names)


def volume(results: DataFrame, file_keys: list[str]) -> DataFrame:
    """Files and records read; counted per file first, so no global distinct."""
    per_file = results.groupBy(*file_keys).agg(F.count("*").alias("n"))
    return per_file.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("records")
    )
