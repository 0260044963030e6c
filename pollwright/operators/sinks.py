"""Writers of prompt, result and report tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the folders of a result table.
FOLDER = ["dataset", "dir_task", "format"]

CSV = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_table(
    rows: DataFrame,
    path: str,
    partition_by: list[str],
    source: str = "parquet",
    mode: str = "errorifexists",
) -> None:
    """Write one folder per combination of the partition columns.

    The rebalance hint gathers each folder's rows in few files and lets Spark
    split a folder that holds much of the table between tasks.
    """
    options = CSV if source == "csv" else {}
    (
        rows.hint("rebalance", *partition_by)
        .write.partitionBy(*partition_by)
        .mode(mode)
        .format(source)
        .options(**options)
        .save(path)
    )


def write_prompts(rows: DataFrame, path: str, *leading: str, **how) -> None:
    """Prompt rows per dataset, task and format, below a variant or augmentation.

    Takes rows in the layout of :func:`operators.prompts.prompt_layout`; the
    task, a partition and a column at once, is also kept as ``dir_task``.
    """
    write_table(
        rows.withColumn("dir_task", rows["task"]), path, [*leading, "dataset", "dir_task", "format"], **how
    )


def write_results(scored: DataFrame, path: str, **how) -> None:
    """Scored rows as a new table, ``skip`` included; the input stays as it was."""
    write_table(scored, path, FOLDER, **how)


def changed_folders(updated: DataFrame, folder: list[str] = FOLDER) -> DataFrame:
    """All rows of the folders in which some row is ``changed``, without that column.

    Only the names of such folders are moved, and pruned by them the rows of
    other folders aren't read where the table is partitioned by ``folder``.
    """
    # a filter on rows would be pushed below the scoring and repeat it; one on groups is not
    names = updated.groupBy(*folder).agg(F.max("changed").alias("_any")).filter("_any").select(*folder)
    return updated.drop("changed").join(names, folder, "left_semi")


def _staged(path: str) -> str:
    return f"{path.rstrip('/')}__changed"


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def finish_rewrite(spark: SparkSession, path: str, folder: list[str] = FOLDER, source: str = "parquet") -> bool:
    """Put changed folders that lie complete beside a table in its place; whether there were any.

    The folders beside are kept until all are in place, so a job lost here, with
    some folders replaced or gone, is made good by doing this again.
    """
    staged = _staged(path)
    if not _exists(spark, f"{staged}/_SUCCESS"):
        return False
    from pollwright.sources.tables import read_table

    options = CSV if source == "csv" else {}
    (
        read_table(spark, staged, source).hint("rebalance", *folder)
        .write.partitionBy(*folder).mode("overwrite").format(source).options(**options)
        .option("partitionOverwriteMode", "dynamic").save(path)
    )
    gone = spark._jvm.org.apache.hadoop.fs.Path(staged)
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return True


def rewrite_changed(
    spark: SparkSession,
    path: str,
    update: Callable[[DataFrame], DataFrame],
    folder: list[str] = FOLDER,
    source: str = "parquet",
) -> bool:
    """Update a result table in place, only those folders in which a row is ``changed``; whether there were any.

    ``update`` takes the table's rows and returns them with ``changed``, as
    :func:`operators.evaluate.update_flags` does. Columns the table doesn't have
    are dropped. Changed folders are first written beside the table and then put in
    place of the old ones; other folders keep their files. A rewrite that
    was lost half-way is finished before the next one.
    """
    from pollwright.sources.tables import read_table

    finish_rewrite(spark, path, folder, source)
    rows = read_table(spark, path, source)
    updated = update(rows).select(*rows.columns, "changed")
    unnamed = F.col("changed") & F.greatest(*(F.col(c).isNull() for c in folder))
    # whether a changed row has no folder; none without changed rows
    worst = updated.agg(F.max(F.when(F.col("changed"), unnamed)).alias("unnamed")).first()["unnamed"]
    if worst is None:
        return False
    if worst:
        raise ValueError(f"changed rows without {', '.join(folder)}")
    write_table(changed_folders(updated, folder), _staged(path), folder, source, mode="overwrite")
    return finish_rewrite(spark, path, folder, source)


def write_documents(documents: DataFrame, path: str, **how) -> None:
    """Survey documents as a table, for collections of more files than a driver can list."""
    write_table(documents, path, ["dataset", "task", "format"], **how)


def report_frame(table: DataFrame, *leading: str) -> DataFrame:
    """A report as it is written: column ``Format``, in order of it."""
    return table.withColumnRenamed("format", "Format").orderBy(*leading, "Format")


def write_report(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A report of one row per format as a single CSV file."""
    report_frame(table).coalesce(1).write.mode(mode).csv(path, header=True)
