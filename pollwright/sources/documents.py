"""Survey documents, skip lists and the catalogue of tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.functions import paths


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """One row per file ``{root}/{dataset}/{task}/{format}/{case_id}.{format}``.

    Each file is one value; many small files share a task through Spark's file
    packing. Line ends of any kind become ``\\n``. Listing very many files takes
    the driver long; :mod:`sources.manifest` lists them in tasks and reads only
    what changed since the last time.
    """
    files = spark.read.text(f"{root.rstrip('/')}/*/*/*/*", wholetext=True)
    path = paths.decoded(F.col("_metadata.file_path")).alias("_path")
    return of_files(files.select(path, "value"), "_path").drop("_path")


def of_files(files: DataFrame, path: str) -> DataFrame:
    """Documents of file texts in ``value`` under their full paths, which stay; other files drop out."""
    keys = [c.alias(n) for n, c in paths.document_keys(F.col(path)).items()]
    content = F.regexp_replace("value", r"\r\n?", "\n").alias("content")
    return files.filter(paths.is_document(F.col(path))).select(path, *keys, content)


def read_skip_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (dataset, task, case_id) of a CSV whose header names them."""
    rows = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    return rows.select("dataset", "task", "case_id").na.fill("").distinct()


def catalogue(spark: SparkSession, root: str) -> DataFrame:
    """Distinct (dataset, task) named by files ``{dataset}/{dataset}_{task}_qa_pairs.json``."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/*{paths.ITEMS_SUFFIX}.json")
    named = files.select(
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("dataset"),
        F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("stem"),
    )
    return tasks_of(named)


def tasks_of(named: DataFrame) -> DataFrame:
    """Distinct (dataset, task) of rows with a dataset and a file stem."""
    task = paths.catalogue_task(F.col("stem"), F.col("dataset"))
    return named.select("dataset", task.alias("task")).distinct()
