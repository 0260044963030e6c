"""Readers of the tables that :mod:`pollwright.operators.sinks` writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pollwright.operators.sinks import CSV

#: Folder names hold text, also where they look like numbers.
KEYS = ["variant", "self_aug", "model", "dataset", "dir_task", "task", "format", "case_id"]


def read_table(spark: SparkSession, path: str, source: str = "parquet") -> DataFrame:
    """A prompt, result or document table with the columns of its folders.

    A filter on those columns keeps Spark from listing and reading other
    folders. CSV cells without a value are empty texts, as they were written.
    """
    options = {**CSV, "multiLine": True} if source == "csv" else {}
    reader = spark.read.format(source).options(**options)
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in KEYS else f.dataType) for f in reader.load(path).schema]
    )
    rows = reader.schema(schema).load(path)
    return rows.na.fill("") if source == "csv" else rows
