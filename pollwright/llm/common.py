"""Helpers shared by the operators."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of ids up to this many rows (16 bytes each) may be broadcast.
BROADCAST_ROWS = 2_000_000
#: Bytes of text that a Python step works on at once.
BLOCK_BYTES = 400_000


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python a thousand at a time: a batch takes buffers on both sides.

    For sessions of this package's queries and pipeline; operators leave settings alone.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **named: str) -> DataFrame:
    """Only the named columns, renamed; other columns can't clash with later ones."""
    return df.select(*(df[source].alias(name) for name, source in named.items()))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset, as in tests, a temporary folder is set for a local master.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if not known.isDefined():
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table, broadcast if it has few enough rows; they are counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def semi_join(df: DataFrame, ids: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Rows of a wide table whose key is (or isn't) in a narrow table of distinct ids.

    The ids are counted; up to ``BROADCAST_ROWS`` they go to every executor
    and the wide rows stay where they are, beyond it both sides are shuffled.
    """
    return df.join(small(ids), on, how)


def sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows of at most so many keys, those of the smallest hash: the same ones on every run.

    Only keys are ranked; rows without key are left out.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return semi_join(df, keys.orderBy(F.xxhash64(key), key).limit(rows), key)


def slices(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of a batch with about so many bytes of text together."""
    sizes = np.cumsum([n or 0 for n in pc.binary_length(batch[column]).to_pylist()])
    begin = 0
    while begin < len(sizes):
        before = sizes[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, before + size, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def fold(key: Column, folds: int) -> Column:
    """crc32 of a key's text, modulo the number of folds; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))
