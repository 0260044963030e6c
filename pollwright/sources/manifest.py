"""Folders of very many files: listed by tasks, remembered, and read only where something changed.

Spark's own readers list files in the driver. Here a folder is one row and
tasks list its children, level by level, so the driver sees no path. A store
keeps what was read, in batches::

    {store}/files/batch=N   path, length, modified, present: what changed in batch N
    {store}/rows/batch=N    the rows parsed from the changed files, with their path

A batch counts once its ``files`` are complete, which are written last; what a
lost job left behind is overwritten by the next one. One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.functions import paths
from pollwright.sources import documents, qa_items, results
from pollwright.sources.ranges import shared

#: Paths a task hands on at once.
LISTED = 10_000
#: Bytes of files that a task reads.
TASK_BYTES = 64 << 20
#: Bytes of small files that a task hands on at once.
BATCH_BYTES = 4 << 20
_FILES = "path string, length long, modified long"


def qualified(spark: SparkSession, root: str) -> str:
    """The folder's address with its scheme, as tasks need it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/") or "/")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub(r"\Afile:/+", "file:///", system.makeQualified(path).toUri().toString())


def file_system(address: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"\As3[an]:", "s3:", address))


def _children(batches: Iterator[pd.DataFrame], address: str, files: bool) -> Iterator[pd.DataFrame]:
    """Files or folders right below each folder; hidden ones and those that don't exist are left out."""
    system, _ = file_system(address)
    wanted = fs.FileType.File if files else fs.FileType.Directory
    for batch in batches:
        for folder in batch["path"]:
            found = [
                (i.path, i.size, i.mtime_ns // 1000)
                for i in system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
                if i.type == wanted and not i.base_name.startswith(("_", "."))
            ]
            for at in range(0, len(found), LISTED):
                part = pd.DataFrame(found[at : at + LISTED], columns=["path", "length", "modified"])
                yield part if files else part[["path"]]


def list_files(spark: SparkSession, root: str, levels: int, name: str = ".*") -> DataFrame:
    """``path, length, modified`` (microseconds) of files ``levels`` folders below the root.

    ``name`` is a pattern for whole file names. The folders of each level are dealt to
    tasks, which list them; a folder's own listing passes one task in parts.
    """
    address = qualified(spark, root)
    found = spark.createDataFrame([(file_system(address)[1],)], "path string")
    tasks = spark.sparkContext.defaultParallelism
    for _ in range(levels):
        # a number of parts keeps adaptive execution from joining rows this small in one task
        found = found.mapInPandas(partial(_children, address=address, files=False), "path string").repartition(tasks, "path")
    listed = found.mapInPandas(partial(_children, address=address, files=True), _FILES)
    return listed.filter(F.regexp_extract("path", "[^/]+$", 0).rlike(rf"\A(?:{name})\z"))


def changes(listed: DataFrame, known: DataFrame) -> DataFrame:
    """``path, length, modified, present``: files that are new or differ from the known ones, and those gone."""
    old = known.select("path", F.col("length").alias("_length"), F.col("modified").alias("_modified"), F.lit(True).alias("_old"))
    both = listed.withColumn("present", F.lit(True)).join(old, "path", "full")
    same = F.col("length").eqNullSafe(F.col("_length")) & F.col("modified").eqNullSafe(F.col("_modified"))
    return both.filter(F.col("present").isNull() | F.col("_old").isNull() | ~same).select(
        "path", "length", "modified", F.coalesce("present", F.lit(False)).alias("present")
    )


def _read(batches: Iterator[pd.DataFrame], address: str) -> Iterator[pd.DataFrame]:
    system, _ = file_system(address)
    texts, size = {}, 0
    for batch in batches:
        for path in batch["path"]:
            with system.open_input_stream(path, compression=None) as opened:
                texts[path] = opened.read()
            size += len(texts[path])
            if size >= BATCH_BYTES:
                yield pd.DataFrame({"path": list(texts), "value": list(texts.values())})
                texts, size = {}, 0
    if texts:
        yield pd.DataFrame({"path": list(texts), "value": list(texts.values())})


def contents(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """``path, value`` of listed files, each a whole text; tasks read them, about ``TASK_BYTES`` each."""
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = files.select("path").repartition(tasks, "path")
    read = dealt.mapInPandas(partial(_read, address=qualified(spark, root)), "path string, value binary")
    return read.select("path", F.col("value").cast("string").alias("value"))


def _batches(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the complete batches; these are as many as there were scans."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{store.rstrip('/')}/files/batch=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(re.search(r"batch=(\d+)/_SUCCESS$", f.getPath().toString())[1]) for f in found or [])


def _history(spark: SparkSession, store: str, part: str, batches: list[int]) -> DataFrame:
    base = f"{store.rstrip('/')}/{part}"
    return spark.read.option("basePath", base).parquet(*(f"{base}/batch={n}" for n in batches))


def _latest(history: DataFrame) -> DataFrame:
    last = F.max_by(F.struct("length", "modified", "present", "batch"), "batch").alias("_last")
    return history.groupBy("path").agg(last).select("path", "_last.*")


def known_files(spark: SparkSession, store: str) -> DataFrame:
    """``path, length, modified`` of the files as last read; none before the first scan."""
    batches = _batches(spark, store)
    if not batches:
        return spark.createDataFrame([], _FILES)
    return _latest(_history(spark, store, "files", batches)).filter("present").select("path", "length", "modified")


def scan(
    spark: SparkSession,
    root: str,
    store: str,
    levels: int,
    parse: Callable[[DataFrame], DataFrame],
    name: str = ".*",
) -> int:
    """Bring a store up to date with a folder; how many files were new, changed or gone.

    ``parse`` takes ``path, value`` of the new and changed files and returns rows that
    keep ``path``. Without changes nothing is read and nothing written. A file is told
    changed by its length and time, as file systems tell it.
    """
    # a folder can change between two listings, so there is one
    found = shared(changes(list_files(spark, root, levels, name), known_files(spark, store)))
    n = found.count()
    if n:
        batch = max(_batches(spark, store), default=-1) + 1
        base = store.rstrip("/")
        parse(contents(spark, root, found.filter("present"))).write.mode("overwrite").parquet(f"{base}/rows/batch={batch}")
        found.write.mode("overwrite").parquet(f"{base}/files/batch={batch}")
    return n


def scanned(spark: SparkSession, store: str) -> DataFrame:
    """Rows of the files as last read, with their ``path``.

    Only the few names of files that have been read again or are gone are joined to the rows.
    """
    batches = _batches(spark, store)
    if not batches:
        raise ValueError(f"{store} holds no complete scan")
    files = _history(spark, store, "files", batches)
    latest = _latest(files).select("path", F.when(F.col("present"), F.col("batch")).alias("_valid"))
    outdated = (
        files.select("path", "batch").join(latest, "path").filter(~F.col("batch").eqNullSafe(F.col("_valid")))
    )
    rows = _history(spark, store, "rows", batches)
    if len(batches) > 1:
        rows = rows.join(outdated.select("path", "batch"), ["path", "batch"], "left_anti")
    return rows.drop("batch")


def scan_documents(spark: SparkSession, root: str, store: str) -> int:
    """Scan ``{root}/{dataset}/{task}/{format}/{case_id}.{format}``; :func:`scanned` gives their rows.

    An empty file is a document without text here; Spark's reader gives no row for it.
    """
    return scan(spark, root, store, 3, lambda files: documents.of_files(files, "path"))


def scan_items(spark: SparkSession, root: str, store: str) -> int:
    """Scan ``{root}/{dataset}/{dataset}_{task}_qa_pairs.json``, one JSON array each."""
    return scan(spark, root, store, 1, lambda files: qa_items.of_files(files, "path"), rf".*{paths.ITEMS_SUFFIX}\.json")


def scan_results(spark: SparkSession, root: str, store: str) -> int:
    """Scan ``{root}/{model}/{dataset}/{task}/*_{format}_converted_prompts.csv``, adding ``model``.

    Each file is one value; read those over a task's memory with :func:`sources.results.read_results`.
    """
    def rows(files: DataFrame) -> DataFrame:
        below = paths.relative_to(F.col("path"), qualified(spark, root))
        model = F.substring_index(below, "/", 1)
        rest = F.substring(below, F.length(model) + 2, F.length(below))
        keys = [value.alias(key) for key, value in paths.result_keys(rest).items()]
        named = files.select("path", "value", model.alias("model"), *keys).filter(F.col("format").isNotNull())
        return results.rows_of(named)

    return scan(spark, root, store, 3, rows, rf".*{re.escape(paths.RESULT_SUFFIX)}")


def catalogue(spark: SparkSession, store: str) -> DataFrame:
    """Distinct (dataset, task) of the item files in a store, from their names alone."""
    named = known_files(spark, store).select(
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("dataset"),
        F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("stem"),
    )
    return documents.tasks_of(named)


def models(spark: SparkSession, root: str, store: str) -> DataFrame:
    """Names of the models with result files in a store, from paths alone, in order."""
    below = paths.relative_to(F.col("path"), qualified(spark, root))
    return known_files(spark, store).select(F.substring_index(below, "/", 1).alias("model")).distinct().orderBy("model")
