"""Queries over files: tables are written as the files a user has, and come back through the readers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.constants import FORMATS
from pollwright.functions import paths
from pollwright.plans import fixtures
from pollwright.plans.fixtures import table
from pollwright.plans.oracle import ITEMS, document_keys, items as sql_list
from pollwright.plans.registry import query
from pollwright.sources import manifest, qa_items
from pollwright.sources.manifest import file_system
from pollwright.sources.ranges import shared_folder


def _write(batches: Iterator[pd.DataFrame], address: str, form: tuple[str, str, str]) -> Iterator[pd.DataFrame]:
    system, folder = file_system(address)
    known, out = None, None

    def close() -> None:
        if out is not None:
            out.write(form[2].encode())
            out.close()

    for batch in batches:
        for path, value in zip(batch["path"], batch["value"], strict=True):
            if path != known:
                close()
                system.create_dir(f"{folder}/{path.rsplit('/', 1)[0]}", recursive=True)
                known, out = path, system.open_output_stream(f"{folder}/{path}")
                out.write(form[0].encode())
            else:
                out.write(form[1].encode())
            out.write(value.encode())
        yield batch[["path"]]
    close()


def write_files(rows: DataFrame, folder: str, form: tuple[str, str, str] = ("", "", "")) -> None:
    """Write rows ``path, pos, value`` as files below a folder, the rows of a path in order.

    ``form`` is what stands before, between and after the values of a file. Rows
    stream through, so a file may be of any size.
    """
    spark = rows.sparkSession
    dealt = rows.select("path", "pos", "value").repartition("path").sortWithinPartitions("path", "pos")
    written = dealt.mapInPandas(partial(_write, address=manifest.qualified(spark, folder), form=form), "path string")
    written.write.format("noop").mode("overwrite").save()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_CONTENT = r"regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g')"


@query(
    "s1_scanned_again",
    f"""SELECT {document_keys('doc_id')}, {sql_list(FORMATS)}[CAST(doc_id % 6 AS INT) + 1] AS format,
    md5({_CONTENT} || CASE WHEN doc_id % 10 = 0 THEN chr(10) || 'second edition' ELSE '' END) AS digest,
    (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) AS read_again FROM documents""",
)
def s1_scanned(spark, sf_dir):
    """Every document as a file; scanned, a tenth changed, and scanned again."""
    docs = table(spark, sf_dir, "documents")
    keys = fixtures.document_keys(F.col("doc_id"))
    kind = fixtures.pick(FORMATS, F.col("doc_id") % 6)
    path = F.concat_ws("/", keys["dataset"], keys["task"], kind, F.concat_ws(".", keys["case_id"], kind))
    files = docs.select("doc_id", path.alias("path"), F.lit(0).alias("pos"), F.coalesce("text", F.lit("")).alias("value"))
    folder = new_folder(spark, "documents")
    root, store = f"{folder}/in", f"{folder}/store"
    write_files(files, root)
    manifest.scan_documents(spark, root, store)
    later = F.concat("value", F.lit("\nsecond edition")).alias("value")
    write_files(files.filter("doc_id % 10 = 0").select("path", "pos", later), root)
    n = manifest.scan_documents(spark, root, store)
    return manifest.scanned(spark, store).select(
        "dataset", "task", "case_id", "format", F.md5("content").alias("digest"), F.lit(n).cast("long").alias("read_again")
    )


#: Conversations whose items share a file.
BLOCK = 100


@query(
    "s2_item_arrays",
    f"""WITH {ITEMS} SELECT 'block' || ((pos // 1000) // {BLOCK}) AS dataset, task,
    row_number() OVER (PARTITION BY (pos // 1000) // {BLOCK}, task ORDER BY pos) - 1 AS pos,
    case_id, question, expected_answer, md5(prompt) AS prompt, CAST(attempts AS VARCHAR) AS attempts,
    '[''a'', ' || attempts || '.0, True]' AS tags FROM items""",
)
def s2_arrays(spark, sf_dir):
    """Items as JSON arrays in files, cut into objects over ranges."""
    items = fixtures.question_items(spark, sf_dir)
    block = F.concat(F.lit("block"), F.floor(F.floor(F.col("pos") / 1000) / BLOCK))
    name = F.concat(block, F.lit("_"), "task", F.lit(f"{paths.ITEMS_SUFFIX}.json"))
    tags = F.concat(F.lit(',"tags":["a",'), F.col("attempts"), F.lit(".0,true]}"))
    value = F.concat(F.rtrim(F.to_json(F.struct(*fixtures.ITEM_FIELDS)), F.lit("}")), tags)
    root = new_folder(spark, "items")
    write_files(items.select(F.concat_ws("/", block, name).alias("path"), "pos", value.alias("value")), root, ("[", ",\n", "]\n"))
    field = lambda k: F.get(F.filter("fields", lambda f: f["key"] == k), F.lit(0))["value"]
    return qa_items.read_items(spark, root, "ranges").select(
        "dataset", "task", "pos", "case_id", "question", "expected_answer", F.md5("prompt").alias("prompt"),
        field("attempts").alias("attempts"), field("tags").alias("tags"),
    )
