"""Question items: JSON objects with four known keys and any others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pollwright.functions import paths
from pollwright.functions.text import printed_double
from pollwright.sources import arrays

_MAP = "map<string,variant>"
_READ = "map<string,string>"


def _quoted(text: Column) -> Column:
    """A string the way a printed list shows it."""
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    double = F.concat(F.lit('"'), escaped, F.lit('"'))
    return F.when(text.contains("'") & ~text.contains('"'), double).otherwise(single)


def _scalar(value: Column, read: Column) -> Column:
    """A value as it is printed; ``read`` is its text, in which only doubles have a point or an exponent."""
    double = read.rlike(r"\A-?\d+(?:\.\d+)?(?:E-?\d+)?\z") & read.rlike("[.E]")
    return (
        F.when(F.is_variant_null(value) | value.isNull(), "None")
        .when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(read))
        .when(double, printed_double(read.try_cast("double")))
        .otherwise(read)
    )


def printed(value: Column, read: Column) -> Column:
    """A JSON value as text: strings as they are, lists in printed form.

    ``read`` is the same value read as a string: texts come as they are and all else as JSON.
    """
    kind = F.schema_of_variant(value)
    items = F.transform(
        F.arrays_zip(
            F.try_variant_get(value, "$", "array<variant>").alias("v"), F.from_json(read, "array<string>").alias("r")
        ),
        lambda i: F.when(F.schema_of_variant(i["v"]) == "STRING", _quoted(i["r"])).otherwise(_scalar(i["v"], i["r"])),
    )
    listed = F.concat(F.lit("["), F.array_join(items, ", ", "None"), F.lit("]"))
    nested = kind.startswith("OBJECT") | kind.contains("ARRAY<ARRAY") | kind.contains("ARRAY<OBJECT")
    return (
        F.when(kind == "STRING", read)
        .when(nested, F.to_json(value))
        .when(kind.startswith("ARRAY"), listed)
        .otherwise(_scalar(value, read))
    )


def _with_fields(rows: DataFrame, entries: Column, read: Column, *kept: str) -> DataFrame:
    """Known keys as columns; all keys, in their own order, as ``fields``; ``kept`` columns stay."""
    fields = F.transform(
        F.arrays_zip(F.map_entries(entries).alias("v"), F.map_values(read).alias("r")),
        lambda e: F.struct(
            e["v"]["key"].alias("key"),
            printed(e["v"]["value"], e["r"]).alias("value"),
            (F.schema_of_variant(e["v"]["value"]) == "STRING").alias("is_text"),
        ),
    )
    value = lambda k: F.get(
        F.filter(F.col("fields"), lambda f: f["key"] == k), F.lit(0)
    )["value"]
    known = [value(k).alias(k) for k in ("question", "expected_answer", "prompt")]
    case_id = F.coalesce(value("case_id"), F.lit("")).alias("case_id")
    return rows.withColumn("fields", fields).select(
        *kept, "dataset", "task", "pos", case_id, *known, "fields"
    )


def items_from_objects(rows: DataFrame, json: str = "value") -> DataFrame:
    """Items of rows (dataset, task, pos) holding one JSON object each."""
    parsed = rows.withColumns(
        {"_entries": F.from_json(F.col(json), _MAP), "_read": F.from_json(F.col(json), _READ)}
    )
    return _with_fields(parsed, F.col("_entries"), F.col("_read"))


def read_items(spark: SparkSession, root: str, layout: str = "array") -> DataFrame:
    """Items of files ``{root}/{dataset}/{dataset}_{task}_qa_pairs.json``.

    ``array`` files hold one JSON array each, read as a whole; with ``ranges`` such
    arrays of objects are cut into items by many tasks (:mod:`sources.arrays`), whatever
    their size; with ``lines`` each line is an object.
    """
    folder = f"{root.rstrip('/')}/*/*{paths.ITEMS_SUFFIX}.json"
    if layout == "ranges":
        objects = arrays.elements(spark, folder)
        return items_from_objects(objects.select(*_keys("path"), "pos", "value"))
    files = spark.read.text(folder, wholetext=layout == "array")
    rows = files.select(paths.decoded(F.col("_metadata.file_path")).alias("_path"), "value")
    if layout == "array":
        return of_files(rows, "_path").drop("_path")
    return items_from_objects(
        rows.filter(F.trim("value") != "")
        .select(*_keys("_path"), F.monotonically_increasing_id().alias("pos"), "value")
    )


def _keys(path: str) -> list[Column]:
    stem = F.regexp_extract(path, r"([^/]+)\.json$", 1)
    dataset = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return [dataset.alias("dataset"), paths.catalogue_task(stem, dataset).alias("task")]


def of_files(files: DataFrame, path: str) -> DataFrame:
    """Items of file texts in ``value``, one JSON array each, under their full paths, which stay."""
    both = F.arrays_zip(
        F.from_json(F.col("value"), f"array<{_MAP}>").alias("v"), F.from_json(F.col("value"), f"array<{_READ}>").alias("r")
    )
    items = files.select(path, *_keys(path), F.posexplode(both).alias("pos", "_both"))
    items = items.withColumn("pos", F.col("pos").cast("long"))
    return _with_fields(items, F.col("_both.v"), F.col("_both.r"), path)
