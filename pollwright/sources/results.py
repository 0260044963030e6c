"""Result files: CSV read by header name, with recovery of files that are not CSV."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pollwright.constants import PROMPT_COLUMNS, RESULT_COLUMNS, TASKS
from pollwright.functions import paths
from pollwright.functions.text import strip, unescape_csv
from pollwright.sources import ranges

#: Files up to this size are read as one value.
WHOLE_BYTES = 64 << 20
KEYS = ["dataset", "dir_task", "format"]
ROW = T.StructType([T.StructField(c, T.StringType()) for c in PROMPT_COLUMNS])


def _keys(base: str) -> list[Column]:
    relative = paths.relative_to(F.col("_path"), base)
    return [c.alias(n) for n, c in paths.result_keys(relative).items()]


def discover(files: DataFrame, base: str) -> DataFrame:
    """Add dataset, task and format of a path; other files drop out."""
    return files.select("*", *_keys(base)).filter(F.col("format").isNotNull())


def _texts(spark: SparkSession, base: str, whole_bytes: int) -> DataFrame:
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{paths.RESULT_SUFFIX}")
        .text(base, wholetext=True)
        .filter(F.col("_metadata.file_size") <= whole_bytes)
        .select("value", paths.decoded(F.col("_metadata.file_path")).alias("_path"))
    )
    return discover(files, base)


def _valid_rows(text: str | None) -> list[dict[str, str]] | None:
    """Rows with a case id, by the names in the header; None if there are none."""
    try:
        rows = [
            {c: row.get(c) or "" for c in PROMPT_COLUMNS}
            for row in csv.DictReader(io.StringIO(text or "", newline=""))
            if row.get("case_id", "").strip().startswith("case_")
        ]
    except (csv.Error, AttributeError):  # not CSV, or a row that ends before its case id
        return None
    return rows or None


@F.pandas_udf(T.ArrayType(ROW))
def csv_rows(texts: pd.Series) -> pd.Series:
    """Valid rows of whole CSV texts; null where a text has to be recovered."""
    return texts.map(_valid_rows)


def file_rows(files: DataFrame) -> DataFrame:
    """Rows of file texts: those of well-formed files, or the ``record`` texts of the others.

    Each text is read once and told apart in its own row, so broken files need
    no list, no join and no second scan.
    """
    rows = files.withColumn("_rows", csv_rows("value"))
    kinds = [T.StructField("row", ROW), T.StructField("record", T.StringType())]
    found = F.when(
        F.col("_rows").isNotNull(),
        F.transform("_rows", lambda r: F.struct(r.alias("row"), F.lit(None).cast("string").alias("record"))),
    ).otherwise(
        F.transform(
            record_texts(F.col("value")),
            lambda t: F.struct(F.lit(None).cast(ROW).alias("row"), t.alias("record")),
        )
    )
    kept = [c for c in files.columns if c != "value"]
    return rows.select(*kept, F.inline(found.cast(T.ArrayType(T.StructType(kinds)))))


def _large(spark: SparkSession, base: str, whole_bytes: int) -> tuple[DataFrame, DataFrame] | None:
    """Rows and broken records of the files over a size; None if there are none.

    The size of the whole folder is asked for first, so a small collection
    starts no job; then a job looks at the lengths of files.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getContentSummary(folder).getLength() <= whole_bytes:
        return None
    sizes = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{paths.RESULT_SUFFIX}")
        .load(base)
        .select("length")
    )
    over = F.col("length") > whole_bytes
    if not sizes.filter(over).limit(1).count():
        return None
    rows, broken = ranges.read_ranges(spark, base, F.col("_metadata.file_size") > whole_bytes)
    return discover(rows, base), discover(broken, base)


def read_results(
    spark: SparkSession, base: str, whole_bytes: int = WHOLE_BYTES, with_file: bool = False
) -> DataFrame:
    """Rows of ``{base}/{dataset}/{task}/*_{format}_converted_prompts.csv``.

    Columns are found by the names in each file's header; missing ones are
    empty and others left out. A file without a valid row is recovered record
    by record. Files over ``whole_bytes`` are read in ranges by many tasks, with the
    same rows (:mod:`sources.ranges`); their parsed rows are written to the checkpoint
    folder, as whether a file is broken shows at its end only. ``with_file`` adds each
    row's ``file``, for reports in which the last file of a group counts.
    """
    keys = [*KEYS, F.col("_path").alias("file")] if with_file else KEYS
    found = rows_of(_texts(spark, base, whole_bytes)).select(*keys, *PROMPT_COLUMNS)
    large = _large(spark, base, whole_bytes)
    if large is None:
        return found
    rows, broken = large
    named = rows.select(*keys, *(F.col("row")[i].alias(c) for i, c in enumerate(PROMPT_COLUMNS)))
    parsed = parse_record(broken).filter(F.col("_r.problem").isNull())
    columns = [F.col(f"_r.{c}") if c != "skip" else F.lit("").alias(c) for c in PROMPT_COLUMNS]
    return found.unionByName(named).unionByName(parsed.select(*keys, *columns))


def rows_of(files: DataFrame) -> DataFrame:
    """Rows of file texts in ``value``, read by header name or recovered; other columns stay."""
    parsed = parse_record(file_rows(files))
    whole = F.col("record").isNull()
    named = [
        F.when(whole, F.col(f"row.{c}")).otherwise(F.col(f"_r.{c}") if c != "skip" else F.lit("")).alias(c)
        for c in PROMPT_COLUMNS
    ]
    kept = [c for c in files.columns if c != "value"]
    return parsed.filter(whole | F.col("_r.problem").isNull()).select(*kept, *named)


def quarantined(spark: SparkSession, base: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Records of broken files that cannot be recovered, with the reason."""
    rows = file_rows(_texts(spark, base, whole_bytes)).filter(F.col("record").isNotNull()).select(*KEYS, "record")
    large = _large(spark, base, whole_bytes)
    if large is not None:
        rows = rows.unionByName(large[1].select(*KEYS, "record"))
    return parse_record(rows).filter(F.col("_r.problem").isNotNull()).select(
        *KEYS, "record", F.col("_r.problem").alias("problem")
    )


def record_texts(value: Column) -> Column:
    """Texts of the records of a file whose header starts as it should.

    A record starts at a line beginning with ``case_``; the header line, which
    does too, is cut off first.
    """
    lines = F.regexp_replace(value, r"\r\n?", "\n")
    body = F.regexp_replace(lines, r"\A[^\n]*+\n?", "")
    records = F.filter(F.split(body, r"(?md)^(?=case_)"), lambda r: r.startswith("case_"))
    none = F.array().cast("array<string>")
    return F.when(value.startswith("case_id"), F.transform(records, strip)).otherwise(none)


# --- fixed values: record shape ---------------------------------------------
_TAIL = r"(?s)\A(.*?),([^,]*),\s*(True|False)\s*\z"
_HEAD = rf"(?s)\A(case_\w+),(?:({'|'.join(TASKS)}),)?(.*)\z"
# ----------------------------------------------------------------------------


#: What a record is made of where its fields are told apart: an escaped quote, one sign, or text between signs.
_TOKENS = r'\\"|["\\{}\[\],]|[^"\\{}\[\],]++'


def _outer_commas(tokens: Column) -> Column:
    """Which tokens are commas outside quotes, braces and brackets, counted from 1.

    The fold's state is whether a quote is open and how deep braces and
    brackets are nested. A quote after a backslash does not open or close;
    depth may go below zero.
    """
    def step(state: Column, token: Column) -> Column:
        plain = ~state["quoted"]
        depth = [
            (state[name] + F.when(plain & (token == up), 1).when(plain & (token == down), -1).otherwise(0)).alias(name)
            for name, up, down in (("braces", "{", "}"), ("brackets", "[", "]"))
        ]
        outside = plain & (token == ",") & (state["braces"] == 0) & (state["brackets"] == 0)
        at = state["at"] + 1
        found = F.when(outside, F.concat(state["found"], F.array(at))).otherwise(state["found"])
        return F.struct(at.alias("at"), (state["quoted"] != (token == '"')).alias("quoted"), *depth, found.alias("found"))

    begin = F.struct(
        F.lit(0).alias("at"), F.lit(False).alias("quoted"), F.lit(0).alias("braces"), F.lit(0).alias("brackets"),
        F.array().cast("array<int>").alias("found"),
    )
    return F.aggregate(tokens, begin, step, lambda state: state["found"])


def with_outer_fields(rows: DataFrame, text: Column, name: str) -> DataFrame:
    """Add the stripped fields between outer commas of a text; an empty last one does not count."""
    kept = rows.columns
    cut = rows.withColumn("_tokens", F.regexp_extract_all(text, F.lit(_TOKENS), F.lit(0)))
    cut = cut.withColumn("_commas", _outer_commas(F.col("_tokens")))
    ends = F.concat("_commas", F.array(F.size("_tokens") + 1))
    starts = F.concat(F.array(F.lit(0)), F.col("_commas"))
    parts = F.transform(
        F.arrays_zip(starts.alias("start"), ends.alias("end")),
        lambda p: strip(F.array_join(F.slice("_tokens", p["start"] + 1, p["end"] - p["start"] - 1), "")),
    )
    cut = cut.withColumn(name, parts)
    whole = F.when(F.element_at(name, -1) == "", F.slice(name, 1, F.size(name) - 1)).otherwise(F.col(name))
    return cut.select(*kept, F.when(text.isNotNull(), whole).alias(name))


def parse_record(rows: DataFrame) -> DataFrame:
    """Add ``_r``: the columns of each ``record`` and the ``problem`` that keeps it from having any."""
    record = F.col("record")
    has_tail = record.rlike(_TAIL)
    kept = rows.columns
    rows = rows.withColumns(
        {
            "_Response": strip(F.when(has_tail, F.regexp_extract(record, _TAIL, 2)).otherwise("")),
            "_Correct": F.when(has_tail, F.regexp_extract(record, _TAIL, 3)).otherwise(""),
            "_front": F.when(has_tail, F.regexp_extract(record, _TAIL, 1)).otherwise(record),
        }
    )
    rows = rows.withColumns(
        {
            "_case_id": F.regexp_extract("_front", _HEAD, 1),
            "_task": F.regexp_extract("_front", _HEAD, 2),
            "_rest": F.regexp_extract("_front", _HEAD, 3),
        }
    )
    headed = (F.col("_case_id") != "") & (F.col("_task") != "")
    rows = with_outer_fields(rows.withColumn("_rest", F.when(headed, F.col("_rest"))), F.col("_rest"), "_fields")
    # Filters do not pass a generator, so fields are told apart once per record.
    found = ["_Response", "_Correct", "_case_id", "_task", "_fields"]
    rows = rows.select(*kept, F.inline(F.array(F.struct(*found))))
    problem = (
        F.when(F.col("_case_id") == "", "no case id")
        .when(F.col("_task") == "", "no known task")
        .when(F.size("_fields") < 3, "fewer than three fields")
    )
    middle = ["question", "questionnaire", "expected_answer", "prompt"]
    text = {c: F.col(f"_{c}") for c in ("case_id", "task", "Response", "Correct")} | {
        c: F.coalesce(F.get("_fields", F.lit(i)), F.lit("")) for i, c in enumerate(middle)
    }
    columns = [unescape_csv(text[c]).alias(c) for c in RESULT_COLUMNS]
    return rows.select(*kept, F.struct(*columns, problem.alias("problem")).alias("_r"))


def parsed_records(files: DataFrame) -> DataFrame:
    """Columns of each record of malformed file texts, or the ``problem`` with it."""
    kept = [c for c in files.columns if c != "value"]
    records = files.select(*kept, F.explode(record_texts(F.col("value"))).alias("record"))
    return parse_record(records).select(*kept, "record", "_r.*")


def recovered(files: DataFrame) -> DataFrame:
    """Records of malformed file texts in the result columns."""
    return parsed_records(files).filter(F.col("problem").isNull()).drop("record", "problem")


def available_models(spark: SparkSession, root: str) -> DataFrame:
    """Sorted names of the model folders holding result files."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .load(root)
        .select(paths.decoded(F.col("_metadata.file_path")).alias("_path"))
    )
    model = F.get(F.split(paths.relative_to(F.col("_path"), root), "/"), F.lit(0))
    return files.select(model.alias("model")).distinct().orderBy("model")
