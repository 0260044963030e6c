"""Large quoted CSV files, read in ranges by many tasks.

Spark's text reader deals a file out in ranges of whole lines. Whether a range
starts inside a quoted field depends on all ranges before it, so a first pass
finds for either start how each range ends; a window over these few rows then
tells the real starts. With them, each task parses the records of its ranges;
the pieces of records that cross a border are put together by a small shuffle.
"""

from __future__ import annotations

import csv
import io
import re
import tempfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pollwright.constants import PROMPT_COLUMNS
from pollwright.functions import paths
from pollwright.functions.text import strip

#: Characters of whole records that are parsed at once.
CHUNK = 1 << 18

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"(?:[^",\r][^,\r]*+)?+|[^",\r][^,\r]*+|)'
_FROM_START = re.compile(rf"{_FIELD}(?:[,\r]{_FIELD})*+")
_FROM_QUOTED = re.compile(rf'[^"]*+(?:""[^"]*+)*+"(?:[^",\r][^,\r]*+)?+(?:[,\r]{_FIELD})*+')


def ends_quoted(line: str, quoted: bool) -> bool:
    """Whether a quoted field is open at the end of a line, given whether one is at its start.

    A quote opens a field at its start only; text after a closing quote is
    unquoted up to the next comma.
    """
    if '"' not in line:
        return quoted
    return (_FROM_QUOTED if quoted else _FROM_START).fullmatch(line) is None


def records(text: str) -> Iterator[list[str]]:
    return csv.reader(io.StringIO(text, newline=""))


def header_of(text: str) -> list[str]:
    try:
        return next(records(text), [])
    except csv.Error:
        return []


def valid_rows(text: str, header: list[str], after: int = 0) -> tuple[list[list[str]], bool]:
    """Rows with a case id, in the order of ``PROMPT_COLUMNS``, and whether some row can't be read.

    The first ``after`` records are passed over.
    """
    place = {name: i for i, name in enumerate(header)}
    key = place.get("case_id")
    wanted = [place.get(c, -1) for c in PROMPT_COLUMNS]
    rows = []
    try:
        for row in islice(records(text), after, None):
            if not row or key is None:
                continue
            if len(row) <= key:
                return rows, True
            if row[key].strip().startswith("case_"):
                rows.append([row[i] if 0 <= i < len(row) else "" for i in wanted])
    except csv.Error:
        return rows, True
    return rows, False


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which all executors reach.

    A folder of its own is set only for a local session that names none.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if not known.isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def shared(df: DataFrame) -> DataFrame:
    """Write a table to the checkpoint folder of the session and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def lines(spark: SparkSession, base: str, size: Column) -> DataFrame:
    """Lines of the result files below a folder whose size meets a condition, in file order in each partition.

    Only line feeds end a line here, so carriage returns stay as they are.
    """
    meta = F.col("_metadata")
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{paths.RESULT_SUFFIX}")
        .option("lineSep", "\n")
        .text(base)
        .filter(size)
        .select(
            paths.decoded(meta.file_path).alias("_path"),
            meta.file_block_start.alias("_range"),
            (meta.file_block_start + meta.file_block_length >= meta.file_size).alias("_last"),
            meta.file_size.alias("_size"),
            "value",
        )
    )


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[str], bool]]:
    """Neighbouring lines of one range: the other columns of its first line, the lines, whether they begin the range."""
    known = None
    for batch in batches:
        names = [n for n in batch.schema.names if n != "value"]
        keys = list(zip(batch["_path"].to_pylist(), batch["_range"].to_pylist(), strict=True))
        texts = batch["value"].to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                yield {n: batch[n][start].as_py() for n in names}, texts[start:i], keys[start] != known
                known, start = keys[start], i


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def closed(found: dict, head: list[str]) -> pa.RecordBatch:
        if found["_range"] == 0 and found["header"] is None and head:
            found["header"] = header_of("\n".join(head)) if not found["open"] else None
        names = ["_path", "_range", "_size", "from_start", "from_quoted", "bytes", "header"]
        return pa.RecordBatch.from_pylist([{n: found[n] for n in names}], _SUMMARY)

    found, head = None, []
    for meta, texts, begins in runs(batches):
        if begins:
            if found is not None:
                yield closed(found, head)
            found, head = meta | {"from_start": False, "from_quoted": True, "bytes": 0, "header": None, "open": True}, []
        for line in texts:
            if found["_range"] == 0 and found["open"]:
                head.append(line)
            found["from_start"] = ends_quoted(line, found["from_start"])
            found["from_quoted"] = ends_quoted(line, found["from_quoted"])
            found["bytes"] += len(line.encode("utf-8", "surrogatepass")) + 1
            found["open"] = found["open"] and found["from_start"]
    if found is not None:
        yield closed(found, head)


_SUMMARY = pa.schema([
    ("_path", pa.string()), ("_range", pa.int64()), ("_size", pa.int64()), ("from_start", pa.bool_()),
    ("from_quoted", pa.bool_()), ("bytes", pa.int64()), ("header", pa.list_(pa.string())),
])


def starts(texts: DataFrame) -> DataFrame:
    """``_path, _range, quoted, header, ended``: how each range starts, one row each.

    A range makes its end the same for both starts, keeps the start or swaps
    it. The start of a range is thus the last fixed end before it, swapped as
    often as ranges since then do.
    """
    schema = "_path string, _range long, _size long, from_start boolean, from_quoted boolean, bytes long, header array<string>"
    found = texts.select("_path", "_range", "_size", "value").mapInArrow(_summaries, schema)
    file = W.partitionBy("_path")
    before = file.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    so_far = file.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)
    swap = F.col("from_start") & ~F.col("from_quoted")
    fixed = F.when(F.col("from_start") == F.col("from_quoted"), F.struct(F.col("from_start").alias("end"), "swaps"))
    counted = found.withColumn("swaps", F.sum(swap.cast("long")).over(so_far))
    last = counted.withColumns({
        "_fixed": F.last(fixed, ignorenulls=True).over(before),
        "_swaps": F.coalesce(F.max("swaps").over(before), F.lit(0)),
    })
    odd = (F.col("_swaps") - F.coalesce("_fixed.swaps", F.lit(0))) % 2 == 1
    return last.select(
        "_path",
        "_range",
        (F.coalesce("_fixed.end", F.lit(False)) != odd).alias("quoted"),
        F.first("header", ignorenulls=True).over(file).alias("header"),
        (F.sum("bytes").over(file) == F.col("_size")).alias("ended"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Valid rows of whole records, pieces of the others, and a mark where a row can't be read.

    A piece has a ``place``: 0 for what ends a record of an earlier range, 1 for
    what starts one that goes on.
    """
    def rows(meta: dict, texts: list[str], after: int = 0) -> Iterator[dict]:
        found, bad = valid_rows("\n".join(texts), meta["header"] or [], after)
        for row in found:
            yield {"_path": meta["_path"], "row": row}
        if bad:
            yield {"_path": meta["_path"], "bad": True}

    def piece(meta: dict, texts: list[str], place: int, open_end: bool) -> dict:
        text = "\n".join(texts) + ("\n" if open_end and meta["_last"] and meta["ended"] else "")
        return {"_path": meta["_path"], "_range": meta["_range"], "place": place, "text": text, "header": meta["header"]}

    def results() -> Iterator[dict]:
        meta, held, begun, quoted, first, size = None, [], 0, False, False, 0

        def finish() -> Iterator[dict]:
            if meta is None:
                return
            if first:
                yield piece(meta, held, 0, True)
                return
            yield from rows(meta, held[:begun] if quoted else held)
            if quoted:
                yield piece(meta, held[begun:], 1, True)

        for now, texts, begins in runs(batches):
            if begins:
                yield from finish()
                meta, held, begun, size = now, [], 0, 0
                quoted, skip = now["quoted"], now["_range"] == 0
                first = quoted  # lines up to the end of a record that began in an earlier range
            for line in texts:
                held.append(line)
                size += len(line)
                quoted = ends_quoted(line, quoted)
                if quoted:
                    continue
                if first:
                    yield piece(meta, held, 0, False)
                    held, begun, size, first = [], 0, 0, False
                elif skip:
                    # the header, and rows that a lone carriage return parts from it
                    yield from rows(meta, held, 1)
                    held, begun, size, skip = [], 0, 0, False
                else:
                    begun = len(held)
                    if size > CHUNK:
                        yield from rows(meta, held)
                        held, begun, size = [], 0, 0
        yield from finish()

    def batched(found: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(found, _PIECE)

    held: list[dict] = []
    for result in results():
        held.append(result)
        if len(held) == 1000:
            yield batched(held)
            held = []
    if held:
        yield batched(held)


_PIECE = pa.schema([
    ("_path", pa.string()), ("_range", pa.int64()), ("place", pa.int32()), ("text", pa.string()),
    ("header", pa.list_(pa.string())), ("row", pa.list_(pa.string())), ("bad", pa.bool_()),
])


def _joined_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the records that crossed a border."""
    for batch in batches:
        out = []
        for path, text, header in zip(*(batch[c].to_pylist() for c in ("_path", "text", "header")), strict=True):
            found, bad = valid_rows(text, header or [])
            out += [{"_path": path, "row": row} for row in found]
            if bad:
                out.append({"_path": path, "bad": True})
        yield pa.RecordBatch.from_pylist(out, _FOUND)


_FOUND = pa.schema([("_path", pa.string()), ("row", pa.list_(pa.string())), ("bad", pa.bool_())])


def across_borders(pieces: DataFrame) -> DataFrame:
    """Whole texts of records that lie in several ranges: a start and all that follows up to the next start.

    Starts are numbered on narrow rows; texts are then grouped by record.
    """
    parts = pieces.filter("text is not null")
    order = W.partitionBy("_path").orderBy("_range", "place")
    numbered = parts.select("_path", "_range", "place").withColumn(
        "record", F.sum(F.col("place").cast("long")).over(order)
    )
    whole = F.array_sort(F.collect_list(F.struct("_range", "place", "text")))
    return (
        parts.join(numbered, ["_path", "_range", "place"])
        .groupBy("_path", "record")
        .agg(F.array_join(F.transform(whole, lambda p: p["text"]), "\n").alias("text"), F.first("header").alias("header"))
        .drop("record")
    )


def read_ranges(spark: SparkSession, base: str, size: Column) -> tuple[DataFrame, DataFrame]:
    """``_path, row`` of the files that read as CSV, and ``_path, record`` texts of the others.

    A file counts as CSV as a whole: it has a row with a case id, and no row ends before
    its case id or has a field over the limit of :mod:`csv`. One row a range is broadcast: at
    the default range of 128 MB, 0.8 million rows for 100 TB. The header must end inside
    the first range, and a record, like any value, has to stay under 2 GB.
    """
    texts = lines(spark, base, size)
    states = F.broadcast(starts(texts))
    known = texts.join(states, ["_path", "_range"])
    wanted = known.select("_path", "_range", "_last", "quoted", "header", "ended", "value")
    pieces = shared(wanted.mapInArrow(_pieces, _ddl(_PIECE)))
    crossing = across_borders(pieces).mapInArrow(_joined_rows, _ddl(_FOUND))
    found = pieces.filter("text is null").select("_path", "row", "bad").unionByName(crossing)
    judged = found.groupBy("_path").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"), F.count("row").alias("rows"))
    good = judged.filter("not bad and rows > 0").select("_path")
    rows = found.filter("row is not null").join(good, "_path", "left_semi").select("_path", "row")
    return rows, record_lines(texts.join(good, "_path", "left_anti"))


def _ddl(schema: pa.Schema) -> str:
    from pyspark.sql.pandas.types import from_arrow_schema

    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in from_arrow_schema(schema).fields)


def record_lines(texts: DataFrame) -> DataFrame:
    """``_path, record`` of files read by the starts of their lines, each file dealt over many tasks.

    A record starts at a line that begins with ``case_``, and goes on over the
    lines after it, into other ranges too. A file whose first line, the
    header, doesn't begin with ``case_id`` has none.
    """
    place = texts.select("_path", "_range", F.monotonically_increasing_id().alias("_line"), "value")
    parts = F.split(F.regexp_replace("value", r"\r\z", ""), "\r")
    each = place.select("_path", "_range", "_line", F.posexplode(parts).alias("_part", "text"))
    order = W.partitionBy("_path", "_range").orderBy("_line", "_part")
    header = (F.col("_range") == 0) & (F.row_number().over(order) == 1)
    named = each.withColumn("_header", header)
    begins = F.col("text").startswith("case_") & ~F.col("_header")
    counted = named.withColumn("_record", F.sum(begins.cast("long")).over(order))
    # lines before the first start of a range go on with the last record of the range before that has any
    ranges = counted.groupBy("_path", "_range").agg(
        F.max("_record").alias("_records"), F.max(F.col("_header") & F.col("text").startswith("case_id")).alias("_named")
    )
    before = W.partitionBy("_path").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    own = F.when(F.col("_records") > 0, F.struct("_range", F.col("_records").alias("_record")))
    states = ranges.select(
        "_path", "_range", F.last(own, ignorenulls=True).over(before).alias("_earlier"),
        F.max("_named").over(W.partitionBy("_path")).alias("_named"),
    ).filter("_named").drop("_named")
    key = F.when(F.col("_record") > 0, F.struct("_range", "_record")).otherwise(F.col("_earlier"))
    kept = counted.filter(~F.col("_header")).join(states, ["_path", "_range"]).withColumn("_key", key)
    whole = F.array_sort(F.collect_list(F.struct("_range", "_line", "_part", "text")))
    grouped = kept.filter("_key is not null").groupBy("_path", "_key").agg(whole.alias("_lines"))
    text = F.array_join(F.transform("_lines", lambda p: p["text"]), "\n")
    return grouped.select("_path", strip(text).alias("record"))
