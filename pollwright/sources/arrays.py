"""Large JSON arrays of objects, cut into their elements by many tasks.

Spark's text reader, with the closing brace as the end of a line, deals a file out
in ranges of small pieces. Whether a piece starts inside a string, and how many
brackets are open there, depends on all before it: each range sums up its pieces for
either start, running sums over one row a range give the real starts, and
with these each range numbers the elements that end in it. Nothing is parsed here;
an element comes as its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pollwright.functions import paths
from pollwright.sources.ranges import shared

_RANGE = ["path", "_range"]


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _depth(bare: Column, inside: bool) -> Column:
    """By how much a piece, its closing brace included, changes the number of open brackets.

    ``bare`` is the piece without escapes, ``inside`` whether it starts in a string.
    """
    text = F.concat(F.lit('"'), bare) if inside else bare
    outside = F.regexp_replace(text, r'"[^"]*+(?:"|\z)', "")
    closes = _count(text, '"') % 2 == 0
    return _count(outside, "[{") - _count(outside, "]}") - closes.cast("int")


def _pieces(spark: SparkSession, files: str) -> DataFrame:
    """Pieces in the order of ``_id`` within a range, with their quotes and depths.

    A brace follows no backslash, so no escape is open at the start of a piece.
    """
    meta = F.col("_metadata")
    read = spark.read.option("lineSep", "}").text(files).select(
        paths.decoded(meta.file_path).alias("path"),
        meta.file_block_start.alias("_range"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    return read.withColumns(
        {"_quotes": _count(bare, '"'), "_from_out": _depth(bare, False), "_from_in": _depth(bare, True)}
    )


def elements(spark: SparkSession, files: str) -> DataFrame:
    """``path, pos, value``: the objects of each file's JSON array, from 0, as they are written.

    Files are named by a pattern. Pieces are shuffled once, by range, and written to the
    checkpoint folder; only elements that cross the border of a range move again.
    What stands between objects is left out. A file without an array of objects gives no rows.
    """
    order = W.partitionBy(*_RANGE).orderBy("_id")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy("path").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)

    def sum_before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    pieces = shared(_pieces(spark, files).withColumn("_odd", sum_before("_quotes", before) % 2))
    totals = pieces.groupBy(*_RANGE).agg(
        F.sum("_quotes").alias("_quotes"),
        F.sum(F.when(F.col("_odd") == 0, F.col("_from_out")).otherwise(F.col("_from_in"))).alias("_out"),
        F.sum(F.when(F.col("_odd") == 0, F.col("_from_in")).otherwise(F.col("_from_out"))).alias("_in"),
    )
    starts = (
        totals.withColumn("_start", sum_before("_quotes", earlier) % 2)
        .withColumn("_change", F.when(F.col("_start") == 0, F.col("_out")).otherwise(F.col("_in")))
        .select(*_RANGE, "_start", sum_before("_change", earlier).alias("_open"))
    )
    state = (F.col("_start") + F.col("_odd")) % 2
    known = pieces.join(starts, _RANGE).withColumn("_state", state)
    change = F.when(F.col("_state") == 0, F.col("_from_out")).otherwise(F.col("_from_in"))
    deep = F.col("_open") + F.sum(change).over(order)
    ends = ((F.col("_state") + F.col("_quotes")) % 2 == 0) & (deep == 1)
    ended = known.select(*_RANGE, "_id", "value", ends.cast("long").alias("_ends"))
    counts = ended.groupBy(*_RANGE).agg(F.sum("_ends").alias("_n"))
    numbered = ended.join(counts.select(*_RANGE, sum_before("_n", earlier).alias("_base"), "_n"), _RANGE).withColumn(
        "_nth", sum_before("_ends", before)
    )
    piece = F.struct("_range", "_id", "value")
    parts = numbered.groupBy(*_RANGE, "_base", "_n", "_nth").agg(
        F.collect_list(piece).alias("_pieces"), F.max("_ends").alias("_ends")
    ).withColumn("pos", F.col("_base") + F.col("_nth"))
    # the first element that ends in a range may have begun before it, what follows the last one goes on after it
    whole = (F.col("_nth") > 0) & (F.col("_nth") < F.col("_n"))
    crossing = parts.filter(~whole).groupBy("path", "pos").agg(
        F.flatten(F.collect_list("_pieces")).alias("_pieces"), F.max("_ends").alias("_ends")
    )
    found = parts.filter(whole).select("path", "pos", "_pieces", "_ends").unionByName(crossing)
    texts = F.transform(F.array_sort("_pieces"), lambda p: p["value"])
    text = F.regexp_replace(F.concat(F.array_join(texts, "}"), F.lit("}")), r"\A[^{]*+", "")
    return found.filter("_ends = 1").select("path", "pos", text.alias("value"))
