"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a hash. A bucket that holds more
bytes than a shard may have is split on another bit; other buckets stay as they
are, so shards differ in depth and each fits its limit. Bytes are added up for
prefixes of ``LEVEL_BITS`` bits; only where such a prefix is still too large are
its rows counted again by further bits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pollwright.llm.common import columns, cut, small

HASH_BITS = 60
LEVEL_BITS = 12
SHARD_BYTES = 32 << 20
#: Rows of one overfull group that are numbered in one part.
PART_ROWS = 100_000


def hash_code(key: Column, text: Column) -> Column:
    """60 bits of the md5 of id and text: rows differ in it unless they are copies."""
    both = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(both.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def prefix(bits: int) -> Column:
    return F.shiftright("_code", HASH_BITS - bits)


def directory(rows: DataFrame, base: int, limit: int) -> DataFrame:
    """``_prefix`` of ``base + LEVEL_BITS`` bits, ``_depth`` and ``_bytes`` of its shard.

    ``_depth`` is null where all these bits leave more bytes than the limit.
    """
    deepest = base + LEVEL_BITS
    parts = cut(
        rows.groupBy(prefix(deepest).alias("_prefix")).agg(F.sum("_total").alias("_bytes"))
    )
    depths = F.explode(F.sequence(F.lit(base), F.lit(deepest))).alias("_depth")
    split = parts.select("_prefix", "_bytes", depths)
    bucket = F.expr(f"shiftright(_prefix, {deepest} - _depth)")
    fitting = split.groupBy("_depth", bucket.alias("_bucket")).agg(
        F.sum("_bytes").alias("_sum")
    ).filter(F.col("_sum") <= limit)
    shard = split.withColumn("_bucket", bucket).join(fitting, ["_depth", "_bucket"]).groupBy(
        "_prefix"
    ).agg(F.min(F.struct("_depth", F.col("_sum"))).alias("_s"))
    return parts.select("_prefix").join(shard, "_prefix", "left").select(
        "_prefix", F.col("_s._depth").alias("_depth"), F.col("_s._sum").alias("_bytes")
    )


def assign(
    df: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, shard, shard_depth, shard_bytes`` for every row.

    ``n_bytes`` is the text in UTF-8 (null: 0). ``shard`` is ``s`` and the bits
    of its prefix. Copies of one row share all bits: where they alone exceed the
    limit they are dealt over numbered pages (``s…-0``, ``s…-1`` and so on) of as
    many copies as fit. A single text over the limit has a page of its own, the
    only shard above the limit. A null id counts as empty. An empty table gives
    no rows; other columns are left out.
    """
    return placed(df, limit, id_col, text_col).drop("_code")


def placed(df: DataFrame, limit: int, id_col: str, text_col: str) -> DataFrame:
    """What ``assign`` gives, and the hash ``_code``."""
    docs = columns(df, doc_id=id_col, _text=text_col)
    rows = cut(
        docs.select(
            "doc_id",
            F.octet_length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_bytes"),
            hash_code(F.col("doc_id"), F.col("_text")).alias("_code"),
        ).groupBy("doc_id", "n_bytes", "_code").agg(F.count("*").alias("_copies"))
        .withColumn("_total", F.col("n_bytes") * F.col("_copies"))
    )
    left, done = rows, []
    for base in range(0, HASH_BITS, LEVEL_BITS):
        found = cut(directory(left, base, limit))
        there = left.withColumn("_prefix", prefix(base + LEVEL_BITS)).join(small(found), "_prefix")
        done.append(there.filter("_depth is not null").drop("_prefix"))
        left = there.filter("_depth is null").select(*rows.columns)
        if base + LEVEL_BITS < HASH_BITS and found.filter("_depth is null").isEmpty():
            left = left.limit(0)
            break
    fit = reduce(DataFrame.unionByName, done)
    bits = F.expr(f"lpad(bin(shiftright(_code, {HASH_BITS} - _depth)), _depth, '0')")
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    kept = fit.select(
        "_code", "doc_id", "n_bytes", F.concat(F.lit("s"), bits).alias("shard"),
        F.col("_depth").alias("shard_depth"), F.col("_bytes").alias("shard_bytes"), copies,
    )
    # copies of one row: pages of as many as fit
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1)))).cast("long")
    last = F.floor((F.col("_copies") - 1) / room).cast("long")
    pages = left.select("*", room.alias("_room")).withColumn(
        "_page", F.explode(F.sequence(F.lit(0).cast("long"), last))
    ).withColumn(
        "_held", F.least(F.col("_room"), F.col("_copies") - F.col("_page") * F.col("_room"))
    ).repartition("_code", "_page")
    all_bits = F.lpad(F.bin("_code"), HASH_BITS, "0")
    paged = pages.select(
        "_code", "doc_id", "n_bytes", F.concat_ws("-", F.concat(F.lit("s"), all_bits), "_page").alias("shard"),
        F.lit(HASH_BITS).alias("shard_depth"),
        (F.col("_held") * F.col("n_bytes")).alias("shard_bytes"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("_held"))).alias("_copy"),
    )
    return kept.unionByName(paged).drop("_copy")


def write(df: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id",
          text_col: str = "text") -> None:
    """Write the rows as Parquet in a folder a shard (``shard=…``), each as it is, with all columns.

    Rows that share an id and a text (null counts as empty) and overfill a
    shard are numbered, in parts of ``PART_ROWS``, and dealt over its pages. A
    column ``shard`` of the table gives way to that of the folders.
    """
    shards = placed(df, limit, id_col, text_col).groupBy("_code").agg(
        F.min("shard").alias("_first"), F.max("shard").alias("_last"),
        F.count("*").alias("_rows"), F.max("n_bytes").alias("_size"),
    )
    whole = F.struct(*(c for c in df.columns if c != "shard")).alias("_row")
    there = df.select(whole, hash_code(F.col(id_col), F.col(text_col)).alias("_code")).join(shards, "_code")
    alone = there.filter("_first = _last").select("_row", F.col("_first").alias("shard"))
    at = F.monotonically_increasing_id()
    many = cut(there.filter("_first <> _last").withColumn("_at", at).withColumn(
        "_part", F.pmod(F.xxhash64("_at"), F.ceil(F.col("_rows") / PART_ROWS))
    ))
    before = W.partitionBy("_code").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = many.groupBy("_code", "_part").agg(F.count("*").alias("_n")).select(
        "_code", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    place = F.col("_offset") + F.row_number().over(W.partitionBy("_code", "_part").orderBy("_at")) - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("_size", F.lit(1))))
    name = F.concat_ws("-", F.substring_index("_first", "-", 1), F.floor(place / room).cast("string"))
    dealt = many.join(offsets, ["_code", "_part"]).select("_row", name.alias("shard"))
    rows = alone.unionByName(dealt).select("_row.*", "shard")
    rows.repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int = SHARD_BYTES) -> str:
    """The same by adding up every prefix of every row."""
    return f"""
WITH d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(doc_id || ':' || coalesce(text, '')), 1, {HASH_BITS // 4}) AS BIGINT) AS code
    FROM documents),
depths AS (SELECT unnest(range({HASH_BITS} + 1)) AS depth),
sums AS (SELECT depth, code >> ({HASH_BITS} - depth) AS bucket, sum(n_bytes) AS total
    FROM d, depths GROUP BY ALL),
leaf AS (SELECT d.doc_id, n_bytes, code, min(depth) AS depth FROM d, depths JOIN sums USING (depth)
    WHERE bucket = code >> ({HASH_BITS} - depth) AND total <= {limit} GROUP BY ALL)
SELECT doc_id, n_bytes, 's' || CASE WHEN depth = 0 THEN ''
    ELSE substr(lpad(bin(code), {HASH_BITS}, '0'), 1, CAST(depth AS INTEGER)) END AS shard,
    CAST(depth AS INTEGER) AS shard_depth,
    CAST((SELECT total FROM sums s WHERE s.depth = leaf.depth
        AND s.bucket = code >> ({HASH_BITS} - leaf.depth)) AS BIGINT) AS shard_bytes
FROM leaf"""
