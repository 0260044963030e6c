"""Similarity join on sets of word n-grams by rare-first prefix filtering.

The n-grams of a text are ordered by how many texts have them, rarest first.
Two sets can only be similar enough if they share an n-gram within their
prefixes, so only prefixes are shuffled. A pair met there passes a length, a
positional and a suffix filter before its whole sets are compared, once.

Texts with equal sets are one class. Groups of near copies are not paired off:
in the list of each n-gram one member, the one with the fewest n-grams of its own, is
compared with all others first; what it links is one component, and only
members of different components are compared further. No link between
different components is lost, which is what the result consists of.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pollwright.llm.common import columns, cut, semi_join, slices
from pollwright.llm.graph import components

#: Texts that have an n-gram are counted in a table of this many buckets.
COUNT_BITS = 18
#: Parts of the hash range that the suffix filter counts n-grams in.
SUFFIX_PARTS = 256
#: Rounds in which one member of a list is compared with the others.
STARS = 1
PRIME = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Hashes of the distinct runs of so many words, sorted.

    A-Z are lower-cased; words are split at ASCII white space. A text with
    fewer words is one run, a text without words has none.
    """
    import xxhash

    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(h))
    mixed = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i : len(h) - width + 1 + i]) * PRIME
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed numbers."""
    both = np.array([
        (s * OTHER ^ s >> np.uint64(31)).sum(dtype=np.uint64), np.bitwise_xor.reduce(s * PRIME + OTHER)
    ], np.uint64) if len(s) else np.zeros(2, np.uint64)
    return tuple(both.view(np.int64).tolist())


def bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def summaries(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n, k1, k2`` a text, and ``counts`` of n-grams a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "k1", "k2", "counts"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        for batch in batches:
            n, keys = [], []
            for text in batch["_text"]:
                s = shingles(text.as_py(), words)
                n.append(len(s))
                keys.append(fingerprint(s))
                np.add.at(counts, bucket(s), np.uint32(1))
            k = list(zip(*keys, strict=True)) if keys else [[], []]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(n, types[1]), pa.array(k[0], types[2]),
                 pa.array(k[1], types[3]), pa.nulls(len(n), types[4])], names)
        packed = zlib.compress(counts.tobytes(), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], t) for x, t in zip((None, None, None, None, packed), types, strict=True)], names
        )

    return docs.mapInArrow(read, "doc_id long, n long, k1 long, k2 long, counts binary")


def counted(parts: DataFrame) -> np.ndarray:
    """Texts for each bucket of n-grams, added up over all tasks."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for x in batch["counts"]:
                total += np.frombuffer(zlib.decompress(x.as_py()), np.uint32)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"]
        )

    found = parts.select("counts").filter("counts is not null").mapInArrow(unpack, "bucket int, n long")
    sums = found.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # a row a bucket at most
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def prefixes(docs: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """``token, k1, k2, size, pos`` for the prefix of each set, once a class and task."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for part in (p for batch in batches for p in slices(batch, "_text")):
            tokens, keys, sizes, lengths = [], [], [], []
            for text in part["_text"]:
                s = shingles(text.as_py(), words)
                key = fingerprint(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                kept = len(s) + percent * len(s) // -100 + 1
                order = np.lexsort((s, shared.value[bucket(s)]))[:kept]
                tokens.append(s[order].view(np.int64))
                keys.append(key)
                sizes.append(len(s))
                lengths.append(kept)
            if not keys:
                continue
            k1, k2 = np.array(keys, np.int64).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens)), pa.array(np.repeat(k1, lengths)),
                 pa.array(np.repeat(k2, lengths)), pa.array(np.repeat(sizes, lengths), pa.int32()),
                 pa.array(np.concatenate([np.arange(n) for n in lengths]), pa.int32())],
                ["token", "k1", "k2", "size", "pos"],
            )

    return docs.mapInArrow(read, "token long, k1 long, k2 long, size int, pos int")


def whole_sets(docs: DataFrame, words: int) -> DataFrame:
    """``node, s``: whole sets."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "_text")):
            sets = [shingles(t.as_py(), words) for t in part["_text"]]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            flat = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["node", "s"],
            )

    return docs.mapInArrow(read, "node long, s array<long>")


def part_counts(docs: DataFrame, words: int) -> DataFrame:
    """``node, parts``: how many n-grams lie in each part of the hash range."""
    step = np.uint64(64 - SUFFIX_PARTS.bit_length() + 1)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingles(t.as_py(), words) for t in batch["_text"])
            parts = [np.bincount((s >> step).astype(np.int64), minlength=SUFFIX_PARTS) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))],
                ["node", "parts"],
            )

    return docs.mapInArrow(read, "node long, parts array<int>")


def overlap(size_a: Column, size_b: Column, percent: int) -> Column:
    """Common n-grams that two sets need."""
    return F.ceil(F.lit(percent) * (size_a + size_b) / F.lit(100 + percent))


def may_link(a: Column, b: Column, percent: int) -> Column:
    """Length and positional filter, on two members of one list.

    Where the n-gram is the first one that both sets share, what is left behind
    it in either set bounds their overlap.
    """
    left = F.least(a["size"] - a["pos"], b["size"] - b["pos"])
    return (
        F.least(a["size"], b["size"]) * 100 >= F.greatest(a["size"], b["size"]) * percent
    ) & (left >= overlap(a["size"], b["size"], percent))


def alive(lists: DataFrame, percent: int) -> DataFrame:
    """Members that may still link to one of another component in their list.

    A member that lies too far behind in its set for the smallest set of the
    list goes, then lists whose members are all in one component.
    """
    same = W.partitionBy("token")
    least = F.greatest(F.min("size").over(same), F.ceil(F.col("size") * percent / F.lit(100)))
    near = lists.withColumn("_least", least).filter(
        F.col("size") - F.col("pos") >= overlap(F.col("size"), F.col("_least"), percent)
    ).drop("_least")
    mixed = F.min("component").over(same) != F.max("component").over(same)
    return near.withColumn("_mixed", mixed).filter("_mixed").drop("_mixed")


def with_both(pairs: DataFrame, of_nodes: DataFrame, column: str) -> DataFrame:
    """Add ``column`` of both texts of a pair."""
    first, second = (
        of_nodes.select(F.col("node").alias(x), F.col(column).alias(f"{column}_{x}")) for x in "ab"
    )
    return pairs.join(first, "a").join(second, "b")


def texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    nodes = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    return semi_join(docs, cut(nodes), "doc_id")


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b`` of the pairs that pass the suffix filter and whose whole sets are similar enough.

    The parts of the hash range bound how many n-grams only one of the sets
    has, so that whole sets are made and moved for little more than the links.
    """
    pairs = cut(pairs)
    counts = with_both(pairs, cut(part_counts(texts_of(pairs, docs), words)), "parts")
    size_a, size_b = (F.aggregate(f"parts_{x}", F.lit(0), lambda s, n: s + n) for x in "ab")
    apart = F.aggregate(
        F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, n: s + n
    )
    near = cut(
        counts.filter(apart <= size_a + size_b - 2 * overlap(size_a, size_b, percent))
        .select("a", "b").distinct()
    )
    both = with_both(near, cut(whole_sets(texts_of(near, docs), words)), "s")
    common = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - common
    return both.filter(common * 100 >= union * percent).select("a", "b").distinct()


def near_duplicates(
    df: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Two texts link where their sets of runs of ``words`` words have at least
    ``percent`` hundredths of their union in common; ``component_id`` is the
    smallest id that can be reached by links, the own one included. A null text,
    or one without words, has an empty set and links to nothing. Repeated rows come
    out repeated; rows that share an id but not a text are one document with the
    links of all its texts. A row without id is linked by its text alone and
    gives no name to a component. An empty table gives no rows; other columns
    are left out.
    """
    docs = columns(df, doc_id=id_col, _text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    read = cut(summaries(docs, words))
    rows = read.filter("counts is null").drop("counts")
    classes = cut(
        rows.filter("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
    )

    # lists of n-grams that several classes have in their prefix
    found = prefixes(docs, counted(read), words, percent)
    same = W.partitionBy("token")
    several = (F.min("k1").over(same) != F.max("k1").over(same)) | (
        F.min("k2").over(same) != F.max("k2").over(same)
    )
    in_lists = (
        found.withColumn("_several", several).filter("_several").drop("_several")
        .dropDuplicates(["token", "k1", "k2"])
    )
    lists = cut(
        in_lists.join(classes, ["k1", "k2"]).filter("node is not null")
        .select("token", "node", "size", "pos")
    )
    rest = alive(lists.withColumn("component", F.col("node")), percent)

    # an id whose rows differ is one document
    known = rows.filter("n > 0 and doc_id is not null")
    shared_ids = known.groupBy("doc_id").agg(F.min("k1").alias("lo"), F.max("k1").alias("hi")).filter("lo <> hi")
    links = cut(
        known.join(shared_ids.select("doc_id"), "doc_id", "left_semi").join(classes, ["k1", "k2"])
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b")).filter("a <> b").distinct()
    )
    for turn in range(STARS + 1):
        if turn < STARS:
            pivot = F.min(F.struct("pos", "size", "node", "component")).over(same)
            met = rest.withColumn("_p", pivot)
            pairs = met.filter(
                (F.col("node") != F.col("_p.node")) & (F.col("component") != F.col("_p.component"))
                & may_link(F.col("_p"), F.struct("pos", "size"), percent)
            ).select(F.least("node", "_p.node").alias("a"), F.greatest("node", "_p.node").alias("b"))
            rest = met.filter(F.col("node") != F.col("_p.node")).drop("_p")
        else:
            x, y = rest.alias("x"), rest.alias("y")
            meets = (
                (F.col("x.token") == F.col("y.token")) & (F.col("x.node") < F.col("y.node"))
                & (F.col("x.component") != F.col("y.component"))
            )
            a, b = ({c: F.col(f"{t}.{c}") for c in ("size", "pos")} for t in "xy")
            pairs = x.join(y, meets & may_link(a, b, percent)).select(
                F.col("x.node").alias("a"), F.col("y.node").alias("b")
            )
        fresh = verified(pairs.distinct(), docs, words, percent)
        links = cut(links.unionByName(fresh))
        named = components(links)
        if turn < STARS:
            again = rest.drop("component").join(
                named.select("node", F.col("component").alias("_c")), "node", "left"
            ).withColumn("component", F.coalesce("_c", "node")).drop("_c")
            rest = cut(alive(again, percent))
            if rest.isEmpty():
                break

    class_named = classes.join(named, "node", "left").select(
        "k1", "k2", F.coalesce("component", "node").alias("_component")
    )
    return rows.join(class_named, ["k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def oracle(words: int, percent: int) -> str:
    """The same by joining all n-grams and following links, over ``documents``."""
    big = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{big}', '{big.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {words - 2}),
        lambda i: array_to_string(w[i:i + {words - 1}], ' '))) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n + b.n) AS n
    FROM e a JOIN e b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM c WHERE 100 * c >= {percent} * (n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT x, b FROM reach JOIN links ON y = a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(y) FROM reach WHERE x = doc_id) AS component_id
FROM s"""
