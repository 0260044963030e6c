"""Nearest neighbours by multi-index hashing.

Rotations learned from a bounded sample turn a vector into a binary code. Codes
are cut into substrings of one byte, each with an index of its own. A code
within Hamming distance ``r`` of the query differs by at most ``r // substrings``
bits in one substring at least, so probing all buckets that near retrieves every
such code. The radius grows until it holds enough codes; the vectors of
all codes within it are then compared in double precision.

The table is dealt into parts of bounded size by a hash of the id, each of them
indexed in one task, and the queries into blocks; each block meets each part and
the best of all parts are merged. Equal vectors lie in different parts, so a vector
that is very common fills no task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pollwright.llm.common import columns, cut, sample

#: Vectors that a rotation is learned from at most, rotations, steps of learning.
SAMPLE = 20_000
ROTATIONS = 4
STEPS = 10
#: Rows of a part and queries of a block, about.
PART_ROWS = 16_384
BLOCK_QUERIES = 1_024
#: The radius grows until it holds this share of a part and so many codes.
REACH = 0.05
LEAST = 256

BYTE_BITS = np.array([bin(x).count("1") for x in range(256)], np.uint8)
BYTE_DISTANCE = BYTE_BITS[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of vectors with finite components that aren't all zero, one a ``vec_id``.

    Of several rows with one id the smallest vector counts; vectors must be as
    long as most are (of equally frequent lengths, the longer).
    """
    known = vectors.select("vec_id", F.col("v").cast("array<double>").alias("v")).filter(
        "vec_id is not null and v is not null"
    )
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    fit = known.filter(finite & F.exists("v", lambda x: x != 0))
    common = fit.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return (
        fit.filter(F.size("v") == (common["n"] if common else 0))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )


@dataclass
class Codes:
    """Rotations, and the largest norm, by which inner products become angles."""

    rotations: list[np.ndarray]
    norm: float

    def of(self, v: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes as bytes; rows get a further component that makes their norms equal."""
        if query:
            v = v / np.linalg.norm(v, axis=1, keepdims=True)
            rest = np.zeros(len(v))
        else:
            v = v / self.norm
            rest = np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1)))
        full = np.column_stack([v, rest])
        bits = np.concatenate([full @ r > 0 for r in self.rotations], axis=1)
        return np.packbits(bits[:, : bits.shape[1] // 8 * 8], axis=1)


def learn(vectors: np.ndarray, norm: float, seed: int = 7) -> Codes:
    """Iterative quantisation from several random rotations."""
    dice = np.random.default_rng(seed)
    v = vectors / norm
    full = np.column_stack([v, np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1)))])
    rotations = []
    for _ in range(ROTATIONS):
        r = np.linalg.qr(dice.standard_normal((full.shape[1],) * 2))[0]
        for _ in range(STEPS):
            u, _, w = np.linalg.svd(full.T @ np.sign(full @ r))
            r = u @ w
        rotations.append(r)
    return Codes(rotations, norm)


class MultiIndex:
    """An index for each byte of the codes of one part."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.count = np.array([np.bincount(c, minlength=256) for c in codes.T])
        self.start = np.cumsum(self.count, axis=1) - self.count

    def distance(self, query: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        codes = self.codes if rows is None else self.codes[rows]
        return BYTE_BITS[codes ^ query].sum(axis=1, dtype=np.int32)

    def within(self, query: np.ndarray, enough: int) -> np.ndarray:
        """All rows in the smallest radius that holds ``enough`` of them."""
        n, parts = self.codes.shape
        seen = np.zeros(n, bool)
        near = BYTE_DISTANCE[query]
        for bits in range(9):
            probed = near <= bits
            if (self.count * probed).sum() >= n:  # to compare all codes costs no more
                break
            for j, bucket in zip(*np.nonzero(near == bits), strict=True):
                begin = self.start[j, bucket]
                seen[self.order[begin : begin + self.count[j, bucket], j]] = True
            rows = np.flatnonzero(seen)
            far = self.distance(query, rows)
            sure = far < parts * (bits + 1)  # every code this near has been probed
            if sure.sum() >= enough:
                radius = np.partition(far[sure], enough - 1)[enough - 1]
                return rows[far <= radius]
        far = self.distance(query)
        if n <= enough:
            return np.arange(n)
        return np.flatnonzero(far <= np.partition(far, enough - 1)[enough - 1])


def search(
    df: DataFrame,
    is_query: str,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    reach: float = REACH,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query.

    ``is_query`` is an SQL condition on ``vec_id``. A row is no neighbour of its
    own id. Ties go to the smaller ``vec_id``; with fewer than ``k`` other rows
    all are returned. Vectors that are null, zero, of another length than
    most, or hold a null or non-finite component take no part, neither do rows
    without id; rows that repeat an id count once. An empty table gives no rows;
    other columns are left out.
    """
    known = cut(usable(columns(df, vec_id=id_col, v=vector_col)))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows, norm, asked = known.agg(
        F.count("*"), F.max(length), F.count_if(F.expr(is_query))
    ).first()
    schema = "query_id long, vec_id long, score double"
    if not rows:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    taken = sample(known, "vec_id", SAMPLE).toPandas().sort_values("vec_id")
    codes = learn(np.stack(taken["v"].to_numpy()), norm)
    parts, blocks = -(-rows // PART_ROWS), max(1, -(-asked // BLOCK_QUERIES))

    def dealt(of: DataFrame, own: str, n: int, other: str, copies: int) -> DataFrame:
        lots = F.pmod(F.xxhash64("vec_id", F.lit(own)), F.lit(n)).cast("int").alias(own)
        return of.select("*", lots, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))

    table = dealt(known, "part", parts, "block", blocks)
    queries = dealt(known.filter(is_query), "block", blocks, "part", parts)

    def meet(asking: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(asking) and len(there):
            ids = there["vec_id"].to_numpy()
            vectors = np.stack(there["v"].to_numpy())
            index = MultiIndex(codes.of(vectors))
            enough = max(LEAST, int(len(ids) * reach)) + 1
            asked = np.stack(asking["v"].to_numpy())
            for q, v, code in zip(
                asking["vec_id"].to_numpy(), asked, codes.of(asked, query=True), strict=True
            ):
                rows = index.within(code, enough)
                rows = rows[ids[rows] != q]
                score = (vectors[rows] * v).sum(axis=1)
                best = np.lexsort((ids[rows], -score))[:k]
                found["query_id"] += [q] * len(best)
                found["vec_id"] += ids[rows[best]].tolist()
                found["score"] += score[best].tolist()
        return pd.DataFrame(found).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    near = queries.groupBy("block", "part").cogroup(table.groupBy("block", "part")).applyInPandas(
        meet, schema
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def exact(df: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """The same over all vectors of every part: to measure recall."""
    return search(df, is_query, k, id_col, vector_col, reach=1.0)
