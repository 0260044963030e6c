"""Whitening of embeddings from the covariance of distinct vectors with multiplicities.

Equal vectors of whole-number steps are one group. The groups, with their counts
as weights, give mean and covariance through products of centred blocks; each
distinct vector is whitened once, and the rows of the table get its result by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pollwright.llm.common import columns, cut

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
#: Entries of this size and more can't be told from their neighbours as whole numbers.
LARGEST = float(1 << 53)
#: A vector of more than one in so many rows is joined back in parts.
HOT_SHARE = 500
#: Rows of a block in a product.
BLOCK = 4096
#: Eigenvalues up to this part of the largest one, for each dimension, count as zero.
NOISE = 1e-12


@dataclass
class Whitening:
    """Fit of the vectors: count, sums, whitening matrix and share of each component."""

    n: int
    sums: list[int]
    matrix: np.ndarray
    explained: np.ndarray

    @property
    def mean_offset(self) -> np.ndarray:
        """Mean of x - OFFSET, from exact sums."""
        return np.array([(s - self.n * OFFSET) / self.n for s in self.sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - OFFSET) - self.mean_offset

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.matrix

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n*x - S)^2, exact; Python's whole numbers where 64 bits don't suffice."""
        shift = np.array([s - self.n * OFFSET for s in self.sums], object)
        small = x - OFFSET
        reach = self.n * (int(np.abs(small).max(initial=0)) + 1) + max(map(abs, shift), default=0)
        kind = np.int64 if reach**2 * max(1, x.shape[1]) < 2**63 else object
        return [int(v) for v in ((self.n * small.astype(kind) - shift.astype(kind)) ** 2).sum(axis=1)]


def steps(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, x`` of the usable rows, x an array of long."""
    named = columns(df, vec_id=id_col, vector=vector_col)
    whole = F.transform("vector", lambda c: c.cast("double"))
    usable = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) * SCALE < LARGEST) & ~F.isnan(c))
    kept = named.withColumn("vector", whole).filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & usable)
    x = F.transform("vector", lambda c: F.floor(c * SCALE).cast("long") + OFFSET)
    return kept.select("vec_id", x.alias("x"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches in pieces of ``BLOCK`` rows, with x as a matrix."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            flat = part["x"].flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, -1)


def summed(parts: DataFrame) -> np.ndarray:
    """Sum of square matrices that come as rows ``i, row``: one row of the result a group."""
    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(b["row"].flatten().to_numpy().reshape(b.num_rows, -1).sum(axis=0) for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([list(total)])], ["i", "row"])

    rows = parts.groupBy("i").applyInArrow(add, "i int, row array<double>").collect()  # one row a dimension
    return np.array([r["row"] for r in sorted(rows, key=lambda r: r["i"])])


def covariance(groups: DataFrame, of: Whitening, whitened: bool) -> np.ndarray:
    """Weighted covariance, divisor n, of the centred vectors or of the whitened ones."""
    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part, x in blocks(batches):
            y = of.whiten(x) if whitened else of.centred(x)
            weights = part["weight"].to_numpy()[:, None]
            product = y.T @ (y * weights)
            total = product if total is None else total + product
        if total is not None:
            rows = [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))]
            yield pa.RecordBatch.from_arrays(rows, ["i", "row"])

    return summed(groups.mapInArrow(multiply, "i int, row array<double>")) / of.n


def fit(groups: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on ``x, weight``; None without rows. Only sums and a matrix of dims x dims reach the driver."""
    counted = groups.agg(
        F.sum("weight").alias("n"), F.max(F.size("x")).alias("dims")
    ).first()
    if not counted["n"]:
        return None
    n, dims = counted["n"], counted["dims"]
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, object)
        for part, x in blocks(batches):
            small, weight = x - OFFSET, part["weight"].to_numpy()
            fits = int(np.abs(small).max()) * int(weight.sum()) < 2**63
            kind = np.int64 if fits else object
            total = total + (weight.astype(kind) @ small.astype(kind)).astype(object)
        exact = pa.array([Decimal(int(t)) for t in total], pa.decimal128(38))
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), exact], ["i", "s"])

    parts = groups.mapInArrow(add, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    sums = [int(r["s"]) + n * OFFSET for r in parts.orderBy("i").collect()]  # one row a dimension
    centre = Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0))
    values, vectors = np.linalg.eigh(covariance(groups, centre, False))
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > NOISE * dims * max(values.max(), 0)]
    return Whitening(n, sums, vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum())


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    weights: str = "counts",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each row and component.

    Rows take no part if their vector is null, empty, of another length than most
    rows have (the longer one of two as frequent), or holds a null, a non-finite
    entry or one that is too large for a whole number (64 * \\|c\\| >= 2^53). Repeated rows and rows
    without id come out as they are. ``weights`` is ``counts``, so that every row counts in the
    fit, or ``one``, so that every distinct vector does. Components without spread are
    left out: an empty table, a single vector or equal vectors give no rows.
    """
    taken = steps(df, id_col, vector_col)
    counted = taken.groupBy("x").agg(F.count("*").alias("rows"))
    groups = cut(counted.withColumn("weight", F.col("rows") if weights == "counts" else F.lit(1).cast("long")))
    lengths = groups.groupBy(F.size("x").alias("dims")).agg(F.sum("rows").alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("dims")).first()
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if common is None:
        return df.sparkSession.createDataFrame([], shape)
    groups, all_rows = groups.filter(F.size("x") == common["dims"]), common["rows"]
    model = fit(groups, components)
    if not model.matrix.shape[1]:
        return df.sparkSession.createDataFrame([], shape)
    error = float(np.abs(covariance(groups, model, True) - np.eye(model.matrix.shape[1])).max())

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches):
            found = [part["x"], part["lots"], pa.array(model.deviations(x), pa.int64()), pa.array(list(model.whiten(x)))]
            yield pa.RecordBatch.from_arrays(found, ["x", "lots", "deviation", "y"])

    # vectors of many rows, under HOT_SHARE of them, are dealt over lots on both sides of the join
    lots = F.greatest(F.lit(1), F.ceil(F.col("rows") * HOT_SHARE / F.lit(all_rows))).cast("int")
    dealt = groups.select("x", lots.alias("lots"))
    hot = dealt.filter("lots > 1")
    done = dealt.mapInArrow(results, "x array<long>, lots int, deviation long, y array<double>").withColumn(
        "lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))
    )
    spread = taken.filter(F.size("x") == common["dims"]).join(F.broadcast(hot), "x", "left").withColumn(
        "lot", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.coalesce("lots", F.lit(1))).cast("int")
    ).drop("lots")
    joined = spread.join(done.drop("lots"), ["x", "lot"])
    share = F.array(*map(F.lit, model.explained.tolist()))
    return joined.select("vec_id", "deviation", F.posexplode("y").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(share, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
