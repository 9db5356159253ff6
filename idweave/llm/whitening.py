"""Whitening of embedding vectors by the covariance of the distinct vectors.

An entry c becomes the integer x = floor(256 * c). Identical x vectors are
grouped (partial counts first, so a vector that holds a third of all rows is
one row a task), the covariance is fitted over the groups, each weighing one
or its number of copies, and each distinct vector is whitened once; the rows
then join back on their x vector, where adaptive skew-join splitting cuts a
hot one.

The fit takes two passes over the stored groups: exact sums of every dimension
first, then each task's product of its centred rows, added up by cell. Centring
subtracts the whole part of the mean as integers and the fraction as a double,
so that neither large entries nor a far mean cost digits. Only the d sums and
the d x d covariance (d: entries of a vector) reach the driver.

Defined results: a row whose vector is null, empty, or holds a null or a
non-finite entry (or one of 2^54 or more, whose x is no 64-bit integer) is
dropped; where lengths differ, the commonest stays (of ties the longest); a
null id and repeated rows are rows like others; columns of other names are not
read; no rows give no rows. A component whose eigenvalue is zero to double
precision (fewer independent vectors than components) has a null whitened
value and does not count in the identity error; with one distinct vector the
explained share is null too. Fewer dimensions than components give as many
components as dimensions. A deviation of over 38 digits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store

COMPONENTS = 4
#: Entries become floor(SCALE * c).
SCALE = 256
#: Entries of this size and beyond have no 64-bit x.
TOO_LARGE = 2.0 ** 54
#: Columns of the result.
COLUMNS = "id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, x) of the rows whose vector has finite entries only."""
    return (vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
            .filter(f"size(v) > 0 AND forall(v, c -> c IS NOT NULL AND abs(c) < {TOO_LARGE!r}D)")
            .selectExpr("id", f"transform(v, c -> CAST(floor({SCALE}D * c) AS BIGINT)) AS x"))


def matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The x vectors of a batch as rows."""
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def exact_sums(x: np.ndarray, weight: np.ndarray) -> list[int]:
    """Weighted sum of every column, as Python integers where 64 bits may not hold it."""
    most = float(np.abs(x).max(initial=0)) * float(weight.sum())
    return [int(v) for v in (weight @ x if most < 2.0 ** 62 else weight.astype(object) @ x.astype(object))]


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """Sum over the columns of (n * y - rest) ** 2, exactly, for every row of integers ``y``."""
    most, dim = float(np.abs(y).max(initial=0)), y.shape[1]
    if max(most * most, most * max(map(abs, rest))) * dim >= 2.0 ** 62 or max(map(abs, rest)) >= 2 ** 62:
        y = y.astype(object)
    r = np.array(rest, dtype=y.dtype)
    return [n * n * int(a) - 2 * n * int(b) + sum(v * v for v in rest) for a, b in zip((y * y).sum(axis=1), y @ r)]


class Centre:
    """Exact mean of the fit list, S / n, in whole parts and fractions."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = [s // n for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.whole)]
        self.fraction = np.array([r / n for r in self.rest])

    def integers(self, x: np.ndarray) -> np.ndarray:
        return x - np.array(self.whole, dtype=np.int64)

    def doubles(self, x: np.ndarray) -> np.ndarray:
        return self.integers(x).astype(np.float64) - self.fraction


def fitted_centre(groups: DataFrame, dim: int) -> Centre:
    """Total weight and exact sums over the groups (x, weight)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [0] * dim, 0
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            sums = [a + b for a, b in zip(sums, exact_sums(matrix(batch, dim), weight))]
            n += int(weight.sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()),
                                          pa.array([Decimal(v) for v in [n, *sums]], pa.decimal128(38, 0))], ["at", "total"])
    parts = groups.select("x", "weight").mapInArrow(run, "at int, total decimal(38,0)")
    total = {r.at: int(r.total) for r in parts.groupBy("at").agg(F.sum("total").alias("total")).collect()}
    return Centre(total[-1], [total[i] for i in range(dim)])


def fitted_covariance(groups: DataFrame, dim: int, centre: Centre) -> np.ndarray:
    """Covariance of the groups: the tasks' products of centred rows, added up by cell, over the total weight."""
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product, some = np.zeros((dim, dim)), False
        for batch in batches:
            y = centre.doubles(matrix(batch, dim))
            product += (y * batch.column("weight").to_numpy()[:, None]).T @ y
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                                              pa.array(product[upper])], ["i", "j", "value"])
    cells = groups.select("x", "weight").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(
        F.sum("value").alias("value")).toPandas()
    v = np.zeros((dim, dim))
    v[cells.i, cells.j] = cells.value / centre.n
    return v + np.triu(v, 1).T


def leading_components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues by falling size (zero where zero to double precision) and unit eigenvectors as columns, largest entry positive."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most].copy(), u[:, ::-1][:, :most].copy()
    e[e <= max(e.max(initial=0.0), 0.0) * len(v) * np.finfo(float).eps] = 0.0
    return e, u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(u.shape[1])])


def identity_error(white: DataFrame, live: list[int], n: int) -> float:
    """Largest absolute entry of the whitened groups' covariance minus the identity, over the components ``live``."""
    if not live:
        return 0.0
    at = [F.col("whitened")[k] for k in live]
    means = white.agg(*[F.sum(F.col("weight") * c).alias(f"m{k}") for k, c in enumerate(at)]).first()
    centred = [c - F.lit(means[k] / n) for k, c in enumerate(at)]
    pairs = list(combinations_with_replacement(range(len(live)), 2))
    sums = white.agg(*[F.sum(F.col("weight") * centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs))


def whitened_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                     components: int = COMPONENTS, weights: str = "one") -> DataFrame:
    """Rows of ``vectors`` on the leading components: see ``COLUMNS``, one row for each row and component.

    ``weights``: ``one`` fits each distinct x vector once, ``copies`` as often
    as it occurs. n is the total weight, ``deviation`` the sum over dimensions
    of (n * x - S) ** 2 where S holds the weighted sums.
    """
    if weights not in ("one", "copies"):
        raise ValueError("weights must be 'one' or 'copies'")
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_column, vector_column)
    groups = store(rows.groupBy("x").agg(F.count("*").alias("copies")), "distinct_vectors")
    common = groups.groupBy(F.size("x").alias("dim")).agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("dim")).first()
    if common is None:
        return spark.createDataFrame([], COLUMNS)
    dim = common["dim"]
    groups = groups.filter(F.size("x") == dim).withColumn("weight", F.lit(1).cast("bigint") if weights == "one" else F.col("copies"))
    centre = fitted_centre(groups, dim)
    v = fitted_covariance(groups, dim, centre)
    e, u = leading_components(v, components)
    trace, scale = float(np.trace(v)), np.divide(1.0, np.sqrt(e), out=np.full(len(e), np.nan), where=e > 0)
    projection = u * scale

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch, dim)
            values = centre.doubles(x) @ projection
            far = [Decimal(d) if d < 10 ** 38 else None for d in deviations(centre.integers(x), centre.n, centre.rest)]
            flat = pa.array(values.ravel(), from_pandas=True)  # not a number: null
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("weight"), pa.array(far, pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(e)), flat)],
                ["x", "weight", "deviation", "whitened"])
    white = store(groups.select("x", "weight").mapInArrow(
        whiten, "x array<bigint>, weight bigint, deviation decimal(38,0), whitened array<double>"), "whitened_vectors")
    error = identity_error(white, [k for k in range(len(e)) if e[k] > 0], centre.n)
    shares = F.array(*[F.lit(float(k) / trace if trace > 0 else None).cast("double") for k in e])
    return (rows.join(white.drop("weight"), "x")
            .select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("id", (F.col("at") + 1).alias("component"), F.lit(centre.n).cast("bigint").alias("n"), "deviation", "whitened",
                    F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))
