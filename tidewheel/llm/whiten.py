"""Embedding whitening by upper-triangle column aggregates.

Vectors are put on a lattice (whole numbers), of which each distinct one counts once. One
aggregation over these sums the centred product of every pair of dimensions of the covariance's upper
triangle. Its SQL expressions are generated for the pairs of a block of dimensions with another and the
pair of blocks is its key, so that the code stays small enough to be compiled, however many dimensions
there are. LAPACK decomposes the covariance on the driver, whose size depends on the dimensions alone,
and every row is projected on the components.

Distinct vectors, sums and products are found by partial aggregations in each task, so a vector that
very many rows share is one row of the shuffle for each task, and no key has more than a row for each.
Sums and counts are exact; a centre is taken off as a whole number and a fraction below one, so nothing
is lost to large means.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import broadcast, forget, ship, written

#: Lattice points to a unit, and where zero lies.
SCALE, ORIGIN = 64, 1_000_000
#: Scaled entries beyond this count as this, so that whole numbers hold them and their sums.
MOST = float(1 << 40)
#: Components that are returned at most.
COMPONENTS = 16
#: Dimensions of a block: the square of it sums are a row of the aggregation.
BLOCK = 8


def lattice(vector: Column) -> Column:
    """floor(64 c) + 1000000 of every entry; null for a null vector and one with a null or non-finite entry."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    point = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(MOST)), F.lit(-MOST))) + F.lit(ORIGIN).cast("bigint")
    return F.when(~odd, F.transform(vector, point))


def _products(rows: DataFrame, entries: list[Column], block: int) -> np.ndarray:
    """The sum over rows of the products of each pair of entries (doubles), in one aggregation."""
    d = len(entries)
    starts = range(0, d, block)
    filled = [*entries, *[F.lit(0.0)] * (len(starts) * block - d)]
    meets = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in combinations_with_replacement(starts, 2)))
    paired = rows.select(F.array(*filled).alias("c")).select("c", F.inline(meets))
    sides = [F.get("c", F.col(side) + F.lit(i)).alias(f"{side}{i}") for side in "pq" for i in range(block)]
    sums = [F.expr(f"sum(p{i} * q{j}) AS s{i}_{j}") for i in range(block) for j in range(block)]
    out = np.zeros((len(filled), len(filled)))
    for r in paired.select("p", "q", *sides).groupBy("p", "q").agg(*sums).collect():
        part = np.array(r[2:]).reshape(block, block)
        out[r.p : r.p + block, r.q : r.q + block] = part
        out[r.q : r.q + block, r.p : r.p + block] = part.T
    return out[:d, :d]


@dataclass
class Whitening:
    """n distinct vectors of `size` entries, their sums, and the first components (unit vectors, one in each row) with
    their variances; trace: of the covariance; error: of the whitened fit vectors' covariance, its largest difference
    to the identity; long: whether deviations are known to fit into a bigint."""

    n: int
    size: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    long: bool
    error: float | None = None

    @property
    def base(self) -> list[int]:
        return [s // self.n for s in self.sums]

    @property
    def rest(self) -> list[float]:
        return [s % self.n / self.n for s in self.sums]

    @property
    def varying(self) -> np.ndarray:
        """The components along which the fit vectors differ."""
        return self.variances > np.finfo(float).eps * self.size * max(self.trace, 0.0)

    def project(self, points: np.ndarray) -> np.ndarray:
        """Whitened rows of lattice points (bigint); nan where the fit vectors don't differ."""
        centred = (points - np.array(self.base)).astype(float) - np.array(self.rest)
        out = np.full((len(points), len(self.variances)), np.nan)
        for k in np.flatnonzero(self.varying):
            out[:, k] = (centred * self.components[k]).sum(axis=1) / np.sqrt(self.variances[k])  # row by row alike, whatever the batch
        return out

    def deviations(self, points: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S)^2, exact: bigints, or decimal texts where a bigint might not hold it."""
        if self.long:
            away = points * self.n - np.array(self.sums)
            return pa.array((away * away).sum(axis=1), pa.int64())
        return pa.array([str(sum((self.n * x - s) ** 2 for x, s in zip(p, self.sums))) for p in points.tolist()], pa.string())


def fit(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, block: int = BLOCK) -> Whitening | None:
    """Fits on the distinct lattice vectors of the length that most rows have (of equals, the larger); None if no row
    has a vector with an entry, all of them finite."""
    ship(vectors.sparkSession)
    points = vectors.select(lattice(F.col(vector)).alias("x")).filter(F.size("x") > 0)
    table = written(points.groupBy("x").agg(F.count("*").alias("copies")))
    most = table.groupBy(F.size("x").alias("size")).agg(F.sum("copies").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    if most is None:
        forget(table)
        return None
    d = most["size"]
    mine = table.filter(F.size("x") == d).select("x")
    # sums in two parts, which no number of rows makes overflow
    high, low = F.sum(F.shiftright("c", 20)), F.sum(F.col("c").bitwiseAND(F.lit((1 << 20) - 1).cast("bigint")))
    by = mine.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.count("*").alias("n"), high.alias("high"), low.alias("low"), F.min("c").alias("least"), F.max("c").alias("most")).orderBy("at").collect()
    n, sums = by[0].n, [(r.high << 20) + r.low for r in by]
    widest = [max(abs(n * r.least - s), abs(n * r.most - s)) for s, r in zip(sums, by)]
    fits = sum(w * w for w in widest) < 1 << 63 and all(n * max(abs(r.least), abs(r.most)) < 1 << 63 for r in by)
    model = Whitening(n, d, sums, np.empty((0, d)), np.empty(0), 0.0, fits)
    entries = [(F.get("x", F.lit(i)) - F.lit(b).cast("bigint")).cast("double") - F.lit(r) for i, (b, r) in enumerate(zip(model.base, model.rest))]
    covariance = _products(mine, entries, block) / n
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(values)[::-1][:components]
    model.variances, model.components, model.trace = values[order], columns[:, order].T, float(np.trace(covariance))
    if model.varying.any():
        there = np.flatnonzero(model.varying)
        white = mine.select(F.arrow_udf(_projected(model), _FOUND[model.long])("x").alias("w"))
        found = _products(white, [F.get("w.whitened", F.lit(int(k))) for k in there], block) / n  # their mean is 0
        model.error = float(np.abs(found - np.eye(len(there))).max())
    forget(table)
    return model


_FOUND = {True: "struct<whitened:array<double>,deviation:bigint>", False: "struct<whitened:array<double>,deviation:string>"}


def _projected(model: Whitening) -> Callable[[pa.Array], pa.Array]:
    def found(points: pa.Array) -> pa.Array:
        x = np.asarray(points.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(len(points), model.size)
        white = model.project(x)
        whitened = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1], pa.array(white.ravel(), pa.float64(), mask=np.isnan(white.ravel())))
        return pa.StructArray.from_arrays([whitened, model.deviations(x)], ["whitened", "deviation"])

    return found


def transform(vectors: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """Adds whitened (array of double, one entry for each component) and deviation (null beyond 38 digits).

    Rows whose vector is null, has a null or non-finite entry or another length than the model are dropped; so are
    all rows if there is no model. An entry of whitened is null where the fit vectors don't differ along the component.
    Repeated rows and equal vectors give equal results, null keys pass. Columns named whitened or deviation are
    replaced (the vector is read before), all others pass.
    """
    if model is None:
        return vectors.filter(F.lit(False)).withColumns({"whitened": F.lit(None).cast("array<double>"), "deviation": F.lit(None).cast("bigint")})
    shared = broadcast(vectors.sparkSession, model)
    project = F.arrow_udf(lambda points: _projected(shared.value)(points), _FOUND[model.long])
    rows = vectors.withColumn("_x", lattice(F.col(vector))).filter(F.size("_x") == model.size).withColumn("_w", project("_x"))
    deviation = F.col("_w.deviation") if model.long else F.col("_w.deviation").try_cast("decimal(38,0)")
    return rows.withColumns({"whitened": F.col("_w.whitened"), "deviation": deviation}).drop("_x", "_w")


def components(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component (from 1), n, deviation (null if no bigint holds it), whitened, explained and identity_error: a row for each of transform()'s and each component."""
    split = rows.select("vec_id", F.col("deviation").try_cast("bigint").alias("deviation"), F.posexplode("whitened").alias("_at", "whitened"))
    shares = [float(e / model.trace) if model.trace > 0 else 0.0 for e in model.variances] if model else []
    explained = F.get(F.array(*map(F.lit, shares)), F.col("_at")) if shares else F.lit(None)
    one = lambda v, kind: F.lit(v).cast(kind)
    return split.select("vec_id", (F.col("_at") + 1).cast("int").alias("component"), one(model.n if model else None, "bigint").alias("n"), "deviation", "whitened", explained.cast("double").alias("explained"), one(model.error if model else None, "double").alias("identity_error"))
