"""Embedding whitening from weighted distinct vectors.

Vectors are quantised to integers, x = floor(64 * c) + 1000000. Identical x
vectors are grouped and counted; everything after works on the distinct ones,
with their counts as fit weights: sums, the covariance (a weighted, centred
matrix product in every task, d * d partial sums added up), and the projection,
which is computed once a distinct vector and joined back to its rows. Centring
is exact: n * x - S is an integer.

The fit's own arrays (sums, covariance, components: d * d numbers) are all that
reaches the driver. A vector that many rows share is one row here; when rows
are joined back, vectors with more than a 256th of all rows (thus fewer than
256 of them) are broadcast, so none gathers its rows in one task.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are dropped; null and repeated ids keep their rows; vectors of
different lengths are fitted apart, each with its own n; directions in which
the fitted vectors do not vary (eigenvalue below 1e-12 of the largest; so all,
for a single distinct vector) cannot be whitened and give no rows; entries
beyond 2^52 / 64 are cut to it; a deviation beyond 2^63 - 1 is null; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RESERVED, written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Eigenvalues up to this share of the largest count as zero.
FLAT = 1e-12
#: Vectors of more than one row in this many are joined by broadcast (fewer than this many).
HOT = 256
_LARGEST = float(1 << 52)


def quantised(vector: Column) -> Column:
    """The vector's entries as integers; null where it is null, empty, or not finite."""
    entry = vector.cast("array<double>")
    fine = F.forall(entry, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    bound = F.lit(_LARGEST)
    whole = F.transform(entry, lambda c: F.floor(F.greatest(-bound, F.least(bound, c * SCALE))) + SHIFT)
    return F.when(fine & (F.size(entry) > 0), whole.cast("array<bigint>"))


def _key(x: Column) -> Column:
    return F.unhex(F.md5(F.array_join(x.cast("array<string>"), ",").cast("binary")))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(key, d, x, w): every distinct x of ``rows`` (key, x) with its number of rows."""
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("w"), F.first("x").alias("x")) \
        .select("key", F.size("x").alias("d"), "x", "w")


def _rows_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def weighted_covariance(df: DataFrame, vector: str, centre, n: float, d: int) -> np.ndarray:
    """Sum of w * c c' / n over ``df`` (vector, w), c = ``centre(rows of the vector)``."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                c = centre(_rows_of(batch, vector))
                total += (c * batch.column(1).to_numpy(zero_copy_only=False)[:, None]).T @ c
        i, j = np.triu_indices(d)
        yield pa.record_batch({"i": i.astype(np.int32), "j": j.astype(np.int32), "v": total[i, j]})

    out = np.zeros((d, d))
    for r in (df.select(vector, "w").mapInArrow(partial, "i int, j int, v double")
              .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()):  # d * (d + 1) / 2 rows
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"] / n
    return out


def weighted_sums(df: DataFrame, vector: str, d: int, kind: str) -> list:
    """Sum of w * entry for each of ``d`` entries."""
    found = (df.select("w", F.posexplode(vector).alias("i", "v"))
             .groupBy("i").agg(F.sum(F.col("v").cast(kind) * F.col("w")).alias("s")).collect())  # d rows
    sums = dict((r["i"], r["s"]) for r in found)
    return [sums[i] for i in range(d)]


@dataclass
class Fit:
    """Whitening of vectors of one length: ``basis`` columns are components over sqrt(eigenvalue)."""
    n: int
    sums: list[int]
    basis: np.ndarray
    explained: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers if they fit, else Python's."""
        far = max(abs(self.n * int(v) - s) for s, v in
                  [*zip(self.sums, x.max(0)), *zip(self.sums, x.min(0))])
        kind = np.int64 if far < 1 << 62 and self.n * int(np.abs(x).max()) < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.deviations(x) / self.n).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.basis

    def squared(self, x: np.ndarray) -> list[int | None]:
        d = self.deviations(x)
        if d.dtype != object and float(np.abs(d).max()) ** 2 * d.shape[1] < 2 ** 62:
            return (d * d).sum(1).tolist()
        exact = [sum(int(v) ** 2 for v in row) for row in d]
        return [v if v < 1 << 63 else None for v in exact]


def fit(groups: DataFrame, d: int, n: int, components: int) -> Fit:
    """Fit on the distinct vectors ``groups`` (x, w), all of length ``d``, ``n`` rows in all."""
    sums = [int(s) for s in weighted_sums(groups, "x", d, "decimal(38,0)")]
    plain = Fit(n, sums, np.zeros((d, 0)), np.zeros(0))
    v = weighted_covariance(groups, "x", plain.centred, n, d)
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:components]
    order = order[e[order] > FLAT * max(e.max(), 0)]
    return Fit(n, sums, u[:, order] / np.sqrt(e[order]), e[order] / np.trace(v) if len(order) else np.zeros(0))


def identity_error(groups: DataFrame, n: int, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (weights w, divisor n) minus the identity."""
    mean = np.array(weighted_sums(groups, "whitened", components, "double")) / n
    cov = weighted_covariance(groups, "whitened", lambda z: z - mean, n, components)
    return float(np.abs(cov - np.eye(components)).max())


def project(groups: DataFrame, of: Fit) -> DataFrame:
    """(key, w, deviation, whitened): every distinct vector projected once."""
    kind = groups.schema["key"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _rows_of(batch, "x")
                z = of.whitened(x)
                yield pa.record_batch({
                    "key": batch.column(0), "w": batch.column(2),
                    "deviation": pa.array(of.squared(x), type=pa.int64()),
                    "whitened": pa.ListArray.from_arrays(
                        np.arange(len(z) + 1, dtype=np.int32) * z.shape[1], z.ravel())})

    return groups.select("key", "x", "w").mapInArrow(
        run, f"key {kind.simpleString()}, w long, deviation long, whitened array<double>")


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS, hot: int = HOT) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``,
    one row for each remaining row and component (from 1, by falling eigenvalue).

    ``deviation``: sum over dimensions of (n * x - S) squared; ``whitened``: x - S / n
    projected on the component, over the root of its eigenvalue; ``explained``: the
    eigenvalue's share of the trace; ``identity_error``: how far the covariance of
    all whitened rows is from the identity.
    """
    id_, x = f"{RESERVED}id", F.col("x")
    base = (rows.select(F.col(vec_id).alias(id_), quantised(F.col(vector)).alias("x")).where(x.isNotNull())
            .select(id_, _key(x).alias("key"), "x"))
    groups = written(distinct_vectors(base), "distinct_vectors")
    out = None
    for r in groups.groupBy("d").agg(F.sum("w").alias("n")).orderBy("d").collect():  # one row a vector length
        d, n = r["d"], int(r["n"])
        own = groups.where(F.col("d") == d)
        of = fit(own, d, n, components)
        k = of.basis.shape[1]
        if not k:
            continue
        done = written(project(own, of), "whitened_vectors")
        error = identity_error(done, n, k)
        heavy = F.col("w") * hot > n
        mine = base.where(F.size("x") == d).drop("x")
        few = F.broadcast(done.where(heavy))  # fewer than ``hot`` rows
        joined = mine.join(few, "key").unionByName(
            mine.join(few.select("key"), "key", "left_anti").join(done.where(~heavy), "key"))
        share = F.array(*[F.lit(float(s)) for s in of.explained])
        part = (joined.select(id_, "deviation", F.posexplode("whitened").alias("at", "value"))
                .select(F.col(id_).alias(vec_id), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
                        "deviation", F.col("value").alias("whitened"), F.get(share, F.col("at")).alias("explained"),
                        F.lit(error).alias("identity_error")))
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = rows.schema[vec_id].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], (
            f"`{vec_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"))
    return out
