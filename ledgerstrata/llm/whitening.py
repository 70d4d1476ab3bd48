"""Embedding whitening by weighted multiplicity covariance.

Equal vectors are grouped; the fit uses each distinct vector once, with its number of copies or one as
weight. The covariance is a weighted product of the centred matrix with itself, summed over tasks. Each
distinct vector is whitened once, and the result is joined back to all rows that hold it.

To the driver go, per vector length d, the sums (d numbers), the covariance (d x d) and the check of the whitened
components; nothing there grows with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstrata.config import cut_lineage

COMPONENTS = 16
#: Entries become whole numbers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Largest whole number taken; a vector beyond it is an error, as sums and squares could not be exact.
_MOST = 1 << 61


@dataclass(frozen=True)
class Fit:
    """Whitening of the vectors of one length."""

    n: int  # weight of the fit list
    sums: list[int]  # per dimension
    values: np.ndarray  # eigenvalues of the kept components, falling
    vectors: np.ndarray  # their unit eigenvectors, one per column
    trace: float


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    lengths = np.diff(batch.column("x").offsets.to_numpy())
    for d in np.unique(lengths[lengths > 0]):
        yield int(d), batch.filter(pa.array(lengths == d))


def whole_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums as exact whole numbers; Python's own where 64 bits do not suffice."""
    if n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0) < _MOST:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squared_lengths(deviation: np.ndarray) -> np.ndarray:
    """Exact sum of squares per row, as 64-bit numbers; an OverflowError where they do not fit."""
    most = max(int(np.abs(deviation).max(initial=0)), 1)
    if deviation.dtype == object or most * most * deviation.shape[1] >= _MOST:
        deviation = deviation.astype(object)
    return np.array([int(v) for v in (deviation * deviation).sum(axis=1)], np.int64)


def components_of(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues and their unit vectors; those that are zero but for rounding are left out."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    sound = values > max(values[0], 0.0) * len(covariance) * np.finfo(float).eps if len(values) else values
    return values[sound], vectors[:, sound]


def whole_vectors(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """``vec_id, x, h1, h2`` of the rows whose vector is neither null nor holds a null or non-finite entry."""
    v = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))
    rows = rows.where(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    beyond = F.exists(v, lambda c: F.abs(c) >= float(_MOST // scale))
    x = F.when(beyond, F.raise_error(F.lit("an entry is too large for exact sums"))).otherwise(
        F.transform(v, lambda c: F.floor(c * scale).cast("long") + shift))
    rows = rows.select("vec_id", x.cast("array<long>").alias("x"))
    return rows.withColumn("h1", F.xxhash64("x")).withColumn("h2", F.xxhash64(F.lit(1), "x"))


def _sums(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length: weight of the fit list and exact sum of each dimension."""

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for d, same in _by_length(batch):
                x, weight = _matrix(same.column("x")).astype(object), same.column("weight").to_numpy(zero_copy_only=False).astype(object)
                n, s = held.get(d, (0, 0))
                held[d] = n + sum(weight), s + (x * weight[:, None]).sum(axis=0)
        for d, (n, s) in held.items():
            rows = [{"d": d, "i": i, "n": n, "s": int(v)} for i, v in enumerate(s)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("d", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("s", pa.decimal128(38, 0))]))

    total = distinct.mapInArrow(per_task, "d int, i int, n long, s decimal(38,0)").groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in total.orderBy("d", "i").collect():  # d rows for each length d
        out.setdefault(r["d"], (r["n"], []))[1].append(int(r["s"]))
    return out


def _products(rows: DataFrame, centre: dict[int, tuple[int, list[int]]] | dict[int, tuple[float, np.ndarray]]) -> dict[int, np.ndarray]:
    """Per vector length: weighted sum of the products of all pairs of dimensions, centred first.

    ``rows``: x (whole numbers, centred exactly by n and sums) or doubles (centred by their means), weight.
    """

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, same in _by_length(batch):
                x, (n, of) = _matrix(same.column("x")), centre[d]
                x = whole_deviations(x, n, of).astype(np.float64) / n if x.dtype.kind == "i" else x - of
                held[d] = held.get(d, 0.0) + x.T @ (x * same.column("weight").to_numpy(zero_copy_only=False)[:, None])
        for d, product in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(product), pa.list_(pa.float64()))], names=["d", "i", "row"])

    def add(table: pa.Table) -> pa.Table:
        row = np.array(table.column("row").to_pylist()).sum(axis=0)
        return pa.table([table.column("d").slice(0, 1), table.column("i").slice(0, 1), pa.array([row], pa.list_(pa.float64()))], names=["d", "i", "row"])

    shape = "d int, i int, row array<double>"
    out: dict[int, list] = {}
    for r in rows.mapInArrow(per_task, shape).groupBy("d", "i").applyInArrow(add, shape).orderBy("d", "i").collect():  # d rows of d numbers
        out.setdefault(r["d"], []).append(r["row"])
    return {d: np.array(product) for d, product in out.items()}


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A whitening for each vector length of ``distinct`` (x, weight)."""
    sums = _sums(distinct)
    fits = {}
    for d, product in (_products(distinct, sums) if sums else {}).items():
        n, s = sums[d]
        covariance = (product + product.T) / (2 * n)
        fits[d] = Fit(n, s, *components_of(covariance, components), float(np.trace(covariance)))
    return fits


def whitened_distinct(distinct: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """``h1, h2, weight, d, deviation, x`` (the whitened components) of each distinct vector."""
    shape = "h1 long, h2 long, weight long, d int, deviation long, x array<double>"

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, same in _by_length(batch):
                own = fits[d]
                deviation = whole_deviations(_matrix(same.column("x")), own.n, own.sums)
                white = deviation.astype(np.float64) / own.n @ own.vectors / np.sqrt(own.values)
                yield pa.RecordBatch.from_arrays([
                    same.column("h1"), same.column("h2"), same.column("weight"), pa.array(np.full(same.num_rows, d, np.int32)),
                    pa.array(squared_lengths(deviation)), pa.array(list(white), pa.list_(pa.float64())),
                ], names=["h1", "h2", "weight", "d", "deviation", "x"])

    return distinct.mapInArrow(per_task, shape)


def identity_errors(white: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Per vector length, the largest entry of the covariance of the whitened fit list minus the identity."""
    errors = {d: 0.0 for d in fits}
    for d, own in fits.items():  # as many as there are vector lengths
        k = len(own.values)
        if not k:
            continue
        rows = white.where(F.col("d") == d).select("x", "weight")
        means = rows.select(F.posexplode("x").alias("i", "v"), "weight").groupBy("i").agg(F.sum(F.col("v") * F.col("weight")).alias("s"))
        mean = np.array([r["s"] for r in means.orderBy("i").collect()]) / own.n
        errors[d] = float(np.abs(_products(rows, {k: (1.0, mean)})[k] / own.n - np.eye(k)).max())
    return errors


def whitened(vectors: DataFrame, components: int = COMPONENTS, fit_copies: bool = False) -> DataFrame:
    """One row per row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries become x = floor(64 c) + 1000000. The fit list holds each distinct x vector once (``fit_copies``: as
    often as it occurs); n is its size, S its sums, V its covariance with divisor n. Components are
    the unit eigenvectors of V by falling eigenvalue e, from 1; ``whitened`` is (x - S/n) on the component over sqrt(e),
    ``explained`` e / trace(V), ``deviation`` the exact sum of (n x - S)^2.

    Rows whose vector is null or holds a null or non-finite entry are dropped; empty vectors have no component. Vectors
    of different lengths are fitted apart. Components whose eigenvalue is zero but for rounding have no
    whitening and give no rows, so a single distinct vector gives none. Repeated rows, and null ids, each give their own rows;
    an entry beyond 2^55, or a deviation beyond 63 bits, is an error. Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(whole_vectors(vectors))
    weight = F.count("*") if fit_copies else F.lit(1).cast("long")
    distinct = cut_lineage(rows.where(F.size("x") > 0).groupBy("h1", "h2", "x").agg(weight.alias("weight")))
    fits = fit(distinct, components)
    white = cut_lineage(whitened_distinct(distinct, fits))
    errors = identity_errors(white, fits)
    known = [(d, i + 1, own.n, float(e) / own.trace, errors[d]) for d, own in fits.items() for i, e in enumerate(own.values)]
    known = spark.createDataFrame(known, "d int, component int, n long, explained double, identity_error double")
    out = rows.select("vec_id", "h1", "h2").join(white, ["h1", "h2"])
    out = out.select("vec_id", "d", "deviation", F.posexplode("x").alias("i", "whitened")).withColumn("component", F.col("i") + 1)
    return out.join(F.broadcast(known), ["d", "component"]).select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
