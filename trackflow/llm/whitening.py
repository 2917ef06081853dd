"""Whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The fit list X (each distinct vector once, centred) stays distributed. Every step of the
bidiagonalisation is one pass over it: u = Xp and X'u are partial sums per batch, so a task holds one
Arrow batch and the driver a few vectors of the width of X. Left vectors have as many entries as X has
rows and are never stored: each is X times a short vector, which a task applies again to its rows to
reorthogonalise u against all earlier ones. Right vectors are reorthogonalised twice on the driver.

The bidiagonal matrix has at most as many rows as X has columns. Its singular value decomposition
gives the components, and the deviations along them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.llm.shared import stored

# Entries become whole numbers: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**40  # a larger entry has no exact place among the whole numbers used
MOST = (1 << 63) - 1


@dataclass(frozen=True)
class Plan:
    components: int = 16
    tolerance: float = 1e-13  # residual of a converged component, against the largest deviation
    null: float = 1e-10  # a smaller deviation, against the largest, counts as none
    seed: int = 13


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its size, sums, components (columns), variances along them."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    steps: int


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def whole_rows(vectors: DataFrame, id: str, column: str) -> DataFrame:
    """id and x of the rows whose vector can be used."""
    v = F.col(column).cast("array<double>")
    sound = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))
    rows = vectors.select(F.col(id).alias("id"), v.alias("_v")).where(F.col("_v").isNotNull() & (F.size("_v") > 0))
    return rows.where(sound).select("id", F.transform("_v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x"))


def _sums(fit: DataFrame, measure: Callable[[np.ndarray], np.ndarray], width: int, size: int, kind: str) -> list:
    """Sum over the rows of what measure gives for a batch of them; size numbers come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = measure(matrix(batch.column("x"), width))
                total = part if total is None else total + part
                if kind == "long":  # long sums stay small: one record per batch
                    yield pa.RecordBatch.from_pydict({"place": pa.array(range(size), pa.int32()), "value": pa.array(total)})
                    total = None
        if total is not None:
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(size), pa.int32()), "value": pa.array(total)})

    parts = fit.select("x").mapInArrow(run, f"place int, value {kind}")
    value = F.col("value").cast("decimal(38,0)") if kind == "long" else F.col("value")
    found = {r.place: r.total for r in parts.groupBy("place").agg(F.sum(value).alias("total")).collect()}
    return [found.get(i, 0) for i in range(size)]


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: as 64-bit integers where they suffice, else as Python's."""
    top = max(abs(int(x.max())), abs(int(x.min())), 1)
    if n * top + max(abs(int(s)) for s in sums) <= MOST:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums.astype(object)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(np.float64)


def bidiagonalise(
    products: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, float, np.ndarray]], width: int, trace: float, plan: Plan
) -> tuple[np.ndarray, np.ndarray, int]:
    """(components, singular values, steps) of X from products with it.

    products(M, p) gives (XM)'u, u'u and X'u for u = Xp. Goes on until the wanted components have
    converged and what the trace leaves is too little for another one, or all of X is spanned."""
    rng = np.random.default_rng(plan.seed)
    wanted = min(plan.components, width)

    def fresh(v: np.ndarray) -> np.ndarray:
        new = rng.standard_normal(width)
        for _ in range(2):
            new = new - v @ (v.T @ new)
        return new / np.linalg.norm(new)

    V = np.zeros((width, 0))
    M = np.zeros((width, 0))  # u_i = X m_i
    XU = np.zeros((width, 0))  # X'u_i
    alphas: list[float] = []
    betas: list[float] = []
    v, beta = fresh(V), 0.0
    while True:
        V = np.column_stack((V, v))
        p = v - beta * M[:, -1] if beta else v
        overlap, square, back = products(M, p)
        # The component along earlier left vectors is taken out of u, of its length and of X'u.
        p, back = p - M @ overlap, back - XU @ overlap
        alpha = float(np.sqrt(max(square - overlap @ overlap, 0.0)))
        scale = np.sqrt(trace)
        if alpha <= plan.null * scale:
            alpha, m, back = 0.0, np.zeros(width), np.zeros(width)
        else:
            m, back = p / alpha, back / alpha
        M, XU = np.column_stack((M, m)), np.column_stack((XU, back))
        alphas.append(alpha)
        w = back - alpha * v
        for _ in range(2):
            w = w - V @ (V.T @ w)
        beta = float(np.linalg.norm(w)) if alpha else 0.0
        k = len(alphas)
        B = np.diag(alphas) + np.diag(betas, 1)
        left, values, right = np.linalg.svd(B)
        residuals = beta * np.abs(left[-1])
        spare = trace - float(values @ values)
        enough = k >= wanted and spare <= values[wanted - 1] ** 2
        if k == width or (enough and residuals[:wanted].max() <= plan.tolerance * values[0]):
            return V @ right.T, values, k
        if beta <= plan.null * scale:  # X leaves this span to itself: go on in the rest
            v, beta = fresh(V), 0.0
        else:
            v = w / beta
        betas.append(beta)


def fit_whitening(fit: DataFrame, width: int, plan: Plan = Plan()) -> Whitening | None:
    """Components of a stored fit list of distinct x of this width; None where nothing varies."""
    n = fit.count()
    shifted = _sums(fit, lambda x: (x - SHIFT).sum(axis=0), width, width, "long")
    sums = np.array([int(s) + n * SHIFT for s in shifted], object)
    if n < 2:
        return None
    trace = float(_sums(fit, lambda x: np.array([np.square(centred(x, n, sums)).sum()]), width, 1, "double")[0])
    if trace <= 0:
        return None

    def products(M: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        k = M.shape[1]

        def measure(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            u = c @ p
            return np.concatenate(((c @ M).T @ u, [u @ u], c.T @ u))

        got = np.array(_sums(fit, measure, width, k + 1 + width, "double"))
        return got[:k], float(got[k]), got[k + 1 :]

    components, values, steps = bidiagonalise(products, width, trace, plan)
    kept = min(plan.components, int((values > plan.null * values[0]).sum()))
    return Whitening(n, tuple(sums), components[:, :kept], np.square(values[:kept]) / n, trace / n, steps)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    width, k = model.components.shape
    sums, whiten = np.array(model.sums, object), model.components / np.sqrt(model.variances)

    def measure(x: np.ndarray) -> np.ndarray:
        w = centred(x, model.n, sums) @ whiten
        return (w.T @ w).ravel()

    got = np.array(_sums(fit, measure, width, k * k, "double")).reshape(k, k) / model.n
    return float(np.abs(got - np.eye(k)).max())


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """id, deviation, whitened (a list): rows of id and x as wide as the model's.

    The deviation is null where it is no 64-bit number."""
    width = len(model.sums)
    sums, whiten = np.array(model.sums, object), model.components / np.sqrt(model.variances)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d = deviations(matrix(batch.column("x"), width), model.n, sums)
            largest = max(abs(int(d.max())), abs(int(d.min())))
            if width * largest * largest > MOST:
                d = d.astype(object)
            squares = (d * d).sum(axis=1)
            w = (d / model.n).astype(np.float64) @ whiten
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "deviation": pa.array([int(s) if s <= MOST else None for s in squares], pa.int64()),
                    "whitened": pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), w.shape[1]).cast(pa.list_(pa.float64())),
                }
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x").mapInArrow(run, f"id {kind}, deviation long, whitened array<double>")


def whiten(vectors: DataFrame, id: str = "vec_id", column: str = "embedding", plan: Plan = Plan()) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row per row and component.

    Rows whose vector is null, empty, or holds null or non-finite entries (or ones beyond 2**40) are
    dropped; null and repeated ids are kept, equal vectors are fitted once. Vectors of different
    lengths are whitened apart, each length by its own fit list. Components of no variance have no
    rows, so a table of equal vectors gives none. Other columns are ignored."""
    spark = vectors.sparkSession
    rows = whole_rows(vectors, id, column)
    fits = stored(rows.select("x").distinct().withColumn("width", F.size("x")), "whitening-fit")
    out: DataFrame | None = None
    # One entry per vector length, which is one in a table of embeddings.
    for width in sorted(r.width for r in fits.select("width").distinct().collect()):
        fit = fits.where(F.col("width") == width)
        model = fit_whitening(fit, width, plan)
        if model is None:
            continue
        error = identity_error(fit, model)
        shares = F.array(*[F.lit(float(e)) for e in model.variances / model.trace])
        found = transform(rows.where(F.size("x") == width), model)
        found = found.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
            F.col("id").alias(id), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
            "deviation", "whitened", shares[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
        )
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = vectors.schema[id].dataType.simpleString()
        schema = f"{id} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], schema)
    return out
