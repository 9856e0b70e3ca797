"""Whitening of embeddings by matrix-free block Lanczos with full reorthogonalisation.

The covariance is never formed. A pass over the vectors gives, for a block of directions Q, the sum of (x - mean)(x - mean)'Q:
every task centres its vectors, multiplies them by the block and back, and adds up; the partial sums of tasks are added by place,
so the driver gets one matrix of the block's shape. The block's images are orthogonalised against all directions so far, twice, and make
the next block; directions that vanish are replaced by new random ones (a breakdown), and where the basis is full, the best
Ritz vectors and their residuals start a new one (a restart). Images of all directions are kept, so residuals of the Ritz
pairs cost no pass: the work ends when those of all components asked for are at rounding level, or when the basis is the
whole space. The trace of the covariance comes from the rows' own deviations and gives the components' shares.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Directions of a block, and of a basis at most (a multiple of the block; at least what restarting needs).
BLOCK, BASIS = 8, 512
#: Residuals are at rounding level below this share of the largest eigenvalue; eigenvalues below are those of a direction without variance.
RESIDUAL, NO_VARIANCE = 4e-15, 1e-11
#: Passes over the data at most; more is an error, not a rougher result.
PASSES = 2000
#: Vectors that are multiplied at once, in numbers.
TOGETHER = 1 << 20
LARGEST = (1 << 63) - 1


@dataclass
class Fit:
    """n vectors of one width with sums per dimension, and the components of their covariance: unit columns by falling eigenvalue.
    passes counts products with the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int
    restarts: int
    breakdowns: int


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): rows whose vector holds neither nulls nor non-finite entries, as doubles. An entry whose whole number has no
    place in a long (from 2^62 / 1024 on) takes its vector out like a non-finite one."""
    limit = float((1 << 62) // SCALE)
    ok = f"{vector} is not null and forall({vector}, x -> x is not null and not isnan(x) and abs(cast(x as double)) < {limit:.0f}D)"
    return embeddings.where(ok).select("vec_id", F.col(vector).cast("array<double>").alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Whole numbers of a batch of vectors of one width."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    return np.floor(flat * SCALE).astype(np.int64) + SHIFT


def _pieces(x: np.ndarray):
    step = max(1, TOGETHER // max(1, x.shape[1]))
    for a in range(0, len(x), step):
        yield x[a : a + step]


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: long where that is sure to fit, else Python integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most <= LARGEST:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(np.float64)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Sums of squares of n * x - S, exact: long where they are sure to fit, else Python integers."""
    t = _numerators(x, n, sums)
    most = max(abs(int(t.max())), abs(int(t.min()))) if t.size else 0
    if most * most * max(1, t.shape[1]) <= LARGEST:
        return (t.astype(np.int64) ** 2).sum(axis=1)
    return (t.astype(object) ** 2).sum(axis=1)


def _summed(vectors: DataFrame, run, kind: str = "double", of: str = "double") -> dict[int, object]:
    """run(batches) yields arrays of numbers; their sums by place over all tasks, one number a place."""

    def rows(batches):
        total = run(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["place", "number"])

    out = vectors.select("v").mapInArrow(rows, f"place int, number {kind}").groupBy("place").agg(F.sum(F.col("number").cast(of)).alias("number"))
    return {r["place"]: r["number"] for r in out.collect()}


def totals(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of their whole numbers."""

    def run(batches):
        total = np.zeros(1 + 2 * width, np.int64)  # high and low halves, so that sums of a task fit
        for batch in batches:
            x = _matrix(batch.column(0), width)
            total[0] += len(x)
            total[1 : 1 + width] += (x >> 32).sum(axis=0)
            total[1 + width :] += (x & 0xFFFFFFFF).sum(axis=0)
        return total

    got = _summed(vectors, run, "bigint", "decimal(38,0)")
    if not got:
        return 0, [0] * width
    return int(got[0]), [(int(got[1 + j]) << 32) + int(got[1 + width + j]) for j in range(width)]


def _products(vectors: DataFrame, n: int, sums: list[int], block: np.ndarray) -> tuple[np.ndarray, float]:
    """Covariance times block, and the trace, in one pass."""
    width, b = block.shape
    sent = vectors.sparkSession.sparkContext.broadcast((block.tobytes(), b, sums, n))

    def run(batches):
        raw, b, sums, n = sent.value
        q = np.frombuffer(raw).reshape(-1, b)
        total, deviations = np.zeros(q.shape), 0.0
        for batch in batches:
            for x in _pieces(_matrix(batch.column(0), len(q))):
                c = _centred(x, n, sums)
                total += c.T @ (c @ q)
                deviations += float((_deviations(x, n, sums) / (n * n)).sum())
        return np.append(total.ravel(), deviations)

    got = _summed(vectors, run)
    sent.unpersist()
    flat = np.array([got[i] for i in range(width * b + 1)], np.float64) / n
    return flat[:-1].reshape(width, b), float(flat[-1])


class Basis:
    """Orthonormal directions and their images."""

    def __init__(self, width: int, seed: int = 11):
        self.q, self.image = np.zeros((width, 0)), np.zeros((width, 0))
        self.rng = np.random.default_rng(seed)
        self.breakdowns = 0

    def next(self, candidates: np.ndarray, size: int) -> np.ndarray:
        """Up to `size` orthonormal directions that are orthogonal to the basis: candidates first; those that vanish are replaced by random ones."""
        width, out = len(self.q), np.zeros((len(self.q), 0))
        queue = list(candidates.T)
        while out.shape[1] < size and self.q.shape[1] + out.shape[1] < width:
            drawn = not queue
            v = self.rng.normal(size=width) if drawn else queue.pop(0)
            length = np.linalg.norm(v)
            if length == 0:
                self.breakdowns += 1
                continue
            v, kept = v / length, 1.0
            for _ in range(3):
                w = v - self.q @ (self.q.T @ v)
                w -= out @ (out.T @ w)
                norm = np.linalg.norm(w)
                kept *= norm
                if kept < 1e-10:
                    break
                v = w / norm
            if kept < 1e-10:
                self.breakdowns += not drawn
                continue
            out = np.column_stack([out, v])
        return out

    def add(self, block: np.ndarray, image: np.ndarray) -> None:
        self.q, self.image = np.column_stack([self.q, block]), np.column_stack([self.image, image])

    def ritz(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values, vectors and residual vectors of the k largest Ritz pairs."""
        t = self.q.T @ self.image
        values, y = np.linalg.eigh((t + t.T) / 2)
        values, y = values[::-1][:k], y[:, ::-1][:, :k]
        vectors = self.q @ y
        return values, vectors, self.image @ y - vectors * values


def lanczos(product, width: int, k: int, block: int = BLOCK, most: int = BASIS) -> tuple[np.ndarray, np.ndarray, dict]:
    """The k largest eigenpairs of a symmetric operator given by product(block of columns): values, unit columns, counts."""
    basis, k, block = Basis(width), min(k, width), min(block, width)
    most = max(most, 2 * (k + block))
    passes = restarts = 0
    candidates = np.zeros((width, 0))
    while True:
        new = basis.next(candidates, block)
        if new.shape[1]:
            image = product(new)
            passes += 1
            basis.add(new, image)
        values, vectors, residuals = basis.ritz(k)
        scale = max(abs(values[0]), np.finfo(float).tiny)
        settled = len(values) == k and (np.linalg.norm(residuals, axis=0) <= RESIDUAL * scale).all()
        if settled or basis.q.shape[1] == width:
            return values, vectors / np.linalg.norm(vectors, axis=0), {"passes": passes, "restarts": restarts, "breakdowns": basis.breakdowns}
        if passes >= PASSES:
            raise ArithmeticError(f"no convergence after {passes} passes")
        candidates = image
        if basis.q.shape[1] + block > most:
            # the Ritz vectors wanted and as many spare ones stay, with their images; residuals lead on
            values, vectors, residuals = basis.ritz(k + block)
            kept, _ = np.linalg.qr(vectors)
            turned = np.linalg.lstsq(basis.q, kept, rcond=None)[0]
            basis.q, basis.image = kept, basis.image @ turned
            candidates = residuals[:, :block]
            restarts += 1


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Fit:
    """Components of the covariance of all vectors (v array<double>, all of this width). Directions without variance are none."""
    n, sums = totals(vectors, width)
    if n == 0 or width == 0:
        return Fit(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0, 0, 0, 0)
    trace = 0.0

    def product(block: np.ndarray) -> np.ndarray:
        nonlocal trace
        out, trace = _products(vectors, n, sums, block)
        return out

    values, found, counts = lanczos(product, width, components)
    there = values > max(NO_VARIANCE * max(values[0], 0.0), 0.0)
    return Fit(n, sums, values[there], found[:, there], trace, **counts)


def width_of(vectors: DataFrame) -> int:
    """The width that most vectors have; the smaller of equally frequent ones, 0 without vectors."""
    top = vectors.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").first()
    return top["width"] if top else 0


def _whitened(x: np.ndarray, n: int, sums: list[int], vectors: np.ndarray, values: np.ndarray) -> np.ndarray:
    return _centred(x, n, sums) @ vectors / np.sqrt(values)


def identity_error(vectors: DataFrame, fitted: Fit) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, from a pass over all vectors."""
    k, width = len(fitted.values), len(fitted.sums)
    model = (fitted.n, fitted.sums, fitted.vectors.tobytes(), fitted.values.tobytes())
    sent = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        n, sums, found, values = sent.value
        values = np.frombuffer(values)
        found = np.frombuffer(found).reshape(-1, len(values))
        total = np.zeros((k + 1, k))
        for batch in batches:
            for x in _pieces(_matrix(batch.column(0), width)):
                w = _whitened(x, n, sums, found, values)
                total[:k] += w.T @ w
                total[k] += w.sum(axis=0)
        return total.ravel()

    got = _summed(vectors, run)
    flat = np.array([got[i] for i in range(k * (k + 1))]).reshape(k + 1, k) / fitted.n
    covariance = flat[:k] - np.outer(flat[k], flat[k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: of every usable row and component.

    The fit list is all usable rows. Vectors of another width than most have are of another space and take no part. Rows that repeat
    are fitted and returned each; a null vec_id stays null. Directions without variance are no components: fewer rows, or
    none where all vectors agree, and none for no vectors. deviation is exact; it is null where it has no place in a long (from
    about 10^8 vectors on, when entries differ by thousands), while the trace is still summed from all deviations. Every pass reads the
    vectors' column of the input; columns of other names are not read.
    """
    spark = embeddings.sparkSession
    vectors = usable(embeddings, vector)
    width = width_of(vectors)
    vectors = vectors.where(F.size("v") == width)
    fitted = fit(vectors, width, components)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    k = len(fitted.values)
    if k == 0:
        return vectors.where("false").select("vec_id", *(F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in schema.split(", ")[1:])))
    error = identity_error(vectors, fitted)
    sent = spark.sparkContext.broadcast((fitted.n, fitted.sums, fitted.vectors.tobytes(), fitted.values.tobytes(), fitted.trace))

    def run(batches):
        n, sums, found, values, trace = sent.value
        values = np.frombuffer(values)
        found = np.frombuffer(found).reshape(-1, k)
        for batch in batches:
            at = 0
            for x in _pieces(_matrix(batch.column(1), width)):
                rows = np.repeat(np.arange(at, at + len(x)), k)
                at += len(x)
                deviation = _deviations(x, n, sums)
                if deviation.dtype == object:
                    deviation = pa.array([d if d <= LARGEST else None for d in deviation for _ in range(k)], pa.int64())
                else:
                    deviation = pa.array(np.repeat(deviation, k))
                arrays = [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(np.full(len(rows), n)), deviation]
                arrays += [pa.array(_whitened(x, n, sums, found, values).ravel()), pa.array(np.tile(values / trace, len(x))), pa.array(np.full(len(rows), error))]
                yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, schema)
