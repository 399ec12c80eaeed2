"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become whole numbers. The fit list holds each distinct vector once, packed into blocks of rows. Sums per dimension
are exact; rows are centred, in whole numbers first, before they are multiplied.

With X the centred fit list, every step is one pass over the blocks: X c and X' (X c) for a vector c, summed over blocks;
only d + 1 numbers come back. c is chosen so that X c is the next left vector, alpha u = X v - beta u', before it is
normalised. Left vectors are as long as the table and are never stored: each is X w with a w of d numbers, which the driver
keeps with X' u. Since products with earlier left vectors are w' (X' X c), the new one is orthogonalised against all of
them, and each right vector against all earlier right vectors, twice. The steps give a bidiagonal matrix B with
X V = U B; its singular values and vectors give components and deviations.

Up to FULL_DIMS dimensions the basis is completed, so that equal eigenvalues are all found. Beyond, steps end when the
residuals of the wanted components are at rounding level. Where the recursion ends early, it goes on with a new direction.

Defined cases: vectors that are null or hold null or non-finite entries take no part; scaled entries are limited to 2**53
either way, beyond which doubles skip whole numbers; vectors of another length than the most frequent one (the longer of
two) take no part; rows that repeat an id or a vector each have their result, the fit list has the vector once; a null id
stays; components without variance are left out, so equal vectors, a single one or an empty table give an empty result;
`deviation` is null where the sum does not fit a long; further columns are passed over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import own_columns
from fiscalmill.sources.staging import stage

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(2**53)
COMPONENTS = 16
FULL_DIMS = 128
LOW_BITS = 20
ROUNDING = float(np.finfo(np.float64).eps)
NOTHING = 1e-12
"""Singular values below this share of the largest count as zero."""

Batches = Iterator[pa.RecordBatch]


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id and the whole-number vector x of the rows that take part."""
    own = own_columns(embeddings, "vec_id", "embedding").where(F.col("embedding").isNotNull())
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    limited = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform("embedding", lambda c: F.floor(limited(c)).cast("long") + F.lit(SHIFT).cast("long"))
    return own.where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _packed(dims: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_matrix(batch, dims).astype("<i8").tobytes()], pa.binary())], names=["rows"])

    return run


def _over_blocks(blocks: DataFrame, dims: int, size: int, of_block: Callable[[np.ndarray], np.ndarray], kind: str) -> list:
    """Sums of `size` numbers that `of_block` makes of each block; added up per task, then by Spark."""

    def run(batches: Batches) -> Batches:
        total = np.zeros(size, np.int64 if kind == "long" else np.float64)
        for batch in batches:
            for rows in batch.column("rows"):
                total += of_block(np.frombuffer(rows.as_py(), "<i8").reshape(-1, dims))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["at", "part"])

    parts = blocks.mapInArrow(run, f"at int, part {kind}")
    part = F.col("part").cast("decimal(38,0)") if kind == "long" else F.col("part")
    out = [0] * size
    for at, total in parts.groupBy("at").agg(F.sum(part).alias("total")).collect():
        out[at] = int(total) if kind == "long" else total
    return out


@dataclass(frozen=True)
class Centre:
    """Exact sums of the fit list, and how rows are centred: whole numbers first, then the rest of the mean."""

    n: int
    sums: list[int]

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([(s % self.n) / self.n for s in self.sums])

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        base, rest = self.base, self.rest
        return lambda x: (x - base).astype(np.float64) - rest

    def deviations(self) -> Callable[[np.ndarray], list[int | None]]:
        """Sum over dimensions of (n x - S)**2 of every row, exact; null beyond a long."""
        n, base, rests = self.n, self.base, [s % self.n for s in self.sums]

        def run(x: np.ndarray) -> list[int | None]:
            offset = x - base
            bound = n * (int(np.abs(offset).max(initial=0)) + 1)
            if bound < 1 << 31 and bound * bound * len(rests) < 1 << 63:
                d = n * offset - np.array(rests, np.int64)
                return (d * d).sum(axis=1).tolist()
            exact = [sum((n * v - r) ** 2 for v, r in zip(row, rests, strict=True)) for row in offset.tolist()]
            return [v if v < 1 << 63 else None for v in exact]

        return run


@dataclass(frozen=True)
class Model:
    """`vectors` has a unit component per column, `eigenvalues` fall, `trace` is that of the whole covariance."""

    centre: Centre
    vectors: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def project(self) -> Callable[[np.ndarray], np.ndarray]:
        centred, scaled = self.centre.centred(), self.vectors / np.sqrt(self.eigenvalues)
        return lambda x: centred(x) @ scaled


def _centre(blocks: DataFrame, dims: int) -> Centre:
    """Number of rows and sums per dimension, of high and low bits apart so that no sum overflows."""

    def of_block(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> LOW_BITS).sum(axis=0), (x & ((1 << LOW_BITS) - 1)).sum(axis=0)])

    n, *parts = _over_blocks(blocks, dims, 2 * dims + 1, of_block, "long")
    return Centre(n, [(high << LOW_BITS) + low for high, low in zip(parts[:dims], parts[dims:], strict=True)])


def _orthogonal(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """What is left of v beside the columns of `basis`; the second time takes away what rounding left."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def _new_direction(basis: np.ndarray, random: np.random.Generator) -> np.ndarray:
    v = _orthogonal(random.standard_normal(len(basis)), basis)
    return v / np.linalg.norm(v)


def fit(blocks: DataFrame, dims: int, wanted: int = COMPONENTS, seed: int = 1) -> Model | None:
    """Largest components of the rows in `blocks`, or None where nothing varies."""
    centre = _centre(blocks, dims)
    if centre.n == 0:
        return None
    centred, random = centre.centred(), np.random.default_rng(seed)

    def products(c: np.ndarray) -> tuple[np.ndarray, float]:
        """X' X c, and the sum of all squares of X."""

        def of_block(x: np.ndarray) -> np.ndarray:
            rows = centred(x)
            return np.append(rows.T @ (rows @ c), np.square(rows).sum())

        *z, squares = _over_blocks(blocks, dims, dims + 1, of_block, "double")
        return np.array(z), squares

    right, left, images = np.zeros((dims, 0)), np.zeros((dims, 0)), np.zeros((dims, 0))  # V; W with U = XW; X'U
    alphas, betas = [], []
    v, beta = _new_direction(right, random), 0.0
    while True:
        right = np.column_stack([right, v])
        c = v - beta * left[:, -1] if betas else v
        z, squares = products(c)
        if squares == 0:
            return None
        for _ in range(2):
            shared = left.T @ z
            c, z = c - left @ shared, z - images @ shared
        alpha = float(np.sqrt(max(0.0, c @ z)))
        zero = NOTHING * float(np.sqrt(squares))
        w, image = (c / alpha, z / alpha) if alpha > zero else (np.zeros(dims), np.zeros(dims))
        alpha = alpha if alpha > zero else 0.0
        left, images = np.column_stack([left, w]), np.column_stack([images, image])
        alphas.append(alpha)
        if len(alphas) == dims:
            break
        rest = _orthogonal(image - alpha * v, right)
        beta = float(np.linalg.norm(rest))
        ended = beta <= zero
        if not ended and dims > FULL_DIMS and len(alphas) >= wanted:
            p, sigma, _ = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
            if (beta * np.abs(p[-1, :wanted]) <= ROUNDING * sigma[:wanted]).all():
                break
        beta, v = (0.0, _new_direction(right, random)) if ended else (beta, rest / beta)
        betas.append(beta)
    _, sigma, q = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
    kept = min(wanted, int((sigma > NOTHING * sigma[0]).sum()))
    vectors = right @ q[:kept].T
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    return Model(centre, vectors, np.square(sigma[:kept]) / centre.n, squares / centre.n)


def identity_error(blocks: DataFrame, dims: int, model: Model) -> float:
    """Largest entry by which the covariance of the whitened fit list differs from the identity."""
    project, k = model.project(), len(model.eigenvalues)

    def of_block(x: np.ndarray) -> np.ndarray:
        y = project(x)
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    total = np.array(_over_blocks(blocks, dims, k + k * k, of_block, "double")) / model.centre.n
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def _applied(model: Model, dims: int, error: float) -> Callable[[Batches], Batches]:
    project, deviations, k = model.project(), model.centre.deviations(), len(model.eigenvalues)
    explained = model.eigenvalues / model.trace

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = _matrix(batch, dims)
            times = np.repeat(np.arange(len(x)), k)
            columns = {
                "vec_id": batch.column("vec_id").take(pa.array(times)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(times), model.centre.n, np.int64)),
                "deviation": pa.array(deviations(x), pa.int64()).take(pa.array(times)),
                "whitened": pa.array(project(x).ravel()),
                "explained": pa.array(np.tile(explained, len(x))),
                "identity_error": pa.array(np.full(len(times), error)),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(embeddings: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part and each component, see RESULT."""
    points = stage(quantised(embeddings), "points")
    nothing = points.sparkSession.createDataFrame([], RESULT)
    lengths = points.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    if usual is None or usual["dims"] == 0:
        return nothing
    dims = usual["dims"]
    points = points.where(F.size("x") == dims)
    blocks = stage(points.select("x").distinct().mapInArrow(_packed(dims), "rows binary"), "blocks")
    model = fit(blocks, dims, wanted)
    if model is None:
        return nothing
    return points.mapInArrow(_applied(model, dims, identity_error(blocks, dims, model)), RESULT)
