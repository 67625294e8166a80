"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never multiplied into a covariance matrix.  Each step
takes a right vector v, forms the left vector u = Xv (less its parts along the
earlier left vectors) and the product X'u, whose part outside the right
vectors so far is the next v.  Both families are reorthogonalised in full, the
coefficients are kept, so X V = U B holds to rounding with a small triangular
B (bidiagonal but for rounding and restarts); its singular value decomposition
yields the components and their deviations, and one more pass sets right the last digits of the small ones.

On the cluster a step is one job over the rows: a left vector has one entry a
row and is not stored but written as u = X w with a short w, so a task computes
its rows' entries and at once their share of |u|^2 and of X'u; the shares are
summed per dimension in a shuffle, and only the d sums come to the driver.
U'u is W'(X'u), again short.  What the driver holds grows with the vectors'
width d and the number of steps, never with the rows.

The run ends when every wanted triplet has a residual of rounding size and a
restart with a fresh random vector has found nothing larger (one start cannot
see a repeated singular value twice), or when the right vectors span all dimensions.

Rows are staged once as blocks of whole numbers, each in the narrowest type
that holds it, and centred in the tasks before any product.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out; other rows stay, with a null or repeated id too; shorter vectors are filled up with
entries 0; directions without variance (at most RANK of the largest deviation)
are no components, so one row, equal rows or an empty table give no rows;
64 * c beyond 2^53 and a deviation beyond a long raise an error; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import read_table
from tidewatch.session import stage_table

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
BLOCK_ENTRIES = 1 << 18  # numbers of one staged block
CONVERGED = 1e-13  # residual of a triplet, of the largest deviation
RANK = 1e-7  # smaller deviations, of the largest, are none: w has no more digits
SLIGHT = 1e-5  # parts along earlier vectors that one more pass need not remove; smaller remainders are made orthogonal anew
NOISE = 1e-11
PROBE = 10  # steps after a restart before the triplets count as settled
SEED = 12
LARGEST = float(1 << 53)
BLOCKS = "ids array<bigint>, rows int, width int, kind string, data binary"


def blocks(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows in blocks: ids, and floor(scale * entry) as a matrix of whole numbers."""
    def bad(x):
        d = x.cast("double")
        return x.isNull() | F.isnan(d) | (F.abs(d) == float("inf"))

    kept = (vectors.filter(F.col(vec_col).isNotNull() & ~F.exists(vec_col, bad))
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("id"), batch.column("v")
            length = column.value_lengths().to_numpy()
            at = 0
            while at < batch.num_rows:
                width = int(length[at:].max())
                n = min(batch.num_rows - at, max(1, BLOCK_ENTRIES // max(1, width)))
                part, own = column.slice(at, n), length[at:at + n]
                width = int(own.max())
                x = np.zeros((n, width))
                x[np.arange(width) < own[:, None]] = np.floor(part.flatten().to_numpy() * scale)
                if x.size and np.abs(x).max() > LARGEST:
                    raise ValueError(f"an entry times {scale} is beyond 2^53")
                x = x.astype(np.int64)
                kind = np.result_type(np.min_scalar_type(min(0, int(x.min(initial=0)))), np.min_scalar_type(-1 - int(x.max(initial=0))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.slice(at, n).to_pylist()], pa.list_(pa.int64())), pa.array([n], pa.int32()), pa.array([width], pa.int32()),
                     pa.array([kind.str]), pa.array([x.astype(kind).tobytes()], pa.binary())], names=["ids", "rows", "width", "kind", "data"])
                at += n

    return kept.mapInArrow(pack, BLOCKS)


def _each(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list, np.ndarray]]:
    """(ids, whole numbers) of the staged blocks, filled up to one width."""
    for batch in batches:
        for row in batch.to_pylist():
            x = np.frombuffer(row["data"], dtype=np.dtype(row["kind"])).reshape(row["rows"], row["width"])
            yield row["ids"], np.pad(x, ((0, 0), (0, width - row["width"]))) if row["width"] < width else x


def _summed(staged: DataFrame, width: int, length: int, share: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``share(block)`` (``length`` numbers) over all blocks: added up in the tasks, then place by place."""
    numbers = np.float64 if kind == "double" else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, dtype=numbers)
        for _, x in _each(batches, width):
            total += share(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length, dtype=np.int32)), pa.array(total)], names=["place", "value"])

    out = np.zeros(length, dtype=numbers)
    for r in staged.mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return out


class Components:
    """Unit eigenvectors of the covariance, as rows by falling eigenvalue, and what they rest on."""

    def __init__(self, n: int, sums: np.ndarray, vectors: np.ndarray, eigenvalues: np.ndarray, trace: float):
        self.n, self.sums, self.vectors, self.eigenvalues, self.trace = n, sums, vectors, eigenvalues, trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, by the whole part of the mean first: no digits are lost to a large mean."""
        whole, rest = np.divmod(self.sums, self.n)
        return (x - whole) - rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.eigenvalues)[:, None]).T


def bidiagonalise(step: Callable[[np.ndarray], tuple[float, np.ndarray]], products: Callable[[np.ndarray], np.ndarray], width: int,
                  wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest singular values of X and their right vectors (as rows).

    ``step(w)`` gives |Xw|^2 and X'Xw, ``products(M)`` gives (XM)'XM, with X's rows spread over the cluster."""
    rng = np.random.default_rng(seed)
    v_all, w_all, g_all = np.zeros((0, width)), np.zeros((0, width)), np.zeros((0, width))  # v; u = Xw; g = X'u
    b = np.zeros((0, 0))
    top, settled_at = 0.0, None

    def outside(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - v_all.T @ (v_all @ v)
        return v

    def fresh() -> np.ndarray:
        v = outside(rng.normal(size=width))
        return v / np.linalg.norm(v)

    v = fresh()
    while True:
        v_all = np.vstack([v_all, v])
        # the left vector: Xv less its parts along the earlier ones, twice
        coefficients = g_all @ v
        w = v - coefficients @ w_all
        for _ in range(3):
            square, g = step(w)
            again = w_all @ g
            coefficients, w = coefficients + again, w - again @ w_all
            if again @ again <= SLIGHT**2 * square:  # so little that the products need no new pass
                g, square = g - again @ g_all, square - again @ again
                break
        size = np.sqrt(max(square, 0.0))
        top = max(top, size, float(np.abs(coefficients).max(initial=0.0)))
        b = np.hstack([b, coefficients[:, None]])
        if size > max(0.1 * RANK, NOISE * np.linalg.norm(w)) * top:  # more than rounding makes of w
            w_all, g_all = np.vstack([w_all, w / size]), np.vstack([g_all, g / size])
            b = np.vstack([b, np.append(np.zeros(b.shape[1] - 1), size)])
            v = outside(g / size)
            if 0 < np.linalg.norm(v) < SLIGHT * top:
                v = np.linalg.norm(v) * outside(v / np.linalg.norm(v))
        else:
            v = np.zeros(width)  # Xv lies among the left vectors already
        if len(v_all) == width:
            break
        p, sigma, q = np.linalg.svd(b, full_matrices=False)
        top = max(top, float(sigma.max(initial=0.0)))
        if len(sigma) >= wanted:
            residual = g_all.T @ p[:, :wanted] - v_all.T @ (q[:wanted].T * sigma[:wanted])
            if np.linalg.norm(residual, axis=0).max() <= CONVERGED * top:
                if settled_at is None:
                    settled_at, v = len(v_all), np.zeros(width)
                elif len(v_all) >= settled_at + PROBE:
                    break
            else:
                settled_at = None if settled_at is not None and len(v_all) >= settled_at + PROBE else settled_at
        v = v / np.linalg.norm(v) if np.linalg.norm(v) > 1e-3 * RANK * top else fresh()
    if not len(b):
        return np.zeros(0), np.zeros((0, width))
    # the small triplets, to the last digits: their images in units of their deviations are nearly orthonormal,
    # and what they lack of it, measured over all rows, goes into a second small decomposition
    _, sigma, q = np.linalg.svd(b, full_matrices=False)
    q, scale = q @ v_all, np.maximum(sigma, RANK * sigma[0])
    share, turn = np.linalg.eigh(products(q.T / scale))
    _, sigma, again = np.linalg.svd(np.sqrt(np.maximum(share, 0.0))[:, None] * turn.T * scale)
    keep = min(wanted, int((sigma > RANK * sigma[0]).sum()))
    return sigma[:keep], again[:keep] @ q


def fit(staged: DataFrame, components: int = COMPONENTS, seed: int = SEED) -> Components | None:
    """Components of the staged rows; None if there are none."""
    shape = staged.agg(F.max("width").alias("width"), F.sum(F.col("rows").cast("long")).alias("n")).first()
    width, n = shape["width"] or 0, shape["n"] or 0
    if not width:
        return None
    sums = _summed(staged, width, width, lambda x: x.sum(axis=0, dtype=np.int64), "long")
    found = Components(n, sums, np.zeros((0, width)), np.zeros(0), 0.0)

    def step(w: np.ndarray) -> tuple[float, np.ndarray]:
        def share(x: np.ndarray) -> np.ndarray:
            x = found.centred(x)
            u = x @ w
            return np.append(x.T @ u, u @ u)

        total = _summed(staged, width, width + 1, share)
        return float(total[-1]), total[:-1]

    def products(m: np.ndarray) -> np.ndarray:
        def share(x: np.ndarray) -> np.ndarray:
            z = found.centred(x) @ m
            return (z.T @ z).ravel()

        return _summed(staged, width, m.shape[1] ** 2, share).reshape(m.shape[1], -1)

    found.trace = float(_summed(staged, width, width, lambda x: (found.centred(x) ** 2).sum(axis=0)).sum()) / n
    if found.trace == 0:
        return None
    sigma, vectors = bidiagonalise(step, products, width, min(components, width), seed)
    found.vectors, found.eigenvalues = vectors, sigma**2 / n
    return found


def identity_error(staged: DataFrame, found: Components) -> float:
    """Largest entry of the whitened rows' covariance less the identity, measured over all rows."""
    k, width = len(found.eigenvalues), len(found.sums)

    def share(x: np.ndarray) -> np.ndarray:
        z = found.whitened(x)
        return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])

    total = _summed(staged, width, k * k + k, share) / found.n
    mean = total[k * k:]
    return float(np.abs(total[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Sum over dimensions of (n x - sum)^2, exactly."""
    if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + int(np.abs(sums).max(initial=0)) < 1 << 62:
        m = n * x.astype(np.int64) - sums
        if int(np.abs(m).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return (m * m).sum(axis=1)
    m = (n * x.astype(object) - sums.astype(object)) ** 2
    return np.array(m.sum(axis=1).tolist(), dtype=np.int64)  # raises beyond a long


def whitened(staged: DataFrame, found: Components) -> DataFrame:
    """(vec_id, component, deviation, whitened) of every staged row and component."""
    k, width = len(found.eigenvalues), len(found.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _each(batches, width):
            rows = np.repeat(np.arange(len(ids)), k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                 pa.array(_deviation(x, found.n, found.sums)[rows]), pa.array(found.whitened(x).ravel())],
                names=["vec_id", "component", "deviation", "whitened"])

    return staged.mapInArrow(run, "vec_id long, component int, deviation long, whitened double")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 32 whitened components of every vector of ``embeddings``.

    The offset of every entry moves no centred number, so the rows are kept without it."""
    staged = stage_table(blocks(read_table(spark, sf_dir, "embeddings")), "whitening-blocks")
    found = fit(staged)
    if found is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    explained = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues])
    return whitened(staged, found).select(
        "vec_id", "component", F.lit(found.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("component")).alias("explained"), F.lit(identity_error(staged, found)).alias("identity_error"))
