"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Vectors become integers, x = floor(64 c) + 1000000 per entry, and the fit list holds each distinct
x once. Its centred scatter is computed exactly: per-dimension sums S first, then each partition adds
up y y^T and y for y = x - m (m = S div n, integers, so the products stay small) and n C = n G - T T^T
follows in integers. The driver only ever holds d x d numbers.

The scatter C is factored by a pivoted Cholesky, C = P L L^T P^T, which stops at the numerical rank:
directions without variance are not whitened. One-sided Jacobi then rotates the columns of the
triangular factor G = P L until they are orthogonal, G J = B: C = G G^T = B B^T, so the rotated
columns' squared norms are C's eigenvalues and the normalised columns its eigenvectors, without ever
forming or diagonalising C itself (accurate even for small eigenvalues).

Every remaining row (copies included) is then projected: whitened = (x - S/n) . u_k / sqrt(e_k),
with (x - S/n) = (n x - S) / n taken in integers first. identity_error is measured, not assumed: the
covariance of the whitened fit list against the identity.

Defined cases: rows with a null vector or a null or non-finite entry are dropped; vectors of another
length than the most common one (ties: the shorter) are dropped too; an empty table, a single distinct
vector or a fit list without variance give no rows; a rank below 16 gives that many components; ties
among eigenvalues give some orthonormal basis of their space; null ids stay null; other input columns
are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

# Fixed values of the contract.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16

RANK_TOLERANCE = 1e-12  # pivoted Cholesky stops where the rest of the diagonal is below this share
SWEEPS = 60  # one-sided Jacobi sweeps at most; each sweep squares the remaining off-diagonal mass


def integer_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part, x as array<bigint>."""
    c = F.col(f"`{vector}`")
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(math.inf)))
    kept = df.where(c.isNotNull() & finite).select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.transform(c, lambda v: F.floor(v.cast("double") * SCALE) + F.lit(OFFSET)).alias("x"),
    )
    lengths = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").asc()).limit(1).collect()
    if not lengths:
        return kept.limit(0)
    return kept.where(F.size("x") == lengths[0]["d"])


def _rows(pdf: pd.DataFrame, column: str) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in pdf[column]]) if len(pdf) else np.zeros((0, 0), dtype=np.int64)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """n and S over the fit list, per partition then per dimension."""
    def part(batches):
        for pdf in batches:
            x = _rows(pdf, "x")
            if len(x):
                yield pd.DataFrame({"n": [len(x)], "s": [[int(v) for v in x.sum(axis=0, dtype=object)]]})

    parts = fit.mapInPandas(part, "n long, s array<long>")
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))  # noqa: E731  (partitions' sums added without overflow)
    totals = parts.select("n", F.posexplode("s")).groupBy("pos").agg(big("col").alias("s"), big("n").alias("n")).collect()
    if not totals:
        return 0, []
    totals = sorted(totals, key=lambda r: r["pos"])
    return int(totals[0]["n"]), [int(r["s"]) for r in totals]


def _scatter(fit: DataFrame, m: list[int]) -> tuple[np.ndarray, list[int]]:
    """G = sum (x - m)(x - m)^T and T = sum (x - m), exact integers (as Python ints)."""
    d = len(m)
    mean = np.array(m, dtype=object)

    def part(batches):
        for pdf in batches:
            x = _rows(pdf, "x")
            if not len(x):
                continue
            y = x.astype(object) - mean
            top = int(np.abs(y).max()) if y.size else 0
            if top * top * len(y) < 2**62:
                yi = y.astype(np.int64)
                g, t = (yi.T @ yi).ravel().tolist(), yi.sum(axis=0).tolist()
            else:  # beyond int64: Python integers
                g, t = (y.T @ y).ravel().tolist(), y.sum(axis=0).tolist()
            yield pd.DataFrame({"g": [[int(v) for v in g] + [int(v) for v in t]]})

    parts = fit.mapInPandas(part, "g array<long>")
    totals = parts.select(F.posexplode("g")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("v")).collect()
    totals = sorted(totals, key=lambda r: r["pos"])
    values = [int(r["v"]) for r in totals]
    gram = np.array(values[: d * d], dtype=object).reshape(d, d)
    return gram, values[d * d :]


def pivoted_cholesky(c: np.ndarray, tolerance: float = RANK_TOLERANCE) -> np.ndarray:
    """G (d x r) with C = G G^T, rows in C's order, r the numerical rank."""
    a = c.astype(np.float64).copy()
    d = len(a)
    perm = np.arange(d)
    factor = np.zeros((d, d))
    limit = tolerance * max(float(np.trace(a)), 0.0)
    rank = 0
    for k in range(d):
        rest = np.diag(a)[perm[k:]] - (factor[perm[k:], :k] ** 2).sum(axis=1)
        j = k + int(np.argmax(rest))
        if rest[j - k] <= limit or rest[j - k] <= 0:
            break
        perm[[k, j]] = perm[[j, k]]
        p = perm[k]
        pivot = math.sqrt(rest[j - k])
        factor[p, k] = pivot
        others = perm[k + 1 :]
        factor[others, k] = (a[others, p] - factor[others, :k] @ factor[p, :k]) / pivot
        rank = k + 1
    return factor[:, :rank]


def one_sided_jacobi(g: np.ndarray, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Rotate G's columns until orthogonal: (eigenvalues falling, unit eigenvectors as columns) of G G^T."""
    b = g.copy()
    r = b.shape[1]
    for _ in range(sweeps):
        turned = False
        for i in range(r - 1):
            for j in range(i + 1, r):
                alpha, beta, gamma = b[:, i] @ b[:, i], b[:, j] @ b[:, j], b[:, i] @ b[:, j]
                if abs(gamma) <= 1e-15 * math.sqrt(alpha * beta) or gamma == 0:
                    continue
                turned = True
                zeta = (beta - alpha) / (2 * gamma)
                t = math.copysign(1.0, zeta) / (abs(zeta) + math.sqrt(1 + zeta * zeta))
                cos = 1 / math.sqrt(1 + t * t)
                sin = cos * t
                bi, bj = b[:, i].copy(), b[:, j]
                b[:, i] = cos * bi - sin * bj
                b[:, j] = sin * bi + cos * bj
        if not turned:
            break
    else:
        raise ArithmeticError(f"one-sided Jacobi did not settle in {sweeps} sweeps")
    norms = np.sqrt((b * b).sum(axis=0))
    order = np.argsort(-norms, kind="stable")
    norms, b = norms[order], b[:, order]
    vectors = b / np.where(norms > 0, norms, 1.0)
    flip = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return norms**2, vectors * np.where(flip == 0, 1.0, flip)


OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: see the module's description."""
    spark = df.sparkSession
    rows = stored(integer_vectors(df, key, vector), "whitening-rows")
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    n, s = _sums(fit)
    empty = spark.createDataFrame([], OUTPUT)
    if n < 2:
        return empty
    m = [v // n for v in s]
    gram, t = _scatter(fit, m)
    t_vec = np.array(t, dtype=object)
    scatter_n = gram * n - np.outer(t_vec, t_vec)  # n C, exact
    c = np.array([[float(v) / n for v in row] for row in scatter_n])
    trace_v = float(sum(scatter_n[i, i] for i in range(len(s)))) / (n * n)
    g = pivoted_cholesky(c)
    if g.shape[1] == 0:
        return empty
    eig_c, u = one_sided_jacobi(g)
    k = min(components, len(eig_c))
    e = eig_c[:k] / n
    u = u[:, :k]
    project = u / np.sqrt(e)
    s_arr, explained = np.array(s, dtype=object), (e / trace_v).tolist()

    def centred(x: np.ndarray) -> np.ndarray:
        """n x - S, exact (object where int64 could overflow)."""
        if n * (int(np.abs(x).max()) + 1) < 2**62 and max(abs(v) for v in s) < 2**62:
            return x * n - np.array(s, dtype=np.int64)
        return x.astype(object) * n - s_arr

    def covariance(batches):
        for pdf in batches:
            x = _rows(pdf, "x")
            if len(x):
                w = (centred(x).astype(np.float64) / n) @ project
                yield pd.DataFrame({"w": [w.sum(axis=0).tolist() + (w.T @ w).ravel().tolist()]})

    sums = fit.mapInPandas(covariance, "w array<double>").select(F.posexplode("w")).groupBy("pos").agg(F.sum("col").alias("v")).collect()
    sums = np.array([r["v"] for r in sorted(sums, key=lambda r: r["pos"])])
    mean, second = sums[:k] / n, sums[k:].reshape(k, k) / n
    identity_error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())

    def score(batches):
        for pdf in batches:
            x = _rows(pdf, "x")
            if not len(x):
                continue
            diff = centred(x)
            if diff.dtype != object and int(np.abs(diff).max()) ** 2 * diff.shape[1] < 2**62:
                deviation = (diff * diff).sum(axis=1)
            else:
                deviation = np.array([sum(int(v) * int(v) for v in r) for r in diff], dtype=object)
            w = (diff.astype(np.float64) / n) @ project
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "deviation": [int(v) for v in deviation], "w": list(w)})

    scored = rows.mapInPandas(score, "vec_id long, deviation long, w array<double>")
    return scored.select(
        "vec_id", F.posexplode("w").alias("at", "whitened"), "deviation"
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(float(v)) for v in explained]), F.col("at") + 1).alias("explained"),
        F.lit(identity_error).alias("identity_error"),
    )


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened coordinates of every valid embedding on the first 16 principal components."""
    return whiten(table(spark, folder, "embeddings"))


QUERIES = {"op13_embedding_whitening": op13_embedding_whitening}
SQL: dict[str, str] = {}  # eigenvectors: no SQL; tests/llm compares with numpy's eigh on the exact covariance
