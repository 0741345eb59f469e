"""Embedding whitening by Jacobi-Davidson on a covariance that is never formed.

Vectors become whole numbers, written once in packed blocks. A product of the covariance with a few
columns is one pass over the blocks: each task centres its rows and adds up ``y (y' u)``, the sums meet in
a fixed number of groups. The driver holds only matrices of the dimension times the search space.

Outer loop: Rayleigh-Ritz in the search space; pairs whose residual reached double precision are
locked, from the largest on. For the leading open pairs the correction equations, projected off locked and
current vectors, are solved by a few steps of MINRES, all columns in one pass a step; the corrections widen
the space, which restarts from its leading vectors when it is full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import ship, stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Rows of a packed block; groups in which the sums of all tasks meet.
BLOCK_ROWS = 4096
GROUPS = 16
#: Vectors of the search space beyond the wanted ones, at the start and at most; MINRES steps of one correction.
GUARD = 8
ROOM = 64
INNER = 8
#: A pair is locked at this residual, as a share of the largest eigenvalue; below RANK of it an eigenvalue counts as zero.
DOUBLE = 2.0 ** -46
RANK = 2.0 ** -40
OUTER = 200
#: Whole numbers up to this size are exact in a double.
LARGEST = 2.0 ** 52


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of ``apply(x) = b``, each column a symmetric system of its own, by MINRES:
    Lanczos vectors, a QR of their tridiagonal matrix by Givens rotations, and short recurrences."""
    x, w, w_old = (np.zeros_like(b) for _ in range(3))
    v_old, y = np.zeros_like(b), b.copy()
    beta = np.linalg.norm(b, axis=0)
    rest, small = beta.copy(), 1e-14 * beta
    cos, cos_old, sin, sin_old = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    open_ = beta > 0
    for _ in range(steps):
        if not open_.any():
            break
        v = np.where(open_, y / np.where(open_, beta, 1), 0)
        y = apply(v) - beta * v_old
        alpha = (v * y).sum(axis=0)
        y -= alpha * v
        after = np.linalg.norm(y, axis=0)
        # The new column of the tridiagonal matrix (beta, alpha, after) under the last two rotations.
        upper = sin_old * beta
        middle = cos * cos_old * beta + sin * alpha
        lower = cos * alpha - sin * cos_old * beta
        size = np.hypot(lower, after)
        usable = open_ & (size > 0)
        size = np.where(usable, size, 1)
        cos_old, sin_old = cos, sin
        cos, sin = np.where(usable, lower / size, 1), np.where(usable, after / size, 0)
        w, w_old = np.where(usable, (v - upper * w_old - middle * w) / size, 0), w
        x += np.where(usable, cos * rest, 0) * w
        rest = -sin * rest
        v_old, beta = v, after
        open_ = usable & (beta > small) & (np.abs(rest) > small)
    return x


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, guard: int = GUARD, room: int = ROOM, inner: int = INNER,
                    outer: int = OUTER, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenpairs of a symmetric positive operator of dimension ``d``: eigenvalues
    (falling), vectors (columns) and residual norms over the largest eigenvalue. ``apply`` multiplies a block of columns."""
    wanted = min(wanted, d)
    off = lambda basis, x: x - basis @ (basis.T @ x)
    values, vectors, errors = np.zeros(0), np.zeros((d, 0)), np.zeros(0)
    space = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, min(d, wanted + guard))))[0]
    images = apply(space)
    for _ in range(outer):
        ritz, mix = np.linalg.eigh((space.T @ images + images.T @ space) / 2)
        ritz, mix = ritz[::-1], mix[:, ::-1]
        space, images = space @ mix, images @ mix
        left = images - space * ritz
        left -= vectors @ (vectors.T @ left)
        top = max(values[0] if len(values) else 0.0, ritz[0])
        size = np.linalg.norm(left, axis=0) / (top or 1.0)
        full = space.shape[1] + len(values) >= d  # the space is all there is: nothing can be added to it
        done = 0
        while done < len(ritz) and len(values) + done < wanted and (size[done] <= DOUBLE or full or top == 0):
            done += 1
        if done:
            values, errors = np.concatenate([values, ritz[:done]]), np.concatenate([errors, size[:done]])
            vectors = np.concatenate([vectors, space[:, :done]], axis=1)
            space, images, ritz, left, size = space[:, done:], images[:, done:], ritz[done:], left[:, done:], size[done:]
        if len(values) == wanted:
            break
        need = wanted - len(values)
        target = np.arange(min(need, len(ritz)))
        target = target[size[target] > DOUBLE]
        if space.shape[1] + len(target) > wanted + room:  # restart from the leading vectors
            keep = need + guard
            space, images = space[:, :keep], images[:, :keep]
        if not len(target):  # what is left has converged, but too few vectors: widen at random
            more = np.random.default_rng(seed + len(values)).standard_normal((d, need))
        else:
            known = np.concatenate([vectors, space[:, target]], axis=1)
            shift = ritz[target]
            more = minres(lambda x: off(known, apply(off(known, x)) - shift * off(known, x)), -off(known, left[:, target]), inner)  # noqa: B023
        basis = np.concatenate([vectors, space], axis=1)
        more = more / np.maximum(np.linalg.norm(more, axis=0), 1e-300)
        more = off(basis, off(basis, more))
        column, upper = np.linalg.qr(more)
        new = off(basis, column[:, np.abs(np.diag(upper)) > 1e-10])
        if not new.shape[1]:
            new = off(basis, off(basis, np.random.default_rng(seed + space.shape[1]).standard_normal((d, min(need, d - basis.shape[1])))))
        new = np.linalg.qr(new)[0][:, :d - basis.shape[1]]
        space, images = np.concatenate([space, new], axis=1), np.concatenate([images, apply(new)], axis=1)
    else:
        raise ArithmeticError(f"{len(values)} of {wanted} eigenpairs reached double precision in {outer} rounds")
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order], errors[order]


def to_blocks(table: DataFrame, key: str, vector: str, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """Stored ``keys, x`` blocks of the usable rows as whole numbers, and the dimension."""
    usable = table.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("c")).where(
        F.expr(f"c is not null and size(c) > 0 and forall(c, v -> v is not null and not isnan(v) and abs({SCALE} * v) < {LARGEST})"))
    common = usable.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = common["d"] if common else 0

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            for i in range(0, len(rows), block_rows):
                some = rows.iloc[i:i + block_rows]
                x = np.floor(SCALE * np.stack(some["c"].to_numpy())).astype(np.int64) + SHIFT
                yield pd.DataFrame({"keys": [some["key"].tolist()], "x": [x.astype("<i8").tobytes()]})

    return stored(usable.where(F.size("c") == d).mapInPandas(pack, "keys array<string>, x binary"), "whitening-blocks"), d


class Whitener:
    """Mean, components and eigenvalues of the vectors in stored blocks."""

    def __init__(self, blocks: DataFrame, d: int, components: int = COMPONENTS):
        self.blocks, self.d = blocks, d
        sums = self._summed(lambda x: np.concatenate([[len(x)], x.sum(axis=0)]), np.int64, d + 1)
        self.n, self.sums = int(sums[0]), [int(s) for s in sums[1:]]
        #: x - S/n as (x - base) - rest: the first difference is exact.
        self.base = np.array([s // self.n for s in self.sums], np.int64) if self.n else np.zeros(d, np.int64)
        self.rest = np.array([s % self.n / self.n for s in self.sums]) if self.n else np.zeros(d)
        self.trace = float(self._summed(self._over(lambda y: np.array([np.square(y).sum()])), float, 1)[0]) / max(1, self.n)
        self.values, self.vectors, self.residuals = np.zeros(0), np.zeros((d, 0)), np.zeros(0)
        self.identity_error = 0.0
        if self.trace > 0:
            values, vectors, errors = jacobi_davidson(self.product, d, components)
            real = values > RANK * values[0]
            self.values, self.vectors, self.residuals = values[real], vectors[:, real], errors[real]
            k = int(real.sum())
            to = self.vectors / np.sqrt(self.values)

            def moments(y: np.ndarray) -> np.ndarray:
                z = y @ to
                return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

            flat = self._summed(self._over(moments), float, k + k * k) / self.n
            mean, square = flat[:k], flat[k:].reshape(k, k)
            self.identity_error = float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())

    def _over(self, task: Callable[[np.ndarray], np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
        base, rest = self.base, self.rest
        return lambda x: task((x - base) - rest)

    def _summed(self, task: Callable[[np.ndarray], np.ndarray], kind, size: int) -> np.ndarray:
        """The sum of ``task`` over all blocks: each task sums its own, GROUPS groups sum those, the driver the groups."""
        d, groups, kind = self.d, GROUPS, np.dtype(kind)

        def one(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext

            total = None
            for rows in frames:
                for raw in rows["x"]:
                    value = task(np.frombuffer(raw, "<i8").reshape(-1, d)).astype(kind)
                    total = value if total is None else total + value
            if total is not None:
                yield pd.DataFrame({"group": [TaskContext.get().partitionId() % groups], "total": [total.tobytes()]})

        def add(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for rows in frames:
                for raw in rows["total"]:
                    value = np.frombuffer(raw, kind)
                    total = value if total is None else total + value
            yield pd.DataFrame({"total": [total.tobytes()]})

        rows = self.blocks.select("x").mapInPandas(one, "group int, total binary").groupBy("group").applyInPandas(add, "total binary").collect()
        return sum((np.frombuffer(r["total"], kind) for r in rows), np.zeros(size, kind))

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times ``columns``."""
        flat = self._summed(self._over(lambda y: (y.T @ (y @ columns)).ravel()), float, columns.size)
        return flat.reshape(columns.shape) / self.n

    def whitened(self) -> DataFrame:
        """``key, component, n, deviation, whitened, explained, residual, identity_error`` of every row and component."""
        d, n, base, rest, sums = self.d, self.n, self.base, self.rest, np.array(self.sums, np.int64)
        k, to = len(self.values), self.vectors / np.sqrt(self.values)
        explained, residual, error = self.values / (self.trace or 1.0), self.residuals, self.identity_error

        def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in frames:
                for r in rows.itertuples(index=False):
                    x = np.frombuffer(r.x, "<i8").reshape(-1, d)
                    # n * (x - base) - (S - n * base) is n * x - S; where it or its square might pass 64 bits, Python's numbers take over.
                    near, more = x - base, sums - n * base
                    wide = float(np.abs(near).max(initial=0) + 1) * n
                    if wide * wide * d < 2.0 ** 62:
                        deviation = np.square(near * n - more).sum(axis=1).tolist()
                    else:
                        deviation = np.square(near.astype(object) * n - more.astype(object)).sum(axis=1).tolist()
                    z = (near - rest) @ to
                    yield pd.DataFrame({"key": np.repeat(np.array(r.keys, dtype=object), k), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)), "n": n,
                                        "deviation": np.repeat(np.array([str(v) for v in deviation], dtype=object), k), "whitened": z.ravel(), "explained": np.tile(explained, len(x)),
                                        "residual": np.tile(residual, len(x)), "identity_error": error})

        return self.blocks.mapInPandas(project if k else lambda frames: iter(()), "key string, component int, n long, deviation string, whitened double, "
                                       "explained double, residual double, identity_error double")


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable vector: ``key, component, n, deviation, whitened, explained, residual, identity_error``.

    Defined cases: a vector that is null or empty, holds a null or non-finite entry, or one too large for exact
    numbers (2^46) is left out, and so is one of another length than the commonest (the longer of two
    equally common); components of eigenvalue zero (all vectors equal in that direction) have no rows, so equal
    vectors alone give none; repeated rows count and are projected each; null keys stay; an empty table gives
    no rows; other columns are ignored. A deviation beyond 64 bits is an error.
    """
    blocks, d = to_blocks(table, key, vector)
    found = Whitener(blocks, d, components).whitened()
    return found.select(F.col("key").cast(table.schema[key].dataType).alias(key), "component", "n", F.col("deviation").cast("decimal(38,0)").cast("long").alias("deviation"),
                        "whitened", "explained", "residual", "identity_error")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ship(__name__)
