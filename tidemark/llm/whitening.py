"""Whitening of embeddings by a bidiagonal qd solver.

Entries are made whole numbers, whose sums are exact, so that rows are centred without
loss.  Blocks of centred rows are reduced by QR in each task, and the triangles by QR in a
tree, to one triangle of the vectors' dimension; the covariance matrix, which would square
the rounding errors, is never formed.  That triangle is made bidiagonal by Householder
reflections, dqds finds its singular values to high relative accuracy, and a twisted
factorisation for each of them gives its direction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, let_workers_import, map_batches

COMPONENTS, STEP, SHIFT = 32, 64, 1_000_000
#: Triangles that are reduced together, at most, and the numbers that they hold.
FAN_IN, FAN_NUMBERS = 16, 1 << 25
#: Singular values below this share of the largest are rounding errors: no components.
LEAST_SHARE = 1e-10
#: Eigenvalues closer than this, relatively, get vectors that are made orthogonal.
CLUSTER = 1e-3
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """What turns whole numbers x into components; ``n * mean_floor + rest`` are the sums."""

    n: int
    mean_floor: np.ndarray
    rest: np.ndarray
    directions: np.ndarray  # dimensions x components, unit columns
    eigenvalues: np.ndarray
    explained: np.ndarray

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * (x - mean), exact: whole 64-bit numbers, or Python's where these are too short."""
        apart = x - self.mean_floor
        if len(apart) and self.n * int(np.abs(apart).max()) >= 2**62:
            apart = apart.astype(object)
        return apart * self.n - self.rest

    def whiten(self, scaled: np.ndarray) -> np.ndarray:
        return (scaled / self.n).astype(float) @ self.directions / np.sqrt(self.eigenvalues)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and V of r = U B V' for a square r, by Householder reflections."""
    r, d = r.astype(float).copy(), len(r)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        w, size = x.copy(), np.linalg.norm(x)
        if size == 0 or not x[1:].any():
            return w, 0.0
        w[0] += np.copysign(size, x[0])
        return w, 2 / (w @ w)

    for k in range(d):
        w, t = reflector(r[k:, k])
        r[k:, k:] -= t * np.outer(w, w @ r[k:, k:])
        if k < d - 2:
            w, t = reflector(r[k, k + 1 :])
            r[k:, k + 1 :] -= t * np.outer(r[k:, k + 1 :] @ w, w)
            v[:, k + 1 :] -= t * np.outer(v[:, k + 1 :] @ w, w)
    return np.diagonal(r).copy(), np.diagonal(r, 1).copy(), v


def _shifted(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float], float, float]:
    """One differential qd transform with shift ``s``; also its least d, negative if the
    shift was too large, and its last."""
    d, least, new_q, new_e = q[0] - s, q[0] - s, [], []
    for i in range(len(e)):
        if d < 0:
            return [], [], d, d
        top = d + e[i]
        if top > 0:
            new_e.append(e[i] * (q[i + 1] / top))
            d = d * (q[i + 1] / top) - s
        else:
            new_e.append(0.0)
            d = q[i + 1] - s
        new_q.append(top)
        least = min(least, d)
    return [*new_q, d], new_e, least, d


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the bidiagonal matrix with diagonal a and
    superdiagonal b: qd transforms with shifts below the least one, which split and shrink
    the array as its off-diagonals vanish."""
    found: list[float] = []
    todo = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while todo:
        q, e, moved = todo.pop()
        bound = min(q, default=0.0)
        while q:
            if len(q) == 1:
                found.append(max(0.0, moved + q[0]))
                break
            tiny = [x <= (EPS * EPS) * (moved + min(q[i], q[i + 1])) or x == 0 for i, x in enumerate(e)]
            if any(tiny):
                at = len(tiny) - 1 - tiny[::-1].index(True)
                todo.append((q[at + 1 :], e[at + 1 :], moved))
                q, e, bound = q[: at + 1], e[:at], min(q[: at + 1])
                continue
            if 1.5 * q[0] < q[-1]:  # the least ones are found soonest at the end
                q, e = q[::-1], e[::-1]
            s = 0.75 * bound
            while True:
                if s < EPS * (moved or max(q)) * 1e-3:
                    s = 0.0
                new_q, new_e, least, last = _shifted(q, e, s)
                if least >= 0 or s == 0:
                    break
                s = min(s / 4, s + least) if s + least > 0 else s / 4
            q, e, moved, bound = [max(0.0, x) for x in new_q], new_e, moved + s, max(0.0, least)
    return np.sort(np.array(found))[::-1]


class Twisted:
    """B'B - lam in its twisted factorisation with the smallest twist."""

    def __init__(self, a: np.ndarray, b: np.ndarray, lam: float):
        n, tiny = len(a), EPS * max(float((a * a).max()), lam) * 1e-20 + 1e-300
        d, lower = a * a, b / a[:-1] if n > 1 else b
        self.plus, self.low = np.empty(n), np.empty(n - 1)
        s, p = np.empty(n), np.empty(n)
        s[0] = -lam
        for i in range(n):  # from the top: stationary
            self.plus[i] = (s[i] + d[i]) or tiny
            if i < n - 1:
                self.low[i] = lower[i] * (d[i] / self.plus[i])
                s[i + 1] = self.low[i] * lower[i] * s[i] - lam
        self.minus, self.up = np.empty(n), np.empty(n - 1)
        p[-1] = d[-1] - lam
        for i in range(n - 2, -1, -1):  # from the bottom: progressive
            p[i + 1] = p[i + 1] or tiny
            self.minus[i + 1] = (d[i] * lower[i] ** 2 + p[i + 1]) or tiny
            t = d[i] / self.minus[i + 1]
            self.up[i] = lower[i] * t
            p[i] = p[i + 1] * t - lam
        gamma = s + p + lam
        self.at = int(np.argmin(np.where(np.isfinite(gamma), np.abs(gamma), np.inf)))
        pivot = np.concatenate([self.plus[: self.at], [gamma[self.at]], self.minus[self.at + 1 :]])
        least = EPS * max(lam, float((a * a).max()))  # vanishing pivots count alike, so that equal eigenvalues do
        self.pivot = np.where(np.abs(pivot) < least, np.where(pivot < 0, -least, least), pivot)

    def _outwards(self, x: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            x[i] -= self.low[i] * x[i + 1]
        for i in range(self.at, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x / np.linalg.norm(x)

    def vector(self) -> np.ndarray:
        x = np.zeros(len(self.pivot))
        x[self.at] = 1.0
        return self._outwards(x)

    def solve(self, x: np.ndarray) -> np.ndarray:
        """The direction of (B'B - lam)^-1 x."""
        x = x.copy()
        for i in range(1, self.at + 1):
            x[i] -= self.low[i - 1] * x[i - 1]
        for i in range(len(x) - 2, self.at - 1, -1):
            x[i] -= self.up[i] * x[i + 1]
        x = x / self.pivot
        return self._outwards(x / np.abs(x).max())


def directions(a: np.ndarray, b: np.ndarray, eigenvalues: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of B'B for its leading eigenvalues, which are falling.
    Off-diagonals of the size of the reflections' rounding errors count as 0: they would
    mix the vectors of equal eigenvalues at random."""
    b = np.where(np.abs(b) <= 8 * EPS * max(np.abs(a).max(), np.abs(b).max(initial=0)), 0.0, b)
    a = np.where(np.abs(a) < 1e-150, max(np.abs(a).max(), np.abs(b).max(initial=0)) * EPS**2 + 1e-150, a)
    out, first, rng = [], 0, np.random.default_rng(12)
    for k, lam in enumerate(eigenvalues):
        if k and eigenvalues[k - 1] - lam > CLUSTER * eigenvalues[k - 1]:
            first = k
        near = Twisted(a, b, float(lam))
        x = near.vector()
        others = np.array(out[first:k])
        if len(others):  # of a cluster
            for _ in range(8):
                rest = x - others.T @ (others @ x)
                if np.linalg.norm(rest) > 0.5:
                    break
                x = near.solve(rest / np.linalg.norm(rest) if np.linalg.norm(rest) > 1e-3 else rng.standard_normal(len(x)))
            for _ in range(2):
                x = x - others.T @ (others @ x)
                x /= np.linalg.norm(x)
        out.append(x)
    return np.array(out).T


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def whole_numbers(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and _x, the entries as whole numbers, of the rows whose vector has entries that
    are all finite."""
    ok = f"coalesce(size(`{vec_col}`) > 0 and forall(`{vec_col}`, c -> c is not null and not isnan(c) and abs(c) <> double('inf')), false)"
    x = F.expr(f"transform(`{vec_col}`, c -> cast(floor({STEP} * cast(c as double)) as bigint) + {SHIFT}L)")
    return vectors.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), x.alias("_x"))


def triangle(rows: DataFrame, model: Whitening) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    d = len(model.rest)

    def reduced(blocks: Iterator[np.ndarray]) -> np.ndarray:
        r = np.zeros((0, d))
        for block in blocks:
            r = np.linalg.qr(np.concatenate([r, block]), mode="r")
        return r

    def of_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = reduced((model.scaled(_stacked(pdf["_x"])) / model.n).astype(float) for pdf in batches if len(pdf))
        if len(r):
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "r": [r.tobytes()]})

    def of_parts(pdf: pd.DataFrame) -> pd.DataFrame:
        r = reduced(np.frombuffer(x).reshape(-1, d) for x in pdf.sort_values("part")["r"])
        return pd.DataFrame({"part": [pdf["_to"].iloc[0]], "r": [r.tobytes()]})

    parts = cut(rows.select("_x").transform(map_batches, of_rows, "part long, r binary"))
    fan = max(2, min(FAN_IN, FAN_NUMBERS // (d * d)))
    most = parts.agg(F.max("part").alias("m")).first()["m"]
    while most:
        parts = cut(parts.withColumn("_to", F.expr(f"part div {fan}")).groupBy("_to").applyInPandas(of_parts, "part long, r binary"))
        most //= fan
    r = np.frombuffer(parts.first()["r"]).reshape(-1, d)  # as many numbers as the square of the dimension
    return np.concatenate([r, np.zeros((d - len(r), d))])


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of whole_numbers() rows of equal length; None without rows."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"n": [len(pdf)], "s": [_stacked(pdf["_x"]).sum(0)]})

    partial = rows.select("_x").transform(map_batches, sums, "n long, s array<long>")
    totals = partial.select("n", F.posexplode("s").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()  # a row a dimension
    if not totals:
        return None
    n, s = totals[0]["n"], [int(t["s"]) for t in totals]
    floor = np.array([x // n for x in s], np.int64)
    none = np.empty(0)
    centred = Whitening(n, floor, np.array([x - n * int(m) for x, m in zip(s, floor, strict=True)], np.int64), none, none, none)
    a, b, v = bidiagonal(triangle(rows, centred))
    size = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    if not size:
        return Whitening(n, centred.mean_floor, centred.rest, np.empty((len(s), 0)), none, none)
    squared = dqds(a / size, b / size)
    keep = min(components, int((squared > LEAST_SHARE**2 * squared[0]).sum()))
    eigenvalues = squared[:keep] * size**2 / n
    return Whitening(n, centred.mean_floor, centred.rest, v @ directions(a / size, b / size, squared[:keep]), eigenvalues, squared[:keep] / squared.sum())


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest entry, in absolute value, of the whitened rows' covariance minus the identity."""
    k = len(model.eigenvalues)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k + 1, k))
        for pdf in batches:
            if len(pdf):
                w = model.whiten(model.scaled(_stacked(pdf["_x"])))
                total += np.concatenate([w.T @ w, w.sum(0)[None]])
        yield pd.DataFrame({"m": [total.ravel()]})

    partial = rows.select("_x").transform(map_batches, moments, "m array<double>")
    found = partial.select(F.posexplode("m").alias("at", "m")).groupBy("at").agg(F.sum("m").alias("m")).orderBy("at").collect()  # components squared
    total = np.array([f["m"] for f in found]).reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten_vectors(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row
    for each vector and component.

    Vectors that are null or empty, or that hold null or non-finite entries, are left out,
    and so are those of another length than the most common one (of several, the longest).
    Equal ids, ids that are null and repeated rows are rows of their own.  Directions
    without variance are no components, so that vectors that are all equal, and an empty
    table, have no rows.  A deviation (the squared distance from the mean times n squared)
    that a long can't hold is null."""
    let_workers_import(vectors.sparkSession)
    rows = whole_numbers(vectors, id_col, vec_col)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = rows.groupBy(F.size("_x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    rows = rows.where(F.size("_x") == (common["d"] if common else 0))
    model = fit_whitening(rows, components)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(rows, model), len(model.eigenvalues)
    sent = vectors.sparkSession.sparkContext.broadcast(model)  # dimensions x components numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in batches:
            for at in range(0, len(pdf), 4096):  # bounds memory
                part = pdf.iloc[at : at + 4096]
                scaled = m.scaled(_stacked(part["_x"]))
                if scaled.dtype == object or scaled.shape[1] * int(np.abs(scaled).max()) ** 2 >= 2**63:
                    exact = [sum(int(x) ** 2 for x in row) for row in scaled]
                    deviation = pd.array([x if x < 2**63 else pd.NA for x in exact], dtype="Int64")
                else:
                    deviation = pd.array((scaled * scaled).sum(1), dtype="Int64")
                yield pd.DataFrame(
                    {
                        "vec_id": part["vec_id"].repeat(k).array,
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(part)),
                        "n": m.n,
                        "deviation": deviation.repeat(k),
                        "whitened": m.whiten(scaled).ravel(),
                        "explained": np.tile(m.explained, len(part)),
                        "identity_error": error,
                    }
                )

    return rows.transform(map_batches, run, schema)
