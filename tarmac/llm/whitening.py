"""Embedding whitening by a bidiagonal qd solver.

Entries become integers, x = floor(1024 * c) + 100000; sums over the rows are exact.  Every task reduces its centred rows
block by block to one triangular factor R (QR of the factor so far stacked on the next block), and factors are stacked
and reduced again in rounds until one is left, so R'R is the rows' scatter matrix and nothing was squared before.
Householder reflections from both sides make R bidiagonal, the dqds recurrence finds its singular values to high relative
accuracy, and the twisted factorisation of B'B - s^2 gives each direction, with inverse iteration against the neighbours
where values are close.  The driver sees one small R, sums and a Gram matrix of the whitened components, all sized by the
vectors' length and never by the rows.

Defined results: null vectors and vectors with null or non-finite entries take no part; null ids and repeated rows are
rows like any other; vectors of different lengths are fitted apart; scaled entries beyond 2^31 count as 2^31; vectors
without entries have no components; a component without variance (all rows equal along it) has ``whitened`` null and is
left out of ``identity_error``; empty tables give no rows.  A component's sign makes its largest entry positive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.llm.common import Scratch, table

SCALE, SHIFT = 1024, 100_000
MOST = float(1 << 31)
COMPONENTS = 8
BLOCK_ROWS = 4096
STACK_BYTES = 1 << 25  # of factors stacked in one task
EPS = float(np.finfo(float).eps)
BIG = "decimal(38,0)"
COLUMNS = f"component int, n long, deviation {BIG}, whitened double, explained double, identity_error double"


# ---- bidiagonal solver ------------------------------------------------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit v with (1 - 2 v v') x = (alpha, 0, ...), and alpha; v is zero where x already has that form."""
    norm = float(np.linalg.norm(x))
    if not norm or not np.any(x[1:]):
        return np.zeros_like(x), float(x[0])
    alpha = -math.copysign(norm, x[0])
    v = x.copy()
    v[0] -= alpha
    return v / np.linalg.norm(v), alpha


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, right factor P) of a square matrix: R P has B's singular values and B'B = P'R'R P."""
    a, n = np.array(r, dtype=float), len(r)
    p = np.eye(n)
    for j in range(n):
        v, alpha = _reflector(a[j:, j])
        a[j:, j:] -= 2 * np.outer(v, v @ a[j:, j:])
        a[j, j], a[j + 1:, j] = alpha, 0
        if j + 2 < n:
            v, alpha = _reflector(a[j, j + 1:])
            a[j:, j + 1:] -= 2 * np.outer(a[j:, j + 1:] @ v, v)
            a[j, j + 1], a[j, j + 2:] = alpha, 0
            p[:, j + 1:] -= 2 * np.outer(p[:, j + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _pass(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform with shift ``tau``: (q, e, sum of 1 / d); None if the shift was above the least value."""
    n, d, inverse = len(q), q[0] - tau, 0.0
    qs, es = [0.0] * n, [0.0] * (n - 1)
    for k in range(n - 1):
        if d < 0:
            return None
        inverse += 1 / d if d else math.inf
        qs[k] = t = d + e[k]
        if t:
            ratio = q[k + 1] / t
            es[k], d = e[k] * ratio, d * ratio - tau
        else:  # nothing couples the parts
            es[k], d = 0.0, q[k + 1] - tau
    if d < 0:
        return None
    qs[-1] = d
    return qs, es, inverse + (1 / d if d else math.inf)


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of a bidiagonal matrix's singular values, falling, by dqds with Newton shifts from below."""
    found: list[float] = []
    tiny = (100 * EPS) ** 2
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    limit = 200 * (len(diagonal) + 10) ** 2
    while todo:
        q, e, low = todo.pop()
        while q:
            if len(q) == 1 or e[-1] <= tiny * (low + q[-1]):
                found.append(low + q.pop())
                e = e[:len(q) - 1] if q else []
                continue
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= tiny * low), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], low))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            plain = _pass(q, e, 0.0)  # without a shift 1 / d sums up the inverse values: a bound from below
            tau = (1 - 8 * EPS * len(q)) / plain[2]
            step = None
            while tau and step is None:
                step = _pass(q, e, tau)
                if step is None:
                    tau = tau / 4 if tau > EPS * low else 0.0
            q, e = (step or plain)[:2]
            low += tau
            limit -= 1
            if limit < 0:
                raise ArithmeticError("singular values not settled")
    return np.sort(np.array(found))[::-1]


class Twisted(NamedTuple):
    """Twisted factorisation of a tridiagonal matrix less a shift: eliminated from both ends to the row ``at``."""

    down: np.ndarray
    lower: np.ndarray
    up: np.ndarray
    upper: np.ndarray
    gamma: float
    at: int

    def solve(self, b: np.ndarray) -> np.ndarray:
        c, r, n = b.copy(), self.at, len(b)
        for i in range(r):
            c[i + 1] -= self.lower[i] * c[i]
        for i in range(n - 2, r - 1, -1):
            c[i] -= self.upper[i] * c[i + 1]
        y = np.zeros(n)
        y[r] = c[r] / self.gamma
        for i in range(r - 1, -1, -1):
            y[i] = c[i] / self.down[i] - self.lower[i] * y[i + 1]
        for i in range(r, n - 1):
            y[i + 1] = c[i + 1] / self.up[i + 1] - self.upper[i] * y[i]
        return y

    def direction(self) -> np.ndarray:
        z, r = np.zeros(len(self.down)), self.at
        z[r] = 1
        for i in range(r - 1, -1, -1):
            z[i] = -self.lower[i] * z[i + 1]
        for i in range(r, len(z) - 1):
            z[i + 1] = -self.upper[i] * z[i]
        return z / np.linalg.norm(z)


def twist(t: np.ndarray, off: np.ndarray, value: float, size: float) -> Twisted:
    n, least = len(t), EPS * EPS * size or 1e-300
    down, up, lower, upper = t - value, t - value, np.zeros(n - 1), np.zeros(n - 1)
    for i in range(n - 1):
        down[i] = down[i] or least
        lower[i] = off[i] / down[i]
        down[i + 1] -= lower[i] * off[i]
    for i in range(n - 2, -1, -1):
        up[i + 1] = up[i + 1] or least
        upper[i] = off[i] / up[i + 1]
        up[i] -= upper[i] * off[i]
    gamma = down + up - (t - value)
    at = int(np.argmin(np.abs(gamma)))
    return Twisted(down, lower, up, upper, float(gamma[at]) or least, at)


def _apart(v: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, float]:
    """``v`` made orthogonal to the unit columns ``near`` and of length one, and the share of it that was left."""
    v = v / np.abs(v).max()
    v = v / np.linalg.norm(v)
    w = v - near @ (near.T @ v)
    left = float(np.linalg.norm(w))
    if left < 1e-6:
        return v, left
    for _ in range(2):
        w = w / np.linalg.norm(w)
        w = w - near @ (near.T @ w)
    return w / np.linalg.norm(w), left


def principal(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(k largest eigenvalues of R'R, their unit vectors as columns, sum of all eigenvalues)."""
    size = float(np.abs(r).max(initial=0))
    if not size:
        return np.zeros(min(k, len(r))), np.eye(len(r))[:, :k], 0.0
    diagonal, above, p = bidiagonalise(r / size)
    values = squared_singular_values(diagonal, above)
    t = diagonal ** 2
    t[1:] += above ** 2
    off = diagonal[:-1] * above
    rng = np.random.default_rng(0)
    z = np.zeros((len(r), min(k, len(r))))
    for j in range(z.shape[1]):
        f = twist(t, off, float(values[j]), float(values[0]))
        v = f.direction()
        first = j
        while first and values[first - 1] - values[first] <= 1e-3 * values[0]:
            first -= 1
        near = z[:, first:j]
        if near.shape[1]:  # a shift beside the value reaches all directions of a multiple one alike
            f = twist(t, off, float(values[j] - 16 * EPS * values[0]), float(values[0]))
        v, left = _apart(v, near)
        if left < 0.1:
            v, left = _apart(rng.standard_normal(len(r)), near)
        for _ in range(3 if near.shape[1] else 1):
            w, left = _apart(f.solve(v), near)
            if left < 1e-6:  # nothing new: v already is a direction of the cluster
                break
            v = w
        z[:, j] = v
    vectors = p @ z
    vectors *= np.where(vectors[np.abs(vectors).argmax(0), np.arange(z.shape[1])] < 0, -1.0, 1.0)
    return values[:z.shape[1]] * size ** 2, vectors, float(values.sum()) * size ** 2


# ---- Spark ------------------------------------------------------------------------------------------------------


class Sums(NamedTuple):
    """Rows of one vector length and their exact sums, as n * base + rest with 0 <= rest < n."""

    n: int
    base: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base).astype(float) - self.rest.astype(float) / self.n


class Fit(NamedTuple):
    sums: Sums
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def has_variance(self) -> np.ndarray:
        return self.values > EPS * EPS * max(1.0, float(np.abs(self.sums.base).max(initial=0))) ** 2

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scale = np.sqrt(np.where(self.has_variance(), self.values, np.inf))
        return self.sums.centred(x) @ self.vectors / scale


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is there and finite in every entry."""
    x = F.transform(vec_col, lambda v: v.cast("double"))
    return vectors.filter(F.col(vec_col).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their integer vectors as a matrix) of each vector length in a batch."""
    lengths = np.asarray(column.value_lengths())
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        flat = np.asarray(column.take(pa.array(rows)).flatten(), dtype=float)
        scaled = np.clip(np.floor(SCALE * np.clip(flat, -MOST, MOST)), -MOST, MOST)
        yield rows, scaled.astype(np.int64).reshape(len(rows), d) + SHIFT


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: dict[int, int] = {}
    sums: dict[int, list[int]] = {}
    for batch in batches:
        for rows, x in by_length(batch.column("x")):
            d = x.shape[1]
            n[d] = n.get(d, 0) + len(x)
            sums[d] = [a + b for a, b in zip(sums.get(d, [0] * d), x.sum(0).tolist())]
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(n), pa.int32()), pa.array([[Decimal(v) for v in [n[d], *sums[d]]] for d in n], pa.list_(pa.decimal128(38, 0)))],
            names=["d", "v"])


def _added(partial: DataFrame) -> dict[int, list]:
    """Element-wise sums of the arrays ``v`` for each ``d``: as many numbers as an array has come to the driver."""
    got = (partial.select("d", F.posexplode("v").alias("i", "v")).groupBy("d", "i").agg(F.sum("v").alias("v"))
           .groupBy("d").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("v")).collect())
    return {r["d"]: [e["v"] for e in r["v"]] for r in got}


def _factor(factors: list[np.ndarray], d: int) -> np.ndarray:
    return np.linalg.qr(np.concatenate([*factors, np.zeros((d, d))]), mode="r")


def _reduce(sums: dict[int, Sums]) -> Callable:
    """Centred rows of a task to one factor for each vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch.column("x")):
                d = x.shape[1]
                for lo in range(0, len(x) if d else 0, BLOCK_ROWS):
                    block = sums[d].centred(x[lo:lo + BLOCK_ROWS])
                    factors[d] = _factor([factors[d], block] if d in factors else [block], d)
        if factors:
            yield pa.RecordBatch.from_arrays([pa.array(list(factors), pa.int32()), pa.array([f.tobytes() for f in factors.values()], pa.binary())],
                                             names=["d", "r"])

    return run


def _stack(pdf: pd.DataFrame) -> pd.DataFrame:
    d = int(pdf["d"].iloc[0])
    r = _factor([np.frombuffer(b).reshape(d, d) for b in pdf["r"]], d)
    return pd.DataFrame([(d, r.tobytes())], columns=["d", "r"])


def fit(x: DataFrame, k: int, scratch: Scratch) -> dict[int, Fit]:
    """The principal directions of the rows' column ``x``, for each vector length."""
    sums = {}
    for d, (n, *s) in _added(x.select("x").mapInArrow(_partial_sums, f"d int, v array<{BIG}>")).items():
        n = int(n)
        base, rest = zip(*(divmod(int(v), n) for v in s)) if d else ((), ())
        sums[d] = Sums(n, np.array(base, dtype=np.int64), np.array(rest, dtype=np.int64))
    factors = scratch.stored(x.select("x").mapInArrow(_reduce(sums), "d int, r binary"), "factors")
    while True:
        most = max((r["count"] for r in factors.groupBy("d").count().collect()), default=0)
        if most <= 1:
            break
        fan = max(2, min(64, STACK_BYTES // (8 * max(sums) ** 2 + 1)))
        dealt = factors.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(-(-most // fan))))
        factors = scratch.stored(dealt.groupBy("d", "g").applyInPandas(_stack, "d int, r binary"), "factors")
        scratch.drop("factors", but_last=True)
    fits = {}
    for row in factors.collect():
        d, s = row["d"], sums[row["d"]]
        values, vectors, trace = principal(np.frombuffer(row["r"]).reshape(d, d), k)
        fits[d] = Fit(s, values / s.n, vectors, trace / s.n)
    return fits


def _gram(fits: dict[int, Fit]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in by_length(batch.column("x")):
                if d := x.shape[1]:
                    w = fits[d].whitened(x)
                    sums[d] = sums.get(d, 0) + np.concatenate([w.sum(0), (w.T @ w).ravel()])
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))],
                                             names=["d", "v"])

    return run


def identity_errors(x: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Largest absolute entry of the whitened components' covariance minus the identity, measured over all rows."""
    out = {}
    for d, v in _added(x.select("x").mapInArrow(_gram(fits), "d int, v array<double>")).items():
        k, n, real = len(fits[d].values), fits[d].sums.n, fits[d].has_variance()
        mean = np.array(v[:k]) / n
        cov = np.array(v[k:]).reshape(k, k) / n - np.outer(mean, mean)
        out[d] = float(np.abs(cov - np.eye(k))[np.ix_(real, real)].max(initial=0))
    return out


def deviations(s: Sums, x: np.ndarray) -> list[int]:
    """Sum over the dimensions of (n * x - S)^2 for every row, exact at any size."""
    y = x - s.base
    small = int(np.abs(y).max(initial=0)) * max(int(np.abs(y).max(initial=0)), int(s.rest.max(initial=0))) * max(1, y.shape[1]) < 1 << 62
    y, rest = (y, s.rest) if small else (y.astype(object), s.rest.astype(object))
    squares, mixed = (y * y).sum(1).tolist(), (y * rest).sum(1).tolist()
    own = sum(int(v) ** 2 for v in s.rest.tolist())
    return [s.n * s.n * int(a) - 2 * s.n * int(b) + own for a, b in zip(squares, mixed)]


def _project(fits: dict[int, Fit], errors: dict[int, float], schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                for rows, x in by_length(part.column("x")):
                    if not (d := x.shape[1]):
                        continue
                    f = fits[d]
                    k, m = len(f.values), len(x)
                    real = np.tile(f.has_variance(), m)
                    dev = pa.array([Decimal(v) for v in deviations(f.sums, x)], pa.decimal128(38, 0))
                    each = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays([
                        part.column("id").take(pa.array(rows)).take(each),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, f.sums.n, dtype=np.int64)),
                        dev.take(each),
                        pa.array(f.whitened(x).ravel(), mask=~real),
                        pa.array(np.tile(f.values / f.trace if f.trace else np.zeros(k), m)),
                        pa.array(np.full(m * k, errors[d])),
                    ], names=schema.names)

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (id, component, n, deviation as an exact decimal, whitened, explained, identity_error)."""
    x = usable(vectors, vec_col).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("x"))
    scratch = Scratch(vectors.sparkSession, "whitening")
    fits = fit(x, components, scratch)
    errors = identity_errors(x, fits)
    scratch.drop("factors")
    schema = StructType([x.schema["id"], *StructType.fromDDL(COLUMNS).fields])
    return x.mapInArrow(_project(fits, errors, schema), schema).withColumnRenamed("id", id_col)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every embedding; a deviation beyond a long would be an error, not a wrong number."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
