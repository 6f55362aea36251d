"""Embedding whitening: blockwise QR, bidiagonal form, dqds, twisted factorisations.

Vectors become whole numbers x = floor(256 c). Directions are fitted on the distinct vectors, so
copies do not weigh more. Tasks reduce their centred rows to triangles block by block, triangles
are stacked and reduced again a few dozen at a time, and only one triangle, dimension by dimension,
reaches the driver. Householder reflections make it bidiagonal, the dqds iteration gives the
singular values to high relative accuracy without ever forming a covariance, and twisted
factorisations of the shifted tridiagonal give one direction for each.

Defined cases: vectors that are null, empty, or hold a null, a non-finite entry or one whose x does
not fit a long take no part; nor do vectors of another length than the commonest one (ties: the
longest). Rows with a null id stay rows, with a null id; repeated rows each get their result.
Components without variance (rank below the number asked for, a single vector) have whitened null
and explained 0, or null where nothing varies at all; identity_error covers the others, and is null
if there are none. A deviation that does not fit a long is null. Fewer dimensions than components
give fewer components, an empty table gives no rows. Columns other than the two named are not read,
so their names cannot clash. The driver holds one triangle, dimension squared, and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import in_batches, table
from tidemart.session import written

COMPONENTS = 4
#: Triangles stacked in one task of a reduction round.
FAN = 32
#: Rows reduced at a time inside a task.
BLOCK = 4096
EPS = np.finfo(float).eps
_LOW = np.int64(0xFFFFFFFF)


def scaled(vector: Column) -> Column:
    """floor(256 c) of every entry as longs; null where the vector takes no part."""
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (
        F.abs(c.cast("double")) < F.lit(float(1 << 55))))
    return F.when(fits & (F.size(vector) > 0), F.transform(
        vector, lambda c: F.floor(c.cast("double") * 256.0).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for part in parts:
        if part.num_rows:
            yield _matrix(part.column("x"))


def _sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count and sums per dimension of a task, in two halves of 32 bits so that they fit."""
    n, high, low = 0, None, None
    for x in _batches(parts):
        h, lo = (x >> 32).sum(0), (x & _LOW).sum(0)
        n, high, low = n + len(x), h if high is None else high + h, lo if low is None else low + lo
    if n:
        yield pa.RecordBatch.from_pydict({
            "dim": np.arange(len(high), dtype=np.int32), "n": np.full(len(high), n), "high": high, "low": low})


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    rough = ((n * x.astype(float) - np.array(total, float)) ** 2).sum(1)
    wrapped = np.array([t & 0xFFFFFFFFFFFFFFFF for t in total], np.uint64)
    with np.errstate(over="ignore"):  # exact modulo 2^64, hence exact where the sum is below
        y = x.astype(np.uint64) * np.uint64(n & 0xFFFFFFFFFFFFFFFF) - wrapped
        out: list[int | None] = (y * y).sum(1).astype(np.int64).tolist()
    for i in np.flatnonzero(~(rough < 9e18)):
        sure = sum((n * int(v) - t) ** 2 for v, t in zip(x[i].tolist(), total)) if rough[i] < 1e19 else 1 << 63
        out[i] = sure if sure < 1 << 63 else None
    return out


def _centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S / n; whole and fractional part of the mean apart, so that nothing large cancels."""
    whole = np.array([t // n for t in total], np.int64)
    part = np.array([(t % n) / n for t in total])
    return (x - whole).astype(float) - part


def _triangle(rows: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(rows), mode="r")


def _reduce(n: int, total: list[int]):
    """Triangle of a task's centred rows, block by block."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, triangle = [], 0, None
        for x in _batches(parts):
            held.append(_centred(x, n, total))
            rows += len(x)
            if rows >= BLOCK:
                triangle = _triangle(held if triangle is None else [triangle, *held])
                held, rows = [], 0
        if held or triangle is not None:
            triangle = _triangle(held if triangle is None else [triangle, *held])
            yield _packed(triangle)

    return run


def _packed(triangle: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"r": pa.array([triangle.ravel().tolist()], pa.list_(pa.float64()))})


def _stacked(dims: int):
    """One triangle from those of a task."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = None
        for part in parts:
            for r in part.column("r").to_pylist():
                rows = np.array(r).reshape(-1, dims)
                triangle = rows if triangle is None else _triangle([triangle, rows])
        if triangle is not None:
            yield _packed(triangle)

    return run


def blockwise_qr(fit: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """The triangle of all centred rows: per task, then in rounds of FAN triangles."""
    dims = len(total)
    found = written(fit.mapInArrow(_reduce(n, total), "r array<double>"), "triangles")
    left = found.count()
    while left > 1:
        left = -(-left // FAN)
        found = written(found.repartition(left).mapInArrow(_stacked(dims), "r array<double>"), "triangles")
        left = found.count()
    return np.array(found.collect()[0]["r"]).reshape(-1, dims)


def bidiagonal(triangle: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, superdiagonal, and the right reflections, of an upper bidiagonal form."""
    dims = triangle.shape[1]
    a = np.zeros((max(dims, len(triangle)), dims))
    a[:len(triangle)] = triangle
    right = []

    def reflection(x: np.ndarray) -> np.ndarray:
        u = x.copy()
        u[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(u)
        return u / size if size > 0 else u

    for k in range(dims):
        u = reflection(a[k:, k])
        a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < dims - 1:
            v = reflection(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            right.append(v)
    return np.diag(a)[:dims].copy(), np.diag(a, 1)[:dims - 1].copy(), right


def _back(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """Apply the right reflections to a vector of the bidiagonal form."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        z[k + 1:] -= 2 * right[k] * (right[k] @ z[k + 1:])
    return z


def dqds(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling: differential qd with shifts."""
    q, e = diagonal ** 2, upper ** 2
    scale = max(float(q.max(initial=0.0)), float(e.max(initial=0.0)))
    if scale == 0:
        return np.zeros(len(q))
    out, segments = [], [(q / scale, e / scale, 0.0)]
    while segments:
        q, e, moved = segments.pop()
        fails = 0
        while len(q):
            m = len(q)
            if m == 1:
                out.append(q[0] + moved)
                break
            # Below this an entry of e changes no value by more than a rounding of it.
            split = np.flatnonzero(e <= EPS ** 2 * (moved + np.minimum(q[:-1], q[1:])))
            if len(split):
                cut = int(split[-1]) + 1
                segments.append((q[:cut], e[:cut - 1], moved))
                q, e = q[cut:], e[cut:]
                continue
            shift = 0.0
            if fails < 3 and m > 1:
                # The last rows estimate the least value; a failed step shrinks the shift.
                b, c = q[-1] + (e[-2] if m > 2 else 0.0), q[-2] + e[-1]
                half = (q[-2] + q[-1] + e[-1]) / 2
                low = q[-1] * q[-2] / (half + np.sqrt(max(half * half - q[-1] * q[-2], 0.0))) if half > 0 else 0.0
                shift = max(0.0, min(low, b, c) * (1 - 1e-3)) * 0.25 ** fails
                if q[-1] == 0:
                    shift = 0.0
            d, ok = q[0] - shift, True
            nq, ne = np.empty(m), np.empty(m - 1)
            for i in range(m - 1):
                nq[i] = d + e[i]
                if d < 0 or nq[i] <= 0:
                    ok = d >= 0
                    if not ok:
                        break
                    ne[i], d = 0.0, q[i + 1] - shift  # d and e vanish: a zero of q, which splits here
                    continue
                t = q[i + 1] / nq[i]
                ne[i], d = e[i] * t, d * t - shift
            if not ok or d < 0:
                fails += 1
                continue
            nq[-1] = d
            q, e, moved, fails = nq, ne, moved + shift, 0
    return np.sort(np.maximum(np.array(out), 0.0))[::-1] * scale


def _twisted(diagonal: np.ndarray, upper: np.ndarray, value: float, avoid: list[np.ndarray]) -> np.ndarray:
    """A unit vector z with B'B z = value z, from the factorisation whose twist is smallest.

    Vectors of values that agree to within rounding are kept apart: the vector is made orthogonal
    to those in `avoid`, and where little is left the next best twist is taken.
    """
    m = len(diagonal)
    tiny = np.finfo(float).tiny ** 0.5
    # Stationary form from the top: L D L' = B'B - value; progressive form from the bottom: U P U'.
    q, off = diagonal ** 2, diagonal[:-1] * upper
    # B'B has the diagonal q_i + u_{i-1}^2; both forms keep the shift apart from the entries.
    s, down, ratio_down = -value, np.empty(m), np.empty(m - 1)
    tops = np.empty(m)
    for i in range(m):
        tops[i] = s
        down[i] = q[i] + s
        if i < m - 1:
            pivot = down[i] if abs(down[i]) > tiny else tiny
            ratio_down[i] = off[i] / pivot
            s = s * upper[i] ** 2 / pivot - value
    p, up, ratio_up = q[-1] - value if m else 0.0, np.empty(m), np.empty(m - 1)
    bottoms = np.empty(m)
    for i in range(m - 1, -1, -1):
        bottoms[i] = p
        up[i] = p + (upper[i - 1] ** 2 if i else 0.0)
        if i:
            pivot = up[i] if abs(up[i]) > tiny else tiny
            ratio_up[i - 1] = off[i - 1] / pivot
            p = p * q[i - 1] / pivot - value
    twist = np.abs(tops + bottoms + value)
    best = None
    for r in np.argsort(twist, kind="stable")[:len(avoid) + 8]:
        z = np.zeros(m)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -ratio_down[i] * z[i + 1]
        for i in range(r, m - 1):
            z[i + 1] = -ratio_up[i] * z[i]
        z /= np.linalg.norm(z)
        size = 1.0
        for _ in range(2):
            for other in avoid:
                z = z - (other @ z) * other
            left = np.linalg.norm(z)
            size, z = size * left, z / left if left > 0 else z
        if best is None or size > 2 * best[0]:
            best = (size, z)
        if best[0] > 0.1:
            break
    return best[1]


def directions(triangle: np.ndarray, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values, falling, and unit directions (rows) of the first `count`."""
    diagonal, upper, right = bidiagonal(triangle)
    values = dqds(diagonal, upper)
    scale = values[0] if len(values) else 0.0
    # The form falls apart where its superdiagonal vanishes; a block has its own vectors.
    cuts = [0, *(np.flatnonzero(np.abs(upper) <= EPS * np.sqrt(scale)) + 1).tolist(), len(diagonal)]
    found = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        d, u = diagonal[low:high], upper[low:high - 1]
        own, near = dqds(d, u)[:count], []
        for i, value in enumerate(own):
            near = [z for v, z in near if v - value <= 1e-3 * v] if i else []
            z = _twisted(d, u, value, near)
            near = [(own[j], w) for j, w in zip(range(i - len(near), i), near)] + [(value, z)]
            whole = np.zeros(len(diagonal))
            whole[low:high] = z
            found.append((value, whole))
    found.sort(key=lambda f: -f[0])
    rows = []
    for _, z in found[:count]:
        v = _back(z, right)
        v /= np.linalg.norm(v)
        rows.append(v * np.sign(v[np.argmax(np.abs(v))]))
    return values, np.array(rows)


class Whitening:
    """What a fit gives: count, sums, directions scaled to unit variance, shares, the check."""

    def __init__(self, n: int, total: list[int], values: np.ndarray, rows: np.ndarray):
        self.n, self.total = n, total
        top = values[:len(rows)]
        # A triangle's roundings amount to its largest value times dimension and precision.
        varies = np.sqrt(top) > 8 * len(values) * EPS * np.sqrt(values[0]) if len(values) and values[0] > 0 else (
            np.zeros(len(top), bool))
        self.varies = varies
        whole = values.sum()
        self.explained = [None if whole == 0 else float(v / whole) if ok else 0.0 for v, ok in zip(top, varies)]
        self.project = rows / np.where(varies, np.sqrt(np.where(varies, top, 1.0) / n), 1.0)[:, None]
        self.identity_error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """A column per component; those without variance are nan."""
        out = _centred(x, self.n, self.total) @ self.project.T
        out[:, ~self.varies] = np.nan
        return out


def _products(model: Whitening):
    """Count, mean and centred products of a task's whitened rows."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, 0.0, 0.0
        for x in _batches(parts):
            w = model.whitened(x)[:, model.varies]
            m = w.mean(0)
            gap, both = m - mean, n + len(w)
            spread = spread + (w - m).T @ (w - m) + np.outer(gap, gap) * n * len(w) / both
            mean, n = mean + gap * len(w) / both, both
        if n:
            yield pa.RecordBatch.from_pydict({
                "n": [n], "mean": pa.array([mean.tolist()], pa.list_(pa.float64())),
                "spread": pa.array([spread.ravel().tolist()], pa.list_(pa.float64()))})

    return run


def _identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened covariance minus the identity, in absolute value."""
    k = int(model.varies.sum())
    if not k:
        return None
    parts = written(fit.mapInArrow(_products(model), "n long, mean array<double>, spread array<double>"), "products")
    cell = parts.select("n", F.posexplode("mean")).groupBy("pos").agg(F.sum(F.col("n") * F.col("col")).alias("s"))
    mean = np.zeros(k)
    for r in cell.collect():  # a row per component
        mean[r["pos"]] = r["s"] / model.n
    own = parts.select("n", "mean", F.posexplode("spread").alias("at", "c"))
    i, j = F.floor(F.col("at") / k).cast("int"), (F.col("at") % k).cast("int")
    away = lambda at: F.element_at("mean", at + 1) - F.element_at(F.array(*[F.lit(float(m)) for m in mean]), at + 1)
    cells = own.groupBy("at").agg(F.sum(F.col("c") + F.col("n") * away(i) * away(j)).alias("s")).collect()
    cover = np.zeros(k * k)
    for r in cells:
        cover[r["at"]] = r["s"] / model.n
    return float(np.abs(cover.reshape(k, k) - np.eye(k)).max())


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """A model of the distinct rows of column x; None without rows."""
    once = written(in_batches(vectors).select("x").distinct(), "distinct-vectors")
    sums = once.mapInArrow(_sums, "dim int, n long, high long, low long").groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()  # a row per dimension
    if not sums:
        return None
    sums.sort(key=lambda r: r["dim"])
    n, total = sums[0]["n"], [int(r["high"]) * (1 << 32) + int(r["low"]) for r in sums]
    values, rows = directions(blockwise_qr(once, n, total), min(components, len(total)))
    model = Whitening(n, total, values, rows)
    model.identity_error = _identity_error(once, model)
    return model


_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _transform(model: Whitening, id_type: pa.DataType):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.explained)
        for part in parts:
            if not part.num_rows:
                continue
            x = _matrix(part.column("x"))
            rows = np.repeat(np.arange(len(x)), k)
            numbers = np.tile(np.arange(k), len(x))
            w = model.whitened(x).ravel()
            deviation = deviations(x, model.n, model.total)
            yield pa.RecordBatch.from_pydict({
                "vec_id": part.column("vec_id").take(pa.array(rows)).cast(id_type),
                "component": pa.array(numbers + 1, pa.int32()),
                "n": pa.array(np.full(len(rows), model.n)),
                "deviation": pa.array(deviation, pa.int64()).take(pa.array(rows)),
                "whitened": pa.array(w, mask=np.isnan(w)),
                "explained": pa.array(model.explained, pa.float64()).take(pa.array(numbers)),
                "identity_error": pa.array([model.identity_error] * len(rows), pa.float64()),
            })

    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """vec_id and component: n, deviation, whitened, explained, identity_error."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), scaled(F.col(vector_col)).alias("x")).where("x is not null")
    common = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).head()
    kind = rows.schema["vec_id"].dataType.simpleString()
    if common is None:
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, {_RESULT}")
    rows = rows.where(F.size("x") == common["dims"])
    model = fit(rows, components)
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    if kind not in ("bigint", "int", "string"):
        rows, kind = rows.withColumn("vec_id", F.col("vec_id").cast("string")), "string"
    return in_batches(rows).mapInArrow(_transform(model, id_type), f"vec_id {kind}, {_RESULT}")


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
