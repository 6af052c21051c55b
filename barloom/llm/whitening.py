"""Whitening of embeddings by their leading components, found with a block Jacobi-Davidson iteration.

The covariance is never formed. All that is done with it is its product with a few vectors, (1/n) X'(X w) with the centred
fit list X: each task multiplies its blocks of rows, Spark adds the tasks' d x k results. The driver holds vectors of the
dimension d only, never rows. One step of the iteration:

1. Rayleigh-Ritz in the subspace gives the pairs; pairs at the top whose residual has reached double precision are locked.
2. For all open pairs at once, MINRES solves the projected correction equation (1 - ZZ')(V - e)(1 - ZZ') t = -r, Z being the
   locked vectors and the open block; a step of MINRES is one product for the whole block.
3. The corrections, made orthogonal to all there is, widen the subspace; a full one restarts from its best vectors.
"""
from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import dropped, query, staged, table

COMPONENTS = 16
#: Entries become floor(SCALE * c). The offset of the contract's x cancels in all that is centred.
SCALE = 64
#: An entry must be below this to have an exact scaled integer; a row with a larger one cannot take part.
LARGEST = 2.0 ** 45
#: Ritz vectors carried beyond the wanted ones, steps of MINRES for a correction, and widths of the block a subspace may have.
GUARD, INNER, WIDTHS = 4, 8, 4
MOST_STEPS = 200
EPS = float(np.finfo(np.float64).eps)
#: Vectors of a block of the fit list.
BLOCK = 2048
SEED = 7_301


@dataclass(frozen=True)
class Model:
    """n distinct vectors with exact sums; components as columns of `vectors`, by falling value; a value of 0: no variance."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residual: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) if self.trace else 0.0 for v in self.values]


def _numerators(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - sums, exact: in 64 bits where they suffice, else in Python's integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(np.float64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length -> a row for each."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _rows(blocks: pa.RecordBatch, d: int):
    for raw in blocks["raw"]:
        yield np.frombuffer(raw.as_buffer(), np.int64).reshape(-1, d)


def scaled(vectors: DataFrame) -> DataFrame:
    """vectors(vec_id, embedding) -> (vec_id, x): scaled integers of the rows whose entries are all given, finite and below LARGEST."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    usable = wide.where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST)))
    return usable.select("vec_id", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE)))).alias("x"))


def _blocks(x: DataFrame) -> DataFrame:
    """x(x) of one length -> (rows, raw): blocks of the distinct vectors, as 64-bit integers."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch["x"].slice(at, BLOCK)
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), pa.array([_matrix(part).astype(np.int64).tobytes()], pa.binary())], names=["rows", "raw"])
    return x.select("x").distinct().mapInArrow(run, "rows long, raw binary")


def _sums(blocks: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """The number of vectors and the exact sum of each dimension."""
    def run(batches):
        totals = [0] * d
        for batch in batches:
            for x in _rows(batch, d):
                for i, (high, low) in enumerate(zip((x >> 26).sum(0).tolist(), (x & (2**26 - 1)).sum(0).tolist())):
                    totals[i] += (high << 26) + low
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))], names=["i", "s"])
    got = blocks.mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()
    at = {r["i"]: int(r["s"]) for r in got}
    return int(blocks.agg(F.sum("rows")).first()[0] or 0), tuple(at[i] for i in range(d))


def _added(blocks: DataFrame, d: int, partial, size: int) -> np.ndarray:
    """The sum over all blocks of partial(x), an array of `size` numbers: added in each task, then by Spark."""
    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for x in _rows(batch, d):
                total += partial(x)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["part"])
    parts = blocks.select("raw").mapInArrow(run, "part array<double>").select(F.posexplode("part").alias("i", "y"))
    out = np.zeros(size)
    for i, y in parts.groupBy("i").agg(F.sum("y")).collect():
        out[i] = y
    return out


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal base of what t adds to the others; directions lost in rounding go."""
    t = t / np.maximum(np.linalg.norm(t, axis=0), np.finfo(float).tiny)
    for _ in range(2):
        for base in against:
            t = t - base @ (base.T @ t)
    q, s, _ = np.linalg.svd(t, full_matrices=False)
    q = q[:, s > 1e-10]
    for _ in range(2):
        for base in against:
            q = q - base @ (base.T @ q)
        q = np.linalg.qr(q)[0]
    return q


def _minres(operator, b: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Approximate solutions of operator(x) = b for all columns at once; the operator is symmetric for each column."""
    tiny = np.finfo(float).tiny
    first = np.linalg.norm(b, axis=0)
    v, before = b / np.maximum(first, tiny), np.zeros_like(b)
    x, w, w_before = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    k = b.shape[1]
    beta, c, c_before, s, s_before, eta = np.zeros(k), np.ones(k), np.ones(k), np.zeros(k), np.zeros(k), first.copy()
    for _ in range(steps):
        y = operator(v)
        alpha = (v * y).sum(0)
        y = y - alpha * v - beta * before
        following = np.linalg.norm(y, axis=0)
        delta = c * alpha - c_before * s * beta
        r1, r2, r3 = np.hypot(delta, following), s * alpha + c_before * c * beta, s_before * beta
        live = r1 > tiny
        safe = np.where(live, r1, 1.0)
        c_before, s_before = c, s
        c, s = np.where(live, delta / safe, 1.0), np.where(live, following / safe, 0.0)
        w_before, w = w, np.where(live, (v - r3 * w_before - r2 * w) / safe, 0.0)
        x = x + c * eta * w
        eta = -s * eta
        before, v, beta = v, y / np.maximum(following, tiny), following
        if (np.abs(eta) <= enough * first).all():
            break
    return x


def leading(product, d: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, residual): the k largest eigenpairs of a symmetric positive operator of dimension d.

    `product` maps d x m to d x m. The largest residual is returned in units of the largest value; it is at most
    max(64, d) roundings. RuntimeError where that is not reached.
    """
    k = min(k, d)
    width = min(d, k + GUARD)
    most = min(d, WIDTHS * width)
    base = np.linalg.qr(np.random.default_rng([SEED, d]).standard_normal((d, width)))[0]
    image = product(base)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    tol = max(64, d) * EPS
    for step in range(MOST_STEPS):
        e, y = np.linalg.eigh((base.T @ image + image.T @ base) / 2)
        e, y = e[::-1], y[:, ::-1]
        base, image = base @ y, image @ y
        top = max([*np.abs(values), abs(e[0])]) if len(e) else 0.0
        residual = image - base * e
        done = 0
        while done < len(e) and len(values) + done < k and np.linalg.norm(residual[:, done]) <= tol * top:
            done += 1
        locked, values = np.hstack([locked, base[:, :done]]), np.append(values, e[:done])
        base, image, e, residual = base[:, done:], image[:, done:], e[done:], residual[:, done:]
        if len(values) == k:
            order = np.argsort(-values, kind="stable")
            values, locked = values[order], locked[:, order]
            left = np.linalg.norm(product(locked) - locked * values, axis=0).max() if k else 0.0
            return np.maximum(values, 0.0), locked, float(left / top) if top else 0.0
        open_ = min(width - len(values), base.shape[1])
        z = np.hstack([locked, base[:, :open_]])

        def beside(t, z=z):
            return t - z @ (z.T @ t)
        shift = e[:open_]
        correction = _minres(lambda t: beside(product(beside(t)) - beside(t) * shift), -beside(residual[:, :open_]), INNER, 0.05)  # noqa: B023
        if base.shape[1] + open_ > most - len(values) and locked.shape[1] + base.shape[1] < d:
            base, image = base[:, :max(open_, most - len(values) - open_)], image[:, :max(open_, most - len(values) - open_)]
        more = _orthonormal(correction, locked, base)
        if more.shape[1]:
            base, image = np.hstack([base, more]), np.hstack([image, product(more)])
        else:  # nothing new: all is spanned, or corrections are below rounding; take the products anew
            base = _orthonormal(base, locked)
            image = product(base)
    raise RuntimeError(f"{len(values)} of {k} components after {MOST_STEPS} steps")


def fitted(x: DataFrame, components: int = COMPONENTS) -> Model | None:
    """x(x), integer vectors -> the model of the distinct ones among those of the commonest length; None without any."""
    lengths = x.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return None
    d = lengths[0]["d"]
    blocks = staged(_blocks(x.where(F.size("x") == d)), "fit")
    n, sums = _sums(blocks, d)
    square = [0.0]

    def product(w):
        w = np.ascontiguousarray(w)

        def partial(rows):
            c = _centred(rows, n, sums)
            return np.append((c.T @ (c @ w)).ravel(), np.einsum("ij,ij", c, c))
        got = _added(blocks, d, partial, w.size + 1) / n
        square[0] = float(got[-1])
        return got[:-1].reshape(w.shape)
    values, vectors, residual = leading(product, d, components)
    values = np.where(values > max(64, d) * EPS * values.max(initial=0.0), values, 0.0)
    real = values > 0
    project = vectors[:, real] / np.sqrt(values[real])
    k = int(real.sum())
    means = _added(blocks, d, lambda rows: (_centred(rows, n, sums) @ project).sum(0), k) / n if k else np.zeros(0)

    def spread(rows):
        z = _centred(rows, n, sums) @ project - means
        return (z.T @ z).ravel()
    error = float(np.abs(_added(blocks, d, spread, k * k).reshape(k, k) / n - np.eye(k)).max()) if k else 0.0
    dropped(blocks)
    return Model(n, sums, values, vectors, square[0], error, residual)


def projected(x: DataFrame, model: Model) -> DataFrame:
    """x(vec_id, x) -> (vec_id, deviation, whitened) for the vectors of the model's length.

    deviation: the sum over dimensions of (n x - S)^2, exact; null where a long cannot hold it. whitened: an entry for each
    component, null where the component has no variance.
    """
    d, n, sums = len(model.sums), model.n, model.sums
    real = model.values > 0
    project = np.where(real, model.vectors / np.sqrt(np.where(real, model.values, 1.0)), 0.0)
    k = len(model.values)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            numerators = _numerators(_matrix(batch["x"]).astype(np.int64), n, sums)
            if numerators.dtype == object or d * float(np.abs(numerators).max()) ** 2 >= 2.0**62:
                exact = (numerators.astype(object) ** 2).sum(1)
                deviation = pa.array([int(v) if v < 2**63 else None for v in exact], pa.int64())
            else:
                deviation = pa.array((numerators * numerators).sum(1), pa.int64())
            z = (numerators / n).astype(np.float64) @ project
            flat = pa.array(z.ravel(), pa.float64(), mask=np.tile(~real, len(z)))
            offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], deviation, pa.ListArray.from_arrays(offsets, flat)], names=["vec_id", "deviation", "whitened"])
    return x.where(F.size("x") == d).mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vectors(vec_id, embedding) -> a row for each usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    Usable are vectors without null or non-finite entries or entries of 2^45 and more, of the commonest length (of equally
    common ones the larger); the others have no rows. Equal vectors count once in the fit and each has its rows; rows that
    repeat an id, or have none, are rows of their own. There are as many components as dimensions where these are fewer.
    A component without variance has explained 0 and whitened null and takes no part in identity_error. An empty table, or
    one without usable vectors, gives no rows. Other columns are not read.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    x = scaled(vectors)
    model = fitted(x, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = projected(x, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*[F.lit(v) for v in model.explained])
    return rows.select("vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       explained[F.col("place")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
