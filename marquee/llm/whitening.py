"""Embedding whitening on eigenvectors found by Jacobi-Davidson.

The covariance matrix is never formed.  It is a product ``V q = sum of d (d . q) / n`` over the
rows' deviations ``d = x - S / n``, centred exactly before multiplying, one Spark job for a
block of vectors: tasks add up their rows, a shuffle adds up the tasks by dimension, and a
block (dimensions x a few columns) is all that reaches the driver.

The driver holds the search space.  Rayleigh-Ritz gives the Ritz pairs; leading pairs whose
residual is down to rounding are locked and projected out; for the others a few steps of
MINRES solve the correction equations ``(I - QQ')(V - theta I)(I - QQ') t = -r``, whose
products are jobs again; the solutions widen the space.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written

COMPONENTS = 8
INNER = 4  # MINRES steps of a correction equation
SPACE = 96  # dimensions of the search space at which it is restarted from its best Ritz vectors
ROUNDS = 300  # outer iterations until the search is given up with an error
EPS = float(np.finfo(np.float64).eps)
LARGEST = 2.0**50  # |floor(1024 c)| beyond this is no exact integer arithmetic any more
ROW_BLOCK = 4096  # rows that are multiplied at a time


def integer_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(id, x)`` of the rows whose vector is whole: ``x`` holds ``floor(1024 c) + 100000`` of
    every entry as packed 64-bit integers.  NULL vectors, vectors with NULL, NaN or infinite
    entries and vectors shorter than the longest one (empty ones, too) are left out."""
    rows = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    whole = F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    longest = rows.filter(whole).agg(F.max(F.size("v"))).first()[0] or 0
    kept = rows.filter(whole & (F.size("v") == F.lit(longest)) & (F.size("v") > 0))
    id_field = kept.schema["id"]

    def pack(batches):
        for b in batches:
            v = b.column(1).flatten().to_numpy(zero_copy_only=False)
            x = np.floor(1024 * v)
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError("a vector entry is too large for exact integers")
            flat = (x.astype(np.int64) + 100_000).tobytes()
            size = 8 * longest
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([flat[k * size:(k + 1) * size] for k in range(b.num_rows)], pa.binary())], ["id", "x"])
    return kept.mapInArrow(pack, f"id {id_field.dataType.simpleString()}, x binary")


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(-1, dims)


def _blocks(batches, dims: int):
    """The rows of Arrow batches as integer matrices of bounded size."""
    for b in batches:
        x = b.column(b.schema.get_field_index("x"))
        for at in range(0, b.num_rows, ROW_BLOCK):
            yield _matrix(x.slice(at, ROW_BLOCK), dims)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """``n`` and the exact sum of every dimension."""
    first = rows.select("x").first()
    if first is None:
        return 0, []
    dims = len(first["x"]) // 8

    def partial(batches):
        n, total = 0, [0] * dims
        for x in _blocks(batches, dims):
            n += len(x)
            # columns of a block cannot leave 64 bits; Python integers carry on
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(lo) for t, h, lo in zip(total, high, low, strict=True)]
        if n:
            from decimal import Decimal

            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
                                              pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["i", "n", "s"])
    got = rows.select("x").mapInArrow(partial, "i int, n long, s decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    return int(got[0]["n"]), [int(r["s"]) for r in got]


def _deviations(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """``x - S / n``, exact up to one rounding: the difference is taken in integers."""
    mean = np.array([s // n for s in total], dtype=np.int64)
    rest = np.array([s % n for s in total], dtype=np.float64) / n
    return (x - mean).astype(np.float64) - rest


@dataclass(frozen=True)
class Covariance:
    """Products of the centred covariance with blocks of vectors, as Spark jobs over ``rows``."""
    rows: DataFrame
    n: int
    total: list[int]

    @property
    def dims(self) -> int:
        return len(self.total)

    def _summed(self, width: int, add: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all rows of ``add(deviations)``, a dims x width matrix: a row per
        dimension and task is shuffled, a row per dimension comes back."""
        n, total, dims = self.n, self.total, self.dims
        names = [f"c{j}" for j in range(width)]

        def partial(batches):
            out = None
            for x in _blocks(batches, dims):
                part = add(_deviations(x, n, total))
                out = part if out is None else out + part
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int32())] + [pa.array(out[:, j]) for j in range(width)],
                                                 ["i", *names])
        schema = "i int, " + ", ".join(f"{c} double" for c in names)
        got = self.rows.select("x").mapInArrow(partial, schema).groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect()
        out = np.zeros((max((r["i"] for r in got), default=-1) + 1, width))
        for r in got:
            out[r["i"]] = [r[c] for c in names]
        return out

    def product(self, block: np.ndarray) -> np.ndarray:
        """``V @ block``."""
        return self._summed(block.shape[1], lambda d: d.T @ (d @ block)) / self.n

    def trace(self) -> float:
        return float(self._summed(1, lambda d: np.einsum("ij,ij->j", d, d)[:, None]).sum()) / self.n

    def projected(self, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and centred covariance of the rows projected on the columns of ``basis``."""
        k = basis.shape[1]

        def add(d):
            w = d @ basis
            return np.vstack([w.T @ w, w.sum(axis=0)])
        s = self._summed(k, add) / self.n
        mean = s[k]
        return mean, s[:k] - np.outer(mean, mean)


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal columns of ``against``."""
    known = np.hstack([a for a in against if a.size]) if any(a.size for a in against) else np.empty((len(new), 0))
    out = np.empty((len(new), 0))
    for v in new.T:
        length = np.linalg.norm(v)
        if not np.isfinite(length) or length == 0:
            continue
        v = v / length
        for _ in range(3):  # twice is enough, a third settles what nearly vanished
            v = v - known @ (known.T @ v) - out @ (out.T @ v)
            size = np.linalg.norm(v)
            if size < 1e-12:
                break
            v = v / size
        else:
            out = np.hstack([out, v[:, None]])
    return out


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """``steps`` of MINRES for each column of ``b`` on its own, in lockstep: ``apply`` takes the
    columns together, so a step is one job."""
    x = np.zeros_like(b)
    v_old, v = np.zeros_like(b), b.copy()
    beta = np.linalg.norm(v, axis=0)
    live = beta > 0
    v = np.divide(v, beta, out=np.zeros_like(v), where=live)
    eta = beta.copy()
    c_old = c = np.ones(b.shape[1])
    s_old = s = np.zeros(b.shape[1])
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    beta = np.zeros(b.shape[1])
    for _ in range(steps):
        p = apply(v)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # the last two plane rotations on the new column of the tridiagonal matrix
        delta = c * alpha - c_old * s * beta
        r1 = np.hypot(delta, beta_new)
        r2 = s * alpha + c_old * c * beta
        r3 = s_old * beta
        ok = live & (r1 > 0)
        safe = np.where(ok, r1, 1.0)
        c_old, s_old = c, s
        c, s = np.where(ok, delta / safe, 1.0), np.where(ok, beta_new / safe, 0.0)
        w_old, w = w, np.where(ok, (v - r3 * w_old - r2 * w) / safe, 0.0)
        x = x + np.where(ok, c * eta, 0.0) * w
        eta = -s * eta
        live = ok & (beta_new > EPS * np.abs(alpha))
        if not live.any():
            break
        v_old, v = v, np.divide(p, beta_new, out=np.zeros_like(p), where=live)
        beta = beta_new
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, seed: int = 7,
                    inner: int = INNER, space: int = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) of a symmetric positive operator and their
    unit eigenvectors (columns), each residual down to the rounding of a product."""
    wanted = min(wanted, dims)
    space = max(space, 4 * wanted)
    locked, values = np.empty((dims, 0)), np.empty(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((dims, min(dims, wanted + 4))))
    image = product(basis)
    scale = 0.0
    for _ in range(ROUNDS):
        h = basis.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        need = wanted - locked.shape[1]
        u, au = basis @ y[:, :need], image @ y[:, :need]
        scale = max(scale, values[0] if len(values) else theta[0], 0.0)
        tolerance = 64 * EPS * max(scale, np.finfo(float).tiny)
        r = au - u * theta[:need]
        r = r - locked @ (locked.T @ r)
        size = np.linalg.norm(r, axis=0)
        done = 0
        while done < need and size[done] <= tolerance:
            done += 1
        if done:  # only leading pairs, so that none is passed over; on images computed afresh
            fresh = product(u[:, :done])
            drift = np.linalg.norm(fresh - u[:, :done] * np.einsum("ij,ij->j", u[:, :done], fresh)
                                   - locked @ (locked.T @ fresh), axis=0)
            sound = 0
            while sound < done and drift[sound] <= 2 * tolerance:
                sound += 1
            values = np.concatenate([values, np.einsum("ij,ij->j", u[:, :sound], fresh[:, :sound])])
            locked = np.hstack([locked, u[:, :sound]])
            if sound < done:  # rounding gathered in the images: start anew from the Ritz vectors
                basis = _orthonormal(basis @ y[:, sound:space // 2], locked)
                image = product(basis)
                continue
            if locked.shape[1] == wanted:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
            basis, image = basis @ y[:, done:], image @ y[:, done:]
            theta, r, u, size = theta[done:], r[:, done:], u[:, done:], size[done:]
            need -= done
        elif basis.shape[1] > space - need:  # restart from the best Ritz vectors
            best = y[:, :space // 2]
            basis, image = basis @ best, image @ best
        open_ = np.flatnonzero(size > tolerance)
        q = np.hstack([locked, u])

        def corrected(t, q=q, shift=theta[open_]):
            t = t - q @ (q.T @ t)
            t = product(t) - shift * t
            return t - q @ (q.T @ t)
        start = -(r[:, open_] - q @ (q.T @ r[:, open_]))
        t = minres(corrected, start, inner)
        new = _orthonormal(np.hstack([t, r[:, open_]]) if basis.shape[1] + locked.shape[1] < dims else t, locked, basis)
        if not new.shape[1]:  # the space is all there is: images afresh, and the residuals are rounding
            basis = _orthonormal(basis @ np.linalg.eigh(basis.T @ image)[1], locked)
            image = product(basis)
            h = basis.T @ image
            theta, y = np.linalg.eigh((h + h.T) / 2)
            take = slice(None, None, -1)
            values = np.concatenate([values, theta[take][:need]])
            return values, np.hstack([locked, (basis @ y)[:, take][:, :need]])
        basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    raise RuntimeError("the eigenvectors did not reach double precision")


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of a fitted table: exact counts and sums, components and their shares."""
    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Fit on all ``rows`` of ``integer_vectors``.  Directions without variance (constant
    columns, repeated rows, fewer rows than dimensions) give no component."""
    n, total = sums(rows)
    if not n:
        return Whitening(0, [], np.empty(0), np.empty((0, 0)), np.empty(0), 0.0)
    v = Covariance(rows, n, total)
    trace = v.trace()
    if trace == 0:
        return Whitening(n, total, np.empty(0), np.empty((v.dims, 0)), np.empty(0), 0.0)
    values, vectors = jacobi_davidson(v.product, v.dims, components)
    real = values > 1e-12 * values[0]
    values, vectors = values[real], vectors[:, real]
    _, spread = v.projected(vectors / np.sqrt(values))
    return Whitening(n, total, values, vectors, values / trace, float(np.abs(spread - np.eye(len(values))).max()))


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per whole vector and component (up to ``components``, numbered from 1 by
    falling eigenvalue): ``vec_id``, ``component``, ``n``, ``deviation`` (exact decimal: sum over
    dimensions of (n x - S)^2), ``whitened``, ``explained`` and ``identity_error``.

    NULL vectors, vectors with NULL or non-finite entries and vectors shorter than the
    longest (empty ones, too) are left out and do not count.  Repeated rows each count and are
    each returned, an id of NULL stays NULL, other columns of ``df`` are not looked at.  An
    empty table, one row, or rows that are all equal have no variance: no component, no rows.
    Directions of equal eigenvalue are some orthonormal basis of theirs.
    """
    rows = written(integer_vectors(df, vec_id, vector), "integer-vectors")
    model = fit(rows, components)
    k, dims = len(model.values), len(model.total)
    n, total, explained, error = model.n, model.total, model.explained.tolist(), model.identity_error
    projection = model.vectors / np.sqrt(model.values) if k else np.empty((dims, 0))

    def project(batches):
        from decimal import Decimal

        mean, rest = [s // n for s in total] if n else [], [s % n for s in total] if n else []
        own = sum(z * z for z in rest)
        for b in batches:
            column = b.column(b.schema.get_field_index("x"))
            for at in range(0, b.num_rows, ROW_BLOCK):
                x = _matrix(column.slice(at, ROW_BLOCK), dims)
                w = _deviations(x, n, total) @ projection
                off = x - np.array(mean, dtype=np.int64)
                # n x - S = n off - rest, squared and summed in whole numbers
                far = int(np.abs(off).max(initial=0)) + 1
                if far * max(n, far) * dims < 2**62:
                    z = np.array(rest, dtype=np.int64)
                    deviation = [n * n * a - 2 * n * c for a, c in zip((off * off).sum(axis=1).tolist(), (off @ z).tolist(), strict=True)]
                    deviation = [d + own for d in deviation]
                else:
                    deviation = [sum((n * a - z) ** 2 for a, z in zip(row, rest, strict=True)) for row in off.tolist()]
                m = len(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, ROW_BLOCK), pa.array([Decimal(d) for d in deviation], pa.decimal128(38, 0)),
                     pa.ListArray.from_arrays(np.arange(0, (m + 1) * k, k, dtype=np.int32) if k else np.zeros(m + 1, dtype=np.int32),
                                              pa.array(w.ravel()))], ["id", "deviation", "w"])
    id_type = rows.schema["id"].dataType.simpleString()
    if not k:
        rows = rows.filter("false")
    projected = rows.mapInArrow(project, f"id {id_type}, deviation decimal(38,0), w array<double>")
    share = F.array(*[F.lit(e) for e in explained]) if k else F.array().cast("array<double>")
    return projected.select(F.col("id").alias(vec_id), "deviation", F.posexplode("w").alias("__pos", "whitened")).select(
        vec_id, (F.col("__pos") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("__pos")).alias("explained"), F.lit(error).alias("identity_error"))
