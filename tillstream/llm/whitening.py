"""Whitening of embeddings by their leading components, found by spectrum slicing.

Each entry c of a vector becomes the integer x = floor(256 c). Components belong to the covariance of
the different x vectors (the fit list). Its leading eigenvalues are isolated by counting: for a shift
s, the inertia of V - sI, read off an LDL' factorisation, tells how many eigenvalues exceed s, and
bisection narrows an interval until it holds the wanted one alone. Rayleigh quotient iteration
converges from there, cubically, and counts on both sides of the result certify its number. Where
several eigenvalues are too close to be told apart in double precision, the interval holds the group,
and each of its vectors is kept orthogonal to those before.

Sums over the fit list are taken per task and added up in Spark; what reaches the driver are d sums and
d x d products, d being the length of a vector, never a row.

Rows: those whose vector is null or holds a null or non-finite entry are dropped; repeated rows are kept
each and count once in the fit. Shorter vectors count as filled up with zeros, entries beyond the range
of a long as its ends. ``deviation`` is null where it exceeds a long. There are as many components as
wanted, or as eigenvalues above zero (within double precision), if fewer: none for one vector, or none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.session import settle

EPS = np.finfo(float).eps
LONG = 2**63 - 1
# Rows worked on at once in a task.
BLOCK = 4_096


# eigenvalues of a small symmetric matrix

def above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of ``v`` exceed ``shift``: the positive pivots of v - shift I = LDL'.

    Pivots of one or two rows are chosen by the largest entries left, so that factors stay small. A
    remainder of zeros counts as not above.
    """
    a = v - shift * np.eye(len(v))
    limit = (1 + 17**0.5) / 8
    count = 0
    while len(a):
        i, j = np.unravel_index(np.argmax(np.abs(a)), a.shape)
        largest = abs(a[i, j])
        if largest == 0:
            break
        k = int(np.argmax(np.abs(np.diag(a))))
        if abs(a[k, k]) >= limit * largest:
            count += bool(a[k, k] > 0)
            rest = np.delete(np.arange(len(a)), k)
            column = a[rest, k]
            a = a[np.ix_(rest, rest)] - np.outer(column / a[k, k], column)
        else:
            # The two-row pivot has a negative determinant: one eigenvalue of either sign.
            count += 1
            rest = np.delete(np.arange(len(a)), [i, j])
            columns = a[np.ix_(rest, [i, j])]
            pivot = a[np.ix_([i, j], [i, j])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(pivot, columns.T)
    return count


@dataclass(frozen=True)
class Component:
    value: float
    vector: np.ndarray
    certified: bool


def _slice(v: np.ndarray, k: int, low: float, high: float, least: float) -> tuple[float, float]:
    """An interval around the k-th eigenvalue from above, with no other one in it if they are further
    than ``least`` apart: above(low) >= k > above(high)."""
    n_low, n_high = above(v, low), above(v, high)
    while (n_low > k or n_high < k - 1) and high - low > least:
        middle = (low + high) / 2
        n = above(v, middle)
        if n >= k:
            low, n_low = middle, n
        else:
            high, n_high = middle, n
    return low, high


def _quotient_iteration(v: np.ndarray, low: float, high: float, before: list[np.ndarray],
                        noise: float) -> tuple[float, np.ndarray]:
    """The eigenpair in (low, high), orthogonal to ``before``; the interval's middle is the first shift."""
    def apart(y):
        for b in before * 2:
            y = y - b * (b @ y)
        return y / np.linalg.norm(y)

    def solve(shift, y):
        # A shift that is an eigenvalue makes the matrix singular; a hair beside it does not.
        for step in (0.0, noise, -noise):
            try:
                found = np.linalg.solve(v - (shift + step) * np.eye(len(v)), y)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(found).all() and np.linalg.norm(found):
                return found / np.linalg.norm(found)
        return y

    y = apart(np.random.default_rng(13).standard_normal(len(v)))
    middle = (low + high) / 2
    for _ in range(4):
        y = apart(solve(middle, y))
    best = None
    for _ in range(40):
        shift = float(y @ v @ y)
        residual = float(np.linalg.norm(v @ y - shift * y))
        if best is None or residual < best[0]:
            best = residual, shift, y
        elif best[0] <= 4 * noise:
            break
        # A quotient outside the interval belongs to another eigenvalue: the middle leads back.
        y = apart(solve(shift if low <= shift <= high else middle, y))
    _, shift, y = best
    return shift, y if y[np.argmax(np.abs(y))] > 0 else -y


def leading(v: np.ndarray, most: int) -> list[Component]:
    """The leading eigenpairs of a covariance, at most ``most``, by falling eigenvalue."""
    trace = float(np.trace(v)) if len(v) else 0.0
    if not trace > 0:
        return []
    v = v / trace
    # Where rounding alone may have moved an eigenvalue to; also the least one that counts.
    noise = len(v) * EPS
    found: list[Component] = []
    while len(found) < min(most, len(v)):
        k = len(found) + 1
        if above(v, noise) < k:
            break
        low, high = _slice(v, k, 0.0, 1 + 1e-9, 4 * noise)
        before = [c.vector for c in found]
        while True:
            value, vector = _quotient_iteration(v, low, high, before, noise)
            certified = above(v, value - 8 * noise) >= k > above(v, value + 8 * noise)
            if certified or high - low <= 4 * noise:
                break
            # It went to a neighbour all the same: start over from half the interval.
            middle = (low + high) / 2
            low, high = (middle, high) if above(v, middle) >= k else (low, middle)
        found.append(Component(value * trace, vector, certified))
    if not all(c.certified for c in found):
        raise ArithmeticError("counts of eigenvalues do not agree with the components found")
    # Within a group that counts cannot separate, the quotients decide the order.
    return sorted(found, key=lambda c: -c.value)


# sums over all rows

def integers(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows of ``df`` that can take part, with ``_x``: floor(256 c) of each entry as a long."""
    entry = F.col(f"`{vector}`")
    usable = entry.isNotNull() & F.forall(
        entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    x = F.transform(entry, lambda c: F.floor(F.least(F.greatest(
        c.cast("double") * 256, F.lit(-2.0**63)), F.lit(float(2**63 - 1024)))))
    return df.filter(F.coalesce(usable, F.lit(False))).withColumn("_x", x)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of longs, shorter ones filled up with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == d).all():
        return flat.reshape(len(column), d)
    out = np.zeros((len(column), d), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.concatenate([np.arange(n) for n in sizes])] = flat
    return out


def _blocks(batches, d: int):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, _matrix(part.column("_x"), d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as longs where they suffice, else as Python's integers."""
    widest = n * int(max(x.max(initial=0), -int(x.min(initial=0)))) + max(map(abs, sums), default=0)
    if widest < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviation(t: np.ndarray) -> list[int | None]:
    widest = max(int(t.max(initial=0)), -int(t.min(initial=0)))
    if t.dtype == object or t.shape[1] * widest**2 > LONG:
        t = t.astype(object)
    return [int(s) if s <= LONG else None for s in (t * t).sum(axis=1)]


@dataclass(frozen=True)
class Fit:
    """What the fit list says: its size, sums per dimension, components, and the matrix's trace."""
    n: int
    sums: list[int]
    components: list[Component]
    trace: float
    identity_error: float

    def whitened(self, t: np.ndarray) -> np.ndarray:
        return project(t, self.n, self.components)


def project(t: np.ndarray, n: int, components: list[Component]) -> np.ndarray:
    centred = t.astype(float) / n
    return np.stack([centred @ c.vector / c.value**0.5 for c in components], axis=1)


def _products(fit: DataFrame, d: int, side: int, rows) -> np.ndarray:
    """The sum over the fit list of the outer products of ``rows(x)``, ``side`` wide: added up per task,
    then by entry, with the sums of a task's entries combined before the shuffle."""
    def work(batches):
        total = np.zeros((side, side))
        for _, x in _blocks(batches, d):
            z = rows(x)
            total += z.T @ z
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(side), pa.int32()),
                                          "row": pa.array(list(total), pa.list_(pa.float64()))})

    parts = fit.select("_x").mapInArrow(work, "i int, row array<double>")
    entries = (parts.select("i", F.posexplode("row").alias("j", "value")).filter("j >= i")
               .groupBy("i", "j").agg(F.sum("value").alias("value")).collect())
    out = np.zeros((side, side))
    for r in entries:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def fit(x: DataFrame, most: int = 4) -> Fit:
    """The fit of the different vectors ``_x`` of ``x``. The list is settled and read three times."""
    least, d = x.agg(F.min(F.size("_x")), F.max(F.size("_x"))).first()
    if not d:
        return Fit(0, [], [], 0.0, 0.0)
    if least < d:
        zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("_x"))
        x = x.select(F.concat("_x", zeros).alias("_x"))
    different = settle(x.select("_x").distinct(), "fit")
    n = different.count()

    def add(batches):
        total = np.zeros(d, object)
        for _, rows in _blocks(batches, d):
            # Halves of the longs, so that sums of many rows stay exact.
            total += (rows >> 32).sum(axis=0).astype(object) * 2**32 + (rows & 0xFFFFFFFF).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_pydict({"s": pa.array([[str(s) for s in total]], pa.list_(pa.string()))})

    sums = [0] * d
    for r in (different.mapInArrow(add, "s array<string>").select(F.posexplode("s").alias("j", "s"))
              .groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()):
        sums[r["j"]] = int(r["s"])
    v = _products(different, d, d, lambda rows: _centred(rows, n, sums).astype(float) / n) / n
    components = leading(v, most)
    error = 0.0
    if components:
        z = _products(different, d, len(components),
                      lambda rows: project(_centred(rows, n, sums), n, components)) / n
        error = float(np.abs(z - np.eye(len(components))).max())
    return Fit(n, sums, components, float(np.trace(v)), error)


def whiten(df: DataFrame, fitted: Fit, vector: str = "embedding", to: str = "whitened") -> DataFrame:
    """The rows of ``df`` that can take part, with ``to``: their coordinates along the components of unit
    variance, as an array. It replaces a column of that name."""
    keep = [c for c in df.columns if c not in (to, "_x", "_row")]
    rows = integers(df.select(*[F.col(f"`{c}`") for c in keep]), vector)
    d = len(fitted.sums)

    def work(batches):
        for part, x in _blocks(batches, d):
            z = (fitted.whitened(_centred(x, fitted.n, fitted.sums)) if fitted.components
                 else np.zeros((len(x), 0)))
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + [pa.array(list(z), pa.list_(pa.float64()))], [*keep, to])

    own = ", ".join(f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(work, f"{own}, `{to}` array<double>")


def report(df: DataFrame, most: int = 4) -> DataFrame:
    """Per row and component: its number, the row's exact deviation and coordinate, the share of variance."""
    x = integers(df.select("vec_id", "embedding")).select(F.col("vec_id").cast("long").alias("vec_id"), "_x")
    fitted = fit(x, most)
    d, count = len(fitted.sums), len(fitted.components)
    shares = [c.value / fitted.trace for c in fitted.components]
    fields = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def work(batches):
        for part, rows in _blocks(batches, d):
            if not count:
                continue
            t = _centred(rows, fitted.n, fitted.sums)
            size, each = len(rows), np.repeat(np.arange(len(rows)), count)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, count + 1), size), pa.int32()),
                 pa.array(np.full(size * count, fitted.n), pa.int64()),
                 pa.array(_deviation(t), pa.int64()).take(pa.array(each)), pa.array(fitted.whitened(t).ravel()),
                 pa.array(np.tile(shares, size)), pa.array(np.full(size * count, fitted.identity_error))],
                schema=fields)

    return x.mapInArrow(work, "vec_id long, component int, n long, deviation long, whitened double, "
                              "explained double, identity_error double")
