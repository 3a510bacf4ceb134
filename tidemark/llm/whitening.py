"""Whitening of vectors by the exact characteristic polynomial of their integer scatter.

Entries are made integers, so sums of products are exact: tasks add them up, and only matrices of the vectors' dimension are
shuffled and brought together. With ``n`` rows, sums ``S`` and products ``G`` the scatter ``n G - S S'`` is an integer matrix, the
covariance times ``n`` squared. Its characteristic polynomial is found modulo many primes, a prime per row of a Spark job, by
reduction to Hessenberg form, and put together by Chinese remaindering; the number of primes follows from a bound of the
coefficients. All its roots are real, so the sign changes of the shifted polynomial count the roots above a point exactly: the
largest roots are isolated by bisection with that count, equal roots included, and each is refined in integer arithmetic. A
component is the null space of the scatter less its root, by inverse iteration in fixed-point numbers long enough for the root's
precision, one root per row of a Spark job. What grows with the table is only read, never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.shared import blocks_by_key, lanes

SCALE = 64
#: Components returned at most.
COMPONENTS = 32
#: Bits of an exact product's factors and of a limb in transit.
HALF, LIMB = 20, 32
#: Roots closer than this many bits of their size are one root of several components; bits a root is refined to; spare bits.
CLOSE, REFINED, SPARE = 100, 160, 160


# Exact sums -------------------------------------------------------------------


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part: every entry given and finite.

    Vectors of another length than most (ties: the longer one) take no part, nor do empty ones.
    """
    e = F.col("embedding").cast("array<double>")
    sound = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where(sound).where(F.size("embedding") > 0)
    size = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (size["d"] if size else 0))


def integers(column: pa.Array, d: int) -> np.ndarray:
    """``floor(64 c)`` of every entry; Python integers where 64 bits are too few for exact doubles.

    The constant that the contract adds drops out of every result, as all are centred.
    """
    values = np.asarray(column.flatten(), np.float64).reshape(-1, d)
    with np.errstate(over="ignore"):
        y = np.floor(values * SCALE)
    if not len(y) or np.abs(y).max() < 2.0 ** 53:
        return y.astype(np.int64)
    return np.array([[(p * SCALE) // q for p, q in (v.as_integer_ratio() for v in row)] for row in values.tolist()], object)


def gram(y: np.ndarray) -> np.ndarray:
    """Exact ``y' y`` as Python integers, from products of doubles that cannot round."""
    total = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), 1 << 12):
        parts, rest = [], y[at:at + (1 << 12)]
        while np.abs(rest).max() >= 1 << HALF:
            parts.append((rest & ((1 << HALF) - 1)).astype(np.float64))
            rest = rest >> HALF
        parts.append(rest.astype(np.float64))
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                total += (left.T @ right).astype(np.int64).astype(object) << (HALF * (a + b))
    return total


def _sums(d: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The products of a task's vectors, each with a one behind it, row by row in signed limbs."""
    total = np.zeros((d + 1, d + 1), object)
    for batch in batches:
        if batch.num_rows:
            y = integers(batch.column("embedding"), d)
            total += gram(np.concatenate([y, np.ones((len(y), 1), y.dtype)], axis=1))
    limb = 0
    while np.any(total != 0):
        last = all(-(1 << 62) < v < 1 << 62 for v in total.flat)
        part = total if last else total & ((1 << LIMB) - 1)
        total = np.zeros_like(total) if last else total >> LIMB
        rows = [r.astype(np.int64).tobytes() for r in part]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d + 1), pa.int32()), pa.array([limb] * (d + 1), pa.int32()), pa.array(rows, pa.binary())], ["i", "limb", "part"]
        )
        limb += 1


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of limbs per row, as decimal text: a total may be longer than any number type."""
    state = None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([state[0]], pa.int32()), pa.array([[str(v) for v in state[1]]])], ["i", "row"])

    for fresh, cols in blocks_by_key(batches, ["i"]):
        if fresh:
            if state:
                yield done()
            state = (int(cols["i"][0]), 0)
        for limb, part in zip(cols["limb"].tolist(), cols["part"]):
            state = (state[0], state[1] + (np.frombuffer(part, np.int64).astype(object) << (LIMB * limb)))
    if state:
        yield done()


@dataclass
class Scatter:
    """``n`` rows, their sums per dimension, and ``n`` squared times their covariance; exact."""

    n: int
    sums: np.ndarray
    matrix: np.ndarray


def scatter(rows: DataFrame, d: int) -> Scatter:
    parts = rows.select("embedding").mapInArrow(partial(_sums, d), "i int, limb int, part binary")
    added = parts.repartition(lanes(rows.sparkSession), "i").sortWithinPartitions("i").mapInArrow(_added, "i int, row array<string>")
    found = {r["i"]: [int(v) for v in r["row"]] for r in added.collect()}  # as many rows as dimensions
    g = np.array([found.get(i, [0] * (d + 1)) for i in range(d + 1)], object)
    n, sums = g[d, d], g[d, :d]
    return Scatter(n, sums, n * g[:d, :d] - np.outer(sums, sums))


# Characteristic polynomial ----------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that are proof below 2^64."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    r = ((n - 1) & (1 - n)).bit_length() - 1
    for a in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37):
        x = pow(a, (n - 1) >> r, n)
        if a % n and x != 1 and all(pow(x, 1 << k, n) != n - 1 for k in range(r)):
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2^31 whose product has more than ``bits`` bits."""
    found, product, p = [], 1, 1 << 31
    while product.bit_length() <= bits:
        p -= 1
        if is_prime(p):
            found.append(p)
            product *= p
    return found


def coefficient_bits(m: np.ndarray) -> int:
    """Bits that hold every coefficient: they are symmetric sums of roots >= 0 whose sum is the trace."""
    d, t = len(m), int(np.trace(m))
    return max((comb(d, k) * t ** k // d ** k + 1).bit_length() for k in range(d + 1)) + 1


def polynomial_modulo(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of ``det(x - m)`` modulo a prime below 2^31, the highest first."""
    h, d = (m % p).astype(np.int64), len(m)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        if below[0]:
            i, j = k + 1, k + 1 + int(below[0])
            h[[i, j]] = h[[j, i]]
            h[:, [i, j]] = h[:, [j, i]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(axis=1)) % p
    done = np.zeros((d + 1, d + 1), np.int64)  # row k: polynomial of the leading k rows and columns, the lowest coefficient first
    done[0, 0] = 1
    for k in range(d):
        factors, product = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):  # column k, times the subdiagonal between row i and row k
            factors[i] = int(h[i, k]) * product % p
            product = product * int(h[i, i - 1]) % p if i else 0
        done[k + 1, 1:] = done[k, :-1]
        done[k + 1] = (done[k + 1] - (factors[:, None] * done[:k + 1] % p).sum(axis=0)) % p
    return done[d, ::-1]


def _polynomials(m: np.ndarray, moduli: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in batch.column(0).to_pylist():
            made = polynomial_modulo(m, moduli[k])
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([made.tobytes()], pa.binary())], ["id", "made"])


def remaindered(residues: list[np.ndarray], moduli: list[int]) -> list[int]:
    """The integers of smallest size with the given residues."""
    value, product = np.zeros(len(residues[0]), object), 1
    for r, p in zip(residues, moduli):
        step = (r.astype(object) - value) * pow(product, -1, p) % p
        value, product = value + product * step, product * p
    return [int(v - product) if 2 * v > product else int(v) for v in value]


def characteristic(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Coefficients of ``det(x - m)``, the highest first; a prime per row of a Spark job."""
    moduli = primes(coefficient_bits(m))
    jobs = spark.range(len(moduli)).repartition(min(len(moduli), lanes(spark)))
    made = dict(map(tuple, jobs.mapInArrow(partial(_polynomials, m, moduli), "id long, made binary").collect()))
    return remaindered([np.frombuffer(made[k], np.int64) for k in range(len(moduli))], moduli)


# Roots ------------------------------------------------------------------------


def roots_above(poly: list[int], point: int, bits: int) -> int:
    """How many roots, counted as often as they occur, are larger than ``point / 2**bits``.

    Sign changes of the shifted coefficients bound the number of positive roots, and reach it when all roots are real.
    """
    c = [v << (bits * k) for k, v in enumerate(poly)]
    for stop in range(len(c), 1, -1):
        carry = c[0]
        for j in range(1, stop):
            carry = c[j] = c[j] + point * carry
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


@dataclass(frozen=True)
class Root:
    """``count`` roots in ``(low, high] / 2**bits``, with ``above`` larger ones."""

    low: int
    high: int
    bits: int
    count: int
    above: int


def largest_roots(poly: list[int], trace: int, wanted: int) -> list[Root]:
    """The largest positive roots, each in an interval of its own or in one too narrow to matter; the largest first."""
    rank = roots_above(poly, 0, 0)
    wanted, found = min(wanted, rank), []
    waiting = [(0, trace, 0, rank, 0)]
    while waiting:
        low, high, bits, below, above = waiting.pop()
        if below == above or above >= wanted:
            continue
        if below - above == 1 or (high - low == 1 and low.bit_length() > CLOSE):
            found.append(Root(low, high, bits, below - above, above))
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        n = roots_above(poly, middle, bits)
        waiting += [(low, middle, bits, below, n), (middle, high, bits, n, above)]
    return sorted(found, key=lambda r: r.above)


def refined(poly: list[int], root: Root) -> tuple[int, int]:
    """A root to ``REFINED`` bits, as ``(number, bits)``: number / 2**bits."""
    low, high, bits = root.low, root.high, root.bits
    odd = root.above % 2
    while root.count == 1 and (high - low > 1 or low.bit_length() < REFINED):
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle, value = (low + high) // 2, 0
        for k, c in enumerate(poly):
            value = value * middle + (c << (bits * k))
        if not value:
            return middle, bits
        if (value < 0) == odd:  # as many roots above the middle as above the interval
            high = middle
        else:
            low = middle
    return high, bits


# Components -------------------------------------------------------------------


def null_space(m: np.ndarray, root: tuple[int, int], count: int) -> np.ndarray:
    """``count`` orthonormal rows spanning the null space of ``m`` less its root, rounded to doubles.

    Inverse iteration in fixed-point numbers: elimination with row pivots, three solves, rows made orthonormal after each.
    """
    d, (number, bits) = len(m), root
    trace, size = int(np.trace(m)), max(number >> bits, 1)
    point = REFINED + SPARE + trace.bit_length() - size.bit_length() + 2 * d.bit_length()
    shift = max(point - trace.bit_length(), bits)
    a = m.copy() << shift
    a[np.diag_indices(d)] -= number << (shift - bits)
    order, factors = [], []
    for k in range(d):
        j = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, j]] = a[[j, k]]
        order.append(j)
        if a[k, k] == 0:
            a[k, k] = 1  # the smallest step: the root is exact, the null space is found all the same
        f = (a[k + 1:, k] << point) // a[k, k]
        a[k + 1:, k:] -= (f[:, None] * a[k, k:]) >> point
        factors.append(f)
    rng = np.random.default_rng(d)
    v = rng.integers(-(1 << 30), 1 << 30, (count, d)).astype(object) << point
    for _ in range(3):
        for r in range(count):
            x = v[r].copy()
            for k in range(d):
                x[[k, order[k]]] = x[[order[k], k]]
                x[k + 1:] -= (factors[k] * x[k]) >> point
            for k in range(d - 1, -1, -1):
                x[k] = ((x[k] - (int((a[k, k + 1:] * x[k + 1:]).sum()) >> shift if k + 1 < d else 0)) << shift) // a[k, k]
            v[r] = x
        for r in range(count):
            x = _unit(v[r], point)
            for _ in range(2):
                for q in v[:r]:
                    x = x - ((q * (int((q * x).sum()) >> point)) >> point)
                x = _unit(x, point)
            v[r] = x
    out = np.array([[x / (1 << point) for x in row] for row in v.tolist()])
    flip = out[np.arange(count), np.abs(out).argmax(axis=1)] < 0
    return np.where(flip[:, None], -out, out)


def _unit(x: np.ndarray, point: int) -> np.ndarray:
    """The vector with length 1, at ``point`` binary places."""
    excess = max(max(abs(int(c)) for c in x).bit_length() - 2 * point, 0)
    x = x >> excess
    return (x << point) // max(isqrt(int((x * x).sum())), 1)


def square_root(number: int, bits: int) -> float:
    """The root of ``number / 2**bits`` as a double, whatever its size."""
    spare = 128 + bits % 2
    return isqrt(number << spare) / (1 << ((bits + spare) // 2))


@dataclass
class Whitening:
    """``weights`` turn ``n x - S`` into whitened values; ``explained`` is each component's share of the variance."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    weights: np.ndarray
    explained: list[float]


def _components(m: np.ndarray, poly: list[int], roots: list[Root], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trace = int(np.trace(m))
    for batch in batches:
        for k in batch.column(0).to_pylist():
            number, bits = refined(poly, roots[k])
            rows = null_space(m, (number, bits), roots[k].count)
            share = number / (trace << bits)
            scaled = rows / square_root(number, bits)
            columns = [[k] * len(rows), [share] * len(rows), [r.tobytes() for r in rows], [r.tobytes() for r in scaled]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1]), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.binary())],
                ["id", "share", "component", "weights"],
            )


def fit(rows: DataFrame, d: int, wanted: int = COMPONENTS) -> Whitening:
    """Components and weights of ``usable`` rows of ``d`` entries; as many components as there are positive eigenvalues, at most ``wanted``."""
    spark, s = rows.sparkSession, scatter(rows, d)
    trace = int(np.trace(s.matrix)) if d else 0
    if not trace:  # no rows, or equal ones: no variance to whiten
        return Whitening(s.n, s.sums, np.zeros((0, d)), np.zeros((0, d)), [])
    poly = characteristic(spark, s.matrix)
    roots = largest_roots(poly, trace, wanted)
    jobs = spark.range(len(roots)).repartition(min(len(roots), lanes(spark)))
    made = jobs.mapInArrow(partial(_components, s.matrix, poly, roots), "id long, share double, component binary, weights binary").collect()
    made = sorted(made, key=lambda r: r["id"])[:wanted]
    return Whitening(
        s.n, s.sums, np.array([np.frombuffer(r["component"]) for r in made]), np.array([np.frombuffer(r["weights"]) for r in made]),
        [r["share"] for r in made],
    )


# Whitened rows ----------------------------------------------------------------


def _centred(column: pa.Array, model: Whitening) -> np.ndarray:
    """Exact ``n x - S``: 64-bit integers, or Python's where they may not do."""
    y = integers(column, len(model.sums))
    widest = model.n * int(np.abs(y).max()) + int(max(abs(v) for v in model.sums))
    if widest < 1 << 62 and y.dtype != object:
        return model.n * y - model.sums.astype(np.int64)
    return model.n * y.astype(object) - model.sums


def _whitened(z: np.ndarray, model: Whitening) -> np.ndarray:
    return z.astype(np.float64) @ model.weights.T


def _deviations(z: np.ndarray) -> list[int | None]:
    """Sums of squares; None where one does not fit a long."""
    if z.dtype != object and int(np.abs(z).max()) ** 2 * z.shape[1] < 1 << 63:
        return (z * z).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in z.tolist()]
    return [v if v < 1 << 63 else None for v in sums]


def _moments(model: Whitening, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of whitened values and of their centred products, per task; ``j`` is -1 for the plain sums."""
    k = len(model.weights)
    n, mean, spread = 0, np.zeros(k), np.zeros((k, k))
    for batch in batches:
        if not batch.num_rows:
            continue
        w = _whitened(_centred(batch.column("embedding"), model), model)
        m, own = len(w), w.mean(axis=0)
        gap, w = own - mean, w - own
        spread += w.T @ w + np.outer(gap, gap) * (n * m / (n + m))
        mean, n = mean + gap * (m / (n + m)), n + m
    if n:
        i, j = np.triu_indices(k)
        products = spread + n * np.outer(mean, mean)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([i, np.arange(k)]), pa.int32()), pa.array(np.concatenate([j, np.full(k, -1)]), pa.int32()),
             pa.array(np.concatenate([products[i, j], n * mean]))], ["i", "j", "v"],
        )


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, measured on the rows."""
    k = len(model.weights)
    found = rows.select("embedding").mapInArrow(partial(_moments, model), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    products, mean = np.zeros((k, k)), np.zeros(k)
    for r in found.collect():  # at most 32 * 33 / 2 + 32 rows
        if r["j"] < 0:
            mean[r["i"]] = r["v"] / model.n
        else:
            products[r["i"], r["j"]] = products[r["j"], r["i"]] = r["v"] / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _rows(model: Whitening, error: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k = len(model.weights)
    for batch in batches:
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            z = _centred(part.column("embedding"), model)
            m, places = len(z), np.repeat(np.arange(len(z)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(places)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n), pa.int64()), pa.array(_deviations(z), pa.int64()).take(pa.array(places)),
                    pa.array(_whitened(z, model).ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, error)),
                ],
                [f.split()[0] for f in WHITENED.split(", ")],
            )


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row that takes part.

    Rows whose vector is NULL, empty, of another length than most, or holds NULL or non-finite entries are dropped; a NULL
    ``vec_id`` stays NULL. Repeated rows all count and all come back. There are as many components as positive eigenvalues (at
    most ``components``); equal eigenvalues give orthonormal vectors of their common space. Vectors without variance, and an empty
    table, give no rows. A deviation that no long can hold is NULL. Further columns are not looked at.
    """
    spark, rows = table.sparkSession, usable(table)
    head = rows.select(F.size("embedding").alias("d")).first()
    model = fit(rows, head["d"], components) if head else None
    if model is None or not len(model.weights):
        return spark.createDataFrame([], WHITENED)
    return rows.mapInArrow(partial(_rows, model, identity_error(rows, model)), WHITENED)
