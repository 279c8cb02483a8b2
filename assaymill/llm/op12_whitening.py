"""Embedding whitening by the exact characteristic polynomial of the scatter.

Vectors become integers, floor(scale * c) + offset per entry, and each distinct one counts once. Then

1. *Scatter.* n, the sums S and the products G of the distinct vectors are summed exactly, each value
   in limbs of 30 bits, so that n G - S S^T, n squared times the covariance, is an integer matrix M
   without any rounding. (The offset cancels in M and is left out of the products.)
2. *Polynomial.* M's characteristic polynomial modulo each of many primes under 2^31, by reduction to
   Hessenberg form with the usual recurrence over its leading blocks; tasks share the primes. Chinese
   remaindering gives the integer coefficients. How many primes: M has no negative eigenvalue, so
   |c_k| <= C(d, k) (trace / d)^k.
3. *Roots.* All roots are real, so by Descartes' rule the sign changes of p(x + a) count exactly the
   roots over a. Bisection by these counts isolates the largest roots in exact dyadic arithmetic; a
   lone root is then bisected by the sign of p alone. Roots that no bisection to ``BITS`` relative bits
   parts are one eigenvalue with their number as multiplicity.
4. *Components.* Inverse iteration on M - lambda I in fixed point with ``BITS`` fractional bits, one
   task per eigenvalue; components of one eigenvalue are made orthonormal. Each component's sign makes
   its largest entry (the first such) positive.

Only M, d polynomials' worth of residues, and components reach the driver: sizes that the dimension
gives, not the number of vectors. Copies of a vector collapse in each task before they are shuffled.
Rows are projected where they lie, with the components broadcast (16 vectors).

Defined results: rows whose vector is null or holds a null or non-finite entry are dropped; rows that
repeat, and rows with null id, are returned each; vectors shorter than the longest end in entries 0;
entries beyond 2^52 / scale count as that bound; components of eigenvalue 0 can't be whitened and are not
returned, so neither an empty table nor one with a single distinct vector gives a row; ``deviation`` is
null where it exceeds 64 bits. Of columns only the two named are read. Which basis stands for an
eigenvalue of multiplicity two or more is fixed by the iteration's start vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_arrow, partitions, staged

#: Fractional bits of the fixed-point arithmetic, and relative bits to which eigenvalues are bisected.
BITS = 192
#: Bits of a limb in which exact sums travel.
LIMB = 30
#: Rows that are multiplied at a time: products of whole numbers under 2^20 stay exact in doubles.
ROWS = 4096
_EXACT = 1 << 20


# --- integers -----------------------------------------------------------------------------------------

def quantized(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, y): floor(scale * c) per entry, for the vectors that take part."""
    limit = float(2 ** 52)
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), F.coalesce(whole, F.lit(False)).alias("whole")) \
        .where("whole") \
        .select("vec_id", F.transform("x", lambda c: F.floor(
            F.greatest(F.least(c * scale, F.lit(limit)), F.lit(-limit))).cast("long")).alias("y"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of int64, those too short padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), np.int64)
    ends = np.cumsum(lengths)
    for row, n, end in zip(out, lengths, ends):
        row[:n] = flat[end - n:end]
    return out


def _exact_product(y: np.ndarray) -> np.ndarray:
    """y^T y in Python integers."""
    if np.abs(y).max(initial=0) < _EXACT // 2:
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    whole = y.astype(object)
    return whole.T @ whole


def _limbs(values: Sequence[int], count: int) -> list[list[int]]:
    """Signed integers as ``count`` lists of limbs, lowest first; the last one takes the rest."""
    out = []
    for _ in range(count - 1):
        out.append([v & ((1 << LIMB) - 1) for v in values])
        values = [v >> LIMB for v in values]
    return [*out, list(values)]


_PARTS = 5  # 4 * 30 bits and a signed rest: products of two numbers of 53 bits, 2^30 times and more


def scatter(fit: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums, and the products of the vectors ``y`` of ``fit``, all exact."""
    left, right = np.triu_indices(dim)
    names = [f"l{k}" for k in range(_PARTS)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = _matrix(batch.column(0).slice(at, ROWS), dim)
                n += len(y)
                small = np.abs(y).max(initial=0) < 1 << 50
                sums = sums + (y.sum(axis=0).astype(object) if small else y.astype(object).sum(axis=0))
                products = products + _exact_product(y)
        if n:
            values = [n, *sums.tolist(), *products[left, right].tolist()]
            limbs = _limbs([int(v) for v in values], _PARTS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(values)), pa.int32()), *(pa.array(x, pa.int64()) for x in limbs)], names=["at", *names])

    parts = fit.select("y").mapInArrow(add, "at int, " + ", ".join(f"{x} long" for x in names))
    total = [0] * (1 + dim + len(left))  # as many numbers as the dimension gives
    for row in parts.groupBy("at").agg(*[F.sum(x).alias(x) for x in names]).collect():
        total[row["at"]] = sum(row[x] << (LIMB * k) for k, x in enumerate(names))
    products = [[0] * dim for _ in range(dim)]
    for i, j, v in zip(left, right, total[1 + dim:]):
        products[i][j] = products[j][i] = v
    return total[0], total[1:1 + dim], products


# --- polynomial ---------------------------------------------------------------------------------------

def primes_below(limit: int, count: int) -> list[int]:
    """The ``count`` largest primes under ``limit`` (at most 2^31), by Miller-Rabin to bases 2, 3, 5, 7."""
    def prime(n: int) -> bool:
        d, s = n - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        for a in (2, 3, 5, 7):  # decides all numbers under 3,215,031,751
            x = pow(a, d, n)
            if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
                return False
        return True

    out, n = [], (limit - 1) | 1
    while len(out) < count:
        if n < limit and prime(n):
            out.append(n)
        n -= 2
    return out


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - matrix) modulo a prime under 2^31, constant term first.

    Similarity transformations clear each column under its subdiagonal; then the polynomials of the
    leading blocks follow from each other."""
    h = matrix.astype(np.int64) % p
    d = len(h)
    for k in range(d - 2):
        at = np.flatnonzero(h[k + 1:, k])
        if not len(at):
            continue
        pivot = k + 1 + int(at[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - factor[:, None] * h[k + 1] % p) % p
        gain = h[:, k + 2:] * factor % p  # each under 2^31, so a sum of 2^32 of them fits
        h[:, k + 1] = (h[:, k + 1] + gain.sum(axis=1)) % p
    block = [np.array([1], np.int64)]
    for k in range(1, d + 1):
        new = np.zeros(k + 1, np.int64)
        new[1:] = block[-1]
        new[:k] = (new[:k] - h[k - 1, k - 1] * block[-1] % p) % p
        below = 1
        for i in range(1, k):
            below = below * int(h[k - i, k - i - 1]) % p
            if not below:
                break
            weight = below * int(h[k - i - 1, k - 1]) % p
            new[:k - i] = (new[:k - i] - weight * block[k - i - 1] % p) % p
        block.append(new)
    return block[-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x I - matrix), constant term first, of a matrix without negative
    eigenvalues. Primes are dealt to tasks."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes = primes_below(1 << 31, (2 * bound).bit_length() // 30 + 2)
    shared = spark.sparkContext.broadcast(matrix)

    def reduce(batch: pa.RecordBatch):
        whole = np.array(shared.value, object)
        for p in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int64()), pa.array([polynomial_modulo(whole % p, p)], pa.list_(pa.int64()))], names=["p", "c"])

    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), partitions(spark)))
    rest = map_arrow(dealt, reduce, "p long, c array<long>").collect()
    modulus, value = 1, [0] * (d + 1)
    for p, coefficients in sorted((r["p"], r["c"]) for r in rest):
        inverse = pow(modulus, -1, p)
        value = [v + modulus * ((c - v) * inverse % p) for v, c in zip(value, coefficients)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


# --- roots --------------------------------------------------------------------------------------------

def _scaled(p: Sequence[int], bits: int) -> list[int]:
    """2^(bits d) p(x / 2^bits): its roots are 2^bits times those of p."""
    d = len(p) - 1
    return [c << (bits * (d - k)) for k, c in enumerate(p)]


def _roots_over(p: Sequence[int], a: int) -> int:
    """How many roots of a real-rooted polynomial lie over the integer a: sign changes of p(x + a)."""
    c = list(p)
    d = len(c) - 1
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(p: Sequence[int], a: int) -> int:
    value = 0
    for c in reversed(p):
        value = value * a + c
    return (value > 0) - (value < 0)


@dataclass
class Root:
    """``value`` / 2^``bits`` is the root, ``multiplicity`` how many roots it stands for."""

    value: int
    bits: int
    multiplicity: int


def largest_roots(p: Sequence[int], count: int) -> list[Root]:
    """The ``count`` largest positive roots, largest first, of a real-rooted polynomial without
    negative roots; at least so many with multiplicities, if there are."""
    zeros = next((k for k, c in enumerate(p) if c), len(p) - 1)
    p = list(p[zeros:])
    degree = len(p) - 1
    out: list[Root] = []
    if not degree:
        return out
    top = max(1, -p[-2])  # the sum of the roots
    open_ = [(0, top + 1, 0, degree)]  # (low, high] at a number of bits with as many roots; largest first
    found = 0
    while open_ and found < count:
        low, high, bits, n = open_.pop()
        if n == 1:
            out.append(_refined(p, low, high, bits))
            found += 1
            continue
        if low and (high - low).bit_length() + BITS <= low.bit_length():
            out.append(Root(high, bits, n))
            found += n
            continue
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
        middle = (low + high) // 2
        over = _roots_over(_scaled(p, bits), middle)
        # roots over ``high`` were counted out before: those of (middle, high] are the difference
        above = over - sum(r.multiplicity for r in out)
        if n - above:
            open_.append((low, middle, bits, n - above))
        if above:
            open_.append((middle, high, bits, above))
    return out


def _refined(p: list[int], low: int, high: int, bits: int) -> Root:
    """A lone root of (low, high], bisected by signs to ``BITS`` relative bits."""
    scaled = _scaled(p, bits)
    at_high = _sign(scaled, high)
    if not at_high:
        return Root(high, bits, 1)
    while not low or (high - low).bit_length() + BITS > low.bit_length():
        if high - low == 1:
            low, high, bits = 2 * low, 2 * high, bits + 1
            scaled = _scaled(p, bits)
        middle = (low + high) // 2
        sign = _sign(scaled, middle)
        if not sign:
            return Root(middle, bits, 1)
        if sign == at_high:
            high = middle
        else:
            low = middle
    return Root(high, bits, 1)


# --- components ---------------------------------------------------------------------------------------

def _orthonormal(v: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    """Fixed point: what of v is orthogonal to ``against``, with length 1."""
    for _ in range(2):
        for u in against:
            v = v - (u * (int((u * v).sum()) >> BITS) >> BITS)
    return (v << BITS) // max(1, math.isqrt(int((v * v).sum())))


def eigenvectors(matrix: list[list[int]], root: Root) -> list[np.ndarray]:
    """Orthonormal vectors for an eigenvalue, in fixed point: inverse iteration with one elimination of
    M - lambda I, whose last pivots are next to nothing. Start vectors differ in every entry."""
    d = len(matrix)
    unit = max(matrix[i][i] for i in range(d)).bit_length()  # entries are made at most 1
    a = np.array([[(v << BITS) >> unit for v in row] for row in matrix], object)
    shift = (root.value << BITS) >> (root.bits + unit)
    for i in range(d):
        a[i, i] -= shift
    swaps, factors = [], []
    for k in range(d):
        pivot = max(range(k, d), key=lambda r: abs(a[r, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
        swaps.append(pivot)
        if not a[k, k]:
            a[k, k] = 1  # the least number there is
        f = np.array([(x << BITS) // a[k, k] for x in a[k + 1:, k]], object)
        factors.append(f)
        if len(f):
            a[k + 1:, k:] = a[k + 1:, k:] - (f[:, None] * a[k, k:] >> BITS)

    def solved(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for k in range(d):
            b[k], b[swaps[k]] = b[swaps[k]], b[k]
            if k + 1 < d:
                b[k + 1:] = b[k + 1:] - (factors[k] * b[k] >> BITS)
        for k in range(d - 1, -1, -1):
            rest = b[k] - (int((a[k, k + 1:] * b[k + 1:]).sum()) >> BITS if k + 1 < d else 0)
            b[k] = (rest << BITS) // a[k, k]
        return b

    found: list[np.ndarray] = []
    for m in range(root.multiplicity):
        v = np.array([(1 << BITS) // (2 + (i * (2 * m + 3) + m) % (d + m + 1)) for i in range(d)], object)
        v = _orthonormal(v, found)
        for _ in range(3):
            v = _orthonormal(solved(v), found)
        largest = max(range(d), key=lambda i: (abs(v[i]), -i))
        found.append(v if v[largest] > 0 else -v)
    return found


@dataclass
class Whitening:
    """``center`` and ``vectors`` are in units of y, without the offset. ``explained`` is each component's
    share of the total variance, ``eigenvalue`` its variance."""

    n: int
    sums: list[int]
    dim: int
    eigenvalue: list[float]
    explained: list[float]
    vectors: np.ndarray
    identity_error: float = 0.0

    def apply(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows: (y - S / n) on the components, over the root of the eigenvalues."""
        center = np.array([s / self.n for s in self.sums])
        return (y - center) @ self.vectors.T / np.sqrt(np.array(self.eigenvalue))


def fit_whitening(y: DataFrame, components: int = 16) -> Whitening | None:
    """From rows with a vector ``y`` of whole numbers; None where no component has any variance."""
    spark = y.sparkSession
    dim = y.agg(F.max(F.size("y")).alias("d")).first()["d"] or 0
    if not dim:
        return None
    full = F.concat("y", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("y")))
    fit = staged(y.select(full.alias("y")).groupBy("y").agg(F.count(F.lit(1)).alias("copies")), "distinct_vectors")
    n, sums, products = scatter(fit, dim)
    matrix = [[n * g - sums[i] * sums[j] for j, g in enumerate(row)] for i, row in enumerate(products)]
    trace = sum(matrix[i][i] for i in range(dim))
    if not trace:
        return None
    roots = largest_roots(characteristic_polynomial(spark, matrix), components)
    shared = spark.sparkContext.broadcast((matrix, roots))

    def look(batch: pa.RecordBatch):
        whole, all_roots = shared.value
        for k in batch.column(0).to_pylist():
            found = [[int(x) / (1 << BITS) for x in v] for v in eigenvectors(whole, all_roots[k])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(found), pa.int32()), pa.array(range(len(found)), pa.int32()),
                 pa.array(found, pa.list_(pa.float64()))], names=["root", "m", "v"])

    dealt = spark.createDataFrame([(k,) for k in range(len(roots))], "k int").repartition(len(roots))
    rows = sorted(map_arrow(dealt, look, "root int, m int, v array<double>").collect(), key=lambda r: (r["root"], r["m"]))[:components]
    value = [(roots[r["root"]].value, roots[r["root"]].bits) for r in rows]
    whitening = Whitening(
        n, sums, dim, [a / ((n * n) << b) for a, b in value], [a / (trace << b) for a, b in value],
        np.array([r["v"] for r in rows]))
    whitening.identity_error = _identity_error(fit, whitening)
    return whitening


def _identity_error(fit: DataFrame, whitening: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity. Whitened vectors are
    centred by S / n before they are multiplied; their mean, rounding alone, is taken off as well."""
    shared = fit.sparkSession.sparkContext.broadcast(whitening)
    k = len(whitening.eigenvalue)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        total, products, any_ = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                x = w.apply(_matrix(batch.column(0).slice(at, ROWS), w.dim))
                total, products, any_ = total + x.sum(axis=0), products + x.T @ x, True
        if any_:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(k + k * k), pa.int32()), pa.array([*total, *products.ravel()])], names=["at", "x"])

    sums = np.zeros(k + k * k)
    for row in fit.select("y").mapInArrow(add, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        sums[row["at"]] = row["x"] / whitening.n
    mean, second = sums[:k], sums[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, scale: int = 64, offset: int = 1_000_000, components: int = 16,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row and component: vec_id, component, n, deviation, whitened, explained, identity_error.
    ``offset`` is part of the integers' definition; no result depends on it."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    y = quantized(vectors, scale, id_col, vector_col)
    fitted = fit_whitening(y, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema)
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)

    def project(batch: pa.RecordBatch):
        w = shared.value
        k = len(w.eigenvalue)
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            m = _matrix(part.column("y"), w.dim)
            far = w.n * int(np.abs(m).max(initial=0)) + max(map(abs, w.sums))
            kind = np.int64 if far * far * w.dim < 1 << 63 else object
            off = m.astype(kind) * w.n - np.array(w.sums, kind)
            deviation = [int(x) if x < 1 << 63 else None for x in (off * off).sum(axis=1)]
            rows = len(m)
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, w.n)),
                pa.array([x for x in deviation for _ in range(k)], pa.int64()),
                pa.array(w.apply(m).ravel()), pa.array(np.tile(w.explained, rows)),
                pa.array(np.full(rows * k, w.identity_error))], names=schema.replace(",", "").split()[::2])

    return map_arrow(y, project, schema)
