"""Whitening of vectors from the exact characteristic polynomial of their integer scatter.

Entries become integers ``floor(64 c) + 1000000``. With n rows, sums S and second moments G the matrix
``M = n G - S S'`` holds integers only and is n^2 times the covariance. All steps up to the last are exact
or carry far more digits than a double:

* **Moments** are summed exactly where rows are read: numbers are cut into limbs of 20 bits, so that
  products of a batch are exact in doubles, and partial sums travel as long digits with their place.
* **Polynomial.** Modulo each of enough 31 bit primes, M is reduced to Hessenberg form and its
  characteristic polynomial read off; primes are rows of a DataFrame. Chinese remaindering gives the
  integer coefficients; the eigenvalues are not negative, so the trace bounds the coefficients.
* **Roots.** All roots are real, so the sign changes of the polynomial shifted to ``a`` count the roots above
  ``a`` exactly (Descartes). Bisection isolates them from the largest down and stops at 2^-128 of the trace;
  roots that are still together there count as one of higher multiplicity.
* **Components.** ``M - root`` is eliminated in integers of 192 bits with complete pivoting. The pivots left
  over belong to the null space; one step of inverse iteration with starts in just those rows gives its
  basis. Each root is a row of a DataFrame.

The driver holds matrices of the dimension only, never rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.lineage import materialize
from millrace.llm.frames import session_of

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
ROOT_BITS, GUARD_BITS = 128, 64

_LIMB, _DIGIT = 20, 31
_MOST = float(2**62)


# ------------------------------------------------------------------------------------------ entries

def entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Usable rows of a list array, their lengths, and ``floor(64 c)`` of all their entries (the offset is left off).

    A row is left out where it is null or holds a null or non-finite entry. Integers stop at 2^62.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    good = np.concatenate([[0], np.cumsum(np.isfinite(values))])  # a null entry arrives as NaN
    ends = np.cumsum(length)
    usable = (good[ends] - good[ends - length] == length) & column.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * values[np.repeat(usable, length)])
    return np.flatnonzero(usable), length[usable], np.clip(scaled, -_MOST, _MOST).astype(np.int64)


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length that occurs: the rows of that length, and their entries as a matrix."""
    rows, length, values = entries(column)
    starts = np.cumsum(length) - length
    for d in np.unique(length):
        at = np.flatnonzero(length == d)
        yield rows[at], values[starts[at][:, None] + np.arange(d)]


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Limbs of 20 bits, the last one signed, as doubles."""
    top = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    count = top.bit_length() // _LIMB + 1
    mask = (1 << _LIMB) - 1
    low = [(y >> (_LIMB * k)) & mask for k in range(count - 1)]
    return [x.astype(np.float64) for x in [*low, y >> (_LIMB * (count - 1))]]


# ------------------------------------------------------------------------------------------ moments

def _moments(column: str):
    """Partial sums ``(d, i, j, place, value)``: the sum of ``x_i x_j``, with i = -1 of ``x_j``, with both -1 of 1.

    A sum is that of ``value * 2^place`` over its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[np.ndarray]] = {}

        def add(d: int, place: int, table: np.ndarray) -> None:
            whole = table.astype(np.int64)
            held = sums.setdefault((d, place), [np.zeros((d + 1, d + 1), np.int64) for _ in range(2)])
            held[0] += whole & ((1 << _DIGIT) - 1)
            held[1] += whole >> _DIGIT

        for batch in batches:
            for _, y in by_length(batch[column]):
                d = y.shape[1]
                for low in range(0, len(y), 4096):
                    parts = _limbs(y[low: low + 4096])
                    ones = np.ones((len(parts[0]), 1))
                    for a, left in enumerate(parts):
                        for b, right in enumerate(parts):
                            table = np.zeros((d + 1, d + 1))
                            table[1:, 1:] = left.T @ right
                            if a == 0:
                                table[0, 1:] = (ones.T @ right)[0]
                                table[0, 0] = len(ones) if b == 0 else 0
                            add(d, _LIMB * (a + b), table)
        for (d, place), held in sums.items():
            i, j = np.triu_indices(d + 1)
            for k, table in enumerate(held):
                value = table[i, j]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), d)), pa.array(i - 1), pa.array(j - 1),
                     pa.array(np.full(len(i), place + _DIGIT * k)), pa.array(value)], ["d", "i", "j", "place", "value"])

    return run


def moments(rows: DataFrame, column: str = "embedding") -> tuple[int, list[int], np.ndarray]:
    """Number of usable rows, sums per dimension and second moments, all exact, of ``floor(64 c)``.

    Rows of other lengths than the most frequent one (the longer of equally frequent ones) are left out.
    """
    partial = rows.select(column).mapInArrow(_moments(column), "d long, i long, j long, place long, value long")
    # Digits of opposite limbs land in (i, j) and (j, i); only the upper half travels, which the sum over a, b fills.
    sums = materialize(partial.groupBy("d", "i", "j", "place").agg(F.sum("value").alias("value")), "moments")
    best = sums.where("i = -1 and j = -1 and d > 0").groupBy("d").agg(
        F.sum(F.col("value") * F.pow(F.lit(2.0), "place")).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return 0, [], np.zeros((0, 0), object)
    d = best["d"]
    count, total, second = 0, [0] * d, np.zeros((d, d), object)
    for _, i, j, place, value in sums.where(F.col("d") == d).toLocalIterator():
        exact = value << place if value >= 0 else -(-value << place)
        if i >= 0:
            second[i, j] += exact
            if i != j:
                second[j, i] += exact
        elif j >= 0:
            total[j] += exact
        else:
            count += exact
    return count, total, second


# --------------------------------------------------------------------------------------- polynomial

def is_prime(n: int) -> bool:
    """Exact for n below 3 * 10^9 (Miller-Rabin with bases 2, 3, 5 and 7)."""
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        if all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """Primes below 2^31, from the largest down, whose product exceeds ``bound``."""
    found, product, at = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(at):
            found.append(at)
            product *= at
        at -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients, constant first, of the characteristic polynomial modulo a 31 bit prime, by Hessenberg reduction."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(d - 2):
        filled = np.flatnonzero(h[k + 1:, k])
        if not len(filled):
            continue
        pivot = k + 1 + filled[0]
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(axis=1)) % p
    # Polynomials of the leading blocks; the subdiagonal product links column k with each earlier block.
    blocks = np.zeros((d + 1, d + 1), np.int64)
    blocks[0, 0] = 1
    for k in range(1, d + 1):
        blocks[k, 1:] = blocks[k - 1, :-1]
        link, factors = 1, np.zeros(k, np.int64)
        for i in range(k, 0, -1):
            factors[i - 1] = int(h[i - 1, k - 1]) * link % p
            link = link * int(h[i - 1, i - 2]) % p if i > 1 else 0
        blocks[k] = (blocks[k] - (factors[:, None] * blocks[:k] % p).sum(axis=0)) % p
    return blocks[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Exact coefficients, constant first, of a symmetric integer matrix without negative eigenvalues."""
    d, trace = len(matrix), sum(int(matrix[i, i]) for i in range(len(matrix)))
    primes = primes_above(2 * max(trace, 1) ** d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_modulo(matrix, p).tolist() for p in batch["p"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["p"], pa.array(found, pa.list_(pa.int64()))], ["p", "c"])

    table = spark.createDataFrame([(p,) for p in primes], "p long").repartition(max(1, len(primes) // 8), "p")
    value, product = [0] * (d + 1), 1
    for p, residues in sorted(table.mapInArrow(run, "p long, c array<long>").collect()):
        inverse = pow(product % p, -1, p)
        value = [x + product * ((r - x) * inverse % p) for x, r in zip(value, residues)]
        product *= p
    return [x - product if 2 * x > product else x for x in value]


# -------------------------------------------------------------------------------------------- roots

def roots_above(poly: list[int], at: int) -> int:
    """Number of roots greater than ``at``, with multiplicity, of a polynomial with real roots only."""
    shifted = poly[:]
    for low in range(len(poly) - 1):
        for k in range(len(poly) - 2, low - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def isolate(poly: list[int], top: int, wanted: int) -> list[tuple[int, int, int, int]]:
    """``(low, high, above, number)`` of the largest roots: intervals ``(low, high]`` of one root, or of width one.

    ``above`` roots are greater than ``high``. Roots of zero and below are not looked for.
    """
    found, open_ = [], [(0, top, 0, roots_above(poly, 0))]
    while open_ and sum(x[3] for x in found) < wanted:
        low, high, above, upto = open_.pop()
        if upto == above:
            continue
        if upto - above == 1 or high - low == 1:
            found.append((low, high, above, upto - above))
            continue
        middle = (low + high) // 2
        split = roots_above(poly, middle)
        open_ += [(low, middle, split, upto), (middle, high, above, split)]
    return found


def refine(poly: list[int], low: int, high: int, above: int) -> int:
    """The end of the unit interval ``(high - 1, high]`` that holds the one root of ``(low, high]``."""
    below = 1 if above % 2 else -1  # sign left of the root
    while high - low > 1:
        middle = (low + high) // 2
        value = 0
        for c in reversed(poly):
            value = value * middle + c
        low, high = (middle, high) if value and (value > 0) == (below > 0) else (low, middle)
    return high


# --------------------------------------------------------------------------------------- components

def null_space(matrix: np.ndarray, number: int) -> np.ndarray:
    """``number`` orthonormal rows nearest to the null space of a square matrix of big integers.

    Complete pivoting leaves the smallest pivots for the end. Inverse iteration from starts that lie in
    the rows of those pivots needs the back substitution alone.
    """
    a = matrix.copy()
    d = len(a)
    bits = max(int(abs(x)).bit_length() for x in a.ravel())
    order = np.arange(d)
    for k in range(d - number):
        size = np.abs(a[k:, k:])
        i, j = divmod(int(size.argmax()), d - k)
        if not size[i, j]:
            break
        a[[k, k + i]] = a[[k + i, k]]
        a[:, [k, k + j]] = a[:, [k + j, k]]
        order[[k, k + j]] = order[[k + j, k]]
        factor = (a[k + 1:, k] << bits) // a[k, k]
        a[k + 1:, k + 1:] -= (factor[:, None] * a[k, k + 1:]) >> bits
        a[k + 1:, k] = 0
    basis = np.zeros((number, d), object)
    for n in range(number):
        v = np.zeros(d, object)
        v[d - number + n] = 1 << bits
        for k in range(d - number - 1, -1, -1):
            v[k] = -int((a[k, k + 1:] * v[k + 1:]).sum()) // int(a[k, k]) if a[k, k] else 0
        most = max(int(abs(x)) for x in v)
        basis[n, order] = [int(x) / most for x in v]
    rows = np.linalg.qr(basis.astype(np.float64).T)[0].T
    if number == 1:
        rows = basis.astype(np.float64) / math.sqrt(math.fsum(float(x) ** 2 for x in basis[0]))
    lead = rows[np.arange(number), np.abs(rows).argmax(axis=1)]
    return rows * np.where(lead < 0, -1.0, 1.0)[:, None]


@dataclass
class Whitening:
    """n rows, sums of ``floor(64 c)``, unit components as rows, their variances and their shares of all variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    variances: np.ndarray
    explained: np.ndarray


def fit(rows: DataFrame, column: str = "embedding", *, components: int = COMPONENTS) -> Whitening:
    """The leading components of all usable vectors of ``rows``.

    Components without variance are not returned, so there are fewer where the vectors span less, and
    none for a table without rows, a single vector or equal vectors.
    """
    spark = session_of(rows)
    n, sums, second = moments(rows, column)
    d = len(sums)
    scatter = np.array([[n * second[i, j] - sums[i] * sums[j] for j in range(d)] for i in range(d)], object).reshape(d, d)
    trace = sum(int(scatter[i, i]) for i in range(d))
    if not trace:
        return Whitening(n, sums, np.zeros((0, d)), np.zeros(0), np.zeros(0))
    # In units of 2^-shift the trace has ROOT_BITS bits at least, so roots of the whole range fit in integers.
    shift = max(0, ROOT_BITS - trace.bit_length())
    poly = [c << (shift * (d - k)) for k, c in enumerate(characteristic_polynomial(spark, scatter))]
    spans = isolate(poly, (trace << shift) + 1, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, spaces = [], []
            for k in batch["span"].to_pylist():
                low, high, above, number = spans[k]
                root = refine(poly, low, high, above) if number == 1 else high
                shifted = scatter * (1 << (shift + GUARD_BITS))
                shifted[np.arange(d), np.arange(d)] -= root << GUARD_BITS
                roots.append(str(root))
                spaces.append(null_space(shifted, number).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [batch["span"], pa.array(roots), pa.array(spaces, pa.list_(pa.float64()))], ["span", "root", "space"])

    table = spark.createDataFrame([(k,) for k in range(len(spans))], "span long").repartition(max(1, len(spans)), "span")
    vectors, variances, explained = [], [], []
    for _, root, space in sorted(table.mapInArrow(run, "span long, root string, space array<double>").collect()):
        for vector in np.array(space).reshape(-1, d):
            vectors.append(vector)
            variances.append(int(root) / (n * n << shift))
            explained.append(int(root) / (trace << shift))
    cut = slice(0, components)
    return Whitening(n, sums, np.array(vectors[cut]).reshape(-1, d), np.array(variances[cut]), np.array(explained[cut]))


def _centred(model: Whitening, y: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    """``x - S / n`` as doubles, and the exact sums of ``(n x - S)^2``, null where they exceed a long."""
    d, most = len(model.sums), max(int(y.max(initial=0)), -int(y.min(initial=0)))
    reach = model.n * most + max((abs(s) for s in model.sums), default=0)
    if d * reach * reach < 2**63:
        z = model.n * y - np.array(model.sums, np.int64)
        return z / model.n, (z * z).sum(axis=1).tolist()
    z = model.n * y.astype(object) - np.array(model.sums, object)
    squares = [int(x) for x in (z * z).sum(axis=1)]
    # Divided as integers first, so that huge numbers keep their digits.
    whole, rest = z // model.n, z % model.n
    return whole.astype(np.float64) + rest.astype(np.float64) / model.n, [s if s < 2**63 else None for s in squares]


def _project(model: Whitening, y: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
    centred, deviation = _centred(model, y)
    return centred @ (model.vectors / np.sqrt(model.variances)[:, None]).T, deviation


def identity_error(rows: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """Largest entry of the whitened covariance minus the identity, measured on all rows; 0 without components."""
    k, d = len(model.variances), len(model.sums)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            for _, y in by_length(batch[column]):
                if y.shape[1] == d:
                    w = _project(model, y)[0]
                    total += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "value"])

    # Vectors are centred by the exact mean before they are multiplied, so their whitened mean is zero.
    sums = rows.select(column).mapInArrow(run, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    return max(abs(r["value"] / model.n - (r["i"] == r["j"])) for r in sums.collect())


def whiten(rows: DataFrame, model: Whitening, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` per usable row and component.

    ``deviation`` is the exact sum of ``(n x - S)^2``, null where it exceeds a long. Rows whose vector is null
    or empty, holds a null or non-finite entry, or has another length than most are left out. Null and
    repeated keys and repeated rows each give their rows; other columns are not read; an empty table, or
    vectors without variance, give none.
    """
    session_of(rows)
    error, d, k = identity_error(rows, model, column), len(model.sums), len(model.variances)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, y in by_length(batch[column]):
                if y.shape[1] != d or not k:
                    continue
                whitened, deviation = _project(model, y)
                yield pa.RecordBatch.from_arrays([
                    batch[key].take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))), pa.array(whitened.ravel()),
                    pa.array(np.tile(model.explained, len(at)))], [key, "component", "deviation", "whitened", "explained"])

    found = rows.select(key, column).mapInArrow(
        run, f"`{key}` {kind}, component int, deviation long, whitened double, explained double")
    return found.select(key, "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
                        F.lit(error).alias("identity_error"))
