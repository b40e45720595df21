"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter ``n * sum(x x') - sum(x) sum(x)'`` is an integer matrix that
is summed without any rounding: tasks multiply digits that a double holds exactly, and Spark
adds their parts up. Then

* its characteristic polynomial is found modulo many primes, by tasks, each reducing the
  matrix to Hessenberg form, and put together by the Chinese remainder theorem;
* all its roots are real, so the changes of sign of the shifted polynomial count exactly the
  roots above a number: roots are isolated by bisection and refined to ``PRECISE`` bits;
* components are null vectors of the matrix less a root, by inverse iteration in ``DIGITS`` decimal
  digits, by tasks. Roots that agree to all those bits share a space, of which a basis is given.

The driver holds the square matrix, the polynomial and the components, none of which grows with the rows.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Bits that roots are refined to, decimal digits of inverse iteration and its rounds.
PRECISE, DIGITS, ROUNDS = 110, 90, 4
#: Rows multiplied at once, and bits of a digit: products of two digits summed over the rows fit a double.
ROWS, DIGIT = 4096, 20
#: Numbers of the matrices that are reduced at once in a task.
AT_ONCE = 1 << 20


@dataclass
class Whitening:
    """Sums over ``n`` integer vectors, and unit components by falling eigenvalue of their covariance."""

    n: int
    sums: list[int]
    values: list[float]
    vectors: np.ndarray  # a column for each component
    explained: list[float]
    identity_error: float = math.nan


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)``: vectors as doubles, without null or unfit entries, of the commonest length.

    An entry is fit if it is finite and its integer fits a long. Of lengths equally common the
    larger counts; empty vectors never do.
    """
    v = F.col(vector_col).cast("array<double>")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 52)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(fit & (F.size(v) > 0))
    common = rows.groupBy(F.size("v").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.where(F.size("v") == (common.size if common else 0))


def integers(column: pa.Array, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    """A row of longs for each vector."""
    if not len(column):
        return np.zeros((0, 0), dtype=np.int64)
    entries = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return np.floor(scale * entries).astype(np.int64) + shift


def product(rows: np.ndarray) -> np.ndarray:
    """``rows' rows`` of longs as exact Python integers, by digits that doubles multiply exactly."""
    total = np.zeros((rows.shape[1], rows.shape[1]), dtype=object)
    for start in range(0, len(rows), ROWS):
        left, digits = rows[start:start + ROWS], []
        while True:
            last = not left.size or (left.min() >= -(1 << DIGIT) and left.max() < 1 << DIGIT)
            digits.append((left if last else left & ((1 << DIGIT) - 1)).astype(np.float64))
            if last:
                break
            left = left >> DIGIT
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                total += (a.T @ b).astype(np.int64).astype(object) << DIGIT * (i + j)
    return total


def scatter(rows: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> tuple[int, list[int], np.ndarray]:
    """How many ``rows(v)``, the sums of their integers and the integer scatter, all exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, None, None
        for batch in batches:
            x = integers(batch.column(0), scale, 0)  # the scatter is the same without the shift
            if len(x):
                own = x.astype(object).sum(axis=0) if np.abs(x).max() > 1 << 40 else x.sum(axis=0).astype(object)
                squares = product(x) if squares is None else squares + product(x)
                sums, n = own if sums is None else sums + own, n + len(x)
        if not n:
            return
        upper = np.triu_indices(len(sums))
        cells, places, values = [], [], []
        for cell, number in enumerate([n, *sums, *squares[upper]]):
            sign, number, place = (-1 if number < 0 else 1), abs(int(number)), 0
            while number:
                cells.append(cell)
                places.append(place)
                values.append(sign * (number & 0xFFFFFFFF))
                number >>= 32
                place += 1
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(places, pa.int32()), pa.array(values, pa.int64())], ["cell", "place", "value"])

    parts = rows.select("v").mapInArrow(run, "cell int, place int, value long").groupBy("cell", "place").agg(F.sum("value").alias("value"))
    numbers: dict[int, int] = {}
    for r in parts.toLocalIterator():  # a row or a few for each cell of the matrix
        numbers[r.cell] = numbers.get(r.cell, 0) + (r.value << 32 * r.place)
    n = numbers.get(0, 0)
    if not n:
        return 0, [], np.zeros((0, 0), dtype=object)
    first = rows.select(F.size("v").alias("size")).first().size
    sums = [numbers.get(1 + i, 0) for i in range(first)]
    matrix = np.zeros((first, first), dtype=object)
    for k, (i, j) in enumerate(zip(*np.triu_indices(first))):
        matrix[i, j] = matrix[j, i] = n * numbers.get(1 + first + k, 0) - sums[i] * sums[j]
    return n, [s + n * shift for s in sums], matrix


def primes(product_above: int) -> list[int]:
    """The largest primes below 2**31, enough for their product."""
    small = [p for p in range(3, 1 << 8, 2) if all(p % q for q in range(3, math.isqrt(p) + 1, 2))]

    def prime(x: int) -> bool:
        if any(x % p == 0 for p in small):
            return False
        odd, twos = x - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        return all(  # these bases decide all numbers of 32 bits
            (y := pow(base, odd, x)) in (1, x - 1) or any((y := y * y % x) == x - 1 for _ in range(twos - 1)) for base in (2, 3, 5, 7))

    found, total, x = [], 1, (1 << 31) - 1
    while total <= product_above:
        if prime(x):
            found.append(x)
            total *= x
        x -= 2
    return found


def residues(matrix: np.ndarray, moduli: list[int]) -> np.ndarray:
    """Coefficients of the characteristic polynomial from degree 0 on, a row for each prime."""
    size, p = len(matrix), np.array(moduli, dtype=np.int64)
    h = np.stack([(matrix % m).astype(np.int64) for m in moduli])
    one, two, three = p, p[:, None], p[:, None, None]
    inverse = lambda xs: np.array([pow(int(x), -1, m) if x else 0 for x, m in zip(xs, moduli)], dtype=np.int64)
    for m in range(1, size - 1):
        pivot = (h[:, m:, m - 1] != 0).argmax(axis=1) + m
        for k in np.flatnonzero(pivot != m):
            h[k, [m, pivot[k]]] = h[k, [pivot[k], m]]
            h[k][:, [m, pivot[k]]] = h[k][:, [pivot[k], m]]
        u = h[:, m + 1:, m - 1] * inverse(h[:, m, m - 1])[:, None] % two
        h[:, m + 1:, :] = (h[:, m + 1:, :] - u[:, :, None] * h[:, m:m + 1, :] % three) % three
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * u[:, None, :] % three).sum(axis=2)) % two
    found = [np.ones((len(p), 1), dtype=np.int64)]
    for k in range(size):
        own = np.zeros((len(p), k + 2), dtype=np.int64)
        own[:, 1:] = found[k]
        own[:, :-1] -= h[:, k, k][:, None] * found[k] % two
        chain = np.ones(len(p), dtype=np.int64)
        for i in range(1, k + 1):
            chain = chain * h[:, k - i + 1, k - i] % one
            own[:, :k - i + 1] -= (h[:, k - i, k] * chain % one)[:, None] * found[k - i] % two
        found.append(own % two)
    return found[size]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """The polynomial of an integer matrix without negative eigenvalues, coefficients from degree 0 on."""
    size = len(matrix)
    # every coefficient is a sum of products of eigenvalues, so (1 + mean eigenvalue) ** size bounds it
    moduli = primes(2 * (2 + int(matrix.trace()) // size) ** size)
    at_once = max(1, AT_ONCE // size**2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_pylist()
            for start in range(0, len(own), at_once):
                part = own[start:start + at_once]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array(residues(matrix, part).tolist(), pa.list_(pa.int64()))], ["p", "c"])

    tasks = min(len(moduli), max(1, spark.sparkContext.defaultParallelism))  # the answer is the same for any
    found = spark.createDataFrame([(p,) for p in moduli], "p long").repartition(tasks).mapInArrow(run, "p long, c array<long>").collect()
    whole = math.prod(moduli)
    terms = [(r.c, whole // r.p * pow(whole // r.p % r.p, -1, r.p)) for r in found]
    out = []
    for k in range(size + 1):
        x = sum(c[k] * term for c, term in terms) % whole
        out.append(x - whole if 2 * x > whole else x)
    return out


def above(poly: list[int], at: int) -> int:
    """How many roots of a polynomial of real roots only are larger than ``at``, by their multiplicity."""
    own = poly[:]
    for k in range(len(own) - 1):  # the polynomial of x + at
        for i in range(len(own) - 2, k - 1, -1):
            own[i] += at * own[i + 1]
    signs = [c > 0 for c in own if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], count: int) -> list[tuple[Fraction, int]]:
    """The largest positive roots, falling, with how many of the ``count`` asked for agree in each."""
    zeros = next(k for k, c in enumerate(poly) if c)
    own, bits = poly[zeros:], PRECISE
    degree = len(own) - 1
    count = min(count, degree)

    def apart(scaled: list[int], known: dict[int, int], i: int) -> tuple[int, int]:
        """Neighbouring numbers with the i-th root alone between them, or else one apart."""
        low = max(y for y, c in known.items() if c >= i)
        high = min(y for y, c in known.items() if c < i)
        while high - low > 1 and not (known[low] == i and known[high] == i - 1):
            mid = (low + high) // 2
            known[mid] = above(scaled, mid)
            low, high = (mid, high) if known[mid] >= i else (low, mid)
        return low, high

    whole = {0: degree, 1 - own[-2]: 0}  # no root is above the sum of all
    for i in range(1, count + 1):
        apart(own, whole, i)  # most are told apart by whole numbers, which are shorter
    while count:
        scaled = [c << bits * (degree - k) for k, c in enumerate(own)]
        found: list[tuple[int, int]] = []
        known = {y << bits: c for y, c in whole.items()}
        while sum(m for _, m in found) < count:
            i = sum(m for _, m in found) + 1
            low, high = apart(scaled, known, i)
            alike = known[low] - known[high] if high - low == 1 else 1
            while high - low > 1:  # one root is left: the sign tells on which side it is
                mid, value = (low + high) // 2, 0
                for c in reversed(scaled):
                    value = value * mid + c
                low, high = (mid, high) if value and (value > 0) == (i % 2 == 0) else (low, mid)
            found.append((low, alike))
        if found[-1][0].bit_length() >= PRECISE:
            return [(Fraction(2 * y + 1, 2 << bits), m) for y, m in found]
        bits *= 2
    return []


def null_vectors(matrix: np.ndarray, root: Fraction, count: int) -> np.ndarray:
    """Unit vectors, a column each, of the matrix's ``count`` eigenvalues next to ``root``."""
    size = len(matrix)
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        shifted = np.array([[decimal.Decimal(int(x)) for x in row] for row in matrix], dtype=object)
        value = decimal.Decimal(root.numerator) / decimal.Decimal(root.denominator)
        for i in range(size):
            shifted[i, i] -= value
        order = np.arange(size)
        tiny = value.scaleb(-DIGITS)
        for k in range(size):
            best = k + max(range(size - k), key=lambda i: abs(shifted[k + i, k]))
            if best != k:
                shifted[[k, best]], order[[k, best]] = shifted[[best, k]], order[[best, k]]
            if not shifted[k, k]:
                shifted[k, k] = tiny
            if k + 1 < size:
                shifted[k + 1:, k] = shifted[k + 1:, k] / shifted[k, k]
                shifted[k + 1:, k + 1:] -= np.outer(shifted[k + 1:, k], shifted[k, k + 1:])
        own = np.array([[decimal.Decimal(int(x)) for x in row] for row in np.random.default_rng(1).integers(-999, 999, (size, count))], dtype=object)
        for _ in range(ROUNDS):
            own = own[order]
            for k in range(size):
                own[k + 1:] -= np.outer(shifted[k + 1:, k], own[k])
            for k in reversed(range(size)):
                own[k] = (own[k] - (shifted[k, k + 1:, None] * own[k + 1:]).sum(axis=0)) / shifted[k, k]
            for j in range(count):
                for _ in range(2):
                    for i in range(j):
                        own[:, j] -= own[:, i] * (own[:, i] * own[:, j]).sum()
                own[:, j] /= (own[:, j] * own[:, j]).sum().sqrt()
        return own.astype(np.float64)


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of ``rows(vec_id, v)`` (see ``usable``); None if no direction has any variance."""
    spark = rows.sparkSession
    n, sums, matrix = scatter(rows, scale, shift)
    if not n or not matrix.trace():
        return None
    common = math.gcd(*(int(x) for x in matrix.ravel()))
    small = matrix // common
    roots = largest_roots(characteristic(spark, small), components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, top, bottom, count in zip(*(c.to_pylist() for c in batch.columns)):
                found = null_vectors(small, Fraction(int(top), int(bottom)), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at], pa.int32()), pa.array([found.T.ravel().tolist()], pa.list_(pa.float64()))], ["at", "v"])

    asked = [(i, str(r.numerator), str(r.denominator), m) for i, (r, m) in enumerate(roots)]
    tasks = spark.createDataFrame(asked, "at int, top string, bottom string, count int").repartition(len(asked))
    found = sorted(tasks.mapInArrow(run, "at int, v array<double>").collect())
    vectors = np.concatenate([np.array(r.v).reshape(-1, len(small)) for r in found])[:components].T
    each = [r for r, m in roots for _ in range(m)][:components]
    model = Whitening(
        n, sums, [float(r * common / n**2) for r in each], np.ascontiguousarray(vectors),
        [float(r / int(small.trace())) for r in each])
    model.identity_error = identity_error(rows, model, scale, shift)
    return model


def centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``n * x - S`` as exact integers: longs where they fit, else Python's."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * model.n + max(map(abs, model.sums))
    if most < 1 << 62:
        return x * model.n - np.array(model.sums, dtype=np.int64)
    return x.astype(object) * model.n - np.array(model.sums, dtype=object)


def projected(away: np.ndarray, model: Whitening) -> np.ndarray:
    return (away / model.n).astype(np.float64) @ model.vectors / np.sqrt(model.values)


def identity_error(rows: DataFrame, model: Whitening, scale: int = SCALE, shift: int = SHIFT) -> float:
    """The largest absolute entry of the covariance of all whitened rows less the identity."""
    size = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size))
        for batch in batches:
            if batch.num_rows:
                own = projected(centred(integers(batch.column(0), scale, shift), model), model)
                total[0] += own.sum(axis=0)
                total[1:] += own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])

    parts = rows.select("v").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((size + 1) * size)
    for r in parts:  # a row for each cell
        total[r.cell] = r.value / model.n
    mean, squares = total[:size], total[size:].reshape(size, size)
    return float(np.abs(squares - np.outer(mean, mean) - np.eye(size)).max())


def whitened(
    vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact)``.

    A row for each usable row (see ``usable``; a null id is kept) and component of positive
    variance, at most ``components``. Equal vectors and equal ids stay rows of their own. Vectors
    of a length that is not the commonest take no part. ``deviation`` is null where it does not fit a
    long; ``deviation_exact`` has it as decimal text always. Without any variance (no row, one row,
    equal rows) there is nothing to scale to one: the result is empty. Other columns are not read.
    """
    rows = usable(vectors, id_col, vector_col)
    model = fit(rows, components, scale, shift)
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double, deviation_exact string")
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = centred(integers(batch.column(1), scale, shift), model)
            if away.dtype != object and int(np.abs(away).max()) ** 2 * away.shape[1] >= 1 << 63:
                exact = (away.astype(object) ** 2).sum(axis=1)
            else:
                exact = (away**2).sum(axis=1)
            fitting = [int(d) if int(d) < 1 << 63 else None for d in exact]
            of = pa.array(np.repeat(np.arange(batch.num_rows), size))
            count = batch.num_rows * size
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(of), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), batch.num_rows)),
                pa.array(np.full(count, model.n, dtype=np.int64)), pa.array(fitting, pa.int64()).take(of),
                pa.array(projected(away, model).ravel()), pa.array(np.tile(model.explained, batch.num_rows)),
                pa.array(np.full(count, model.identity_error)), pa.array([str(int(d)) for d in exact]).take(of),
            ], [field.split()[0] for field in schema.split(", ")])

    return rows.mapInArrow(run, schema)
