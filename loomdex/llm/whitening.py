"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

1. Each entry c becomes the integer floor(256 c). Every different vector counts once; tasks add up their exact products
   and sums, and rows of the matrix are added up across tasks. M = n sum(x x') - S S' is n^2 times the covariance, in integers.
2. The characteristic polynomial of M is found modulo many 31-bit primes, each a row of a Spark job: the matrix goes to
   Hessenberg form, whose polynomial follows by recurrence. Chinese remaindering joins the residues. Enough primes are taken
   to exceed the largest value that a coefficient can have: by Maclaurin, C(d, k) (trace / d)^k.
3. M is symmetric, so all roots are real and the sign changes of the shifted polynomial are exactly the number of roots
   above the shift. Bisection on that count isolates the largest roots; the sign of the polynomial then refines a root that is
   alone. Roots get ``BITS`` correct bits. The multiplicity of the root zero is read off the polynomial.
4. Components are null vectors of M - root, by inverse iteration in fixed-point arithmetic of ``BITS`` bits, orthogonal to
   those before. Equal eigenvalues get an orthonormal basis of their space.
5. Each row is centred and projected. The covariance of the result is measured over the different vectors in one more pass.

What the driver holds is of the size of the matrix, which depends on the dimension only. Vectors that are null or empty,
hold null or non-finite entries, or entries beyond 2^62 / 256, are left out, as are those of another length than most rows
have (ties: the longer). Of a component without variance the whitened value is null; where there is no variance at all,
``explained`` and ``identity_error`` are null. Null ids and repeated rows stay; other columns are ignored; no vectors, no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from decimal import Decimal
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomdex.llm.common import keep, per_task, ranges

SCALE = 256
TOP = 4
BITS = 220
PACKED = "vec_id long, size int, x binary"
WHITE = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
_DECIMAL = pa.decimal128(38, 0)


def _packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Integer vectors as bytes, in the least width that holds all entries, so equal vectors are equal bytes."""
    batch = batch.filter(pc.and_(pc.is_valid(batch.column("vector")), pc.greater(pc.fill_null(pc.list_value_length(batch.column("vector")), 0), 0)))
    if not batch.num_rows:
        return
    vectors = batch.column("vector")
    size = pc.list_value_length(vectors).to_numpy().astype(np.int64)
    start = np.cumsum(size) - size
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    most = np.maximum.reduceat(np.where(np.isfinite(x), np.abs(x), np.inf), start)
    for width, low, high in ((2, -1, 2**15 - 1), (4, 2**15 - 1, 2**31 - 1), (8, 2**31 - 1, 2**62)):
        rows = np.flatnonzero((most > low) & (most <= high))
        if len(rows):
            data = x[ranges(start[rows], size[rows])].astype(np.int64).astype(f"<i{width}")
            offsets = np.r_[0, np.cumsum(size[rows] * width)].astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(rows)), pa.array(size[rows].astype(np.int32)), packed], names=["vec_id", "size", "x"])


def integer_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Rows (vec_id, size, x) of all usable vectors; x is the packed integer vector."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("vector"))
    return rows.mapInArrow(per_task(lambda: _packed), PACKED)


def _matrices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their vectors as integers, by width."""
    x = batch.column("x")
    width = pc.binary_length(x).to_numpy() // size
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        data = b"".join(x.take(pa.array(rows)).to_pylist())
        yield rows, np.frombuffer(data, f"<i{w}").reshape(len(rows), size).astype(np.int64)


def _products(x: np.ndarray) -> np.ndarray:
    """x'x without rounding: by floating point where all sums stay below 2^53, else by Python's integers."""
    most = int(np.abs(x).max())
    rows = 2**53 // max(most * most, 1)
    if rows < 1:
        return x.T.astype(object) @ x.astype(object)
    total = np.zeros((x.shape[1],) * 2, object)
    for low in range(0, len(x), rows):
        part = x[low : low + rows].astype(np.float64)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _numbers(values) -> str:
    return " ".join(map(str, values))


def _scatter(size: int):
    """Of a task's vectors: row i of the sum of x x', its sum of x, and how many there are."""

    def run(batches):
        total, sums, n = np.zeros((size, size), object), np.zeros(size, object), 0
        for batch in batches:
            for rows, x in _matrices(batch, size) if batch.num_rows else ():
                total, n = total + _products(x), n + len(rows)
                sums = sums + x.astype(object).sum(axis=0) if np.abs(x).max() > 2**40 else sums + x.sum(axis=0).astype(object)
        if n:
            rows = [_numbers([n, sums[i], *total[i]]) for i in range(size)]
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(rows)], names=["i", "numbers"])

    return run


def _add(batches):
    sums: dict[int, list[int]] = {}
    for batch in batches:
        for i, numbers in zip(*(c.to_pylist() for c in batch.columns)):
            new = [int(v) for v in numbers.split()]
            sums[i] = [a + b for a, b in zip(sums[i], new)] if i in sums else new
    if sums:
        rows = pa.array([_numbers(v) for v in sums.values()])
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), rows], names=["i", "numbers"])


def scatter(different: DataFrame, size: int) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S and n sum(x x') - S S' of vectors (x); as many numbers as the matrix has."""
    schema = "i int, numbers string"
    parts = different.select("x").mapInArrow(_scatter(size), schema).repartition(min(size, 64), "i").mapInArrow(_add, schema)
    rows = {r.i: [int(v) for v in r.numbers.split()] for r in parts.collect()}
    if not rows:
        return 0, [0] * size, [[0] * size for _ in range(size)]
    n, sums = rows[0][0], [rows[i][1] for i in range(size)]
    return n, sums, [[n * v - sums[i] * sums[j] for j, v in enumerate(rows[i][2:])] for i in range(size)]


def primes() -> Iterator[int]:
    """Primes below 2^31, falling. Miller-Rabin to these bases is certain up to 3 x 10^9."""
    for p in range(2**31 - 1, 2, -2):
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        if all(_passes(p, base, odd, twos) for base in (2, 3, 5, 7)):
            yield p


def _passes(p: int, base: int, odd: int, twos: int) -> bool:
    x = pow(base, odd, p)
    if x in (1, p - 1):
        return True
    for _ in range(twos - 1):
        x = x * x % p
        if x == p - 1:
            return True
    return False


def polynomial_modulo(matrix: list[list[int]], p: int) -> np.ndarray:
    """Coefficients, from x^0 up, of det(x - matrix) modulo p < 2^31."""
    a = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(a)
    for j in range(d - 2):
        below = np.flatnonzero(a[j + 1 :, j])
        if not len(below):
            continue
        pivot = j + 1 + int(below[0])
        if pivot != j + 1:
            a[[pivot, j + 1]] = a[[j + 1, pivot]]
            a[:, [pivot, j + 1]] = a[:, [j + 1, pivot]]
        factor = a[j + 2 :, j] * pow(int(a[j + 1, j]), -1, p) % p
        a[j + 2 :] = (a[j + 2 :] - factor[:, None] * a[j + 1] % p) % p
        a[:, j + 1] = (a[:, j + 1] + (a[:, j + 2 :] * factor % p).sum(axis=1)) % p
    found = np.zeros((d + 1, d + 1), np.int64)  # of the leading blocks
    found[0, 0] = 1
    for k in range(1, d + 1):
        found[k, 1:] = found[k - 1, :-1]
        found[k] = (found[k] - int(a[k - 1, k - 1]) * found[k - 1] % p) % p
        product = 1
        for i in range(1, k):
            product = product * int(a[k - i, k - i - 1]) % p
            if not product:
                break
            found[k] = (found[k] - int(a[k - 1 - i, k - 1]) * product % p * found[k - 1 - i] % p) % p
    return found[d]


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, from x^0 up, of the characteristic polynomial of a positive semidefinite integer matrix."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    limit = 2 * max(math.comb(d, k) * trace**k // d**k + 1 for k in range(d + 1))
    chosen, product = [], 1
    source = primes()
    while product <= limit:
        chosen.append(next(source))
        product *= chosen[-1]
    sent = spark.sparkContext.broadcast((matrix, chosen))  # as large as the matrix

    def residues(batches):
        m, ps = sent.value
        for batch in batches:
            for k in batch.column("id").to_pylist():
                found = pa.array([polynomial_modulo(m, ps[k]).tolist()], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), found], names=["id", "residues"])

    tasks = min(len(chosen), 4 * spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(chosen), 1, tasks).mapInArrow(residues, "id long, residues array<long>").collect()
    out = [0] * (d + 1)
    for row in rows:
        rest = product // chosen[row.id]
        unit = rest * pow(rest % chosen[row.id], -1, chosen[row.id])
        out = [a + r * unit for a, r in zip(out, row.residues)]
    out = [v % product for v in out]
    return [v - product if 2 * v > product else v for v in out]


class RealRoots:
    """The positive roots of a polynomial all of whose roots are real and not negative, largest first."""

    def __init__(self, coefficients: list[int]):
        zeros = next(i for i, c in enumerate(coefficients) if c)
        self.c = coefficients[zeros:]
        self.count = len(self.c) - 1
        total = -self.c[-2] if self.count else 0  # the sum of all roots bounds each
        self.top = total.bit_length() + 1
        self._known: dict[tuple[int, int], int] = {}

    def above(self, place: int, shift: int) -> int:
        """How many roots are larger than place / 2^shift: sign changes of the polynomial shifted by it."""
        while shift and place % 2 == 0:
            place, shift = place // 2, shift - 1
        if (place, shift) not in self._known:
            c = [v << (shift * (self.count - i)) for i, v in enumerate(self.c)]
            for i in range(self.count):
                for j in range(self.count - 1, i - 1, -1):
                    c[j] += place * c[j + 1]
            signs = [v > 0 for v in c if v]
            self._known[place, shift] = sum(a != b for a, b in zip(signs, signs[1:]))
        return self._known[place, shift]

    def value(self, place: int, shift: int) -> int:
        """A number with the polynomial's sign at place / 2^shift."""
        out = 0
        for i in range(self.count, -1, -1):
            out = out * place + (self.c[i] << (shift * (self.count - i)))
        return out

    def root(self, rank: int, bits: int = BITS) -> tuple[int, int]:
        """The rank-th largest root (from 1) as place / 2^shift, ``bits`` bits correct at least."""
        low, high, shift = 0, 1 << self.top, 0  # low < root <= high
        while (high - low) << bits > high or low == 0:
            if high - low == 1:
                low, high, shift = low * 2, high * 2, shift + 1
            middle = (low + high) // 2
            many, few = self.above(low, shift) if low else self.count, self.above(high, shift)
            if many - few == 1:
                return self._refined(low, high, shift, many, bits)
            if self.above(middle, shift) >= rank:
                low = middle
            else:
                high = middle
        return low + high, shift + 1

    def _refined(self, low: int, high: int, shift: int, many: int, bits: int) -> tuple[int, int]:
        """Between low and high is one root, and ``many`` are above low: the sign tells on which side of a place it is."""
        while (high - low) << bits > high or low == 0:
            if high - low == 1:
                low, high, shift = low * 2, high * 2, shift + 1
            middle = (low + high) // 2
            sign = self.value(middle, shift)
            if sign == 0:
                return middle, shift
            if (sign > 0) == (many % 2 == 0):
                low = middle
            else:
                high = middle
        return low + high, shift + 1


def null_vector(matrix: list[list[int]], place: int, shift: int, before: list[list[int]], bits: int = BITS) -> list[int]:
    """Unit vector (times 2^bits) of the null space of matrix - place / 2^shift, orthogonal to those ``before``."""
    d = len(matrix)
    a = np.array([[v << bits for v in row] for row in matrix], object)
    root = place << (bits - shift) if bits >= shift else place >> (shift - bits)
    for i in range(d):
        a[i, i] -= root
    order = np.arange(d)
    for k in range(d):  # factors below the diagonal, in place
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[[k, pivot]] = order[[pivot, k]]
        a[k, k] = a[k, k] or 1  # the matrix is singular as far as the bits tell
        if k + 1 < d:
            factor = (a[k + 1 :, k] << bits) // a[k, k]
            a[k + 1 :, k] = factor
            a[k + 1 :, k + 1 :] -= np.multiply.outer(factor, a[k, k + 1 :]) >> bits

    def unit(v):
        for old in before:
            old = np.array(old, object)
            v = v - ((int((v * old).sum()) >> bits) * old >> bits)
        length = math.isqrt(int((v * v).sum()))
        return (v << bits) // length if length else v

    x = np.array([(1 << bits) // (2 + (i * 7919 + 104729 * len(before)) % 97) for i in range(d)], object)
    x = unit(x)
    for _ in range(3):
        y = x[order].copy()
        for k in range(1, d):
            y[k] -= int((a[k, :k] * y[:k]).sum()) >> bits
        for k in range(d - 1, -1, -1):
            rest = y[k] - (int((a[k, k + 1 :] * y[k + 1 :]).sum()) >> bits) if k + 1 < d else y[k]
            y[k] = (rest << bits) // a[k, k]
        x = unit(unit(y))
    largest = max(range(d), key=lambda i: abs(x[i]))
    return [int(v) if x[largest] > 0 else -int(v) for v in x]


class Model:
    """What is needed to whiten a row: n, S, eigenvalues of M and components, largest first."""

    def __init__(self, size: int, n: int, sums: list[int], trace: int, roots: list[float], components: np.ndarray, top: int):
        self.size, self.n, self.sums, self.trace, self.roots, self.components, self.top = size, n, sums, trace, roots, components, top

    def explained(self) -> list[float | None]:
        found = [r / self.trace for r in self.roots] if self.trace else []
        return [*found, *[0.0 if self.trace else None] * (self.top - len(found))]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        most = self.n * int(np.abs(x).max()) + max(map(abs, self.sums))
        kind = np.int64 if most < 2**62 else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return centred.astype(np.float64) @ self.components.T / np.sqrt(np.array(self.roots))


def fit(different: DataFrame, size: int, top: int = TOP) -> Model | None:
    """The model of different integer vectors (x) of one size."""
    n, sums, matrix = scatter(different, size)
    if not n:
        return None
    trace = sum(matrix[i][i] for i in range(size))
    roots, vectors = [], []
    if trace:
        divisor = math.gcd(*(v for row in matrix for v in row))
        reduced = [[v // divisor for v in row] for row in matrix]
        solver = RealRoots(characteristic(different.sparkSession, reduced))
        for rank in range(1, min(top, solver.count) + 1):
            place, shift = solver.root(rank)
            vectors.append(null_vector(reduced, place, shift, vectors))
            roots.append(divisor * place / (1 << shift))
    components = np.array([[v / (1 << BITS) for v in c] for c in vectors]).reshape(len(vectors), size)
    return Model(size, n, sums, trace, roots, components, min(top, size))


def identity_error(different: DataFrame, model: Model) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    if not model.roots:
        return None
    k = len(model.roots)

    def sums(batches):
        total, outer = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _matrices(batch, model.size) if batch.num_rows else ():
                white = model.whitened(model.centred(x))
                total, outer = total + white.sum(axis=0), outer + white.T @ white
        values = np.r_[total, outer.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["i", "value"])

    rows = different.select("x").mapInArrow(sums, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    value = np.zeros(k + k * k)
    for r in rows:
        value[r.i] = r.value / model.n
    mean = value[:k]  # of centred values: nothing but rounding
    return float(np.abs(value[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def _decimals(centred: np.ndarray) -> pa.Array:
    if centred.dtype == np.int64 and int(np.abs(centred).max()) ** 2 * centred.shape[1] < 2**62:
        return pa.array((centred * centred).sum(axis=1)).cast(_DECIMAL)
    exact = centred.astype(object)
    return pa.array([Decimal(int(v)) if int(v) < 10**38 else None for v in (exact * exact).sum(axis=1)], _DECIMAL)


def _rows(model: Model, error: float | None) -> Callable:
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def work(batch):
        for rows, x in _matrices(batch, model.size):
            centred = model.centred(x)
            count, k = len(rows), len(model.roots)
            deviation = _decimals(centred)
            white = model.whitened(centred) if k else None
            vec_id = batch.column("vec_id").take(pa.array(rows))
            for c, explained in enumerate(model.explained()):
                yield pa.RecordBatch.from_arrays(
                    [
                        vec_id, pa.array(np.full(count, c + 1, np.int32)), pa.array(np.full(count, model.n, np.int64)), deviation,
                        pa.array(white[:, c]) if c < k else pa.nulls(count, pa.float64()),
                        pa.array([explained] * count, pa.float64()), pa.array([error] * count, pa.float64()),
                    ],
                    names=names,
                )

    return work


def whiten(vectors: DataFrame, top: int = TOP, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """One row per usable vector and component: its exact squared deviation and its whitened value."""
    spark = vectors.sparkSession
    rows = keep(integer_vectors(vectors, id_column, column), "integer-vectors")
    most = rows.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return spark.createDataFrame([], WHITE)
    rows = rows.where(F.col("size") == most["size"]).select("vec_id", "x")
    different = keep(rows.select("x").distinct(), "different-vectors")
    model = fit(different, most["size"], top)
    error = identity_error(different, model)
    return rows.mapInArrow(per_task(lambda: _rows(model, error)), WHITE)
