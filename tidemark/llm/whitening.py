"""Operator 13: whitening of embeddings by principal components that come from an exact characteristic polynomial.

Entries become integers ``x = floor(64 * c) + 1000000``. Tasks add up products of the distinct vectors, exactly, and Spark adds
up the tasks' sums; the driver gets one number per pair of dimensions, however many rows there are. With ``n``
vectors and sums ``S`` the integer matrix ``M = n * sum(x x') - S S'`` is ``n * n`` times the covariance.

Its characteristic polynomial is worked out modulo as many primes as its largest possible coefficient asks for, each by
reduction to Hessenberg form in a task of its own, and put together by the Chinese remainder theorem. All its
roots are real, so the sign changes of the polynomial moved by ``a`` count the roots above ``a`` exactly, multiple
ones with their number: halving intervals isolates the largest roots, and signs alone narrow them until each is known far
better than its distance from the next. Components are null vectors of ``M`` less the root, by inverse iteration in
numbers of several hundred bits, a root in a task of its own. Roots that agree to 160 bits count as one, of which any orthonormal
vectors serve.

A vector that is NULL, or holds a NULL, a NaN, an infinity or an entry of 2**56 or more (its ``x`` is no long), is left out;
vectors of different lengths raise. Components without variance can't be whitened and are left out, so fewer distinct
vectors or constant dimensions give fewer than the components asked for, and one distinct vector, empty vectors or an empty
table no rows. Repeated rows and equal or NULL ids each give their rows. A deviation beyond a long is NULL. Columns of the
input that the caller doesn't ask to carry aren't read. The table has no texts; vectors may be long, but each task holds one number per
pair of dimensions.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import comb, isqrt, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import ready, table
from tidemark.session import written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Entries of this size and beyond have no integer that fits a long.
LARGEST = float(1 << 56)
#: Bits of the digits in which products are added up as doubles, and rows that are added at once: no sum needs more than 53 bits.
DIGIT, ROWS = 20, 4096
#: Bits of the numbers in which components are worked out; agreeing bits from which on two roots count as one; and the bits
#: by which a root's interval must be smaller than the root and than its distance from the next.
BITS, SAME, SURE = 512, 160, 64


def _integers(vector: str) -> Column:
    return F.expr(f"transform(`{vector}`, c -> cast(floor({SCALE} * cast(c AS double)) AS long))")


def _usable(vector: str) -> Column:
    return F.expr(f"`{vector}` IS NOT NULL AND forall(`{vector}`, c -> coalesce(abs(cast(c AS double)) < {LARGEST}D, false))")


def _matrix(column: pa.ListArray) -> np.ndarray:
    """One row per vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


# -- exact sums --------------------------------------------------------------------------------


def _products(y: np.ndarray) -> np.ndarray:
    """The exact sum of ``y_i * y_j`` over at most ``ROWS`` rows, as Python integers."""
    digits, rest = [], y
    while True:
        low = rest & ((1 << DIGIT) - 1)
        if ((rest == low) | (rest == low - (1 << DIGIT))).all():
            digits.append(rest.astype(np.float64))
            break
        digits.append(low.astype(np.float64))
        rest = rest >> DIGIT
    out = 0
    for a, left in enumerate(digits):
        for b, right in enumerate(digits):
            out = out + ((left.T @ right).astype(np.int64).astype(object) << (DIGIT * (a + b)))
    return out


_SUMS = "i int, j int, low long, middle long, high long"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task: its rows at (-1, -1), sums at (i, -1), sums of products at (i, j), each cut into parts of 60 bits."""
    n, total, products = 0, 0, 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            y = _matrix(batch.column("y").slice(at, ROWS))
            n += len(y)
            total = total + ((y >> 32).sum(0).astype(object) << 32) + (y & 0xFFFFFFFF).sum(0).astype(object)
            products = products + _products(y)
    if not n:
        return
    d = len(total)
    i, j = np.triu_indices(d)
    values = np.concatenate([[n], total, products[i, j]])
    part = (1 << 60) - 1
    columns = [values & part, (values >> 60) & part, values >> 120]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([[-1], np.arange(d), i]).astype(np.int32)),
            pa.array(np.concatenate([[-1], np.full(d, -1), j]).astype(np.int32)),
            *(pa.array([int(v) for v in c], pa.int64()) for c in columns),
        ],
        ["i", "j", "low", "middle", "high"],
    )


def exact_sums(points: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """``(n, sums, sums of products)`` over the vectors ``y`` of ``points``; one row per pair of dimensions comes to the driver."""
    parts = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "middle", "high")]
    found = points.select("y").mapInArrow(_sums, _SUMS).groupBy("i", "j").agg(*parts).collect()
    values = {(r.i, r.j): int(r.low) + (int(r.middle) << 60) + (int(r.high) << 120) for r in found}
    n = values.pop((-1, -1), 0)
    d = 1 + max((i for i, _ in values), default=-1)
    return n, [values[i, -1] for i in range(d)], [[values[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]


# -- the characteristic polynomial -------------------------------------------------------------


def _prime(p: int) -> bool:
    """Exact below 3,215,031,751."""
    if any(p % q == 0 for q in (2, 3, 5, 7)):
        return p in (2, 3, 5, 7)
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    return all(pow(b, odd, p) == 1 or any(pow(b, odd << k, p) == p - 1 for k in range(twos)) for b in (2, 3, 5, 7))


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31, from the largest on, whose product is larger than ``bound``."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of ``det(t - matrix)`` modulo a prime below 2**31, that of the highest power first."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        other = k + int(below[0])
        h[[k, other]] = h[[other, k]]
        h[:, [k, other]] = h[:, [other, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(1)) % p
    # Polynomials of the leading parts, each from those before it; the lowest power first.
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        polys[k, 1:] = polys[k - 1, :-1]
        factors, along = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            factors[i] = int(h[i, k - 1]) * along % p
            along = along * int(h[i, i - 1]) % p
        polys[k] = (polys[k] - (factors[:, None] * polys[:k] % p).sum(0)) % p
    return polys[d, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """The exact coefficients for a matrix whose roots are all real and not negative, as those of a covariance are."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # With a given sum, elementary symmetric functions are largest where all roots are equal.
    bound = max(comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1))
    primes = primes_beyond(bound)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                yield pa.RecordBatch.from_pydict({"p": [p], "residues": [polynomial_modulo(matrix, p)]})

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(residues, "p long, residues array<long>").collect()
    product = prod(primes)
    out = [0] * (d + 1)
    for r in rows:
        others = product // r.p
        unit = others * pow(others, -1, r.p)
        out = [have + unit * residue for have, residue in zip(out, r.residues, strict=True)]
    # Signs alternate, so each coefficient is known from its remainder alone.
    signed = [v % product if k % 2 == 0 else -((-v) % product) for k, v in enumerate(out)]
    if signed[:2] != [1, -trace][: d + 1]:
        raise ArithmeticError("the polynomial does not have the matrix's trace")
    return signed


# -- its roots ---------------------------------------------------------------------------------


class Roots:
    """Real roots of a polynomial that has no other ones, none of them negative. Places are integers over ``2**bits``."""

    def __init__(self, polynomial: list[int]):
        while polynomial[-1] == 0 and len(polynomial) > 1:
            polynomial = polynomial[:-1]
        self.polynomial = polynomial

    def above(self, at: int, bits: int) -> int:
        """How many roots lie above, multiple ones with their number: the sign changes of the polynomial moved there."""
        moved = [c << (bits * k) for k, c in enumerate(self.polynomial)]
        for end in range(len(moved), 1, -1):
            for k in range(1, end):
                moved[k] += at * moved[k - 1]
        signs = [c > 0 for c in moved if c]
        return sum(a != b for a, b in zip(signs, signs[1:]))

    def sign(self, at: int, bits: int) -> int:
        value = 0
        for k, c in enumerate(self.polynomial):
            value = value * at + (c << (bits * k))
        return (value > 0) - (value < 0)

    def largest(self, wanted: int) -> list[tuple[int, int, int, int]]:
        """The largest roots as ``(low, high, bits, number)``, falling: so many equal roots lie in the interval, no other."""
        degree = len(self.polynomial) - 1
        if not degree:
            return []
        top = -self.polynomial[1]
        found: list[tuple[int, int, int, int]] = []
        # Intervals (low, high] with the number of roots above either end; the one with the largest roots is last.
        waiting = [(0, top, 0, degree, 0)]
        while waiting and sum(f[3] for f in found) < wanted:
            low, high, bits, over_low, over_high = waiting.pop()
            number = over_low - over_high
            if not number:
                continue
            if number == 1 or (high - low) << SAME <= low:
                found.append((low, high, bits, number))
                continue
            if high - low < 2:
                low, high, bits = low << 8, high << 8, bits + 8
            middle = (low + high) // 2
            over = self.above(middle, bits)
            waiting += [(low, middle, bits, over_low, over), (middle, high, bits, over, over_high)]
        return self._apart(found, waiting)

    def _apart(self, found: list[tuple], waiting: list[tuple]) -> list[tuple[int, int, int, int]]:
        """Narrow single roots until their intervals are small beside the roots and the distances between them."""
        below = max((Fraction(w[1], 1 << w[2]) for w in waiting if w[3] > w[4]), default=Fraction(0))
        narrowed = [self._narrow(f, SAME) if f[3] == 1 else f for f in found]
        out = []
        for k, own in enumerate(narrowed):
            upper = Fraction(narrowed[k - 1][0], 1 << narrowed[k - 1][2]) if k else None
            lower = Fraction(narrowed[k + 1][1], 1 << narrowed[k + 1][2]) if k + 1 < len(narrowed) else below
            high, low = Fraction(own[1], 1 << own[2]), Fraction(own[0], 1 << own[2])
            gap = min([x for x in (low - lower, upper - high if upper is not None else None) if x is not None and x > 0], default=low)
            ratio = high / gap if gap else Fraction(1)
            more = max(SAME, SURE + (ratio.numerator // ratio.denominator).bit_length())
            out.append(self._narrow(own, more) if own[3] == 1 else own)
        return out

    def _narrow(self, root: tuple[int, int, int, int], to: int) -> tuple[int, int, int, int]:
        """Halve the interval of a single root until it is ``2**-to`` of the root; signs change there and nowhere else."""
        low, high, bits, number = root
        over = self.sign(high, bits)
        while over and ((high - low) << to > low):
            if high - low < 2:
                low, high, bits = low << 16, high << 16, bits + 16
            middle = (low + high) // 2
            here = self.sign(middle, bits)
            if here == 0:
                return middle, middle, bits, number
            low, high = (low, middle) if here == over else (middle, high)
        return (high, high, bits, number) if not over else (low, high, bits, number)


# -- components --------------------------------------------------------------------------------


def null_vectors(matrix: list[list[int]], at: int, bits: int, number: int) -> list[list[float]]:
    """Unit vectors that ``matrix`` stretches by the root ``at / 2**bits``, ``number`` of them at right angles to each other.

    Inverse iteration in fixed-point numbers: one elimination, then two solutions from fixed starting vectors.
    """
    d = len(matrix)
    size = max(1, at >> bits, max(abs(v) for row in matrix for v in row)).bit_length()
    fixed = BITS + 2 * SAME
    a = np.array([[(v << fixed) >> size for v in row] for row in matrix], object)
    for k in range(d):
        a[k, k] -= (at << fixed) >> (bits + size)
    order = np.arange(d)
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        order[[k, pivot]] = order[[pivot, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        a[k + 1 :, k] = (a[k + 1 :, k] << fixed) // a[k, k]
        a[k + 1 :, k + 1 :] -= (a[k + 1 :, k, None] * a[k, k + 1 :]) >> fixed
    start = np.random.default_rng(13).integers(1 << 20, 1 << 30, (number, d)).tolist()
    vectors = [np.array([v << (fixed - 30) for v in row], object) for row in start]
    for _ in range(2):
        solved: list[np.ndarray] = []
        for vector in vectors:
            x = vector[order].copy()
            for k in range(d):
                x[k + 1 :] -= (a[k + 1 :, k] * x[k]) >> fixed
            for k in range(d - 1, -1, -1):
                x[k] = (x[k] << fixed) // a[k, k]
                x[:k] -= (a[:k, k] * x[k]) >> fixed
            for other in solved:
                x -= (other * ((x * other).sum() >> fixed)) >> fixed
            solved.append((x << fixed) // max(1, isqrt(int((x * x).sum()))))
        vectors = solved
    return [[float(Fraction(int(v), 1 << fixed)) for v in vector] for vector in vectors]


def _root(value: Fraction) -> float:
    """The square root, to double precision."""
    up = 2 * max(0, 128 - (value.numerator.bit_length() - value.denominator.bit_length()) // 2)
    return float(Fraction(isqrt((value.numerator << up) // value.denominator), 1 << (up // 2)))


def components(spark: SparkSession, matrix: list[list[int]], wanted: int) -> list[tuple[Fraction, list[float]]]:
    """Roots and unit vectors of the largest components with a variance, falling."""
    roots = Roots(characteristic_polynomial(spark, matrix)).largest(wanted)
    rows = [(k, str(low + high), bits + 1, number) for k, (low, high, bits, number) in enumerate(roots)]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                vectors = null_vectors(matrix, int(r["at"]), r["bits"], r["number"])
                yield pa.RecordBatch.from_pydict({"k": [r["k"]], "vectors": [vectors]})

    if not rows:
        return []
    asked = spark.createDataFrame(rows, "k long, at string, bits int, number int").repartition(len(rows), "k")
    solved = {r.k: r.vectors for r in asked.mapInArrow(solve, "k long, vectors array<array<double>>").collect()}
    out = [(Fraction(int(at), 1 << bits), list(v)) for k, at, bits, _ in rows for v in solved[k]]
    return out[:wanted]


# -- whitening ---------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What the fit list gave. ``projection``: one row per dimension, unit vectors over the roots of ``M``'s eigenvalues."""

    n: int
    sums: list[int]  # of x - SHIFT
    projection: np.ndarray
    explained: list[float]

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """``n * x - S`` of each entry, exactly."""
        largest = int(max(abs(y.max(initial=0)), abs(y.min(initial=0))))
        if self.n * largest + max(map(abs, self.sums)) < 1 << 62:
            return y * self.n - np.array(self.sums, np.int64)
        return y.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return self.deviations(y).astype(np.float64) @ self.projection


def _squares(deviations: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, where it fits a long."""
    largest = int(np.abs(deviations).max(initial=0))
    if deviations.shape[1] * largest**2 < 1 << 63:
        deviations = deviations.astype(np.int64)
        return (deviations * deviations).sum(1).tolist()
    wide = deviations.astype(object)
    return [v if v < 1 << 63 else None for v in (wide * wide).sum(1).tolist()]


def _moments(model: Whitening, mean: np.ndarray | None):
    """Sums over a task's rows: of whitened values, or of the products of their distances from the mean."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            w = model.whitened(_matrix(batch.column("y"))) if batch.num_rows else np.zeros((0, model.projection.shape[1]))
            total = total + (w.sum(0)[:, None] if mean is None else (w - mean).T @ (w - mean))
        if not np.isscalar(total):
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_pydict({"i": i.ravel().astype(np.int32), "j": j.ravel().astype(np.int32), "value": total.ravel()})

    return run


def identity_error(points: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    k = model.projection.shape[1]

    def total(mean: np.ndarray | None) -> dict:
        rows = points.select("y").mapInArrow(_moments(model, mean), "i int, j int, value double")
        return {(r.i, r.j): r.value for r in rows.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}

    sums = total(None)
    mean = np.array([sums[i, 0] / model.n for i in range(k)])
    found = total(mean)
    return max(abs(found[i, j] / model.n - (i == j)) for i in range(k) for j in range(k))


def fit(points: DataFrame, wanted: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors ``y``; None without any component that has a variance."""
    spark = points.sparkSession
    n, sums, products = exact_sums(points)
    d = len(sums)
    matrix = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return None
    found = components(spark, matrix, wanted)
    projection = np.array([[v / _root(value) for v in vector] for value, vector in found]).T
    return Whitening(n, sums, projection, [float(value / trace) for value, _ in found])


def whitened(rows: DataFrame, vector: str, *carried: str, wanted: int = COMPONENTS) -> DataFrame:
    """``carried``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error`` per usable row and component."""
    spark = ready(rows.sparkSession)
    usable = rows.where(_usable(vector)).select(F.struct(*carried).alias("carried"), _integers(vector).alias("y"))
    points = written(usable.select("y").distinct(), "points")
    sizes = points.agg(F.min(F.size("y")), F.max(F.size("y"))).first()
    if sizes[0] != sizes[1]:
        raise ValueError(f"vectors have {sizes[0]} to {sizes[1]} entries")
    model = fit(points, wanted) if sizes[0] else None
    kind = usable.schema["carried"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                deviations = model.deviations(_matrix(some.column("y")))
                values = deviations.astype(np.float64) @ model.projection
                lists = pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], values.ravel())
                columns = [some.column("carried"), pa.array(_squares(deviations), pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["carried", "deviation", "values"])

    schema = f"carried {kind}, deviation long, values array<double>"
    if model is None:
        found, n, explained, error = spark.createDataFrame([], schema), 0, [0.0], 0.0
    else:
        found, n, explained = usable.mapInArrow(project, schema), model.n, model.explained
        error = identity_error(points, model)
    return found.select("carried", "deviation", F.posexplode("values").alias("place", "whitened")).select(
        "carried.*",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(F.lit, explained))[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_exact_polynomial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"), "embedding", "vec_id")
