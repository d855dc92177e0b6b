"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter matrix.

Integers. Each component c becomes x = floor(scale * c) + offset. The fit list is
each distinct x vector once: n vectors with sums S. N = n * sum(x x^T) - S S^T is an
integer matrix, n^2 times their covariance V, and does not depend on the offset.
Its sums are added up exactly: vectors are cut into digits of 20 bits, whose
products over a block of rows fit a double without rounding.

Polynomial. The characteristic polynomial of N is found modulo enough 31-bit primes
to hold its largest possible coefficient (the bound follows from the trace): N is brought to Hessenberg
form modulo each prime and the polynomial read off by the recurrence of its
leading minors. The primes are shared out over Spark tasks; Chinese remaindering puts the coefficients together.

Roots. All roots are real and none is negative, so by Descartes' rule the sign changes of p(t + x)
count the roots above x exactly, with their multiplicity. Bisection at integers and binary fractions with
this count isolates each of the largest roots; a simple one is narrowed by the
sign of p alone, down to a relative width of 2^-`root_bits`. Roots that can't be told apart at that width count as one multiple root.

Components. For each root, (N - root I) is factored with `digits` decimal digits, and
inverse iteration on as many start vectors as the root is multiple gives its null space; each
vector is made orthogonal to those of its root, and is rounded to doubles at the end. The
roots are shared out over tasks too. The largest entry of a component is positive.

Whitening. A row's deviations from the mean are exact integers plus one fraction;
projected on the components and divided by the roots' square roots they give columns of variance 1.
`identity_error` is measured on the fit list: the covariance of its whitened
vectors, centred before multiplying, minus the identity.

Plan. A shuffle of distinct vectors in their shortest integer form, counted in each
task first; sums of d * d numbers per task; narrow passes for the rest. What the
driver holds are matrices of the vectors' dimension, whatever the number of rows.

Defined results: vectors that are null, empty, or hold null or non-finite entries take no
part; neither do vectors whose length isn't the most frequent one (ties: the longer); a
component too large for 62 bits after scaling is an error that names it; rows that
repeat an id, or have none, are each returned. Only components with a positive
root exist: a table whose vectors are all alike, or empty, gives an empty result. A deviation past
a long is null in `deviation`; `exact_deviation=True` returns it as a decimal.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Context, Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from livetables.llm.common import col, ship_package, written

_DIGIT = 20                       # bits of a digit: products of two over _ROWS rows stay below 2^53
_ROWS = 4096


# ---------------------------------------------------------------------------
# Integer vectors
# ---------------------------------------------------------------------------

def scaled(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * c) as 64-bit integers."""
    made = np.floor(vectors.astype(np.float64) * scale)
    if made.size and np.abs(made).max() >= 2.0 ** 62:
        raise ValueError(f"component {vectors.reshape(-1)[np.abs(made).argmax()]} is too large for {scale} * c in 62 bits")
    return made.astype(np.int64)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in the shortest of 2, 4 or 8 bytes per entry: equal rows give equal bytes."""
    most = np.maximum(x.max(axis=1), -(x.min(axis=1) + 1)) if x.size else np.zeros(len(x))
    two, four = x.astype("<i2"), x.astype("<i4")
    return [(two[i] if m < 2 ** 15 else four[i] if m < 2 ** 31 else x[i].astype("<i8")).tobytes() for i, m in enumerate(most)]


def unpacked(rows: Sequence[bytes], d: int) -> np.ndarray:
    out = np.empty((len(rows), d), np.int64)
    by_width = defaultdict(list)
    for i, r in enumerate(rows):
        by_width[len(r) // d].append(i)
    for width, at in by_width.items():
        out[at] = np.frombuffer(b"".join(rows[i] for i in at), f"<i{width}").reshape(-1, d)
    return out


def digits_of(x: np.ndarray) -> list[np.ndarray]:
    """Signed digits of 20 bits, lowest first, as doubles; none beyond the last that is not zero."""
    out, rest = [], x
    while rest.any():
        high = (rest + (1 << (_DIGIT - 1))) >> _DIGIT
        out.append((rest - (high << _DIGIT)).astype(np.float64))
        rest = high
    return out


def exact_sums(x: np.ndarray) -> dict[int, np.ndarray]:
    """By power of 2^20: the integer matrix sum(z z^T) of z = (1, x), for at most _ROWS rows."""
    parts = digits_of(x)
    one = np.ones((len(x), 1))
    rows = [np.hstack([one, p]) if i == 0 else np.hstack([0 * one, p]) for i, p in enumerate(parts)] or [np.hstack([one, np.zeros(x.shape)])]
    out: dict[int, np.ndarray] = {}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            made = (a.T @ b).astype(np.int64)
            out[i + j] = out[i + j] + made if i + j in out else made
    return out


# ---------------------------------------------------------------------------
# Characteristic polynomial
# ---------------------------------------------------------------------------

def _is_prime(n: int) -> bool:
    # these bases decide every n below 3,215,031,751
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_below(top: int, product: int) -> list[int]:
    """The largest primes below `top`, until their product exceeds `product`."""
    out, total, n = [], 1, top
    while total <= product:
        n -= 1 if n % 2 == 0 else 2
        if _is_prime(n):
            out.append(n)
            total *= n
    return out


def _inverses(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return np.array([pow(int(a), -1, int(q)) if a else 0 for a, q in zip(x, p)], np.int64)


def modular_polynomial(residues: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """[prime, degree + 1] coefficients, lowest first, of det(x I - A) modulo each prime; residues [prime, d, d]."""
    a, p = residues.astype(np.int64).copy(), primes.astype(np.int64)
    d, each, p1, p2 = a.shape[1], np.arange(len(primes)), primes.astype(np.int64)[:, None], primes.astype(np.int64)[:, None, None]
    for m in range(1, d - 1):
        # a non-zero entry below the diagonal of column m - 1 comes to row m; rows and columns change together
        pivot = m + (a[:, m:, m - 1] != 0).argmax(axis=1)
        rows = a[each, pivot].copy()
        a[each, pivot] = a[:, m]
        a[:, m] = rows
        columns = a[each, :, pivot].copy()
        a[each, :, pivot] = a[:, :, m]
        a[:, :, m] = columns
        factor = a[:, m + 1:, m - 1] * _inverses(a[:, m, m - 1], p)[:, None] % p1
        a[:, m + 1:, m - 1:] = (a[:, m + 1:, m - 1:] - factor[:, :, None] * a[:, None, m, m - 1:] % p2) % p2
        # the inverse step on columns, sums of products below 2^62 one at a time
        add = a[:, :, m].copy()
        for i in range(m + 1, d):
            add = (add + a[:, :, i] * factor[:, None, i - m - 1]) % p1
        a[:, :, m] = add
    polys = np.zeros((d + 1, len(primes), d + 1), np.int64)
    polys[0, :, 0] = 1
    for k in range(1, d + 1):
        made = np.zeros((len(primes), d + 1), np.int64)
        made[:, 1:] = polys[k - 1][:, :-1]
        made = (made - a[:, k - 1, k - 1, None] * polys[k - 1] % p1) % p1
        under = np.ones(len(primes), np.int64)
        for i in range(k - 1, 0, -1):
            under = under * a[:, i, i - 1] % p
            if not under.any():
                break
            made = (made - (a[:, i - 1, k - 1] * under % p)[:, None] * polys[i - 1] % p1) % p1
        polys[k] = made
    return polys[d]


def coefficient_bound(trace: int, d: int) -> int:
    """No coefficient of the polynomial of a matrix with roots >= 0 and this trace is larger."""
    share = Fraction(trace, d)
    return max((math.comb(d, k) * math.ceil(share ** k) for k in range(d + 1)), default=1)


def combined(residues: np.ndarray, primes: Sequence[int]) -> list[int]:
    """Chinese remaindering of [prime, coefficient], to the integers nearest zero."""
    total = math.prod(primes)
    basis = [(total // q) * pow(total // q, -1, q) for q in primes]
    out = []
    for column in residues.T.tolist():
        c = sum(b * r for b, r in zip(basis, column)) % total
        out.append(c - total if 2 * c > total else c)
    return out


# ---------------------------------------------------------------------------
# Roots
# ---------------------------------------------------------------------------

def roots_above(poly: Sequence[int], num: int, shift: int) -> int:
    """How many roots of a polynomial with real roots only (lowest coefficient first) exceed num / 2^shift."""
    d = len(poly) - 1
    # q(t) = 2^(shift d) p((t + num) / 2^shift): same signs, integers only
    q = [c << (shift * (d - i)) for i, c in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            q[j] += num * q[j + 1]
    signs = [c > 0 for c in q if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign_at(poly: Sequence[int], num: int, shift: int) -> int:
    value, power = 0, 0
    for c in reversed(poly):
        value = value * num + (c << power)
        power += shift
    return (value > 0) - (value < 0)


@dataclass
class Root:
    num: int                  # the middle of its interval: num / 2^shift
    shift: int
    multiple: int

    def value(self) -> Fraction:
        return Fraction(self.num, 1 << self.shift)


def largest_roots(poly: Sequence[int], wanted: int, root_bits: int = 160) -> list[Root]:
    """The largest roots (>= `wanted` with their multiplicity, positive ones only), falling, for polynomials with roots >= 0."""
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = list(poly[zeros:])
    d = len(poly) - 1
    if d <= 0:
        return []
    top = 1 << (-poly[-2] // poly[-1]).bit_length()                  # above the sum of all roots
    out: list[Root] = []
    # (low, high, shift, roots above low, roots above high): roots in (low, high] / 2^shift, largest interval last
    todo = [(0, top, 0, d, 0)]
    while todo and sum(r.multiple for r in out) < wanted:
        low, high, shift, below, above = todo.pop()
        if below == above:
            continue
        if below - above == 1 and low > 0:
            out.append(_narrowed(poly, low, high, shift, root_bits))
            continue
        if low > 0 and (high - low) << root_bits < low:
            out.append(Root(low + high, shift + 1, below - above))
            continue
        if high - low == 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        middle = (low + high) // 2
        inside = roots_above(poly, middle, shift)
        todo += [(low, middle, shift, below, inside), (middle, high, shift, inside, above)]
    return out


def _narrowed(poly: Sequence[int], low: int, high: int, shift: int, root_bits: int) -> Root:
    """The simple root in (low, high] / 2^shift."""
    if _sign_at(poly, high, shift) == 0:
        return Root(high, shift, 1)
    below = _sign_at(poly, high, shift)                              # of the side above the root
    while (high - low) << root_bits >= low:
        if high - low == 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        middle = (low + high) // 2
        sign = _sign_at(poly, middle, shift)
        if sign == 0:
            return Root(middle, shift, 1)
        low, high = (low, middle) if sign == below else (middle, high)
    return Root(low + high, shift + 1, 1)


# ---------------------------------------------------------------------------
# Components
# ---------------------------------------------------------------------------

def null_space(matrix: list[list[int]], root: Fraction, multiple: int, digits: int = 100, rounds: int = 3) -> np.ndarray:
    """[multiple, d] unit vectors of the eigenspace of a symmetric integer matrix."""
    d = len(matrix)
    with localcontext(Context(prec=digits, Emax=10 ** 9, Emin=-10 ** 9)):
        value = Decimal(root.numerator) / Decimal(root.denominator)
        a = np.array([[Decimal(v) for v in row] for row in matrix], dtype=object)
        a[np.arange(d), np.arange(d)] -= value
        tiny = value * Decimal(10) ** (10 - digits)
        swaps = []
        for k in range(d):
            best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            swaps.append(best)
            if best != k:
                a[[k, best]] = a[[best, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] = a[k + 1:, k] / a[k, k]
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])
        rng = np.random.default_rng(d)
        found: list[np.ndarray] = []
        for _ in range(multiple):
            v = np.array([Decimal(int(i)) for i in rng.integers(1, 1 << 30, d)], dtype=object)
            for _ in range(rounds):
                for k in range(d):
                    if swaps[k] != k:
                        v[[k, swaps[k]]] = v[[swaps[k], k]]
                    v[k + 1:] -= a[k + 1:, k] * v[k]
                for k in range(d - 1, -1, -1):
                    v[k] = (v[k] - (a[k, k + 1:] @ v[k + 1:] if k + 1 < d else Decimal(0))) / a[k, k]
                for u in found:
                    v = v - u * (u @ v)
                v = v / (v @ v).sqrt()
            found.append(v)
        return np.array([[float(x) for x in v] for v in found]).reshape(len(found), d)


# ---------------------------------------------------------------------------
# The operator
# ---------------------------------------------------------------------------

@dataclass
class Model:
    """n, dimension, S of the shifted vectors (x - offset), and the components: of the dimension's size, whatever the rows."""

    n: int
    sums: list[int]
    trace: int                          # of N
    roots: list[Fraction]               # of N, one per component
    components: np.ndarray              # [component, d]

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x (shifted like the sums) minus the mean, as doubles; and n * x - S as integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole).astype(np.float64) - part, x

    def whitened(self, x: np.ndarray) -> np.ndarray:
        size = np.array([self.n / math.sqrt(r) if r < 2 ** 1000 else float(self.n / Fraction(math.isqrt(int(r)))) for r in self.roots])
        return self.deviations(x)[0] @ self.components.T * size

    def squares(self, x: np.ndarray) -> list[int]:
        """sum over dimensions of (n * x - S)^2, exact, per row."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if self.n * most + max(map(abs, self.sums), default=0) >= 1 << 56 or len(self.sums) > 64:
            d = x.astype(object) * self.n - np.array(self.sums, dtype=object)
            return (d * d).sum(axis=1).tolist() if d.size else [0] * len(x)
        d = x * self.n - np.array(self.sums, np.int64)
        high = d >> 28
        low = d - (high << 28)
        parts = [(high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1)]
        return [(a << 56) + (b << 29) + c for a, b, c in zip(*(p.tolist() for p in parts))]


def _vectors(df: DataFrame, vector_col: str) -> DataFrame:
    """`df` with __v (array of doubles) where the vector takes part, whatever its length."""
    v = col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.withColumn("__v", v).where(F.col("__v").isNotNull() & (F.size("__v") > 0) & F.coalesce(fine, F.lit(False)))


def fit(df: DataFrame, *, vector_col: str = "embedding", scale: float = 64.0, components: int = 16,
        root_bits: int = 160, digits: int = 100) -> tuple[Model | None, DataFrame | None]:
    """The model, and the written fit list (x, packed); (None, None) without any vector."""
    spark = df.sparkSession
    ship_package(spark)
    vectors = _vectors(df, vector_col).select("__v")
    length = vectors.groupBy(F.size("__v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if length is None:
        return None, None
    d = length["d"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([pa.array(packed(scaled(flat, scale)), pa.binary())], names=["x"])
    distinct = written(vectors.where(F.size("__v") == d).mapInArrow(pack, "x binary").distinct(), "whitening-fit")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            rows = [(power, i, line.tolist()) for power, m in totals.items() for i, line in enumerate(m)]
            totals.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                               pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["power", "row", "line"])
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                x = unpacked(batch.slice(at, _ROWS).column(0).to_pylist(), d)
                for power, made in exact_sums(x).items():
                    totals[power] = totals[power] + made if power in totals else made
                held += len(x)
                if held > 1 << 20:                                   # sums of products below 2^40 stay below 2^63
                    yield flush()
                    held = 0
        if totals:
            yield flush()
    added = (distinct.mapInArrow(add_up, "power int, row int, line array<long>").select("power", "row", F.posexplode("line").alias("column", "v"))
             .groupBy("power", "row", "column").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))
    gram = np.zeros((d + 1, d + 1), dtype=object)
    for r in added.collect():                                        # a few times (d + 1)^2 numbers
        gram[r["row"], r["column"]] += int(r["v"]) << (_DIGIT * r["power"])
    n, sums = int(gram[0, 0]), [int(s) for s in gram[0, 1:]]
    scatter = [[n * int(gram[i + 1, j + 1]) - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(scatter[i][i] for i in range(d))
    if trace == 0:
        return Model(n, sums, 0, [], np.zeros((0, d))), distinct
    roots = largest_roots(_polynomial(spark, scatter, trace), components, root_bits)
    found = _null_spaces(spark, scatter, roots, digits)
    values = [r.value() for r in roots for _ in range(r.multiple)][:components]
    return Model(n, sums, trace, values, found[:components]), distinct


def _polynomial(spark, scatter: list[list[int]], trace: int, at_once: int = 8) -> list[int]:
    """The characteristic polynomial, lowest coefficient first; primes are shared out over tasks."""
    d = len(scatter)
    primes = primes_below(1 << 31, 2 * coefficient_bound(trace, d))
    shared = spark.sparkContext.broadcast(scatter)                  # d * d integers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = np.array(batch.column(0).to_pylist(), np.int64)
            for at in range(0, len(some), at_once):
                own = some[at:at + at_once]
                residues = np.array([[[v % int(p) for v in row] for row in shared.value] for p in own], np.int64)
                made = modular_polynomial(residues, own)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(made.tolist(), pa.list_(pa.int64()))], names=["p", "c"])
    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    rows = (spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks).mapInArrow(run, "p long, c array<long>").collect())
    by_prime = {r["p"]: r["c"] for r in rows}
    return combined(np.array([by_prime[p] for p in primes], dtype=object), primes)


def _null_spaces(spark, scatter: list[list[int]], roots: list[Root], digits: int) -> np.ndarray:
    shared = spark.sparkContext.broadcast(scatter)                  # d * d integers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                vectors = null_space(shared.value, Fraction(int(r["num"]), 1 << r["shift"]), r["multiple"], digits)
                # the largest entry is positive
                sign = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
                yield pa.RecordBatch.from_arrays([pa.array([r["i"]] * len(vectors), pa.int32()), pa.array(np.arange(len(vectors)), pa.int64()),
                                                  pa.array((vectors * sign[:, None]).tolist(), pa.list_(pa.float64()))], names=["i", "j", "v"])
    rows = [(i, str(r.num), r.shift, r.multiple) for i, r in enumerate(roots)]
    frame = spark.createDataFrame(rows, "i int, num string, shift int, multiple int").repartition(max(1, len(rows)))
    made = frame.mapInArrow(run, "i int, j long, v array<double>").collect()
    return np.array([r["v"] for r in sorted(made, key=lambda r: (r["i"], r["j"]))]).reshape(-1, len(scatter))


def identity_error(distinct: DataFrame, model: Model) -> float:
    """Largest absolute entry of the covariance of the fit list's whitened vectors, minus the identity."""
    shared, d, k = distinct.sparkSession.sparkContext.broadcast(model), len(model.sums), len(model.roots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                w = shared.value.whitened(unpacked(batch.slice(at, _ROWS).column(0).to_pylist(), d))
                z = np.hstack([np.ones((len(w), 1)), w])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(np.arange((k + 1) ** 2), pa.int64()), pa.array(total.reshape(-1))], names=["at", "v"])
    rows = distinct.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()     # (k + 1)^2 numbers
    total = np.zeros((k + 1) ** 2)
    for r in rows:
        total[r["at"]] = r["v"]
    total = total.reshape(k + 1, k + 1) / model.n
    # deviations are centred already; what rounding left of the mean is taken out too
    cov = total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:])
    return float(np.abs(cov - np.eye(k)).max(initial=0.0))


def whiten(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0, components: int = 16,
           exact_deviation: bool = False) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: per row that takes part and component."""
    model, distinct = fit(df, vector_col=vector_col, scale=scale, components=components)
    kind = "decimal(38,0)" if exact_deviation else "long"
    id_type = df.select(col(id_col).alias("id")).schema["id"].dataType
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if model is None or not model.roots:
        empty = StructType([StructField("id", id_type), *StructType.fromDDL(f"c int, n long, d {kind}, w double, e double, i double").fields])
        return df.sparkSession.createDataFrame([], empty).toDF(*names)
    error = identity_error(distinct, model)
    shared, d = df.sparkSession.sparkContext.broadcast(model), len(model.sums)
    explained = [float(r / model.trace) for r in model.roots]
    rows = _vectors(df, vector_col).where(F.size("__v") == d).select(col(id_col).alias("id"), "__v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            x = scaled(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d), scale)
            squares = own.squares(x)
            if exact_deviation:
                far = pa.array([Decimal(s) for s in squares], pa.decimal128(38, 0))
            else:
                far = pa.array([s if s < 1 << 63 else None for s in squares], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), far, pa.array(list(own.whitened(x)), pa.list_(pa.float64()))],
                                             names=["id", "deviation", "w"])
    made = rows.mapInArrow(run, StructType([StructField("id", id_type), *StructType.fromDDL(f"deviation {kind}, w array<double>").fields]))
    share = F.array(*[F.lit(e) for e in explained])
    return (made.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select("id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(share, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error")).toDF(*names))
