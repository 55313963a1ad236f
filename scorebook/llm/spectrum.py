"""Leading eigenpairs of an integer symmetric positive semidefinite matrix, from its exact characteristic polynomial.

The polynomial is computed modulo primes below 2**31 (Hessenberg reduction), one prime after the other inside Spark
tasks, and put together by Chinese remaindering; as the roots are real and not negative, its coefficients alternate
in sign and are bounded by the trace. The number of roots above c is the number of sign changes of p(x + c)
(Descartes' rule is exact for real roots), counted in integers, so bisection isolates every root, repeated ones
included, to any precision. An eigenvector comes from inverse iteration in fixed point near the root, kept at right
angles to the earlier vectors of the same root.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

ROOT_BITS, WORK_BITS = 128, 320
ROUNDS = 3


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3.2e9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd = n - 1
    two = (odd & -odd).bit_length() - 1
    odd >>= two
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1):
            for _ in range(two - 1):
                x = x * x % n
                if x == n - 1:
                    break
            else:
                return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2**31 whose product has more than `bits` bits."""
    out, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def char_poly_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients modulo p of det(x - a), lowest first; `a` holds residues."""
    h, d = a.astype(np.int64) % p, len(a)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        i = k + 1 + int(below[0])
        if i != k + 1:
            h[[k + 1, i]] = h[[i, k + 1]]
            h[:, [k + 1, i]] = h[:, [i, k + 1]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        row = -h[k - 1, k - 1] * polys[k - 1] % p
        row[1:] += polys[k - 1, :-1]
        chain = 1
        for i in range(1, k):
            chain = chain * int(h[k - i, k - i - 1]) % p
            if not chain:
                break
            row = (row - int(h[k - 1 - i, k - 1]) * chain % p * polys[k - i - 1]) % p
        polys[k] = row % p
    return polys[d]


def symmetric_sums(spark: SparkSession, a: list[list[int]]) -> list[int]:
    """e_0 .. e_d of the eigenvalues: det(x - a) = sum of (-1)**j e_j x**(d - j). The primes are dealt over tasks."""
    d, trace = len(a), sum(a[i][i] for i in range(len(a)))
    bound = max(comb(d, j) * (trace // d + 1) ** j for j in range(d + 1))
    some = primes(bound.bit_length())

    def run(batches):
        for batch in batches:
            ps = [some[i] for i in batch.column(0).to_pylist()]
            got = [char_poly_mod(np.array([[v % p for v in row] for row in a], np.int64), p) for p in ps]
            yield pa.RecordBatch.from_arrays([pa.array(ps, pa.int64()), pa.array([g.tolist() for g in got], pa.list_(pa.int64()))],
                                             names=["p", "c"])

    slices = min(len(some), max(1, spark.sparkContext.defaultParallelism) * 2)
    rows = spark.range(0, len(some), 1, slices).mapInArrow(run, "p bigint, c array<bigint>").collect()  # d numbers per prime
    product = 1
    for r in rows:
        product *= r["p"]
    parts = [(product // r["p"], pow(product // r["p"] % r["p"], -1, r["p"]), r["p"], r["c"]) for r in rows]
    out = []
    for j in range(d + 1):
        out.append(sum(m * ((-1) ** j * c[d - j] * inv % p) for m, inv, p, c in parts) % product)
    return out


def roots_above(sums: list[int], c: int, shift: int) -> int:
    """How many roots exceed c / 2**shift."""
    d = len(sums) - 1
    q = [(-1) ** j * e << (shift * j) for j, e in enumerate(sums)]  # the polynomial of the roots times 2**shift, highest first
    for stop in range(d, 0, -1):  # q(x + c) by repeated synthetic division
        for j in range(1, stop + 1):
            q[j] += q[j - 1] * c
    signs = [x > 0 for x in q if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def leading_roots(sums: list[int], k: int) -> tuple[list[tuple[int, int]], int]:
    """The k largest roots times 2**shift as intervals (low, high], and shift; (0, 0) is a root that is exactly 0. Equal roots
    (or any within ROOT_BITS of the trace) have equal intervals."""
    trace = sums[1]
    shift = max(0, ROOT_BITS - trace.bit_length())
    seen: dict[int, int] = {}

    def above(c):
        if c not in seen:
            seen[c] = roots_above(sums, c, shift)
        return seen[c]

    least, out = max(1, (trace << shift) >> ROOT_BITS), []
    for i in range(1, k + 1):
        if not trace or above(0) < i:
            out.append((0, 0))
            continue
        low, high = 0, trace << shift
        while high - low > least:
            mid = (low + high) // 2
            low, high = (mid, high) if above(mid) >= i else (low, mid)
        out.append((low, high))
    return out, shift


def _factors(a: list[list[int]], root: int, shift: int, trace: int):
    """LU of (a - root / 2**shift) / trace in fixed point, rows exchanged by size."""
    d = len(a)
    m = np.array([[((a[i][j] << shift) - (root if i == j else 0) << WORK_BITS) // (trace << shift) for j in range(d)]
                  for i in range(d)], object)
    order = list(range(d))
    for k in range(d):
        i = k + max(range(d - k), key=lambda r: abs(m[k + r, k]))
        if i != k:
            m[[k, i]] = m[[i, k]]
            order[k], order[i] = order[i], order[k]
        if m[k, k] == 0:
            m[k, k] = 1
        for r in range(k + 1, d):
            f = (m[r, k] << WORK_BITS) // m[k, k]
            m[r, k] = f
            if f:
                m[r, k + 1:] -= (f * m[k, k + 1:]) >> WORK_BITS
    return m, order


def _solved(m, order, b):
    d, x = len(b), [b[i] for i in order]
    for r in range(d):
        x[r] -= sum(m[r, j] * x[j] for j in range(r)) >> WORK_BITS
    for r in reversed(range(d)):
        x[r] = ((x[r] << WORK_BITS) - sum(m[r, j] * x[j] for j in range(r + 1, d))) // m[r, r]
    return _unit(x)


def _unit(x: list[int]) -> list[int]:
    n = isqrt(sum(v * v for v in x)) or 1
    return [(v << WORK_BITS) // n for v in x]


@dataclass
class Component:
    eigenvalue: Fraction
    vector: np.ndarray | None  # unit length; None for the eigenvalue 0


def leading_components(spark: SparkSession, a: list[list[int]], k: int) -> list[Component]:
    """The k (at most the dimension) largest eigenvalues of `a`, falling, with unit eigenvectors in double precision
    (the largest entry positive)."""
    d, trace = len(a), sum(a[i][i] for i in range(len(a)))
    found, shift = leading_roots(symmetric_sums(spark, a), min(k, d))
    out, same, before = [], [], None
    for n, (low, high) in enumerate(found):
        if high == 0:
            out.append(Component(Fraction(0), None))
            continue
        root = (low + high) // 2
        if (low, high) != before:
            same, before, parts = [], (low, high), _factors(a, root, shift, trace)
        x = [((i * 2654435761 + n * 40503 + 12345) % 1000003 + 1) << (WORK_BITS - 20) for i in range(d)]
        for _ in range(ROUNDS):
            for _ in range(2):
                for s in same:
                    dot = sum(u * v for u, v in zip(x, s)) >> WORK_BITS
                    x = [u - (dot * v >> WORK_BITS) for u, v in zip(x, s)]
            x = _solved(*parts, _unit(x))
        for s in same:
            dot = sum(u * v for u, v in zip(x, s)) >> WORK_BITS
            x = [u - (dot * v >> WORK_BITS) for u, v in zip(x, s)]
        x = _unit(x)
        same.append(x)
        vector = np.array([float(Fraction(v, 1 << WORK_BITS)) for v in x])
        out.append(Component(Fraction(root, 1 << shift), vector * np.sign(vector[np.abs(vector).argmax()])))
    return out
