"""Whitened leading components of embeddings, from exact integer statistics.

Each entry c becomes x = floor(256 * c), a long (beyond the range of a long: its nearest end). The fit list holds each
distinct x-vector once: vectors are packed (two, four or eight bytes an entry, whatever the largest needs) and made
distinct by one exchange with a map-side part, so copies don't travel. Sums and products of the fit list are exact:
tasks multiply 16-bit limbs in blocks whose sums fit a double's 53 bits, and Spark adds what the tasks found as
decimals. The driver gets one row per pair of dimensions. Eigenvalues and components come from the exact
characteristic polynomial of n * (sum of x x') - S S' (see spectrum.py).

Rows whose vector is null or holds null or non-finite entries are left out; so is an empty vector, which has no
component. Vectors of another length are whitened among themselves. Rows are judged by their own vector, so null and
repeated ids and repeated rows stay; extra columns are left out, whatever their names. A component with eigenvalue 0
(fewer distinct directions than components) has null whitened values, and explained is 0, or null where nothing varies.
`deviation` is a decimal, null beyond 38 digits; the query's long is null beyond a long. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorebook.llm.frames import stage, table
from scorebook.llm.spectrum import leading_components
from scorebook.llm.words import Texts

COMPONENTS, SCALE, BLOCK_ROWS = 4, 256.0, 4096
_LONG = 1 << 63


def vector_rows(col: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) of the vectors of a list column without null or non-finite entries, by length."""
    lens = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten()
    bad = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    bad = bad | ~np.isfinite(values)
    ends = np.cumsum(lens)
    faults = np.concatenate([[0], np.cumsum(bad)])
    ok = (faults[ends] - faults[ends - lens] == 0) & (lens > 0)
    out = []
    for d in np.unique(lens[ok]):
        rows = np.flatnonzero(ok & (lens == d))
        out.append((rows, values[(ends[rows] - d)[:, None] + np.arange(d)]))
    return out


def scaled(m: np.ndarray) -> np.ndarray:
    """floor(256 * c) as longs."""
    f = np.floor(SCALE * m)
    x = np.where(np.abs(f) < 2.0**63, f, 0).astype(np.int64)
    x[f >= 2.0**63], x[f <= -(2.0**63)] = _LONG - 1, -_LONG
    return x


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in as many bytes an entry as its own largest needs: equal rows, equal bytes."""
    top = np.maximum(x.max(1), -(x.min(1) + 1))
    out = [b""] * len(x)
    for kind, low, high in (("<i2", 0, 1 << 15), ("<i4", 1 << 15, 1 << 31), ("<i8", 1 << 31, None)):
        rows = np.flatnonzero((top >= low) & ((top < high) if high else True))
        data = x[rows].astype(kind)
        for i, r in zip(rows, data):
            out[i] = r.tobytes()
    return out


def _unpacked(batch: pa.RecordBatch):
    """(d, matrix of longs) of the rows d, x of the fit list, in blocks."""
    d = batch.column(0).to_numpy()
    t = Texts.of(batch.column(1))
    size = np.diff(t.offs)
    for dim in np.unique(d):
        for wide in np.unique(size[d == dim]):
            rows = np.flatnonzero((d == dim) & (size == wide))
            for a in range(0, len(rows), BLOCK_ROWS):
                some = t.take(rows[a:a + BLOCK_ROWS])
                yield int(dim), np.ascontiguousarray(some.buf).view(f"<i{wide // dim}").reshape(-1, dim).astype(np.int64)


def fit_list(embeddings: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """d, x: each distinct x-vector once."""

    def run(batches):
        for batch in batches:
            for _, m in vector_rows(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array([m.shape[1]] * len(m), pa.int32()), pa.array(packed(scaled(m)), pa.binary())],
                                                 names=["d", "x"])

    return embeddings.select(F.col(vector_col).alias("v")).mapInArrow(run, "d int, x binary").distinct()


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """x = sum of limbs[k] * 2**(16 k), as doubles; the last is signed, as many as the largest entry needs."""
    out = []
    while x.size and max(int(x.max()), -int(x.min()) - 1) >= 1 << 15:
        out.append((x & 0xFFFF).astype(np.float64))
        x = x >> 16
    return [*out, x.astype(np.float64)]


def exact_sums(fit: DataFrame) -> dict[int, tuple[int, list[int], list[list[int]]]]:
    """By dimension: n, S and the sums of x_i * x_j of the fit list, exact."""

    def run(batches):
        held: dict[tuple[int, int], np.ndarray] = {}  # by dimension and power of 2**16: a row for 1 and for each x_i

        def add(key, m):
            held[key] = held[key] + m if key in held else m

        def rows():
            for (d, power), m in held.items():
                i, j = np.nonzero(np.triu(m))
                for a in range(0, len(i), 10_000):
                    s, e = i[a:a + 10_000], j[a:a + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), d), pa.int32()), pa.array(s, pa.int32()), pa.array(e, pa.int32()),
                         pa.array(np.full(len(s), power), pa.int32()), pa.array(m[s, e], pa.int64())],
                        names=["d", "i", "j", "power", "total"])
            held.clear()

        done = 0
        for batch in batches:
            for d, x in _unpacked(batch):
                parts = limbs(x)
                ones = np.ones((len(x), 1))
                for k, u in enumerate(parts):
                    for l, v in enumerate(parts):
                        g = np.zeros((d + 1, d + 1), np.int64)
                        g[1:, 1:] = (u.T @ v).astype(np.int64)
                        if not k:
                            g[:1, 1:] = (ones.T @ v).astype(np.int64)
                        if not k and not l:
                            g[0, 0] = len(x)
                        add((d, k + l), g)
                done += len(x)
                if done > 1 << 26:  # below 2**63 in any sum
                    yield from rows()
                    done = 0
        yield from rows()

    found = (fit.mapInArrow(run, "d int, i int, j int, power int, total bigint").groupBy("d", "i", "j", "power")
             .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    out: dict[int, list[list[int]]] = {}
    for r in found:
        g = out.setdefault(r["d"], [[0] * (r["d"] + 1) for _ in range(r["d"] + 1)])
        g[r["i"]][r["j"]] += int(r["total"]) << 16 * r["power"]
    return {d: (g[0][0], g[0][1:], [[g[min(i, j)][max(i, j)] for j in range(1, d + 1)] for i in range(1, d + 1)])
            for d, g in out.items()}


@dataclass
class Whitening:
    """What rows of one length need: n, S, unit components with their deviations (roots of the eigenvalues), shares."""

    n: int
    sums: list[int]
    vectors: list[np.ndarray | None]
    spread: list[float]
    explained: list[float | None]
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs, or Python integers where a long may not hold them."""
        most = max(int(x.max()), -int(x.min()), 1) * self.n + max(map(abs, self.sums))
        if most < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """Coordinates of centred rows; NaN for components without spread."""
        y = y.astype(np.float64) / self.n
        return np.stack([y @ v / s if v is not None else np.full(len(y), np.nan) for v, s in zip(self.vectors, self.spread)], axis=1)


def deviations(y: np.ndarray) -> list[int]:
    """Sum of squares of each row, exact."""
    most = int(np.abs(y).max()) if y.size else 0
    if y.dtype != object and y.shape[1] * most * most < 1 << 62:
        return (y * y).sum(1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in y]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each length; `fit` is read twice (sums, then the covariance of what is whitened)."""
    spark, out = fit.sparkSession, {}
    for d, (n, s, g) in exact_sums(fit).items():
        a = [[n * g[i][j] - s[i] * s[j] for j in range(d)] for i in range(d)]  # n squared times the covariance
        trace = sum(a[i][i] for i in range(d))
        found = leading_components(spark, a, components)
        out[d] = Whitening(n, s, [c.vector for c in found], [sqrt(c.eigenvalue / (n * n)) for c in found],
                           [float(c.eigenvalue / trace) if trace else None for c in found])

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, x in _unpacked(batch):
                w = np.nan_to_num(out[d].whitened(out[d].centred(x)))
                w = np.concatenate([np.ones((len(w), 1)), w], axis=1)
                held[d] = held.get(d, 0) + w.T @ w
        for d, m in held.items():
            i, j = np.indices(m.shape).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(m.ravel())], names=["d", "i", "j", "total"])

    rows = fit.mapInArrow(run, "d int, i int, j int, total double").groupBy("d", "i", "j").agg(F.sum("total").alias("total")).collect()
    totals = {(r["d"], r["i"], r["j"]): r["total"] for r in rows}
    for d, w in out.items():
        some = [k + 1 for k, v in enumerate(w.vectors) if v is not None]
        # centred before multiplying: the means are 0 but for rounding, and taken off
        cov = [abs(totals[d, i, j] / w.n - totals[d, 0, i] / w.n * (totals[d, 0, j] / w.n) - (i == j)) for i in some for j in some]
        w.identity_error = max(cov, default=None)
    return out


def whitened_components(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained, identity_error of every row and component."""
    fitted = fit_whitening(stage(fit_list(embeddings, vector_col), "fit"), components)
    big = pa.decimal128(38, 0)

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for rows, m in vector_rows(batch.column(1)):
                f = fitted[m.shape[1]]
                k = len(f.vectors)
                y = f.centred(scaled(m))
                w = f.whitened(y).ravel()
                dev = [Decimal(v) if v < 10**38 else None for v in deviations(y)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()),
                     pa.array(np.full(len(w), f.n), pa.int64()), pa.array(dev, big).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                     pa.array(w, mask=np.isnan(w)), pa.array(f.explained * len(rows), pa.float64()),
                     pa.array([f.identity_error] * len(w), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    rows = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(run, "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, "
                                "explained double, identity_error double")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitened_components(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))


QUERIES = {"op12_embedding_whitening": op12_embedding_whitening}
ORACLE: dict[str, str] = {}
