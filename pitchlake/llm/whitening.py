"""Whitening of embeddings by their exact integer covariance.

Entries become whole numbers (``floor(scale * entry)``).  Every distinct vector of
them is in the fit list once.  Tasks subtract a shift (a vector of the list), and add up sums
and cross-products without rounding: numbers are cut into planes of 20 bits, whose products are
exact in a matrix product of doubles, and partial results are integers of any size.  They are added
up in blocks by Spark, so that no task or driver ever holds more than one partial result of each of
``SPLITS`` groups.  Only ``n * XtX - S St`` itself, which no shift changes, becomes floating-point numbers, for eigh.

Rows whose vector is null or holds null or non-finite entries are dropped, as are
vectors without entries.  Vectors of different lengths have nothing in common:
each length is fitted by itself (the driver holds one fit a length, a square matrix).  Entries beyond
64 bits are taken as the nearest 64-bit number.  Rows with equal ids or a null id are rows of
their own; equal eigenvalues come in any order.  Components without
variance (fewer distinct vectors than components, say) have a null ``whitened``, and no part
in ``identity_error``, which is null where no component has any.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import forget, written

SCALE, COMPONENTS = 256, 4
#: Bits of a plane.
PLANE = 20
#: Entries of a partial result that travel together, and groups that partial results are added up in first.
CHUNK, SPLITS = 1 << 16, 64


def integers(vectors: pa.Array, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors as whole numbers) of the usable rows, for each length."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    length = np.diff(offsets)
    good = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]]) & (length > 0)
    for d in np.unique(length[good]):
        rows = np.flatnonzero(good & (length == d))
        with np.errstate(over="ignore"):
            x = np.floor(values[offsets[rows][:, None] + np.arange(d)] * scale)
        high, low = x >= 2.0**63, x < -(2.0**63)
        whole = np.where(high | low, 0, x).astype(np.int64)
        whole[high], whole[low] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        yield rows, whole


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in the fewest bytes an entry that hold all of its entries: equal rows, equal bytes."""
    width = np.ones(len(x), np.int64)
    for w in (1, 2, 4):
        fit = np.iinfo(f"i{w}")
        width[((x < fit.min) | (x > fit.max)).any(axis=1)] = 2 * w
    out: list[bytes] = [b""] * len(x)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        raw = x[at].astype(f"<i{w}").tobytes()
        step = int(w) * x.shape[1]
        for k, i in enumerate(at.tolist()):
            out[i] = raw[k * step : (k + 1) * step]
    return out


def unpacked(keys: list[bytes], d: int) -> np.ndarray:
    out = np.empty((len(keys), d), np.int64)
    width = np.array([len(k) // d for k in keys])
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        out[at] = np.frombuffer(b"".join(keys[i] for i in at), f"<i{w}").reshape(-1, d)
    return out


def planes(x: np.ndarray, shift: np.ndarray) -> list[np.ndarray]:
    """``x - shift`` as signed digits to the base 2^20, least first; nothing overflows."""
    def cut(v: np.ndarray) -> list[np.ndarray]:
        out = []
        while len(v) and (v.min() < -(1 << PLANE) or v.max() >= 1 << PLANE):
            out.append(v & ((1 << PLANE) - 1))
            v = v >> PLANE
        return [*out, v]

    a, b = cut(x), cut(shift)
    zero = np.zeros(1, np.int64)
    return [(a[i] if i < len(a) else zero) - (b[i] if i < len(b) else zero) for i in range(max(len(a), len(b)))]


def products(digits: list[np.ndarray]) -> np.ndarray:
    """The exact cross-products of all columns, summed over rows (Python integers).

    A product of two digits is below 2^43; as many rows are multiplied at once as doubles hold exactly.
    """
    d = digits[0].shape[1]
    total = np.zeros((d, d), object)
    top = [max(1, int(np.abs(u).max())) if u.size else 1 for u in digits]
    for i, u in enumerate(digits):
        for j, v in enumerate(digits):
            step = max(1, (1 << 53) // (top[i] * top[j]))
            part = np.zeros((d, d), object)
            for lo in range(0, len(u), step):
                part += (u[lo : lo + step].T.astype(np.float64) @ v[lo : lo + step].astype(np.float64)).astype(np.int64).astype(object)
            total += part << (PLANE * (i + j))
    return total


def column_sums(digits: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(digits[0].shape[1], object)
    for i, u in enumerate(digits):
        total += u.sum(axis=0).astype(object) << (PLANE * i)
    return total


def to_bytes(numbers: list[int]) -> bytes:
    """Integers of any size in equally many bytes; the first four say how many."""
    width = max((n.bit_length() for n in numbers), default=0) // 8 + 1
    return width.to_bytes(4, "little") + b"".join(n.to_bytes(width, "little", signed=True) for n in numbers)


def from_bytes(raw: bytes) -> list[int]:
    width = int.from_bytes(raw[:4], "little")
    return [int.from_bytes(raw[i : i + width], "little", signed=True) for i in range(4, len(raw), width)]


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total: np.ndarray | None = None
    for raw in group["numbers"]:
        one = np.array(from_bytes(raw), object)
        total = one if total is None else total + one
    return pd.DataFrame({"dim": group["dim"].iloc[:1], "chunk": group["chunk"].iloc[:1], "split": group["split"].iloc[:1], "numbers": [to_bytes(total.tolist())]})


PARTIAL = "dim int, chunk int, split int, numbers binary"


def scatter(keys: DataFrame, shifts: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vector length -> exact (sums, cross-products) of the shifted vectors of a table ``dim, key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        cross: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            raw = batch.column(1)
            for d in np.unique(dims).tolist():
                digits = planes(unpacked([raw[i].as_py() for i in np.flatnonzero(dims == d).tolist()], d), shifts[d])
                sums[d] = sums.get(d, 0) + column_sums(digits)
                cross[d] = cross.get(d, 0) + products(digits)
        split = TaskContext.get().partitionId() % SPLITS
        for d in sums:
            numbers = [*sums[d].tolist(), *cross[d][np.triu_indices(d)].tolist()]
            for c, at in enumerate(range(0, len(numbers), CHUNK)):
                yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([c], pa.int32()), pa.array([split], pa.int32()), pa.array([to_bytes(numbers[at : at + CHUNK])], pa.binary())], names=["dim", "chunk", "split", "numbers"])

    parts = keys.mapInArrow(run, PARTIAL).groupBy("dim", "chunk", "split").applyInPandas(_added, PARTIAL)
    whole = parts.groupBy("dim", "chunk").applyInPandas(_added, PARTIAL).orderBy("dim", "chunk").select("dim", "numbers").collect()  # a matrix a length
    numbers: dict[int, list[int]] = {}
    for r in whole:
        numbers.setdefault(r["dim"], []).extend(from_bytes(bytes(r["numbers"])))
    out = {}
    for d, v in numbers.items():
        cross = np.zeros((d, d), object)
        cross[np.triu_indices(d)] = v[d:]
        cross.T[np.triu_indices(d)] = v[d:]
        out[d] = np.array(v[:d], object), cross
    return out


class Whitener:
    """The fit of one vector length."""

    def __init__(self, n: int, shift: np.ndarray, sums: np.ndarray, cross: np.ndarray, components: int = COMPONENTS):
        self.n, self.shift, self.sums = n, shift, sums
        d = len(shift)
        exact = n * cross - np.outer(sums, sums)
        cov = np.array([[v / (n * n) for v in row] for row in exact], np.float64)
        trace = sum(exact[i, i] for i in range(d)) / (n * n)
        e, v = np.linalg.eigh(cov)
        e, v = e[::-1][:components], v[:, ::-1][:, :components]
        # the largest entry of a component is positive
        v = v * np.where(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])] < 0, -1.0, 1.0)
        self.usable = e > trace * d * np.finfo(np.float64).eps
        self.explained = e / trace if trace else np.full(len(e), np.nan)
        self.mean = np.array([s / n for s in sums], np.float64)
        self.axes = v / np.sqrt(np.where(self.usable, e, 1.0))
        self.identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values; NaN for components without variance."""
        digits = planes(x, self.shift)
        y = sum(u.astype(np.float64) * 2.0 ** (PLANE * i) for i, u in enumerate(digits))
        out = (y - self.mean) @ self.axes
        out[:, ~self.usable] = np.nan
        return out

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """The sums over dimensions of ``(n * x - S)^2``, exact (Python integers): n^2 y^2 - 2 n y S + S^2 of the shifted ones."""
        digits = planes(x, self.shift)
        squares = np.zeros(len(x), object)
        for i, u in enumerate(digits):
            for j, v in enumerate(digits):
                squares += (u * v).sum(axis=1).astype(object) << (PLANE * (i + j))
        mixed, left, k = np.zeros(len(x), object), self.sums.copy(), 0
        while True:
            last = all(-(1 << PLANE) <= s < 1 << PLANE for s in left)
            low = np.array([s if last else s & ((1 << PLANE) - 1) for s in left], np.int64)
            for i, u in enumerate(digits):
                mixed += (u * low).sum(axis=1).astype(object) << (PLANE * (i + k))
            if last:
                break
            left, k = left >> PLANE, k + 1
        return self.n * self.n * squares - 2 * self.n * mixed + sum(s * s for s in self.sums)


def fit(df: DataFrame, vec_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS) -> dict[int, Whitener]:
    """Vector length -> :class:`Whitener` of a table's distinct vectors."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch.column(0), scale):
                yield pa.RecordBatch.from_arrays([pa.array([x.shape[1]] * len(rows), pa.int32()), pa.array(packed(x), pa.binary())], names=["dim", "key"])

    vectors = df.select(df[vec_col].cast("array<double>").alias("vec"))
    # equal vectors meet in the task first, so copies in any number cost one row a task
    distinct = written(vectors.mapInArrow(keys, "dim int, key binary").distinct(), "distinct-vectors")
    told = distinct.groupBy("dim").agg(F.count("*").alias("n"), F.min("key").alias("first")).collect()  # a row a length
    shifts = {r["dim"]: unpacked([bytes(r["first"])], r["dim"])[0] for r in told}
    found = scatter(distinct, shifts) if told else {}
    models = {r["dim"]: Whitener(r["n"], shifts[r["dim"]], *found[r["dim"]], components) for r in told}
    if models:
        shared = df.sparkSession.sparkContext.broadcast(models)  # a few vectors a length

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                dims = batch.column(0).to_numpy()
                raw = batch.column(1)
                for d in np.unique(dims).tolist():
                    w = shared.value[d].project(unpacked([raw[i].as_py() for i in np.flatnonzero(dims == d).tolist()], d))
                    cols = [pa.array(w[:, i] if i < w.shape[1] else np.full(len(w), np.nan), from_pandas=True, type=pa.float64()) for i in range(components)]
                    yield pa.RecordBatch.from_arrays([pa.array([d] * len(w), pa.int32()), *cols], names=["dim", *(f"w{i}" for i in range(components))])

        flat = distinct.mapInArrow(project, "dim int, " + ", ".join(f"w{i} double" for i in range(components)))
        pairs = [(i, j) for i in range(components) for j in range(i + 1)]
        for r in flat.groupBy("dim").agg(*[F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs]).collect():  # a row a length
            gaps = [abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None]
            models[r["dim"]].identity_error = max(gaps, default=None)
    forget(distinct)
    return models


SCHEMA = "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, models: dict[int, Whitener], id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``SCHEMA`` for each usable row and component (from 1); ``deviation`` is a whole number of any size, as text.

    Rows of a length that the fit has not seen are dropped.
    """
    shared = df.sparkSession.sparkContext.broadcast(models)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integers(batch.column(1), scale):
                m = shared.value.get(x.shape[1])
                if m is None:
                    continue
                w, far = m.project(x), [str(v) for v in m.deviation(x).tolist()]
                k, many = w.shape[1], len(rows)
                ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
                cols = [ids, pa.array(np.tile(np.arange(1, k + 1), many), pa.int32()), pa.array(np.full(many * k, m.n), pa.int64()), pa.array([v for v in far for _ in range(k)], pa.string()), pa.array(w.ravel(), pa.float64(), from_pandas=True)]
                cols += [pa.array(np.tile(m.explained, many), pa.float64(), from_pandas=True), pa.array([m.identity_error] * (many * k), pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.select(df[id_col].cast("long").alias("vec_id"), df[vec_col].cast("array<double>").alias("vec")).mapInArrow(run, SCHEMA)
