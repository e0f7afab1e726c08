"""Shared vector handling: a table of usable vectors with row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def packed(v: np.ndarray) -> bytes:
    """Four bytes a component where that loses nothing, else eight."""
    with np.errstate(over="ignore"):
        narrow = v.astype(np.float32)
    return (narrow if (narrow == v).all() else v).tobytes()


def matrix(raw, dim: int) -> np.ndarray:
    """Packed vectors of ``dim`` components as a matrix of doubles."""
    raw = list(raw)
    widths = {len(r) for r in raw}
    if len(widths) > 1:
        return np.array([np.frombuffer(r, np.float64 if len(r) == 8 * dim else np.float32).astype(np.float64) for r in raw]).reshape(-1, dim)
    kind = np.float32 if widths == {4 * dim} else np.float64
    return np.frombuffer(b"".join(raw), kind).reshape(-1, dim).astype(np.float64)


def usable(df: DataFrame, id_col: str, vec_col: str, label_col: str | None = None) -> DataFrame:
    """``uid, vec_id, label, dim, norm, vec`` of every row; ``vec`` (see :func:`packed`) is null where the vector takes no part.

    Null and zero vectors and those with null or non-finite components take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            raw, dims, norms = [], [], []
            for v in batch.column(2):
                x = v.as_py()
                ok = bool(x) and not any(c is None for c in x)
                a = np.array(x, np.float64) if ok else None
                if ok:
                    with np.errstate(over="ignore", invalid="ignore"):
                        n = float(np.sqrt(a @ a))
                    ok = bool(np.isfinite(a).all()) and 0 < n < np.inf
                raw.append(packed(a) if ok else None)
                dims.append(len(x) if ok else None)
                norms.append(n if ok else None)
            ids = pa.array(range(uid, uid + batch.num_rows), pa.int64())
            uid += batch.num_rows
            yield pa.RecordBatch.from_arrays([ids, batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(norms, pa.float64()), pa.array(raw, pa.binary())], names=["uid", "vec_id", "label", "dim", "norm", "vec"])

    label = df[label_col].cast("string") if label_col else F.lit(None).cast("string")
    vec = df[vec_col].cast("array<double>")
    return df.select(df[id_col].cast("long").alias("vec_id"), label.alias("label"), vec.alias("vec")).mapInArrow(run, "uid long, vec_id long, label string, dim int, norm double, vec binary")
