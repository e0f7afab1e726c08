"""Near-duplicate embeddings by E8 lattice hashing.

Vectors of one label are normalised, projected at random to eight dimensions in
several tables, and decoded to the nearest point of the lattice E8.  Each
vector is filed under its own cell and under the neighbouring cells (lattice
point plus a minimal vector) nearest to it.  Vectors that share a cell meet in
one task (large cells are cut into blocks), where cosines of whole blocks are
computed in double precision.  A pair counts only in the first cell it shares;
tasks give link counts and spanning forests, never pairs.

Null labels, null or zero vectors and vectors with null or non-finite
components link with nothing; vectors of different lengths don't either.
Repeated rows are rows of their own (each counts the other as a link).  An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import components, looked_up, written
from pitchlake.llm.jaccard import BASE, forest, mix
from pitchlake.llm.vectors import matrix, usable

TABLES, PROBES, SCALE = 6, 3, 2.6
THRESHOLD, BLOCK = 0.98, 768
#: Rows of a task: several units of two blocks, dealt by hash.
TASK_ROWS = 20_000
SEED = 81


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: +-1 in two places, and half-integer ones with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for a, b in product((1, -1), repeat=2):
                v = np.zeros(8)
                v[i], v[j] = a, b
                out.append(v)
    out += [np.array(s) / 2 for s in product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(out)


MINIMAL = minimal_vectors()


def nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    f = np.round(x)
    odd = np.flatnonzero(f.sum(axis=1) % 2)
    if len(odd):
        gap = x[odd] - f[odd]
        k = np.abs(gap).argmax(axis=1)
        f[odd, k] += np.where(gap[np.arange(len(odd)), k] >= 0, 1, -1)
    return f


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8: D8 or D8 moved by one half."""
    a, b = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def projections(dim: int, tables: int = TABLES) -> np.ndarray:
    """For each table a random eight-dimensional projection that keeps lengths on average."""
    rng = np.random.Generator(np.random.PCG64(SEED))
    out = [np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))[0][:dim] * np.sqrt(max(dim, 8) / 8) for _ in range(tables)]
    return np.array(out)


def cells(unit: np.ndarray, labels: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Keys (64 bits) of each unit vector's cells: for each table its own and the nearest neighbours."""
    out = []
    for t, p in enumerate(projections(unit.shape[1], tables)):
        x = unit @ p * SCALE
        own = nearest_e8(x)
        near = np.argpartition(-((x - own) @ MINIMAL.T), probes, axis=1)[:, :probes]
        points = np.concatenate([own[:, None, :], own[:, None, :] + MINIMAL[near]], axis=1)
        twice = np.round(points * 2).astype(np.int64).view(np.uint64)
        key = np.full(twice.shape[:2], t + 1, np.uint64) + labels[:, None]
        for d in range(8):
            key = mix(key * BASE + twice[:, :, d])
        out.append(key)
    return np.concatenate(out, axis=1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = np.array(batch.column(2).to_pylist(), np.int64)
        keys = np.zeros((len(dims), TABLES * (1 + PROBES)), np.uint64)
        label = np.array(batch.column(1).to_pylist(), np.int64).view(np.uint64)
        vecs = batch.column(3).to_pylist()
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = matrix((vecs[i] for i in at), int(d))
            keys[at] = cells(x / np.sqrt((x * x).sum(axis=1))[:, None], mix(label[at] + np.uint64(d)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64()))], names=[*batch.schema.names, "cells"])


def _task(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Links of several units, each two blocks of one cell, of pairs that share no earlier cell."""
        uid, first, of = np.unique(group["uid"].to_numpy(), return_index=True, return_inverse=True)
        one = group.iloc[first]
        dims = one["dim"].to_numpy()
        norm = one["norm"].to_numpy()
        raw = one["vec"].to_numpy()
        unit: list[np.ndarray] = [np.zeros(0)] * len(uid)
        # as they were filed: computed again, a vector near a border might get other cells
        keys = np.array(one["cells"].tolist(), np.int64).reshape(len(uid), -1).view(np.uint64)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = matrix(raw[at], int(d)) / norm[at][:, None]
            for i, v in zip(at, x, strict=True):
                unit[i] = v
        links = np.zeros(len(uid), np.int64)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        own = group["own"].to_numpy()
        for (cell, i, j), rows in group.groupby(["cell", "i", "j"], sort=False).indices.items():
            mine = np.int64(cell).view(np.uint64)
            a, b = of[rows[own[rows] == i]], of[rows[own[rows] == j]]
            if not len(a) or not len(b):
                continue
            y = np.array([unit[k] for k in b])
            for lo in range(0, len(a), 512):
                u = a[lo : lo + 512]
                p, q = np.nonzero(np.array([unit[k] for k in u]) @ y.T >= threshold)
                p, q = u[p], b[q]
                if i == j:
                    p, q = p[p < q], q[p < q]
                for s in range(0, len(p), 20_000):
                    v, w = p[s : s + 20_000], q[s : s + 20_000]
                    # keys below this cell's: none may be shared
                    few = keys[v]
                    low = few < mine
                    fresh = np.ones(len(v), bool)
                    for c in range(keys.shape[1]):
                        fresh &= ~(low & (few == keys[w, c][:, None])).any(axis=1)
                    v, w = v[fresh], w[fresh]
                    np.add.at(links, v, 1)
                    np.add.at(links, w, 1)
                    left.append(v)
                    right.append(w)
        tree = dict(forest(len(uid), np.concatenate(left), np.concatenate(right)))
        rows = [(int(uid[k]), int(links[k]), int(uid[tree.get(k, k)])) for k in np.flatnonzero(links)]
        return pd.DataFrame(rows, columns=["uid", "links", "root"])

    return run


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    table = written(usable(df, id_col, vec_col, label_col), "vectors")
    rows = table.filter("vec is not null and label is not null").withColumn("lh", F.xxhash64("label"))
    kept = written(rows.select("uid", "lh", "dim", "vec", "norm").mapInArrow(_keys, "uid long, lh long, dim int, vec binary, norm double, cells array<long>"), "cells")
    filed = kept.select("uid", F.explode("cells").alias("cell"))
    sizes = written(filed.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    meet = looked_up(filed, "cell", sizes, "inner", sizes).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    meet = meet.withColumn("own", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    meet = meet.join(kept.select("uid", "dim", "norm", "vec", "cells"), "uid")
    meet = meet.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meet = meet.select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "uid", "dim", "norm", "vec", "cells")
    total = sizes.agg(F.sum(F.col("n") * F.ceil(F.col("n") / BLOCK))).first()[0] or 0
    meet = meet.withColumn("task", F.pmod(F.xxhash64("cell", "i", "j"), F.lit(max(1, -(-int(total) // TASK_ROWS)))))
    linked = written(meet.groupBy("task").applyInPandas(_task(threshold), "uid long, links long, root long"), "linked")
    counted = linked.groupBy("uid").agg(F.sum("links").alias("links"))
    edges = linked.filter("uid != root").select(F.col("uid").alias("a"), F.col("root").alias("b"))
    if edges.isEmpty():
        parts = df.sparkSession.createDataFrame([], "uid long, root long")
    else:
        parts = components(edges).withColumnRenamed("node", "uid")
    known = written(parts.join(table.select("uid", "vec_id"), "uid"), "parts")
    least = known.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    known = known.join(least, "root").join(counted, "uid").select("uid", "component_id", "links")
    out = table.select("uid", "vec_id").join(known, "uid", "left")
    part = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), part.alias("component_id"), F.coalesce(F.col("vec_id") == part, F.lit(True)).alias("kept"))
