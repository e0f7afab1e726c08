"""Approximate nearest neighbours by query-aware collision counting.

Largest inner product is turned into least distance by one more component
(sqrt(M^2 - |x|^2) for rows, M the largest norm; 0 for queries scaled to M).
Rows are cut into blocks by a hash of their number.  In a block each of
``PROJECTIONS`` random projections is a sorted array.  A query opens a window
centred on its own projection in every array; virtual rehashing widens all
windows by a factor until enough rows lie in at least ``NEED`` of the windows.
Those rows are verified by the exact inner product of the original vectors.
Blocks of rows meet blocks of queries, so a task is bounded whatever the table.
Small blocks verify a larger share of their rows: ``ENOUGH`` candidates for each wanted neighbour, so that recall there is no lower.
The query set is a stated part of all rows, so rows are copied once for each
``QUERIES`` queries, and queries once for each ``ROWS`` rows.

Null or zero vectors and those with null or non-finite components take no part,
nor do rows with a null id;
vectors of another length than the query's are no candidates.  A query's own
row (same id) is no candidate.  Repeated rows of an id give repeated candidates;
a repeated query is answered once, for the least of its vectors (as bytes).  Ties go to the smaller id.
An empty table, or one without queries, gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import written
from pitchlake.llm.vectors import matrix, usable

PROJECTIONS, NEED, START, WIDEN = 192, 134, 0.3, 1.06
#: Rows and queries of a block; candidates verified per wanted neighbour and block at least, and share of a block.
ROWS, QUERIES, ENOUGH, BETA = 8192, 8192, 16, 0.1
#: Places of a sorted array between kept bit sets.
GRAIN = 64
SEED = 5


class Index:
    """Sorted projections of a block of rows, with bit sets of the rows before every ``GRAIN``-th place.

    The rows in a window of places are the difference of two bit sets, and the
    collisions of all rows with a query are added up in bit-sliced counters.
    """

    def __init__(self, base: np.ndarray):
        n, dim = base.shape
        self.n, self.words = n, -(-n // 64)
        self.directions = np.random.Generator(np.random.PCG64(SEED)).standard_normal((dim, PROJECTIONS))
        flat = (base @ self.directions).T
        order = flat.argsort(axis=1, kind="stable")
        self.values = np.take_along_axis(flat, order, axis=1)
        self.places = np.minimum(np.arange(0, n + GRAIN, GRAIN), n)
        self.before = np.zeros((PROJECTIONS, len(self.places), self.words), np.uint64)
        step = np.arange(n) // GRAIN + 1
        for j in range(PROJECTIONS):
            np.bitwise_or.at(self.before[j], (step, order[j] >> 6), np.uint64(1) << (order[j] & 63).astype(np.uint64))
            np.bitwise_or.accumulate(self.before[j], axis=0, out=self.before[j])
        self.spread = float(np.median(self.values[:, min(n - 1, n * 9 // 10)] - self.values[:, n // 10]))

    def colliding(self, centres: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bit sets of the rows that lie in at least ``NEED`` windows of each query, and whether all windows are whole."""
        planes = PROJECTIONS.bit_length()
        start = (1 << planes) - NEED  # a counter overflows at NEED collisions
        counter = [np.full((len(centres), self.words), np.uint64(-(start >> p & 1) & 0xFFFFFFFFFFFFFFFF)) for p in range(planes)]
        hit = np.zeros((len(centres), self.words), np.uint64)
        whole = np.ones(len(centres), bool)
        for j in range(PROJECTIONS):
            lo = self.values[j].searchsorted(centres[:, j] - width) // GRAIN
            hi = -(-self.values[j].searchsorted(centres[:, j] + width, side="right") // GRAIN)
            whole &= (lo == 0) & (hi == len(self.places) - 1)
            carry = self.before[j][hi] & ~self.before[j][lo]
            for p in range(planes):
                counter[p], carry = counter[p] ^ carry, counter[p] & carry
            hit |= carry
        return hit, whole


def search_block(rows: np.ndarray, queries: np.ndarray, top: float, k: int) -> Iterator[np.ndarray]:
    """Candidates of each query in a block of rows; ``top``: the largest norm of all rows."""
    n = len(rows)
    lift = np.sqrt(np.maximum(0.0, top * top - (rows * rows).sum(axis=1)))
    index = Index(np.concatenate([rows, lift[:, None]], axis=1))
    scaled = queries * (top / np.sqrt((queries * queries).sum(axis=1)))[:, None]
    centres = np.concatenate([scaled, np.zeros((len(queries), 1))], axis=1) @ index.directions
    enough = min(n, max(ENOUGH * k, int(BETA * n)))
    first = START * index.spread + 1e-12
    for lo in range(0, len(queries), 256):
        c = centres[lo : lo + 256]
        width = np.full(len(c), first)
        found: list = [None] * len(c)
        open_ = np.arange(len(c))
        while len(open_):
            hit, whole = index.colliding(c[open_], width[open_])
            enough_now = (np.bitwise_count(hit).sum(axis=1) >= enough) | whole
            for i in np.flatnonzero(enough_now):
                bits = np.unpackbits(hit[i].view(np.uint8), bitorder="little")[:n]
                found[open_[i]] = np.arange(n) if whole[i] else np.flatnonzero(bits)
            open_ = open_[~enough_now]
            width[open_] *= WIDEN
        first = float(np.quantile(width, 0.1)) / WIDEN  # later queries begin where these ended
        yield from found


def _task(k: int, top: float):
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The best k of one block of rows for one block of queries."""
        out: list[tuple[int, int, float]] = []
        if len(left) and len(right):
            for dim in right["dim"].unique():
                rows, asked = left[left["dim"] == dim], right[right["dim"] == dim]
                if not len(rows):
                    continue
                x, q = matrix(rows["vec"], dim), matrix(asked["vec"], dim)
                ids, own = rows["vec_id"].to_numpy(np.int64), asked["vec_id"].to_numpy(np.int64)
                for i, found in enumerate(search_block(x, q, top, k + 1)):
                    found = found[ids[found] != own[i]]
                    score = (x[found] * q[i]).sum(axis=1)
                    best = np.lexsort((ids[found], -score))[:k]
                    out += [(int(own[i]), int(ids[found[b]]), float(score[b])) for b in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def search(df: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row where ``is_query(id column)``, in blocks of so many rows and queries."""
    table = written(usable(df, id_col, vec_col).filter("vec is not null and vec_id is not null"), "vectors")
    asked = table.filter(is_query(F.col("vec_id"))).groupBy("vec_id").agg(F.min(F.struct("vec", "dim")).alias("v")).select("vec_id", "v.dim", "v.vec")
    n, top, wanted = table.agg(F.count("*"), F.max("norm"), F.count(F.when(is_query(F.col("vec_id")), 1))).first()
    blocks, asking = max(1, -(-n // rows)), max(1, -(-wanted // queries))
    row_block = F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(asking)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = table.select("vec_id", "dim", "vec", row_block.alias("rb")).withColumn("qb", every(asking))
    right = asked.select("vec_id", "dim", "vec", query_block.alias("qb")).withColumn("rb", every(blocks))
    found = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInPandas(_task(k, float(top or 0.0)), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
