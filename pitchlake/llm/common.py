"""Shared plumbing of the training-data operators: written tables, components."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the cluster names.

    Where it names none, only a session without executors of its own (local mode, as in tests and the bench) gets a folder.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="pitchlake-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def forget(df: DataFrame) -> None:
    """Deletes a table made by :func:`written` that nothing reads any more."""
    path = getattr(df, "_written_path", None)
    if path:
        spark = df.sparkSession
        with contextlib.suppress(Exception):  # leftovers are only untidy
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: A key with at least this share of the rows is heavy; at most its inverse many can be.
HEAVY_SHARE, HEAVY_LEAST = 1000, 1000


def looked_up(rows: DataFrame, key: str | list[str], table: DataFrame, how: str = "left", sizes: DataFrame | None = None) -> DataFrame:
    """Left (or inner) join of ``rows`` with ``table`` (``key`` unique there) that no heavy key sends to one task.

    Heavy keys, at most ``HEAVY_SHARE`` of them, meet a broadcast copy of their rows of ``table``;
    all others are shuffled.  ``rows`` is read three times, so it should be a written table, or once less
    where ``sizes`` (the key and ``n``, its rows) is known.
    """
    keys = [key] if isinstance(key, str) else key
    if sizes is None:
        sizes, total = rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")), rows.count()
    else:
        total = sizes.agg(F.sum("n")).first()[0] or 0
    known = sizes.filter(F.col("n") >= max(HEAVY_LEAST, total // HEAVY_SHARE)).select(*keys).collect()  # at most HEAVY_SHARE rows
    if not known:
        return rows.join(table, keys, how)
    heavy = rows.sparkSession.createDataFrame(known, rows.select(*keys).schema)
    some = rows.join(F.broadcast(heavy.join(table, keys, how)), keys)
    return some.unionByName(rows.join(F.broadcast(heavy), keys, "left_anti").join(table, keys, how))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``; returns ``(node, root)``, root the smallest node.

    Rounds of contraction: every node points to its least neighbour, unless it
    is less itself; pointers are followed to their ends by doubling; then edges
    between the ends are all that is left.  Even rounds compare the nodes
    themselves, which ends stars around their least node at once; odd rounds
    compare hashes that differ from round to round, and so at least halve the
    nodes with an edge on average, however the graph is numbered.  So rounds grow with the
    logarithm of the largest component, and there's no limit on them.  Hubs are
    only aggregated with map-side combine or looked up without skew; no
    neighbour list is collected.  Nodes without an edge (or with one to
    themselves only) and null nodes don't appear; repeated edges count once.
    """
    straight = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = written(straight.distinct(), "links")
    pointers: list[DataFrame] = []
    while not links.isEmpty():
        n = len(pointers)
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(n)).alias("h") if n % 2 else F.lit(0).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        both = links.select(F.col("a").alias("v"), rank("b").alias("r")).unionByName(links.select(F.col("b").alias("v"), rank("a").alias("r")))
        up = written(both.groupBy("v").agg(F.min("r").alias("r")).select("v", F.least(rank("v"), F.col("r"))["v"].alias("p")), "up")
        while True:
            # where the ends of pointers point on; roots don't, so hubs drop out
            on = up.select(F.col("p").alias("v")).distinct().join(up, "v").filter("v <> p").select(F.col("v").alias("p"), F.col("p").alias("q"))
            on = written(on, "on")
            if on.isEmpty():
                forget(on)
                break
            further = written(looked_up(up, "p", on).select("v", F.coalesce("q", "p").alias("p")), "up")
            forget(up)
            forget(on)
            up = further
        ends = up.withColumnRenamed("p", "end")
        half = written(looked_up(links, "a", ends.withColumnRenamed("v", "a")).select(F.col("end").alias("a"), "b"), "half")
        whole = looked_up(half, "b", ends.withColumnRenamed("v", "b")).select("a", F.col("end").alias("b"))
        rest = written(whole.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        forget(links)
        forget(half)
        links = rest
        pointers.append(up)
    forget(links)
    if not pointers:
        return straight.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    # the ends of a round's pointers are where those of the next begin, if they still have an edge
    while len(pointers) > 1:
        later, earlier = pointers.pop(), pointers.pop()
        joined = looked_up(earlier, "p", later.select(F.col("v").alias("p"), F.col("p").alias("q"))).select("v", F.coalesce("q", "p").alias("p"))
        pointers.append(written(joined, "up"))
        forget(later)
        forget(earlier)
    labels = pointers[0]
    least = written(labels.groupBy("p").agg(F.min("v").alias("root")), "roots")
    out = looked_up(labels, "p", least).select(F.col("v").alias("node"), "root")
    return out
