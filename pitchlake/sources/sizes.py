"""Partition counts that follow the size of the input, for steps whose tasks must stay small whatever the session's settings."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of input files a partition.  Parquet rows of a few numbers take ten to twenty bytes there, and a hundred or more in a hash table.
SHARE = 4 << 20


def input_bytes(df: DataFrame) -> int:
    """The size of the files that a frame reads, by what Spark has listed; frames that read none have 0, as do tables whose files it hasn't listed yet."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    sizes = [int(x.stats().sizeInBytes()) for x in leaves if x.getClass().getSimpleName() == "LogicalRelation"]
    return sum(n for n in sizes if n < 1 << 60)


def tasks(*frames: DataFrame, share: int | None = None) -> int:
    """A partition for each share of all frames' input; at least the session's own number."""
    least = int(frames[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-sum(map(input_bytes, frames)) // (share or SHARE)))


def spread(df: DataFrame, *keys: str, share: int | None = None) -> DataFrame:
    """Rows by hash of ``keys`` in as many partitions as the input has shares; as they are, where the session's own number is as many.

    A join or aggregation on the keys (and more) takes these partitions over, and adaptive execution doesn't merge them.
    """
    n = tasks(df, share=share)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
