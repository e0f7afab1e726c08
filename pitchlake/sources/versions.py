"""Partitions replaced as a whole: rows go to a fresh folder, and one catalog statement makes it the partition's place.

A reader that has planned its scan goes on reading the files it has listed, one
that plans later lists the new ones; none sees a mixture.  Folders that no
partition names any more are noted as retired, and deleted by a later
write to the table once they have been so for ``RETAINED`` seconds (:func:`expire`).
A write that fails leaves a folder that nobody reads.  There is one writer a partition.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitchlake.sources.files import Files

#: Seconds for which scans that began before a write may still read what it replaced.
RETAINED = 3600


def literal(v: object) -> str:
    """A partition value in SQL."""
    if v is None:
        return "null"
    return str(v) if isinstance(v, int) else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def clause(spec: dict[str, object]) -> str:
    return "PARTITION (" + ", ".join(f"`{k}`={literal(v)}" for k, v in spec.items()) + ")"


def place(spark: SparkSession, name: str, spec: dict[str, object] | None = None, check: bool = True) -> str | None:
    """The folder of a table, or of one of its partitions; None if there's no such partition (an error without ``check``)."""
    if spec and check and spark.sql(f"SHOW PARTITIONS {name} {clause(spec)}").isEmpty():
        return None
    rows = spark.sql(f"DESCRIBE FORMATTED {name} {clause(spec) if spec else ''}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def folder(spark: SparkSession, name: str) -> str:
    """A new folder for versions within the table's own; scans of the table don't look there by themselves."""
    return f"{place(spark, name)}/_versions/{int(time.time())}-{uuid.uuid4().hex}"


def known(spark: SparkSession, name: str) -> set[tuple]:
    """The partitions a table has, as (key, text) pairs."""
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()  # a row a partition
    return {tuple((k, unquote(v)) for k, _, v in (part.partition("=") for part in r["partition"].split("/"))) for r in rows}


def as_text(v: object) -> str:
    """A partition value as :func:`known` has it."""
    return "__HIVE_DEFAULT_PARTITION__" if v is None else str(v)


#: Partitions that one statement adds.
TOGETHER = 200


def point(spark: SparkSession, name: str, places: list[tuple[dict[str, object], str]]) -> list[str]:
    """Makes each path the place of its partition; returns the places that partitions had before.

    New partitions are added together, others change one by one.
    """
    there = known(spark, name)
    new = [(spec, path) for spec, path in places if tuple((k, as_text(v)) for k, v in spec.items()) not in there]
    for at in range(0, len(new), TOGETHER):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"{clause(spec)} LOCATION {literal(path)}" for spec, path in new[at : at + TOGETHER]))
    before, added = [], {path for _, path in new}
    for spec, path in places:
        if path not in added:
            before.append(place(spark, name, spec, check=False))
            spark.sql(f"ALTER TABLE {name} {clause(spec)} SET LOCATION {literal(path)}")
    return before


def retire(spark: SparkSession, name: str, paths: list[str]) -> None:
    """Notes folders that no partition names any more."""
    if paths:
        Files(spark).write_text(f"{place(spark, name)}/_versions/_retired/{int(time.time())}-{uuid.uuid4().hex}", "\n".join(paths))


def expire(spark: SparkSession, name: str, retained: float = RETAINED) -> list[str]:
    """Deletes folders retired for at least so many seconds; returns them."""
    files, gone = Files(spark), []
    for note in files.names(f"{place(spark, name)}/_versions/_retired"):
        if time.time() - int(note.rpartition("/")[2].partition("-")[0]) >= retained:
            for path in files.read_text(note).split("\n"):
                files.delete(path)
                gone.append(path)
            files.delete(note)
    return gone


def fitted(df: DataFrame, name: str, without: list[str]) -> DataFrame:
    """The columns of a table but for its partitions', in its order and types: columns it lacks are added to it, those ``df`` lacks are null."""
    spark = df.sparkSession
    known = spark.table(name).columns
    new = [f"`{c}` {kind}" for c, kind in df.dtypes if c not in known]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.table(name).schema if f.name not in without])


def publish(df: DataFrame, name: str, spec: dict[str, object], metrics: dict[str, Column] | None = None, gate: Callable[[dict], None] | None = None, retained: float = RETAINED) -> dict[str, object]:
    """Replaces one partition by ``df``, which is computed once, in one step for readers.

    A missing table is made.  No rows: the partition goes.  ``metrics`` (aggregates) are gathered while rows are
    written; ``gate`` sees them, with ``n_rows``, before anything is published, and what it raises leaves
    the table as it was, as do rows of another partition (ValueError).  Returns the metrics.
    """
    spark = df.sparkSession
    keys = list(spec)
    if not spark.catalog.tableExists(name):
        df.limit(0).write.partitionBy(*keys).format("parquet").saveAsTable(name)
    own = F.lit(True)
    for k, v in spec.items():
        own = own & F.col(k).eqNullSafe(F.lit(v))
    told = Observation(f"publish-{uuid.uuid4().hex}")
    seen = df.observe(told, F.count(F.lit(1)).alias("n_rows"), F.count_if(~own).alias("stray_"), *[c.alias(k) for k, c in (metrics or {}).items()])
    path = folder(spark, name)
    try:
        fitted(seen, name, keys).write.parquet(path)
        found = told.get
        if found.pop("stray_"):
            raise ValueError(f"{name}: rows outside {clause(spec)}")
        if gate:
            gate(found)
        if not found["n_rows"] and place(spark, name, spec) is None:
            Files(spark).delete(path)
            return found
        old = point(spark, name, [(spec, path)])
    except Exception:
        Files(spark).delete(path)
        raise
    if not found["n_rows"]:
        # by now the partition is an empty folder, which may go at once
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {clause(spec)}")
    retire(spark, name, old)
    expire(spark, name, retained)
    return found


def publish_many(df: DataFrame, name: str, keys: list[str], due: list[dict[str, object]] | None = None, retained: float = RETAINED, arranged: bool = False) -> list[dict[str, object]]:
    """Replaces every partition that ``df`` has rows of, and removes those of ``due`` that it has none of; returns the replaced ones.

    ``arranged``: rows of a partition lie in few tasks already, and are written as they lie, without another shuffle.

    One job writes all of them to a fresh folder before the first is published; each then changes in one step.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.limit(0).write.partitionBy(*keys).format("parquet").saveAsTable(name)
    path = folder(spark, name)
    rows = fitted(df, name, keys).columns
    kinds = {f.name: f.dataType for f in spark.table(name).schema}
    whole = df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in [*rows, *keys]])
    try:
        # files of a partition are of even size, whatever it holds
        (whole if arranged else whole.hint("rebalance", *keys)).write.partitionBy(*keys).parquet(path)
        written = spark.read.schema(whole.schema).parquet(path).select(*keys, F.col("_metadata.file_path").alias("file_")).distinct()
        places = written.select(*keys, F.regexp_replace("file_", "/[^/]*$", "").alias("folder_")).distinct().collect()  # a row a partition
    except Exception:
        Files(spark).delete(path)
        raise
    done = [{k: r[k] for k in keys} for r in places]
    before = point(spark, name, [(spec, Files.decoded(r["folder_"])) for spec, r in zip(done, places, strict=True)])
    for spec in due or []:
        if spec not in done and place(spark, name, spec) is not None:
            empty = folder(spark, name)
            fitted(df.limit(0), name, keys).write.parquet(empty)
            before += point(spark, name, [(spec, empty)])
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {clause(spec)}")
    retire(spark, name, before)
    expire(spark, name, retained)
    return done


#: Column by which a keyed table is cut into buckets of its keys' hash, and how many there are by default.
BUCKET, BUCKETS = "key_bucket", 64


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def keyed_table(df: DataFrame, name: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Makes an empty table with the columns of ``df``, partitioned by buckets of ``keys``; more data wants more buckets."""
    df.limit(0).withColumn(BUCKET, F.lit(0)).write.partitionBy(BUCKET).format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('keys' = {literal(','.join(keys))}, 'buckets' = '{buckets}')")


def buckets_of(spark: SparkSession, name: str) -> int:
    """How many buckets a table has; 0 if it isn't a keyed one."""
    if BUCKET not in spark.table(name).columns:
        return 0
    return int(spark.sql(f"SHOW TBLPROPERTIES {name} ('buckets')").first()["value"])


def rows_of(spark: SparkSession, name: str) -> DataFrame:
    """A keyed table's rows without the bucket column."""
    return spark.table(name).drop(BUCKET)


def upsert(df: DataFrame, name: str, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], retained: float = RETAINED) -> list[int]:
    """Merges a written frame into a keyed table, of which only the buckets of its keys are read and rewritten; returns these.

    ``merge(old, new)`` must leave the keys that are not in ``new`` as they are.  All buckets are written by one job before the
    first is published; each then changes in one step, and with it the rows of its keys.
    """
    spark = df.sparkSession
    buckets = buckets_of(spark, name)
    new = fitted(df, name, [BUCKET])
    hit = sorted(r[0] for r in new.select(bucket_of(keys, buckets)).distinct().collect())  # one number a bucket
    if not hit:
        return []
    old = spark.table(name).filter(F.col(BUCKET).isin(hit)).drop(BUCKET)
    out = merge(old, new).select(*old.columns).withColumn(BUCKET, bucket_of(keys, buckets))
    path = folder(spark, name)
    # files of a bucket are of even size, whatever it holds
    out.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    retire(spark, name, point(spark, name, [({BUCKET: b}, f"{path}/{BUCKET}={b}") for b in hit]))
    expire(spark, name, retained)
    return hit
