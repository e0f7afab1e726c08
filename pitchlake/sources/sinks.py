"""Sinks and table management on catalog tables of Parquet files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.scalars import quote_ident, slug
from pitchlake.sources import versions
from pitchlake.sources.files import Files


def audited(df: DataFrame) -> DataFrame:
    """Adds ``processed_at``; only sinks do, so that transforms stay deterministic."""
    return df.withColumn("processed_at", F.current_timestamp())


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quote_ident(name)}")


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def staged(df: DataFrame, near: str) -> DataFrame:
    """``df``, written once to the folder that the cluster shares (beside the tables, if it names none) and read back, so that checks don't compute it again."""
    spark = df.sparkSession
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{shared.rstrip('/')}/_staging/{near}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstaged(df: DataFrame) -> None:
    """Deletes what :func:`staged` wrote."""
    Files(df.sparkSession).delete(df._staged_path)


def aligned(df: DataFrame, name: str) -> DataFrame:
    """The columns of a table, in its order: those it lacks are added to it, those ``df`` lacks are null."""
    spark = df.sparkSession
    for c, kind in df.dtypes:
        if c not in spark.table(name).columns:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{c}` {kind})")
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(name).schema])


def write_partitioned(df: DataFrame, name: str, season: int, league: str, metrics: dict[str, Column] | None = None, gate: Callable[[dict], None] | None = None) -> dict[str, object]:
    """Idempotent write of one (season, league) partition, in one step for readers (:func:`pitchlake.sources.versions.publish`).

    Absent tables are made, partitioned by season and league.  In present ones
    the partition is replaced; an empty frame removes it, so no stale rows stay.
    Rows of another season or league are an error.  ``df`` is computed once; no other partition is touched.
    """
    return versions.publish(df, name, {"season": int(season), "league": league}, metrics, gate)


def write_optional(df: DataFrame | None, name: str, season: int, league: str) -> bool:
    """Writes only if there is something to write."""
    if df is None or df.isEmpty():
        return False
    write_partitioned(df, name, season, league)
    return True


def create_or_replace(df: DataFrame, name: str) -> None:
    df.write.format("parquet").mode("overwrite").saveAsTable(name)


def drop_tables(spark: SparkSession, names: list[str]) -> None:
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def add_column(spark: SparkSession, name: str, column: str, kind: str) -> None:
    if column not in spark.table(name).columns:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({quote_ident(column)} {kind})")


def updated(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """Row update: new values where the predicate holds."""
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})


def rewrite_table(df: DataFrame, name: str) -> None:
    """Replaces a table by a frame that reads it: written beside it first, then renamed."""
    spark = df.sparkSession
    beside = f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    df.write.format("parquet").saveAsTable(beside)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")


def json_array(df: DataFrame, *group: str) -> DataFrame:
    """One JSON array of records per group (all rows: a small table); an empty frame gives []."""
    rows = F.to_json(F.coalesce(F.collect_list(F.struct(*df.columns)), F.array()), {"ignoreNullFields": "false"}).alias("json")
    return df.groupBy(*group).agg(rows) if group else df.agg(rows)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    if not df.isEmpty():
        df.write.mode("append").json(path)


def fan_out(df: DataFrame, key: str, path: str) -> None:
    """A CSV folder for each key, by its slug."""
    df.withColumn(f"{key}_slug", slug(F.col(key).cast("string"))).write.mode("overwrite").partitionBy(f"{key}_slug").option("header", True).csv(path)


def run_outputs(frames: dict[str, DataFrame], root: str) -> dict[str, str]:
    """One CSV folder a name for a whole run, such as all match sheets; name -> path."""
    out = {}
    for name, df in frames.items():
        out[name] = f"{root.rstrip('/')}/{name}"
        write_csv(df, out[name])
    return out


def swap_folder(spark: SparkSession, new: str, old: str) -> None:
    """Puts a written folder in the place of the file or folder it was computed from, which is kept aside until then."""
    files, aside = Files(spark), f"{old}__old"
    if files.exists(old):
        files.rename(old, aside)
    files.rename(new, old)
    files.delete(aside)


def move_file(spark: SparkSession, path: str, to: str) -> str:
    """Moves a file; a name that is taken gets a number."""
    files = Files(spark)
    stem, dot, suffix = to.rpartition(".") if "." in to.rpartition("/")[2] else (to, "", "")
    place, n = to, 1
    while files.exists(place):
        place = f"{stem}_{n}{dot}{suffix}"
        n += 1
    files.rename(path, place)
    return place


def move_processed(spark: SparkSession, paths: list[str | None], root: str) -> dict[str, str]:
    """Moves each distinct existing file once, to its place under ``root``/processed; path -> new place."""
    files, base, out = Files(spark), root.rstrip("/"), {}
    for p in dict.fromkeys(p.strip() for p in paths if p and p.strip()):
        if files.is_file(p):
            rest = p[len(base) + 1 :] if p.startswith(base + "/") else p.rpartition("/")[2]
            out[p] = move_file(spark, p, f"{base}/processed/{rest}")
    return out


def moved(paths: DataFrame, root: str) -> DataFrame:
    """Moves each distinct existing file of ``path`` to its place under ``root``/processed, by the tasks: ``path, moved_to`` of those that moved.

    Files that want the same place meet in one task, where those after the first get a number.  A task that is repeated after some of its
    files have moved finds these in their places.  The result is written once; nobody should compute it again.
    """
    base = root.rstrip("/")
    own = F.btrim("path")
    rest = F.when(F.startswith(own, F.lit(base + "/")), F.substr(own, F.lit(len(base) + 2))).otherwise(F.substring_index(own, "/", -1))
    wanted = paths.filter(F.coalesce(own != "", F.lit(False))).select(own.alias("path"), F.concat(F.lit(f"{base}/processed/"), rest).alias("place")).distinct()

    def local(path: str) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, old = local(path)
                there = lambda p: system.get_file_info(p).type == fs.FileType.File  # noqa: B023, E731
                to, n = place, 0
                stem, dot, suffix = place.rpartition(".") if "." in place.rpartition("/")[2] else (place, "", "")
                if there(old):
                    while there(local(to)[1]):
                        n += 1
                        to = f"{stem}_{n}{dot}{suffix}"
                    target = local(to)[1]
                    system.create_dir(target.rpartition("/")[0], recursive=True)
                    system.move(old, target)
                elif not there(local(to)[1]):
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([to], pa.string())], names=["path", "moved_to"])

    return staged(wanted.repartition("place").sortWithinPartitions("place", "path").mapInArrow(run, "path string, moved_to string"), "moved")


def store(df: DataFrame, name: str, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    """Merges rows into a table, which is made (in buckets of its keys) or given new columns as needed.

    Only the buckets that hold keys of ``df`` are rewritten.  A table that was made without buckets is
    appended to if no key is known yet, and rewritten otherwise.
    """
    spark = df.sparkSession
    rows = staged(df, name)
    try:
        if not exists(spark, name):
            versions.keyed_table(merge(rows.limit(0), rows), name, keys)
        if versions.buckets_of(spark, name):
            versions.upsert(rows, name, keys, merge)
            return
        new = aligned(rows, name)
        old = spark.table(name)
        if old.join(new.select(*keys).distinct(), keys, "left_semi").isEmpty():
            merge(old.limit(0), new).select(*old.columns).write.format("parquet").mode("append").saveAsTable(name)
        else:
            rewrite_table(merge(old, new).select(*old.columns), name)
    finally:
        unstaged(rows)
