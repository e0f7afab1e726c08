"""Readers: explicit schemas, bad lines kept, optional inputs decided without a full count."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitchlake import schemas
from pitchlake.operators.ingest import object_of, parsed_messages
from pitchlake.sources import arrays


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file (or folder of files) that holds an array of records, read in as many tasks as it has blocks; one record alone is read as well."""
    if arrays.first_mark(spark, path) in ("[", None):
        return arrays.typed(arrays.records(spark, path), StructType.fromDDL(schema))
    return spark.read.option("multiLine", True).schema(schema).json(path)


def optional_json(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The rows, or None if the path is missing or holds none."""
    try:
        df = json_rows(spark, path, schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return None if df.isEmpty() else df


def bronze(spark: SparkSession, path: str, columns: str, more: str = "") -> DataFrame:
    """All records of a Bronze file or folder: an array of records, or a record a line.

    ``columns`` are always there, with these types; those of ``more`` only if
    the data has them; any others (statistics) have the type they show.  An
    empty array or folder gives no rows.
    """
    array = arrays.first_mark(spark, path) == "["
    typed = {f.name: f for part in (columns, more) if part for f in StructType.fromDDL(part)}
    base = StructType.fromDDL(columns).names
    if array:
        texts = arrays.records(spark, path)
        seen = StructType.fromDDL(", ".join(f"`{k.replace('`', '``')}` {kind}" for k, kind in arrays.fields(texts).items()))
    else:
        seen = spark.read.json(path).schema
    chosen = StructType([typed.get(f.name, f) for f in seen if f.name != "_corrupt_record"] + [typed[c] for c in base if c not in seen.names])
    return arrays.typed(texts, chosen) if array else spark.read.schema(chosen).json(path)


def optional_bronze(spark: SparkSession, path: str, columns: str, more: str = "") -> DataFrame | None:
    """:func:`bronze`, or None if the path is missing or holds no record."""
    try:
        df = bronze(spark, path, columns, more)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return None if df.isEmpty() else df


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def jdbc_table(spark: SparkSession, url: str, name: str, key: str, bounds: tuple[int, int], parts: int = 8, **options: str) -> DataFrame:
    """A database table, read in ranges of a numeric key so that no task reads it whole; filters and columns are pushed down."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.options(**options).load()


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in an order; 0 or less means all."""
    return df.orderBy(*order).limit(n) if n > 0 else df


def partition_scan(df: DataFrame, season: int, league: str) -> DataFrame:
    """Rows of one season and league: bare partition columns, so that files are pruned."""
    return df.filter((F.col("season") == season) & (F.col("league") == league))


def in_memory(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def game_ids(schedule: DataFrame) -> DataFrame:
    """Slim (game, game_id) frame of known ids, the least per game."""
    return schedule.filter(F.col("game_id").isNotNull()).groupBy("game").agg(F.min("game_id").alias("game_id"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_no, raw`` of a text file or folder, in the order of files and lines, from 0.

    Lines are numbered within the block of a file that one task reads; a small
    table of blocks says how many lines come before each.
    """
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a block
    offsets = blocks.select("file", "block", before.alias("before"))
    own = F.row_number().over(Window.partitionBy("file", "block").orderBy("at"))
    return lines.withColumn("own", own).join(offsets, ["file", "block"]).select((F.col("before") + F.col("own") - 1).alias("line_no"), "raw")


def jsonl_queue(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(messages with line_no, failures with the raw line) of a queue file; blank and non-object lines fail."""
    return parse_lines(numbered_lines(spark, path))


def parse_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits ``line_no, raw`` into messages (see :func:`pitchlake.operators.ingest.parsed_messages`) and failures: lines that aren't a JSON object."""
    whole = object_of("raw").isNotNull()
    failed = lines.filter(~whole).select("line_no", F.col("raw").alias("raw_line"), F.lit("json_decode_error").alias("error"))
    return parsed_messages(lines, "line_no"), failed


def json_payloads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, payload`` (a variant, null if the file isn't JSON) of whole files, in one read; ``file`` is the qualified path."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col("path").alias("file"), F.try_parse_json(F.decode("content", "UTF-8")).alias("payload"))


def csv_payload(spark: SparkSession, path: str) -> DataFrame:
    """``meta_row_index, row`` (a variant) of one CSV file with a header; empty cells are null.  ValueError without a column."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if not df.columns:
        raise ValueError("No columns to parse from file")
    # one file's lines are read in order; a payload is one message's, so one task numbers it
    order = Window.partitionBy(F.lit(0)).orderBy(F.monotonically_increasing_id())
    row = F.parse_json(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}))
    return df.select((F.row_number().over(order) - 1).alias("meta_row_index"), row.alias("row"))


def _documents(spark: SparkSession, pattern: str, id_pattern: str, id_name: str, schema: str) -> DataFrame:
    """One row per matching JSON file: the id in its name, its raw text, and the parsed fields (null where it isn't JSON)."""
    raw = spark.read.text(pattern, wholetext=True).select(F.regexp_extract(F.input_file_name(), id_pattern, 1).alias(id_name), F.col("value").alias("_raw"))
    good = F.try_parse_json("_raw").isNotNull()
    return raw.withColumn("d", F.from_json(F.when(good, F.col("_raw")), schema)).select(id_name, "_raw", good.alias("readable"), "d.*")


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Cached match summaries; the id comes from the file name, corrupt files are skipped (:func:`unreadable_summaries` lists them)."""
    docs = _documents(spark, f"{folder}/Summary_*.json", r"Summary_(\d+)", "game_id", schemas.SUMMARY)
    return docs.filter("readable").drop("_raw", "readable").withColumn("game_id", F.col("game_id").cast("bigint"))


def unreadable_summaries(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """``game_id`` of corrupt summaries and, of the ``wanted`` games (``game_id``), those without a file."""
    docs = _documents(spark, f"{folder}/Summary_*.json", r"Summary_(\d+)", "game_id", schemas.SUMMARY).select(F.col("game_id").cast("bigint").alias("game_id"), "readable")
    bad = docs.filter(~F.col("readable")).select("game_id")
    return bad if wanted is None else bad.unionByName(wanted.select(F.col("game_id").cast("bigint").alias("game_id")).distinct().join(docs, "game_id", "left_anti"))


def profiles(spark: SparkSession, folder: str, requested: DataFrame | None = None) -> DataFrame:
    """Offline athlete profiles (athlete_<id>.json): ``requested_id`` from the file name, the fields, and the raw text.

    With ``requested`` (ids), one row for each: all fields are null where the
    file is missing or corrupt, as after a failed request; without it corrupt files are skipped.
    """
    docs = _documents(spark, f"{folder}/athlete_*.json", r"athlete_(\d+)", "requested_id", schemas.PROFILE).filter("readable").drop("readable")
    if requested is None:
        return docs
    return requested.select(F.col("requested_id").cast("string").alias("requested_id")).distinct().join(docs, "requested_id", "left")
