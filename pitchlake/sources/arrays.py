"""Files that hold one JSON array of records, of any size, read by as many tasks as they have blocks.

A file is read in pieces that end with ``}``, which every block of it can find by itself.  What a block can't know is whether
it begins within a string, and how deep.  So a first pass says of each block what it does in both cases (does it end within
a string, and by how much deeper); these summaries, a row a block, are combined from the first block on; and a second pass,
which knows how each block begins, cuts records.  A record that crosses a border of blocks comes in fragments, at
most two a block, which are joined afterwards.

Whatever stands between records at the array's own level (blanks, commas, numbers, lists) is left out, as is what follows the array.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ESCAPED = re.compile(r"\\.", re.DOTALL)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, value`` in the order of the file within each block; the ``}`` that ends a piece isn't in ``value``."""
    lines = spark.read.option("lineSep", "}").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def first_mark(spark: SparkSession, path: str) -> str | None:
    """The first character other than a blank."""
    found = pieces(spark, path).select(F.regexp_extract("value", r"^\s*(\S)", 1).alias("c")).filter("c <> ''").first()
    return found["c"] if found else None


def outside(piece: str) -> tuple[str, str, bool]:
    """What of a piece is outside of strings if it begins so, and if it begins within one; and whether it changes between the two."""
    if "\\" in piece:
        piece = ESCAPED.sub("", piece)  # outside of strings there are none
    parts = piece.split('"')
    return "".join(parts[0::2]), "".join(parts[1::2]), len(parts) % 2 == 0


def deeper(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


SUMMARY = "file string, block long, deeper_out long, inside_out boolean, deeper_in long, inside_in boolean"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at: tuple | None = None
    state = [0, False, 0, True]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in SUMMARY.split(", ")], [*at, *state], strict=True))], schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("deeper_out", pa.int64()), ("inside_out", pa.bool_()), ("deeper_in", pa.int64()), ("inside_in", pa.bool_())]))

    for batch in batches:
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != at:
                if at:
                    yield row()
                at, state = (file, block), [0, False, 0, True]
            out, within, odd = outside(value + "}")
            plus = (deeper(out), deeper(within))
            for k in (0, 2):
                state[k] += plus[state[k + 1]]
                state[k + 1] ^= odd
    if at:
        yield row()


def _starts(group: pd.DataFrame) -> pd.DataFrame:
    """How each block of a file begins."""
    inside, depth, rows = False, 0, []
    for r in group.sort_values("block").itertuples():
        rows.append((r.file, r.block, inside, depth))
        depth += r.deeper_in if inside else r.deeper_out
        inside = bool(r.inside_in if inside else r.inside_out)
    return pd.DataFrame(rows, columns=["file", "block", "inside", "depth"])


def _cut(whole: bool):
    """Records that lie in one block, or the fragments of the others: ``file, block, part, opens, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        inside, depth, held, opened = False, 0, [], False
        for batch in batches:
            out: list[tuple] = []
            for file, block, value, begins_inside, begins_depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, block) != at:
                    if held and not whole:
                        out.append((*at, 1, opened, "".join(held)))
                    at, inside, depth, held = (file, block), begins_inside, begins_depth, []
                    opened = False  # what is held at first was opened by another block
                piece = value + "}"
                plain, within, odd = outside(piece)
                if depth <= 1 and not inside:
                    # only here may a record, or the array itself, begin
                    begin = piece.find("{", piece.find("[") + 1 if depth == 0 else 0)
                    if begin >= 0 and (depth == 1 or "[" in piece):
                        held, opened = [piece[begin:]], True
                else:
                    held.append(piece)
                depth += deeper(within if inside else plain)
                inside ^= odd
                if depth <= 1 and not inside and held:
                    if opened == whole:
                        out.append((*at, 0, opened, "".join(held)))
                    held, opened = [], False
            if out:
                yield _rows(out)
        if held and not whole:
            yield _rows([(*at, 1, opened, "".join(held))])

    return run


PARTS = "file string, block long, part int, opens boolean, text string"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[c.split()[0] for c in PARTS.split(", ")])


def records(spark: SparkSession, path: str) -> DataFrame:
    """``text`` of every record of the arrays in a file or folder."""
    starts = pieces(spark, path).mapInArrow(_summaries, SUMMARY).groupBy("file").applyInPandas(_starts, "file string, block long, inside boolean, depth long")
    # a row a block: a millionth of the data, and the blocks keep their order
    told = pieces(spark, path).join(F.broadcast(starts), ["file", "block"]).select("file", "block", "value", "inside", "depth")
    whole = told.mapInArrow(_cut(True), PARTS).select("text")
    parts = told.mapInArrow(_cut(False), PARTS)
    number = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, 0))  # two rows a block at most
    ordered = F.array_sort(F.collect_list(F.struct("block", "part", "text")))
    joined = parts.withColumn("number", number).groupBy("file", "number").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "").alias("text"))
    return whole.unionByName(joined.select("text"))


def shown_kind(kinds: set[str]) -> str:
    """The type of a field by the kinds its values show (as ``schema_of_variant`` names them): numbers, truth values, else text."""
    plain = {k.partition("(")[0].partition("<")[0] for k in kinds} - {"VOID"}
    if plain and plain <= {"BIGINT"}:
        return "bigint"
    if plain and plain <= {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}:
        return "double"
    return "boolean" if plain == {"BOOLEAN"} else "string"


def fields(texts: DataFrame) -> dict[str, str]:
    """Field -> :func:`shown_kind`, over all records."""
    entries = texts.select(F.explode(F.map_entries(F.try_parse_json("text").try_cast("map<string,variant>"))).alias("e"))
    seen = entries.select(F.col("e.key").alias("k"), F.regexp_extract(F.schema_of_variant("e.value"), "^[A-Z]+", 0).alias("kind")).groupBy("k").agg(F.collect_set("kind").alias("kinds"))
    return {r["k"]: shown_kind(set(r["kinds"])) for r in seen.orderBy("k").collect()}  # columns of one table


def typed(texts: DataFrame, schema: StructType) -> DataFrame:
    """Records as rows; values that don't fit a field's type are null, as the JSON reader has them."""
    return texts.select(F.from_json("text", schema).alias("r")).select("r.*")
