"""Arrays of records in blocks of a few bytes against Python's own parser."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pitchlake.sources import arrays, readers

NASTY = ['plain', 'a}b', '{[', '\\', '"', '\\"}', '}\n{', 'é}漢字{"', ' ', '{"x":[1,2]}', '']


def record(rng, i):
    v = lambda: rng.choice([*NASTY, i, i / 3, None, True, [], {}])
    return {"id": i, "a": rng.choice(NASTY), "b}": v(), "deep": {"x": [v(), {"y": rng.choice(NASTY)}, [[]]], "{": v()}, **({"long": rng.choice(NASTY) * 200} if rng.random() < 0.1 else {})}


@pytest.mark.parametrize("block,indent,many", [(48, None, 60), (333, 1, 60), (100_000, None, 60), (64, None, 0)])
def test_records_over_block_borders(spark, tmp_path, block, indent, many):
    rng = random.Random(block)
    want = []
    for f in range(2):
        rows = [record(rng, 100 * f + i) for i in range(many)]
        want += rows
        text = json.dumps(rows, ensure_ascii=bool(f), indent=indent)
        (tmp_path / f"part{f}.json").write_text(" \n" + text + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        if many and block < 1000:
            assert arrays.pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 20
        got = [json.loads(r[0]) for r in arrays.records(spark, str(tmp_path)).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(got, key=lambda r: r["id"]) == want


def test_arrays_are_typed(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('[{"game":"g","season":2024,"n":1,"x":1},{"game":null,"n":2,"x":1.5,"t":true,"o":{"a":[1]},"z":null}, 5, {"season":"junk","s":"é"}]')
    df = readers.bronze(spark, str(path), "game string, season int", "home_score string")
    assert dict(df.dtypes) == {"game": "string", "season": "int", "n": "bigint", "x": "double", "t": "boolean", "o": "string", "z": "string", "s": "string"}
    got = {(r["game"], r["season"], r["n"], r["x"], r["t"], r["o"], r["s"]) for r in df.collect()}
    assert got == {("g", 2024, 1, 1.0, None, None, None), (None, None, 2, 1.5, True, '{"a":[1]}', None), (None, None, None, None, None, None, "é")}
    assert readers.json_rows(spark, str(path), "game string, n int").agg(F.sum("n")).first()[0] == 3
    path.write_text('{"game":"alone"}')
    assert readers.json_rows(spark, str(path), "game string").first()[0] == "alone"
