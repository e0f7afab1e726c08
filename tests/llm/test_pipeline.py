"""The corpus pipeline, stage by stage, against brute force on the smallest tables and on odd rows."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pitchlake.llm import pii, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LONG = "word " * 30_000
ODD = [
    (900_001, None, "en", "a", None),
    (900_002, "", "en", "a", 0),
    (900_003, LONG, "en", None, 150_000),
    (900_004, LONG, "en", "b", 150_000),
    (900_005, "one two three four five six", None, "b", 27),
    (900_005, "one two three four five six", None, "b", 27),
    (None, "one two three four five six", "en", "c", 27),
    (900_006, "mail bob (at) site (dot) org or 10.0.0.1 now", "en", "c", 45),
    (900_007, "you idiot you moron you stupid worthless scum", "en", "c", 44),
]


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the written output of every stage, over sf0.001 and odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(ODD, docs.schema))
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        out[name] = docs
    return out


def rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def test_stages_are_those_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "personal_data", "packing"]


def test_toxic_documents_go(spark, stages):
    docs = stages["documents"]
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r for r in rows(docs) if model.scores([r[1]])[0] < 0.5]
    assert stages["toxicity"].columns == COLUMNS and rows(stages["toxicity"]) == want
    assert len(want) < docs.count() and 900_007 not in {r[0] for r in want} and {900_001, 900_002, None} <= {r[0] for r in want}


def test_one_of_each_class_stays(stages):
    before = rows(stages["toxicity"])
    texts = {}
    for r in before:
        if r[0] is not None:
            texts.setdefault((r[0], r[1] or ""), set())
    for key in texts:
        words = key[1].translate({c: c + 32 for c in range(65, 91)}).split()
        texts[key] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    up = {k: k for k in texts}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if texts[a] and texts[b] and len(texts[a] & texts[b]) >= 0.8 * len(texts[a] | texts[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    want = [r for r in before if r[0] is None or find((r[0], r[1] or ""))[0] == r[0]]
    assert rows(stages["near_duplicates"]) == want and len(want) < len(before)
    ids = [r[0] for r in want]
    assert ids.count(900_005) == 2 and 900_003 in ids and 900_004 not in ids and None in ids


def test_personal_data_is_replaced(stages):
    weights = pii.train()
    want = []
    for d, text, lang, source, n in rows(stages["near_duplicates"]):
        new = pii.redacted(text, weights)
        want.append((d, new, lang, source, n if new is None else len(new)))
    got = rows(stages["personal_data"])
    assert got == sorted(want, key=repr)
    by_id = {r[0]: r[1] for r in got}
    assert by_id[900_006] == "mail <email> or <ip> now" and by_id[900_001] is None


def test_everything_is_packed(stages):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = stages["packing"].toPandas()
    docs = rows(stages["personal_data"])
    assert out["length"].sum() == sum(len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in docs)
    assert (out["piece"] == 0).sum() == len(docs)
    for _, s in out.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert list(s["offset"]) == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 1024


def test_run_is_the_stages_one_after_another(spark, stages, tmp_path):
    stages["documents"].write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    piece = lambda df: sorted(map(tuple, df.select("doc_id", "piece", "start", "length", "ids_crc32").collect()), key=repr)
    assert piece(got) == piece(stages["packing"])


def test_empty_and_wider_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
    wide = spark.createDataFrame([(1, "call 555-123-4567 today please", "en", "s", 30, "mine", 3.0)], "doc_id long, text string, lang string, source string, n_chars long, th string, score double")
    for _, stage in corpus_pipeline.STAGES[:3]:
        wide = stage(spark, wide, SF)
        assert wide.columns[5:] == ["th", "score"] and tuple(wide.first())[5:] == ("mine", 3.0)
    assert wide.first()["text"] == "call <phone> today please"
