"""Training-data operators against brute force, round trips and held-out accuracy, with odd inputs."""

import pickle
import re
import subprocess
import sys
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitchlake.llm.common import components
from pitchlake.llm import bpe, jaccard, lattice, mixing, neighbours, packing, pii, tools, toxicity, urls

DATA = "/root/testdata/sf0.001"
WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [(1, "", "x"), (2, None, "x"), (3, "a " * 5000, "x"), (4, "Call +1 (017) 555-7713", "x"), (4, "Call +1 (017) 555-7713", "x"), (5, "é" * 3000, None), (6, "<|endoftext|> Ab'S", "y"), (None, "no id", "z")]
SCHEMA = "doc_id long, text string, score string"  # a column whose name clashes with results


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_bpe_equals_library(spark, docs, odd):
    t, own = Tokenizer.from_file(WORD), bpe.WordBpe(WORD)
    texts = [r[0] for r in docs.select("text").collect()] + [r[1] or "" for r in ODD] + ["ΑΣ ΟΔΟΣ's", "12½ ÅéÀ İ 漢字 !!?", "'" * 40]
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        assert own.encode(x) == ids and own.decode(ids) == t.decode(ids, skip_special_tokens=False)
    got = bpe.encode_documents(odd, WORD).collect()
    assert len(got) == len(ODD) and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert bpe.encode_documents(odd.limit(0), WORD).count() == 0


def test_packing_is_whole(spark, docs, odd):
    t = Tokenizer.from_file(BYTE)
    for df in (docs, odd):
        out = packing.pack_documents(df, BYTE).toPandas()
        want = [len(t.encode(r[0] or "", add_special_tokens=False).ids) + 1 for r in df.select("text").collect()]
        assert out["length"].sum() == sum(want) and out["length"].max() <= 1024
        for _, s in out.groupby("sequence_id"):
            s = s.sort_values("offset")
            assert list(s["offset"]) == [0, *np.cumsum(s["length"])[:-1]] and s["length"].sum() <= 1024
        assert ((out["piece"] == 0) | (out["length"] == 1024)).all()
    ids = np.array([*t.encode(ODD[3][1], add_special_tokens=False).ids, 2], "<u4")
    assert set(out[out["doc_id"] == 4]["ids_crc32"]) == {zlib.crc32(ids.tobytes())}
    assert packing.pack_documents(odd.limit(0), BYTE).count() == 0


def test_genetic_packing_improves_on_best_fit(spark):
    """On all open pieces of sf0.01 the search at its production settings needs fewer bins than best fit, and a random instance no more."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table = spark.createDataFrame(packing.pieces(docs, BYTE).collect(), packing.PIECES)
    out = packing.pack(table).toPandas()
    open_ = out[out["length"] < 1024]
    size = sorted(open_["length"].tolist(), reverse=True)
    best = len(packing.best_fit(list(range(len(size))), size, 1024))
    assert best == 456 and open_["sequence_id"].nunique() <= 455 and -(-sum(size) // 1024) == 454
    assert open_.groupby("sequence_id")["length"].sum().max() <= 1024 and len(out) == table.count()
    size = np.random.default_rng(3).integers(300, 700, 400).tolist()
    order = sorted(range(len(size)), key=lambda i: -size[i])
    found = packing.evolve(size, 1024, 1, [])
    assert sorted(i for x in found for i in x) == list(range(400)) and len(found) <= len(packing.best_fit(order, size, 1024))


def test_packing_operators_keep_every_piece():
    import random

    rng, size = random.Random(4), np.random.default_rng(4).integers(1, 900, 300).tolist()
    order = sorted(range(300), key=lambda i: -size[i])
    one, two = packing.best_fit(order, size, 1024), packing.best_fit(order[::-1], size, 1024)
    for child in (packing.crossover(one, two, size, 1024, rng), packing.crossover(two, one, size, 1024, rng), packing.mutated(one, size, 1024, rng), packing.mutated([[0]], size, 1024, rng)):
        n = sum(map(len, child))
        assert sorted(i for x in child for i in x) == list(range(n)) and n in (1, 300) and all(x and sum(size[i] for i in x) <= 1024 for x in child)
    bins = [list(x) for x in two if len(x) > 1]
    loose = [i for x in two if len(x) <= 1 for i in x]
    before = sum(size[i] for i in loose)
    used = packing.filling(bins, size)
    left = packing.exchange(bins, loose, size, 1024, rng, used)
    assert used == packing.filling(bins, size)
    assert sum(size[i] for i in left) <= before and all(sum(size[i] for i in x) <= 1024 for x in bins)
    assert sorted([i for x in bins for i in x] + left) == list(range(300))


def test_fast_encoder_equals_library_on_long_runs():
    t, own = Tokenizer.from_file(BYTE), packing.byte_bpe(BYTE)
    for x in ("a" * 9000, " " * 9000, "\n" * 5000 + "x", "1" * 5000, "é" * 3000, "a\u0300" * 500, "  x\t\ty  ", "<|endoftext|>" * 3 + " z"):
        assert own.encode(x) == t.encode(x, add_special_tokens=False).ids


def brute_pii(x):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, x):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "ip" and all(int(p) < 256 for p in m.group().split(".")) or kind == "card" and 14 <= len(d) <= 19 and pii.luhn(d) or kind == "phone" and 10 <= len(d) <= 15:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_pii_base_and_field(spark, docs, odd):
    rng = np.random.default_rng(1)
    for _ in range(3000):
        x = "".join(rng.choice(list("0123456789..@@ab-+ ()_1234"), rng.integers(0, 50)))
        assert pii.base_spans(x) == brute_pii(x)
    text = "see 4451718024887799 4845168114407329 ok"
    base, spans = pii.find_spans(text, pii.train())
    assert base == [] and spans == [("card", 4, 20), ("card", 21, 37)] if pii.luhn("4451718024887799") and pii.luhn("4845168114407329") else True
    assert all(s in pii.find_spans(t[0] or "", pii.train())[1] for t in docs.select("text").collect() for s in brute_pii(t[0] or ""))
    assert {r["n_phone"] for r in pii.scan(odd).collect() if r["doc_id"] == 4} == {1}
    kept = pii.redact(odd)
    assert kept.columns == odd.columns and kept.filter("text like '%<phone>%'").count() == 2 and kept.filter("text is null").count() == 1
    assert pii.scan(odd.limit(0)).count() == 0


def shingle_set(x):
    w = re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m.group().lower(), x or "").strip(" \t\n\x0b\x0c\r"))
    w = [y for y in w if y]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_against_all_pairs(spark, docs, odd):
    near = spark.createDataFrame([(9000 + k, " ".join(f"w{i}" if i != k else "other" for i in range(80))) for k in range(12)], "doc_id long, text string")
    df = docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text").filter("doc_id <> 4")).unionByName(near)
    df = df.withColumn("doc_id", F.col("doc_id") * 10 + F.when(F.col("text").isNull(), 1).otherwise(0))
    got = {r["doc_id"]: r for r in jaccard.classes(df).collect()}
    sets = [(r[0], shingle_set(r[1])) for r in df.collect() if r[0] is not None]
    links = {i: 0 for i, _ in sets}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and len(a & b) * 10 >= 8 * len(a | b):
                if i != j:
                    links[i] += 1
                    links[j] += 1
    ids = [i for i, _ in sets]
    single = [i for i in ids if ids.count(i) == 1]
    assert {i: got[i]["n_links"] for i in single} == {i: links[i] for i in single}
    assert jaccard.classes(df.limit(0)).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns and {r[0] for r in kept.collect()} == {r[0] for r in ODD}


def test_shared_blocks_of_one_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = [(k, " ".join(f"w{i}" if i != k else "other" for i in range(100))) for k in range(30)]
    got = jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    sets = [shingle_set(t) for _, t in rows]
    want = [sum(len(a & b) * 10 >= 8 * len(a | b) for b in sets) - 1 for a in sets]
    assert [r["n_links"] for r in sorted(got, key=lambda r: r["doc_id"])] == want


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 64))
    rows = [(i, [float(x) for x in base[i % 20] + (0.01 if i >= 20 else 0) * base[i]], i % 2) for i in range(60)]
    rows += [(100, None, 0), (101, [0.0] * 64, 0), (102, [float("nan")] * 64, 0), (103, [None] * 64, 1), (104, rows[0][1], None), (0, rows[0][1], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rows


def test_lattice_against_all_pairs(vectors):
    df, rows = vectors
    got = {}
    for r in lattice.near_duplicates(df).collect():
        got.setdefault(r["vec_id"], r)
    ok = [(i, np.array(v), y) for i, v, y in rows if v and None not in v and np.isfinite(v).all() and any(v) and y is not None]
    cos = lambda a, b: a @ b / np.sqrt((a @ a) * (b @ b))
    for i, v, y in ok:
        want = sum(y == z and cos(v, w) >= 0.98 for _, w, z in ok) - 1
        assert got[i]["n_links"] == want
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (100, 101, 102, 103, 104))
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 8)) * 2
    p = lattice.nearest_e8(x)
    d = ((x - p) ** 2).sum(axis=1)
    for v in lattice.MINIMAL:
        assert (((x - p - v) ** 2).sum(axis=1) >= d - 1e-9).all()
    assert len(lattice.MINIMAL) == 240


@pytest.mark.parametrize("n,kind", [(500, "gauss"), (2000, "gauss"), (8000, "gauss"), (2000, "table")])
def test_neighbours_recall_by_size(n, kind):
    """On vectors without any structure, and on the table's own, one block finds at least 0.94 of the 20 nearest."""
    x = np.random.Generator(np.random.PCG64(3)).standard_normal((n, 64))
    if kind == "table":
        x = np.array([v for v in pd.read_parquet("/root/testdata/sf0.1/embeddings.parquet")["embedding"] if v is not None and np.isfinite(v).all() and np.any(v)], float)[:n]
    asked = np.arange(0, n, 20)
    hit = 0
    for i, found in zip(asked, neighbours.search_block(x, x[asked], float(np.sqrt((x * x).sum(axis=1)).max()), 21), strict=True):
        s = x @ x[i]
        s[i] = -np.inf
        hit += len(set(np.argsort(-s)[:20]) & set(found))
    assert hit / (20 * len(asked)) >= 0.94, hit / (20 * len(asked))


@pytest.mark.parametrize("rows,queries", [(8192, 8192), (250, 15)])
def test_neighbours_recall_and_scores(spark, vectors, rows, queries):
    """In one block, and over eight blocks of rows and three of queries."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = neighbours.search(df, lambda i: F.pmod(i, F.lit(50)) == 0, rows=rows, queries=queries).toPandas()
    t = df.toPandas()
    x, ids = np.array(t.embedding.tolist(), float), t.vec_id.to_numpy()
    hit = 0
    for q, g in got.groupby("query_id"):
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        best = np.lexsort((ids, -s))[:20]
        hit += len(set(ids[best]) & set(g["vec_id"]))
        assert list(g.sort_values("rank")["rank"]) == list(range(1, 21)) and np.allclose(g["score"], [s[ids == v][0] for v in g["vec_id"]], atol=1e-12)
    assert got["query_id"].nunique() == (ids % 50 == 0).sum() and hit / (20 * got["query_id"].nunique()) >= 0.9
    small = neighbours.search(vectors[0], lambda i: i == 104).collect()
    assert len(small) == 20 and small[0]["query_id"] == 104
    assert neighbours.search(vectors[0].limit(0), lambda i: i == 0).count() == 0


def test_toxicity_held_out_and_odd(spark, odd):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    t = toxicity.score(docs, model).join(labels, "doc_id").toPandas()
    h = t[t["held_out"]]
    assert (h["predicted"] == h["toxic"]).mean() > 0.95
    print("toxicity: agreement of held-out rows", (h["predicted"] == h["toxic"]).mean(), "cues", len(model.cues), dict(zip(toxicity.FEATURES, model.weights.round(2))))
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(odd.limit(0), model).count() == 0
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    empty = toxicity.fit(odd, labels.limit(0))
    assert empty.scores(["you idiot"])[0] > empty.scores(["fine"])[0]


def test_automaton_against_edit_distance():
    m = toxicity.Matcher(["idiot", "moron", "scum"], ["vequ"])

    def near(a, b):
        edits = {b[:i] + c + b[j:] for i in range(len(b) + 1) for j in (i, i + 1) for c in ["", *"abcdefghijklmnopqrstuvwxyz0123456789"]}
        swapped = {b[:i] + b[i + 1] + b[i] + b[i + 2 :] for i in range(len(b) - 1)}
        return a in edits | swapped or a == b

    words = [*{x[:i] + x[i + 1] + x[i] + x[i + 2 :] for x in ("idiot", "moron") for i in range(4)}, "idoti", "diito", "idiotm", "omron", "romon", "idiot", "id1ot", "idot", "iidiot", "idiots", "idxxt", "scum", "skum", "vequance", "oron", "morons", "mooron", "x", "ido", "noise"]
    got = {w: m.words(np.frombuffer(w.encode("utf-32-le"), np.uint32), np.array([0]), np.array([len(w)]))[0] for w in words}
    for w in words:
        want = 1 if w in ("idiot", "moron", "scum") else 2 if w.startswith("vequ") else 3 if any(near(w, t) for t in ("idiot", "moron")) else 0
        assert got[w] == want, w
    assert toxicity.quoted('he said "idiot" there', 9, 14) and not toxicity.quoted("you idiot", 4, 9)
    text = "don't be an idiot, it's bad"
    assert not toxicity.quoted(text, 12, 17) and toxicity.quoted("they 'idiot' me", 6, 11) and toxicity.quoted("«un idiot»", 4, 9)


def test_quotations_are_paired():
    long = "x " * 80
    for text, want in (
        ('"hi" you idiot said "bye"', False), ('two "quotes" around you idiot and "more"', False), ("word: you idiot", False), ("you are an idiot, says everyone", False),
        (f'they said "{long}idiot {long}" then', True), ('he said "you\nidiot"', False), ('an inch is " and idiot', False), ("the dogs' idiot and the cats' food", False),
        ("„du idiot“ sagte er", True), ("»du idiot« sagte er", True), ("“so ‘the idiot’ went” on", True), ("“so ‘he’ the idiot went” on", True), ('5" you idiot "ok"', False), ('("idiot")', True), ("'tis an idiot, isn't he", False),
    ):
        at = text.index("idiot")
        assert toxicity.quoted(text, at, at + 5) == want, text
        assert toxicity.evidence(text, [(at, at + 5, 1)])[0][:2] == ([0, 1] if want else [1, 0]), text


def test_toxicity_score_against_brute_force():
    """Terms by edits of every word, quotations by walking the text, cues by hand."""
    terms, stems, innocent, cues = ["idiot", "moron", "scum"], ["vequ"], frozenset({"idiom"}), {"you": 0.7, "called": -1.1, "the": -0.2}
    weights = np.array([-2.0, 1.5, 0.4, 0.9, 0.3, 1.1, 0.8])
    model = toxicity.Model(toxicity.Matcher(terms, stems), innocent, weights, cues)

    def near(a, b):
        edits = {b[:i] + c + b[j:] for i in range(len(b) + 1) for j in (i, i + 1) for c in ["", *"abcdefghijklmnopqrstuvwxyz"]}
        return a in edits | {b[:i] + b[i + 1] + b[i] + b[i + 2 :] for i in range(len(b) - 1)}

    def score(text):
        low, spans, start = text.lower(), [], None
        for i, c in enumerate(low):
            start = None if c == "\n" else start
            if c == '"':
                if start is None:
                    start = i
                else:
                    spans.append((start, i))
                    start = None
        words = [(m.start(), m.group()) for m in re.finditer(r"[^\W_]+", low)]
        kinds = [1 if w in terms else 2 if w.startswith("vequ") else 3 if any(near(w, t) for t in terms if len(t) > 4) else 0 for _, w in words]
        n, told = [0] * 4, []
        for k, ((at, w), kind) in enumerate(zip(words, kinds, strict=True)):
            if kind == 0 or kind == 3 and w in innocent:
                continue
            around = [j for j in range(max(0, k - 6), min(len(words), k + 7)) if j != k and kinds[j] == 0]
            told.append(sum(cues.get(words[j][1], 0.0) for j in around))
            n[0 if any(a < at < b for a, b in spans) else kind] += 1
        context = np.clip(np.mean(told), -4, 4) if told else 0.0
        x = np.array([1.0, np.log1p(n[1]), np.log1p(n[0]), np.log1p(n[3]), np.log1p(1000.0 * (n[1] + n[2]) / (len(low) + 100)), np.log1p(n[2]), context])
        return 1 / (1 + np.exp(-(x @ weights)))

    rng = np.random.Generator(np.random.PCG64(9))
    pool = ["you", "called", "the", "IDIOT", "idot", "idoit", "idiom", "scum", "skum", "vequance", "morons", "moron", "cat", "runs", "\n"]
    texts = ["", "you", "idiot"]
    for n in rng.integers(1, 60, 150):
        ws = [pool[i] for i in rng.integers(0, len(pool), n)]
        for i in rng.integers(0, n, n // 8):
            ws[i] = f'"{ws[i]}"' if ws[i] != "\n" else ws[i]
        texts.append(" ".join(ws))
    texts += [f'so "{t}" it went' for t in texts[3:40] if '"' not in t and "\n" not in t]
    texts = [t.replace('""', '"') for t in texts]
    assert np.allclose(model.scores(texts), [score(t) for t in texts], atol=1e-12)


def test_context_of_misspelt_terms():
    """A misspelt term counts as abuse, unless it's quoted."""
    model = toxicity.Model(toxicity.Matcher(["idiot"], []), frozenset({"idiom"}), toxicity.PRIOR)
    count = lambda t: toxicity.features(*toxicity.evidence(t, toxicity.matches(t, model.matcher)), model.innocent)
    for word, place in (("idiot", 1), ("idot", 3), ("idoit", 3)):
        assert count(f"you {word}")[place] == np.log1p(1) and count(f"you {word}")[2] == 0
        assert count(f'the sign "{word}" hung')[place] == 0 and count(f'the sign "{word}" hung')[2] == np.log1p(1)
        direct, said, none = model.scores([f"you {word} there", f'it read "{word}" there', "you idiom there"])
        assert direct > said > none


def test_urls(spark):
    rows = [(1, "http://A.example.COM/en/71?x"), (2, None), (3, "no scheme"), (4, "https://x.example.net/de/8#t"), (5, "https://casinowin.example.org/fr/1"), (6, "https://free-casino.example.org/fr/1"), (7, "http://shop.com/en/1")] + [(10 + i, f"http://win-casino{i % 3}.example.org/q") for i in range(20)] + [(50 + i, f"http://garden.example.org/{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in urls.judge(df, urls.fit(df)).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.com", "/en/71", "example.com/en/7", "allow")
    assert (got[4]["rule"], got[4]["verdict"], got[7]["rule"]) == ("example.net/de/8", "block", "com/en/")
    assert got[2]["host"] == got[3]["path"] == "" and got[2]["rule"] is None
    assert got[5]["verdict"] == got[6]["verdict"] == "block" and got[50]["verdict"] == "allow"
    assert urls.Segmenter({"casino": 5, "win": 5, "casi": 1}).split("casinowin") == ("casino", "win")
    assert urls.judge(df.limit(0), urls.fit(df.limit(0))).count() == 0


def test_tools_order_and_errors(spark):
    calls = spark.createDataFrame(
        [(1, 1, "a", "reply", '{"turn": 1, "text": "x"}', ["c"]), (1, 3, "c", "reply", '{"text":"y","turn":2.5}', []), (1, 4, "d", "other", "{", ["a", "zz"]), (1, 5, "e", "reply", None, ["f"]), (1, 6, "f", "reply", "[1]", ["e"]), (1, 7, "a", "reply", "{}", []), (1, 8, None, "reply", "{}", [])],
        "conv_id long, turn long, call_id string, tool string, arguments string, depends array<string>",
    )
    results = spark.createDataFrame([(1, 2, "a", "r"), (1, 9, "a", "late"), (1, 2, "q", None)], "conv_id long, turn long, call_id string, content string")
    got = {(r["call_id"], r["status"]): r for r in tools.link(calls, results).collect()}
    assert len(got) == 9
    a = got["a", "linked"]
    assert (a["order_turn"], a["order_depth"], a["record"]) == (3, 1, '{"arguments":{"text":"x","turn":1},"id":"a","result":"r","tool":"reply"}')
    assert got["c", "unanswered"]["errors"] == "turn is no integer" and got["d", "unanswered"]["errors"] == "not JSON; unknown tool; no call zz"
    assert got["e", "unanswered"]["order_turn"] is None and ("q", "orphan") in got and ("a", "repeated call") in got and ("a", "repeated result") in got
    assert tools.link(calls.limit(0), results.limit(0)).count() == 0


def mixing_tokens(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^ \t-\r]+", low) + [""]


def test_mixing_base_and_causality(spark, docs, odd):
    extra = [(900_001, "ab" * 40 + " \0 \0\0 " + "x" * 15 + " " + "x" * 16 + " " + "x" * 17 + "\tÉé A\x1cb"), (900_002, "x" * 16)]
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    model, vocabulary = mixing.fit(df)
    got = {r["doc_id"]: r for r in mixing.score(df, model, vocabulary).collect()}
    counts, total = {}, 0
    rows = [(r[0], mixing_tokens(r[1])) for r in df.collect()]
    for i, words in rows:
        if not mixing.held_out(i):
            for w in words:
                counts[w] = counts.get(w, 0) + 1
                total += 1
    for i, words in rows:
        want = sum(np.log10((counts.get(w, 0) + 1) / (total + len(counts) + 1)) for w in words)
        assert abs(got[i]["base_score"] - want) < 1e-6 * abs(want) and got[i]["n_known"] == sum(w in counts for w in words) and got[i]["n_tokens"] == len(words) and got[i]["train_tokens"] == total
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    # the code is a prefix code over all symbols, so that probabilities of all next symbols add up to one
    for row in model.trees.length[:50]:
        assert abs(sum(2.0 ** -int(n) for n in row) - 1) < 1e-9
    assert mixing.score(odd, model, vocabulary).count() == len(ODD) and mixing.score(odd.limit(0), model, vocabulary).count() == 0


def test_mixing_learns_from_nothing(spark, odd):
    empty = odd.limit(0)
    model, vocabulary = mixing.fit(empty)
    got = mixing.score(odd, model, vocabulary).collect()
    assert len(got) == len(ODD) and all(r["train_tokens"] == 0 and r["base_score"] == 0 and r["score"] < 0 for r in got)


def mixing_bits(model, text):
    """(bit, four inputs, gate, own counter) of every decision of a text, one after another."""
    data, every = b"\n" * 16 + mixing.lowered(text), mixing.Symbols([mixing.lowered(text)]).hashes
    out = []
    for i in range(16, len(data) + 1):
        symbol = data[i] if i < len(data) else mixing.END
        row = model.trees.row[data[i - 2] << 8 | data[i - 1]] or model.trees.row[data[i - 1] + (1 << mixing.TREE_BITS)]
        code, length = int(model.trees.code[row, symbol]), int(model.trees.length[row, symbol])
        hashes = [int(h[i - 16]) for h in every]
        for d in range(length):
            node = 1 << d | code >> length - d
            states, own = [], None
            for k, h in enumerate(hashes):
                slot = (((h ^ node * int(mixing.ODD32) & 0xFFFFFFFF) * 0x85EBCA6B) & 0xFFFFFFFF) >> 32 - mixing.SLOT_BITS
                states.append(int(model.tables[k][slot]))
                own = slot & (1 << mixing.LOCAL_BITS) - 1 if k == 0 else own
            inputs = [s_ * 16 / 65536 - 8 for s_ in states]
            gate = min(sum(s_ & 7 for s_ in states[1:]) // 3, mixing.GATES - 1)
            out.append((code >> length - 1 - d & 1, inputs, gate, own))
    return out


def test_mixing_equals_a_slow_mixer(spark, docs):
    """Bit after bit, in double precision, with dictionaries for state."""
    train = docs.limit(60).select("doc_id", "text")
    model, _ = mixing.fit(train)
    texts = [b"", b"the of and", "Éa été ".encode() * 30, b"aaaa" * 700, docs.filter("doc_id % 7 = 3").first()["text"].encode()[:3000]]
    squash = lambda z: 1 / (1 + np.exp(-z))
    for text, got in zip(texts, model.scores([mixing.lowered(t) for t in texts])[0], strict=True):
        total = 0.0
        for n, (bit, x, gate, slot) in enumerate(mixing_bits(model, text)):
            if n % mixing.LANE == 0:
                weights, own_weight, own, table = {}, 0.25, {}, {}
            w = weights.get(gate, [float(mixing.WEIGHT)] * 4)
            o = own.get(slot, 0.0)
            z = min(8.0, max(-8.0, sum(a * b for a, b in zip(w, x, strict=True)) + own_weight * o))
            p = squash(z)
            place = int(2 * z + mixing.STEPS // 2 + 0.5)
            seen = table.get(place, squash((place - mixing.STEPS // 2) / 2))
            both = (p + seen) / 2
            total += np.log10(both if bit else 1 - both)
            own[slot] = o + 0.32 * (bit - squash(o))
            table[place] = seen + 0.012 * (bit - seen)
            weights[gate] = [a + 0.03 * (bit - p) * b for a, b in zip(w, x, strict=True)]
            own_weight += 0.03 * (bit - p) * o
        assert abs(total - got) < 2e-3 * abs(total) + 1e-4


def test_mixing_windows_change_nothing():
    """Texts cut into windows have the symbols, contexts, tokens and score of whole ones."""
    rng = np.random.Generator(np.random.PCG64(4))
    texts = [bytes(rng.choice(np.frombuffer(letters, np.uint8), n)) for letters in (b"abc ", b"abcdefghij", b"a\n\tb\xc3\xa9 ") for n in (0, 1, 15, 16, 17, 40, 41, 900)] + [b"x" * 500 + b" y " + b"z" * 333]
    for limit in (16, 40, 41, 300):
        parts = [(owner, s) for s, owner in mixing.symbols(texts, limit)]
        for i, text in enumerate(texts):
            whole = mixing.Symbols([text])
            got = [[] for _ in range(7)]
            for owner, s in parts:
                for j in np.flatnonzero(owner == i):
                    end = s.first[j + 1] if j + 1 < len(owner) else len(s.symbol)
                    at = np.arange(s.first[j], end)[s.real[s.first[j] : end]]
                    for g, x in zip(got, (s.symbol, s.last, s.context, *s.hashes), strict=True):
                        g.append(x[at])
            for g, x in zip(got, (whole.symbol, whole.last, whole.context, *whole.hashes), strict=True):
                assert np.array_equal(np.concatenate(g), x[whole.real])
        want = mixing.token_keys(texts)
        chunks = [(which, final, *mixing.token_keys(ps)) for which, ps, final in mixing.token_parts(texts, limit)]
        assert all(np.array_equal(np.concatenate([c[n] for c in chunks]), want[n - 2]) for n in (2, 3))
        words = np.bincount(np.concatenate([c[0] for c in chunks]), weights=np.concatenate([c[4] for c in chunks]), minlength=len(texts))
        assert np.array_equal(words, want[2]) and sum(sum(c[1]) for c in chunks) == len(texts)
    model = mixing.Model(mixing.Trees([]), [np.full(1 << mixing.SLOT_BITS, mixing.UNSEEN, np.uint16) for _ in mixing.CONTEXTS])
    text = b" ".join(texts)
    assert abs(model._long(text, 700) - model.scores([text])[0][0] * np.log(10)) < 1e-6 * len(text)


def test_mixing_memory_of_a_long_text():
    """What a text of 24 MB needs beyond itself doesn't grow with it."""
    code = """
import resource, numpy as np
from pitchlake.llm import mixing
model = mixing.Model(mixing.Trees([]), [np.full(1 << mixing.SLOT_BITS, mixing.UNSEEN, np.uint16) for _ in mixing.CONTEXTS])
text = np.random.Generator(np.random.PCG64(1)).integers(97, 107, {mb} << 20, np.uint8).tobytes()
for s, _ in mixing.symbols([text], mixing.GROUP):
    inputs = np.empty(8 * len(s.symbol), np.complex128), np.empty(8 * len(s.symbol), np.uint32)
    model._unfolded(s, *inputs, 0)
    del inputs, s
for _, parts, _ in mixing.token_parts([text.replace(b"a", b" ")], 2 * mixing.GROUP):
    mixing.token_keys(parts)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10)
"""
    small, large = (int(subprocess.run([sys.executable, "-c", code.replace("{mb}", mb)], capture_output=True, text=True, check=True).stdout) for mb in ("3", "24"))
    assert large - small < 5 * 21  # a few copies of the text itself; in whole arrays it would be 190 bytes a byte


def test_mixing_counts_are_exact(spark):
    # 1.2 million equal bytes in one text, and about 2.4 million word starts that share one slot of the word context
    for text, n in (("a" * 1_200_000, 1), ("ab cd ef gh " * 20_000, 30)):
        df = spark.createDataFrame([(None, text)] * n, "doc_id long, text string").coalesce(1)
        trees = mixing.Trees(mixing.tree_counts(mixing.count_all(df)))
        s = mixing.Symbols([text.encode()])
        whole, most_counted = [], 0
        _, bit, slots = mixing.bits(s, trees, 0, len(s.symbol))
        for slot in slots:
            counts = np.zeros(2 << mixing.SLOT_BITS, np.int64)
            np.add.at(counts, slot.astype(np.int64) * 2 + bit, n)
            most_counted = max(most_counted, counts.max())
            whole.append(mixing.states(counts))
        assert most_counted > 1 << 16
        for most in (1 << 31, 3_000_000):
            for got, want in zip(mixing.count_tables(df, trees, most), whole, strict=True):
                assert (got == want).all()
    model = mixing.Model(trees, whole)
    assert np.isfinite(model.scores([b"a" * 1_200_000])[0]).all()


def test_mixing_costs_and_company(spark, docs):
    """A bit takes ten bytes, in room that stays; a score doesn't depend on the texts beside it; pairs handed on in parts add up."""
    train = docs.limit(60).select("doc_id", "text")
    model, _ = mixing.fit(train)
    texts = [mixing.lowered(r["text"].encode()) for r in train.filter("text is not null").collect()] + [b"", b"a", b"the of and" * 900]
    inputs, notes, per_text = model._inputs(texts)
    assert inputs.itemsize + notes.itemsize == 10 and len(inputs) == len(notes) == per_text.sum()
    room = model.room[0]
    together = model.scores(texts)[0]
    assert np.shares_memory(model.room[0], room) and not len(pickle.loads(pickle.dumps(model)).room[0])
    for i, text in enumerate(texts):
        alone = model.scores([text])[0][0]
        assert abs(alone - together[i]) < 1e-4 * abs(alone) + 1e-5
    want, got = ({(r["k1"], r["k2"]): r["c"] for r in mixing.count_all(train, most).collect()} for most in (1 << 31, 1000))
    assert want == got
    # pairs by the two bytes before a symbol, and by the last one, as counted by hand
    pairs, by_hand = {k & 0xFFFFFFFF: c for (k, k2), c in got.items() if k2 >> 56 & 0xFF == mixing.PAIR}, {}
    for r in train.collect():
        data = b"\n\n" + mixing.lowered((r["text"] or "").encode())
        for i in range(2, len(data) + 1):
            symbol = data[i] if i < len(data) else mixing.END
            for context in (data[i - 2] << 8 | data[i - 1], data[i - 1] + (1 << mixing.TREE_BITS)):
                by_hand[context << 9 | symbol] = by_hand.get(context << 9 | symbol, 0) + 1
    assert pairs == by_hand


def test_urls_recurring_concatenated_hosts(spark):
    hosts = ["casinowin.com", "freebets.org", "casino-win.net", "win-free.net", "good-news.net", "better.com", "alphabet.com", "newsroom.com"]
    rows = [(i, f"https://{hosts[i % 8]}/page/{i}") for i in range(4000)] + [(9000, "https://freecasino.com/page/1")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    model = urls.fit(df)
    split = model.segmenter.split
    assert split("casinowin") == ("casino", "win") and split("freebets") == ("free", "bets") and split("freecasino") == ("free", "casino")
    assert split("better") == ("better",) and split("alphabet") == ("alphabet",) and split("page") == ("page",)
    got = {r["host"]: r["verdict"] for r in urls.judge(df, model, ()).collect()}
    assert {h for h, v in got.items() if v == "block"} >= {"casinowin.com", "freebets.org", "casino-win.net", "freecasino.com"}
    assert got["good-news.net"] == got["better.com"] == got["alphabet.com"] == got["newsroom.com"] == "allow"


def test_pii_long_lists_of_numbers():
    weights = pii.train()
    for n in (30, 300):
        for gap in (" ", " - ", "  "):
            numbers = [f"555-{i % 900 + 100}-{i * 37 % 9000 + 1000}" for i in range(n)]
            text = gap.join(numbers)
            want, at = [], 0
            for x in numbers:
                want.append(("phone", at, at + len(x)))
                at += len(x) + len(gap)
            assert pii.find_spans(text, weights) == ([], want)
            # whatever stands before them, and so wherever a window ends
            for before in range(0, 12, 5):
                lead = "7 " * before
                assert pii.find_spans(lead + text, weights)[1] == pii.segment(lead + text, 0, len(lead + text), weights)


def test_pii_every_form_of_the_generator():
    weights = pii.train()
    emails = [f"ab12{at}mail1{dot}org" for at in (" @ ", " (at) ", " [at] ") for dot in (".", " (dot) ", " [dot] ")]
    emails += ["jane.doe (at) mail (dot) org", "jane (at) mail (dot) example (dot) org", "a1.b2-c3 [at] " + " [dot] ".join(f"x{i}" for i in range(7))]
    # the longest local part and labels that the field looks at
    emails.append("a1" * 32 + " (at) " + " (dot) ".join(["b2" * 32] * 7))
    for text in emails:
        assert pii.find_spans(f"see {text}, or", weights)[1] == [("email", 4, 4 + len(text))]
    for text in ("555-123-4567", "(555) 123-4567", "555.123.4567", "1 555-123-4567", "0033 (0)1 23 45 67 89"):
        assert pii.find_spans(f"call {text}, or", weights)[1] == [("phone", 5, 5 + len(text))]


def test_tools_long_forward_chains(spark):
    # call i depends on call i + 1, which comes later; in one expression, and in rounds of joins
    for n, small in ((400, tools.SMALL), (30, 0)):
        rows = [(1, i, f"c{i}", [f"c{i + 1}"] if i < n - 1 else []) for i in range(n)]
        got = {(r["conv_id"], r["call_id"]): (r["order_turn"], r["order_depth"]) for r in tools.topological(spark.createDataFrame(rows, "conv_id long, turn int, call_id string, depends array<string>"), small).collect()}
        assert got == {(1, f"c{i}"): (n - 1, n - 1 - i) for i in range(n)}


def test_tools_order_of_random_references(spark):
    rng = np.random.default_rng(8)
    rows = [(g, i, f"c{i}", [f"c{j}" for j in rng.integers(0, 12, rng.integers(0, 3)).tolist()]) for g in range(40) for i in range(12)]
    deps = {(g, c): [d for d in set(ds)] for g, _, c, ds in rows}
    turn = {(g, c): i for g, i, c, _ in rows}

    def key(node, path=()):
        if node in path:
            raise RecursionError
        keys = [key((node[0], d), (*path, node)) for d in deps[node]]
        t, d = max(keys, default=(-1, 0))
        return (t, d + 1) if t >= turn[node] else (turn[node], 0)

    df = spark.createDataFrame(rows, "conv_id long, turn int, call_id string, depends array<string>")
    for small in (tools.SMALL, 10):
        for r in tools.topological(df, small).collect():
            try:
                want = key((r["conv_id"], r["call_id"]))
            except RecursionError:
                want = (None, None)
            assert (r["order_turn"], r["order_depth"]) == want



def reached(edges):
    """Least node reachable from each node that has an edge."""
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {x: find(x) for x in up}


def test_components_of_odd_graphs(spark):
    rng = np.random.default_rng(5)
    ids = rng.permutation(2000).tolist()
    graphs = {
        "path of random numbers": list(zip(ids, ids[1:], strict=False)),
        "star around the greatest": [(5000, i) for i in range(3000)],
        "two cliques and a bridge": [(i + o, j + o) for o in (0, 100) for i in range(20) for j in range(i)] + [(19, 100)],
        "loops and repeats": [(1, 1), (3, 4), (4, 3), (3, 4)],
        "random": rng.integers(0, 3000, (2500, 2)).tolist(),
        "none": [],
    }
    for name, edges in graphs.items():
        df = spark.createDataFrame([tuple(e) for e in edges], "a long, b long")
        assert {r["node"]: r["root"] for r in components(df).collect()} == reached(map(tuple, edges)), name
    df = spark.createDataFrame([(None, 1), (2, None)], "a long, b long")
    assert components(df).count() == 0


def test_jaccard_long_chain_of_near_copies(spark):
    words = [f"w{i}" for i in range(1200)]
    order = np.random.default_rng(2).permutation(500).tolist()
    rows = [(order[i], " ".join(words[2 * i : 2 * i + 60])) for i in range(500)]
    got = {r["doc_id"]: r for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [set(zip(*(t.split()[k:] for k in range(5)), strict=False)) for _, t in rows]
    for i in range(0, 500, 7):
        near = sum(j != i and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8 for j in range(max(0, i - 20), min(500, i + 21)))
        assert got[order[i]]["n_links"] == near
    assert {r["class_id"] for r in got.values()} == {0} and sum(r["kept"] for r in got.values()) == 1


def test_lattice_long_chain_of_near_vectors(spark):
    rng = np.random.default_rng(4)
    x, walk = rng.standard_normal(64), []
    for _ in range(500):
        x /= np.sqrt(x @ x)
        step = rng.standard_normal(64)
        step -= (step @ x) * x
        x = x + 0.12 * step / np.sqrt(step @ step)
        walk.append(x / np.sqrt(x @ x))
    order = rng.permutation(500).tolist()
    rows = [(order[i], walk[i].tolist(), 1) for i in range(500)]
    got = {r["vec_id"]: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    m = np.array(walk)
    near = m @ m.T >= 0.98
    links = {order[i]: int(near[i].sum()) - 1 for i in range(500)}
    roots = reached([(order[i], order[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)])
    found = {k: (r["n_links"], r["component_id"]) for k, r in got.items()}
    assert found == {k: (n, roots.get(k, k)) for k, n in links.items()} and len(set(roots.values())) == 1


def test_pii_field_equals_all_segmentations():
    weights = pii.train()

    def best(spans, scores, at, last, memory):
        """The best score of candidates from atom ``at`` on, by trying every one that can come next."""
        key = at, last
        if key not in memory:
            options = [0.0]
            for (i, j, kind, a, b), own in zip(spans, scores, strict=True):
                if i >= at:
                    options.append(own + weights.get(f"{last}>{kind}", 0.0) + best(spans, scores, j, kind, memory))
            memory[key] = max(options)
        return memory[key]

    for text, _ in pii.examples(150, 21):
        _, spans = pii.candidates(text, 0, len(text))
        own = lambda kind, a, b, text=text: sum(weights.get(f, pii.UNSEEN) for f in pii.features_at(text, kind, a, b)) + (b - a) * 1e-6
        total, last = 0.0, ""
        for kind, a, b in pii.segment(text, 0, len(text), weights):
            total += own(kind, a, b) + weights.get(f"{last}>{kind}", 0.0)
            last = kind
        assert abs(total - best(spans, [own(*s[2:]) for s in spans], 0, "", {})) < 1e-9


def test_pii_training_follows_the_likelihood():
    number = {}
    n, rows, right = next(d for d in (pii._prepared(t, g, number) for t, g in pii.examples(60, 5)) if d and len(d[2]) >= 2)
    rng = np.random.default_rng(1)
    w, to = rng.normal(0, 0.5, len(number)), rng.normal(0, 0.5, (5, 5))
    grad, grad_to = np.zeros(len(w)), np.zeros((5, 5))
    value = pii._gradient(n, rows, right, w, to, grad, grad_to)
    assert value < 0
    used = sorted({f for r in rows for f in r[3]})
    for f in used[::3]:
        more = w.copy()
        more[f] += 1e-5
        assert abs((pii._gradient(n, rows, right, more, to, np.zeros(len(w)), np.zeros((5, 5))) - value) / 1e-5 - grad[f]) < 1e-3
    for k, c in ((0, 1), (0, 3), (1, 4), (4, 3)):
        more = to.copy()
        more[k, c] += 1e-5
        assert abs((pii._gradient(n, rows, right, w, more, np.zeros(len(w)), np.zeros((5, 5))) - value) / 1e-5 - grad_to[k, c]) < 1e-3


def test_pii_field_on_lines_it_has_not_seen():
    weights = pii.train()
    right = wrong = missed = 0
    for text, gold in pii.examples(600, 99):
        found, want = set(pii.segment(text, 0, len(text), weights)), set(gold)
        right, wrong, missed = right + len(found & want), wrong + len(found - want), missed + len(want - found)
    assert right / (right + wrong) > 0.92 and right / (right + missed) > 0.95


def test_pii_clean_numbers_stay():
    weights = pii.train()
    for text in ("on 2024-05-01 12:30:00 we had 1.234.567,89", "see 1.2.3.4.5 and 10.20.30.40.50", "0-306-40615-2 or 978-0-306-40615-7", "look at example.org today"):
        base, spans = pii.find_spans(text, weights)
        assert spans == base


def test_urls_split_as_the_cheapest_of_all_splits():
    segmenter = urls.Segmenter({"casino": 9, "bets": 7, "bet": 20, "casin": 2, "obets": 1, "s": 4, "free": 8, "in": 30, "no": 30, "cas": 5})

    def every(run):
        return [[run]] + [[run[:i], *rest] for i in range(1, len(run)) for rest in every(run[i:])]

    for run in ("casinobets", "freebet", "cafreex", "sins", "inno", "zzz", "betsbets", "q"):
        assert abs(sum(map(segmenter.cost, segmenter.split(run))) - min(sum(map(segmenter.cost, x)) for x in every(run))) < 1e-9
        assert "".join(segmenter.split(run)) == run
    assert segmenter.split("casinobets") == ("casino", "bets")
    long = "freebets" * 40
    assert "".join(segmenter.split(long)) == long and set(segmenter.split(long)) == {"free", "bets"}


def test_urls_learn_from_company(spark):
    # casinobets comes in the table itself, never apart; lucky keeps company with seeds, sunny doesn't
    hosts = ["casinobets.com"] * 30 + ["lucky-casino.com", "lucky-poker.net", "www.lucky-jackpot.org"] * 10 + ["sunny-garden.com", "www.garden-news.org", "abetter-garden.net", "luckless.org"] * 2500
    rows = [(i, f"https://{h}/page/{i}") for i, h in enumerate(hosts)]
    asked = [(20_000, "http://lucky-garden.com/"), (20_001, "http://sunny-news.org/x"), (20_002, "http://lucky.net/" + "a" * 100_000), (20_003, None), (20_004, "no scheme"), (20_005, "http://casinobets.com/page/1"), (20_005, "http://casinobets.com/page/1")]
    table, more = (spark.createDataFrame(x, "page_id long, url string") for x in (rows, asked))
    model = urls.fit(table)
    assert model.segmenter.split("casinobets") == ("casino", "bets") and model.segmenter.split("luckless") == ("luckless",)
    got = {r["host"]: r["verdict"] for r in urls.judge(table, model, ()).collect()}
    blocked = {h for h, v in got.items() if v == "block"}
    assert blocked == {"casinobets.com", "lucky-casino.com", "lucky-poker.net", "www.lucky-jackpot.org"}
    out = urls.judge(more, model, ()).collect()
    verdicts = {r["page_id"]: r["verdict"] for r in out}
    assert len(out) == 7 and verdicts == {20_000: "block", 20_001: "allow", 20_002: "block", 20_003: "allow", 20_004: "allow", 20_005: "block"}
    # the odds of words in the first model, counted by hand
    model = urls.fit(table, 0)
    good, bad = {}, {}
    n = [0, 0]
    for h, (_, u) in zip(hosts, rows, strict=True):
        words = ["h:" + w for run in re.findall("[a-z]+", h) for w in model.segmenter.split(run)] + ["p:" + w for w in re.findall("[a-z]+", u.split(h)[1])]
        seeds = {w for w in words if w[2:] in urls.SEEDS and w.startswith("h:")}
        n[bool(seeds)] += 1
        for w in words:
            if not seeds:
                good[w] = good.get(w, 0) + 1
            elif seeds - {w}:
                bad[w] = bad.get(w, 0) + 1
    size = len(set(good) | set(bad))
    scale = (sum(bad.values()) + size + 1) / (sum(good.values()) + size + 1)
    for w in set(good) | set(bad):
        a, b = (1, urls.SEED_RATIO * scale) if w[2:] in urls.SEEDS and w.startswith("h:") else (1, 1)
        assert abs(model.odds[w] - np.log((bad.get(w, 0) + b) / (good.get(w, 0) + a) / scale)) < 1e-9
    assert abs(model.prior - np.log((n[1] + 1) / (n[0] + 1))) < 1e-9
    for w in ("h:lucky", "h:casino"):
        assert model.odds[w] > 2
    # the passes after it, each from the degrees of the one before
    again = urls.fit(table, 2)
    for _ in range(2):
        totals, count = np.zeros(2), {}
        for h, (_, u) in zip(hosts, rows, strict=True):
            words = model.words(*re.fullmatch(r"https://([^/]*)(.*)", u).groups())
            bad = 1 / (1 + np.exp(-model.prior - sum(model.odds.get(w, model.unknown) for w in words)))
            totals += (1 - bad, bad)
            for w in words:
                count[w] = count.get(w, 0) + np.array((1 - bad, bad))
        size = np.array([sum(n[k] for n in count.values()) + 1 for k in (0, 1)])
        mixed = {w: (1 - urls.MIXED) * (n + size / size.sum() + ((0, urls.SEED_WEIGHT) if w in urls.SEED_MARKS else (0, 0))) / size + urls.MIXED * (n.sum() + urls.PSEUDO) / size.sum() for w, n in count.items()}
        odds = {w: float(np.log(x[1] / x[0])) for w, x in mixed.items()}
        model = urls.Model(model.segmenter, odds, 0.0, float(np.log((totals[1] + 1) / (totals[0] + 1))), model.paths)
    assert abs(again.prior - model.prior) < 1e-3
    assert max(abs(again.odds[w] - v) for w, v in model.odds.items()) < 1e-3


def test_urls_words_without_seeds_decide(spark):
    """Company decides both ways: hosts without a seed are blocked, hosts with one are allowed; path words don't split hosts."""
    hosts = ["lucky-casino.com", "lucky-poker.net", "www.lucky-jackpot.org", "lucky-spins.com"] * 20 + ["cheap-flights.com", "cheap-hotels.org"] * 10 + ["flights-garden.org", "www.hotels-news.net", "hotels.com", "flights.net", "theres.org"] * 500
    place = lambda h: "travel/" if "flights" in h or "hotels" in h else ""
    table = spark.createDataFrame([(i, f"https://{h}/{('es', 'ther', 'en')[i % 3]}/{place(h)}{i}") for i, h in enumerate(hosts)], "page_id long, url string")
    model = urls.fit(table)
    got = {r["host"]: r["verdict"] for r in urls.judge(table, model, ()).collect()}
    assert {h for h, v in got.items() if v == "block"} == {"lucky-casino.com", "lucky-poker.net", "www.lucky-jackpot.org", "lucky-spins.com"}
    assert model.segmenter.split("theres") == ("theres",)
    first = {r["host"]: r["verdict"] for r in urls.judge(table, urls.fit(table, 0), ()).collect()}
    assert first["cheap-flights.com"] == "block"  # what the seeds' prior alone says
    more = spark.createDataFrame([(1, "http://spins.org/"), (2, "http://lucky.org/x"), (3, "http://cheap-garden.net/"), (4, "http://unheard.org/of")], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge(more, model, ()).orderBy("page_id").collect()] == ["block", "block", "allow", "allow"]


def test_urls_removed_seeds_are_made_up_for(spark):
    """On urls of sf0.1 that have a seed in the host, most verdicts stand when one seed is taken out of the score."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    model = urls.fit(pages)
    host, path = urls.host_path(F.col("url"))
    kept = total = 0
    for h, p in pages.select(host, path).collect():
        words = model.words(h, p)
        assert all("-" in label or len(model.segmenter.split(label)) == 1 for label in h.split("."))
        for seed in urls.SEED_MARKS & set(words):
            kept += model.weigh([w for w in words if w != seed]) > 0
            total += 1
    assert total > 100 and kept / total > 0.85


def test_urls_seeds_found_by_company_alone(spark):
    """Held-out agreement: without its own seed, a url of the table gets the label that its seed would give it."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    fold = F.pmod(F.xxhash64("page_id"), F.lit(5)) == 0
    model = urls.fit(pages.filter(~fold))
    host, path = urls.host_path(F.col("url"))
    agree = total = 0
    for h, p in pages.filter(fold).select(host, path).collect():
        words = model.words(h, p)
        score = model.prior + sum(model.odds.get(w, model.unknown) for w in words if w not in urls.SEED_MARKS)
        agree += (score > 0) == (not urls.SEED_MARKS.isdisjoint(words))
        total += 1
    assert agree / total > 0.95


def test_tools_cycles_and_what_lies_behind(spark):
    rows = [("a", 1, ["b"]), ("b", 2, ["a"]), ("c", 5, ["a"]), ("d", 9, ["c"]), ("e", 3, ["f"]), ("f", 7, ["g"]), ("g", 8, []), ("h", 4, ["h"]), ("i", 6, ["e", "zz"]), ("j", 10, ["f"])]
    df = spark.createDataFrame([(1, t, c, d) for c, t, d in rows] + [(2, t, c, d) for c, t, d in rows if c not in "bh"], "conv_id long, turn int, call_id string, depends array<string>")
    for small in (tools.SMALL, 5, 0):
        got = {(r["conv_id"], r["call_id"]): (r["order_turn"], r["order_depth"]) for r in tools.topological(df, small).collect()}
        assert {c: got[1, c] for c in "abcdh"} == {c: (None, None) for c in "abcdh"}
        for conv in (1, 2):
            assert {c: got[conv, c] for c in "efgij"} == {"e": (8, 2), "f": (8, 1), "g": (8, 0), "i": (8, 3), "j": (10, 0)}
        assert (got[2, "a"], got[2, "c"], got[2, "d"]) == ((1, 0), (5, 0), (9, 0))


def test_tools_chains_past_one_expression(spark):
    """A chain of 5,000 references, a cycle with a tail of 3,000 and calls with several references, in rounds of joins."""
    rng = np.random.default_rng(9)
    deps = {f"c{i}": [f"c{i + 1}"] if i < 5000 else [] for i in range(5001)}
    deps |= {f"y{i}": [f"y{i + 1}"] if i < 3006 else ["y3000"] for i in range(3007)}
    deps |= {f"b{i}": [f"b{j}" for j in sorted(set(rng.integers(i + 1, i + 4, 2).tolist())) if j < 40] + ["c4000"] for i in range(40)}
    deps["z"] = ["b0", "y5"]
    turn = {c: int(t) for c, t in zip(deps, rng.integers(0, 9000, len(deps)), strict=True)}
    want = {c: None for c in deps}
    order = [f"c{i}" for i in range(5000, -1, -1)] + [f"b{i}" for i in range(39, -1, -1)]
    for c in order:
        t, d = max((want[x] for x in deps[c]), default=(-1, 0))
        want[c] = (t, d + 1) if t >= turn[c] else (turn[c], 0)
    df = spark.createDataFrame([(7, turn[c], c, d) for c, d in deps.items()], "conv_id long, turn int, call_id string, depends array<string>")
    assert tools.SMALL < len(deps)
    got = {r["call_id"]: (r["order_turn"], r["order_depth"]) for r in tools.topological(df).collect()}
    assert got == {c: k or (None, None) for c, k in want.items()}


def test_tools_hot_identifier(spark):
    """One identifier holds most rows, equal ones among them; each row comes back once."""
    calls = spark.createDataFrame([(1, i % 3, "hot", "reply", '{"text":"x","turn":1}', []) for i in range(3000)] + [(1, 1, "cold", "reply", None, ["hot"])], "conv_id long, turn int, call_id string, tool string, arguments string, depends array<string>")
    results = spark.createDataFrame([(1, 5 + i % 2, "hot", f"r{i % 7}") for i in range(4000)], "conv_id long, turn int, call_id string, content string")
    got = tools.link(calls, results).groupBy("call_id", "status").count().collect()
    assert {tuple(r) for r in got} == {("hot", "linked", 1), ("hot", "repeated call", 2999), ("hot", "repeated result", 3999), ("cold", "unanswered", 1)}


def test_tool_calls_query_equals_sql(spark):
    import duckdb

    from pitchlake.llm import queries

    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    want = con.execute(queries.ORACLE_SQL["op8_tool_calls"]).fetchdf()
    got = queries.QUERIES["op8_tool_calls"](spark, "/root/testdata/sf0.01").toPandas()
    cell = lambda v: None if pd.isna(v) else str(int(v)) if isinstance(v, float) else str(v)
    rows = lambda f: sorted([tuple(map(cell, r)) for r in f[sorted(f.columns)].astype(object).values.tolist()], key=repr)
    assert rows(got) == rows(want)
    assert set(got["status"]) == {"linked", "unanswered", "orphan", "before its call", "repeated call", "repeated result"}
    assert got["order_turn"].isna().any() and (got["order_depth"] > 1).any() and got["errors"].str.contains("no call").any()


def test_neighbours_repeated_and_null_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [2.0, 0.5]), (2, [2.0, 0.5]), (None, [9.0, 9.0]), (3, [0.5, 3.0]), (4, [1.0]), (5, None)]
    want = None
    for shuffled in (rows, rows[::-1]):
        df = spark.createDataFrame(shuffled, "vec_id long, embedding array<double>").repartition(3)
        got = [tuple(r) for r in neighbours.search(df, lambda i: i == 1).orderBy("rank").collect()]
        # the least vector (as bytes) asks: (0, 1); both rows of id 2 are candidates
        assert got == [(1, 1, 3, 3.0), (1, 2, 2, 0.5), (1, 3, 2, 0.5)]
        assert want in (None, got)
        want = got


def test_bpe_of_code_points():
    """All but the insides of the large uniform blocks (ideographs, syllables, private and empty planes)."""
    t, own = Tokenizer.from_file(WORD), bpe.WordBpe(WORD)
    inside = ((0x3500, 0x9F00), (0xAD00, 0xD700), (0xD800, 0xE000), (0xE100, 0xF800), (0x17100, 0x18700), (0x20100, 0x2A600), (0x2A800, 0x2F700), (0x2FB00, 0x31300), (0x32500, 0xE0000), (0xE0200, 0x10FF00))
    points = [c for c in range(0x110000) if not any(a <= c < b for a, b in inside)]
    for lo in range(0, len(points), 256):
        text = " ".join(f"a{chr(c)}b {chr(c)}" for c in points[lo : lo + 256])
        ids = t.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, hex(points[lo])
        # next to a letter and a mark that change when normalised, and between letters without marks
        text = " ".join(f"é\u0301{chr(c)}ΑΣ" for c in points[lo : lo + 256])
        assert own.encode(text) == t.encode(text, add_special_tokens=False).ids, hex(points[lo])
        text = " ".join(f"É{chr(c)}ΑΣ" for c in points[lo : lo + 256] if not bpe.UNSURE.match(chr(c)))
        assert own.encode(text) == t.encode(text, add_special_tokens=False).ids, hex(points[lo])


def test_bpe_added_tokens_come_from_the_file(tmp_path):
    import json

    with open(WORD, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"].append({"id": max(t["id"] for t in spec["added_tokens"]) + 1, "content": "[hello]", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True})
    path = tmp_path / "words.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    t, own = Tokenizer.from_file(str(path)), bpe.WordBpe(str(path))
    for text in ("say [hello] you", "[hello][hello]", "<|endoftext|>[hello]", "[hell"):
        ids = t.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids and own.decode(ids) == t.decode(ids, skip_special_tokens=False)
