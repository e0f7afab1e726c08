"""Exact whitening, periodic runs and line labelling against brute force, with odd inputs."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import line_crf, periods, queries, whitening

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, n string"  # a column whose name clashes with results


def brute_whitening(rows):
    """(n, distinct vectors, per-row deviation) by Python integers."""
    good = [(i, [int(np.floor(256.0 * c)) for c in v]) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    return good, fit, n, s, [sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)) for _, x in good]


@pytest.mark.parametrize("big", [1.0, 3e12])
def test_whitening_is_exact(spark, big):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6)) + 5 * big
    rows = [(i, [float(c) for c in v], "x") for i, v in enumerate(base)]
    rows += [(100, rows[0][1], "x"), (100, rows[0][1], "x"), (None, rows[1][1], "y"), (101, None, "x"), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x"), (103, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0], "x"), (104, [float("inf")] * 6, "x"), (105, [], "x")]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    good, fit, n, s, far = brute_whitening(rows)
    got = whitening.whiten(df, whitening.fit(df)).collect()
    assert len(got) == 4 * len(good) and {r["n"] for r in got} == {n}
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], int(r["deviation"])) for r in got if r["component"] == 1) == sorted((-1 if i is None else i, d) for (i, _), d in zip(good, far, strict=True))
    exact = np.array([[sum(n * x[i] * n * x[j] for x in fit) - n * s[i] * s[j] for j in range(6)] for i in range(6)], object)
    cov = np.array([[v / n**3 for v in r] for r in exact], float)
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    white = {(r["vec_id"], r["component"]): r for r in got}
    x = {i: np.array([a - b / n for a, b in zip(w, s, strict=True)]) for i, w in good}
    for c in range(4):
        want = np.array([x[i] @ v[:, c] for i in range(40)]) / np.sqrt(e[c])
        have = np.array([white[i, c + 1]["whitened"] for i in range(40)])
        if np.dot(want, have) < 0:
            want = -want
        assert np.allclose(want, have, atol=1e-6 if big == 1 else 1e-2)
        assert white[0, c + 1]["explained"] == pytest.approx(e[c] / e.sum(), rel=1e-6)
    assert got[0]["identity_error"] < (1e-9 if big == 1 else 1e-2)


def test_whitening_of_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert whitening.fit(empty) == {} and whitening.whiten(empty, {}).count() == 0
    # one vector only has no variance; another length is a fit of its own; entries beyond 64 bits are cut
    df = spark.createDataFrame([(1, [1.0, 2.0], "a"), (2, [1.0, 2.0], "a"), (3, [0.0, 0.0, 1e300], "b"), (4, [0.0, 1.0, -1e300], "b"), (5, [0.5, 1.0, 0.0], "b")], VECTORS)
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(df, whitening.fit(df)).collect()}
    assert len(got) == 2 * 2 + 3 * 3 and got[1, 1]["whitened"] is None and got[1, 1]["identity_error"] is None and got[1, 1]["deviation"] == "0" and got[1, 1]["n"] == 1
    assert got[3, 1]["n"] == 3 and got[3, 1]["whitened"] is not None
    x = [(0, 0, 2**63 - 1), (0, 256, -(2**63)), (128, 256, 0)]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert int(got[3, 1]["deviation"]) == sum((3 * a - b) ** 2 for a, b in zip(x[0], s, strict=True))


def test_whitening_parts_add_up():
    rng = np.random.default_rng(0)
    x = rng.integers(-(2**62), 2**62, (30, 5))
    shift = x[7]
    digits = whitening.planes(x, shift)
    y = x.astype(object) - shift.astype(object)
    assert (whitening.products(digits) == y.T.dot(y)).all() and (whitening.column_sums(digits) == y.sum(axis=0)).all()
    numbers = [0, -1, 2**200, -(2**199), 5]
    assert whitening.from_bytes(whitening.to_bytes(numbers)) == numbers
    assert (whitening.unpacked(whitening.packed(x), 5) == x).all() and len(whitening.packed(np.array([[1, -128], [1, 128]]))[0]) == 2


def test_whitening_query(spark):
    out = queries.op11_whitening(spark, DATA)
    r = out.agg(F.count("*"), F.count_distinct("vec_id"), F.max("identity_error"), F.min("component"), F.max("component"), F.count("deviation")).first()
    assert tuple(r)[:2] == (2000, 500) and r[2] < 1e-4 and (r[3], r[4], r[5]) == (1, 4, 2000)


def brute_runs(w, least=12):
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            if i - a + q >= max(least, 2 * q):
                out.setdefault((a, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def test_runs_against_all_periods():
    rng = random.Random(4)
    for _ in range(1500):
        n, k = rng.randrange(0, 150), rng.choice([1, 2, 2, 3, 4, 30])
        w = [rng.randrange(k) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            if n > 4:
                a, p, m = rng.randrange(n), rng.randrange(1, max(2, n // 3)), rng.randrange(1, n)
                for i in range(a + p, min(n, a + m)):
                    w[i] = w[i - p]
        least = rng.choice([12, 12, 2, 3, 5, 20])
        assert periods.periodic_runs(np.array(w, np.int64), least) == brute_runs(w, least), (w, least)


def test_runs_of_famous_words():
    a, b = [0], [0, 1]
    while len(b) < 700:
        a, b = b, b + a
    nested = ([1] * 40 + [2, 3]) * 6 + ([1, 2] * 30 + [1]) * 4  # highly periodic blocks within longer periods
    for w in (b, nested, [7] * 300, [1, 2, 3] * 50 + [4] + [1, 2, 3] * 50):
        assert periods.periodic_runs(np.array(w, np.int64)) == brute_runs(w)


def plant(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_periods_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect() if len(r[1]) < 4000]
    rows += [(10**6 + i, t) for i, t in enumerate(["", None, " \t\n", "a " * 40, "x" * 5000, "é\x1cb " * 30, "a b c " * 4, "one two " * 7 + "one"])] + [(None, "b " * 20), (rows[0][0], rows[0][1])]
    df = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, start string")
    got = queries.digest_of_runs(periods.find(queries.planted(df))).collect()
    want = []
    for i, t in rows:
        w = plant(i, t)
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        drop = {j for s, m, q in runs for j in range(s + q, s + m)}
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for j, x in enumerate(w) if j not in drop))))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and sum(r[1] for r in want) > 30
    assert periods.find(df.limit(0)).count() == 0


def test_words_of_long_texts_in_pieces():
    text = "ab " * 400_000 + "\x1c c" + "d" * 3_000_000 + " e"
    assert list(periods.words(text)) == re.findall(r"[^\x20\x09-\x0D]+", text)


def brute_base(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    rep = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(rep), len(w) < 10 or 100 * len(rep) > 20 * len(w))


ODD = [(1, "", "x"), (2, None, "x"), (3, "a " * 5000, "x"), (4, "\n\n \t\n", "x"), (5, "é\xa0b c\x85d " * 300, None), (6, "<a> |\n<a> |\n<a>  |", "y"), (None, "no id here but more than ten words in this one line of text.", "z"), (7, "w" * 200_000, "x"), (7, "w" * 200_000, "x")]


def test_line_base_and_verdicts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = line_crf.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    for df in (docs.select("doc_id", "text", F.lit("c").alias("n_words")), spark.createDataFrame(ODD, "doc_id long, text string, kept string")):
        got = line_crf.judge(df, model).collect()
        want = [(r[0], *brute_base(r[1])) for r in df.select("doc_id", "text").collect()]
        assert sorted(str((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])) for r in got) == sorted(map(str, want))
        assert not any(r["kept"] and (r["base_failed"] or 2 * r["content_words"] < r["n_words"]) for r in got)
        assert line_crf.keep_good(df, model).count() == sum(r["kept"] for r in got)
        marked = line_crf.marked_lines(df, model).filter("content").select(F.sum(F.size(F.regexp_extract_all("line", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))).first()[0]
        assert (marked or 0) == sum(r["content_words"] for r in got)
    assert line_crf.judge(docs.limit(0), model).count() == 0
    none = line_crf.fit(docs.limit(0), spark.createDataFrame([], "doc_id long, quality int"))
    assert none.weights.tolist() == line_crf.PRIOR.tolist()


def test_line_labels_are_the_likeliest_of_all():
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 8))
        s, trans, start = rng.normal(size=n), rng.normal(size=(2, 2)), rng.normal(size=2)
        total = lambda y: start[y[0]] + sum(s[i] for i in range(n) if y[i]) + sum(trans[y[i], y[i + 1]] for i in range(n - 1))  # noqa: B023, E731
        assert tuple(line_crf.viterbi(s, trans, start)) == max(itertools.product((0, 1), repeat=n), key=total)
    assert line_crf.viterbi(np.zeros(4), np.zeros((2, 2)), np.zeros(2)).tolist() == [1, 1, 1, 1]


def test_line_likelihood_and_gradient():
    rng = np.random.default_rng(6)
    length = np.array([5, 3, 3, 1])
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    x, y = rng.integers(0, 2, (12, line_crf.N)).astype(float), rng.integers(0, 2, 12)
    theta = rng.normal(size=line_crf.N + 6) / 3
    value, grad = line_crf.likelihood(theta, x, y, first, length)
    trans, start = theta[line_crf.N : line_crf.N + 4].reshape(2, 2), theta[line_crf.N + 4 :]
    want = 0.0
    for a, n in zip(first, length, strict=True):
        s = x[a : a + n] @ theta[: line_crf.N]
        total = lambda z: start[z[0]] + sum(s[i] for i in range(n) if z[i]) + sum(trans[z[i], z[i + 1]] for i in range(n - 1))  # noqa: B023, E731
        want += np.log(sum(np.exp(total(z)) for z in itertools.product((0, 1), repeat=int(n)))) - total(y[a : a + n])
    gap = theta - np.concatenate([line_crf.PRIOR, np.zeros(6)])
    assert value == pytest.approx(want + line_crf.RIDGE * gap @ gap / 2)
    for i in rng.integers(0, len(theta), 12):
        step = np.zeros(len(theta))
        step[i] = 1e-5
        up, down = (line_crf.likelihood(theta + k * step, x, y, first, length)[0] for k in (1, -1))
        assert grad[i] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_line_model_on_documents_it_has_not_seen(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = line_crf.fit(docs, labels, folds=5)
    held = labels.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)
    got = line_crf.judge(docs.join(held, "doc_id"), model).join(held.select("doc_id", "quality"), "doc_id").filter("n_words > 0")
    good = (F.col("content_words") * 2 >= F.col("n_words")).cast("int")
    right, n, lost = got.agg(F.avg((good == F.col("quality")).cast("int")), F.count("*"), F.count_if((F.col("quality") == 1) & ~F.col("kept") & ~F.col("base_failed"))).first()
    assert n > 700 and right >= 0.98 and lost <= n / 100


def test_line_model_marks_the_junk_within_a_document(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = line_crf.fit(docs, labels)
    text = "\n".join(["The thing of that and reins to the onder with an other, as it was to be."] * 1 + ["BUY!! NOW!! AND!! HERE!! BUY!! OF!! THE!!"] * 3 + ["In the ordering of and that stion with thered on the handing, for it is an ereding."])
    got = [r["content"] for r in line_crf.marked_lines(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).orderBy("line_no").collect()]
    assert got == [True, False, False, False, True]
