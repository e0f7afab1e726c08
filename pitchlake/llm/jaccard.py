"""Jaccard similarity join of documents on word shingles, with Bayesian pruning.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; shingles
are five consecutive words (a shorter text is one shingle; a text without words
has none and links with nothing, its exact copies included).

1. Exact copies (equal texts) fold into one representative with a weight.
2. MinHash values in ``BANDS`` bands of ``ROWS`` give candidate buckets.  Only
   buckets with at least two representatives go on; large ones are cut into
   blocks, so that a task sees at most two blocks whatever the bucket's size.
3. In a task, candidates meet as block matrices: MinHash values are compared
   eight at a time, and a pair is dropped once the posterior probability
   (uniform prior) that its similarity reaches the threshold falls below
   ``TOLERANCE``.  A pair counts only in the first band it shares.  The task
   emits a spanning forest of the survivors, never the pairs.
4. The forest's components say which texts must meet for verification; their
   texts are read once more, and all pairs inside a component, in blocks again,
   are pruned the same way and then verified exactly on whole shingle sets.
5. Verified links are counted per document (copies by weight) and their
   spanning forests give the classes.

Null texts count as empty; rows with a null id link with nothing.  Repeated rows are copies.  Other columns of the
input are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import components, forget, looked_up, written

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS, STEP = 20, 4, 8
HASHES = BANDS * ROWS
#: Posterior probability below which a pair is dropped; rows and bytes of a block, at most.
TOLERANCE, BLOCK, BLOCK_BYTES = 1e-6, 1024, 8_000_000
#: Rows, pairs and bytes of a task that looks for candidates, and of one that verifies.
CANDIDATE_TASK, VERIFY_TASK = (4096, 4_000_000, 4_000_000), (1024, 250_000, 2_000_000)

_RNG = np.random.Generator(np.random.PCG64(20240613))
MULT = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
PLUS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse below n, kept and lengthened on demand."""
    global _UP, _DOWN
    if len(_UP) < n:
        n = max(n, 1 << 20)
        _UP, _DOWN = (np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, r, np.uint64))]) for r in (BASE, INVERSE))
    return _UP, _DOWN


_UP = _DOWN = np.zeros(0, np.uint64)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' shingles, one after another, and where each text's begin (one more entry than texts)."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    up, down = powers(len(data) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    edge = np.diff((~SPACE[data]).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    words = mix((total[ends] - total[starts]) * down[starts])
    n_words = np.diff(np.searchsorted(starts, ends_of, side="left"), prepend=0)
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    grams = np.zeros(n, np.uint64)
    first = np.cumsum(n_words) - n_words
    last = np.repeat(first + n_words, n_words)
    at = np.arange(n)
    for k in range(WORDS):
        inside = at + k < last
        grams = (grams * BASE) + np.where(inside, padded[k : n + k], np.uint64(k + 1))
    grams = mix(grams)
    count = np.where(n_words >= WORDS, n_words - WORDS + 1, (n_words > 0).astype(np.int64))
    keep = at - np.repeat(first, n_words) < np.repeat(count, n_words)
    return grams[keep], np.concatenate([[0], np.cumsum(count)])


def minhash(grams: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """HASHES values (32 bits) for each text that has shingles; zeros for the others."""
    n = len(begins) - 1
    out = np.zeros((n, HASHES), np.uint32)
    full = np.flatnonzero(np.diff(begins))
    if len(full):
        at = begins[:-1][full]
        # in runs that stay in the processor's cache
        limit = 1 << 16
        i = 0
        while i < len(full):
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
            lo, hi = at[i], (at[j] if j < len(full) else len(grams))
            part, local = grams[lo:hi], at[i:j] - lo
            for k in range(HASHES):
                out[full[i:j], k] = np.minimum.reduceat(((part * MULT[k] + PLUS[k]) >> np.uint64(32)).astype(np.uint32), local)
            i = j
    return out


def bands(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    key = np.zeros((len(sig), BANDS), np.uint64)
    for r in range(ROWS):
        key = mix(key * BASE + sig[:, r::ROWS].astype(np.uint64) + np.uint64(r + 1))
    return key + np.arange(BANDS, dtype=np.uint64)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For 8, 16, ... compared values: the fewest matches with which a pair stays.

    Posterior of the similarity after m matches in n, uniform prior: Beta(m + 1, n - m + 1).
    """
    s = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            density = m * np.log(s) + (n - m) * np.log1p(-s)
            density = np.exp(density - density.max())
            if density[s >= threshold].sum() / density.sum() >= tolerance:
                out.append(m)
                break
    return out


def survivors(a: np.ndarray, b: np.ndarray, same: bool, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two blocks of signatures that pruning leaves; i < j when the block meets itself."""
    hits = np.zeros((len(a), len(b)), np.uint8)
    for k in range(STEP):
        hits += a[:, k, None] == b[None, :, k]
    keep = hits >= least[0]
    if same:
        keep = np.triu(keep, 1)
    i, j = np.nonzero(keep)
    m = hits[i, j].astype(np.int32)
    for step in range(1, HASHES // STEP):
        if not len(i):
            break
        cols = slice(step * STEP, (step + 1) * STEP)
        m += (a[i, cols] == b[j, cols]).sum(axis=1, dtype=np.int32)
        ok = m >= least[step]
        i, j, m = i[ok], j[ok], m[ok]
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph: (node, root) with root the least node of its component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return [(int(v), int(r)) for v, r in enumerate(root) if v != r]


def signed(docs: DataFrame) -> DataFrame:
    """``th`` (text hash), ``doc_id``, ``sig``, ``bands`` of every document; no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts = batch.columns
            n, i = batch.num_rows, 0
            while i < n:
                part, size = [], 0
                j = i
                while j < n and (size < 2_000_000 or not part):
                    t = (texts[j].as_py() or "").encode("utf-8", "replace")
                    part.append(t)
                    size += len(t)
                    j += 1
                grams, begins = shingles(part)
                sig = minhash(grams, begins)
                keys = bands(sig).view(np.int64)
                full = (np.diff(begins) > 0) & np.array([x.is_valid for x in ids[i:j]])
                yield pa.RecordBatch.from_arrays(
                    [ids[i:j], hashes[i:j], pa.array([sig[k].tobytes() if full[k] else None for k in range(j - i)], pa.binary()), pa.array([keys[k].tolist() if full[k] else None for k in range(j - i)], pa.list_(pa.int64()))],
                    names=["doc_id", "th", "sig", "bands"],
                )
                i = j

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("th"), text.alias("text")).mapInArrow(run, "doc_id long, th binary, sig binary, bands array<long>")


def dealt(members: DataFrame, key: str, sizes: DataFrame, task_rows: int, task_pairs: int, task_bytes: int, more: DataFrame | None = None) -> DataFrame:
    """Rows of groups dealt to units ``(key, i, j)`` of two blocks, and units to tasks; ``sizes``: key, n, bytes.

    A group small in rows and bytes is one unit; else each of its rows goes to as
    many units as the group has blocks.  Units are dealt at random to as many tasks
    (column ``task``, one partition each) as all their rows, pairs and bytes need.
    ``more`` (by ``th``) joins once groups without a size are out.
    """
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    blocked = sizes.withColumn("blocks", blocks)
    work = blocked.agg(F.sum(F.col("n") * F.col("blocks")), F.sum(F.col("n") * F.col("n") / 2), F.sum(F.col("bytes") * F.col("blocks"))).first()
    tasks = max(1, *(-(-int(w or 0) // most) for w, most in zip(work, (task_rows, task_pairs, task_bytes), strict=True)))
    out = looked_up(members, key, blocked.select(key, "blocks"), "inner", sizes)
    if more is not None:
        out = out.join(more, "th")
    out = out.withColumn("own", F.pmod(F.xxhash64("th", F.lit(7)), F.col("blocks")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    out = out.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("blocks", "other")
    return out.withColumn("task", F.pmod(F.xxhash64(key, "i", "j"), F.lit(tasks))).repartition(tasks, "task")


def _units(group: pd.DataFrame, key: str, code: np.ndarray) -> Iterator[tuple[object, np.ndarray, np.ndarray, bool]]:
    """(key, members of the one block, of the other, whether they are the same) of each unit in a task."""
    own = group["own"].to_numpy()
    for (k, i, j), rows in group.groupby([key, "i", "j"], sort=False).indices.items():
        a = np.unique(code[rows[own[rows] == i]])
        yield k, a, a if i == j else np.unique(code[rows[own[rows] == j]]), i == j


def _chunks(a: np.ndarray, b: np.ndarray, same: bool, size: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Parts of two blocks that meet as matrices of bounded size."""
    for x in range(0, len(a), size):
        for y in range(x if same else 0, len(b), size):
            yield a[x : x + size], b[y : y + size], same and x == y


def _candidate_task(least: list[int]):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Spanning forest of the surviving pairs of a task's units; a pair counts only in the first band it shares."""
        th, first, code = np.unique(group["th"].to_numpy(), return_index=True, return_inverse=True)
        sig = np.frombuffer(b"".join(group["sig"].iloc[first]), np.uint32).reshape(len(th), HASHES)
        keys = bands(sig)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for bucket, a, b, whole in _units(group, "bucket", code):
            mine = np.int64(bucket).view(np.uint64)
            for x, y, same in _chunks(a, b, whole):
                p, q = survivors(sig[x], sig[y], same, least)
                p, q = x[p], y[q]
                for lo in range(0, len(p), 200_000):
                    u, v = p[lo : lo + 200_000], q[lo : lo + 200_000]
                    shared = keys[u] == keys[v]
                    mine_first = keys[u, shared.argmax(axis=1)] == mine
                    left.append(u[mine_first])
                    right.append(v[mine_first])
        # texts are numbered by their hashes, so roots are the same in every task
        links = forest(len(th), np.concatenate(left), np.concatenate(right))
        return pd.DataFrame({"a": [th[v] for v, _ in links], "b": [th[r] for _, r in links]})

    return run


def exact_links(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Which pairs (a[i], b[j]) of sets, arrays of distinct hashes, reach the threshold.

    Intersections come from a product of 0/1 matrices, a stripe of shingles at a time.
    """
    if not len(i):
        return np.zeros(0, bool)
    size_a, size_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    if len(i) * 8 < len(a) * len(b):  # few pairs: one by one
        both = np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)])
    else:
        every = np.concatenate([*a, *b])
        values, code = np.unique(every, return_inverse=True)
        row = np.repeat(np.arange(len(a) + len(b)), np.concatenate([size_a, size_b]))
        both_all = np.zeros((len(a), len(b)), np.float32)
        order = np.argsort(code, kind="stable")
        code, row = code[order], row[order]
        stripe = 4096
        cuts = np.searchsorted(code, np.arange(0, len(values) + stripe, stripe))
        for s in range(len(cuts) - 1):
            lo, hi = cuts[s], cuts[s + 1]
            m = np.zeros((len(a) + len(b), stripe), np.float32)
            m[row[lo:hi], code[lo:hi] - s * stripe] = 1
            both_all += m[: len(a)] @ m[len(a) :].T
        both = both_all[i, j].astype(np.int64)
    union = size_a[i] + size_b[j] - both
    return both * 1000 >= round(threshold * 1000) * union


def _verify_task(least: list[int], threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Exact links of a task's units: per text its linked weight, and a spanning forest."""
        th, first, code = np.unique(group["th"].to_numpy(), return_index=True, return_inverse=True)
        one = group.iloc[first]
        grams, begins = shingles([t.encode("utf-8", "replace") for t in one["text"]])
        sig = minhash(grams, begins)
        sets = np.empty(len(th), object)
        for k in range(len(th)):
            sets[k] = np.unique(grams[begins[k] : begins[k + 1]])
        weight = one["weight"].to_numpy(np.int64)
        links = np.zeros(len(th), np.int64)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, a, b, whole in _units(group, "root", code):
            for x, y, same in _chunks(a, b, whole, 256):
                p, q = survivors(sig[x], sig[y], same, least)
                ok = exact_links(sets[x], sets[y], p, q, threshold)
                u, v = x[p[ok]], y[q[ok]]
                np.add.at(links, u, weight[v])
                np.add.at(links, v, weight[u])
                left.append(u)
                right.append(v)
        tree = dict(forest(len(th), np.concatenate(left), np.concatenate(right)))
        return pd.DataFrame([(th[k], int(links[k]), th[tree.get(k, k)]) for k in range(len(th)) if links[k]], columns=["th", "links", "root"])

    return run


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, kept`` and the text's hash ``th``.

    ``class_id`` is the least id among documents reachable by links, itself
    included; ``n_links`` counts the other documents, copies each, with a
    similarity of at least the threshold; ``kept`` marks one row of each class
    (of rows repeated with the same id, each is marked).
    """
    spark = docs.sparkSession
    least = least_matches(threshold)
    table = written(signed(docs), "signed")
    # exact copies fold; texts without words stay by themselves
    folded = table.filter("sig is not null").groupBy("th").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight"))
    reps = written(folded, "reps")
    first = table.filter("sig is not null").join(reps.select("th", F.col("rep").alias("doc_id")), ["th", "doc_id"]).dropDuplicates(["th", "doc_id"])
    members = written(first.select("th", "sig", "bands"), "members")
    buckets = members.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"), (F.count("*") * HASHES * 4).alias("bytes")).filter("n > 1")
    buckets = written(buckets, "buckets")
    # signatures only travel with texts that share a bucket at all
    tasks = dealt(members.select("th", F.explode("bands").alias("bucket")), "bucket", buckets, *CANDIDATE_TASK, members.select("th", "sig"))
    near = tasks.groupBy("task").applyInPandas(_candidate_task(least), "a binary, b binary")
    near = written(near, "near")
    forget(members)
    empty = near.isEmpty()
    if empty:
        linked = spark.createDataFrame([], "th binary, links long, root binary")
    else:
        groups = written(components(near), "groups")
        chosen = groups.withColumnRenamed("node", "th").join(reps, "th")
        text = F.coalesce(F.col("text"), F.lit(""))
        texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.unhex(F.md5(text.cast("binary"))).alias("th"), text.alias("text"))
        # the id is part of the key, so that copies spread; repeated rows of one id fold afterwards
        texts = texts.join(chosen, ["th", "rep"])
        texts = written(texts.select("th", "root", "text", "weight").dropDuplicates(["th"]), "texts")
        sizes = written(texts.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")), "sizes")
        verify = dealt(texts, "root", sizes, *VERIFY_TASK).groupBy("task").applyInPandas(_verify_task(least, threshold), "th binary, links long, root binary")
        linked = written(verify, "linked")
    counted = linked.groupBy("th").agg(F.sum("links").alias("links"))
    edges = linked.filter("th != root").select(F.col("th").alias("a"), F.col("root").alias("b"))
    if empty or edges.isEmpty():
        parts = spark.createDataFrame([], "th binary, root binary")
    else:
        parts = components(edges).withColumnRenamed("node", "th")
    known = reps.join(counted, "th", "left").join(parts, "th", "left").select("th", "rep", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "th").alias("root"))
    known = written(known, "known")
    least_id = known.groupBy("root").agg(F.min("rep").alias("class_id"))
    known = written(known.join(least_id, "root").select("th", "class_id", (F.col("links") + F.col("weight") - 1).alias("n_links")), "classes")
    # a text with very many copies is looked up without skew; ids are unknown where a text has no words or its row no id
    out = looked_up(table.select("doc_id", "th", F.col("sig").isNotNull().alias("some")), "th", known)
    out = out.withColumns({c: F.when(F.col("some"), F.col(c)) for c in ("class_id", "n_links")})
    class_id = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"), "th")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, without all but the least id of each class; rows of a null id stay."""
    gone = classes(docs, threshold).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id_"), F.col("th").alias("gone_th_")).distinct()
    th = F.unhex(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
    return docs.join(gone, (docs["doc_id"] == gone["gone_id_"]) & (th == gone["gone_th_"]), "left_anti")
