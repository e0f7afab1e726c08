"""Quality rules: counts over words and lines, and a linear-chain CRF that marks each line as content or boilerplate.

A line (``\\n`` ends it) without a word has no part in the sequence.  Every
other one has indicator features (:data:`FEATURES`) of its own words, of what it
repeats and of where it stands; the field has one weight for each of them,
four weights of transitions and two of beginnings.  Viterbi decoding marks the
lines of a whole text jointly, and a text stays if at least ``SHARE`` of its words
stand in content lines.

Labels name documents, not lines: at first a document's lines all have its
label and are learned one by one; then the field is trained on the labels which that
gives the lines, where they agree with the document's (most of its words in
content lines if the label is 1, else not), and on the document's label elsewhere.

Null texts count as empty ones (no words: the base rule fails them); rows with
a null id, repeated rows and ties are judged like any other; texts are taken whole,
whatever their length; an empty table gives an empty result and a model of its
prior weights only; other columns are not read (or, in :func:`keep_good`, passed on).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import forget, written

WORD = re.compile(r"[^\x20\x09-\x0d]+")
#: What str.split takes for blanks besides those between words here.
OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SYMBOLS = "#*$%&|<>"
#: Base rule: at least so many words, at most so many percent of them in repeated windows.
LEAST_WORDS, WINDOW, REPEAT_PERCENT = 10, 5, 20
#: Share of words in content lines from which on a text stays.
SHARE = 0.5
#: Labelled documents learned from, at most, of each label; frequent words kept as function words.
MAX_LABELLED, COMMON = 3000, 150
#: Parts of words that speak of rights, licences and page furniture (fixed values).
CUES = ("copyright", "licens", "licenc", "reserved", "privacy", "cookie", "subscri", "http://", "https://", "www.", "\u00a9", "@", "{", "}")

#: Shares of a line's words, each an indicator at every threshold: marks of SYMBOLS a word, words in capitals, with digits,
#: ending in !, without a letter or digit, without a function word nearby, equal to the word before, in a window that comes again.
SHARES = ("symbols", "capitals", "digits", "shouted", "marks", "function", "same", "again")
STEPS = (0.02, 0.1, 0.25, 0.5, 0.8)
LENGTHS = (3, 6, 12, 25, 60, 200)
FLAGS = ("repeated line", "full stop", "capital first", "cue", "blank before", "first", "last", "short words", "long words")
FEATURES = ("bias", *(f"{s}>{t}" for s in SHARES for t in STEPS), *(f"words>={n}" for n in LENGTHS), *FLAGS)
#: Weights before any label is seen: content, unless a line is full of marks, capitals, shouting or repetition.
PRIOR = np.array([1.0] + [-0.5 if s in ("symbols", "shouted", "marks", "same", "again") and t >= 0.1 else 0.0 for s in SHARES for t in STEPS] + [0.0] * (len(LENGTHS) + len(FLAGS)))
N = len(FEATURES)
RIDGE = 0.5


class Lines:
    """Words, lines and counts of one text."""

    __slots__ = ("text", "lines", "sizes", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "features")


#: Words remembered by a process between texts.
REMEMBERED = 300_000


class Words(dict):
    """Word -> its row in ``about``: characters, marks of SYMBOLS, capitals only, has a digit, ends in ! or ?, no letter or digit, function word, cue."""

    def __init__(self, common: frozenset):
        super().__init__()
        self.common, self.about = common, np.zeros((1024, 8), np.int32)

    def __missing__(self, w: str) -> int:
        n = len(self)
        if n == len(self.about):
            self.about = np.concatenate([self.about, np.zeros_like(self.about)])
        self[w] = n
        bare, low = w.isalpha(), w.lower()
        letters = bare or any(map(str.isalpha, w))
        digits = not bare and any(map(str.isdigit, w))
        marks = 0 if bare else sum(map(w.count, SYMBOLS))
        self.about[n] = (len(w), marks, letters and len(w) > 1 and w.isupper(), digits, w[-1] in "!?", not letters and not any(map(str.isalnum, w)), low.strip(".,;:!?") in self.common, any(c in low for c in CUES))
        return n


_words: Words | None = None


def words_of(common: frozenset) -> Words:
    """The process's memory of words, for these function words; begun anew when it is large (a cache only)."""
    global _words
    if _words is None or len(_words) > REMEMBERED or _words.common != common:
        _words = Words(common)
    return _words


def repeated(ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words stand in a window (of so many words) that comes twice or more; exact, by ranks of windows."""
    n = len(ids) - window + 1
    out = np.zeros(len(ids), bool)
    if n < 2:
        return out
    ids = ids.astype(np.int64)
    base = int(ids.max()) + 1
    pair, which = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)
    often = (np.bincount(which) > 1)[which]
    # a window that comes again is made of pairs that do
    at = np.arange(n)
    for k in range(window - 1):
        at = at[often[at + k]]
    rank = which[at]
    for k in range(2, window):
        if len(at) < 2:
            return out
        rank = np.unique(rank * base + ids[at + k], return_inverse=True)[1]
        twice = (np.bincount(rank) > 1)[rank]
        at, rank = at[twice], rank[twice]
    for k in range(window):
        out[at + k] = True
    return out


def read(text: str | None, common: frozenset = frozenset()) -> Lines:
    """Counts and features of a text."""
    out = Lines()
    out.lines, words, sizes, blank_before = [], [], [], []
    blank = False
    seen: set[str] = set()
    again: list[bool] = []
    text = text or ""
    cut = WORD.findall if OTHER_BLANKS.search(text) else str.split
    for line in text.split("\n"):
        found = cut(line)
        if not found:
            blank = True
            continue
        again.append(line in seen)
        seen.add(line)
        out.lines.append(line)
        blank_before.append(blank)
        blank = False
        sizes.append(len(found))
        words += found
    out.sizes = np.array(sizes, np.int64)
    out.n_words, out.n_dup_lines = len(words), sum(again)
    if not words:
        out.word_chars = out.n_symbols = out.n_repeat_words = 0
        out.features = np.zeros((0, N), np.int8)
        return out
    known = words_of(common)
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    rep = repeated(ids)
    all_ = np.empty((len(words), 10), np.int32)
    all_[:, :8] = known.about[ids]
    all_[0, 8] = 0
    all_[1:, 8] = ids[1:] == ids[:-1]
    all_[:, 9] = rep
    starts = np.cumsum(out.sizes) - out.sizes
    sums = np.add.reduceat(all_, starts, axis=0)
    out.word_chars, out.n_symbols, out.n_repeat_words = int(sums[:, 0].sum()), int(sums[:, 1].sum()), int(sums[:, 9].sum())
    per_word = sums / out.sizes[:, None]
    shares = per_word[:, [1, 2, 3, 4, 5, 6, 8, 9]]
    # lines of any usual text have a function word in four words or less
    shares[:, 5] = 1 - np.minimum(1, shares[:, 5] * 4)
    many = len(out.lines)
    x = np.zeros((many, N), np.int8)
    x[:, 0] = 1
    x[:, 1 : 1 + len(SHARES) * len(STEPS)] = (shares[:, :, None] > np.array(STEPS)).reshape(many, -1)
    at = 1 + len(SHARES) * len(STEPS)
    x[:, at : at + len(LENGTHS)] = out.sizes[:, None] >= np.array(LENGTHS)
    at += len(LENGTHS)
    x[:, at] = again
    x[:, at + 1] = [line.rstrip()[-1:] in (".", "!", "?") for line in out.lines]
    x[:, at + 2] = [line.lstrip()[:1].isupper() for line in out.lines]
    x[:, at + 3] = sums[:, 7] > 0
    x[:, at + 4] = blank_before
    x[0, at + 5] = x[-1, at + 6] = 1
    x[:, at + 7], x[:, at + 8] = per_word[:, 0] < 3.5, per_word[:, 0] > 9
    out.features = x
    return out


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n_words


def viterbi(scores: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Labels (1: content) of the likeliest sequence; of equal ones that with content, from the last line backwards.

    ``scores``: what a line gains from being content.
    """
    n = len(scores)
    if not n:
        return np.zeros(0, np.int64)
    (t00, t01), (t10, t11) = trans.tolist()
    a, b = float(start[0]), float(start[1]) + float(scores[0])
    from_0, from_1 = [0], [0]  # whether the best way to 0 and to 1 comes from 1
    for s in scores[1:].tolist():
        p, q, r, u = a + t00, b + t10, a + t01, b + t11
        from_0.append(q >= p)
        from_1.append(u >= r)
        a, b = (q if q >= p else p), (u if u >= r else r) + s
    out = [int(b >= a)]
    for i in range(n - 1, 0, -1):
        out.append(int(from_1[i] if out[-1] else from_0[i]))
    return np.array(out[::-1])


class Model:
    """Function words and the weights of the field."""

    def __init__(self, common: frozenset, weights: np.ndarray, trans: np.ndarray, start: np.ndarray):
        self.common, self.weights, self.trans, self.start = common, weights, trans, start

    def labels(self, doc: Lines) -> np.ndarray:
        return viterbi(doc.features @ self.weights, self.trans, self.start)


def prior_model(common: frozenset = frozenset()) -> Model:
    return Model(common, PRIOR.copy(), np.array([[0.5, 0.0], [0.0, 0.5]]), np.zeros(2))


def likelihood(theta: np.ndarray, x: np.ndarray, y: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of the labels ``y`` of all lines given the texts, with a ridge towards the prior, and its gradient.

    The lines of text ``d`` are rows ``first[d]`` on; texts come longest first, so that all of them step together.
    """
    w, trans, start = theta[:N], theta[N : N + 4].reshape(2, 2), theta[N + 4 :]
    s = x @ w
    n = len(s)
    fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
    score = np.column_stack([np.zeros(n), s])
    longest = int(length[0]) if len(length) else 0
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(longest)]  # texts longer than t
    fwd[first] = start + score[first]
    for t in range(1, longest):
        at = first[: active[t]] + t
        fwd[at] = np.logaddexp(fwd[at - 1, :1] + trans[0], fwd[at - 1, 1:] + trans[1]) + score[at]
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        into = bwd[at + 1] + score[at + 1]
        bwd[at] = np.logaddexp(trans[:, 0] + into[:, :1], trans[:, 1] + into[:, 1:])
    last = first + length - 1
    z = np.logaddexp(fwd[last, 0], fwd[last, 1])
    whole = np.repeat(z, length)
    p = np.exp(fwd + bwd - whole[:, None])
    inner = np.ones(n, bool)
    inner[last] = False
    i = np.flatnonzero(inner)
    pair = np.exp(fwd[i, :, None] + trans[None] + (score[i + 1] + bwd[i + 1])[:, None, :] - whole[i, None, None]).sum(axis=0)
    told = np.bincount(2 * y[i] + y[i + 1], minlength=4).reshape(2, 2)
    began = np.bincount(y[first], minlength=2)
    gain = float(s[y == 1].sum() + (told * trans).sum() + (began * start).sum() - z.sum())
    prior = np.concatenate([PRIOR, np.zeros(6)])
    grad = np.concatenate([x.T @ (y - p[:, 1]), (told - pair).ravel(), began - p[first].sum(axis=0)])
    gap = theta - prior
    return -gain + RIDGE * float(gap @ gap) / 2, -grad + RIDGE * gap


def descend(f, theta: np.ndarray, rounds: int = 60, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with backtracking."""
    value, grad = f(theta)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, coef = grad.copy(), []
        for s, g in reversed(moves):
            a = (s @ d) / (s @ g)
            coef.append(a)
            d -= a * g
        d = d * ((moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, float(np.abs(grad).sum())))
        for (s, g), a in zip(moves, reversed(coef), strict=True):
            d += (a - (g @ d) / (s @ g)) * s
        step, slope = 1.0, float(grad @ d)
        while step > 1e-10:
            to = theta - step * d
            new, slopes = f(to)
            if new <= value - 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        if (to - theta) @ (slopes - grad) > 1e-12:
            moves = [*moves, (to - theta, slopes - grad)][-memory:]
        done = value - new < 1e-7 * (1 + abs(new))
        theta, value, grad = to, new, slopes
        if done:
            break
    return theta


def agreeing(labels: np.ndarray, sizes: np.ndarray, good: int) -> np.ndarray:
    """The field's labels of a document's lines, if they agree with the document's label; else that label for all of them."""
    share = float((labels * sizes).sum()) / float(sizes.sum())
    return labels if (share >= SHARE) == bool(good) else np.full(len(labels), good)


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], common: frozenset) -> Model:
    """A model of ``(features, words a line, label)`` of documents with lines.

    First every line stands alone, with its document's label; then the lines' own labels come from what that taught,
    as far as they agree with the document, and the whole field is trained.  Documents of one kind
    would teach that labels never change within a text; so each document of one label is also
    seen within one of the other label, in its middle (as many as there are of the rarer label).
    """
    docs = [d for d in docs if len(d[1])]
    model = prior_model(common)
    if not docs:
        return model
    lines = np.concatenate([d[0] for d in docs]).astype(np.float64)
    ends = np.cumsum([len(d[1]) for d in docs])
    own = [np.arange(e - len(d[1]), e) for d, e in zip(docs, ends.tolist(), strict=True)]
    told = np.concatenate([np.full(len(d[1]), d[2]) for d in docs])
    theta = np.concatenate([PRIOR, np.zeros(6)])
    theta = descend(lambda t: likelihood(t, lines, told, np.arange(len(told)), np.ones(len(told), np.int64)), theta)
    alone = lines @ theta[:N] + theta[N + 5] - theta[N + 4] > 0
    told = np.concatenate([agreeing(alone[r].astype(np.int64), d[1], d[2]) for r, d in zip(own, docs, strict=True)])
    sides = [[r for r, d in zip(own, docs, strict=True) if d[2] == good] for good in (0, 1)]
    spliced = [np.concatenate([g[: len(g) // 2], b, g[len(g) // 2 :]]) for b, g in zip(*sides, strict=False)]
    sequences = sorted([*own, *spliced], key=lambda r: -len(r))
    length = np.array([len(r) for r in sequences])
    first, order = np.cumsum(length) - length, np.concatenate(sequences)
    x, y = lines[order], told[order]
    theta = descend(lambda t: likelihood(t, x, y, first, length), theta)
    return Model(common, theta[:N], theta[N : N + 4].reshape(2, 2), theta[N + 4 :])


def fit(docs: DataFrame, labels: DataFrame, folds: int = 0) -> Model:
    """Learns from at most ``MAX_LABELLED`` documents of each quality, those of the least hashes.

    With ``folds``, those whose crc32(doc_id as text) is a multiple of it are held out.  Documents with
    contradicting labels teach nothing; of several texts of an id the least does.
    """
    spark = docs.sparkSession
    own = labels.filter(labels["quality"].isNotNull() & labels["doc_id"].isNotNull())
    if folds:
        own = own.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) != 0)
    own = own.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("most")).filter("q = most").select(F.col("doc_id").alias("id_"), F.col("q").cast("int").alias("good"), F.xxhash64("doc_id").alias("h_"))
    chosen = reduce(DataFrame.unionByName, [own.filter(F.col("good") == y).orderBy("h_", "id_").limit(MAX_LABELLED).select("id_", "good") for y in (0, 1)])
    narrow = docs.select(docs["doc_id"].cast("long").alias("id_"), docs["text"].alias("text"))
    # bounded by the parameter, hence safe to send everywhere
    sample = written(narrow.join(F.broadcast(chosen), "id_").groupBy("id_", "good").agg(F.min("text").alias("text")), "quality-sample")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0):
                counts.update({w.strip(".,;:!?").lower() for w in WORD.findall(t.as_py() or "")})
        pairs = list(counts.items())
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.int64())], names=["word", "n"])

    words = sample.filter("good = 1").select("text").mapInArrow(tally, "word string, n long").filter("word rlike '^[\\\\p{L}]+$'").groupBy("word").agg(F.sum("n").alias("n"))
    common = frozenset(r[0] for r in words.orderBy(F.desc("n"), "word").limit(COMMON).collect())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for good, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                d = read(t.as_py(), common)
                yield pa.RecordBatch.from_arrays([pa.array([good], pa.int32()), pa.array([d.features.tobytes()], pa.binary()), pa.array([d.sizes.tobytes()], pa.binary())], names=["good", "x", "sizes"])

    told = sample.select("good", "text").mapInArrow(gather, "good int, x binary, sizes binary").collect()  # at most 2 * MAX_LABELLED rows
    forget(sample)
    told.sort(key=lambda r: (r["good"], bytes(r["sizes"]), bytes(r["x"])))
    return train([(np.frombuffer(bytes(r["x"]), np.int8).reshape(-1, N), np.frombuffer(bytes(r["sizes"]), np.int64), r["good"]) for r in told], common)


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_words long, base_failed boolean, kept boolean"


def verdict(doc: Lines, model: Model) -> tuple[int, bool, bool]:
    """(words in content lines, whether the base rule fails it, whether it stays)."""
    content = int((model.labels(doc) * doc.sizes).sum())
    failed = base_failed(doc.n_words, doc.n_repeat_words)
    return content, failed, not failed and content >= SHARE * doc.n_words


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """``SCHEMA`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column(1):
                d = read(t.as_py(), shared.value.common)
                rows.append((d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines, d.n_repeat_words, *verdict(d, shared.value)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 8
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, SCHEMA)


def marked_lines(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, line_no, line, content`` of every line with a word; ``line_no`` counts these lines from 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                d = read(t.as_py(), shared.value.common)
                content = shared.value.labels(d).astype(bool)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(content), pa.int64()), pa.array(range(len(content)), pa.int32()), pa.array(d.lines, pa.string()), pa.array(content, pa.bool_())], names=["doc_id", "line_no", "line", "content"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, "doc_id long, line_no int, line string, content boolean")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that stay, all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([verdict(read(t.as_py(), shared.value.common), shared.value)[2] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
