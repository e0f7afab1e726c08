"""Toxicity of documents by misspelling-tolerant lexicon matches in context.

Lexicon.  Terms are learned from labelled training rows (a bounded sample, see
``MAX_LABELLED``): whole words of 4 to 16 letters and word beginnings ("stems") of 4 to 7 that occur in
toxic documents and hardly elsewhere, at most ``MAX_TERMS``, joined with a short seed list.

Matching.  The terms form a trie.  Levenshtein automata of distance one (a
letter inserted, left out or replaced, or two neighbours swapped) are
intersected with it by subset construction: a state is a set of (trie node,
edits so far), and the product is determinised into one table over byte
classes.  Terms of under five letters are matched exactly: at distance one
they meet too many common words.  All words of a batch walk that table side by side, a character a
step; dead states drop out at once.  Words at distance one are judged by their
own record in the training sample, so that an innocent neighbour of a term does
not count.

Context.  Each match, misspelt or not, is quoted if it stands between paired
quotation marks of its line, however long the quotation, else direct.  Marks pair by a stack;
an apostrophe between letters is no mark, and a mark that stands against only
one of its neighbours opens or closes by that.  The words in a window around
each match are cues: their log-odds (toxic against clean documents with
matches, shrunk towards none) are learned from the sample, in any language, and
their sum is the window's score.  A logistic model over the match counts (direct, quoted,
misspelt, density) and the mean score of the windows gives the document's score.

Nulls and empty texts score as documents without a match.  Very long texts are
scored whole.  Repeated rows give repeated results; of a labelled id's several
texts the least trains.  Labels that are null, or of ids with contradictory labels,
do not train; of equally supported terms the shorter, then the later in the
alphabet comes first.  Other columns (lang, source, ids) are never inputs of a score.
With no labelled row the seed list and prior weights are used; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import forget, written

SEEDS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "pathetic", "worthless", "disgusting", "clown")
#: Labelled rows that train the lexicon and the model, at most: so many of each label, those of least hash.
MAX_LABELLED = 12_000
#: Lexicon size at most; letters of stems; toxic documents that must hold a term, and their share.
MAX_TERMS, STEM_LETTERS, MIN_SUPPORT, SUPPORT_SHARE = 400, (4, 5, 6, 7), 4, 0.005
#: Words to each side of a match that are its window, within so many characters; documents a cue needs, documents its odds are shrunk by, cues at most.
WINDOW, REACH, MIN_CUE, SHRINK, MAX_CUES = 6, 120, 20, 20.0, 4096
FEATURES = ("bias", "direct", "quoted", "misspelt", "density", "stem", "context")
PRIOR = np.array([-3.0, 3.0, 0.5, 0.8, 0.5, 2.0, 0.0])

WORD = re.compile(r"[^\W_]+")
#: What each quotation mark closes; the marks that may be apostrophes.
CLOSES = {'"': '"', "”": "“„”", "“": "„", "»": "«", "«": "»", "'": "'", "’": "‘’"}
SINGLE_QUOTES = "'’"
MARK = re.compile("[\n\"“”„«»‘'’]")
BLANK, ASCII_SIZE = 0, 128


class Matcher:
    """The determinised product of distance-one automata and the trie of terms."""

    DEAD = 0

    def __init__(self, terms: list[str], stems: list[str]):
        self.terms, self.stems = sorted(set(terms)), sorted(set(stems))
        letters = sorted({c for t in [*self.terms, *self.stems] for c in t})
        self.cls = {c: i + 1 for i, c in enumerate(letters)}  # class 0: any other character
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [0]  # bit 1: a term ends, bit 2: a stem ends
        deep: list[int] = [0]
        for words, bit in ((self.terms, 1), (self.stems, 2)):
            for w in words:
                node = 0
                for c in w:
                    node_next = children[node].get(self.cls[c])
                    if node_next is None:
                        node_next = len(children)
                        children[node][self.cls[c]] = node_next
                        children.append({})
                        ends.append(0)
                        deep.append(0)
                    node = node_next
                ends[node] |= bit
                deep[node] = len(w)
        fuzzy = {0}  # nodes on the way to terms long enough to be matched with an edit
        for w in self.terms:
            if len(w) >= 5:
                node = 0
                for c in w:
                    node = children[node][self.cls[c]]
                    fuzzy.add(node)
        IN_STEM = -1

        def close(items: set) -> frozenset:
            """Adds what deletions of a term's letter reach."""
            out = set(items)
            for node, edits in items:
                if edits == 0 and node >= 0:
                    out |= {(n, 1) for n in children[node].values() if n in fuzzy}
            # with no edit left, a node reached with fewer edits covers it
            return frozenset((n, e) for n, e in out if e == 0 or (n, 0) not in out)

        def step(items: frozenset, c: int) -> frozenset:
            out = set()
            for node, edits in items:
                if node == IN_STEM:
                    out.add((IN_STEM, 0))
                    continue
                if edits < 0:  # the second of two swapped letters is still to come
                    if c == -edits:
                        out.add((node, 1))
                    continue
                n = children[node].get(c)
                if n is not None and (edits == 0 or n in fuzzy):
                    out.add((IN_STEM if ends[n] & 2 and edits == 0 else n, edits))
                    if ends[n] & 2 and edits == 0:
                        out.add((n, 0))
                if edits == 0:
                    if node in fuzzy:
                        out.add((node, 1))  # inserted letter
                    for first, n in children[node].items():
                        swapped = children[n].get(c)
                        if swapped in fuzzy and first != c:
                            out.add((swapped, -first))
                    out |= {(n, 1) for n in children[node].values() if n in fuzzy}  # replaced letter
            return close(out)

        def accept(items: frozenset) -> int:
            """0 nothing, 1 a term, 2 a stem begins the word, 3 a term at distance one."""
            if any(n >= 0 and e == 0 and ends[n] & 1 for n, e in items):
                return 1
            if any(n == IN_STEM or e == 0 and ends[n] & 2 for n, e in items):
                return 2
            return 3 if any(n in fuzzy and e >= 0 and ends[n] & 1 and deep[n] >= 5 for n, e in items) else 0

        size = len(letters) + 1
        ids = {frozenset(): 0}
        order = [frozenset()]
        start = close({(0, 0)})
        ids[start] = 1
        order.append(start)
        table, kinds = [], []
        at = 0
        while at < len(order):
            s = order[at]
            row = []
            for c in range(size):
                t = step(s, c) if s else frozenset()
                if t not in ids:
                    ids[t] = len(order)
                    order.append(t)
                row.append(ids[t])
            table.append(row)
            kinds.append(accept(s))
            at += 1
        self.table = np.array(table, np.int32)
        self.kinds = np.array(kinds, np.uint8)
        # code points below LIMIT map straight to classes; the rest are class 0
        limit = max([127, *map(ord, self.cls)]) + 2
        self.classes = np.zeros(limit, np.int32)
        for c, i in self.cls.items():
            self.classes[ord(c)] = i

    def words(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The kind of match of each word points[start:end]; all words step together."""
        cls = self.classes[np.minimum(points, len(self.classes) - 1)]
        kind = np.zeros(len(starts), np.uint8)
        live = np.arange(len(starts))
        state = np.ones(len(starts), np.int32)
        pos = starts.astype(np.int64)
        last = ends.astype(np.int64)
        flat, size = self.table.ravel(), self.table.shape[1]
        stem_only = (self.kinds == 2) & (self.table == np.arange(len(self.table))[:, None]).all(axis=1)
        while len(live):
            done = pos >= last
            settled = done | stem_only[state]
            kind[live[settled]] = self.kinds[state[settled]]
            go = ~settled
            live, state, pos, last = live[go], state[go], pos[go], last[go]
            state = flat[state * size + cls[pos]]
            pos = pos + 1
            alive = state != self.DEAD
            live, state, pos, last = live[alive], state[alive], pos[alive], last[alive]
        return kind


def word_spans(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters and digits."""
    edge = np.diff(ALNUM[np.minimum(points, len(ALNUM) - 1)].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: Letters and digits by code point; those beyond the table count as letters.
ALNUM = np.array([chr(i).isalnum() for i in range(0x3000)] + [True])


def matches(text: str, matcher: Matcher) -> list[tuple[int, int, int]]:
    """(start, end, kind) of matched words in the lower-cased text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends = word_spans(points)
    kinds = matcher.words(points, starts, ends)
    hit = np.flatnonzero(kinds)
    return [(int(starts[i]), int(ends[i]), int(kinds[i])) for i in hit]


def quotations(text: str) -> list[tuple[int, int]]:
    """(start, end) of what stands between paired quotation marks of one line, by end."""
    out: list[tuple[int, int]] = []
    opened: list[tuple[str, int]] = []
    for m in MARK.finditer(text):
        c, i = m.group(), m.start()
        if c == "\n":
            opened = []
            continue
        left, right = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
        if c in SINGLE_QUOTES and left.isalnum() and right.isalnum():
            continue
        # with a blank on one side only, that side tells; else the marks before it do
        closes, opens = bool(left.strip()), bool(right.strip())
        if not opens and not closes:
            closes = opens = True
        if c in SINGLE_QUOTES:
            opens &= not left.isalnum()
        if opens and closes and c in "\"'":
            closes = left.isalnum() or not right.isalnum()
        at = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] in CLOSES.get(c, "")), -1) if closes else -1
        if at >= 0:
            out.append((opened[at][1] + 1, i))
            del opened[at:]
        elif opens:
            # a mark that opens again leaves an earlier one of its kind without a partner
            opened = [o for o in opened if o[0] != c]
            opened.append((c, i))
    return out


def inside(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the quotations (by end) holds the match."""
    return any(a <= start for a, _ in spans[bisect_left(spans, end, key=lambda s: s[1]) :])


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the match stands between paired quotation marks."""
    return inside(quotations(text), start, end)


def window(text: str, start: int, end: int) -> list[str]:
    """The words around a match."""
    return WORD.findall(text[max(0, start - REACH) : start])[-WINDOW:] + WORD.findall(text[end : end + REACH])[:WINDOW]


def evidence(text: str, found: list[tuple[int, int, int]]) -> tuple[list[int], list[str], list[str], list[tuple[str, list[str]]]]:
    """[direct terms, quoted ones, stems, length of the text], misspelt words, quoted misspelt words, and each match's window.

    A window comes with the misspelt word it is about (else an empty one) and leaves other matches out.
    """
    direct = quote = stem = 0
    wrong: list[str] = []
    wrong_quoted: list[str] = []
    windows: list[tuple[str, list[str]]] = []
    matched = {text[a:b] for a, b, _ in found}
    spans = enclosing(quotations(text)) if found else []
    for a, b, kind in found:
        said = inside(spans, a, b)
        windows.append((text[a:b] if kind == 3 else "", [w for w in window(text, a, b) if w not in matched]))
        if kind == 3:
            (wrong_quoted if said else wrong).append(text[a:b])
        elif said:
            quote += 1
        elif kind == 2:
            stem += 1
        else:
            direct += 1
    return [direct, quote, stem, len(text)], wrong, wrong_quoted, windows


def enclosing(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The outermost of nested quotations."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        while out and a <= out[-1][0]:
            out.pop()
        out.append((a, b))
    return out


def features(counts: list[int], wrong: list[str], wrong_quoted: list[str], windows: list[tuple[str, list[str]]], innocent: frozenset, cues: dict[str, float] | None = None) -> np.ndarray:
    """Dampened by logarithms, in the order of FEATURES; words near a term that are innocent don't count."""
    direct, quote, stem, length = counts
    misspelt = sum(w not in innocent for w in wrong)
    quote += sum(w not in innocent for w in wrong_quoted)
    told = [sum((cues or {}).get(w, 0.0) for w in near) for about, near in windows if about not in innocent]
    context = min(4.0, max(-4.0, sum(told) / len(told))) if told else 0.0
    return np.array([1.0, np.log1p(direct), np.log1p(quote), np.log1p(misspelt), np.log1p(1000.0 * (direct + stem) / (length + 100)), np.log1p(stem), context])


def cue_odds(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log-odds of a cue that so many toxic and clean documents of all with matches have in a window; none where nothing is known."""
    rate = SHRINK * (toxic + clean) / (all_toxic + all_clean)
    return math.log((toxic + rate) / (all_toxic + SHRINK)) - math.log((clean + rate) / (all_clean + SHRINK))


class Model:
    """A matcher, words near a term that are innocent, logistic weights and the odds of cues; scores texts."""

    def __init__(self, matcher: Matcher, innocent: frozenset, weights: np.ndarray, cues: dict[str, float] | None = None):
        self.matcher, self.innocent, self.weights, self.cues = matcher, innocent, weights, cues or {}

    def scores(self, texts: list[str | None]) -> list[float]:
        # all texts in one array: their words step through the automaton together
        low = [(t or "").lower() for t in texts]
        joined = "\n".join(low)
        found: list[list] = [[] for _ in low]
        bounds = np.cumsum([len(t) + 1 for t in low])
        begins = bounds - [len(t) + 1 for t in low]
        for a, b, kind in matches(joined, self.matcher):
            i = int(np.searchsorted(bounds, a, side="right"))
            off = int(begins[i])
            found[i].append((a - off, b - off, kind))
        empty = float(self.weights[0])
        z = [float(features(*evidence(t, f), self.innocent, self.cues) @ self.weights) if f else empty for t, f in zip(low, found, strict=True)]
        return [float(1 / (1 + np.exp(-x))) for x in z]


def candidates(text: str) -> set[tuple[str, bool]]:
    """(term, whether a stem) a document offers to the lexicon."""
    out = set()
    for w in set(WORD.findall(text.lower())):
        if 4 <= len(w) <= 16:
            out.add((w, False))
        for n in STEM_LETTERS:
            if len(w) > n:
                out.add((w[:n], True))
    return out


def held_out(doc_id: int | None, folds: int = 5) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == 0


def choose_terms(counts: list[tuple[str, bool, int, int]], toxic: int, clean: int) -> tuple[list[str], list[str]]:
    """Terms and stems by decreasing support among those that clean documents hardly hold."""
    ratio = max(1, clean) / max(1, toxic)
    good = [(p, -len(t), t, s) for t, s, p, n in counts if p >= max(MIN_SUPPORT, toxic * SUPPORT_SHARE) and n * 25 <= p * ratio]
    terms, stems = [], []
    for _, _, t, s in sorted(good, reverse=True):
        if len(terms) + len(stems) >= MAX_TERMS:
            break
        if not any(t.startswith(x) for x in stems):
            (stems if s else terms).append(t)
    # a word that is a term needs no beginning of its own as a stem, unless that stem reaches more words
    return terms, stems


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from at most ``MAX_LABELLED`` training rows of each label."""
    spark = docs.sparkSession
    own = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0))
    own = own.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").select(F.col("doc_id").alias("id_"), F.col("toxic").cast("int").alias("toxic_"), F.xxhash64("doc_id").alias("h_"))
    # bounded by the parameter, hence safe to send everywhere
    chosen = reduce(DataFrame.unionByName, [own.filter(F.col("toxic_") == y).orderBy("h_", "id_").limit(MAX_LABELLED).select("id_", "toxic_") for y in (0, 1)])
    narrow = docs.select(docs["doc_id"].cast("long").alias("id_"), docs["text"].alias("text"))
    sample = written(narrow.join(F.broadcast(chosen), "id_").groupBy("id_", "toxic_").agg(F.min("text").alias("text")), "toxic-sample")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
        for batch in batches:
            for y, t in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                yield (t.as_py() or "").lower(), y

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[tuple[str, bool], list[int]] = {}
        size = [0, 0]
        for text, y in rows(batches):
            size[y] += 1
            for c in candidates(text):
                tally.setdefault(c, [0, 0])[y] += 1
        items = [(t, s, n[1], n[0]) for (t, s), n in tally.items()] + [("", False, size[1], size[0])]
        cols = list(zip(*items, strict=True))
        for i in range(0, len(items), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(cols[0][i : i + 50_000], pa.string()), pa.array(cols[1][i : i + 50_000], pa.bool_()), pa.array(cols[2][i : i + 50_000], pa.int64()), pa.array(cols[3][i : i + 50_000], pa.int64())], names=["term", "stem", "toxic", "clean"])

    counts = sample.mapInArrow(count, "term string, stem boolean, toxic long, clean long").groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = written(counts, "toxic-terms")
    sizes = counts.filter("term = ''").agg(F.sum("toxic"), F.sum("clean")).first()
    toxic, clean = int(sizes[0] or 0), int(sizes[1] or 0)
    ratio = max(1, clean) / max(1, toxic)
    top = counts.filter((F.col("term") != "") & (F.col("toxic") >= max(MIN_SUPPORT, toxic * SUPPORT_SHARE)) & (F.col("clean") * 25 <= F.col("toxic") * ratio))
    # a document of bounded share holds a term: so many terms can pass, at most, as documents hold words
    terms, stems = choose_terms([tuple(r) for r in top.select("term", "stem", "toxic", "clean").toLocalIterator()], toxic, clean)
    matcher = Matcher([*SEEDS, *terms], stems)
    shared = spark.sparkContext.broadcast(matcher)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Once a document: misspelt words, cues, and (an empty cue) that it has a match."""
        tally: dict[tuple[str, bool], list[int]] = {}
        for low, y in rows(batches):
            _, wrong, said, windows = evidence(low, matches(low, shared.value))
            exact = [near for about, near in windows if not about]
            for key in {(w, True) for w in (*wrong, *said)} | {(w, False) for near in exact for w in near} | ({("", False)} if exact else set()):
                tally.setdefault(key, [0, 0])[y] += 1
        cols = list(zip(*((w, m, n[1], n[0]) for (w, m), n in tally.items()), strict=True)) or [()] * 4
        for i in range(0, len(cols[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[i : i + 50_000], t) for c, t in zip(cols, (pa.string(), pa.bool_(), pa.int64(), pa.int64()), strict=True)], names=["w", "misspelt", "toxic", "clean"])

    seen = sample.mapInArrow(around, "w string, misspelt boolean, toxic long, clean long").groupBy("w", "misspelt").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    seen = written(seen, "toxic-windows")
    # at most the words an edit away from the lexicon
    innocent = frozenset(r["w"] for r in seen.filter("misspelt AND clean * 4 > toxic").select("w").toLocalIterator())
    cited = seen.filter("NOT misspelt AND w = ''").first()
    often = seen.filter(~F.col("misspelt") & (F.col("w") != "") & (F.col("toxic") + F.col("clean") >= MIN_CUE)).orderBy(F.desc(F.col("toxic") + F.col("clean")), "w").limit(MAX_CUES).collect()
    cues = {r["w"]: cue_odds(r["toxic"], r["clean"], cited["toxic"], cited["clean"]) for r in often}
    known = spark.sparkContext.broadcast((innocent, cues))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for low, y in rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([features(*evidence(low, matches(low, shared.value)), *known.value)], pa.list_(pa.float64()))], names=["y", "x"])

    told = sample.mapInArrow(vectors, "y int, x array<double>").collect()  # at most 2 * MAX_LABELLED rows of a fixed size
    for t in (counts, sample, seen):
        forget(t)
    if not told:
        return Model(matcher, innocent, PRIOR.copy())
    told.sort(key=lambda r: (r["y"], r["x"]))  # sums don't depend on the order of rows
    return Model(matcher, innocent, logistic(np.array([r["x"] for r in told]), np.array([r["y"] for r in told], float)), cues)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method on the log-likelihood with a ridge towards PRIOR."""
    w = PRIOR.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * (w - PRIOR)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(h, g)
        w = w - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return w


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
#: Texts are scored in groups of about so many characters.
GROUP_CHARS = 1_000_000


def groups(texts: pa.Array) -> Iterator[list[str | None]]:
    out, size = [], 0
    for t in texts:
        s = t.as_py()
        out.append(s)
        size += len(s or "")
        if size >= GROUP_CHARS:
            yield out
            out, size = [], 0
    if out:
        yield out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            scores = [s for g in groups(batch.column(1)) for s in shared.value.scores(g)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([held_out(d) for d in ids]), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, whose score is below one half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [s for g in groups(batch.column(at)) for s in shared.value.scores(g)]
            yield batch.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
