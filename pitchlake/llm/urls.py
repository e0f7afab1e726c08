"""URL filter: explicit rules, else naive Bayes over segmented host and path words.

Host labels and path parts are split at marks, and concatenated names are split
further by a unigram Viterbi segmentation whose word counts come from all urls
of the table: first from words that stand alone, then from all runs as those
words split them, so a name made of other words has no count of its own.
A multinomial naive Bayes model scores the words.  It learns from all urls,
labelled weakly: a url whose segmented host words hold a seed word is unwanted.
In the first model no word is taught by itself: for each word of a url, the label comes from the
seeds among the url's *other* words, and a seed that alone would label its url
isn't counted there; a prior (``SEED_RATIO``) stands in for what seeds are worth.
From there the model is fitted by expectation maximization (``ROUNDS`` passes): every url is unwanted to the degree the
last model says, and all words are counted by those degrees; a seed then is worth no more than ``SEED_WEIGHT`` observations besides its own.  So a
word that keeps company with unwanted ones becomes evidence, and a seed among wanted ones loses its weight.  Degrees are whole numbers of ``UNIT``, so sums don't depend on their order.

Words of hosts are split by what stands in hosts only; words of paths by what stands in either.

A run of more than ``MAX_LETTERS`` letters is no word and isn't counted as one,
but split like any other; the vocabulary and the odds hold the ``MAX_WORDS``
commonest words (and all seeds), and further words are unknown ones to the model.
Words of one host split the same way everywhere.  Null urls and urls without ``://`` have an
empty host and path: no rule fits, and the model sees no word, so its prior
decides.  Very long urls are read whole.  Of equally cheap splits the one whose
last word is shortest wins.  Repeated rows count and give repeated
results, an empty table an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import forget, written

#: (verdict, host, path): fixed values.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))
#: Words of common classes of unwanted hosts: gambling, medicines, adult, credit, forgery, spam, advertising, malware.
SEEDS = ("casino", "bet", "bets", "poker", "jackpot", "pills", "viagra", "cheap", "xxx", "porn", "adult", "loan", "loans", "replica", "spam", "ads", "adserver", "malware", "phishing", "warez")
#: How much likelier a seed is in unwanted hosts than in others before any evidence.
SEED_RATIO = 1000.0
#: Passes of expectation maximization, and the parts in which degrees are counted.
ROUNDS, UNIT = 4, 1 << 26
#: Observations that every word has beforehand, and those a seed has among unwanted ones, in these passes.
PSEUDO, SEED_WEIGHT = 1.0, 8.0
#: Share of words that come from all urls alike, so that no single word settles a verdict.
MIXED = 0.03
#: Words in the segmentation's vocabulary, and letters in a word, at most.
MAX_WORDS, MAX_LETTERS = 1 << 16, 24
WORD = re.compile("[a-z]+")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


@dataclass
class Segmenter:
    """Unigram Viterbi segmentation of a run of letters."""

    counts: dict[str, int]
    total: int = field(init=False)
    memory: dict[str, tuple[str, ...]] = field(init=False, default_factory=dict)

    def __post_init__(self):
        self.total = sum(self.counts.values()) + 1

    def cost(self, word: str) -> float:
        """Negative log probability; unknown words cost more with each letter."""
        n = self.counts.get(word)
        return math.log(self.total / n) if n else math.log(self.total) + 2.5 * len(word)

    def split(self, run: str) -> tuple[str, ...]:
        found = self.memory.get(run)
        if found is None:
            best, back = [0.0], [0]
            for j in range(1, len(run) + 1):
                options = ((best[i] + self.cost(run[i:j]), -i) for i in range(max(0, j - MAX_LETTERS), j))
                c, i = min(options)
                best.append(c)
                back.append(-i)
            out, j = [], len(run)
            while j:
                out.append(run[back[j] : j])
                j = back[j]
            found = tuple(reversed(out))
            if len(self.memory) >= 200_000:
                self.memory.clear()
            if len(run) <= 64:
                self.memory[run] = found
        return found


@dataclass
class Model:
    """Segmenter plus the log-odds (unwanted against wanted) of words."""

    segmenter: Segmenter
    odds: dict[str, float]
    unknown: float
    prior: float
    paths: Segmenter | None = None

    def words(self, host: str, path: str) -> list[str]:
        """Segmented words; those of the host carry a mark of their own."""
        out = ["h:" + w for run in WORD.findall(host) for w in self.segmenter.split(run)]
        paths = self.paths or self.segmenter
        return out + ["p:" + w for run in WORD.findall(path.lower()) for w in paths.split(run)]

    def score(self, host: str, path: str) -> float:
        return self.weigh(self.words(host, path))

    def weigh(self, words: list[str]) -> float:
        return self.prior + sum(self.odds.get(w, self.unknown) for w in words)

    def degree(self, words: list[str]) -> int:
        """How far a url of these words is unwanted, from 0 to ``UNIT``."""
        s = self.weigh(words)
        return round(UNIT / (1 + math.exp(-s))) if s > -50 else 0


def word_counts(runs: list[tuple[str, int, int, int]]) -> dict[str, int]:
    """Counts for the segmentation from runs of letters: (run, times marked off within a part, as a whole path part, as a whole host label).

    What is marked off stands alone, and so does a path part, unless words marked off make it up.
    A host label may be several words: it counts for those it splits into.
    """

    def seeded(counts: dict[str, int]) -> dict[str, int]:
        more = max(1, sum(counts.values()) // 10_000)
        return counts | {w: counts.get(w, 0) + more for w in SEEDS}

    counts = {w: marked for w, marked, _, _ in runs if marked}

    def spread(which: int, only_known: bool) -> None:
        segmenter = Segmenter(seeded(counts))
        for row in runs:
            if row[which]:
                words = segmenter.split(row[0])
                if row[0] in SEEDS or only_known and (row[1] or not all(w in segmenter.counts and len(w) > 2 for w in words)):
                    words = (row[0],)
                for w in words:
                    counts[w] = counts.get(w, 0) + row[which]

    spread(2, True)
    spread(3, False)
    return seeded(counts)


def fit(pages: DataFrame, rounds: int = ROUNDS) -> Model:
    """Counts over all urls; the vocabulary is cut to the ``MAX_WORDS`` commonest words, seeds always in.

    Without ``rounds``, or where no host has a seed, the first model is the result.
    """
    host, path = host_path(F.col("url"))
    parts = pages.select(host.alias("h"), path.alias("p"))
    labels = F.transform(F.split("h", "[./:@]"), lambda x: F.struct(F.lit(True).alias("host"), x.alias("part")))
    pieces = F.transform(F.split(F.lower("p"), "[./]"), lambda x: F.struct(F.lit(False).alias("host"), x.alias("part")))
    words = parts.select(F.explode(F.concat(labels, pieces)).alias("x")).select("x.host", F.regexp_extract_all("x.part", F.lit("([a-z]+)"), F.lit(1)).alias("ws"))
    runs = words.select("host", (F.size("ws") > 1).alias("marked"), F.explode("ws").alias("w")).filter(F.length("w") <= MAX_LETTERS)
    n = lambda what: F.sum(F.when(what, 1).otherwise(0))
    marked, host_ = F.col("marked"), F.col("host")
    top = runs.groupBy("w").agg(F.count("*").alias("count"), n(marked).alias("marked"), n(marked & host_).alias("within"), n(~marked & ~host_).alias("piece"), n(~marked & host_).alias("label")).orderBy(F.desc("count"), "w").limit(MAX_WORDS).collect()
    hosts = Segmenter(word_counts([(r["w"], r["within"], 0, r["label"]) for r in top if r["within"] + r["label"]]))
    paths = Segmenter(word_counts([(r["w"], r["marked"], r["piece"], r["label"]) for r in top]))
    shell = Model(hosts, {}, 0.0, 0.0, paths)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shell.words(h, p) for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["words"])

    split_urls = written(parts.mapInArrow(split, "words array<string>"), "url-words")
    labelled = tallied(split_urls, taught)
    model = bayes(hosts, *labelled)
    model.paths = paths
    for _ in range(rounds if labelled[2] else 0):
        model = refitted(model, *tallied(split_urls, shared_out(model)))
    forget(split_urls)
    return model


def tallied(split_urls: DataFrame, told: Callable[[list[str]], Iterable[tuple[str, int, int]]]) -> tuple[list[tuple[str, int, int]], int, int, int, int, int]:
    """What ``told`` says of the words of all urls, summed: (word, wanted, unwanted) of the commonest words; the sums of urls (the empty word), of words, and the number of words."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, list[int]] = {}
        for batch in batches:
            for words in batch.column(0).to_pylist():
                for w, good, bad in told(words):
                    n = got.setdefault(w, [0, 0])
                    n[0] += good
                    n[1] += bad
            if len(got) > 200_000:
                yield batch_of(got)
                got = {}
        yield batch_of(got)

    def batch_of(got: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array([n[0] for n in got.values()], pa.int64()), pa.array([n[1] for n in got.values()], pa.int64())], names=["w", "good", "bad"])

    counts = written(split_urls.mapInArrow(tally, "w string, good long, bad long").groupBy("w").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")), "url-counts")
    sums = counts.agg(F.sum(F.when(F.col("w") == "", F.col("good"))), F.sum(F.when(F.col("w") == "", F.col("bad"))), F.sum(F.when(F.col("w") != "", F.col("good"))), F.sum(F.when(F.col("w") != "", F.col("bad"))), F.count_if(F.col("w") != "")).first()
    rows = counts.filter("w != ''").orderBy(F.desc(F.col("good") + F.col("bad")), "w").limit(2 * MAX_WORDS).collect()
    forget(counts)
    return [(r["w"], r["good"], r["bad"]) for r in rows], *(int(x or 0) for x in sums)


def shared_out(model: Model) -> Callable[[list[str]], Iterator[tuple[str, int, int]]]:
    """Counts every word of a url, and the url itself, by the degree the model gives the url."""

    def told(words: list[str]) -> Iterator[tuple[str, int, int]]:
        bad = model.degree(words)
        for w in ("", *words):
            yield w, UNIT - bad, bad

    return told


def taught(words: list[str]) -> Iterator[tuple[str, int, int]]:
    """(word, times wanted, times unwanted) for the words of one url, and the url itself under the empty word.

    A word's label comes from seeds of the host among the other words; a lone seed isn't counted.
    """
    seeds = {w for w in words if w in SEED_MARKS}
    yield "", int(not seeds), int(bool(seeds))
    for w in words:
        if not seeds:
            yield w, 1, 0
        elif seeds != {w}:
            yield w, 0, 1


SEED_MARKS = frozenset("h:" + w for w in SEEDS)


def bayes(segmenter: Segmenter, counts: list[tuple[str, int, int]], urls_good: int, urls_bad: int, good: int, bad: int, size: int) -> Model:
    """The model of (word, count in wanted, count in unwanted) and their totals, with add-one smoothing and the seeds' prior.

    A seed has one observation more among wanted ones' and ``SEED_RATIO`` times that, scaled, among unwanted ones'.
    """
    scale = (bad + size + 1) / (good + size + 1)
    base = -math.log(scale)
    prior = {w: (1.0, SEED_RATIO * scale) for w in SEED_MARKS}
    odds = {w: math.log((b + prior.get(w, (1, 1))[1]) / (g + prior.get(w, (1, 1))[0])) + base for w, g, b in counts}
    odds = {w: math.log(SEED_RATIO) for w in SEED_MARKS} | odds
    return Model(segmenter, odds, base if bad else 0.0, math.log((urls_bad + 1) / (urls_good + 1)))


def refitted(model: Model, counts: list[tuple[str, int, int]], urls_good: int, urls_bad: int, good: int, bad: int, size: int) -> Model:
    """The model of counts in ``UNIT`` parts.

    Every word has ``PSEUDO`` more observations, shared out as all words are, so an unknown word says nothing and a rare one little;
    seeds have ``SEED_WEIGHT`` more among unwanted ones, which enough wanted company outweighs.  A share ``MIXED`` of either kind's words is drawn from all urls.
    """
    bad, good = bad / UNIT + 1, good / UNIT + 1
    share = bad / (good + bad)

    def ratio(w: str, g: float, b: float) -> float:
        both = MIXED * (b + g + PSEUDO) / (good + bad)
        unwanted = (b + PSEUDO * share + (SEED_WEIGHT if w in SEED_MARKS else 0.0)) / bad
        return math.log(((1 - MIXED) * unwanted + both) / ((1 - MIXED) * (g + PSEUDO * (1 - share)) / good + both))

    odds = {w: ratio(w, 0, 0) for w in SEED_MARKS} | {w: ratio(w, g / UNIT, b / UNIT) for w, g, b in counts}
    return Model(model.segmenter, odds, 0.0, math.log((urls_bad + UNIT) / (urls_good + UNIT)), model.paths)


SCHEMA = "page_id long, host string, path string, rule string, verdict string, score double"


def judge(pages: DataFrame, model: Model, rules: tuple = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the model's log-odds ``score`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, p, verdict = (batch.column(i).to_pylist() for i in (1, 2, 4))
            score = [shared.value.score(a, b) for a, b in zip(h, p, strict=True)]
            final = [v or ("block" if s > 0 else "allow") for v, s in zip(verdict, score, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(final, pa.string()), pa.array(score, pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "score"])

    host, path = host_path(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return parts.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict")).mapInArrow(run, SCHEMA)
