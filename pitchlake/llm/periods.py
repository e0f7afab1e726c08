"""Periodic runs of words: all maximal repetitions of a text, found by matching aligned blocks.

A run is a stretch of consecutive words with smallest period ``q`` that holds it
twice (and at least ``LEAST`` words), and that no neighbouring word extends.
In a run with period ``q`` at least ``max(q, LEAST - q)`` words in a row equal the
word ``q`` further on, so they hold a whole block of the largest power of two
whose aligned blocks can't miss such a stretch.  For every such size the aligned
blocks of a text are the keys (integer sequences: the numbers of their two halves) of
an Aho-Corasick automaton, which is run over the whole text; where a block comes again
at a distance that belongs to its size, the equal stretch around it is extended word by
word in both directions.  What leaves blocks and places out is exact:

* a block is looked for only if both of its halves came again further on;
* a block deep inside a known run with a period of at most its size comes again
  only at multiples of that period, as long as the run goes on;
* a distance that is a multiple of a known run's period, with both places in
  that run, gives that run once more.

Null texts have no words; empty ones, repeated rows, null ids and clashing columns
are taken like any other row; texts are taken whole, each by itself, in time
about linear in its words for every size of block; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

WORD = re.compile(r"[^\x20\x09-\x0d]+")
#: Fewest words of a run.
LEAST = 12


def block_size(q: int, least: int = LEAST) -> int:
    """The largest power of two of which every stretch of a period's equal words holds an aligned block."""
    return 1 << ((max(q, least - q) + 1).bit_length() - 2)


def distances(size: int, least: int = LEAST) -> tuple[list[int], range]:
    """The periods a block size is for: those below ``least``, and the range of the others."""
    return [q for q in range(1, least) if block_size(q, least) == size], range(max(least, 2 * size - 1), 4 * size - 1)


def stretch(w: np.ndarray, p: int, q: int, size: int) -> tuple[int, int]:
    """The longest ``[a, b)`` around ``[p, p + size)`` whose words equal those ``q`` further on."""
    a, step = p, 16
    while a:
        lo = max(0, a - step)
        differ = np.flatnonzero(w[lo:a] != w[lo + q : a + q])
        if len(differ):
            a = lo + int(differ[-1]) + 1
            break
        a, step = lo, step * 4
    b, step, end = p + size, 16, len(w) - q
    while b < end:
        hi = min(end, b + step)
        differ = np.flatnonzero(w[b:hi] != w[b + q : hi + q])
        if len(differ):
            b += int(differ[0])
            break
        b, step = hi, step * 4
    return a, b


def places(ident: np.ndarray, half: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of every block of two halves, over the whole text.

    ``ident`` numbers the half block at each place (0: none that came again);
    ``keys``, pairs of such numbers, are the integer sequences the automaton
    looks for.  It reads places ``half`` apart one after another, so that the halves
    of a block are neighbours; stretches of zeros are left out but for one.
    """
    rows = -(-len(ident) // half) + 1
    letters = np.zeros(rows * half, np.int64)
    letters[: len(ident)] = ident
    letters = letters.reshape(rows, half).T.ravel()
    some = letters != 0
    some[1:] |= some[:-1]
    at = np.flatnonzero(some)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i, key in enumerate(keys.tolist()):
        automaton.add_word(tuple(key), i)
    automaton.make_automaton()
    hits = np.array(list(automaton.iter(tuple(letters[at].tolist()))), np.int64).reshape(-1, 2)
    where = at[hits[:, 0] - 1]
    return where % rows * half + where // rows, hits[:, 1]


def periodic_runs(w: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of the word numbers ``w``, by start, then period."""
    n = len(w)
    if n < max(2, least):
        return []
    w = w.astype(np.int64)
    top = int(w.max()) + 1
    found: dict[tuple[int, int], int] = {}
    size, ident = 1, w + 1
    place, key = np.arange(n), w
    block_key, wanted = w, np.bincount(w)[w] > 1
    while True:
        # blocks in known runs of a small period: the run they lie in, and whether they lie deep in it
        near, far = distances(size, least)
        count = len(wanted)
        home, deep = np.full(count, -1), np.zeros(count, bool)
        known = [(s, e, q) for (s, e), q in found.items() if q <= size and e - s >= 3 * size - 1]
        for r, (s, e, _) in enumerate(known):
            home[-(-s // size) : max(0, (e - 3 * size + 1) // size + 1)] = r
            deep[-(-s // size) : max(0, (e - 5 * size + 2) // size + 1)] = True
        last = np.zeros(int(key.max()) + 1 if len(key) else 1, np.int64)
        np.maximum.at(last, key, place)
        start = np.arange(count) * size
        again = wanted & (last[block_key] > start)
        if not again.any():
            break
        if near or len(far):
            order = np.lexsort((place, key))
            ordered, bounds = place[order], np.searchsorted(key[order], np.arange(len(last) + 1))
            lists: dict[int, list[int]] = {}
            reached: dict[int, int] = {}  # period -> end of its last stretch
            few, most, fits = min([*near, *far[:1]]), max([*near, *far[-1:]]), frozenset(near)
            for i in np.flatnonzero(again & ~deep).tolist():
                p, k = i * size, int(block_key[i])
                if k not in lists:
                    lists[k] = ordered[bounds[k] : bounds[k + 1]].tolist()
                stands = lists[k]
                inside = known[home[i]] if home[i] >= 0 else None
                for j in range(bisect_left(stands, p + few), len(stands)):
                    q = stands[j] - p
                    if q > most:
                        break
                    if q not in fits and q not in far or reached.get(q, -1) > p:
                        continue
                    if inside and q % inside[2] == 0 and p + q + size <= inside[1]:
                        continue
                    a, b = stretch(w, p, q, size)
                    reached[q] = b
                    if b - a + q >= max(least, 2 * q):
                        found[a, b + q] = min(q, found.get((a, b + q), q))
        # blocks of twice the size, if both of their halves come again
        half, size = size, 2 * size
        count = n // size
        if not count:
            break
        wanted = again[0 : 2 * count : 2] & again[1 : 2 * count : 2]
        if half == 1:
            pair, which = np.unique(w[:-1] * top + w[1:], return_inverse=True)
            wanted &= (np.bincount(which) > 1)[which][0 : 2 * count : 2]
        at = np.flatnonzero(wanted) * size
        if not len(at):
            break
        base = int(ident.max()) + 1
        pairs, which = np.unique(ident[at] * base + ident[at + half], return_inverse=True)
        block_key = np.zeros(count, np.int64)
        block_key[at // size] = which
        place, key = places(ident, half, np.column_stack([pairs // base, pairs % base]))
        ident = np.zeros(n, np.int64)
        ident[place] = key + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay where only the first period of each run does."""
    change = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        change[s + q] += 1
        change[s + length] -= 1
    return np.cumsum(change[:-1]) == 0


def words(text: str) -> Iterator[str]:
    """The words of a text, from pieces of it, so that no second copy is made of a long one."""
    at, step = 0, 1 << 20
    while at < len(text):
        end = min(len(text), at + step)
        while end < len(text) and not text[end] in " \t\n\x0b\x0c\r":
            end += 1
        yield from WORD.findall(text, at, end)
        at = end


SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def find(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``SCHEMA`` of every document: its runs by start and period, and its text with one period of each run, words joined by a blank."""

    def one(text: str | None) -> tuple[int, list[dict], str]:
        number: dict[str, int] = {}
        w = np.fromiter((number.setdefault(x, len(number)) for x in words(text or "")), np.int64)
        runs = periodic_runs(w, least)
        names = list(number)
        stay = w[kept_words(len(w), runs)] if runs else w
        return len(w), [{"start": s, "length": m, "period": q} for s, m, q in runs], " ".join(map(names.__getitem__, stay.tolist()))

    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [one(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA)
