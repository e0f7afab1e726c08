"""Language-model scores: token unigrams, and online logistic mixing of bit predictors.

Base.  Token counts of all training texts give a smoothed unigram score.  A
token's key is its bytes (up to 15) or 120 bits of its digest, so counting needs
no strings.  Frequent tokens (at most ``FREQUENT`` can be so frequent) are
broadcast, the others meet their counts in a shuffle of narrow rows.

Model.  A text is the bytes of its lower-cased form and one end symbol.  Each
symbol is a path of binary decisions in a Huffman tree chosen by the two bytes
before it where they are frequent, else by the last one, so likely symbols take
few bits.  Every bit has five predictors.  Four are tables of counts over all
training texts, addressed by a hash of a context (``CONTEXTS``) and the tree
node.  The fifth belongs to the text: small counters, addressed by the first
context's hash, that move towards every bit as it comes.  The stretched
predictions are summed with weights picked by a gate (how much of the longer
contexts has been seen), the weights take a gradient step after every bit, and
an adaptive map from mixed to observed probability is averaged in and updated
likewise.  Later bits never influence earlier probabilities, so the product is
a probability of the text.  Every ``LANE`` bits a text's own state (weights,
counters, map) starts anew from the shared one: then the pieces of a batch can
step side by side, a bit of all of them at a time, and a long text costs no
more a byte than short ones, in time or in memory: a text of more than
``GROUP`` bytes is read in windows, and what a window needs of the text before it
(16 bytes, and the hash of the word so far) is carried on, so that results are the same.

What the model gathers: the vocabulary grows with the corpus, and every count
is exact.  The four tables have 2**SLOT_BITS slots whatever the corpus, because
each worker holds them; contexts beyond that share slots, so longer contexts
tell less apart as the corpus grows, and the weights of their gate fall.  The
trees likewise: at most ``TREE_SHARE`` contexts have one of their own.

Null texts count as empty (one end symbol).  Rows with a null id are training
rows.  Repeated rows count and are scored each.  Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import written

FOLDS, HELD = 7, 2
#: Tokens with at least this share of all tokens are broadcast: at most its inverse many, 24 bytes each.
FREQUENT = 1 << 20
#: log2 of a table's slots and of a slice's.
SLOT_BITS, SLICE_BITS = 22, 18
#: Contexts: so many bytes before the symbol, or the word so far.
CONTEXTS = ("bytes4", "bytes6", "bytes12", "word")
PAD = b"\n" * 16
GAP = re.compile(rb"[\x09-\x0d\x20]")
#: Bits between fresh starts, gates, log2 of a piece's own counters, steps of its map, and bits handled between reorderings.
LANE, GATES, LOCAL_BITS, STEPS, WINDOW = 4096, 6, 8, 33, 32
#: First weights of the shared and the own predictor; rates of weights, own counters and map.
WEIGHT, OWN_WEIGHT, RATE, OWN_RATE, MAP_RATE = np.float32(0.38), np.float32(0.25), np.float32(0.03), np.float32(0.32), np.float32(0.012)
#: Bytes of text that step side by side (calls cost less a bit the more do); symbols whose bits are unfolded at once (one table
#: after another, so that the slots in use stay in the cache).
GROUP, PIECE = 3_000_000, 131_072
END = 256
#: log2 of the tree contexts, the share of all symbols a context needs for a tree of its own, and the least count.
TREE_BITS, TREE_SHARE, TREE_LEAST = 16, 1 << 13, 64

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
ODD32 = np.uint32(0x9E3779B1)
ODD64 = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
#: Highest byte of a token key's second half: the length, or one of these.
LONG, LAST, PAIR = 0xFF, 0xFE, 0xFD


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def lowered(text: bytes | None) -> bytes:
    """``text`` with A-Z as a-z and all else as it is."""
    return (text or b"").translate(LOWER)


# --- tokens --------------------------------------------------------------------


def token_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both halves of the key of every token, text after text, and how many tokens each text has (the end apart)."""
    data = np.frombuffer(b"\n".join([*texts, PAD]), np.uint8)
    edge = np.diff(BLANK[data].view(np.int8), prepend=np.int8(1))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    size = ends - starts
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    keep = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    first = eight.take(starts) & keep[np.minimum(size, 8)]
    second = eight.take(np.minimum(starts + 8, len(eight) - 1)) & keep[np.clip(size - 8, 0, 7)] | size.astype(np.uint64) << np.uint64(56)
    for i in np.flatnonzero(size > 15):
        digest = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=15).digest()
        first[i] = int.from_bytes(digest[:8], "little")
        second[i] = int.from_bytes(digest[8:], "little") | LONG << 56
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return first, second, np.diff(np.searchsorted(starts, bounds), prepend=0)


def spread(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of keys."""
    x = (first ^ (first >> np.uint64(29))) * ODD64[0] + second * ODD64[1]
    return (x ^ (x >> np.uint64(32))) * ODD64[2]


def tallied(first: np.ndarray, second: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys with their counts added up; a key may remain more than once, should hashes collide."""
    order = np.argsort(spread(first, second))
    first, second = first[order], second[order]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(first)), bool), (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
    return first[new], second[new], np.add.reduceat(count[order], new) if len(new) else count


class Frequent:
    """Logarithms of the counts of frequent tokens, found by key."""

    def __init__(self, first: np.ndarray, second: np.ndarray, logs: np.ndarray):
        self.bits = max(1, len(first)).bit_length()
        order = np.argsort(spread(first, second))
        self.first, self.second, self.logs = first[order], second[order], logs[order]
        bucket = (spread(self.first, self.second) >> np.uint64(64 - self.bits)).astype(np.int64)
        self.begin = np.searchsorted(bucket, np.arange((1 << self.bits) + 1))
        self.most = int(np.diff(self.begin).max(initial=0))

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The logarithm for each key, NaN where it isn't frequent."""
        out = np.full(len(first), np.nan)
        bucket = (spread(first, second) >> np.uint64(64 - self.bits)).astype(np.int64)
        at, stop = self.begin.take(bucket), self.begin.take(bucket + 1)
        left = np.flatnonzero(at < stop)
        for _ in range(self.most):
            here = at[left]
            hit = (self.first.take(here) == first[left]) & (self.second.take(here) == second[left])
            out[left[hit]] = self.logs[here[hit]]
            at[left] += 1
            left = left[~hit & (here + 1 < stop[left])]
            if not len(left):
                break
        return out


# --- trees -------------------------------------------------------------------


def huffman(weights: list[int]) -> list[tuple[int, int]]:
    """(code, length) of each weight; those under 2**-16 of the sum count as that, which keeps lengths under 31."""
    least = max(1, sum(weights) >> 16)
    heap = [(max(w, least), i, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    up: dict[int, tuple[int, int]] = {}
    node = len(weights)
    while len(heap) > 1:
        (w0, _, a), (w1, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        up[a], up[b] = (node, 0), (node, 1)
        heapq.heappush(heap, (w0 + w1, node, node))
        node += 1
    seen = {node - 1: (0, 0)}
    for n in range(node - 2, -1, -1):
        above, side = up[n]
        code, length = seen[above]
        seen[n] = code << 1 | side, length + 1
    return [seen[i] for i in range(len(weights))]


class Trees:
    """A Huffman tree of all symbols for each frequent context; row 0 is for all others."""

    def __init__(self, pairs: list[tuple[int, int, int]]):
        """``pairs``: (context, symbol, count); contexts from 2**TREE_BITS on are the last byte alone."""
        table: dict[int, np.ndarray] = {}
        every = np.ones(257, np.int64)
        for context, symbol, n in pairs:
            table.setdefault(context, np.zeros(257, np.int64))[symbol] += n
            if context >> TREE_BITS:
                every[symbol] += n
        self.row = np.zeros((1 << TREE_BITS) + 256, np.int32)
        made = [huffman(every.tolist())]
        share = every / every.sum() * 4096
        for i, c in enumerate(sorted(table), 1):
            self.row[c] = i
            # what wasn't seen here is ordered by its count elsewhere
            made.append(huffman((table[c] * 4096 + share.astype(np.int64)).tolist()))
        # where each pair of bytes finds its tree, of which a row has 257 numbers
        pairs_ = np.arange(1 << TREE_BITS)
        self.start = self.rows(pairs_, pairs_ & 255).astype(np.int64) * 257
        self.code = np.array([[c for c, _ in m] for m in made], np.uint32)
        self.length = np.array([[n for _, n in m] for m in made], np.uint8)

    def rows(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The tree of each context, else that of its last byte, else the first."""
        row = self.row[context]
        return np.where(row > 0, row, self.row[last + np.int64(1 << TREE_BITS)])


# --- symbols and bits ----------------------------------------------------------

_power = np.ones(1, np.uint32), np.ones(1, np.uint32)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd number and of its inverse, kept for the next call."""
    global _power
    if len(_power[0]) < n:
        size = n + n // 4
        _power = tuple(np.multiply.accumulate(np.full(size, x, np.uint32), dtype=np.uint32) for x in (ODD32, pow(int(ODD32), -1, 1 << 32)))
    return _power[0][:n], _power[1][:n]


class Symbols:
    """The symbols of several texts, the context that picks each one's tree, and the hash of every context.

    Texts are parted by blanks that are no symbols (``real`` is false), so that all arrays are slices of one.
    """

    def __init__(self, texts: list[bytes], hashes: bool = True, before: list[tuple[bytes, int, int]] | None = None, final: list[bool] | None = None):
        """``before``: for each text the 16 bytes before it, and hash and length of the word they go on with; ``final``: whether an end follows."""
        before = before or [(PAD, 0, 0)] * len(texts)
        data = np.frombuffer(b"".join(x for (head, _, _), t in zip(before, texts, strict=True) for x in (b"\n", head, t)) + b"\n" + PAD, np.uint8)
        pad, n = len(PAD) + 1, len(data) - len(PAD) - 1
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes + pad) - pad
        self.first = ends - sizes
        closed = np.array(final, bool) if final else np.ones(len(texts), bool)
        edge = np.zeros(n + 1, np.int8)
        edge[self.first] += 1
        edge[ends + closed] -= 1
        self.real = np.cumsum(edge[:n], dtype=np.int8).view(bool)
        self.symbol = data[pad:].astype(np.int32)
        self.symbol[ends[closed]] = END
        self.last = data[pad - 1 : -1]
        self.context = data[pad - 2 : -2].astype(np.int32) << 8 | self.last
        if hashes:
            # the eight bytes before each symbol, the last one in the highest place, and the four before those
            w = np.ndarray(n, "<u8", data, pad - 8, (1,)).copy()
            v = np.ndarray(n, "<u4", data, pad - 12, (1,)).copy()
            high = np.uint64(32)
            self.hashes = [
                ((w >> high) * ODD64[0] >> high).astype(np.uint32),
                ((w >> np.uint64(16)) * ODD64[1] >> high).astype(np.uint32),
                (w * ODD64[2] + v * ODD64[0] >> high).astype(np.uint32),
                (self._carried(data, before)[pad - 1 : -1] + self.last * np.uint32(0x85EBCA6B)) * np.uint32(0x27D4EB2F),
            ]

    @staticmethod
    def _words(data: np.ndarray) -> np.ndarray:
        """For each place a hash of the word up to and with it, 0 for a blank."""
        power, inverse = powers(len(data))
        sums = np.cumsum((data + np.uint32(7)) * power, dtype=np.uint32)
        start = np.maximum.accumulate(np.where(data <= 32, np.arange(len(data), dtype=np.int32), np.int32(0)))
        return (sums - sums[start]) * inverse[start]

    def _carried(self, data: np.ndarray, before: list[tuple[bytes, int, int]]) -> np.ndarray:
        """The same where the first word of a text goes on with one that began before its 16 bytes."""
        words = self._words(data)
        for first, (_, h, size) in zip(self.first.tolist(), before, strict=True):
            if size:
                at = first + 1  # of the 16 bytes
                stop = at
                while not (blank := data[stop : stop + 4096] <= 32).any():
                    stop += 4096
                stop += int(blank.argmax())
                words[at:stop] = words[at:stop] * np.uint32(pow(int(ODD32), size, 1 << 32)) + np.uint32(h)
        return words


def windows(text: bytes, limit: int) -> Iterator[tuple[bytes, tuple[bytes, int, int], bool]]:
    """(part, what comes before it, whether it is the last) of a text, in parts of so many bytes (at least 16)."""
    told, h, size = 0, 0, 0  # the word that text[:told] ends with
    for a in range(0, max(1, len(text)), limit):
        if a:
            part = text[told : a - 16]
            blanks = np.flatnonzero(np.frombuffer(part, np.uint8) <= 32)
            if len(blanks):
                part, h, size = part[blanks[-1] + 1 :], 0, 0
            h = (h + pow(int(ODD32), size, 1 << 32) * int(Symbols._words(np.frombuffer(b"\n" + part, np.uint8))[-1])) & 0xFFFFFFFF
            size += len(part)
            told = a - 16
        yield text[a : a + limit], (text[a - 16 : a] if a else PAD, h, size), a + limit >= len(text)


def symbols(texts: list[bytes], limit: int, hashes: bool = True) -> Iterator[tuple[Symbols, np.ndarray]]:
    """The symbols of all texts, about so many bytes at a time, and which text each slice belongs to."""
    parts, size = [], 0
    for i, text in enumerate(texts):
        for part, before, final in windows(text, limit):
            parts.append((i, part, before, final))
            size += len(part)
            if size >= limit:
                yield _together(parts, hashes)
                parts, size = [], 0
    if parts:
        yield _together(parts, hashes)


def _together(parts: list[tuple], hashes: bool) -> tuple[Symbols, np.ndarray]:
    owner, texts, before, final = zip(*parts, strict=True)
    return Symbols(texts, hashes, before, final), np.array(owner)


def token_parts(texts: list[bytes], limit: int) -> Iterator[tuple[list[int], list[bytes], list[bool]]]:
    """(which text, part of it, whether it is the last) of all texts, about so many bytes at a time, cut at blanks only."""
    owner, parts, final, size = [], [], [], 0
    for i, text in enumerate(texts):
        a = 0
        while True:
            gap = GAP.search(text, a + limit) if a + limit < len(text) else None
            b = gap.end() if gap else len(text)
            owner.append(i)
            parts.append(text[a:b])
            final.append(b == len(text))
            size += b - a
            if size >= limit:
                yield owner, parts, final
                owner, parts, final, size = [], [], [], 0
            if b == len(text):
                break
            a = b
    if owner:
        yield owner, parts, final


def bits(s: Symbols, trees: Trees, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, Iterator[np.ndarray]]:
    """Decisions of the symbols from ``begin`` to ``end``: how many each has, then for every decision its bit, and one array of slots a table."""
    at = trees.start.take(s.context[begin:end])
    at += s.symbol[begin:end]
    code, length = trees.code.ravel().take(at), trees.length.ravel().take(at) * s.real[begin:end].astype(np.int64)
    ends = np.cumsum(length)
    owner = np.repeat(np.arange(end - begin), length)
    left = ends.astype(np.uint32).take(owner)
    left -= np.arange(1, len(owner) + 1, dtype=np.uint32)
    # a leading one, then the code: cut off after the bit, it names the node below
    node = (code | np.uint32(1) << length.astype(np.uint32)).take(owner) >> left
    bit = node & np.uint32(1)
    node >>= np.uint32(1)
    node *= ODD32

    def slots() -> Iterator[np.ndarray]:
        both = node.astype(np.uint64)
        both |= both << np.uint64(32)
        # two contexts at a time
        for low, high in zip(s.hashes[::2], s.hashes[1::2], strict=True):
            wide = high[begin:end].astype(np.uint64) << np.uint64(32)
            wide |= low[begin:end]
            slot = wide.take(owner)
            slot ^= both
            slot = slot.view(np.uint32)
            slot *= np.uint32(0x85EBCA6B)
            slot >>= np.uint32(32 - SLOT_BITS)
            yield from (slot[0::2], slot[1::2])

    return length, bit, slots()


def in_groups(batches: Iterator[pa.RecordBatch], limit: int = GROUP) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, lower-cased texts as bytes) of about so many bytes each, whatever the batches."""
    ids, out, size = [], [], 0
    for batch in batches:
        for d, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            b = lowered(t.as_py())
            ids.append(d)
            out.append(b)
            size += len(b) + 64
            if size >= limit:
                yield ids, out
                ids, out, size = [], [], 0
    if ids:
        yield ids, out


# --- training ------------------------------------------------------------------


def count_all(train: DataFrame, most: int = 1 << 31) -> DataFrame:
    """``k1, k2, c``: the counts of all tokens and of all pairs (tree context, symbol), in one pass over the texts.

    A task hands its pairs on after ``most`` symbols, before a counter of four bytes can overflow.
    """

    def rows(first: np.ndarray, second: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(first), 200_000):
            part = slice(lo, lo + 200_000)
            yield pa.RecordBatch.from_arrays([pa.array(first[part].view(np.int64)), pa.array(second[part].view(np.int64)), pa.array(count[part])], names=["k1", "k2", "c"])

    def pair_rows(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        k = np.flatnonzero(pairs)
        n = pairs[k].astype(np.int64)
        lasts = np.zeros(256 << 9, np.int64)
        np.add.at(lasts, k & (256 << 9) - 1, n)
        last = np.flatnonzero(lasts)
        numbers = np.concatenate([k, last + (1 << TREE_BITS + 9)]).astype(np.uint64)
        return numbers, np.full(len(numbers), PAIR << 56, np.uint64), np.concatenate([n, lasts[last]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: np.ndarray | None = None
        held: list[tuple] = []
        texts_seen = seen = 0
        for _, texts in in_groups(batches):
            for s, _ in symbols(texts, GROUP, hashes=False):
                pairs = np.zeros(1 << TREE_BITS + 9, np.uint32) if pairs is None else pairs
                at = s.context[s.real].astype(np.int64)
                at <<= 9
                at |= s.symbol[s.real]
                np.add.at(pairs, at, np.uint32(1))
                seen += len(at)
                if seen >= most:
                    held.append(pair_rows(pairs))
                    pairs[:] = seen = 0
            for _, parts, _ in token_parts(texts, GROUP):
                first, second, _ = token_keys(parts)
                held.append(tallied(first, second, np.ones(len(first), np.int64)))
                if sum(len(h[0]) for h in held) > 1_500_000:
                    yield from rows(*tallied(*(np.concatenate(c) for c in zip(*held, strict=True))))
                    held = []
            texts_seen += len(texts)
        if texts_seen:
            held.append(pair_rows(pairs))
            held.append((np.zeros(1, np.uint64), np.full(1, LAST << 56, np.uint64), np.array([texts_seen])))
            yield from rows(*tallied(*(np.concatenate(c) for c in zip(*held, strict=True))))

    return written(train.mapInArrow(run, "k1 long, k2 long, c long").groupBy("k1", "k2").agg(F.sum("c").alias("c")), "counts")


def is_pair() -> F.Column:
    return F.shiftrightunsigned("k2", 56) == PAIR


def tree_counts(counts: DataFrame) -> list[tuple[int, int, int]]:
    """(context, symbol, count) of the contexts frequent enough for a tree, and of every last byte.

    At most ``TREE_SHARE + 256`` contexts can be, so the rows collected are bounded whatever the corpus.
    """
    pairs = counts.filter(is_pair()).select(F.shiftright("k1", 9).alias("context"), "k1", "c")
    last_byte = F.col("context") >= 1 << TREE_BITS
    sums = pairs.groupBy("context").agg(F.sum("c").alias("total"))
    every = sums.filter(last_byte).agg(F.sum("total")).first()[0] or 0
    least = max(TREE_LEAST, -(-every // TREE_SHARE))
    wanted = sums.filter(last_byte | (F.col("total") >= least)).select("context")
    rows = pairs.join(wanted, "context", "left_semi").select("context", "k1", "c").collect()
    return [(c, k & 511, n) for c, k, n in rows]


def packed(counts: np.ndarray) -> bytes:
    """A slice's counts, in two bytes each where they fit."""
    return zstandard.ZstdCompressor(level=1).compress(counts.astype(np.uint16 if counts.max(initial=0) < 1 << 16 else np.uint32).tobytes())


def unpacked(raw: bytes) -> np.ndarray:
    data = zstandard.ZstdDecompressor().decompress(raw)
    return np.frombuffer(data, np.uint16 if len(data) == 4 << SLICE_BITS else np.uint32)


def count_tables(train: DataFrame, trees: Trees, most: int = 1 << 31) -> list[np.ndarray]:
    """For each context the counts of zeros and ones, as one state (see :func:`states`) a slot.

    A task hands its counters on after ``most`` bits, before one of four bytes can overflow; they are added up exactly.
    """
    shared = train.sparkSession.sparkContext.broadcast(trees)
    slices = 1 << (SLOT_BITS - SLICE_BITS)

    def parts(counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, c in enumerate(counts):
            for k in range(slices):
                raw = packed(c[k << SLICE_BITS + 1 : k + 1 << SLICE_BITS + 1])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([k], pa.int32()), pa.array([raw], pa.binary())], names=["context", "slice", "counts"])
            c[:] = 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: list[np.ndarray] = []
        seen = 0
        for _, texts in in_groups(batches, 4 * PIECE):
            counts = counts or [np.zeros(2 << SLOT_BITS, np.uint32) for _ in CONTEXTS]
            for s, _ in symbols(texts, 4 * PIECE):
                for lo in range(0, len(s.symbol), PIECE):
                    _, bit, slots = bits(s, shared.value, lo, min(lo + PIECE, len(s.symbol)))
                    seen += len(bit)
                    for c, slot in zip(counts, slots, strict=True):
                        at = slot.astype(np.int64)
                        at <<= 1
                        at |= bit
                        np.add.at(c, at, np.uint32(1))
                    if seen >= most:
                        yield from parts(counts)
                        seen = 0
        if seen:
            yield from parts(counts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums the parts of a slice that lie in this partition, one after another."""
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for i, k, raw in zip(*(batch.column(n) for n in range(3)), strict=True):
                key = i.as_py(), k.as_py()
                if key not in sums:
                    sums[key] = np.zeros(2 << SLICE_BITS, np.int64)
                sums[key] += unpacked(raw.as_py())
        for (i, k), c in sums.items():
            raw = zstandard.ZstdCompressor(level=1).compress(states(c).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([k], pa.int32()), pa.array([raw], pa.binary())], names=["context", "slice", "state"])

    dealt = train.mapInArrow(run, "context int, slice int, counts binary").repartition(len(CONTEXTS) * slices, "context", "slice")
    tables = [np.full(1 << SLOT_BITS, UNSEEN, np.uint16) for _ in CONTEXTS]
    size = 1 << SLICE_BITS
    # the tables' size is fixed by the parameters, whatever the corpus
    for i, k, raw in dealt.mapInArrow(add, "context int, slice int, state binary").collect():
        tables[i][k * size : (k + 1) * size] = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint16)
    return tables


#: How far a stretched probability counts after 0, 1, 3, 7, ... observations, and the scale of states.
TRUST = np.array([0.0, 0.6, 0.75, 0.85, 0.92, 0.96, 0.98, 1.0])
SCALE = np.float32(16 / 65536)
UNSEEN = 1 << 15
#: Of four states in one number: the sureness of all but the first, what adds those up, and the gate of each sum.
SURE, ADDED = np.uint64(0x0007_0007_0007_0000), np.uint64(0x0001_0001_0001)
#: Makes signed numbers around zero of four states.
MIDDLE = np.uint64(0x8000_8000_8000_8000)
GATE = np.minimum(np.arange(22) // 3, GATES - 1).astype(np.uint16)


def states(counts: np.ndarray) -> np.ndarray:
    """(zeros, ones) pairs -> one number: a mixer input of -8 to 8 in its twelve high bits, sureness in its three low ones."""
    n0, n1 = counts[0::2].astype(np.float64), counts[1::2].astype(np.float64)
    sure = np.minimum(np.log2(n0 + n1 + 1), len(TRUST) - 1).astype(np.int64)
    stretch = np.clip(np.log((n1 + 0.4) / (n0 + 0.4)), -8, 7.99) * TRUST[sure]
    return ((np.round((stretch + 8) * 256).astype(np.int64) << 4) | sure).astype(np.uint16)


def squash(z: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """1 / (1 + exp(-z))."""
    p = np.negative(z, out=out)
    np.exp(p, out=p)
    p += np.float32(1)
    return np.reciprocal(p, out=p)


class Model:
    def __init__(self, trees: Trees, tables: list[np.ndarray]):
        self.trees, self.tables = trees, tables
        self.room = np.empty(0, np.uint64), np.empty(0, np.uint16)

    def __reduce__(self) -> tuple:
        return Model, (self.trees, self.tables)  # without the room

    def _inputs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every bit of all texts the states of its four shared inputs (one 8-byte number), and gate, bit and own counter; how many bits each text has."""
        size = 8 * sum(len(t) + 1 for t in texts) + 64
        per_text = np.zeros(len(texts), np.int64)
        # the room stays for the next texts: new memory costs about as much as what is written there
        if len(self.room[0]) < size:
            self.room = tuple(np.empty(size + size // 4, x.dtype) for x in self.room)
        (inputs, notes), used = self.room, 0
        for s, owner in symbols(texts, 2 * PIECE):
            inputs, notes, used, lengths = self._unfolded(s, inputs, notes, used)
            np.add.at(per_text, owner, lengths)
        self.room = inputs, notes
        return inputs[:used], notes[:used], per_text

    def _unfolded(self, s: Symbols, inputs: np.ndarray, notes: np.ndarray, used: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
        """Writes the bits of some symbols behind the first ``used`` ones; the arrays (larger ones, if need be), the bits now in use, and those of each slice."""
        inputs = inputs.view(np.uint64)
        lengths = np.empty(len(s.symbol), np.int64)
        for lo in range(0, len(s.symbol), PIECE):
            hi = min(lo + PIECE, len(s.symbol))
            lengths[lo:hi], bit, slots = bits(s, self.trees, lo, hi)
            end = used + len(bit)
            if end > len(notes):
                inputs, notes = (np.concatenate([x[:used], np.empty(used + len(bit), x.dtype)]) for x in (inputs, notes))
            packed_ = inputs[used:end]
            rows = packed_.view(np.uint16).reshape(-1, len(CONTEXTS))
            for i, (slot, table) in enumerate(zip(slots, self.tables, strict=True)):
                if not i:
                    note = slot.astype(np.uint16)
                    note <<= np.uint16(8)  # the own counter's place is all that is left of the slot
                rows[:, i] = table.take(slot)
            # the sureness of all contexts but the first, added up in the highest sixteen bits
            sure = packed_ & SURE
            sure *= ADDED
            sure >>= np.uint64(48)
            note |= GATE.take(sure.view(np.int64))
            packed_ ^= MIDDLE
            note |= bit.astype(np.uint16) << np.uint16(7)
            notes[used:end] = note
            used = end
        return inputs, notes, used, np.add.reduceat(lengths, s.first)

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each text, and the bits it takes; texts of more than ``GROUP`` bytes by themselves, in windows."""
        logs = np.zeros(len(texts))
        short = [i for i, t in enumerate(texts) if len(t) <= GROUP]
        if short:
            logs[short] = self._mixed(*self._inputs([texts[i] for i in short]))
        for i in set(range(len(texts))).difference(short):
            logs[i] = self._long(texts[i], GROUP)
        return logs / math.log(10), -logs / math.log(2)

    def _long(self, text: bytes, limit: int) -> float:
        """The logarithm of the probability of a text, in windows; the last bits of one that make no whole piece go to the next."""
        total = 0.0
        kept = np.empty(0, np.uint64), np.empty(0, np.uint16)
        seen = 0
        for s, _ in symbols([text], limit):
            room = len(kept[0]) + 8 * len(s.symbol)
            inputs, notes = np.empty(room, np.uint64), np.empty(room, np.uint16)
            inputs[: len(kept[0])], notes[: len(kept[1])] = kept
            inputs, notes, used, _ = self._unfolded(s, inputs, notes, len(kept[0]))
            seen += limit
            whole = used if seen >= len(text) else used - used % LANE
            if whole:
                total += float(self._mixed(inputs[:whole], notes[:whole], np.array([whole]))[0])
            kept = inputs[whole:used].copy(), notes[whole:used].copy()
            del inputs, notes
        return total

    @staticmethod
    def _mixed(inputs: np.ndarray, notes: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """The logarithm of the probability of each text's bits.

        Pieces of ``LANE`` bits step side by side, longest first, so that those still going on are the first ones.
        """
        lanes = -(-per_text // LANE)
        owner = np.repeat(np.arange(len(per_text)), lanes)
        begin = np.repeat(np.cumsum(per_text) - per_text, lanes) + LANE * (np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        size = np.diff(np.concatenate([begin, [len(notes)]]))
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        going = (len(size) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")).tolist()
        mixer = Lanes(len(size))
        logs = np.zeros(len(size))
        # runs of WINDOW bits from every place on; those of the last places go beyond the end
        edge = max(0, len(notes) - WINDOW)
        tails = [np.concatenate([x[edge:], np.zeros(WINDOW, x.dtype)]) for x in (inputs, notes)]
        runs, ends = [[np.ndarray((max(0, len(x) - WINDOW + 1), WINDOW), x.dtype, x, strides=x.strides * 2) for x in xs] for xs in ((inputs, notes), tails)]
        for at in range(0, len(going), WINDOW):
            n, steps = going[at], min(WINDOW, len(going) - at)
            place = begin[:n] + at
            late = np.flatnonzero(place > edge)
            x, note = (run[np.minimum(place, edge)] if edge else tail[place] for run, tail in zip(runs, ends, strict=True))
            if edge and len(late):
                for out, tail in zip((x, note), ends, strict=True):
                    out[late] = tail[place[late] - edge]
            right = mixer.steps(x[:, :steps].T, note[:, :steps].T)
            if going[at + steps - 1] < n:
                for t, m in enumerate(going[at : at + steps]):
                    right[t, m:] = 1
            # a bit has a probability of 1.6e-4 or more, so that of eight is no too small number
            for t in range(0, steps, 8):
                logs[:n] += np.log(np.multiply.reduce(right[t : t + 8], axis=0))
        return np.bincount(owner, weights=logs, minlength=len(per_text))


class Lanes:
    """The state of pieces of text that step side by side.

    A step is many small operations, so those of the own counter and of the map go together: their
    numbers lie side by side.  Mix and own counters are kept negated, which is what ``exp`` needs.
    """

    def __init__(self, n: int):
        self.n = n
        self.weights = np.full((n * GATES, 4), WEIGHT, np.float32)
        self.own_weights = np.full(n, OWN_WEIGHT, np.float32)
        self.cells = np.zeros((n << LOCAL_BITS) + n * STEPS, np.float32)  # own counters, then maps
        self.cells[n << LOCAL_BITS :] = np.tile(squash(((np.arange(STEPS) - STEPS // 2) / 2).astype(np.float32)), n)
        self.number = np.arange(n)
        self.map_at = self.number * STEPS + (n << LOCAL_BITS)

    def steps(self, states_: np.ndarray, notes: np.ndarray) -> np.ndarray:
        """The probability given to each bit before it was learnt from; a row a step, for the first pieces. Those that have ended go on without sense."""
        f = np.float32
        n = states_.shape[1]
        x = np.empty((*states_.shape, 4), f)
        x[:] = np.ascontiguousarray(states_).view(np.int16).reshape(x.shape)
        x *= SCALE
        notes = np.ascontiguousarray(notes)
        bit = (notes >> np.uint16(7) & np.uint16(1)).astype(f)
        gates = (notes & np.uint16(127)) + self.number[:n] * GATES
        cells_at = np.empty((len(notes), 2 * n), np.int64)
        np.add(notes >> np.uint16(8), self.number[:n] << LOCAL_BITS, out=cells_at[:, :n])
        # what comes of probability (mix, own counter, map) and bit: steps of weights and own counter, the map's new number
        rates = np.repeat(np.array([-RATE, OWN_RATE, f(1) - MAP_RATE], f), n)
        moves = np.empty((len(notes), 3 * n), f)
        for k, rate in enumerate((RATE, -OWN_RATE, MAP_RATE)):
            np.multiply(bit, rate, out=moves[:, k * n : k * n + n])
        found = np.empty_like(bit)
        whole, own_weights, map_at = self.weights.view(np.complex128).ravel(), self.own_weights[:n], self.map_at[:n]
        minus, ones = np.full(4, -1, f), np.ones((1, 4), f)
        one, minus_two, half, low, high = (np.full(m, v, f) for m, v in ((2 * n, 1), (n, -2), (n, STEPS // 2 + 0.5), (n, -8), (n, 8)))
        both, p, product, picked, part = np.empty(2 * n, f), np.empty(3 * n, f), np.empty((n, 4), f), np.empty(n, np.complex128), np.empty(n, f)
        z, own = both[:n], both[n:]  # negated
        mix, two, seen = p[:n], p[: 2 * n], p[2 * n :]
        w = picked.view(f).reshape(n, 4)
        move = np.empty(3 * n, f)
        error, own_move, new = move[:n], move[n : 2 * n], move[n:]
        for x_, gate, cell, bit_move, out in zip(x, gates, cells_at, moves, found, strict=True):
            place = cell[n:]
            # all places are in range: clipping only spares a copy
            self.cells.take(cell[:n], out=own, mode="clip")
            whole.take(gate, out=picked, mode="clip")
            np.multiply(w, x_, out=product)
            np.dot(product, minus, out=z)
            np.multiply(own_weights, own, out=part)
            np.add(z, part, out=z)
            np.minimum(z, high, out=z)
            np.maximum(z, low, out=z)
            np.exp(both, out=two)
            np.add(two, one, out=two)
            np.reciprocal(two, out=two)
            # the map: what came where the mix said this
            np.multiply(z, minus_two, out=part)
            np.add(part, half, out=part)
            place[:] = part
            np.add(place, map_at, out=place)
            self.cells.take(place, out=seen, mode="clip")
            np.add(mix, seen, out=out)
            np.multiply(p, rates, out=move)
            np.add(move, bit_move, out=move)
            # the own counter moves, in the stretched domain
            np.add(own_move, own, out=own_move)
            self.cells[cell] = new
            np.multiply(error, own, out=part)
            np.subtract(own_weights, part, out=own_weights)
            np.dot(error.reshape(n, 1), ones, out=product)
            np.multiply(x_, product, out=product)
            np.add(w, product, out=w)
            whole[gate] = picked
        # from twice the probability of a one to that of the bit
        found *= f(0.5)
        found += bit
        found -= f(1)
        return np.abs(found, out=found)


# --- whole tables --------------------------------------------------------------


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))


def fold() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the table ``k1, k2, c`` of training tokens (the end is one of them)."""
    train = narrow(docs).filter(F.col("doc_id").isNull() | (fold() != HELD))
    counts = count_all(train)
    trees = Trees(tree_counts(counts))
    return Model(trees, count_tables(train, trees)), counts.filter(~is_pair())


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def score(docs: DataFrame, model: Model, vocabulary: DataFrame) -> DataFrame:
    """One row per document (``SCHEMA``)."""
    sc = docs.sparkSession.sparkContext
    n, v, ends = vocabulary.agg(F.sum("c"), F.count("*"), F.sum(F.when(F.shiftrightunsigned("k2", 56) == LAST, F.col("c")))).first()
    n, v, ends = int(n or 0), int(v), int(ends or 0)
    least = max(2, -(-n // FREQUENT))
    common = vocabulary.filter(F.col("c") >= least).toArrow()  # at most FREQUENT rows
    keys = [np.asarray(common.column(i).combine_chunks(), np.int64).view(np.uint64) for i in (0, 1)] if common.num_rows else [np.zeros(0, np.uint64)] * 2
    logs = np.log10(np.asarray(common.column(2).combine_chunks(), np.float64) + 1) if common.num_rows else np.zeros(0)
    shared = sc.broadcast((model, Frequent(*keys, logs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_, frequent = shared.value
        uid = TaskContext.get().partitionId() << 36
        for ids, texts in in_groups(batches):
            scores, used = model_.scores(texts)
            per_byte = used / np.maximum(1, [len(t) for t in texts])
            m = len(texts)
            for which, parts, final in token_parts(texts, GROUP):
                which, last = np.array(which), np.array(final)
                first, second, words = token_keys(parts)
                found = frequent.find(first, second)
                owner = np.repeat(np.arange(len(parts)), words)
                rare = np.isnan(found)
                known = np.bincount(owner, weights=~rare, minlength=len(parts)).astype(np.int64) + (last & (ends > 0))
                total = np.bincount(owner[~rare], weights=found[~rare], minlength=len(parts)) + last * math.log10(ends + 1)
                r = int(rare.sum())
                numbers = uid + which
                columns = [
                    np.concatenate([numbers, numbers[owner[rare]]]),
                    # a document's own row: its key is no token's, and spreads
                    np.concatenate([numbers, first[rare].view(np.int64)]),
                    np.concatenate([np.full(len(parts), -1), second[rare].view(np.int64)]),
                ]
                own = [pa.array([ids[i] for i in which], pa.int64()), pa.array(words + last), pa.array(known), pa.array(total), pa.array(scores[which]), pa.array(per_byte[which])]
                names = ["uid", "k1", "k2", "doc_id", "n_tokens", "known", "logs", "score", "bpb"]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *(pa.concat_arrays([c, pa.nulls(r, c.type)]) for c in own)], names=names)
            uid += m

    rows = narrow(docs).mapInArrow(run, "uid long, k1 long, k2 long, doc_id long, n_tokens long, known long, logs double, score double, bpb double")
    rest = vocabulary.filter(F.col("c") < least)
    met = rows.join(rest, ["k1", "k2"], "left")
    c = F.coalesce("c", F.lit(0))
    known = F.coalesce("known", F.when(c > 0, 1), F.lit(0))
    logs_ = F.coalesce("logs", F.log10(c + 1))
    docs_ = met.groupBy("uid").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum(known).alias("n_known"), F.sum(logs_).alias("logs"), F.max("score").alias("score"), F.max("bpb").alias("bits_per_byte"))
    held = F.coalesce(fold() == HELD, F.lit(False))
    base = F.col("logs") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))
    return docs_.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score", "bits_per_byte")
