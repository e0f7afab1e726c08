"""Packing documents into token sequences with a grouping genetic algorithm.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
Full pieces fill a sequence each.  The others are dealt evenly into shards of
about ``shard_items`` pieces by a hash of a row number, so neither a hot source
nor repeated rows can make a shard large.  Each shard is packed by several
islands: a grouping genetic algorithm whose crossover injects whole bins of one
parent, the fuller the likelier, into another, removes the bins that now hold
duplicates, and puts displaced pieces back: first in exchange for one or two
smaller ones where that makes a bin fuller, then by best fit, largest first.
Mutation dissolves some of the emptiest bins, and some of those with most
pieces, in the same way.  After each epoch the
best packing of every island migrates to the next island of the same shard.
An island stops at once when it reaches the lower bound on bins; search costs
time only where best fit is above it.

Of equally good packings the one of the earlier island wins, and of pieces of equal size the
one with the smaller number is placed first.  Very long texts are cut into pieces, however many.
Null texts count as empty; an empty document is one piece holding the end id;
repeated rows are packed each; other columns of the input are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import json
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitchlake.llm.bpe import byte_symbols
from pitchlake.llm.common import forget, written

CAPACITY = 1024
END_ID = 2
#: Pieces in a shard, islands of a shard, epochs between migrations, generations of an epoch, packings in a population.
SHARD_ITEMS, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 6000, 2, 2, 25, 4
#: Pieces that an epoch's generations go through at least before it ends: large shards, where a bin more or less is little, take fewer generations.
EFFORT = 48_000
#: Bins that a mutation dissolves at most (emptiest ones, ones of most pieces), rounds of exchanges with what is displaced, and pieces of it that exchanges look at.
DISSOLVED, EXCHANGES, LOOSE = (2, 4), 2, 64

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
#: The pattern by which the library's byte-level pre-tokeniser cuts text (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """Ids of a byte-level vocabulary file, by the tokenizers library's rules.

    Ordinary text goes through a faster encoder built from the same file's
    vocabulary and merges, which yields the same ids; texts that hold one of
    the file's added strings go through the tokenizers library itself, and so do all
    where the file asks for anything but byte-level pieces and merges by rank.
    """

    def __init__(self, path: str):
        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special and all(c in byte_of for c in s)}
        self.special = sorted(special)
        before, model = spec["pre_tokenizer"] or {}, spec["model"]
        self.plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec["normalizer"] and not model.get("ignore_merges") and not model.get("dropout") and not model.get("byte_fallback")
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if self.plain else None

    def encode(self, text: str) -> list[int]:
        if self.plain and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def cut(total: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but the first may be shorter."""
    first = total % capacity or capacity
    yield 0, min(first, total)
    for start in range(first, total, capacity):
        yield start, capacity


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document; ``uid`` numbers the pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*bpe.encode(text.as_py() or ""), end_id], dtype="<u4")
                for n, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((uid, doc_id, n, start, length, zlib.crc32(ids[start : start + length].tobytes())))
                    uid += 1
            columns = zip(*rows, strict=True) if rows else [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in PIECES.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, PIECES)


class Bins:
    """Bins under construction; the residual capacities in use are bits of one integer."""

    def __init__(self, capacity: int):
        self.capacity, self.open, self.mask = capacity, [[] for _ in range(capacity + 1)], 0
        self.bins: list[list[int]] = []

    def _note(self, b: int, free: int) -> None:
        if free:
            self.open[free].append(b)
            self.mask |= 1 << free

    def take(self, items: list[int], free: int) -> None:
        """A whole bin as it is."""
        self.bins.append(items)
        self._note(len(self.bins) - 1, free)

    def put(self, item: int, size: int) -> None:
        """Best fit: the fullest bin that still holds the item, else a new one."""
        fits = self.mask >> size
        if not fits:
            self.bins.append([item])
            self._note(len(self.bins) - 1, self.capacity - size)
            return
        free = size + (fits & -fits).bit_length() - 1
        b = self.open[free].pop()
        if not self.open[free]:
            self.mask ^= 1 << free
        self.bins[b].append(item)
        self._note(b, free - size)


def best_fit(order: list[int], size: list[int], capacity: int) -> list[list[int]]:
    out = Bins(capacity)
    for i in order:
        out.put(i, size[i])
    return out.bins


def filling(bins: list[list[int]], size: list[int]) -> list[int]:
    return [sum([size[i] for i in x]) for x in bins]


def exchange(bins: list[list[int]], loose: list[int], size: list[int], capacity: int, rng: random.Random, used: list[int]) -> list[int]:
    """Puts loose pieces into bins in exchange for one or two smaller ones, each time for the best gain of a bin; what is loose then.

    ``used``, the filling of every bin, follows.

    Of very many loose pieces the largest ``LOOSE`` take part; all others wait for best fit.
    """
    loose = sorted(loose, key=lambda i: (size[i], i))
    rest, loose = loose[:-LOOSE], loose[-LOOSE:]
    for _ in range(EXCHANGES):
        order = [k for k, u in enumerate(used) if u < capacity]
        rng.shuffle(order)
        moved = False
        sizes = [size[i] for i in loose]
        twos: dict[int, tuple[int, int]] = {}
        for y in range(len(loose)):
            for x in range(y):
                twos.setdefault(sizes[x] + sizes[y], (x, y))
        pairs = sorted(twos)
        for k in order:
            box = bins[k]
            slack = capacity - used[k]
            if not sizes:
                break
            best, out, into = 0, (), ()
            held = [((i,), size[i]) for i in box] + [((i, j), size[i] + size[j]) for n, i in enumerate(box[:12]) for j in box[:n]]
            held.append(((), 0))
            for gone, total in held:
                limit = total + slack
                at = bisect.bisect_right(sizes, limit) - 1
                if at >= 0 and sizes[at] - total > best:
                    best, out, into = sizes[at] - total, gone, (at,)
                at = bisect.bisect_right(pairs, limit) - 1
                if at >= 0 and pairs[at] - total > best:
                    best, out, into = pairs[at] - total, gone, twos[pairs[at]]
                if best == slack:
                    break
            if best:
                taken = [loose[x] for x in into]
                bins[k] = [i for i in box if i not in out] + taken
                used[k] += best
                loose = sorted([i for i in loose if i not in taken] + list(out), key=lambda i: (size[i], i))
                sizes = [size[i] for i in loose]
                twos = {}
                for y in range(len(loose)):
                    for x in range(y):
                        twos.setdefault(sizes[x] + sizes[y], (x, y))
                pairs = sorted(twos)
                moved = True
        if not moved or not loose:
            break
    return rest + loose


def refilled(bins: list[list[int]], loose: list[int], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """The bins with displaced pieces back in: exchanges, then best fit, largest first."""
    used = filling(bins, size)
    loose = exchange(bins, loose, size, capacity, rng, used) if loose else loose
    out = Bins(capacity)
    for x, u in zip(bins, used, strict=True):
        out.take(x, capacity - u)
    for i in sorted(loose, key=lambda i: (-size[i], i)):
        out.put(i, size[i])
    return out.bins


def mutated(bins: list[list[int]], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Dissolves a few of the emptiest bins and a few of those with most pieces, whose small ones fill gaps."""
    used = filling(bins, size)
    empty = heapq.nsmallest(6 * DISSOLVED[0], range(len(bins)), key=used.__getitem__)
    rich = heapq.nlargest(3 * DISSOLVED[1], range(len(bins)), key=lambda k: len(bins[k]) * rng.uniform(0.5, 1.0))
    gone = {k for some, most in zip((empty, rich), DISSOLVED, strict=True) for k in rng.sample(some, min(len(some), rng.randint(1, most)))}
    return refilled([list(x) for k, x in enumerate(bins) if k not in gone], [i for k in sorted(gone) for i in bins[k]], size, capacity, rng)


def crossover(a: list[list[int]], b: list[list[int]], size: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """Injects bins of ``b``, chosen by rank of filling, into ``a``; bins of ``a`` with a duplicate go, and their other pieces return."""
    mine = set(map(frozenset, a))
    new = sorted((x for x in b if frozenset(x) not in mine), key=lambda x: -sum([size[i] for i in x]))
    well = [x for rank, x in enumerate(new) if rng.random() < 0.5 * (1 - rank / len(new))]
    taken = {i for x in well for i in x}
    kept = [list(x) for x in a if taken.isdisjoint(x)]
    loose = [i for x in a if not taken.isdisjoint(x) for i in x if i not in taken]
    return refilled(kept + [list(x) for x in well], loose, size, capacity, rng)


def fitness(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins, then more uneven filling."""
    return len(bins), -sum([u * u for u in filling(bins, size)]) / capacity**2


def evolve(size: list[int], capacity: int, seed: int, start: list[list[list[int]]], generations: int = GENERATIONS, population: int = POPULATION) -> list[list[int]]:
    """The best packing an island finds, from given packings and best fit over shaken orders."""
    bound = -(-sum(size) // capacity)
    down = sorted(range(len(size)), key=lambda i: (-size[i], i))
    pool = [*start] or [best_fit(down, size, capacity)]
    rng = random.Random(int(seed))
    score = lambda bins: fitness(bins, size, capacity)
    ranked = sorted(((score(x), n, x) for n, x in enumerate(pool)), key=lambda t: t[:2])
    if len(ranked[0][2]) <= bound:
        return ranked[0][2]
    number = len(pool)
    while len(ranked) < population:
        x = best_fit(sorted(down, key=lambda i: -size[i] * rng.uniform(0.9, 1.0)), size, capacity)
        ranked.append((score(x), number, x))
        number += 1
    ranked.sort(key=lambda t: t[:2])
    for _ in range(min(generations, -(-EFFORT // len(size)))):
        one, other = rng.sample(range(len(ranked)), 2)
        mixed = crossover(ranked[min(one, other)][2], ranked[max(one, other)][2], size, capacity, rng)
        for parent in (ranked[0][2], mixed):
            child = mutated(parent, size, capacity, rng)
            ranked.append((score(child), number, child))
            number += 1
            if len(child) <= bound:
                return child
        ranked.sort(key=lambda t: t[:2])
        del ranked[population:]
    return ranked[0][2]


def pack(table: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to the rows of :func:`pieces`, a table on disk."""
    full = table.filter(F.col("length") >= capacity).withColumns({"sequence_id": F.col("uid") * 2 + 1, "offset": F.lit(0).cast("long")})
    rest = table.filter(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // shard_items))
    items = rest.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard"))
    solved = items.select("*", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"))
    solved = solved.withColumn("bins", F.lit(None).cast("array<int>"))

    def island(epoch: int):
        def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
            """Rows of one island; ``bins``: the bin of the piece in each packing that came in."""
            group = group.sort_values("uid", ignore_index=True)
            size = group["length"].tolist()
            start = []
            for told in zip(*(b for b in group["bins"] if b is not None), strict=True) if group["bins"].notna().all() else ():
                packing: dict[int, list[int]] = {}
                for i, b in enumerate(told):
                    packing.setdefault(b, []).append(i)
                start.append(list(packing.values()))
            found = evolve(size, capacity, key[0] * 1000 + key[1] * 10 + epoch, start)
            at = np.empty(len(size), np.int32)
            place = np.zeros(len(size), np.int64)
            for b, x in enumerate(found):
                off = 0
                for i in x:
                    at[i], place[i] = b, off
                    off += size[i]
            group["bins"] = [[int(b)] for b in at]
            return group[["uid", "length", "shard", "island", "bins"]].assign(bin=at, offset=place, n_bins=len(found))

        return run

    schema = "uid long, length long, shard int, island int, bins array<int>, bin int, offset long, n_bins int"
    # Every epoch is dealt anew: one shuffle of narrow rows, and each island stays one bounded task group.
    for epoch in range(epochs):
        # narrow rows, long searches: a task an island, or small partitions would be merged into a few tasks
        solved = solved.repartition(shards * islands, "shard", "island").groupBy("shard", "island").applyInPandas(island(epoch), schema)
        if epoch < epochs - 1:
            moved = solved.select("uid", "length", "shard", F.struct("island", "bin").alias("told"), F.explode(F.array("island", (F.col("island") + 1) % islands)).alias("island"))
            # An island meets its own packing and its neighbour's.
            solved = moved.groupBy("uid", "length", "shard", "island").agg(F.transform(F.sort_array(F.collect_list("told")), lambda t: t["bin"]).alias("bins"))
    solved = written(solved.drop("bins"), "packed")
    winner = solved.groupBy("shard").agg(F.min(F.struct("n_bins", "island")).alias("w")).select("shard", F.col("w.island").alias("island"))
    placed = solved.join(winner, ["shard", "island"]).select("uid", ((F.col("shard").cast("long") * (1 << 24) + F.col("bin")) * 2).alias("sequence_id"), "offset")
    return full.unionByName(rest.join(placed, "uid"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their places: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    # read by the result, which nobody waits for here: the cluster's shared folder is cleared with the job
    table = written(pieces(docs, path, capacity, end_id), "pieces")
    return pack(table, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
