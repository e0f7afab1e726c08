"""Byte-pair encoding and decoding over a vocabulary file of a public tokenizer.

Encoding keeps the symbols of a word in a doubly linked list and the possible
merges in a priority queue ordered by (rank, position); an entry whose symbols
have changed meanwhile is stale and skipped.  Decoding concatenates the
vocabulary strings.  Both are linear-logarithmic in the word's length, so a
very long word needs no special case.

Texts are normalised and cut into words here as the file says; those with
combining marks, or with code points that this Python's Unicode tables don't
know, are cut by the tokenizers library's own normaliser and word splitter,
whose tables are of other versions.  The merges are always made here.

Nulls count as empty texts (no ids, empty decoded text); very long texts are
encoded whole; repeated rows give
repeated results; other columns of the input are not read; an empty table gives
an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer



def unsure() -> list[tuple[int, int]]:
    """The runs of unassigned code points and of marks that change places when normalised."""
    flags = np.array([unicodedata.category(chr(c)) == "Cn" or unicodedata.combining(chr(c)) > 0 for c in range(0x110000)], np.int8)
    edge = np.diff(flags, prepend=0, append=0)
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True))


#: Letters and numbers of Latin-1, as the general categories L and N have them.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
LATIN_NUMBERS = "0-9²³¹¼½¾"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Code points on which versions of the Unicode tables may differ.
UNSURE = re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in unsure()) + "]")
#: Words whose ids a worker remembers, in each of two generations.
CACHE_WORDS = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class _Words(dict):
    """word -> ids as bytes; two generations bound the memory."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        if len(word) < 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordBpe:
    """A word-level BPE tokenizer read from its JSON file."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.strings = {i: s for s, i in vocab.items()}
        self.suffix = model.get("end_of_word_suffix") or ""
        # a pair of ids is one number
        self.shift = max(vocab.values()).bit_length()
        self.rank_of: dict[int, int] = {}
        self.new_of: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of.setdefault(vocab[a] << self.shift | vocab[b], rank)
            self.new_of.append(vocab[a + b])
        symbols = byte_symbols()
        self.path, self.library, self.byte_of = path, None, {c: b for b, c in enumerate(symbols)}
        self.inner = [vocab[s] for s in symbols]
        self.last = [vocab[s + self.suffix] for s in symbols]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings.update({i: s for s, i in self.added.items()})
        self.added_bytes = {s: np.array([i], dtype="<u4").tobytes() for s, i in self.added.items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # Texts within Latin-1 take a plain character class, which matches faster.
        self.find_latin = re.compile(pattern.replace(r"\s", " \t-\r\x85\xa0").replace(r"[\p{L}]", "[" + LATIN_LETTERS + "]").replace(r"\p{L}", LATIN_LETTERS).replace(r"\p{N}", LATIN_NUMBERS)).findall
        # The library's \s is Unicode white space, without the ASCII separators 1C to 1F that Python counts.
        self.find = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else None
        self.words = _Words(self.word_bytes, cache_words)

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        raw = word.encode("utf-8", "replace")
        inner, rank_of, new_of, shift = self.inner, self.rank_of, self.new_of, self.shift
        sym = [inner[b] for b in raw]
        sym[-1] = self.last[raw[-1]]
        n = len(sym)
        if n == 1:
            return sym
        # An entry is rank << 32 | position: the least rank first, then the leftmost.
        queue = []
        left = sym[0]
        for i in range(1, n):
            right = sym[i]
            if (left << shift | right) in rank_of:
                queue.append(rank_of[left << shift | right] << 32 | i - 1)
            left = right
        heapq.heapify(queue)
        after = [*range(1, n), -1]
        before = list(range(-1, n - 1))
        get, pop, push = rank_of.get, heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            j = after[i]
            if j < 0 or sym[i] < 0 or get(sym[i] << shift | sym[j]) != rank:
                continue  # stale
            sym[i] = new = new_of[rank]
            sym[j] = -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                r = get(new << shift | sym[k])
                if r is not None:
                    push(queue, r << 32 | i)
            h = before[i]
            if h >= 0:
                r = get(sym[h] << shift | new)
                if r is not None:
                    push(queue, r << 32 | h)
        return [s for s in sym if s >= 0]

    def word_bytes(self, word: str) -> bytes:
        return struct.pack(f"<{len(ids := self.encode_word(word))}I", *ids)

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if any(a in text for a in self.added):
            return b"".join(self.added_bytes.get(part) or self._plain(part) for part in self.split_added(text) if part)
        return self._plain(text)

    def _library_words(self, text: str) -> list[str]:
        """Words as the library normalises and cuts them; it gives them byte by byte in printable characters."""
        self.library = self.library or Tokenizer.from_file(self.path)
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, w)).decode("utf-8", "replace") for w, _ in cut]

    def _plain(self, text: str) -> bytes:
        find = self.find_latin
        if not text.isascii():
            raw, text = text, unicodedata.normalize("NFC", text)
            # The library lower-cases each character by itself: no final sigma.
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                if UNSURE.search(text):
                    return b"".join(map(self.words.__getitem__, self._library_words(raw)))
                text, find = text.replace("Σ", "σ"), self.find
        return b"".join(map(self.words.__getitem__, find(text.lower())))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text or ""), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings in order; the file names no decoder, so the library puts a space between them."""
        return " ".join(map(self.strings.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """One tokenizer, with the words it remembers, for all tasks of a worker."""
    return WordBpe(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of a full encode and decode."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                raw = bpe.encode_bytes(text.as_py() or "")
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(raw).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode("utf-8", "replace")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA)
