"""Personal data: exact base patterns, widened by a semi-Markov random field.

The base finds e-mail addresses, IPv4 addresses, card numbers and telephone
numbers by fixed patterns.  A semi-Markov conditional random field then reads
what the base leaves over near digits and ``@``: it cuts a region into atoms
(digit groups, words, single marks) and scores whole candidate spans of at most
``MAX_ATOMS`` atoms, or e-mail addresses from a region's begin on, with span
features (:func:`span_features`; candidates are spans whose digit, dot and sign
counts a kind allows), and the kinds of successive entities with transition
weights.  A dynamic program over (end of span, kind of the last entity) with
entities of bounded length chooses boundaries and types jointly.  The weights
are fitted here, by maximum likelihood (forward and backward sums over all
segmentations) on lines made from a seeded generator, numbers that are nothing
among them.  The field only adds spans that touch no base span.

Spans are (kind, start, end) in code points, end exclusive.  Nulls count as
empty texts without spans; repeated rows give repeated results; an empty table
gives an empty result; columns other than id and text are not read, or kept as
they are by :func:`redact`.  Of equally good segmentations the one that covers
more wins, then the one found first, from the left and the longest.  Very long
texts are scanned whole, in time linear in their length.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("email", "ip", "card", "phone")
#: Atoms in a span (15 digits with two marks between each have 43) and in a window (so in an e-mail address) at most, letters in a span at least, words that announce data.
MAX_ATOMS, WINDOW, LEAST = 43, 640, 7
CUES = {"card": {"card", "visa", "mastercard", "karte", "carte", "tarjeta"}, "phone": {"phone", "tel", "call", "mobile", "telefon", "téléphone", "teléfono"}, "email": {"email", "mail", "contact"}, "ip": {"ip", "host", "server", "addr", "address"}}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
NON_DIGITS = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind; matches that fail their test are dropped."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            last = m.end()
        else:
            last = at + 1  # no local part holds an @
        at = text.find("@", last)
    for m in DOTTED.finditer(text):
        runs = m.group().split(".")
        pos = m.start()
        for i in range(0, len(runs) - 3, 4):
            four = runs[i : i + 4]
            width = sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in four):
                out.append(("ip", pos, pos + width))
            pos += width + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := NON_DIGITS.sub("", m.group())) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NON_DIGITS.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    rank = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (s[1], rank[s[0]]))


# --- the semi-Markov field -------------------------------------------------

ATOM = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_|\s+|.", re.S)
#: Where the field looks: digits with marks that numbers use, or words joined by @ or "at".
REGION = re.compile(r"[+(]?[0-9][0-9 ().-]{6,}[0-9]|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++")
SHAPES = {
    "card": re.compile(r"[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}|[0-9]{14,19}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}"),
    "phone": re.compile(r"(?:\+?[0-9]{1,3}[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}|(?:\+|00)[0-9]{1,3}[ .-]?(?:\(0\)[ .-]?)?[0-9]{1,4}(?:[ .-][0-9]{2,4}){2,5}"),
    "ip": re.compile(r"[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}"),
    "email": re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+"),
}


def span_features(kind: str, span: str, before: str, after: str) -> list[str]:
    """Features of one whole candidate span of a kind."""
    digits = NON_DIGITS.sub("", span)
    n = len(digits)
    out = [kind, f"{kind} shape {SHAPES[kind].fullmatch(span) is not None}"]
    if kind == "card":
        out += [f"card length {n}", f"card luhn {14 <= n <= 19 and luhn(digits)}", f"card marks {min(2, len(set(NON_DIGITS.findall(span))))}"]
    elif kind == "phone":
        groups = re.findall("[0-9]+", span)
        out += [f"phone length {n}", f"phone groups {min(len(groups), 6)}", f"phone begin {span[0] if span[0] in '+(' else '00' if digits[:2] == '00' else 'digit'}"]
        out.append(f"phone least {min(map(len, groups[1:]), default=0)}")
        if len(groups) >= 3 and groups[-1:] and len(groups[-1]) == 4 and len(groups[-2]) == 3:
            out.append("phone three four")
    elif kind == "ip":
        parts = re.findall("[0-9]+", span)
        out += [f"ip parts {len(parts) == 4 and all(len(p) < 4 and int(p) < 256 for p in parts)}", f"ip blanks {' ' in span}"]
    else:
        sign = "@" if "@" in span else "mark" if "(at)" in span or "[at]" in span else "word"
        out += [f"email sign {sign}", f"email dots {min(span.count('.') + span.count('dot)') + span.count('dot]'), 3)}"]
    if before[-1:].isalnum() or after[:1].isalnum():
        out.append(f"{kind} inside")
    elif before[-1:] in (".", "-", "+", "(") and (before[-1:] in "+(" or before[-2:-1].isdigit()) or after[:1] in (".", "-") and after[1:2].isdigit():
        out.append(f"{kind} goes on")
    words = re.findall(r"[^\W\d_]+", before.lower())[-2:]
    if any(w in CUES[kind] for w in words):
        out.append(f"{kind} cue")
    elif any(w in cues for k, cues in CUES.items() if k != kind for w in words):
        out.append(f"{kind} other cue")
    return out


#: What numbers consist of, and marks that no address begins or ends with.
NUMBER_CHARS, PLAIN_MARKS = frozenset("0123456789 +().-"), frozenset("()[]@.,;:!?")
#: Weight given to features that training never saw.
UNSEEN = -0.5


def candidates(text: str, start: int, end: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, str, int, int]]]:
    """The atoms of text[start:end], and (first atom, atom after the last, kind, begin, end) of every candidate span, by its last atom."""
    atoms = [(m.start(), m.end()) for m in ATOM.finditer(text, start, end)]
    digits, groups, dots, signs, others = [0], [0], [0], [0], [0]
    for a, b in atoms:
        others.append(others[-1] + (text[a] not in NUMBER_CHARS))
        digits.append(digits[-1] + (b - a if text[a].isdigit() else 0))
        groups.append(groups[-1] + text[a].isdigit())
        dots.append(dots[-1] + (text[a] == "."))
        signs.append(signs[-1] + (text[a] == "@" or text[a:b] == "at"))
    out = []
    near = 0  # from here on a span has at most 19 digits
    for j in range(1, len(atoms) + 1):
        if text[atoms[j - 1][1] - 1].isspace():
            continue
        while digits[j] - digits[near] > 19:
            near += 1
        first = max(0, j - MAX_ATOMS)
        for i in [*([0] if first else []), *range(first, j)] if signs[j] else range(max(near, first), j):
            a, b = atoms[i][0], atoms[j - 1][1]
            if b - a < LEAST or text[a].isspace():
                continue
            if signs[j] > signs[i] and text[a] not in PLAIN_MARKS and text[b - 1] not in PLAIN_MARKS:
                out.append((i, j, "email", a, b))
            # numbers hold no letters, end with a digit and begin with one or its sign
            d = digits[j] - digits[i]
            if others[j] > others[i] or d < 4 or not text[b - 1].isdigit() or text[a] in " .-)":
                continue
            for kind, can in (("ip", dots[j] - dots[i] == 3 and groups[j] - groups[i] == 4 and d <= 12), ("card", 14 <= d <= 19 and text[a].isdigit() and dots[j] == dots[i]), ("phone", 10 <= d <= 15)):
                if can:
                    out.append((i, j, kind, a, b))
    return atoms, out


def features_at(text: str, kind: str, a: int, b: int) -> list[str]:
    return span_features(kind, text[a:b], text[max(0, a - 40) : a], text[b : b + 2])


def segment(text: str, start: int, end: int, weights: dict[str, float], last: str = "") -> list[tuple[str, int, int]]:
    """Best joint segmentation of text[start:end] after an entity of kind ``last``, if any."""
    atoms, spans = candidates(text, start, end)
    kinds = ("", *KINDS)
    to = {c: {k: weights.get(f"{k}>{c}", 0.0) for k in kinds} for c in KINDS}
    # best[j][k]: (score, span that ends it or None) of the atoms before j, the last entity being of kind k
    best: list[dict[str, tuple]] = [{last: (0.0, None)}]
    at = 0
    for j in range(1, len(atoms) + 1):
        row = {k: (s, None) for k, (s, _) in best[j - 1].items()}
        while at < len(spans) and spans[at][1] == j:
            i, _, kind, a, b = spans[at]
            at += 1
            own = sum(weights.get(f, UNSEEN) for f in features_at(text, kind, a, b))
            own += (b - a) * 1e-6  # of equal ones, what covers more
            for k, (s, _) in best[i].items():
                total = s + own + to[kind][k]
                if kind not in row or total > row[kind][0]:
                    row[kind] = (total, (i, k, kind, a, b))
        best.append(row)
    j, k = len(atoms), max(best[-1], key=lambda k: best[-1][k][0])
    found = []
    while j:
        span = best[j][k][1]
        if span is None:
            j -= 1
        else:
            j, k = span[0], span[1]
            found.append(span[2:])
    return found[::-1]


def _example(rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A made line with known spans: pairs, odd marks, words around, and numbers that are nothing."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    letters = lambda n: "".join(rng.choice("abcdefghilmnorstuv") for _ in range(n))
    pick = rng.choice

    def card() -> str:
        n = pick([16, 16, 16, 15, 14, 19])
        body = digits(n - 1)
        d = next(body + c for c in "0123456789" if luhn(body + c))
        sep = pick(["", "", " ", "-"])
        cut = [4, 6, 5] if n == 15 else [4] * (n // 4) + [n % 4] * (n % 4 > 0)
        at = [sum(cut[:i]) for i in range(len(cut) + 1)]
        return sep.join(d[x:y] for x, y in zip(at, at[1:], strict=False))

    def phone() -> str:
        country = pick(["1 ", "44 ", "0049 ", "0033 ", "00 39 "])
        local = pick([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}", f"{digits(3)} {digits(3)} {digits(4)}"])
        pairs = f"{pick(['(0)', '0', ''])}{digits(1)} {' '.join(digits(2) for _ in range(4))}"
        return pick([local, local, "1 " + local, pick(["", "0"]) + country + pairs, f"(0{digits(2)}) {digits(4)} {digits(4)}"])

    def email() -> str:
        local = pick([f"{letters(2)}{digits(2)}", f"{letters(4)}.{letters(3)}", letters(5), f"{letters(2)}-{digits(1)}_{letters(2)}"])
        dot = pick([".", " (dot) ", " [dot] "])
        return local + pick([" @ ", " (at) ", " [at] "]) + dot.join([*(letters(4) + pick(["", digits(1)]) for _ in range(rng.randrange(1, 4))), pick(["org", "com", "net", "example"])])

    made = {"card": card, "phone": phone, "ip": lambda: pick([".", " . ", ". "]).join(str(rng.randrange(256)) for _ in range(4)), "email": email}
    noise = [
        lambda: digits(rng.randrange(8, 24)),
        lambda: f"{digits(4)}-{digits(2)}-{digits(2)}",
        lambda: f"{digits(4)}-{digits(2)}-{digits(2)} {digits(2)}:{digits(2)}:{digits(2)}",
        lambda: f"{digits(2)}.{digits(2)}.{digits(4)} {digits(2)}",
        lambda: ".".join(digits(rng.randrange(1, 5)) for _ in range(5)),
        lambda: " ".join(digits(rng.randrange(1, 4)) for _ in range(rng.randrange(4, 9))),
        lambda: " ".join(str(y) for y in range(1990, 1990 + rng.randrange(3, 8))),
        lambda: f"{digits(3)}-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}",
        lambda: f"{digits(1)}.{digits(3)}.{digits(3)},{digits(2)}",
        lambda: f"{digits(4)} - {digits(4)} - {digits(4)}",
        lambda: f"look at {letters(5)}.org",
        lambda: f"{letters(4)}{digits(12)}",
        lambda: " ".join(letters(rng.randrange(2, 7)) for _ in range(3)),
    ]
    every = sorted({w for c in CUES.values() for w in c})
    text, spans = pick(["", "see ", "the ", "no. "]), []
    for _ in range(rng.randrange(1, 5)):
        if rng.random() < 0.55:
            kind = pick(KINDS)
            if rng.random() < 0.4:
                text += pick(sorted(CUES[kind])) + pick([" ", ": "])
            s = made[kind]()
            spans.append((kind, len(text), len(text) + len(s)))
        else:
            if rng.random() < 0.2:
                text += pick(every) + " "
            s = pick(noise)()
        text += s + pick([" ", " ", ", ", " and ", "; ", "\n"])
    return text, spans


def examples(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    rng = random.Random(seed)
    return [_example(rng) for _ in range(n)]


def _prepared(text: str, gold: list[tuple[str, int, int]], number: dict[str, int]) -> tuple | None:
    """A line for training: atoms, candidates with their features' numbers, and the gold ones; None where gold has no candidate."""
    atoms, spans = candidates(text, 0, len(text))
    wanted = set(gold)
    rows, right = [], []
    for i, j, kind, a, b in spans:
        fs = [number.setdefault(f, len(number)) for f in features_at(text, kind, a, b)]
        if (kind, a, b) in wanted:
            right.append(len(rows))
        rows.append((i, j, KINDS.index(kind) + 1, np.array(fs)))
    return (len(atoms), rows, right) if len(right) == len(wanted) else None


def _gradient(n: int, rows: list, right: list[int], w: np.ndarray, to: np.ndarray, grad: np.ndarray, grad_to: np.ndarray) -> float:
    """Adds a line's gradient of the log-likelihood, which is returned."""
    own = [float(w[fs].sum()) for _, _, _, fs in rows]
    total = lambda v: (m := max(v)) + math.log(sum(math.exp(x - m) for x in v)) if v else -math.inf
    gone = -math.inf
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_begin: list[list[int]] = [[] for _ in range(n + 1)]
    for r, (i, j, _, _) in enumerate(rows):
        by_end[j].append(r)
        by_begin[i].append(r)
    forward = [[0.0] + [gone] * 4]
    for j in range(1, n + 1):
        sums = [[x] if x > gone else [] for x in forward[j - 1]]
        for r in by_end[j]:
            i, _, c, _ = rows[r]
            sums[c] += [x + own[r] + to[k, c] for k, x in enumerate(forward[i]) if x > gone]
        forward.append([total(v) for v in sums])
    z = total([x for x in forward[n] if x > gone])
    backward = [[0.0] * 5 for _ in range(n + 1)]
    for j in range(n - 1, -1, -1):
        for k in range(5):
            if forward[j][k] > gone:
                backward[j][k] = total([backward[j + 1][k], *(own[r] + to[k, rows[r][2]] + backward[rows[r][1]][rows[r][2]] for r in by_begin[j])])
    for r, (i, j, c, fs) in enumerate(rows):
        p = 0.0
        for k in range(5):
            if forward[i][k] > gone:
                q = math.exp(min(0.0, forward[i][k] + own[r] + to[k, c] + backward[j][c] - z))
                grad_to[k, c] -= q
                p += q
        if p > 1e-9:
            grad[fs] -= p
    score, k = -z, 0
    for r in right:
        c = rows[r][2]
        grad[rows[r][3]] += 1
        grad_to[k, c] += 1
        score += own[r] + to[k, c]
        k = c
    return score


@functools.lru_cache(maxsize=1)
def train(lines: int = 500, rounds: int = 12, seed: int = 7) -> dict[str, float]:
    """Maximum likelihood with a ridge, by adaptive gradient steps; the lines and so the weights are the same everywhere."""
    number: dict[str, int] = {}
    data = [d for d in (_prepared(t, g, number) for t, g in examples(lines, seed)) if d]
    w, to = np.zeros(len(number)), np.zeros((5, 5))
    seen_w, seen_to = np.full(len(number), 1e-3), np.full((5, 5), 1e-3)
    for _ in range(rounds):
        for lo in range(0, len(data), 50):
            grad, grad_to = -0.01 * w, -0.01 * to
            for n, rows, right in data[lo : lo + 50]:
                _gradient(n, rows, right, w, to, grad, grad_to)
            seen_w += grad * grad
            seen_to += grad_to * grad_to
            w += 0.6 * grad / np.sqrt(seen_w)
            to += 0.6 * grad_to / np.sqrt(seen_to)
    kinds = ("", *KINDS)
    out = {f: float(w[i]) for f, i in number.items()}
    return out | {f"{k}>{c}": float(to[i, j]) for i, k in enumerate(kinds) for j, c in enumerate(kinds) if c}


def windowed(text: str, start: int, end: int, weights: dict[str, float]) -> list[tuple[str, int, int]]:
    """Segmentation of text[start:end] in windows of bounded length.

    Spans that end in a window's last ``MAX_ATOMS`` atoms, and so could go on beyond it,
    are left to the next window, which begins with the first of them.
    """
    out, at, kind = [], 0, ""
    atoms = [(m.start(), m.end()) for m in ATOM.finditer(text, start, end)]
    starts = {a: i for i, (a, _) in enumerate(atoms)}
    while at < len(atoms):
        last = at + WINDOW
        found = segment(text, atoms[at][0], atoms[min(last, len(atoms)) - 1][1], weights, kind)
        if last >= len(atoms):
            return out + found
        sure = atoms[last - MAX_ATOMS][0]
        keep = [s for s in found if s[2] <= sure]
        out += keep
        kind = out[-1][0] if out else ""
        at = starts[found[len(keep)][1]] if len(keep) < len(found) else last - MAX_ATOMS
    return out


def added_spans(text: str, base: list[tuple[str, int, int]], weights: dict[str, float]) -> list[tuple[str, int, int]]:
    """Spans of the field in regions of the text that no base span touches."""
    out, k = [], 0
    busy = sorted((a, b) for _, a, b in base)
    if not any(c in text for c in "0123456789@") and "at" not in text:
        return out
    for m in REGION.finditer(text):
        while k < len(busy) and busy[k][1] <= m.start():
            k += 1
        # the parts of the region between base spans
        parts, at, i = [], m.start(), k
        while i < len(busy) and busy[i][0] < m.end():
            parts.append((at, busy[i][0]))
            at = max(at, busy[i][1])
            i += 1
        parts.append((at, m.end()))
        for a, b in parts:
            if b - a >= 8:
                out += windowed(text, a, b, weights)
    return out


def find_spans(text: str | None, weights: dict[str, float]) -> tuple[list, list]:
    """(base spans, all spans) of a text, in order."""
    base = base_spans(text or "")
    rank = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + added_spans(text or "", base, weights), key=lambda s: (s[1], rank[s[0]]))


def shown(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, all_email long, all_ip long, all_card long, all_phone long"


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``n_`` counts base spans, ``n_added`` those of the field, ``all_`` both."""
    weights = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, every, sha, texts, added = [], [], [], [], []
            for text in batch.column(1):
                base, spans = find_spans(text.as_py(), weights)
                counts.append([sum(s[0] == k for s in base) for k in KINDS] if base else [0] * 4)
                every.append([sum(s[0] == k for s in spans) for k in KINDS] if spans else [0] * 4)
                sha.append(hashlib.sha256(shown(base).encode()).hexdigest())
                texts.append(shown(spans))
                added.append(len(spans) - len(base))
            cols, more = ([pa.array([c[i] for c in t], pa.int64()) for i in range(4)] for t in (counts, every))
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols, pa.array(sha, pa.string()), pa.array(texts, pa.string()), pa.array(added, pa.int64()), *more], names=[f.split()[0] for f in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, SCHEMA)


def redacted(text: str | None, weights: dict[str, float]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans count as one of the first kind."""
    if not text:
        return text
    out, last = [], 0
    for kind, a, b in find_spans(text, weights)[1]:
        if a >= last:
            out += [text[last:a], f"<{kind}>"]
        last = max(last, b)
    return "".join([*out, text[last:]]) if out else text


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; ``n_chars`` follows the new text, other columns stay."""
    weights = train()
    names = docs.columns
    at_text = names.index("text")
    at_chars = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(batch.columns)
            texts = [redacted(t.as_py(), weights) for t in cols[at_text]]
            cols[at_text] = pa.array(texts, batch.schema.field(at_text).type)
            if at_chars is not None:
                old = cols[at_chars]
                cols[at_chars] = pa.array([len(t) if t is not None else o.as_py() for t, o in zip(texts, old, strict=True)], old.type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, docs.schema)
