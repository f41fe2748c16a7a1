"""Personal data: base patterns and a semi-Markov conditional random field.

Base patterns give certain spans. Around every digit or at-sign a *region* is cut
into atoms (runs of digits, runs of letters, single characters). Candidate
segments of at most ``MAX_ATOMS`` atoms are scored as whole spans: digit counts,
checksums, separators, grouping, borders, words before them. Dynamic programming
over the region chooses boundaries and types together; base spans are clamped,
so they always stay. A segment that is no base span is reported if its marginal
probability is at least ``SURE``. The model is trained on generated examples and
on regions of a bounded sample of texts, labelled by the base patterns.
"""

from __future__ import annotations

import functools
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import texts

KINDS = ("email", "ip", "card", "phone")
TRAIN_TEXTS = 400       # texts with digits whose regions join the generated examples
GENERATED = 500
EPOCHS = 5
MAX_ATOMS = 24          # atoms of a segment
MAX_CHARS = 64          # characters of a segment
REACH = 96              # characters that a region extends beyond a digit or at-sign
SURE = 0.9
CLAMP = 60.0

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that starts inside a run of digits could start at the run's first one.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: from every domain back over the local part."""
    out, end = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            out.append((start, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


_SEED = re.compile(r"[0-9@]+")
_ATOM = re.compile(r"[0-9]+|[A-Za-z]+|.", re.DOTALL)


def regions(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or at-sign, joined over one space or hyphen; borders within ``REACH``."""
    out: list[list[int]] = []
    for m in _SEED.finditer(text):
        a, b = m.span()
        if out and a < out[-1][1]:
            if b <= out[-1][1]:
                continue
            a = out[-1][1]
        low, high = max(0, a - REACH, out[-1][1] if out else 0), min(len(text), b + REACH)
        while a > low and not text[a - 1].isspace():
            a -= 1
        while b < high and not text[b].isspace():
            b += 1
        if out and a - out[-1][1] <= 1:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


_CONTEXT = tuple(re.compile(p, re.IGNORECASE) for p in (
    r"\b(e-?mail|mail|contact)\W*$", r"\b(ip|host|server|address|addr)\W*$",
    r"\b(card|visa|mastercard|credit|pan)\W*(no|number)?\W*$", r"\b(tel|phone|call|fax|mobile|cell)\W*$"))

FEATURES = 14           # numbers per kind, the constant included


def _candidate(kind: int, s: str, digits: str, alone: bool, before: str) -> list[float] | None:
    """Whole-span features of ``s`` as ``kind``; None where it cannot be one."""
    n = len(digits)
    plain = not any(c.isalpha() or c == "@" for c in s)
    if kind == 0:
        if s.count("@") != 1 or " " in s:
            return None
        local, domain = s.split("@")
        parts = domain.split(".")
        own = [len(parts) >= 2 and all(parts), bool(local) and local[0].isalnum(), parts[-1].isalpha() and 2 <= len(parts[-1]) <= 8,
               all(c in _LOCAL for c in local), all(c.isalnum() or c in ".-" for c in domain), len(local) <= 40, len(domain) >= 4]
    elif not plain or not s[-1].isdigit():
        return None
    elif kind == 1:
        parts = re.split(r"[.:]", s)
        if len(parts) < 3 or not all(p.isdigit() and p.isascii() for p in parts):
            return None
        own = [len(parts) == 4, all(len(p) < 4 and int(p) < 256 for p in parts), ":" in s, parts[0] not in ("0", "00"),
               all(p == "0" or p[0] != "0" for p in parts), n >= 6, max(map(len, parts)) <= 3]
    elif kind == 2:
        if not 13 <= n <= 19 or not s[0].isdigit() or set(s) - set("0123456789 -."):
            return None
        groups = re.split(r"[ .-]", s)
        own = [luhn(digits), n == 16, digits[0] in "3456", all(len(g) == 4 for g in groups[:-1]), len(groups) == 1,
               len({c for c in s if not c.isdigit()}) <= 1, min(map(len, groups)) >= 3]
    else:
        if not 7 <= n <= 15 or s[0] not in "+(0123456789" or set(s) - set("+0123456789 ().-/"):
            return None
        groups = re.findall(r"[0-9]+", s)
        own = [s[0] == "+", n >= 10, "(" in s and ")" in s, len(groups) >= 3, max(map(len, groups)) <= 4,
               s.count("+") + s.count("(") <= 2 and s.count("(") == s.count(")"), len(groups) == 1]
    return [1.0, *map(float, own), float(alone), float(bool(_CONTEXT[kind].search(before))), float(n >= 10), float(n > 12),
            len(s) / 16, float(any(c in " -./" for c in s))]


def candidates(text: str, a: int, b: int) -> tuple[list[int], list[tuple[int, int, int, np.ndarray]]]:
    """(atom borders, [(first border, last border, kind, features)]) of a region."""
    cuts = [m.start() for m in _ATOM.finditer(text, a, b)] + [b]
    out = []
    before = text[max(0, a - 24):a]
    for i in range(len(cuts) - 1):
        start = cuts[i]
        first = text[start]
        if not (first.isascii() and (first.isalnum() or first in "+(")):
            continue
        border = start == 0 or not text[start - 1].isalnum()
        for j in range(i + 1, min(i + MAX_ATOMS, len(cuts) - 1) + 1):
            end = cuts[j]
            if end - start > MAX_CHARS:
                break
            last = text[end - 1]
            if not (last.isascii() and last.isalnum()):
                continue
            s = text[start:end]
            digits = _digits(s)
            if len(digits) < 6 and "@" not in s:
                continue
            alone = border and (end >= len(text) or not text[end].isalnum())
            left = text[max(0, start - 24):start] if start > a else before
            for kind in range(len(KINDS)):
                f = _candidate(kind, s, digits, alone, left)
                if f is not None:
                    out.append((i, j, kind, np.array(f)))
    return cuts, out


class SemiMarkov:
    """Weights per kind; an atom outside all spans scores 0."""

    def __init__(self, weights: np.ndarray | None = None):
        self.w = np.zeros((len(KINDS), FEATURES)) if weights is None else weights

    def lattice(self, n: int, cands: list, bonus: np.ndarray | None = None):
        scores = np.array([self.w[k] @ f for _, _, k, f in cands]) if cands else np.zeros(0)
        if bonus is not None:
            scores = scores + bonus
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for c, (i, j, _, _) in enumerate(cands):
            ending[j].append(c)
            starting[i].append(c)
        return scores, ending, starting

    def marginals(self, n: int, cands: list, scores, ending, starting) -> tuple[np.ndarray, float]:
        """Probability of every candidate and the log partition sum."""
        alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            terms = [alpha[j - 1]] + [alpha[cands[c][0]] + scores[c] for c in ending[j]]
            top = max(terms)
            alpha[j] = top + math.log(sum(math.exp(t - top) for t in terms))
        for i in range(n - 1, -1, -1):
            terms = [beta[i + 1]] + [beta[cands[c][1]] + scores[c] for c in starting[i]]
            top = max(terms)
            beta[i] = top + math.log(sum(math.exp(t - top) for t in terms))
        p = np.array([math.exp(min(0.0, alpha[i] + s + beta[j] - alpha[n])) for (i, j, _, _), s in zip(cands, scores, strict=True)])
        return p, alpha[n]

    def best(self, n: int, cands: list, scores, ending) -> list[int]:
        """Candidates on the best path."""
        value, back = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            value[j] = value[j - 1]
            for c in ending[j]:
                v = value[cands[c][0]] + scores[c]
                if v > value[j]:
                    value[j], back[j] = v, c
        out, j = [], n
        while j > 0:
            if back[j] < 0:
                j -= 1
            else:
                out.append(back[j])
                j = cands[back[j]][0]
        return out[::-1]

    def fit(self, examples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.5) -> SemiMarkov:
        """Gradient steps (scaled by past squares) on the log likelihood of labelled texts."""
        data = []
        for text, gold in examples:
            spans = {(a, b, k) for a, k, b in gold}
            for a, b in regions(text):
                cuts, cands = candidates(text, a, b)
                if cands:
                    own = np.array([(cuts[i], cuts[j], k) in spans for i, j, k, _ in cands], dtype=float)
                    data.append((len(cuts) - 1, cands, own))
        past, order = np.full_like(self.w, 1e-3), random.Random(5)
        for _ in range(epochs):
            order.shuffle(data)
            for n, cands, own in data:
                scores, ending, starting = self.lattice(n, cands)
                p, _ = self.marginals(n, cands, scores, ending, starting)
                grad = -1e-3 * self.w
                for (_, _, k, f), d in zip(cands, own - p, strict=True):
                    if abs(d) > 1e-4:
                        grad[k] += d * f
                past += grad * grad
                self.w += rate * grad / np.sqrt(past)
        return self

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """(base spans, all spans) of a text, each (start, kind index, end) and sorted."""
        base = base_spans(text)
        found, near = set(base), _Overlaps(base)
        for a, b in regions(text):
            cuts, cands = candidates(text, a, b)
            if not cands:
                continue
            bonus = np.zeros(len(cands))
            for c, (i, j, k, _) in enumerate(cands):
                for s in near.of(cuts[i], cuts[j]):
                    if (cuts[i], k, cuts[j]) == s:
                        bonus[c] = CLAMP
                    elif bonus[c] <= 0:
                        bonus[c] = min(bonus[c], -CLAMP)
            scores, ending, starting = self.lattice(len(cuts) - 1, cands, bonus)
            if scores.max() <= 0:
                continue
            p = None
            for c in self.best(len(cuts) - 1, cands, scores, ending):
                i, j, k, _ = cands[c]
                span = (cuts[i], k, cuts[j])
                if span in found or next(near.of(cuts[i], cuts[j]), None):
                    continue
                if p is None:
                    p, _ = self.marginals(len(cuts) - 1, cands, scores, ending, starting)
                if p[c] >= SURE:
                    found.add(span)
        return base, sorted(found)


class _Overlaps:
    """Spans, sorted by start, looked up by the range they overlap."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.spans, self.starts = spans, [s[0] for s in spans]
        self.reach = list(accumulate((s[2] for s in spans), max))       # the furthest end so far

    def of(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        i = bisect_left(self.starts, end) - 1
        while i >= 0 and self.reach[i] > start:
            if self.spans[i][2] > start:
                yield self.spans[i]
            i -= 1


def generated_examples(n: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Labelled sentences: entities in common spellings, and numbers that are none."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(k))
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card() -> str:
        body = rng.choice("3456") + num(rng.choice((14, 14, 14, 13)))
        return next(body + c for c in "0123456789" if luhn(body + c))

    def group(s: str, sep: str) -> str:
        return sep.join(s[i:i + 4] for i in range(0, len(s), 4))

    def octets(top: int) -> str:
        return ".".join(str(rng.randint(1, top)) for _ in range(4))

    entity = (
        lambda: (0, f"{word(5)}.{num(2)}@{word(6)}.{rng.choice(('com', 'org', 'de', 'example.com'))}"),
        lambda: (1, octets(255)),
        lambda: (2, card()), lambda: (2, group(card(), rng.choice(" -"))),
        lambda: (3, f"+{rng.randint(1, 99)} ({num(3)}) {num(3)}-{num(4)}"), lambda: (3, f"({num(3)}) {num(3)}-{num(4)}"),
        lambda: (3, f"+{rng.randint(1, 99)}{num(10)}"), lambda: (3, f"{num(3)}-{num(3)}-{num(4)}"),
    )
    other = (
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: num(rng.randint(1, 9)),
        lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}", lambda: f"{num(2)}:{num(2)}:{num(2)}",
        lambda: octets(255).replace(".", ".9", 1) + num(2), lambda: "4" + num(15) + rng.choice(("7a", "x1")), lambda: f"@{word(6)}",
        lambda: f"{word(4)}={num(5)}{word(2)}{num(4)}", lambda: f"{num(3)},{num(3)},{num(3)}", lambda: f"${num(4)}.{num(2)}",
        lambda: num(rng.choice((10, 11, 12, 13))), lambda: f"{num(4)} {num(4)}", lambda: f"{num(1)} {num(2)} {num(3)} {num(1)} {num(2)} {num(1)}",
    )
    cue = (("mail", "contact"), ("host", "ip"), ("card", "credit card"), ("call", "tel", "phone"))
    out = []
    for _ in range(n):
        text, gold = word(6) + " ", []
        for _ in range(rng.randint(1, 3)):
            if rng.random() < 0.5:
                kind, s = rng.choice(entity)()
                if rng.random() < 0.4:
                    text += rng.choice(cue[kind]) + rng.choice((" ", ": "))
                gold.append((len(text), kind, len(text) + len(s)))
            else:
                s = rng.choice(other)()
            text += s + rng.choice((" ", ". ", ", ")) + word(rng.randint(2, 7)) + " "
        out.append((text, gold))
    return out


@functools.lru_cache(maxsize=4)
def _generated_model(n: int) -> SemiMarkov:
    return SemiMarkov().fit(generated_examples(n))


def train(docs: DataFrame) -> SemiMarkov:
    """The model: generated examples, then regions of ``TRAIN_TEXTS`` texts labelled by the base patterns.

    The texts are those with a digit that come first by a hash of the text. A
    region where the model so far finds more than the patterns is left out: there
    a pattern may have run two entities into one.
    """
    hashed = docs.select("text", F.xxhash64("text").alias("h")).where(F.col("text").rlike("[0-9]"))
    first = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(TRAIN_TEXTS).collect()]
    sample = hashed.where(F.col("h") <= first[-1]).groupBy("h").agg(F.min("text").alias("text")).collect() if first else []
    model = SemiMarkov(_generated_model(GENERATED).w.copy())
    examples = []
    for text in sorted(r["text"] for r in sample):
        for a, b in regions(text):
            piece = text[max(0, a - 24):b]
            base, every = model.spans(piece)
            if base and base == every:
                examples.append((piece, base))
    return model.fit(examples[:TRAIN_TEXTS], epochs=1, rate=0.05) if examples else model


def find(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, base, spans``; arrays of (kind, start, end), sorted by start, then kind.

    Offsets are code points, ends exclusive. ``base`` are the matches of the
    base patterns, leftmost and non-overlapping per kind; ``spans`` adds what the
    model finds apart from them. A null or empty text has none. Rows stay one to
    one, repeated rows agree, other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs))      # a few dozen weights
    src = texts(docs.select("doc_id", "text"), "doc_id")
    hint = np.zeros(256, dtype=bool)
    hint[[*range(0x30, 0x3A), ord("@")]] = True
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    named = lambda found: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in found]

    def run(batches):
        m = model.value
        for batch in batches:
            offsets, data = K.string_buffers(batch.column("text"))
            counts = np.concatenate(([0], np.cumsum(hint[data], dtype=np.int64)))
            some = counts[offsets[1:]] > counts[offsets[:-1]]
            base, every = [()] * batch.num_rows, [()] * batch.num_rows
            column = batch.column("text")
            for r in np.flatnonzero(some).tolist():
                own, found = m.spans(column[r].as_py())
                base[r], every[r] = named(own), named(found)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(base, span), pa.array(every, span)],
                                             names=["doc_id", "base", "spans"])

    kind = dict(src.dtypes)["doc_id"]
    s = "array<struct<kind:string,start:bigint,end:bigint>>"
    return src.mapInArrow(run, f"doc_id {kind}, base {s}, spans {s}")
