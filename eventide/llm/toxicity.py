"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is learned from labelled texts: words and word stems that are much
commoner in toxic ones. Its trie and the automata of 'within k edits' are run
together over a word: a state is the set of (trie node, edits so far) that the
letters read can have reached, built when first needed. So misspelled terms are
found without listing their spellings. Every hit is scored in its window of
words: hits close together add up, quoted or reported ones count apart. A
logistic model of these scores, fitted on the same labelled sample, gives the
probability that a text is toxic.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import join_small, texts, written

TRAIN_ROWS = 50_000     # about so many labelled rows fit the lexicon and the model
STEMS = (4, 5, 6)       # letters of the stems tried besides whole words
MIN_TOXIC = 3           # toxic texts that hold a term
MIN_SHARE = 0.01        # and the share of toxic texts that do
SPECIFIC = 0.8          # share of a stem's support at which a longer term replaces it
MIN_ODDS = 4.0          # log odds ratio of a term
SHORTEST = 2            # letters of the shortest whole word
WINDOW = 6              # words to either side of a hit
CACHE = 400_000         # words whose match a task remembers
STATES = 200_000        # automaton states it keeps; beyond, they are built anew
N_FEATURES = 7

_QUOTES = re.compile(r"[\"'`«»‘’“”]")
_REPORT = re.compile(r"(?i)\b(said|says|called|calls|quote[ds]?|word|term|wrote|insult|dit|sagte|dijo)\b")

# Word characters: letters and digits, and what ``_letters`` leaves beyond ASCII.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = True
IS_WORD[0x80:] = True


def _letters(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with those of punctuation, symbols and spaces beyond ASCII blanked; places stay."""
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return data
    size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
    key = np.zeros(len(lead), dtype=np.uint32)             # the character's bytes as one number
    for k in range(4):
        here = size > k
        key[here] = (key[here] << 8) | data[lead[here] + k]
    known, at = np.unique(key, return_inverse=True)
    cut = np.array([unicodedata.category(int(c).to_bytes(4, "big").lstrip(b"\0").decode())[0] in "PSZ" for c in known])[at]
    out = data.copy()
    for k in range(4):
        out[lead[cut & (size > k)] + k] = 0x20
    return out


def edits_allowed(term: str, stem: bool) -> int:
    """Edits that a term of this length may carry; a stem needs more letters for one."""
    return 0 if len(term) < (6 if stem else 5) else 1 if len(term) < 10 else 2


class Lexicon:
    """Trie of terms with a lazily built automaton of their neighbourhoods.

    ``match(word)`` gives (weight, edits) of the best term: fewest edits, then
    the largest weight; None if no term is near.
    """

    def __init__(self, terms: dict[tuple[str, bool], float]):
        self.children: list[dict[str, int]] = [{}]
        self.weight: list[float | None] = [None]       # of a whole word that ends here
        self.stem: list[float | None] = [None]
        self.budget = [0]                              # most edits of any term through a node
        self.slack: list[tuple[int, int]] = [(0, 0)]   # edits allowed to the word, the stem ending here
        for (term, is_stem), w in terms.items():
            node, k = 0, edits_allowed(term, is_stem)
            path = [0]
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.weight.append(None)
                    self.stem.append(None)
                    self.budget.append(0)
                    self.slack.append((0, 0))
                node = self.children[node][c]
                path.append(node)
            for x in path:
                self.budget[x] = max(self.budget[x], k)
            word_k, stem_k = self.slack[node]
            if is_stem:
                self.stem[node], self.slack[node] = max(w, self.stem[node] or 0.0), (word_k, k)
            else:
                self.weight[node], self.slack[node] = max(w, self.weight[node] or 0.0), (k, stem_k)
        self.reset()

    def reset(self) -> None:
        """Forget all states but the first."""
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.final: list[tuple[float, int] | None] = []
        self.passing: list[tuple[float, int] | None] = []
        self.start = self._state(self._closed({(0, 0)}))

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """``pairs`` with all nodes reached by skipping letters of the term; least edits per node."""
        best: dict[int, int] = {}
        todo = sorted(pairs, key=lambda p: p[1])
        while todo:
            node, e = todo.pop()
            if best.get(node, 99) <= e or e > self.budget[node]:
                continue
            best[node] = e
            todo += [(child, e + 1) for child in self.children[node].values() if e + 1 <= self.budget[child]]
        return frozenset(best.items())

    def _state(self, pairs: frozenset) -> int:
        if pairs in self.states:
            return self.states[pairs]
        self.states[pairs] = state = len(self.sets)
        self.sets.append(pairs)
        self.steps.append({})
        ends = [(self.weight[n], e) for n, e in pairs if self.weight[n] is not None and e <= self.slack[n][0]]
        stems = [(self.stem[n], e) for n, e in pairs if self.stem[n] is not None and e <= self.slack[n][1]]
        best = lambda found: min(found, key=lambda f: (f[1], -f[0]), default=None)
        self.final.append(best(ends))
        self.passing.append(best(stems))
        return state

    def _step(self, state: int, c: str) -> int:
        to = set()
        for node, e in self.sets[state]:
            for letter, child in self.children[node].items():
                if letter == c:
                    to.add((child, e))
                elif e + 1 <= self.budget[child]:
                    to.add((child, e + 1))                    # another letter
            if e + 1 <= self.budget[node]:
                to.add((node, e + 1))                         # an extra letter
        self.steps[state][c] = new = self._state(self._closed(to))
        return new

    def match(self, word: str) -> tuple[float, int] | None:
        state, found = self.start, None
        for c in word:
            nxt = self.steps[state].get(c)
            state = self._step(state, c) if nxt is None else nxt
            p = self.passing[state]
            if p is not None and (found is None or (p[1], -p[0]) < (found[1], -found[0])):
                found = p
            if not self.sets[state]:
                return found
        p = self.final[state]
        return p if p is not None and (found is None or (p[1], -p[0]) < (found[1], -found[0])) else found


def _blocks(batches):
    for batch in batches:
        offsets, data = K.string_buffers(batch.column("text"))
        for a, b in K.row_blocks(offsets):
            yield batch.slice(a, b - a), offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]]


def word_terms(word: str) -> list[tuple[str, bool]]:
    """The terms that a text gets from a word: itself and its stems."""
    return ([(word, False)] if len(word) >= SHORTEST else []) + [(word[:k], True) for k in STEMS if len(word) > k]


def _toxic_terms(toxic: DataFrame, least: float) -> DataFrame:
    """(term, stem, toxic): toxic texts that hold each term, if at least ``least`` do."""
    def run(batches):
        counts: Counter = Counter()

        def emit():
            items = list(counts.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for (t, _), _ in items], pa.string()), pa.array([s for (_, s), _ in items], pa.bool_()),
                 pa.array([n for _, n in items], pa.int64())], names=["term", "stem", "toxic"])
            counts.clear()

        for rows, offsets, data in _blocks(batches):
            starts, ends, at = K.word_spans(offsets, _letters(data), IS_WORD)
            cuts = np.searchsorted(at, np.arange(rows.num_rows + 1))
            raw = data.tobytes()
            for r in range(rows.num_rows):
                words = {raw[x:y] for x, y in zip(starts[cuts[r]:cuts[r + 1]], ends[cuts[r]:cuts[r + 1]], strict=True)}
                counts.update({t for w in words for t in word_terms(w.decode(errors="replace").lower())})
            if len(counts) > CACHE:
                yield from emit()
        yield from emit()

    counted = texts(toxic).mapInArrow(run, "term string, stem boolean, toxic bigint")
    return counted.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= least)


def _clean_counts(clean: DataFrame, terms: list[tuple[str, bool]]) -> np.ndarray:
    """Clean texts that hold each of ``terms``."""
    sent = clean.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def run(batches):
        number, known, total = sent.value, {}, np.zeros(len(sent.value), np.int64)
        for rows, offsets, data in _blocks(batches):
            starts, ends, at_row = K.word_spans(offsets, _letters(data), IS_WORD)
            if not len(starts):
                continue
            raw = data.tobytes()
            hashes, first, at = np.unique(K.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            ids = []
            for h, i in zip(hashes.tolist(), first.tolist(), strict=True):
                if h not in known:
                    own = word_terms(raw[starts[i]:ends[i]].decode(errors="replace").lower())
                    known[h] = [number[t] for t in own if t in number]
                ids.append(known[h])
            sizes = np.array([len(x) for x in ids])
            flat, begin = np.array([i for x in ids for i in x], dtype=np.int64), np.cumsum(sizes) - sizes
            pairs = np.unique(at_row * len(hashes) + at)
            row, word = pairs // len(hashes), pairs % len(hashes)
            n = sizes[word]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            held = np.unique(np.repeat(row, n) * len(number) + flat[np.repeat(begin[word], n) + within])
            total += np.bincount(held % len(number), minlength=len(number))
            if len(known) > CACHE:
                known.clear()
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["i", "n"])

    out = np.zeros(len(terms))
    for r in texts(clean).mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r["i"]] = r["n"]
    return out


def learn_lexicon(labelled: DataFrame) -> dict[tuple[str, bool], float]:
    """Terms with their log odds ratio, all that reach ``MIN_ODDS``.

    A term needs ``MIN_TOXIC`` toxic texts and ``MIN_SHARE`` of them, so that what
    copies of one text share is no term. A stem gives way to a longer term that
    has nearly its support.
    """
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return {}
    least = max(MIN_TOXIC, MIN_SHARE * n1)
    found = _toxic_terms(labelled.where("toxic = 1"), least).collect()     # terms of about TRAIN_ROWS texts at most
    terms = [(r["term"], r["stem"]) for r in found]
    toxic = np.array([r["toxic"] for r in found], dtype=float)
    clean = _clean_counts(labelled.where("toxic = 0"), terms) if terms else toxic
    odds = np.log((toxic + 0.5) / (n1 - toxic + 0.5)) - np.log((clean + 0.5) / (n0 - clean + 0.5))
    strong = {t: (o, c) for t, o, c in zip(terms, odds.tolist(), toxic.tolist(), strict=True) if o >= MIN_ODDS}
    longest: dict[str, float] = {}           # best support among the longer terms that begin so
    for (term, stem), (_, c) in strong.items():
        for k in STEMS:
            if k < len(term) or k == len(term) and not stem:
                longest[term[:k]] = max(longest.get(term[:k], 0.0), c)
    kept = {t: o for t, (o, c) in strong.items() if not t[1] or longest.get(t[0], 0.0) < SPECIFIC * c}
    return dict(sorted(kept.items(), key=lambda x: (-x[1], x[0])))


def features(hits: list[tuple[int, float, int, bool]], n_words: int) -> list[float]:
    """Scores of a text from its hits (word index, weight, edits, quoted), in order.

    Sums of weights by exact or misspelled and open or quoted; the best window,
    where an open hit counts with all others within ``WINDOW`` words; hits a
    hundred words; whether any hit is open.
    """
    sums = [[0.0, 0.0], [0.0, 0.0]]
    best, lo, hi, open_ = 0.0, 0, 0, 0
    for i, w, e, q in hits:
        sums[e > 0][q] += w / (1 + e)
        while hits[lo][0] < i - WINDOW:
            lo += 1
        while hi < len(hits) and hits[hi][0] <= i + WINDOW:
            hi += 1
        if not q:
            open_ = 1
            best = max(best, w / (1 + e) * (1 + 0.5 * (hi - lo - 1)))
    return [*(math.log1p(x) for x in (sums[0][0], sums[0][1], sums[1][0], sums[1][1])), math.log1p(best),
            math.log1p(100 * len(hits) / max(n_words, 1)), float(open_)]


def _quoted(raw: bytes, before: int, start: int, end: int, after: int) -> bool:
    """Whether quotation marks enclose a hit within its window, or a word of reporting precedes it."""
    left, right = raw[before:start].decode(errors="ignore"), raw[end:after].decode(errors="ignore")
    return bool((_QUOTES.search(left) and _QUOTES.search(right)) or _REPORT.search(left))


def text_features(lexicon: Lexicon, cache: dict, offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """(rows, N_FEATURES) of a block."""
    n = len(offsets) - 1
    starts, ends, rows = K.word_spans(offsets, _letters(data), IS_WORD)
    cuts = np.searchsorted(rows, np.arange(n + 1))
    out = np.zeros((n, N_FEATURES))
    if not len(starts):
        return out
    raw = data.tobytes()
    hashes, first, at = np.unique(K.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    hit = np.zeros(len(hashes), dtype=bool)
    found = {}
    for u, (h, i) in enumerate(zip(hashes.tolist(), first.tolist(), strict=True)):
        m = cache.get(h, 0)
        if m == 0:
            m = cache[h] = lexicon.match(raw[starts[i]:ends[i]].decode(errors="replace").lower())
        if m is not None:
            hit[u], found[u] = True, m
    hits: dict[int, list] = {}
    for i in np.flatnonzero(hit[at]).tolist():
        r = int(rows[i])
        lo, hi = max(i - WINDOW, cuts[r]), min(i + WINDOW, cuts[r + 1] - 1)
        weight, edits = found[int(at[i])]
        # one byte beyond the outer words, where a quotation mark may stand
        quoted = _quoted(raw, max(starts[lo] - 3, offsets[r]), starts[i], ends[i], min(ends[hi] + 3, offsets[r + 1]))
        hits.setdefault(r, []).append((i - int(cuts[r]), weight, edits, quoted))
    for r, own in hits.items():
        out[r] = features(own, int(cuts[r + 1] - cuts[r]))
    if len(cache) > CACHE:
        cache.clear()
    if len(lexicon.sets) > STATES:
        lexicon.reset()
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(h, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _with_features(docs: DataFrame, carry: list[str], terms: dict) -> DataFrame:
    src = texts(docs, *carry)
    fields = ", ".join(f"{c} {dict(src.dtypes)[c]}" for c in carry)

    def run(batches):
        lexicon, cache = Lexicon(terms), {}
        for rows, offsets, data in _blocks(batches):
            x = text_features(lexicon, cache, offsets, data)
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in carry], flat], names=[*carry, "features"])

    return src.mapInArrow(run, f"{fields}, features array<double>")


def score(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """Per row of ``docs``: ``doc_id, score, predicted, features``.

    Lexicon and model learn from about ``TRAIN_ROWS`` ids for which ``training``
    (a condition on doc_id) holds and ``labels`` (doc_id, toxic) has 0 or 1; an id
    with several labels counts as toxic if any is 1, one with several texts
    gives its smallest. Scores use the text alone: a
    null or empty text has no hits. With labels of one class or none, the score
    is that class (0 without labels). ``predicted`` is 1 from a score of 0.5.
    Rows stay one to one; repeated rows agree.
    """
    marks = (labels.where("toxic IN (0, 1)").where(training).groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    step = max(1, math.ceil(marks.count() / TRAIN_ROWS))
    ids = written(marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0), "tox-ids")
    sample = written(join_small(docs.select("doc_id", "text"), ids, "doc_id", max_rows=2 * TRAIN_ROWS)
                     .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
                     .select("text", "toxic"), "tox-sample")
    terms = learn_lexicon(sample)
    if terms:
        seen: pd.DataFrame = _with_features(sample, ["toxic"], terms).toPandas()   # about TRAIN_ROWS short rows
        w = fit_logistic(np.stack(seen["features"]), seen["toxic"].to_numpy(float))
        logit = F.lit(float(w[0]))
        for i, c in enumerate(w[1:]):
            logit = logit + F.col("features")[i] * float(c)
        p = 1 / (1 + F.exp(-logit))
    else:
        only = sample.agg(F.min("toxic").alias("t")).first()["t"]
        p = F.lit(float(only or 0))
    return (_with_features(docs.select("doc_id", "text"), ["doc_id"], terms).withColumn("score", p)
            .select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "features"))
