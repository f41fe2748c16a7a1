"""Runs of periodic words: suffix automaton with link-cut access to its last occurrences.

A run is a stretch of words with smallest period ``q`` and at least ``max(MIN_RUN,
2q)`` words that no neighbouring word extends. The words of a *zone* go through a
suffix automaton. Its link tree is cut into paths of one colour, the end of the
last occurrence of their strings. Appending word ``i`` recolours the path from its
state to the root (the access of a link-cut tree): a piece of a path last seen at
``e`` whose longest string has ``m >= i - e`` words shows the square of period
``i - e`` that ends at ``i``. A run's period is primitive, so its first square is
met this way, and it is extended once to both sides.

Zones are exact: a run repeats at least ``MIN_RUN // 2`` words at the distance of
its period and the copies cover it, so a run lies within a stretch of words covered
by word groups of that length which occur twice in the stretch. Texts without such
a group have no run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts
from .kernels import IS_SPACE, mix64, row_blocks, span_hashes, string_buffers, word_spans

MIN_RUN = 12
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(suffix link, longest string, state of every prefix) of the suffix automaton of ``words``."""
    step: list[dict[int, int]] = [{}]
    link, longest, prefix, last = [-1], [0], [], 0
    for w in words:
        state, p = len(step), last
        step.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        while p >= 0 and w not in step[p]:
            step[p][w] = state
            p = link[p]
        if p >= 0:
            q = step[p][w]
            if longest[q] == longest[p] + 1:
                link[state] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                link[q] = link[state] = clone
                while p >= 0 and step[p].get(w) == q:
                    step[p][w] = clone
                    p = link[p]
        last = state
        prefix.append(state)
    return link, longest, prefix


class LastSeen:
    """Link-cut paths over a tree of parents; every path has one colour, held at its splay root."""

    def __init__(self, parent: list[int]):
        self.up, n = list(parent), len(parent)
        self.left, self.right, self.colour = [-1] * n, [-1] * n, [0] * n

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        top = x
        while True:
            y = up[top]
            if y < 0 or (left[y] != top and right[y] != top):
                break
            top = y
        if top == x:
            return
        self.colour[x] = self.colour[top]
        while True:
            y = up[x]
            if y < 0 or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z >= 0 and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            child = left[y] = right[x]
            right[x] = y
        else:
            child = right[y] = left[x]
            left[x] = y
        if child >= 0:
            up[child] = y
        up[x], up[y] = z, x
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Give the path from ``node`` to the root one colour; (deepest node, old colour) of its pieces."""
        pieces, below, x = [], -1, node
        while x >= 0:
            self._splay(x)
            old = self.colour[x]
            pieces.append((x, old))
            if self.right[x] >= 0:
                self.colour[self.right[x]] = old
            self.right[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return pieces


def runs(words: list[int], min_run: int = MIN_RUN) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a word sequence, by start and period."""
    link, longest, prefix = automaton(words)
    seen, reach, found, n = LastSeen(link), {}, [], len(words)
    for i, state in enumerate(prefix):
        for node, end in seen.access(state, i + 1):
            period = i + 1 - end
            if not end or period > longest[node] or reach.get(period, -1) >= i:
                continue
            start, last = i + 1 - period - longest[node], i
            while start > 0 and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while last + 1 < n and words[last + 1] == words[last + 1 - period]:
                last += 1
            reach[period] = last
            if last + 1 - start >= max(min_run, 2 * period):
                found.append((start, last + 1 - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def zones(hashes: np.ndarray, rows: np.ndarray, min_run: int = MIN_RUN) -> list[tuple[int, int]]:
    """[a, b) ranges of a block's words outside which no run of a row lies.

    A range is cut again by the word groups that occur twice within it until nothing goes.
    """
    k = max(1, min_run // 2)
    at, part = np.arange(len(hashes)), rows.astype(np.int64)
    while len(at) >= min_run:
        whole = part[:len(at) - k + 1] == part[k - 1:]
        mixed = mix64(part[:len(at) - k + 1].astype(np.uint64))
        for j in range(k):
            mixed = mix64(mixed + hashes[at[j:len(at) - k + 1 + j]])
        first = np.flatnonzero(whole)
        order = first[np.argsort(mixed[first], kind="stable")]
        same = mixed[order[1:]] == mixed[order[:-1]]
        twice = np.zeros(len(at) + 1, np.int64)
        hit = np.zeros(len(at), bool)
        hit[order[1:][same]] = True
        hit[order[:-1][same]] = True
        twice[:-1] += hit
        twice[k:] -= hit[:len(at) + 1 - k]
        covered = np.cumsum(twice[:-1]) > 0
        kept = at[covered]
        cut = np.ones(len(kept), bool)
        cut[1:] = (np.diff(kept) != 1) | (np.diff(part[covered]) != 0)
        piece = np.cumsum(cut) - 1
        long = np.bincount(piece, minlength=1)[piece] >= min_run if len(piece) else cut
        kept, piece = kept[long], piece[long]
        if len(kept) == len(at):
            break
        at, part = kept, piece
    if len(at) < min_run:
        return []
    edge = np.flatnonzero(np.diff(part)) + 1
    return list(zip(at[np.concatenate(([0], edge))].tolist(), (at[np.concatenate((edge - 1, [len(at) - 1]))] + 1).tolist()))


def _collapse(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, drop: np.ndarray) -> bytes:
    """The kept words of one text joined by one space."""
    if not len(starts):
        return b""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts[~drop]] += 1
    inside[ends[~drop]] -= 1
    keep = np.cumsum(inside[:-1]) > 0
    out = data.copy()
    gap = ends[~drop][:-1]                     # the byte after a word that another kept one follows
    out[gap] = 0x20
    keep[gap] = True
    return out[keep].tobytes()


def _block(offsets: np.ndarray, data: np.ndarray, min_run: int) -> Iterator[tuple[list, bytes]]:
    starts, ends, rows = word_spans(offsets, data, ~IS_SPACE)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    hashes = span_hashes(data, starts, ends)          # words equal but for case share a hash: more zones, no run lost
    drop = np.zeros(len(starts), bool)
    found: dict[int, list] = {}
    raw = data.tobytes()
    for a, b in zones(hashes, rows, min_run):
        ids: dict[bytes, int] = {}
        words = [ids.setdefault(raw[s:e], len(ids)) for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
        row = int(rows[a])
        for start, length, period in runs(words, min_run):
            drop[a + start + period:a + start + length] = True
            found.setdefault(row, []).append((a + start - int(first[row]), length, period))
    for row in range(len(offsets) - 1):
        x, y, o = first[row], first[row + 1], offsets[row]
        rest = _collapse(data[o:offsets[row + 1]], starts[x:y] - o, ends[x:y] - o, drop[x:y])
        yield sorted(found.get(row, []), key=lambda r: (r[0], r[2])), rest


def repetitions(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``runs`` (start, length, period) and ``collapsed``.

    Words are runs without ASCII white space, compared byte by byte and numbered from
    0; ``runs`` are ordered by start, then period. ``collapsed`` is the text's words
    joined by one space without those that any run holds after its first period. A
    null or empty text has no words, no runs and an empty ``collapsed``; repeated rows
    and ids (null as well) give a row each; other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1)
            offsets, data = string_buffers(text)
            for a, b in row_blocks(offsets):
                part = offsets[a:b + 1] - offsets[a]
                got = list(_block(part, data[offsets[a]:offsets[b]], min_run))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in got],
                             pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    pa.array([t.decode() for _, t in got], pa.string())], ["doc_id", "runs", "collapsed"])

    return texts(docs, "doc_id").mapInArrow(scan, f"doc_id {kind.simpleString()}, runs {RUNS}, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with periodic words planted in every tenth text, by the checksum of its id.

    With ``h`` the CRC-32 of the decimal id and ``g = h div 10``, word ``i >= a`` of a
    text of ``n`` words becomes word ``a + (i - a) % p`` where ``a = g % n`` and ``p =
    1 + (n - a) div (3 + g % 8)``, if ``h % 10 = 0`` and ``n > 0``. Its words are then
    joined by one space. A null id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.withColumn("_g", F.when(h % 10 == 0, F.expr("crc32(cast(doc_id as string)) div 10")))
    words = F.when(F.col("_g").isNotNull(), F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})")))
    rows = chosen.withColumn("_w", words).withColumn("_n", F.size("_w"))
    text = F.expr("""array_join(transform(_w, (w, i) -> CASE WHEN i < _g % _n THEN w ELSE
        _w[cast(_g % _n + (i - _g % _n) % (1 + (_n - _g % _n) div (3 + _g % 8)) as int)] END), ' ')""")
    return rows.select("doc_id", F.when(F.col("_n") > 0, text).otherwise(F.col("text")).alias("text"))
