"""Licence scans: a generalised suffix automaton of licence tokens.

The automaton holds every token run of all templates. A file's words stream
through it and give matching statistics: the longest run ending at each word
that occurs in some template; its suffix links lead to the templates that match
fewer words there. A template's matches that do not grow on within that template
are chained, in order in both the file and the template, into its covered span.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .common import texts

# Base phrases with their labels, and short notices of public licences.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied.",
    "bsd-2-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                    "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                    "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
                    "binary form must reproduce the above copyright notice, this list of conditions and the following "
                    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
               "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
               "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
               "PURPOSE.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so.",
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

MIN_MATCH = 4        # tokens of a match that may join a chain
MAX_GAP = 12         # words a chain may skip in the file
COVERED = 0.6        # share of a template that makes its span a finding

# Word characters after lower-casing A-Z: digits, letters and everything beyond ASCII.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = True
IS_WORD[0x80:] = True


def tokens(text: str) -> list[str]:
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends, _ = K.word_spans(np.array([0, len(data)]), data, IS_WORD)
    return [raw[a:b].lower().decode() for a, b in zip(starts, ends, strict=True)]


class SuffixAutomaton:
    """Suffix automaton of several token sequences, with where each state's runs end."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for doc, seq in enumerate(sequences):
            last = 0
            for pos, token in enumerate(seq):
                last = self._extend(last, token)
                self.ends[last].add((doc, pos))
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]] |= self.ends[state]
        self.rests: dict[int, list[tuple[int, int, int]]] = {}

    def shorter(self, state: int, least: int) -> list[tuple[int, int, int]]:
        """(doc, pos, length) of the places where only a shorter suffix of the state's runs ends, ``least`` tokens or more."""
        if state not in self.rests:
            out, seen, s = [], self.ends[state], self.link[state]
            while s > 0 and self.length[s] >= least:
                out += [(doc, pos, self.length[s]) for doc, pos in self.ends[s] - seen]
                seen, s = self.ends[s], self.link[s]
            self.rests[state] = out
        return self.rests[state]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        self.ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, token: int) -> int:
        """The state of p's longest run extended by ``token``, cloned off if it is shared."""
        q = self.next[p][token]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, token)
        return new

    def statistics(self, ids: list[int]) -> list[tuple[int, int]]:
        """(state, length) of the longest known run that ends at each token."""
        out, state, length = [], 0, 0
        for token in ids:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            else:
                state = length = 0
            out.append((state, length))
        return out


class Scanner:
    """Templates and phrases compiled for a task."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.names = list(templates)
        parts = [tokens(t) for t in templates.values()]
        words = sorted({w for p in parts for w in p} | {w for p in phrases for w in p.split()})
        number = {w: i for i, w in enumerate(words)}
        hashes = np.array([K.hash_word(w) for w in words], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int32)
        self.sizes = [len(p) for p in parts]
        self.sequences = [[number[w] for w in p] for p in parts]
        self.automaton = SuffixAutomaton(self.sequences)
        self.phrases = [([number[w] for w in p.split()], label) for p, label in phrases.items()]

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of known words, -1 for all others."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], -1)

    def phrase_starts(self, ids: np.ndarray, rows: np.ndarray) -> list[tuple[np.ndarray, str]]:
        """Word indices of a block at which each phrase stands within one row."""
        out = []
        for seq, label in self.phrases:
            k = len(seq)
            hit = np.ones(max(len(ids) - k + 1, 0), dtype=bool)
            for j, w in enumerate(seq):
                hit &= ids[j:len(ids) - k + 1 + j] == w
            at = np.flatnonzero(hit)
            out.append((at[rows[at] == rows[at + k - 1]], label))
        return out

    def findings(self, ids: list[int]) -> list[tuple[str, int, int, float]]:
        """(template, first word, end word, share covered) of every chain that covers ``COVERED`` of its template."""
        matches: dict[int, list[tuple[int, int, int]]] = {}
        stats = self.automaton.statistics(ids)
        for i, (state, length) in enumerate(stats):
            if length < MIN_MATCH:
                continue
            after = ids[i + 1] if i + 1 < len(ids) else None
            places = [(doc, pos, length) for doc, pos in self.automaton.ends[state]]
            for doc, pos, size in places + self.automaton.shorter(state, MIN_MATCH):
                own = self.sequences[doc]
                if after is None or pos + 1 == len(own) or own[pos + 1] != after:
                    matches.setdefault(doc, []).append((i + 1, pos + 1, size))
        out = []
        for doc, found in matches.items():
            out += [(self.names[doc], first, end, covered / self.sizes[doc])
                    for covered, first, end in chains(found, COVERED * self.sizes[doc])]
        return sorted(out)


def chains(matches: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int]]:
    """(tokens covered, first word, end word) of disjoint chains of ``least`` tokens and more.

    The best chain is taken, then the best of what lies before it and after it in
    the file, and so on; a match across a chain's border counts with its outer part.
    """
    out, todo = [], [matches]
    while todo:
        own = todo.pop()
        if not own:
            continue
        covered, first, end = chain(own)
        if covered < least:
            continue
        out.append((covered, first, end))
        todo.append([(min(e, first), t - max(e - first, 0), n - max(e - first, 0)) for e, t, n in own
                     if min(e, first) - (e - n) >= MIN_MATCH])
        todo.append([(e, t, min(n, e - end)) for e, t, n in own if min(n, e - end) >= MIN_MATCH])
    return out


def chain(matches: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """(tokens covered, first word, end word) of the best chain of (file end, template end, length).

    A match follows another if it ends later in both and starts at most
    ``MAX_GAP`` words after it in the file; overlapping tokens count once. Of
    equally good chains it is the middle one, so that ``chains`` halves a file of copies.
    """
    matches = sorted(set(matches))
    ends = [m[0] for m in matches]
    best: list[tuple[int, int]] = []
    for i, (end, t_end, length) in enumerate(matches):
        value, first = length, end - length
        low = bisect_left(ends, end - length - MAX_GAP)
        for j in range(low, i):
            p_end, p_t, _ = matches[j]
            if p_end < end and p_t < t_end:
                gain = min(length, end - p_end, t_end - p_t)
                if best[j][0] + gain > value:
                    value, first = best[j][0] + gain, min(best[j][1], end - length)
        best.append((value, first))
    most = max(b[0] for b in best)
    top = [i for i, b in enumerate(best) if b[0] == most]
    at = top[len(top) // 2]
    return most, best[at][1], matches[at][0]


def _runs(known: np.ndarray) -> bool:
    """Whether ``MIN_MATCH`` known words stand in a row."""
    if len(known) < MIN_MATCH:
        return False
    sums = np.concatenate(([0], np.cumsum(known)))
    return bool((sums[MIN_MATCH:] - sums[:-MIN_MATCH] == MIN_MATCH).any())


def scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, findings``.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters
    beyond ASCII. Base places are those where a phrase's words stand
    consecutively; ``first_word``/``last_word`` are their least and greatest start
    (null without any). ``findings`` are (label, start, end, share) of every chain
    that covers ``COVERED`` of its template, so a notice that stands twice counts twice. ``labels`` adds their names to
    the base labels; both are distinct, sorted and comma-joined ('' for none).
    ``score`` is the largest share covered, at least 0.5 with a base phrase. A
    null or empty text has no words. Rows stay one to one; other columns are not
    read.
    """
    from pyspark.sql.types import (ArrayType, DoubleType, LongType, StringType, StructField, StructType)

    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    src = texts(docs.select("doc_id", "text"), "doc_id")
    span = StructType([StructField("label", StringType()), StructField("start", LongType()),
                       StructField("end", LongType()), StructField("share", DoubleType())])
    schema = StructType([src.schema["doc_id"]] + [StructField(n, LongType()) for n in ("n_words", "n_base", "first_word", "last_word")]
                        + [StructField("base_labels", StringType()), StructField("labels", StringType()),
                           StructField("score", DoubleType()), StructField("findings", ArrayType(span))])
    arrow_span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]))

    def run(batches):
        scanner = Scanner(templates, phrases)
        for batch in batches:
            offsets, data = K.string_buffers(batch.column("text"))
            for a, b in K.row_blocks(offsets):
                yield block(scanner, batch.column("doc_id").slice(a, b - a), offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]])

    def block(scanner, doc_ids, offsets, data):
        n = len(doc_ids)
        starts, ends, rows = K.word_spans(offsets, data, IS_WORD)
        ids = scanner.word_ids(K.span_hashes(data, starts, ends)) if len(starts) else np.zeros(0, np.int32)
        cuts = np.searchsorted(rows, np.arange(n + 1))
        base: dict[int, list[tuple[int, str]]] = {}
        for at, label in scanner.phrase_starts(ids, rows):
            for i in at:
                base.setdefault(int(rows[i]), []).append((int(i - cuts[rows[i]]), label))
        known = np.bincount(rows[ids >= 0], minlength=n)
        out = {c: [] for c in ("n_base", "first", "last", "base", "labels", "score", "findings")}
        for r in range(n):
            own, hits = ids[cuts[r]:cuts[r + 1]], base.get(r, ())
            found = scanner.findings(own.tolist()) if known[r] >= MIN_MATCH and _runs(own >= 0) else []
            names = {label for _, label in hits}
            out["n_base"].append(len(hits))
            out["first"].append(min((i for i, _ in hits), default=None))
            out["last"].append(max((i for i, _ in hits), default=None))
            out["base"].append(",".join(sorted(names)))
            out["labels"].append(",".join(sorted(names | {f[0] for f in found})))
            out["score"].append(max([min(f[3], 1.0) for f in found] + [0.5 if hits else 0.0]))
            out["findings"].append([dict(zip(("label", "start", "end", "share"), f, strict=True)) for f in found])
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(np.diff(cuts), pa.int64()), pa.array(out["n_base"], pa.int64()), pa.array(out["first"], pa.int64()),
             pa.array(out["last"], pa.int64()), pa.array(out["base"], pa.string()), pa.array(out["labels"], pa.string()),
             pa.array(out["score"], pa.float64()), pa.array(out["findings"], arrow_span)],
            names=schema.names)

    return src.mapInArrow(run, schema)
