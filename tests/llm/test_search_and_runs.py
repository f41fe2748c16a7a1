"""Reversed search and periodic runs against brute force, on edge rows and empty tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import kernels, periodic, queries, reverse_search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = [
    (1, "the cat sat on the mat", "a"), (2, "The Cat; sat!", "b"), (2, "The Cat; sat!", "b"), (3, None, "c"), (4, "", "d"),
    (5, " \t\n .,;", "e"), (6, "dog " * 30_000 + "cat", "f"), (None, "the cat sat on the mat", "g"), (7, "naïve Œuvre 42 cat2", "h"),
    (8, "a b c a b c a b c a b c a b c", "i"), (9, "x " * 11, "j"), (10, "x " * 12, "k"), (11, ("p q " * 3 + "r ") * 40, "l"),
    (12, "a b c d e f A B C D E F", "m"), (13, "une œuvre ç une œuvre ç " * 9, "n"),
]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id bigint, text string, source string")
    for c in ("n", "terms", "tf", "item", "score", "rank", "runs", "collapsed", "start", "merger", "_g", "_w", "_n"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(4).cache()


# 12 -----------------------------------------------------------------------------------------

def ranked(rows, items, top=10):
    n, counts = [], []
    for _, text in rows:
        terms = TERM.findall(lower(text))
        n.append(len(terms))
        counts.append(Counter(terms))
    docs, total = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERM.findall(lower(text)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for (doc, _), size, c in zip(rows, n, counts):
            s = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 8 * (10 + 90 * size * docs // total))) for t in terms if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc, s))
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:top])]
    return sorted(out, key=repr)


def test_search_edges(spark, docs):
    items = [(1, "The CAT sat"), (2, None), (3, ""), (4, "unseen words only"), (5, "dog cat 42 œuvre"), (5, "mat"), (None, "naïve mat"), (6, "Cat cat cat")]
    frame = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("clash"))
    for size, top in ((1 << 22, 10), (20, 2)):
        got = reverse_search.search(docs, frame, top=top, item_bytes=size)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=repr) == ranked([d[:2] for d in DOCS], items, top)
    assert reverse_search.search(docs.limit(0), frame).count() == 0
    assert reverse_search.search(docs, frame.limit(0)).count() == 0
    assert reverse_search.search(docs, frame.where("item_id = 2")).count() == 0


def test_search_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = sorted(map(tuple, queries.op12_search(spark, SF).collect()), key=repr)
    assert got == ranked(rows, items) and len(got) >= len(items)


def test_bounded_heaps():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 9, (500, 7)), [None, *rng.permutation(499).tolist()]
    heaps = reverse_search.Heaps(7, 5)
    for a in range(0, 500, 33):
        heaps.update(scores[a:a + 33], ids[a:a + 33])
    for i in range(7):
        want = sorted(((-s, d is None, d or 0) for s, d in zip(scores[:, i].tolist(), ids) if s))[:5]
        assert sorted((-s, d.id is None, d.id or 0) for s, d in heaps.heaps[i]) == want


# 13 -----------------------------------------------------------------------------------------

def brute_runs(w, least=12):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if size >= max(least, 2 * q) and not any(all(w[x] == w[x + d] for x in range(s, s + size - d)) for d in range(1, q)):
                out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sample(rng):
    n, k = rng.randint(0, 90), rng.choice([1, 2, 3, 8, 26])
    w = [rng.choice("abcdefghijklmnopqrstuvwxyz"[:k]) for _ in range(n)]
    if n > 5 and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_runs_of_sequences():
    rng = random.Random(5)
    for _ in range(800):
        w = sample(rng)
        ids = {x: i for i, x in enumerate(dict.fromkeys(w))}
        for least in (2, 5, 12):
            assert periodic.runs([ids[x] for x in w], least) == brute_runs(w, least)


def test_fibonacci_words_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    assert periodic.runs(b, 2) == brute_runs(b, 2)
    assert periodic.runs([7] * 3000) == [(0, 3000, 1)]
    assert periodic.runs(list(range(1500)) * 2 + [0, 1]) == [(0, 3002, 1500)]
    assert periodic.runs([]) == [] and periodic.runs([1]) == []


def test_zones_lose_no_run():
    rng = random.Random(11)
    for _ in range(150):
        rows = [sample(rng) + sample(rng) for _ in range(rng.randint(1, 5))]
        texts = [rng.choice(["", "\t"]) + rng.choice([" ", " \n"]).join(w) + rng.choice(["", " "]) for w in rows]
        offsets, data = kernels.string_buffers(pa.array(texts))
        for w, (found, rest) in zip(rows, periodic._block(offsets, data, 12)):
            assert found == brute_runs(w) and rest.decode() == collapsed(w, found)


def test_repetitions_edges(docs):
    got = periodic.repetitions(docs)
    assert got.columns == ["doc_id", "runs", "collapsed"]
    want = []
    for d, text, _ in DOCS:
        w = WORDS.findall(text or "")
        if d == 6:
            want.append((d, [(0, 30_000, 1)], "dog cat"))
        else:
            want.append((d, brute_runs(w), collapsed(w, brute_runs(w))))
    assert sorted(((r[0], [tuple(x) for x in r[1]], r[2]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert periodic.repetitions(docs.limit(0)).count() == 0


def test_planted(spark, docs):
    blank = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows = [(i, " ".join(f"w{j}" for j in range(i % 97)), "a") for i in range(300)]
    rows += [(None, "a b", "x"), (blank[0], None, "y"), (blank[1], " ", "z")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, _w string")
    source = {r[0]: r[1] for r in rows}
    for d, text in periodic.planted(frame).collect():
        w, h = WORDS.findall(source[d] or ""), zlib.crc32(str(d).encode())
        n, g = len(w), h // 10
        if d is None or h % 10 or not n:
            assert text == source[d]
            continue
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert text.split(" ") == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    assert periodic.planted(docs).count() == len(DOCS)


def test_runs_query(spark):
    import hashlib

    got = {r["doc_id"]: r for r in queries.op13_runs(spark, SF).collect()}
    some = 0
    for d, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        w, h = WORDS.findall(text or ""), zlib.crc32(str(d).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found, r = brute_runs(w), got[d]
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else None
        assert r["n_runs"] == len(found)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{x},{q}\n" for s, x, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, found).encode()).hexdigest()
        some += len(found)
    assert some > 10 and len(got) == 200
