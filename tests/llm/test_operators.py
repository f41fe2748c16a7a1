"""The dealt operators on edge rows, an empty table and brute-force versions."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import bpe, exact_dedup, hnsw, kernels, language_id, licenses, mixing, near_dedup, pii, queries, sharding, toxicity

SF = "/root/testdata/sf0.001"
BASE = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ["h", "n", "kept", "size", "score", "label", "vid", "key", "shard", "bytes", "sig", "uid", "target", "_row"]
PROSE = "the quick brown fox jumps over a lazy dog and then sleeps under the old tree all day long"
ROWS = [
    (1, PROSE, "en", "a", 5), (2, PROSE.upper(), "en", "b", None), (2, PROSE.upper(), "en", "b", None),
    (3, PROSE + " again", "en", None, 1), (4, None, None, "a", 0), (5, "", "fr", "a", 0), (6, " \t\n", "fr", "\U0001F600", 0),
    (None, PROSE, "en", "a", 1), (None, None, None, None, None), (7, "zwei", "de", "é", 1), (8, "123 456 !!!", None, "é", 1),
    (9, "x" * 200_000, None, "a", 1), (10, ("wort und noch ein wort " * 9000), "de", "a", 1), (11, "naïve Œuvre İ ẞ", "fr", "b", 1),
]
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame(ROWS, BASE)
    for c in CLASH:
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3).cache()


@pytest.fixture(scope="module")
def none(edge):
    return edge.limit(0)


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def key(row):
    return tuple((x is None, x) for x in row)


# 9 ------------------------------------------------------------------------------------------

def test_exact_duplicates(edge, none):
    groups = {}
    for d, t, *_ in ROWS:
        groups.setdefault(lower(t), []).append(d)
    want = []
    for d, t, *_ in ROWS:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = max(ids, default=None)
        want.append((d, keep, len(groups[lower(t)]), d == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    for digest in (exact_dedup.content_hash, lambda c: F.length(c) % 2):     # the second one collides all the time
        got = [tuple(r) for r in exact_dedup.exact_duplicates(edge, digest).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    assert exact_dedup.exact_duplicates(none).count() == 0
    kept = exact_dedup.drop_exact_duplicates(edge)
    assert kept.columns == edge.columns and kept.count() == len(groups)
    assert {r.doc_id for r in kept.collect() if r.text and r.text.startswith("THE")} == {2}


# 2 ------------------------------------------------------------------------------------------

def brute_components(rows, words, need):
    sets = []
    for _, t in rows:
        w = [x for x in SPACE.split(lower(t)) if x]
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and Fraction(len(sets[i] & sets[j]), len(sets[i] | sets[j])) >= need:
                parent[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None] if sets[i] else [d]
        least = min((x for x in ids if x is not None), default=None)
        out.append((d, len(sets[i]), least, d == least))
    return out


def test_near_duplicates_edges(edge, none):
    got = [tuple(r) for r in near_dedup.near_duplicates(edge, words=4).collect()]
    assert sorted(got, key=key) == sorted(brute_components([(r[0], r[1]) for r in ROWS], 4, Fraction(4, 5)), key=key)
    assert near_dedup.near_duplicates(none, words=4).count() == 0


def test_near_duplicates_chain_and_mixed_bucket(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(4000)]
    rows, base = [], list(rng.choice(vocab, 120))
    for i in range(60):                                  # a drifting chain: neighbours are similar, ends are not
        base = base.copy()
        base[int(rng.integers(120))] = str(rng.choice(vocab))
        rows.append((i, " ".join(base)))
    core = list(rng.choice(vocab, 100))
    for i in range(60, 120):                             # variants around a core, some too far from each other
        v = core.copy()
        for j in rng.integers(0, 100, size=int(rng.integers(1, 7))):
            v[int(j)] = str(rng.choice(vocab))
        rows.append((i, " ".join(v)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(tuple(r) for r in near_dedup.near_duplicates(df, words=4).collect())
    assert got == sorted(brute_components(rows, 4, Fraction(4, 5)))
    kept = near_dedup.drop_near_duplicates(df, words=4)
    assert sorted(r.doc_id for r in kept.collect()) == [g[0] for g in got if g[3]]


def test_bitmaps_never_lose_a_pair():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(5, 3000))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate((x[rng.random(len(x)) < 0.9], rng.integers(0, 2**63, int(n * 0.1)).astype(np.uint64))))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 80 * (len(x) + len(y) - both):
            bits = near_dedup.bitmaps([x, y])
            assert near_dedup.can_reach(bits[0], len(x), bits[1:], np.array([len(y)]), 80, 100).all()


def test_shingle_sets_equal_plain_ones():
    texts = [r[1] or "" for r in ROWS]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0] + [len(b) for b in raw])
    sets = kernels.distinct_sets(offsets, np.frombuffer(b"".join(raw), np.uint8), 4)
    for t, s in zip(texts, sets, strict=True):
        w = [x for x in SPACE.split(lower(t)) if x]
        want = {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()
        assert len(s) == len(want)


# 1 ------------------------------------------------------------------------------------------

def plain_targets(sizes, cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return {s: cap * sizes[s] if s in full else share[s] for s in names}
        full |= set(over)


@pytest.mark.parametrize("which", ["edge", "table"])
def test_mixing(spark, edge, which):
    df = edge if which == "edge" else docs_of(spark)
    rows = mixing.copies(df).collect()
    sizes = Counter()
    for r in df.select("source", "text").collect():
        sizes[r.source] += len([x for x in SPACE.split(r.text or "") if x])
    want, taken = plain_targets(sizes), Counter()
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert len(rows) == df.count()
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(r.size for r in rows if r.source == s)
    again = mixing.copies(df.repartition(5)).collect()
    assert sorted(map(key, again)) == sorted(map(key, rows))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in rows)


def test_mixing_empty_and_expectation(none):
    assert mixing.copies(none).count() == 0 and mixing.mix(none).count() == 0
    size = np.sort(np.random.default_rng(0).integers(1, 500, 300).astype(float))[::-1]
    mean = np.zeros(300)
    for seed in range(400):
        rng = np.random.default_rng(seed)
        m = mixing.pivot(0.37 * size, size, rng)
        assert np.isclose(m.sum(), 0.37 * size.sum()) and ((m > 0) & (m < size)).sum() <= 1
        m = mixing.pivot(m, size, rng, last=True)
        assert ((m == 0) | (m == size)).all()
        mean += m / size / 400
    assert abs(mean.mean() - 0.37) < 0.01 and np.abs(mean - 0.37).max() < 0.13


@pytest.mark.parametrize("large,p", [(1e6, 0.5), (1e6, 0.2), (3e4, 0.5)])
def test_mixing_small_documents_beside_a_dominating_one(large, p):
    """The words taken of the small ones vary no more than independent draws would."""
    small = np.sort(np.random.default_rng(1).integers(1, 100, 200).astype(float))[::-1]
    size, taken, of_large = np.concatenate(([large], small)), [], []
    for seed in range(1500):
        m = mixing.pivot(p * size, size, np.random.default_rng(seed), last=True)
        taken.append(m[1:].sum())
        of_large.append(m[0] / large)
    alone = p * (1 - p) * (small ** 2).sum()
    assert np.var(taken) <= 1.15 * alone                 # 1,500 draws tell a variance to about 4 %
    assert abs(np.mean(taken) - p * small.sum()) < 5 * np.sqrt(alone / 1500) and abs(np.mean(of_large) - p) < 0.06


def test_mixing_pairs_are_not_positively_bound():
    """No two equal documents are taken together more often than by independent draws."""
    size, both, one = np.array([900.0, 50, 50, 50, 50, 40, 40, 30]), np.zeros((8, 8)), np.zeros(8)
    for seed in range(4000):
        m = mixing.pivot(0.5 * size, size, np.random.default_rng(seed), last=True) > 0
        both += np.outer(m, m) / 4000
        one += m / 4000
    bound = both - np.outer(one, one)
    np.fill_diagonal(bound, 0)
    assert np.abs(one - 0.5).max() < 0.04 and bound.max() < 0.04


# 3 ------------------------------------------------------------------------------------------

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    d = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(d(m[0])) <= 19 and pii.luhn(d(m[0]))]
    return sorted(out + [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(d(m[0])) <= 15])


def test_base_spans_equal_plain_patterns(spark):
    rng = np.random.default_rng(2)
    hard = ["a@b.c@d.e", "@a.b@c.d x@y.z", "1.2.3.4.5.6.7.8", "300.1.2.3.4 001.002.3.4", "+1 (2) ..3", "4111 1111 1111 1111 4111-1111-1111-1111",
            "9" * 5000, "1." * 3000, "+" * 50 + "12 345 678 901", "a" * 5000 + "@x.y", "é@x.y ٣.1.2.3.4"]
    hard += ["".join(rng.choice(list("0123456789.+-() @ab"), 60)) for _ in range(3000)]
    hard += [r.text for r in docs_of(spark).collect()]
    for t in hard:
        assert pii.base_spans(t) == plain_spans(t), t[:200]


def test_pii_model(spark, edge, none):
    text = "mail bob.12@mail.example.com or 4080166431094600 99.114.106.61 host, call (608) 555-2280. on 2021-10-11 v1.2.3"
    df = spark.createDataFrame([(1, text), (2, "é" + text)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in pii.find(df).collect()}
    found = {(s.kind, text[s.start:s.end]) for s in rows[1].spans}
    assert {("email", "bob.12@mail.example.com"), ("ip", "99.114.106.61"), ("card", "4080166431094600")} <= found
    assert not any("2021" in s or s == "1.2.3" for _, s in found)
    assert [(s.start + 1, s.end + 1) for s in rows[1].base] == [(s.start, s.end) for s in rows[2].base]
    assert all(set(r.base) <= set(r.spans) for r in pii.find(docs_of(spark)).collect())
    assert pii.find(edge).count() == len(ROWS) and pii.find(none).count() == 0


def test_semi_markov_marginals_equal_enumeration():
    model = pii._generated_model(pii.GENERATED)
    text = "+1 (608) 555-2280 37.9.178.161"
    (a, b), = pii.regions(text)
    cuts, cands = pii.candidates(text, a, b)
    n = len(cuts) - 1
    scores, ending, starting = model.lattice(n, cands)
    p, _ = model.marginals(n, cands, scores, ending, starting)
    paths = [[]]

    def walk(at, path):
        if at == n:
            paths.append(path)
            return
        walk(at + 1, path)
        for c in starting[at]:
            walk(cands[c][1], [*path, c])
    paths.clear()
    walk(0, [])
    weight = np.array([np.exp(sum(scores[c] for c in path)) for path in paths])
    for c in range(len(cands)):
        assert p[c] == pytest.approx(sum(w for w, path in zip(weight, paths, strict=True) if c in path) / weight.sum(), abs=1e-9)
    best = max(range(len(paths)), key=lambda i: weight[i])
    assert model.best(n, cands, scores, ending) == paths[best]


# 4 ------------------------------------------------------------------------------------------

def test_language_id(spark, edge, none):
    rows = queries.op4_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 3
    got = {(r.doc_id, r.lang_pred) for r in language_id.identify(edge, ~language_id.fold(4, 2)).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (8, "und"), (None, "und")} <= got
    assert not {x for _, x in got} - {"und", "en", "fr", "de"}
    assert language_id.identify(none, F.lit(True)).count() == 0
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled, F.lit(True)).collect()} == {"und"}
    kept = language_id.keep_identified(edge)
    assert kept.columns == edge.columns and {4, 5, 6, 8}.isdisjoint(r.doc_id for r in kept.collect())


def plain_kneser_ney(rows):
    """Dictionary version: p(symbol | context) for interpolated Kneser-Ney over padded rows."""
    grams = {4: Counter()}
    for t in rows:
        c = " " + re.sub(" +", " ", re.sub("[^a-z]", " ", t + " "))
        for i in range(1, len(c)):
            grams[4][("   " + c)[i:i + 4]] += 1
    for k in (3, 2, 1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])

    def p(g):
        if not g:
            return 1 / 65536
        own = grams[len(g)]
        ones, twos = (sum(n == k for n in own.values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones else 0.5
        after = [n for x, n in own.items() if x[:-1] == g[:-1]]
        return (max(own[g] - d, 0) + d * len(after) * p(g[1:])) / sum(after) if after else p(g[1:])
    return p


def test_kneser_ney_equals_plain_version(spark):
    rows = ["abab abba aab.", "bab aba bb cab"]
    train = spark.createDataFrame([(t, "x") for t in rows], "text string, lang string")
    cells = language_id.model_cells(language_id.gram_counts(train)).toPandas()
    model, p = language_id.Model(["x"]), plain_kneser_ney(rows)
    for (kind, order), part in cells.groupby(["kind", "ord"]):
        model.add("x", kind, order, part)
    for context in ("ab ", "bab", "   ", "cca", "aba"):
        packed = np.array([sum(ord(c) << 16 * (3 - i) for i, c in enumerate(context + s)) for s in "abc "], dtype=np.uint64)
        got = np.exp(model.log_probs(packed)[0].astype(float))
        assert got == pytest.approx([p(context + s) for s in "abc "], rel=1e-4) and got.sum() <= 1 + 1e-6


def test_grams_never_share_a_count(spark):
    rng = np.random.default_rng(4)
    grams = np.unique(rng.integers(0x4E00, 0x4E40, (150_000, 4)) @ (1 << 16 * np.arange(3, -1, -1)))
    counts = spark.createDataFrame([("x", int(g), 1) for g in grams], "lang string, gram bigint, n bigint")
    cells = language_id.model_cells(counts).toPandas()
    sizes = cells.groupby(["kind", "ord"]).size()
    for k in (4, 3, 2):
        own = {int(g) % (1 << 16 * k) for g in grams}
        assert sizes[0, k] == len(own) and sizes[1, k] == len({g >> 16 for g in own})
    model = language_id.Model(["x"])
    for (kind, order), part in cells.groupby(["kind", "ord"]):
        model.add("x", kind, order, part)
    every = (grams[7] >> 16 << 16) + np.arange(0x4E00, 0x4E40)
    assert np.exp(model.log_probs(every.astype(np.uint64))[0].astype(float)).sum() <= 1 + 1e-4


def test_language_model_in_pieces(spark, monkeypatch):
    docs = docs_of(spark)
    whole = sorted(map(key, language_id.identify(docs, ~language_id.fold(4, 2)).collect()))
    monkeypatch.setattr(language_id, "PIECE", 400)
    monkeypatch.setattr(language_id, "RESIDENT", 1000)
    assert sorted(map(key, language_id.identify(docs, ~language_id.fold(4, 2)).collect())) == whole


def prose(rng, letters, words=40):
    return " ".join("".join(rng.choice(list(letters), int(n))) for n in rng.integers(2, 7, words))


def test_every_language_is_calibrated(spark, monkeypatch):
    rng, rows = np.random.default_rng(7), []
    for lang, letters, n in (("big", "abcdefgh", 400), ("rare", "klmnopqr", 6), ("one", "stuvwxyz", 1)):
        rows += [(prose(rng, letters), lang) for _ in range(n)]
    monkeypatch.setattr(language_id, "CALIBRATION_ROWS", 1, raising=False)       # as if the table were large
    model = language_id.train_model(spark.createDataFrame(rows, "text string, lang string").repartition(4))
    assert model.langs == ["big", "one", "rare"] and set(model.reject) == set(model.langs)
    assert model.reject["one"] == tuple(map(max, zip(model.reject["big"], model.reject["rare"], strict=True)))
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)] + [(-1, prose(rng, "klmnopqr"), None), (-2, "q" * 40 + " ξψω" * 40, None)],
                                 "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs, F.lit(True)).collect()}
    assert got[-1].lang_pred == "rare" and not got[-1].rejected and got[-2].rejected
    assert not any(got[i].rejected for i in range(len(rows)))


def test_language_whose_texts_all_fall_aside(spark):
    rng = np.random.default_rng(8)
    draws = spark.createDataFrame([(prose(rng, "klmnopqr"),) for _ in range(60)], "text string")
    fallen = [r.text for r in draws.where(F.pmod(F.xxhash64("text"), F.lit(language_id.CALIBRATION_SHARE)) == 0).collect()]
    assert fallen
    rows = [(prose(rng, "abcdefgh"), "big") for _ in range(100)] + [(t, "aside") for t in fallen] * 3
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id bigint, text string, lang string")
    got = language_id.identify(docs, F.lit(True)).join(docs, "doc_id").collect()
    assert all(r.lang_pred == r.lang for r in got)


# 5 ------------------------------------------------------------------------------------------

def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, diag = [i] + row[1:], row
        for j, y in enumerate(b, 1):
            row[j] = min(diag[j] + 1, row[j - 1] + 1, diag[j - 1] + (x != y))
    return row[-1]


def test_lexicon_equals_edit_distance():
    terms = {("idiot", False): 3.0, ("moron", False): 2.0, ("disgusting", False): 4.0, ("scum", False): 1.0, ("lowei", True): 2.5}
    lexicon, rng = toxicity.Lexicon(terms), np.random.default_rng(4)
    words = ["idiot", "idi0t", "idot", "iddiot", "idiots", "mormon", "disgustin", "dizgustinng", "scum", "scun", "loweient", "lowe", "l", ""]
    words += ["".join(rng.choice(list("idotmrnscuglwe"), int(rng.integers(1, 12)))) for _ in range(3000)]
    for w in words:
        near = []
        for (t, stem), weight in terms.items():
            k = toxicity.edits_allowed(t, stem)
            d = min(edit_distance(w[:i], t) for i in range(len(w) + 1)) if stem else edit_distance(w, t)
            if d <= k:
                near.append((d, -weight))
        got = lexicon.match(w)
        assert (got and (got[1], -got[0])) == (min(near) if near else None), w


def test_toxicity(spark, edge, none):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "toxic")
    rows = queries.op5_toxicity(spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    clean, toxic = ([r.score for r in held if r.toxic == k] for k in (0, 1))
    auc = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert auc > 0.75 and np.mean([s < 0.5 for s in clean]) > 0.9
    got = toxicity.score(edge, labels.withColumn("text", F.lit("clash")), F.lit(True)).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert toxicity.score(none, labels.limit(0), F.lit(True)).count() == 0


def test_quoted_hits_count_apart():
    lexicon = toxicity.Lexicon({("idiot", False): 3.0})
    rows = [b"you are an idiot my friend", b'they said "idiot" to him', b"nothing here"]
    offsets = np.cumsum([0] + [len(r) for r in rows])
    x = toxicity.text_features(lexicon, {}, offsets, np.frombuffer(b"".join(rows), np.uint8))
    assert x[0, 0] > 0 and x[0, 1] == 0 and x[1, 0] == 0 and x[1, 1] > 0 and not x[2].any()


def test_terms_beside_punctuation_beyond_ascii():
    lexicon = toxicity.Lexicon({("wanker", False): 3.0, ("git", False): 2.0})
    texts = ["you wanker friend", "you \u201cwanker\u201d friend", "you wanker\u2026 friend", "you \u2014wanker\u2014 friend",
             "\u00bfwanker?", "\uff08wanker\uff09", "\U0001F600wanker\U0001F600", "\u00e9t\u00e9 w\u00e4nker \u0431\u044b\u043b", "so a git\u2019s"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    x = toxicity.text_features(lexicon, {}, np.cumsum([0] + [len(r) for r in raw]), data)
    assert (x[:, :4].sum(axis=1) > 0).all()
    assert x[0, 0] == x[2, 0] > 0 and x[1, 1] > 0 and x[1, 0] == 0          # curly quotes quote
    assert (x[3:7, 0] > 0).all() and x[7, 2] > 0 and x[8, 0] > 0
    for t in [*texts, "\u65e5\u672c\u3001\u8a9e\u3002 a\u0301b \u00ad\u200b"]:
        got = toxicity._letters(np.frombuffer(t.encode(), np.uint8)).tobytes().decode()
        import unicodedata
        assert got == "".join(c if ord(c) < 128 or unicodedata.category(c)[0] not in "PSZ" else " " * len(c.encode()) for c in t)
    lexicon.reset()
    assert lexicon.match("wankr") == (3.0, 1)


# 6 ------------------------------------------------------------------------------------------

def test_bpe_equals_library(spark, edge, none):
    import tiktoken  # noqa: F401
    path, pattern = queries.tokenizer()
    enc, _ = bpe.encoding(bpe.read_ranks(path), pattern)
    for df in (edge, docs_of(spark)):
        for r in bpe.decode(bpe.encode(df, path, pattern), path, pattern).join(
                df.select(F.col("doc_id").alias("d"), "text"), F.col("d") == F.col("doc_id")).distinct().collect():
            if df is not edge or r.doc_id not in (1, 2):
                assert r.ids == enc.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert queries.token_digest(none, path, pattern).count() == 0


def test_pieces_are_safe():
    enc, _ = bpe.encoding(bpe.read_ranks(queries.tokenizer()[0]), queries.tokenizer()[1])
    rng = np.random.default_rng(6)
    for _ in range(400):
        t = "".join(rng.choice(list("ab1'sé \n\t .!日"), 300))
        parts = bpe.pieces(t, 5)
        assert "".join(parts) == t and [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(t)


# 7 ------------------------------------------------------------------------------------------

def test_sharding(spark, edge, none, tmp_path):
    df, limit = docs_of(spark), 20_000
    rows = sharding.shards(df, limit).collect()
    size, depth = Counter(), {}
    for r in rows:
        size[r.shard] += r.bytes
        depth[r.shard] = r.depth
    assert len(rows) == 200 and all(size[r.shard] == r.shard_bytes for r in rows) and all(len(s) == d for s, d in depth.items())
    assert all(not r.oversize for r in rows)
    for s in size:                                        # a shard's parent would not fit; no shard holds another
        assert not s or sum(n for x, n in size.items() if x.startswith(s[:-1])) > limit
        assert not any(x != s and x.startswith(s) for x in size)
    tiny = sharding.shards(edge, 100).collect()
    assert len(tiny) == len(ROWS) and all(r.oversize for r in tiny if r.bytes > 100)
    assert sharding.shards(none, 100).count() == 0
    sharding.write_shards(edge.drop("shard"), str(tmp_path / "out"), 100)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


# 8 ------------------------------------------------------------------------------------------

def test_nearest_neighbours(spark):
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(3000, 24)) * rng.uniform(0.2, 3, size=(3000, 1))).astype(np.float32)
    x[1000:1500] = x[7]                                   # one very common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 24), (5002, [float("nan")] + [1.0] * 23), (5003, [None] * 24), (None, [1.0] * 24),
             (5020, [float("inf")] * 24), rows[3]]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("ids", F.lit("clash"))
    got = {}
    for r in hnsw.search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    v, hits = x.astype(np.float64), 0
    assert sorted(got) == list(range(0, 3000, 100))
    for q, found in got.items():
        found.sort()
        s = v @ v[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(3000), -np.round(s, 9)))[:20]
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(sc - s[i]) < 1e-9 for _, i, sc in found)
        hits += len(set(want) & {i for _, i, _ in found})
    assert hits / (20 * len(got)) >= 0.9
    assert hnsw.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


# 10 -----------------------------------------------------------------------------------------

def test_licences(spark, edge, none):
    text = ("Foo. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software with no restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.")
    df = spark.createDataFrame([(1, text), (2, "The mit  LICENSE, or CC-BY; gnu general public license mit"), (3, "mit. x license")],
                               "doc_id bigint, text string")
    rows = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert rows[1].labels == "mit" and rows[1].n_base == 0 and rows[1].findings[0].start == 1 and 0.6 <= rows[1].score <= 1
    assert (rows[2].n_base, rows[2].first_word, rows[2].last_word, rows[2].base_labels) == (3, 1, 6, "cc-by,gpl,mit")
    assert rows[3].n_base == 0 and rows[3].first_word is None and rows[3].labels == ""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in licenses.scan(edge).join(edge.select(F.col("doc_id").alias("d"), "text"), F.col("d") == F.col("doc_id")).collect():
        if r.doc_id not in (1, 2):
            assert r.n_words == len(word.findall(lower(r.text)))
    assert licenses.scan(none).count() == 0


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(9)
    seqs = [rng.integers(0, 4, int(n)).tolist() for n in rng.integers(1, 40, 6)]
    sam = licenses.SuffixAutomaton(seqs)
    runs = {tuple(s[i:j]): None for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = rng.integers(0, 5, 400).tolist()
    for i, (state, length) in enumerate(sam.statistics(text)):
        want = next((k for k in range(min(i + 1, 40), 0, -1) if tuple(text[i + 1 - k:i + 1]) in runs), 0)
        assert length == want
        if length:
            run = text[i + 1 - length:i + 1]
            ends = {(d, p) for d, s in enumerate(seqs) for p in range(length - 1, len(s)) if s[p + 1 - length:p + 1] == run}
            assert sam.ends[state] == ends


def test_template_inside_a_longer_run():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES)

    def found(text):
        words = [kernels.hash_word(w) for w in licenses.tokens(text)]
        return scanner.findings(scanner.word_ids(np.array(words, dtype=np.uint64)).tolist())
    notice = ("apache-2.0-notice", 0, 8, 1.0)
    assert notice in found("Licensed under the Apache License, Version 2.0. The library comes as it is.")
    assert notice in found('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                           "compliance with the License.")
    both = found(licenses.TEMPLATES["apache-2.0"])
    assert notice in both and ("apache-2.0", 0, scanner.sizes[scanner.names.index("apache-2.0")], 1.0) in both


def test_matches_of_each_template_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(10)
    letters = "abc"
    templates = {str(n): " ".join(rng.choice(list(letters), int(m))) for n, m in enumerate(rng.integers(4, 30, 8))}
    scanner, got = licenses.Scanner(templates, {}), {}
    monkeypatch.setattr(licenses, "chains", lambda found, least: got.setdefault(len(got), sorted(found)) and [])
    text = rng.choice(list(letters + "z"), 300, p=[0.32, 0.32, 0.32, 0.04]).tolist()
    scanner.findings(scanner.word_ids(np.array([kernels.hash_word(w) for w in text], dtype=np.uint64)).tolist())
    want = []
    for t in templates.values():
        own, found = t.split(), []
        for i in range(len(text)):
            for j in range(len(own)):
                n = 0
                while n <= min(i, j) and text[i - n] == own[j - n]:
                    n += 1
                if n >= licenses.MIN_MATCH and (i + 1 == len(text) or j + 1 == len(own) or text[i + 1] != own[j + 1]):
                    found.append((i + 1, j + 1, n))
        want.append(sorted(found))
    assert sorted(got.values()) == sorted(w for w in want if w)


def test_chain_equals_enumeration():
    rng = np.random.default_rng(12)
    for _ in range(150):
        matches = [(int(e), int(t), int(min(n, e, t))) for e, t, n in zip(rng.integers(4, 120, 7), rng.integers(4, 30, 7),
                                                                        rng.integers(4, 20, 7), strict=True)]
        own = sorted(set(matches))

        def longest(i):
            end, t, n = own[i]
            return max([n] + [longest(j) + min(n, end - own[j][0], t - own[j][1]) for j in range(len(own))
                              if own[j][0] < end and own[j][1] < t and own[j][0] >= end - n - licenses.MAX_GAP])
        covered, first, end = licenses.chain(matches)
        assert covered == max(longest(i) for i in range(len(own))) and 0 <= first < end


def test_every_copy_of_a_notice_is_found():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES)

    def found(text):
        words = [kernels.hash_word(w) for w in licenses.tokens(text)]
        return scanner.findings(scanner.word_ids(np.array(words, dtype=np.uint64)).tolist())
    for name, text in licenses.TEMPLATES.items():
        size = len(licenses.tokens(text))
        close = [f for f in found(f"{text} {text} {text}") if f[0] == name]
        assert [f[1:] for f in close] == [(k * size, (k + 1) * size, 1.0) for k in range(3)], name
        far = [f for f in found(f"{text} {'unrelated words ' * 400} {text}") if f[0] == name]
        assert [f[1:] for f in far] == [(0, size, 1.0), (size + 800, 2 * size + 800, 1.0)], name


# pipeline -----------------------------------------------------------------------------------

def test_pipeline(spark, edge):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "MinHash near-dedup", "mixing sources", "byte-level BPE"]
    docs = edge
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    out = corpus_pipeline.run(spark, SF)
    rows, texts = out.collect(), {r.doc_id: r.text for r in docs_of(spark).collect()}
    assert rows and all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in rows)
