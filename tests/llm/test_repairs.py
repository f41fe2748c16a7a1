"""Repeated ids under near-dedup, personal data among many numbers, Python workers a task, and tables through the driver."""

import functools
import hashlib
import random
import time

from pyspark.sql import functions as F

from eventide.llm import bpe, common, near_dedup, pii, queries, sharding


def test_near_duplicates_of_repeated_ids(spark):
    a = " ".join(f"w{i}" for i in range(60))
    near, other = a + " tail", " ".join(f"v{i}" for i in range(60))
    rows = [(1, a, "p"), (2, other, "q"), (2, near, "r"), (3, near + " end", "s"), (None, a, "t"), (4, None, "u"), (4, "", "v")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, rk string").withColumn("_kept", F.lit("clash"))
    kept = near_dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.rk for r in kept.collect()) == ["p", "q", "u", "v"]


def _overlapping(spans, a, b):
    return sorted(s for s in spans if s[0] < b and s[2] > a)


def test_overlap_lookup_equals_a_scan():
    rng = random.Random(7)
    for _ in range(200):
        spans = sorted((s, rng.randrange(4), s + rng.randrange(1, 30)) for s in (rng.randrange(200) for _ in range(rng.randrange(40))))
        look = pii._Overlaps(spans)
        for _ in range(30):
            a = rng.randrange(230)
            b = a + rng.randrange(1, 40)
            assert sorted(look.of(a, b)) == _overlapping(spans, a, b)


def test_a_text_of_addresses_takes_time_in_proportion():
    rng = random.Random(1)
    model = pii.SemiMarkov().fit(pii.generated_examples(40), epochs=1)

    def took(n):
        text = " ".join(".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(n))
        start = time.process_time()
        base, found = model.spans(text)
        assert set(base) <= set(found) and len(base) >= n // 4
        return time.process_time() - start

    assert took(2000) < 3 * took(1000)              # four times it, when every candidate met every span


def test_token_digest_takes_one_python_worker_a_task(spark, capsys):
    df = spark.createDataFrame([(1, "One fish, two fish"), (1, "One fish, two fish"), (None, "größe 漢字 \t\n x"), (3, None), (4, "")],
                               "doc_id bigint, text string")
    path, pattern = queries.tokenizer()
    queries.token_digest(df, path, pattern).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1     # a worker each for encode and decode before
    rows = [sorted(map(str, d.collect())) for d in (bpe.round_trip(df, path, pattern), bpe.decode(bpe.encode(df, path, pattern), path, pattern))]
    assert rows[0] == rows[1] and len(rows[0]) == 5


def _split(rows, limit, shard=""):
    """(doc_id, bytes, shard, depth, shard_bytes, oversize) of (doc_id, key bits, bytes), a bit at a time."""
    size = sum(r[2] for r in rows)
    if size <= limit or len(shard) == 60:
        return [(d, n, shard, len(shard), size, size > limit) for d, _, n in rows]
    return [x for bit in "01" if (half := [r for r in rows if r[1][len(shard)] == bit]) for x in _split(half, limit, shard + bit)]


def test_tables_of_the_shards_do_not_pass_the_driver(spark, monkeypatch):
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(sharding, "written", lambda df, name: common.written(seen(df), name))
    monkeypatch.setattr(sharding, "join_small", functools.partial(common.join_small, max_rows=0))    # as beyond its rows
    rows = [(i, "x" * (i % 90)) for i in range(400)] + [(7, "é" * 40)] * 9 + [(None, "z" * 500), (None, None), (None, "")]
    got = seen(sharding.shards(spark.createDataFrame(rows, "doc_id bigint, text string"), 300)).collect()
    assert len(plans) > 6 and not any("Broadcast" in p for p in plans)      # Spark went by the size of small files before
    name = lambda d, t: f"text:{t or ''}" if d is None else str(d)
    keyed = [(d, f"{int(hashlib.md5(name(d, t).encode()).hexdigest()[:15], 16):060b}", len((t or "").encode())) for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, _split(keyed, 300)))
