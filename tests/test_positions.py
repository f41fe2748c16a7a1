"""Lines with positions: whole and ordered over ranges, composed with C1 and the upsert table, restarts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from eventide.functions.parse import parse_delimited
from eventide.operators.sequence import adjacent_change
from eventide.operators.upsert import read_snapshot, upsert
from eventide.plans import cdc, patterns, streams
from eventide.session import scratch_path
from eventide.sources.json_table import read_json_table
from eventide.sources.positions import POSITION_BITS, Range, read_positioned_lines, read_range
from eventide.streaming.runner import run_stream

SF = "/root/testdata/sf0.001"


def drain(q):
    q.awaitTermination()
    assert q.exception() is None


@pytest.mark.parametrize("end", [b"\n", b"\r\n", b""])
def test_every_line_once_whatever_the_ranges(tmp_path, end):
    rng = random.Random(5)
    raw = b"\n".join(b"x" * rng.choice([0, 0, 1, 3, 40]) + bytes(str(i), "ascii") * rng.choice([0, 1]) for i in range(60)) + end
    path = str(tmp_path / "a.txt")
    with open(path, "wb") as f:
        f.write(raw)
    want, at = [], 0
    for line in raw.split(b"\n"):
        if line or at < len(raw):
            want.append((line.removesuffix(b"\r").decode(), at))
        at += len(line) + 1
    for size in (1, 2, 7, 64, 10_000):
        got = [(r["value"], r["seq"]) for a in range(0, len(raw), size)
               for b in read_range(path, Range(0, path, a, min(a + size, len(raw)))) for r in b.to_pylist()]
        assert got == want, size


def test_text_to_pattern_in_batch(spark, tmp_path):
    lines = [f"{u},{k}" for u, k in zip([1, 2, 1, 1, 2, 1] * 20, [7, 7, 7, 8, 9, 7] * 20, strict=True)]
    for n, part in enumerate((lines[:50], [], lines[50:])):
        (tmp_path / f"part-{n}.txt").write_text("".join(x + "\n" for x in part))
    df = read_positioned_lines(spark, str(tmp_path), range_bytes=37)
    assert df.columns == ["value", "seq"] and df.rdd.getNumPartitions() > 5
    assert [r.value for r in df.orderBy("seq").collect()] == lines
    assert {r.seq >> POSITION_BITS for r in df.collect()} == {0, 2}          # the empty file has a number too
    rows = parse_delimited(df, "value", "user bigint, k bigint", keep=["seq"])
    last, want = {}, 0
    for x in lines:
        u, k = x.split(",")
        want += last.get(u, k) != k
        last[u] = k
    assert adjacent_change(rows, "user", ["seq"], "k").count() == want
    assert read_positioned_lines(spark, str(tmp_path / "none")).count() == 0


def test_json_to_upsert_table(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":1,"v":"old","d":"d1"}\n{"id":2,"v":"x","d":"d1"}\noops\n{"id":1,"v":"new","d":"d1"}\n')
    rows = read_json_table(spark, "id bigint, v string, d string", str(tmp_path), positions=True)
    table = scratch_path(spark, "t-positions")
    upsert(spark, table, rows.select("id", "v", "d", "seq"), 1, "id", "d", seq="seq")
    assert {r.id: r.v for r in read_snapshot(spark, table, "id", "d").collect()} == {1: "new", 2: "x"}


def test_stream_numbers_files_once(spark, tmp_path):
    """A restart goes on with the numbers of the log, and takes no file twice, grown or not."""
    src, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    os.makedirs(src)

    def go():
        lines = read_positioned_lines(spark, str(src), stream=True, log=log, range_bytes=4)
        drain(run_stream(lines, str(tmp_path / "ckpt"), sink=out))
    (src / "b").write_text("b1\nb2\n")
    go()
    (src / "a").write_text("a1\n")                  # a later file goes after, whatever its name
    (src / "b").write_text("b1\nb2\nb3\n")
    go()
    go()
    got = [r.value for r in spark.read.parquet(out).orderBy("seq").collect()]
    assert got == ["b1", "b2", "a1"]
    with pytest.raises(ValueError):
        read_positioned_lines(spark, str(src), stream=True)


@pytest.mark.parametrize("stream_fn,batch_fn", [
    (streams.stream_login_changes_from_text, patterns.login_changes_from_text),
    (streams.stream_order_table, cdc.order_table_snapshot),
])
def test_text_streams_equal_batch(spark, stream_fn, batch_fn):
    cols = sorted(batch_fn(spark, SF).columns)
    a, b = (sorted(map(str, f(spark, SF).select(*cols).collect())) for f in (stream_fn, batch_fn))
    assert a == b and a


def test_range_is_read_in_chunks(monkeypatch, tmp_path):
    from eventide.sources import positions
    monkeypatch.setattr(positions, "CHUNK", 8)
    path = str(tmp_path / "long")
    lines = ["short", "l" * 1000, "", "m" * 77, "end"]
    with open(path, "w") as f:
        f.write("\n".join(lines))
    size = os.path.getsize(path)
    for cut in (1, 300, 900, 1010, size - 1):
        got = [v for a, b in ((0, cut), (cut, size)) for r in read_range(path, Range(0, path, a, b)) for v in r.column(0).to_pylist()]
        assert got == lines, cut
