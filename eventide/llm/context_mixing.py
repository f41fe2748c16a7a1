"""Language-model scores by logistic context mixing over hashed byte contexts.

A text is read as its lower-cased words, each followed by a space, and one line end
after the last. Every byte is eight binary decisions. One predictor per context
order (the last 1 to ``ORDERS`` bytes) gives the stretched probability of a decision
from the counts of its context, exact counts over all training texts; a gate (the
longest context seen, how often, whether it always went one way, and which bit)
picks the weights that mix them; an adaptive map per gate refines the mixed
probability. Weights and maps are those of least loss over all training occurrences,
each left out of its own counts; they are found in Newton steps, one pass over the
distinct windows each.

A context reaches at most two bytes into the word before, and only from a word's
first three bytes. So a text's probability is a sum over its words and its pairs
(end of a word, start of the next), and a *block* of texts needs each of its distinct
words and byte windows once:

1. blocks of about ``BLOCK_TEXT`` bytes become word lists with training counts,
   window lists with training counts, and word numbers (a written table);
2. words are counted across blocks; windows are summed across blocks, dealt out by
   their last two context bytes, which every longer context shares, and priced;
3. counts and prices are gathered for the blocks that asked, and texts are summed.

Nothing but the order-1 counts (at most 65,536 rows) and the weights is held whole. A
window's price is kept in single precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_folder, scratch_path, ship_package
from .common import written_alone
from .kernels import ASCII_LOWER, IS_SPACE, row_blocks, span_hashes, string_buffers, word_spans

BLOCK_TEXT = 10 << 20
ORDERS = 5
SPACE, END = 0x20, 0x0A
START_TAIL = END << 8 | END
PRIOR = 0.4                    # added to both counts of a decision
BUCKET_WINDOWS = 100_000
CHUNK = 1_024                  # windows worked on at once, and per row of the table that the weights are learnt from
PULL = 1.0                     # of weights and maps to where they start, in decisions
MAX_PASSES, ENOUGH = 12, 1e-5  # learning ends when the next step would lower the loss by less than this share
GATES = (ORDERS + 1) * 4 * 2 * 8
KNOTS = np.linspace(0, 12, 25)


# Windows: up to ``ORDERS`` context bytes and the byte that follows, packed into one integer.

def words_layout(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, place of every word's first byte, lengths); each word as 0, space, word, space, 0, 0."""
    offsets, data = string_buffers(words)
    size = np.diff(offsets)
    at = np.concatenate(([0], np.cumsum(size + 5)))[:-1] + 2
    out = np.zeros(int((size + 5).sum()), np.uint8)
    out[at - 1] = out[at + size] = SPACE
    out[np.repeat(at - offsets[:-1], size) + np.arange(len(data))] = data
    return out, at, size


def later_windows(layout: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, word) of every byte from a word's fourth on, its closing space included."""
    n = np.maximum(size - 2, 0)
    word = np.repeat(np.arange(len(size)), n)
    place = np.repeat(at + 3 - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
    key = np.zeros(len(place), np.int64)
    for i in range(ORDERS + 1):
        key = key << 8 | layout[place - ORDERS + i]
    return key, word


def head_windows(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, unit) of the first three bytes of a word after the two last ones of the word before.

    A unit packs those two and these three bytes, 0 where a word has ended.
    """
    tail, a, b, c = units >> 24, units >> 16 & 255, units >> 8 & 255, units & 255
    some = np.arange(len(units))
    more, third = some[a != END], some[(a != END) & (a != SPACE) & (b != SPACE)]
    first = (tail << 8 | SPACE) << 8 | a
    keys = [first, (first << 8 | b)[more], ((tail << 8 | SPACE) << 24 | a << 16 | b << 8 | c)[third]]
    more_ok = a[more] != SPACE
    return np.concatenate((keys[0], keys[1][more_ok], keys[2])), np.concatenate((some, more[more_ok], third))


def heads_of(layout: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed first three bytes, packed last two bytes) of every word."""
    x = lambda place: layout[place].astype(np.int64)
    return x(at) << 16 | x(at + 1) << 8 | np.where(size >= 2, x(at + 2), 0), x(at + size - 2) << 8 | x(at + size - 1)


def units_of(ids: np.ndarray, sizes: np.ndarray, head: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, text) of every token of a block, the end of every text included.

    ``ids`` are the word numbers of all texts in turn, ``sizes`` the words of each text.
    """
    text = np.repeat(np.arange(len(sizes)), sizes + 1)
    last = np.cumsum(sizes + 1) - 1
    word = np.ones(len(text), bool)
    word[last] = False
    heads, before = np.full(len(text), END << 16, np.int64), np.full(len(text), START_TAIL, np.int64)
    heads[word] = head[ids]
    tails = np.full(len(text), START_TAIL, np.int64)
    tails[word] = tail[ids]
    before[1:] = tails[:-1]                        # an end has the start's tail, so the next text starts anew
    return before << 24 | heads, text


def _spans(sizes: np.ndarray, tokens: int = 1 << 18) -> Iterator[tuple[int, int, int, int]]:
    """(first text, end, first word, end) of runs of texts of about ``tokens`` words, longer texts alone."""
    at = np.concatenate(([0], np.cumsum(sizes)))
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(at, at[i] + tokens, side="right")) - 1)
        yield i, j, int(at[i]), int(at[j])
        i = j


class _Block:
    """Texts gathered until their bytes fill a block; of the texts only word numbers and distinct words are kept."""

    def __init__(self):
        self.doc_ids, self.train, self.sizes, self.ids, self.hashes, self.words = [], [], [], [], [], []
        self.bytes = self.n_words = 0

    def add(self, doc_ids: pa.Array, train: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> None:
        starts, ends, rows = word_spans(offsets, data, ~IS_SPACE)
        hashes, first, ids = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        self.doc_ids.append(doc_ids)
        self.train.append(train)
        self.sizes.append(np.bincount(rows, minlength=len(offsets) - 1))
        self.ids.append((ids + self.n_words).astype(np.int32))
        self.hashes.append(hashes)
        self.words.append(_cut(data, starts[first], ends[first]))
        self.bytes += len(data)
        self.n_words += len(hashes)

    def row(self, block: int, id_type: pa.DataType) -> pa.RecordBatch:
        sizes, train = np.concatenate(self.sizes), np.concatenate(self.train)
        _, first, number = np.unique(np.concatenate(self.hashes), return_index=True, return_inverse=True)
        number = number.astype(np.int32)
        spans, parts = list(_spans(sizes)), np.concatenate(self.ids)
        often = np.bincount(number[parts], minlength=len(first))
        by = np.argsort(-often, kind="stable")               # frequent words get small numbers, which pack well
        rank = np.empty(len(by), np.int32)
        rank[by] = np.arange(len(by))
        ids = rank[number][parts]
        words = pa.concat_arrays(self.words).take(pa.array(first[by])).cast(pa.string())
        layout, at, size = words_layout(words)
        head, tail = heads_of(layout, at, size)
        word_n, units, unit_n = np.zeros(len(words), np.int64), [], []
        for i, j, x, y in spans:
            word_n += np.bincount(ids[x:y], np.repeat(train[i:j], sizes[i:j]).astype(float), len(words)).astype(np.int64)
            asked, text = units_of(ids[x:y], sizes[i:j], head, tail)
            asked, unit = np.unique(asked, return_inverse=True)
            units.append(asked)
            unit_n.append(np.bincount(unit, train[i:j][text].astype(float), len(asked)))
        units, unit = np.unique(np.concatenate(units), return_inverse=True)
        unit_n = np.bincount(unit, np.concatenate(unit_n), len(units)).astype(np.int64)
        key1, word = later_windows(layout, at, size)
        key2, unit = head_windows(units)
        both = np.concatenate((key1, key2))
        del key1, key2
        keys, which = _numbered(both)
        del both
        key_n = np.bincount(which, np.concatenate((word_n[word], unit_n[unit])).astype(float), len(keys)).astype(np.int64)
        planes = ids.view(np.uint8).reshape(-1, 4).T.tobytes()
        one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t) if isinstance(x, np.ndarray) else x)
        return pa.RecordBatch.from_arrays([
            pa.array([block], pa.int64()), one(pa.concat_arrays(self.doc_ids).cast(id_type), None), one(train, pa.bool_()), one(sizes, pa.int64()),
            pa.array([pa.compress(planes, codec="zstd", asbytes=True)], pa.binary()), one(words, None),
            one(word_n, pa.int64()), one(keys, pa.int64()), one(key_n, pa.int64())],
            ["block", "doc_ids", "train", "sizes", "ids", "words", "word_n", "keys", "key_n"])


def _cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The lower-cased bytes of the given spans as strings."""
    size = ends - starts
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    place = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(ASCII_LOWER[data[place]].tobytes()))


def _numbered(values: np.ndarray, part: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, place of every value among them), in less memory than ``np.unique`` takes for both."""
    distinct, place = np.unique(values), np.empty(len(values), np.int32)
    for a in range(0, len(values), part):
        place[a:a + part] = np.searchsorted(distinct, values[a:a + part])
    return distinct, place


def _unpack(packed: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view(np.uint32).ravel()


def blocks(docs: DataFrame, train: Column) -> DataFrame:
    """A row per block of texts: word numbers, distinct words and windows with training counts."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = docs.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, block = TaskContext.get().partitionId() << 32, 0, _Block()
        for batch in batches:
            offsets, data = string_buffers(batch.column(1))
            marks = np.asarray(batch.column(2).to_numpy(zero_copy_only=False), dtype=bool)
            for a, b in row_blocks(offsets):
                block.add(batch.column(0).take(pa.array(np.arange(a, b))), marks[a:b], offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]])
                if block.bytes >= BLOCK_TEXT:
                    yield block.row(base + made, id_type)
                    made, block = made + 1, _Block()
        if block.doc_ids:
            yield block.row(base + made, id_type)
        pa.default_memory_pool().release_unused()          # the worker goes on to other steps

    return rows.mapInArrow(gather, (
        f"block bigint, doc_ids array<{kind.simpleString()}>, train array<boolean>, sizes array<bigint>, ids binary, "
        "words array<string>, word_n array<bigint>, keys array<bigint>, key_n array<bigint>"))


# Predictors, gates, weights.

def path_counts(keys: np.ndarray, n: np.ndarray, first: np.ndarray) -> np.ndarray:
    """counts[order, depth, window]: how often the window's context went on with its byte's first ``depth`` bits.

    ``first``: counts of (last byte, byte) over all windows; the other orders come
    from ``keys`` and ``n``, which hold every window that shares two context bytes.
    """
    out = np.empty((ORDERS, 9, len(keys)), np.int64)
    symbol = keys & 255
    for depth in range(9):
        table = first.reshape(256, 1 << depth, -1).sum(axis=2)
        out[0, depth] = table[keys >> 8 & 255, symbol >> (8 - depth)]
    for order in range(2, ORDERS + 1):
        own = keys & ((1 << 8 * (order + 1)) - 1)
        by = np.argsort(own, kind="stable")
        own, weight = own[by], n[by]
        for depth in range(9):
            node = own >> (8 - depth)
            edge = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
            sums = np.add.reduceat(weight, edge)
            out[order - 1, depth, by] = np.repeat(sums, np.diff(np.concatenate((edge, [len(node)]))))
    return out


def inputs(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretched predictions of the bit taken [window, bit, order], gates [window, bit]).

    A gate depends on counts before the bit alone, so both bits' probabilities add up to 1.
    """
    before, taken = counts[:, :8].astype(float), counts[:, 1:].astype(float)
    other = before - taken
    x = np.log((taken + PRIOR) / (other + PRIOR))
    seen = before > 0
    top = np.where(seen.any(axis=0), ORDERS - np.argmax(seen[::-1], axis=0), 0)
    at = np.maximum(top - 1, 0)[None]
    often = np.take_along_axis(before, at, 0)[0]
    sure = np.maximum(np.take_along_axis(taken, at, 0)[0], np.take_along_axis(other, at, 0)[0]) == often
    level = (often >= 2).astype(int) + (often >= 4) + (often >= 16)
    gate = ((top * 4 + level) * 2 + sure) * 8 + np.arange(8)[:, None]
    return x.transpose(2, 1, 0), gate.T


def _refined(st: np.ndarray, gate: np.ndarray, maps: np.ndarray) -> tuple[np.ndarray, ...]:
    """(refined stretch, lower knot, share of the upper knot); odd in ``st``, so a bit and its opposite add up."""
    size = np.minimum(np.abs(st), KNOTS[-1] - 1e-9) / KNOTS[1]
    low = size.astype(int)
    share = size - low
    value = maps[gate, low] * (1 - share) + maps[gate, low + 1] * share
    return np.sign(st) * value, low, share


def log10_taken(x: np.ndarray, gate: np.ndarray, weights: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """log10 of the probability of the bits taken: the mean, in the stretched domain, of mixed and refined."""
    st = np.clip((x * weights[gate]).sum(axis=-1), -12, 12)
    st = (st + _refined(st, gate, maps)[0]) / 2
    return -np.logaddexp(0, -st) / math.log(10)


def start_weights() -> tuple[np.ndarray, np.ndarray]:
    return np.full((GATES, ORDERS), 0.3), np.tile(KNOTS, (GATES, 1))


def weight_sums(x: np.ndarray, gate: np.ndarray, n: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per gate the loss of ``weights`` over decisions [row, order], its gradient and the rows of its curvature's upper half."""
    st = (x * weights[gate]).sum(axis=1)
    p = 1 / (1 + np.exp(np.clip(st, -500, 500)))                     # of the bit not taken
    slope, bend = -p * n, p * (1 - p) * n
    parts = [np.logaddexp(0, -st) * n, *(slope * x[:, i] for i in range(ORDERS))]
    parts += [bend * x[:, i] * x[:, j] for i in range(ORDERS) for j in range(i, ORDERS)]
    return np.stack([np.bincount(gate, v, GATES) for v in parts], axis=1)


def map_sums(x: np.ndarray, gate: np.ndarray, n: np.ndarray, weights: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """Per gate the loss of ``maps`` after mixing by ``weights``, its gradient, and its curvature's two diagonals."""
    st = np.clip((x * weights[gate]).sum(axis=1), -12, 12)
    refined, low, share = _refined(st, gate, maps)
    p = 1 / (1 + np.exp(np.clip(refined, -500, 500)))
    slope, bend = -p * n * np.sign(st), p * (1 - p) * n
    k = len(KNOTS)
    at = gate * k + low
    cells = lambda here, above: (np.bincount(at, here, GATES * k) + np.bincount(at + 1, above, GATES * k)).reshape(GATES, k)
    return np.concatenate((
        np.bincount(gate, np.logaddexp(0, -refined) * n, GATES)[:, None], cells(slope * (1 - share), slope * share),
        cells(bend * (1 - share) ** 2, bend * share ** 2), np.bincount(at, bend * share * (1 - share), GATES * k).reshape(GATES, k)), axis=1)


def _curvature(sums: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((GATES, size, size))
    if size == ORDERS:
        i, j = np.triu_indices(size)
        out[:, i, j] = out[:, j, i] = sums[:, 1 + size:]
    else:
        i = np.arange(size)
        out[:, i, i] = sums[:, 1 + size:1 + 2 * size]
        out[:, i[:-1], i[1:]] = out[:, i[1:], i[:-1]] = sums[:, 1 + 2 * size:3 * size]
    return out


def _newton(start: np.ndarray, sums_at) -> np.ndarray:
    """The parameters [gate, i] of least loss, drawn to ``start``, by damped Newton steps of every gate for itself.

    ``sums_at(parameters)`` gives ``weight_sums`` or ``map_sums`` over all training
    occurrences. A map's value at an even chance stays 0.
    """
    size, free = start.shape[1], np.ones(start.shape[1])
    if size != ORDERS:
        free[0] = 0
    at, best, least = start, start.copy(), np.full(GATES, np.inf)
    step, hope, rate = np.zeros_like(start), np.zeros(GATES), np.ones(GATES)
    for _ in range(MAX_PASSES):
        sums = sums_at(at)
        loss = sums[:, 0] + PULL / 2 * ((at - start) ** 2).sum(axis=1)
        better = loss <= least
        best[better], least[better], rate[better] = at[better], loss[better], 1
        rate[~better] /= 4                               # the step went too far
        slope = (sums[:, 1:1 + size] + PULL * (at - start)) * free
        bend = _curvature(sums, size) * free[:, None] * free + PULL * np.eye(size)
        whole = np.linalg.solve(bend, slope[..., None])[..., 0]
        step[better], hope[better] = whole[better], (slope * whole).sum(axis=1)[better] / 2
        if hope.sum() <= ENOUGH * least.sum():
            break
        at = best - rate[:, None] * step
    return np.round(best, 6)                             # the order of sums leaves no trace


def _fitted(sums_over) -> tuple[np.ndarray, np.ndarray]:
    """Weights, then maps; ``sums_over(f)`` adds up ``f(x, gate, n)`` over all training decisions."""
    weights, maps = start_weights()
    weights = _newton(weights, lambda w: sums_over(lambda x, g, n: weight_sums(x, g, n, w)))
    return weights, _newton(maps, lambda m: sums_over(lambda x, g, n: map_sums(x, g, n, weights, m)))


def fit(x: np.ndarray, gate: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and maps of least loss over the given windows, each ``weight`` times."""
    return _fitted(lambda f: f(x.reshape(-1, ORDERS).astype(float), gate.ravel(), np.repeat(weight, 8).astype(float)))


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))), F.lit(n))


@contextmanager
def _few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Reads and Arrow batches of few rows, for tables whose rows are some 200 KB each."""
    small = {"spark.sql.parquet.columnarReaderBatchSize": "16", "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _learn(windows: DataFrame, n_buckets: int, first: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Weights and maps from every training occurrence, each left out of its counts.

    Equal occurrences share one row of the table written at ``path``, weighted by their
    number; every pass sums a few figures per gate over its parts, and Spark adds those up.
    """
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = pa.Table.from_batches(list(batches))
        keys, n = group.column("key").to_numpy(), group.column("n").to_numpy()
        by = np.argsort(keys)
        keys, n = keys[by], n[by]
        counts = path_counts(keys, n, first)
        for a in range(0, len(keys), CHUNK):
            x, gate = inputs(np.maximum(counts[:, :, a:a + CHUNK] - 1, 0))
            row = x.astype(np.float32), gate.astype(np.int16), n[a:a + CHUNK].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in row], ["x", "gate", "n"])

    table = written_alone(windows.where("n > 0").withColumn("bucket", _bucket(n_buckets)).groupBy("bucket").applyInArrow(
        features, "x binary, gate binary, n binary"), path)

    def sums_over(f) -> np.ndarray:
        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for x, gate, n in zip(*batch.columns):
                    part = f(np.frombuffer(x.as_buffer(), np.float32).reshape(-1, ORDERS).astype(float),
                             np.frombuffer(gate.as_buffer(), np.int16).astype(np.int64),
                             np.repeat(np.frombuffer(n.as_buffer(), np.int64).astype(float), 8))
                    total = part if total is None else total + part
            pa.default_memory_pool().release_unused()
            if total is not None:
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total.ravel()[some])], ["cell", "value"])

        # At most one row per gate and figure comes back, however many windows there are.
        with _few_rows_at_once(windows.sparkSession):
            got = table.mapInArrow(add_up, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        out = f(np.zeros((0, ORDERS)), np.zeros(0, np.int64), np.zeros(0)).astype(float)     # bincount of nothing is whole numbers
        out.ravel()[got.column("cell").to_numpy()] = got.column("value").to_numpy()
        return out

    return _fitted(sums_over)


def _prices(windows: DataFrame, n_buckets: int, first: np.ndarray, weights: np.ndarray, maps: np.ndarray) -> DataFrame:
    def price(group: pd.DataFrame) -> pd.DataFrame:
        keys = group["key"].to_numpy()
        counts = path_counts(keys, group["n"].to_numpy(), first)
        value = np.empty(len(keys))
        for a in range(0, len(keys), CHUNK):
            value[a:a + CHUNK] = log10_taken(*inputs(counts[:, :, a:a + CHUNK]), weights, maps).sum(axis=1)
        return pd.DataFrame({"key": keys, "value": value})

    return (windows.withColumn("bucket", _bucket(n_buckets)).groupBy("bucket")
            .applyInPandas(price, "key bigint, value float"))


def _summed(id_type: pa.DataType, n_train: int, n_words: int):
    """Function of a block and its ``_gathered`` answers: a row for each text."""
    floor = n_train + 0.1 * (n_words + 1)

    def add_up(asked: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: asked.column(c).combine_chunks() for c in asked.column_names}
        values = lambda c: row[c].values if isinstance(row[c], pa.ListArray) else row[c]
        sizes, train = values("sizes").to_numpy(), np.asarray(values("train").to_numpy(zero_copy_only=False), bool)
        words = values("words")
        ids = _unpack(row["ids"][0].as_py(), int(sizes.sum()))
        layout, at, size = words_layout(words)
        head, tail = heads_of(layout, at, size)
        spans = list(_spans(sizes))
        units = np.unique(np.concatenate([np.unique(units_of(ids[x:y], sizes[i:j], head, tail)[0]) for i, j, x, y in spans]))
        key1, word = later_windows(layout, at, size)
        key2, unit = head_windows(units)
        both = np.concatenate((key1, key2))
        del key1, key2, layout
        which = _numbered(both)[1]                           # in the order they were asked in
        del both
        count = np.frombuffer(answers.column("counts")[0].as_py(), np.int64)
        price = np.frombuffer(answers.column("prices")[0].as_py(), np.float32).astype(float)
        later = np.bincount(word, price[which[:len(word)]], len(words))
        heads = np.bincount(unit, price[which[len(word):]], len(units))
        del which, word, unit
        ends, rate = float(row["ends"][0].as_py()), np.log10((count + 0.1) / floor)
        of_word = np.stack((later, rate, (count > 0).astype(float), size + 1.0))
        sums = np.empty((4, len(sizes)))
        for i, j, x, y in spans:
            owner = np.repeat(np.arange(j - i), sizes[i:j])
            for k in range(4):
                sums[k, i:j] = np.bincount(owner, of_word[k][ids[x:y]], j - i)
            asked_units, text = units_of(ids[x:y], sizes[i:j], head, tail)
            sums[0, i:j] += np.bincount(text, heads[np.searchsorted(units, asked_units)], j - i)
        pa.default_memory_pool().release_unused()
        return pa.table({
            "doc_id": values("doc_ids").cast(id_type), "train": pa.array(train), "n_tokens": pa.array(sizes + 1, pa.int64()),
            "n_known": pa.array(sums[2].astype(np.int64) + (ends > 0)), "train_tokens": pa.array(np.full(len(sizes), n_train, np.int64)),
            "base_score": pa.array(sums[1] + math.log10((ends + 0.1) / floor)), "score": pa.array(sums[0]),
            "bits_per_byte": pa.array(-sums[0] / math.log10(2) / (sums[3] + 1))})

    return add_up


def _gathered(answers: pa.Table) -> pa.Table:
    """One row of a block's answers: counts of its words (place >= 0), prices of its windows (place < 0), in order."""
    place, value = answers.column("place").to_numpy(), answers.column("value").to_numpy()
    is_word = place >= 0
    counts, prices = np.zeros(is_word.sum(), np.int64), np.zeros((~is_word).sum(), np.float32)
    counts[place[is_word]] = value[is_word]
    prices[-1 - place[~is_word]] = value[~is_word]
    return pa.table({"block": answers.column("block")[:1], "counts": pa.array([counts.tobytes()], pa.binary()),
                     "prices": pa.array([prices.tobytes()], pa.binary())})


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Per row of ``docs``: ``doc_id, train, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Tokens are runs without ASCII white space, A-Z lower-cased, then one end. ``train``
    marks the rows to learn from (null: not). ``base_score`` sums ``log10((c + 0.1) /
    (N + 0.1 (V + 1)))`` over tokens: ``c`` training occurrences of the token
    (``n_known`` counts those above 0), ``N`` all and ``V`` distinct training tokens.
    ``score`` is the mixed model's log10 probability of the text, ``bits_per_byte`` the
    same in bits, over the bytes of its words and one byte after each and at the end.

    A null or empty text is its end alone. Repeated rows and ids, null too, give a row
    each; rows without training rows get even chances; an empty table gives no rows.
    Other columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    ship_package(spark)
    path = {k: scratch_path(spark, f"lm-{k}") for k in ("blocks", "words", "windows", "features", "prices", "priced", "answers")}
    table = written_alone(blocks(docs, train), path["blocks"])

    # How often every word and the end occur in training texts.
    asked = table.select("block", F.posexplode(F.arrays_zip("words", "word_n")).alias("place", "w")).select(
        "block", "place", F.col("w.words").alias("word"), F.col("w.word_n").alias("n"))
    same = Window.partitionBy("word")
    counted = written_alone(asked.select(
        "block", "place", F.sum("n").over(same).alias("value"),
        (F.row_number().over(same.orderBy("block")) == 1).alias("first")), path["words"])
    ends, words_in = table.select(F.expr("size(filter(train, t -> t))").alias("e"),
                                  F.expr("aggregate(word_n, 0L, (a, x) -> a + x)").alias("w")).agg(
        F.coalesce(F.sum("e"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    n_words = counted.where("first AND value > 0").count() + (ends > 0)

    # What every window costs.
    windows = written_alone(table.select(F.explode(F.arrays_zip("keys", "key_n")).alias("k")).groupBy(
        F.col("k.keys").alias("key")).agg(F.sum("k.key_n").alias("n")), path["windows"])
    first = np.zeros(1 << 16, np.int64)
    rows = 0
    for r in windows.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("pair")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect():          # at most 65,536 rows
        first[r["pair"]] = r["n"]
        rows += r["rows"]
    n_buckets = max(1, math.ceil(rows / BUCKET_WINDOWS))
    weights, maps = _learn(windows, n_buckets, first, path["features"])
    drop_folder(spark, path["features"])
    prices = written_alone(_prices(windows, n_buckets, first, weights, maps), path["prices"])
    priced = written_alone(table.select("block", F.posexplode("keys").alias("place", "key")).join(prices, "key").select(
        "block", "place", "value"), path["priced"])

    answers = counted.select("block", "place", F.col("value").cast("double").alias("value")).union(
        priced.select("block", (-1 - F.col("place")).alias("place"), F.col("value").cast("double")))
    gathered = written_alone(answers.groupBy("block").applyInArrow(
        _gathered, "block bigint, counts binary, prices binary"), path["answers"])
    for k in ("words", "windows", "prices", "priced"):
        drop_folder(spark, path[k])
    wanted = table.select("block", "doc_ids", "train", "sizes", "ids", "words", F.lit(int(ends)).alias("ends"))
    schema = (f"doc_id {kind.simpleString()}, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
              "base_score double, score double, bits_per_byte double")
    return wanted.groupBy("block").cogroup(gathered.groupBy("block")).applyInArrow(
        _summed(to_arrow_type(kind), int(words_in + ends), int(n_words)), schema)
