"""Ranked lexical search turned round: documents stream through an index of the items.

The items' terms form an inverted index (term -> items). The documents are read
once and keep only their term total and their counts of indexed terms; those small
rows give the corpus figures and then pass through the broadcast index, where each
task updates one bounded heap per item. Heaps are merged in two steps, so that no
task meets all of an item's heaps.

The items are dealt into blocks of about ``ITEM_BYTES`` of text, whatever their
number; each block has its own index and pass over the documents, so what is
broadcast is bounded (by the longest item text, if that is longer).
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import texts, written
from .kernels import row_blocks, span_hashes, string_buffers, word_spans

TOP = 10
ITEM_BYTES = 4 << 20
CELLS = 1 << 21            # scores of (documents x items) held at once
MERGERS = 64
IS_TERM = np.ones(256, dtype=bool)
IS_TERM[:128] = [chr(c).isalnum() for c in range(128)]


def term_table(items: list[tuple[object, str | None]]) -> tuple[list, np.ndarray, list[np.ndarray]]:
    """(item ids, sorted term hashes, term numbers of every item); rows of one id are one item."""
    ids: dict = {}
    for item, text in items:
        data = np.frombuffer((text or "").encode(), np.uint8)
        starts, ends, _ = word_spans(np.array([0, len(data)]), data, IS_TERM)
        ids.setdefault(item, []).append(span_hashes(data, starts, ends))
    own = [np.unique(np.concatenate(h)) for h in ids.values()]
    terms = np.unique(np.concatenate(own)) if own else np.zeros(0, np.uint64)
    return list(ids), terms, [np.searchsorted(terms, h) for h in own]


def matched(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tf) of every row: its term total and its counts of the given terms."""
    kind = docs.schema["doc_id"].dataType
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            offsets, data = string_buffers(batch.column(1))
            for a, b in row_blocks(offsets):
                starts, ends, rows = word_spans(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]], IS_TERM)
                h = span_hashes(data[offsets[a]:offsets[b]], starts, ends)
                at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
                hit = known[at] == h if len(known) else np.zeros(len(h), bool)
                keys, tf = np.unique(rows[hit] * np.int64(len(known) + 1) + at[hit], return_counts=True)
                row, term = np.divmod(keys, np.int64(len(known) + 1))
                cuts = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(np.bincount(rows, minlength=b - a)),
                    pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int64)))], ["doc_id", "n", "terms", "tf"])

    return texts(docs, "doc_id").mapInArrow(
        count, f"doc_id {kind.simpleString()}, n bigint, terms array<int>, tf array<bigint>")


class Heaps:
    """The ``top`` best (score, document) of every item; ties go to the smaller id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top, self.heaps, self.least = top, [[] for _ in range(items)], np.ones(items, np.int64)

    def update(self, scores: np.ndarray, docs: list) -> None:
        """``scores``: documents x items, for the documents ``docs``."""
        for d, i in zip(*map(np.ndarray.tolist, np.nonzero(scores >= self.least))):
            heap, entry = self.heaps[i], (int(scores[d, i]), Reversed(docs[d]))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]


class Reversed:
    """An id whose order is turned round, so that the smaller one is the better; null is the worst."""

    __slots__ = ("id",)

    def __init__(self, id_):
        self.id = id_

    def __lt__(self, other: Reversed) -> bool:
        if self.id is None or other.id is None:
            return self.id is None and other.id is not None
        return self.id > other.id

    def __eq__(self, other: object) -> bool:
        return self.id == other.id


def _streamed(rows: DataFrame, owners: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, top: int,
              id_type: str) -> DataFrame:
    """(item, doc_id, score, merger): each task's heaps after its rows of ``matched``."""
    postings = [[] for _ in weight]
    for item, terms in enumerate(owners):
        for t in terms.tolist():
            postings[t].append(item)
    at = np.concatenate(([0], np.cumsum([len(p) for p in postings]))).astype(np.int64)
    flat = np.array([i for p in postings for i in p], np.int64)
    n_items, most = len(owners), int(max((weight[t].sum() for t in owners), default=0)) * 1_000_000
    exact = most < 1 << 53                       # sums in doubles are then exact
    shared = rows.sparkSession.sparkContext.broadcast((at, flat, weight))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, items, w = shared.value
        heaps, step = Heaps(n_items, top), max(1, CELLS // n_items)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            n = batch.column(1).to_numpy()
            m = np.array([10 + (90 * x * n_docs) // n_terms for x in n.tolist()], dtype=np.int64)
            cuts = batch.column(2).offsets.to_numpy()
            term = batch.column(2).values.to_numpy()
            tf = batch.column(3).values.to_numpy()
            for a in range(0, len(doc_ids), step):
                b = min(len(doc_ids), a + step)
                t, f = term[cuts[a]:cuts[b]], tf[cuts[a]:cuts[b]]
                row = np.repeat(np.arange(b - a), np.diff(cuts[a:b + 1]))
                gain = w[t] * ((1_000_000_000 * f) // (1000 * f + 8 * m[a:b][row]))
                size = first[t + 1] - first[t]
                place = np.repeat(first[t] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                cell = np.repeat(row * n_items, size) + items[place]
                gains = np.repeat(gain, size)
                if exact:
                    scores = np.bincount(cell, gains, (b - a) * n_items).astype(np.int64)
                else:
                    scores = np.zeros((b - a) * n_items, np.int64)
                    np.add.at(scores, cell, gains)
                heaps.update(scores.reshape(b - a, n_items), doc_ids[a:b])
        found = [(i, d.id, s) for i, heap in enumerate(heaps.heaps) for s, d in heap]
        merger = TaskContext.get().partitionId() % MERGERS
        yield pa.RecordBatch.from_arrays([
            pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], batch_type),
            pa.array([x[2] for x in found], pa.int64()), pa.array([merger] * len(found), pa.int32())],
            ["item", "doc_id", "score", "merger"])

    from pyspark.sql.pandas.types import to_arrow_type
    batch_type = to_arrow_type(rows.schema["doc_id"].dataType)
    return rows.mapInArrow(stream, f"item int, doc_id {id_type}, score bigint, merger int")


def _best(heaps: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``top`` best documents of every item: ``item_id, rank, doc_id, score`` (score above 0).

    Terms are maximal runs of ASCII letters, digits and characters from U+0080 in the
    whole text, A-Z lower-cased; they are compared by 64-bit hashes. With N documents
    that have a term, L terms in all, n terms of a document and df documents with a
    term, a term weighs ``floor(1000 ln((2N + 2) / (2 df + 1)))`` and a document scores
    the sum of ``w * (10^9 tf div (1000 tf + 8 m))`` over an item's distinct terms,
    ``m = 10 + 90 n N div L``. Ties go to the smaller ``doc_id``, null last.

    A null or empty text has no term: as a document it is in no result, as an item it
    has none. Rows of ``items`` that share an id (null as well) are one item with the
    terms of all; repeated rows of ``docs`` are ranked each. No documents or no items
    give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    item_type, doc_type = (t.schema[c].dataType.simpleString() for t, c in ((items, "item_id"), (docs, "doc_id")))
    rows = items.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = math.ceil(size / item_bytes)
    results = []
    for block in range(n_blocks):
        mine = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block)
        ids, terms, owners = term_table([tuple(r) for r in mine.collect()])       # bounded: a block of items
        if not len(terms):
            continue
        found = written(matched(docs, terms), "search-counts")
        n_docs, n_terms = found.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
        if not n_terms:
            continue
        df = np.zeros(len(terms), np.int64)
        for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():   # one row a term of the block
            df[r["t"]] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        heaps = _streamed(found, owners, weight, n_docs, n_terms, top, doc_type)
        best = _best(_best(heaps, ["item", "merger"], top).drop("rank"), ["item"], top)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {item_type}")
        results.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score bigint")
    return reduce(DataFrame.union, results)
