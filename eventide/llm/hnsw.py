"""Approximate nearest neighbours: a navigable small-world graph per shard, merged results.

Equal vectors are one node that carries their smallest ids, enough for any
top-k, so copies neither crowd the graph nor the results. Inner product becomes
cosine by one extra coordinate (``sqrt(m^2 - |x|^2)``, m the largest norm). A
shard of about ``SHARD_ROWS`` nodes is built in batches: each batch searches the
graph so far, links to a diverse choice of what it found and of its own members.
The index is a table, one row per node, with flat neighbour arrays; queries meet
it in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import written

M = 16                 # links of a new node; twice as many may end at one on the ground level
EF_BUILD = 64          # candidates kept while building
EF_SEARCH = 128        # and while searching
WIDTH = 4              # nodes of a beam that are opened together
BATCH = 256            # nodes inserted, or queries searched, together
SHARD_ROWS = 4096
QUERY_BLOCK = 2048


def _similar(x: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner products of each row's query with the nodes in ``ids`` (-1: none, -inf)."""
    return np.where(ids >= 0, np.einsum("qd,qkd->qk", q, x[ids]), -np.inf)


def _top(ids: np.ndarray, sims: np.ndarray, k: int, *more: np.ndarray) -> list[np.ndarray]:
    """The k best of every row, best first, of (ids, sims, *more)."""
    order = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    return [np.take_along_axis(a, order, axis=1) for a in (ids, sims, *more)]


def search_layer(x: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int, links: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of many queries at once: (ids, similarities), best first, -1 padded."""
    n_q = len(q)
    seen = np.zeros((n_q, len(x) + 1), dtype=bool)       # the last column takes the padding
    row = np.arange(n_q)[:, None]
    seen[row, entry] = True
    ids = np.full((n_q, ef), -1, dtype=np.int64)
    ids[:, :entry.shape[1]] = entry
    sims = _similar(x, q, ids)
    opened = ids < 0
    while True:
        active = np.flatnonzero(~opened.all(axis=1))
        if not len(active):
            return ids, sims
        ready = np.where(opened[active], -np.inf, sims[active])
        pick = np.argsort(-ready, axis=1, kind="stable")[:, :WIDTH]
        real = np.take_along_axis(~opened[active], pick, axis=1)
        node = np.where(real, np.take_along_axis(ids[active], pick, axis=1), -1)
        opened[active[:, None], pick] = True
        near = np.where((node >= 0)[:, :, None], links[node], -1).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[active[:, None], near]] = -1
        seen[active[:, None], near] = True
        seen[:, -1] = False
        both = np.concatenate((ids[active], near), axis=1)
        both_sims = np.concatenate((sims[active], _similar(x, q[active], near)), axis=1)
        done = np.concatenate((opened[active], near < 0), axis=1)
        ids[active], sims[active], opened[active] = _top(both, both_sims, ef, done)


def diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
    """k links per row: those nearer to the node than to a link taken before, then the nearest left."""
    ids, sims = _top(ids, sims, ids.shape[1])
    out = np.full((len(ids), k), -1, dtype=np.int64)
    for a in range(0, len(ids), BATCH):
        i, s = ids[a:a + BATCH], sims[a:a + BATCH]
        v = x[i]
        among = np.einsum("mcd,med->mce", v, v)
        taken = np.zeros(i.shape, dtype=bool)
        for c in range(i.shape[1]):
            clear = (~taken[:, :c] | (among[:, c, :c] < s[:, c, None])).all(axis=1)
            taken[:, c] = clear & (i[:, c] >= 0) & (taken[:, :c].sum(axis=1) < k)
        rank = np.where(taken, 2.0, 0.0) + (i >= 0)
        order = np.argsort(-rank, axis=1, kind="stable")[:, :k]
        out[a:a + BATCH, :order.shape[1]] = np.take_along_axis(i, order, axis=1)
    return out


class Graph:
    """Neighbour arrays per level; node numbers are row numbers of ``x`` (unit vectors)."""

    def __init__(self, x: np.ndarray, levels: np.ndarray):
        self.x, self.levels = x, levels
        top = int(levels.max()) if len(levels) else 0
        self.links = [np.full((len(x), 2 * M if level == 0 else M), -1, dtype=np.int64) for level in range(top + 1)]
        self.entry, self.entry_level = -1, -1

    def build(self) -> Graph:
        at = 0
        while at < len(self.x):
            size = min(BATCH, max(32, at))
            self._insert(np.arange(at, min(at + size, len(self.x))))
            at += size
        return self

    def _insert(self, nodes: np.ndarray) -> None:
        x, entry = self.x, np.full((len(nodes), 1), self.entry)
        for level in range(int(max(self.levels[nodes].max(), self.entry_level)), -1, -1):
            here = self.levels[nodes] >= level
            found = np.full((len(nodes), 1), -1)
            if level <= self.entry_level:
                found, sims = search_layer(x, x[nodes], entry, EF_BUILD if here.any() else 1, self.links[level])
                entry = found[:, :1]
            if not here.any():
                continue
            own = nodes[here]
            peers = np.broadcast_to(own, (len(own), len(own))).copy()
            np.fill_diagonal(peers, -1)
            ids = np.concatenate((found[here], peers), axis=1)
            ids, sims = _top(ids, _similar(x, x[own], ids), EF_BUILD)
            chosen = diverse(x, ids, sims, M)
            self.links[level][own, :M] = chosen
            self._back(level, own, chosen)
        best = int(nodes[np.argmax(self.levels[nodes])])
        if self.levels[best] > self.entry_level:
            self.entry, self.entry_level = best, int(self.levels[best])

    def _back(self, level: int, own: np.ndarray, chosen: np.ndarray) -> None:
        """Add the reverse of the new links; nodes with too many choose again."""
        links, cap = self.links[level], self.links[level].shape[1]
        to, frm = chosen.ravel(), np.repeat(own, chosen.shape[1])
        to, frm = to[to >= 0], frm[to >= 0]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        target, first, count = np.unique(to, return_index=True, return_counts=True)
        wide = np.full((len(target), cap + int(count.max(initial=0))), -1, dtype=np.int64)
        wide[:, :cap] = links[target]
        slot = np.arange(len(to)) - np.repeat(first, count)
        wide[np.repeat(np.arange(len(target)), count), cap + slot] = frm
        wide.sort(axis=1)
        wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
        wide = -np.sort(-wide, axis=1)
        full = (wide >= 0).sum(axis=1) > cap
        links[target[~full]] = wide[~full, :cap]
        if full.any():
            again = target[full]
            links[again] = diverse(self.x, wide[full], _similar(self.x, self.x[again], wide[full]), cap)

    def search(self, q: np.ndarray, k: int, ef: int = EF_SEARCH) -> np.ndarray:
        """(queries, at least k or all) node numbers, nearest first, -1 padded."""
        out = []
        ef = max(ef, k)
        for a in range(0, len(q), BATCH):
            part, entry = q[a:a + BATCH], np.full((len(q[a:a + BATCH]), 1), self.entry)
            for level in range(self.entry_level, 0, -1):
                entry = search_layer(self.x, part, entry, 1, self.links[level])[0]
            out.append(search_layer(self.x, part, entry, ef, self.links[0])[0])
        return np.concatenate(out)


def _unit(v: np.ndarray, norm: float) -> np.ndarray:
    """Vectors of length 1 whose inner products order as those of ``v`` do."""
    v = v / norm
    rest = np.sqrt(np.maximum(1 - (v * v).sum(axis=1), 0))
    return np.hstack([v, rest[:, None]]).astype(np.float32)


def valid(vectors: DataFrame) -> DataFrame:
    """Rows with an id and a vector of finite components that is not zero."""
    e = F.col("embedding")
    finite = F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & e.isNotNull() & finite
                                                         & F.exists(e, lambda c: c != 0))
            .withColumn("dim", F.size(e)))


def _nodes(rows: DataFrame, k: int) -> DataFrame:
    """(dim, embedding, ids): distinct vectors with their k + 1 smallest ids."""
    first = Window.partitionBy("embedding").orderBy("vec_id")
    return (rows.distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
            .groupBy("dim", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))


def build_index(vectors: DataFrame, k: int) -> tuple[DataFrame, int, float]:
    """(index, shards, largest norm): one row per distinct vector, links within its shard.

    Columns: dim, shard, node, level, embedding, ids, ground (links of level 0)
    and upper (links of levels 1 and up). Every valid row is indexed.
    """
    ship_package(vectors.sparkSession)
    rows = valid(vectors)
    nodes = written(_nodes(rows, k), "hnsw-nodes")
    n, square = nodes.agg(F.count("*"), F.max(F.aggregate(
        "embedding", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))).first()
    shards, norm = max(1, math.ceil(n / SHARD_ROWS)), math.sqrt(square or 1.0)
    key = F.xxhash64("embedding")
    nodes = nodes.withColumn("shard", F.pmod(key, F.lit(shards)).cast("int")).withColumn("order", key)

    def make(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("order", kind="stable").reset_index(drop=True)
        x = _unit(np.stack(shard["embedding"]).astype(np.float64), norm)
        draw = np.random.default_rng(len(x)).random(len(x))
        graph = Graph(x, np.minimum((-np.log(1 - draw) / math.log(M)).astype(np.int64), 8)).build()
        flat = lambda a: a[a >= 0].tolist()
        return pd.DataFrame({
            "dim": shard["dim"], "shard": shard["shard"], "node": np.arange(len(x)), "level": graph.levels,
            "embedding": shard["embedding"], "ids": shard["ids"],
            "ground": [flat(a) for a in graph.links[0]],
            "upper": [[flat(up[i]) for up in graph.links[1:graph.levels[i] + 1]] for i in range(len(x))]})

    kind = dict(nodes.dtypes)
    index = nodes.groupBy("dim", "shard").applyInPandas(
        make, f"dim int, shard int, node int, level int, embedding {kind['embedding']}, ids array<bigint>, "
              "ground array<int>, upper array<array<int>>")
    return written(index, "hnsw-index"), shards, norm


def _load(rows: pd.DataFrame, norm: float) -> tuple[Graph, np.ndarray, list]:
    rows = rows.sort_values("node").reset_index(drop=True)
    v = np.stack(rows["embedding"]).astype(np.float64)
    graph = Graph(_unit(v, norm), rows["level"].to_numpy())
    for i, own in enumerate(rows["ground"]):
        graph.links[0][i, :len(own)] = own
    for i, upper in enumerate(rows["upper"]):
        for level, own in enumerate(upper, 1):
            graph.links[level][i, :len(own)] = own
    if len(rows):
        graph.entry = int(np.argmax(graph.levels))
        graph.entry_level = int(graph.levels[graph.entry])
    return graph, v, rows["ids"].tolist()


def search(vectors: DataFrame, queries: Column, k: int = 20) -> DataFrame:
    """Per query the k nearest found: ``query_id, rank, vec_id, score``.

    Queries are the valid rows for which ``queries`` holds; candidates all valid
    rows of the same dimension whose id differs. ``score`` is the inner product
    in double precision; ties go to the smaller ``vec_id``. Vectors that are null
    or zero or hold null or non-finite components, and rows without an id, take
    no part; repeated rows count once. Without other rows a query has no result.
    """
    index, shards, norm = build_index(vectors, k)
    asked = written(valid(vectors).where(queries).distinct(), "hnsw-queries")
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def find(nodes: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(nodes) and len(block):
            graph, v, ids = _load(nodes, norm)
            q = np.stack(block["embedding"]).astype(np.float64)
            unit = q / np.sqrt((q * q).sum(axis=1))[:, None]
            hits = graph.search(np.hstack([unit, np.zeros((len(q), 1))]).astype(np.float32), k + 1)
            for own, vec, near in zip(block["vec_id"], q, hits, strict=True):
                near = near[near >= 0]
                scores = (v[near] * vec).sum(axis=1)
                best = [(-s, i) for s, n in zip(scores.tolist(), near, strict=True) for i in ids[n] if i != own]
                out += [(own, i, -s) for s, i in sorted(best)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = (left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim", "shard", "block"))
             .applyInPandas(find, "query_id bigint, vec_id bigint, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", rank)
    return best.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
