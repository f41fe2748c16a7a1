"""MinHash near-dedup with sequential Bayesian verification.

1. Every text becomes its set of distinct word shingles (64-bit hashes) and a
   signature of ``N_HASHES`` minima. Equal sets form one *class*.
2. Classes that share a band of the signature are candidates. In each bucket
   every class is first compared with the bucket's smallest one only (linear).
3. A candidate's signatures are compared in batches; it is dropped as soon as
   the posterior probability of a similarity at the threshold falls under
   ``MISS``. Survivors are verified on the full sets.
4. Buckets that then hold more than one component are compared in blocks, but
   only across components: members outside the bucket's largest component
   against all its members. So no link between different components is lost
   and a bucket of linked copies never expands into pairs. Bitmaps of the sets
   bound the similarity from above there, so only pairs that can reach the
   threshold leave the block.
5. Components by contraction: every vertex points to its smallest neighbour,
   pointers are shortened, and the graph of roots is the next round's graph.

Links, components and sets stay in Spark; intermediate tables are written to
the shared checkpoint folder.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import texts, written

BANDS, ROWS = 30, 5            # a pair at 0.8 shares no band with probability 7e-6
N_HASHES = BANDS * ROWS
BATCH = 30                     # signature positions compared at a time
MISS = 1e-6                    # posterior probability below which a pair is dropped
PROBES, TARGETS = 512, 4096    # rows of a block of a mixed bucket
BITMAP = 2048                  # bits of a set's bitmap
_U64 = np.uint64


@functools.cache
def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    i = np.arange(1, N_HASHES + 1, dtype=np.uint64)
    return K.mix64(i) | _U64(1), K.mix64(i + _U64(1 << 40))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), N_HASHES) minima of multiply-shift hashes; empty sets get all ones."""
    a, b = _hash_family()
    out = np.full((len(sets), N_HASHES), 0xFFFFFFFF, dtype=np.uint32)
    full = np.array([i for i, s in enumerate(sets) if len(s)], dtype=np.int64)
    if len(full):
        x = np.concatenate([sets[i] for i in full])
        at = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for j in range(N_HASHES):
            out[full, j] = np.minimum.reduceat((x * a[j] + b[j]) >> _U64(32), at)
    return out


@functools.cache
def needed_matches(threshold: float, miss: float = MISS) -> tuple[int, ...]:
    """Least matches after each batch that keep a pair alive.

    With a uniform prior the posterior after m matches of n is Beta(m+1, n-m+1),
    and P(similarity >= t) = P(Binomial(n+1, t) <= m).
    """
    out = []
    for n in range(BATCH, N_HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def similar_signatures(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Indices of row pairs (x[i], y[i]) that survive every batch."""
    alive = np.arange(len(x))
    matches = np.zeros(len(x), dtype=np.int64)
    for step, least in enumerate(needed_matches(threshold)):
        cols = slice(step * BATCH, (step + 1) * BATCH)
        matches[alive] += (x[alive, cols] == y[alive, cols]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), BITMAP / 64) words; an element sets the bit that its low bits name."""
    out = np.zeros((len(sets), BITMAP // 8), dtype=np.uint8)
    for i, s in enumerate(sets):
        bits = np.zeros(BITMAP, dtype=bool)
        bits[(s & _U64(BITMAP - 1)).astype(np.int64)] = True
        out[i] = np.packbits(bits)
    return out.view(np.uint64)


def can_reach(x_bits: np.ndarray, nx: int, y_bits: np.ndarray, ny: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether set x may be similar enough to each row of y; never false for a pair that is.

    A bit of x that y lacks proves an element of x outside y, and vice versa.
    """
    lacks = np.bitwise_count(x_bits & ~y_bits).sum(axis=1, dtype=np.int64)
    extra = np.bitwise_count(y_bits & ~x_bits).sum(axis=1, dtype=np.int64)
    common = np.minimum(nx - lacks, ny - extra)
    return den * common >= num * (nx + ny - common)


def _set_batches(batches: Iterator[pa.RecordBatch], words: int):
    import xxhash

    for batch in batches:
        offsets, data = K.string_buffers(batch.column("text"))
        for a, b in K.row_blocks(offsets):
            sets = K.distinct_sets(offsets[a:b + 1] - offsets[a], data[offsets[a]:offsets[b]], words)
            keys = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
            yield batch.slice(a, b - a), sets, keys


def document_sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, rk, n_shingles, vid, sig, bits): set size, 128-bit key of the set, signature, bitmap."""
    def run(batches):
        for batch, sets, keys in _set_batches(batches, words):
            sigs = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rk"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(keys, pa.binary()), K.binary_column(list(sigs)), K.binary_column(list(bitmaps(sets)))],
                names=["doc_id", "rk", "n_shingles", "vid", "sig", "bits"])

    src = texts(docs.select("doc_id", "text"), "doc_id").withColumn("rk", F.xxhash64("text"))
    kind = dict(src.dtypes)["doc_id"]
    return src.mapInArrow(run, f"doc_id {kind}, rk bigint, n_shingles bigint, vid binary, sig binary, bits binary")


def _arrays(column: pa.Array, dtype) -> np.ndarray:
    """A (rows, k) array from a binary column whose values have one length."""
    _, data = K.string_buffers(column)
    return data.view(dtype).reshape(len(column), -1)


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Candidate pairs (a, b) that survive the sequential signature test."""
    def run(batches):
        for t in batches:
            if t.num_rows:
                hit = similar_signatures(_arrays(t.column("sa"), np.uint32), _arrays(t.column("sb"), np.uint32), threshold)
                yield t.select(["a", "b"]).take(pa.array(hit))

    sig = classes.select("vid", "sig")
    both = (pairs.join(sig.select(F.col("vid").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("vid").alias("b"), F.col("sig").alias("sb")), "b"))
    return both.mapInArrow(run, "a binary, b binary")


def _needed_sets(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(vid, elements) of the classes named by ``pairs``, from one text of each."""
    def run(batches):
        for _, sets, keys in _set_batches(batches, words):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), K.binary_column(sets)],
                                             names=["vid", "elements"])

    need = (pairs.select(F.col("a").alias("vid")).union(pairs.select("b")).distinct()
            .join(classes.select("vid", "rep.*"), "vid").select("doc_id", "rk"))
    src = texts(docs.select("doc_id", "text"), "doc_id").withColumn("rk", F.xxhash64("text")).alias("d")
    n = need.alias("n")
    src = src.join(n, (F.col("d.rk") == F.col("n.rk")) & F.col("d.doc_id").eqNullSafe(F.col("n.doc_id")), "left_semi")
    return (src.select("text").mapInArrow(run, "vid binary, elements binary")
            .groupBy("vid").agg(F.first("elements").alias("elements")))


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs with den * |intersection| >= num * |union| on the full sets."""
    def run(batches):
        for t in batches:
            hit = []
            for i, (x, y) in enumerate(zip(t.column("ea"), t.column("eb"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if den * min(len(x), len(y)) >= num * max(len(x), len(y)):
                    both = np.concatenate((x, y))
                    both.sort()
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    if den * common >= num * (len(both) - common):
                        hit.append(i)
            yield t.select(["a", "b"]).take(pa.array(hit, pa.int64()))

    both = (pairs.join(sets.select(F.col("vid").alias("a"), F.col("elements").alias("ea")), "a")
            .join(sets.select(F.col("vid").alias("b"), F.col("elements").alias("eb")), "b"))
    return both.mapInArrow(run, "a binary, b binary")


def connected_components(edges: DataFrame) -> DataFrame:
    """(vid, label) for every vertex of ``edges`` (a, b); the label is a vertex of its component."""
    done = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("v", "w")
        parent = written(both.groupBy("v").agg(F.min("w").alias("w"))
                         .select("v", F.least("v", "w").alias("p")), "cc-parent")
        while True:                                   # shorten until every pointer names a root
            up = parent.select(F.col("v").alias("p"), F.col("p").alias("q"))
            new = written(parent.join(up, "p").select("v", F.col("q").alias("p"),
                                                      (F.col("p") != F.col("q")).alias("moved")), "cc-jump")
            parent = new.select("v", "p")
            if not new.where("moved").limit(1).count():
                break
        root = parent.select("v", "p")
        if done is None:
            done = root.toDF("vid", "label")
        else:
            done = done.join(root, F.col("label") == F.col("v"), "left").select(
                "vid", F.coalesce("p", "label").alias("label"))
        edges = written(edges.join(root.toDF("a", "ra"), "a").join(root.toDF("b", "rb"), "b")
                        .where("ra != rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                        .distinct(), "cc-edges")
        if not edges.limit(1).count():
            return written(done, "cc-labels")


def _cross_pairs(members: DataFrame, labels: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """Likely pairs of different components that share a bucket, found block by block."""
    m = members.join(labels, "vid", "left").select("key", "band", "vid", F.coalesce("label", "vid").alias("label"))
    mixed = (m.groupBy("key", "label").count().groupBy("key")
             .agg(F.sum("count").alias("total"), F.max("count").alias("most"),
                  F.max_by("label", F.struct("count", "label")).alias("big"), F.count("*").alias("labels"))
             .where("labels > 1")
             .select("key", "big", F.ceil((F.col("total") - F.col("most")) / PROBES).cast("int").alias("np"),
                     F.ceil(F.col("total") / TARGETS).cast("int").alias("nt")))
    cols = ["key", "band", "vid", "label", "minor", "n_shingles", "sig", "bits"]
    rows = (m.join(mixed, "key").withColumn("minor", F.col("label") != F.col("big"))
            .join(classes.select("vid", "n_shingles", "sig", "bits"), "vid"))
    spread = lambda n, salt: F.pmod(F.xxhash64("vid", F.lit(salt)), F.col(n)).cast("int")
    probes = rows.where("minor").select(*cols, F.lit(True).alias("probe"),
                                               spread("np", 1).alias("pb"), F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("tb"))
    targets = rows.select(*cols, F.lit(False).alias("probe"),
                          F.explode(F.sequence(F.lit(0), F.col("np") - 1)).alias("pb"), spread("nt", 2).alias("tb"))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        is_probe = block["probe"].to_numpy(bool)
        vid, label = block["vid"].to_numpy(), pd.factorize(block["label"].map(bytes))[0]
        sig = np.frombuffer(b"".join(block["sig"]), dtype=np.uint32).reshape(len(block), -1)
        bits = np.frombuffer(b"".join(block["bits"]), dtype=np.uint64).reshape(len(block), -1)
        size, minor, band = block["n_shingles"].to_numpy(), block["minor"].to_numpy(bool), block["band"].iloc[0]
        p, t = np.flatnonzero(is_probe), np.flatnonzero(~is_probe)
        least, found = needed_matches(num / den)[0], []
        for i in p:
            near = t[label[t] != label[i]]
            near = near[~minor[near] | (vid[near] > vid[i])]      # two probes meet once
            near = near[(sig[near, :BATCH] == sig[i, :BATCH]).sum(axis=1) >= least]
            if len(near):
                near = near[similar_signatures(np.broadcast_to(sig[i], (len(near), N_HASHES)), sig[near], num / den)]
                shared = (sig[near].reshape(-1, BANDS, ROWS) == sig[i].reshape(BANDS, ROWS)).all(axis=2)
                near = near[shared.argmax(axis=1) == band]        # a pair counts in its first common band
                near = near[can_reach(bits[i], size[i], bits[near], size[near], num, den)]
                found += [(min(vid[i], vid[j]), max(vid[i], vid[j])) for j in near]
        return pd.DataFrame(found, columns=["a", "b"])

    return (probes.unionByName(targets).groupBy("key", "pb", "tb")
            .applyInPandas(compare, "a binary, b binary").distinct())


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``.

    A text's words are runs without ASCII white space, A-Z lower-cased; its set
    holds the distinct ``words``-word shingles, or the whole sequence if it has
    fewer words. Rows are linked when ``den * |A & B| >= num * |A | B|``;
    ``component_id`` is the smallest ``doc_id`` reachable over links and
    ``kept`` marks the row that carries it (null matches null). A null, empty or
    blank text has an empty set, is linked with nothing and kept. Null ids are
    ignored by the minimum; rows repeating an id and a text share all results.
    An empty table gives no rows; other columns are not read.
    """
    return _components(docs, words, num, den).drop("rk")


def _components(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``near_duplicates`` with ``rk``, the hash of the row's text."""
    sigs = written(document_sets(docs, words), "nd-sigs")
    classes = written(sigs.where("n_shingles > 0").groupBy("vid").agg(
        F.min("doc_id").alias("min_id"), F.min(F.struct("doc_id", "rk")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig"), F.first("bits").alias("bits")), "nd-classes")
    width = 4 * ROWS
    band = (classes.select("vid", "sig", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("j"))
            .select("vid", F.col("j").alias("band"), F.xxhash64("j", F.expr(f"substring(sig, j * {width} + 1, {width})")).alias("key")))
    shared = band.groupBy("key").agg(F.count("*").alias("n"), F.min("vid").alias("leader")).where("n > 1")
    members = written(band.join(shared.select("key", "leader"), "key"), "nd-members")

    star = members.where("vid != leader").select(F.col("vid").alias("a"), F.col("leader").alias("b")).distinct()
    edges, labels = _link(star, classes, docs, words, num, den)
    cross = _cross_pairs(members, labels, classes, num, den)
    more, _ = _link(cross, classes, docs, words, num, den, likely=True, cc=False)
    if more.limit(1).count():
        labels = connected_components(edges.union(more))
    named = classes.select("vid", "min_id").join(labels, "vid", "left").select(
        "vid", "min_id", F.coalesce("label", "vid").alias("label"))
    least = named.groupBy("label").agg(F.min("min_id").alias("least"))
    comp = named.join(least, "label").select("vid", "least")
    return (sigs.select("doc_id", "rk", "n_shingles", "vid").join(comp, "vid", "left")
            .select("doc_id", "rk", "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _link(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, num: int, den: int,
          likely: bool = False, cc: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Verified edges of candidate pairs and, if asked for, the components they form."""
    pairs = written(pairs if likely else _likely(pairs, classes, num / den), "nd-likely")
    sets = written(_needed_sets(pairs, classes, docs, words), "nd-sets")
    edges = written(_verified(pairs, sets, num, den), "nd-edges")
    return edges, connected_components(edges) if cc else None


def drop_near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The row of each component with its smallest ``doc_id``, with all columns of ``docs``.

    Rows that repeat an id with different texts are judged each by its own text.
    """
    kept = _components(docs, words, num, den).where("kept").select(F.col("doc_id").alias("_kept"), F.col("rk").alias("_text")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]) & (own == kept["_text"]), "left_semi")
