"""Language ID with interpolated Kneser-Ney character models, one per language.

Training counts the character ``ORDER``-grams of every training text in Spark;
lower orders count distinct left neighbours (Kneser-Ney continuation counts),
contexts their mass and their distinct successors. Every gram keeps its own
count: the packed grams are their own keys, sorted and looked up by binary
search. The model grows with the distinct grams and goes to the tasks in
broadcast pieces of bounded size; a large one is read piece by piece for each
block of texts, so no task and not the driver holds it whole. A text gets the
language of the lowest cross-entropy per character. Rejection is calibrated on training texts set aside from the counts:
the expected cross-entropy and its spread, which falls with a text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from . import kernels as K
from .common import texts, written

ORDER = 4
PIECE = 1 << 21                # grams a piece of the model holds (up to twice as many)
RESIDENT = 1 << 23             # a model of more grams stays on disk, one piece in memory at a time
FLUSH = 2_000_000              # distinct grams a counting task holds before it emits them
BLOCK = 1 << 20                # bytes of text handled at a time
WIDE_BLOCK = 1 << 23           # the same where the model is read again for each block
CALIBRATION_SHARE = 8          # one training text in so many is set aside to calibrate the rejection
SPARE = 4                      # distinct texts a language must have on either side, else it learns from all
SIGMAS = 8.0
CONFIDENT_CHARS = 50           # a score's evidence is that of at most so many characters

_MASK = [np.uint64((1 << 16 * k) - 1) for k in range(ORDER + 1)]
_fold: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """Code point -> 16-bit symbol: letters lower-cased, everything else a space."""
    global _fold
    if _fold is None:
        t = np.full(0x110000, 32, dtype=np.uint16)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = ord(c.lower()[0])
                t[cp] = low if low < 0x10000 else 0xE000 + low % 0x1900
        _fold = t
    return _fold


def symbols(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, starts) of a block: each row is a space, its folded text, a space; no double spaces."""
    joined = "".join(f" {v} " for v in values)
    c = fold_table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    starts = np.concatenate(([0], np.cumsum([len(v) + 2 for v in values])))[:-1].astype(np.int64)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    keep[starts] = True
    return c[keep], (np.cumsum(keep) - 1)[starts]


def grams(c: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct packed grams, index of each position's gram, starts of rows among the positions).

    Every symbol after a row's first space is predicted from the ``ORDER - 1``
    before it; before the row's start there are spaces.
    """
    if not len(c):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), starts
    lengths = np.diff(np.append(starts, len(c)))
    offset = np.arange(len(c)) - np.repeat(starts, lengths)
    present = np.zeros(1 << 16, dtype=bool)
    present[c] = True
    present[32] = True
    alphabet = np.flatnonzero(present)
    local = np.zeros(1 << 16, dtype=np.int64)
    local[alphabet] = np.arange(len(alphabet))
    columns = []
    for back in range(ORDER - 1, -1, -1):
        x = np.full(len(c), 32, dtype=np.uint16)
        x[back:] = c[:len(c) - back]
        x[offset < back] = 32
        columns.append(x)
    predicted = offset > 0
    if len(alphabet) ** ORDER <= 1 << 24:                     # small alphabets: direct addressing
        code = np.zeros(len(c), dtype=np.int64)
        for x in columns:
            code = code * len(alphabet) + local[x]
        code = code[predicted]
        seen = np.zeros(len(alphabet) ** ORDER, dtype=bool)
        seen[code] = True
        used = np.flatnonzero(seen)
        index = np.empty(len(seen), dtype=np.int32)
        index[used] = np.arange(len(used))
        at, packed = index[code], np.zeros(len(used), dtype=np.uint64)
        for k in range(ORDER):
            digit = used // len(alphabet) ** (ORDER - 1 - k) % len(alphabet)
            packed = packed << np.uint64(16) | alphabet[digit].astype(np.uint64)
    else:
        full = np.zeros(len(c), dtype=np.uint64)
        for x in columns:
            full = full << np.uint64(16) | x
        packed, at = np.unique(full[predicted], return_inverse=True)
    return packed, at, starts - np.arange(len(starts))


def _blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK):
    for batch in batches:
        offsets, _ = K.string_buffers(batch.column("text"))
        for a, b in K.row_blocks(offsets, size):
            yield batch.slice(a, b - a), batch.column("text").slice(a, b - a).to_pylist()


def gram_counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) of all training texts: packed top-order grams and their counts."""
    def merge(parts):
        g = np.concatenate([x for x, _ in parts])
        n = np.concatenate([y for _, y in parts])
        u, at = np.unique(g, return_inverse=True)
        return u, np.bincount(at, weights=n, minlength=len(u)).astype(np.int64)

    def run(batches):
        held: dict[str, list] = {}

        def emit():
            for lang, parts in held.items():
                u, n = merge(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u.view(np.int64)), pa.array(n)],
                                                 names=["lang", "gram", "n"])
            held.clear()

        for rows, values in _blocks(batches):
            langs = pd.Series(rows.column("lang").to_pylist())
            for lang, own in langs.groupby(langs).groups.items():
                packed, at, _ = grams(*symbols([values[i] for i in own]))
                held.setdefault(lang, []).append((packed, np.bincount(at, minlength=len(packed))))
                if len(held[lang]) > 8:
                    held[lang] = [merge(held[lang])]
            if sum(len(x) for parts in held.values() for x, _ in parts) > FLUSH:
                yield from emit()
        yield from emit()

    src = texts(train, "lang")
    return src.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model_cells(counts: DataFrame) -> DataFrame:
    """(lang, kind, ord, gram, n, types): the model's counts, a row for each gram.

    Kind 0 has grams, kind 1 contexts (``n`` their mass, ``types`` their
    distinct successors).
    """
    tables, table = [], counts
    for k in range(ORDER, 0, -1):
        tables.append(table.select("lang", F.lit(0).alias("kind"), F.lit(k).alias("ord"), "gram", "n", F.lit(1).cast("long").alias("types")))
        context = F.expr("shiftrightunsigned(gram, 16)")
        tables.append(table.select("lang", F.lit(1).alias("kind"), F.lit(k).alias("ord"), context.alias("gram"), "n", F.lit(1).cast("long").alias("types"))
                      .groupBy("lang", "kind", "ord", "gram").agg(F.sum("n").alias("n"), F.sum("types").alias("types")))
        table = table.select("lang", F.col("gram").bitwiseAND(F.lit(int(_MASK[k - 1]))).alias("gram")).groupBy("lang", "gram").agg(F.count("*").alias("n"))
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    return every


class Model:
    """Sorted grams per language and order, in pieces; ``log_probs`` scores packed grams.

    A piece is a list of (key, grams, counts, successors); ``add`` fills the last
    one and ``send`` makes it a broadcast.
    """

    def __init__(self, langs: list[str]):
        self.langs = sorted(langs, key=lambda s: s.encode())
        self.open: list[tuple] = []
        self.sent: list = []
        self.where: dict[tuple, list[int]] = {}          # numbers of the pieces that have a key's grams
        self.rare: dict[tuple, tuple[int, int]] = {}     # how many grams count 1 and 2
        self.grams = self.filled = 0
        self.at: int | None = None
        self.resident = True
        self.reject: dict[str, tuple[float, float, float]] = {}

    def add(self, lang: str, kind: int, order: int, cells: pd.DataFrame) -> None:
        """Store counts of one language, kind and order (columns of ``model_cells``), all of them or a share."""
        key, gram = (lang, kind, order), cells["gram"].to_numpy(np.int64).view(np.uint64)
        by, n = np.argsort(gram), cells["n"].to_numpy(np.int64)
        self.open.append((key, gram[by], n[by].astype(np.float32), cells["types"].to_numpy(np.float32)[by] if kind else None))
        if len(self.sent) not in self.where.setdefault(key, []):
            self.where[key].append(len(self.sent))
        if kind == 0:
            one, two = self.rare.get((lang, order), (0, 0))
            self.rare[lang, order] = one + int((n == 1).sum()), two + int((n == 2).sum())
        self.grams += len(gram)
        self.filled += len(gram)

    def send(self, sc) -> None:
        """Hand the last piece to the tasks."""
        if self.open:
            self.sent.append(sc.broadcast(self.open))
        self.open, self.filled, self.resident = [], 0, self.grams <= RESIDENT

    def block_bytes(self) -> int:
        return BLOCK if self.resident else WIDE_BLOCK

    def _piece(self, i: int) -> list[tuple]:
        if i == len(self.sent):
            return self.open
        if self.at not in (None, i) and not self.resident:
            vars(self.sent[self.at]).pop("_value", None)  # the broadcast's file stays
        self.at = i
        return self.sent[i].value

    def _find(self, key: tuple, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, successors) of packed grams, 0 where the key has no such gram."""
        n, types = np.zeros(len(packed), np.float32), np.zeros(len(packed), np.float32)
        for i in self.where.get(key, ()):
            for own, gram, count, after in self._piece(i):
                if own == key and len(gram):
                    at = np.minimum(np.searchsorted(gram, packed), len(gram) - 1)
                    hit = gram[at] == packed
                    n[hit] = count[at[hit]]
                    if after is not None:
                        types[hit] = after[at[hit]]
        return n, types

    def log_probs(self, packed: np.ndarray, langs: list[str] | None = None) -> np.ndarray:
        """(languages, grams) natural logarithms of p(last symbol | the ones before it)."""
        langs = self.langs if langs is None else langs
        out = np.empty((len(langs), len(packed)), dtype=np.float32)
        grams_ = [packed & _MASK[k] for k in range(ORDER + 1)]
        for i, lang in enumerate(langs):
            p = np.full(len(packed), 1 / 65536)
            for k in range(1, ORDER + 1):
                one, two = self.rare.get((lang, k), (0, 0))
                d = one / (one + 2 * two) if one else 0.5
                n, _ = self._find((lang, 0, k), grams_[k])
                total, types = self._find((lang, 1, k), grams_[k] >> np.uint64(16))
                known = total > 0
                safe = np.where(known, total, 1)
                p = np.where(known, (np.maximum(n - d, 0) + d * types * p) / safe, p)
            out[i] = np.log(p)
        return out


def load_model(cells: DataFrame) -> Model | None:
    """The model of a written ``model_cells`` table, sent to the tasks in pieces; None of an empty one."""
    parts = cells.groupBy("lang", "ord", "kind").count().collect()       # eight rows a language
    if not parts:
        return None
    model = Model(list({r["lang"] for r in parts}))
    sizes = {lang: {} for lang in model.langs}
    for r in parts:
        sizes[r["lang"]][r["ord"], r["kind"]] = r["count"]
    sc, small = cells.sparkSession.sparkContext, []

    def fetch():
        if small:                                 # languages of at most PIECE grams together, read at once
            rows = cells.where(F.col("lang").isin(small)).toPandas()
            for (lang, order, kind), own in rows.groupby(["lang", "ord", "kind"]):
                model.add(lang, kind, order, own)
            small.clear()
        if model.filled >= PIECE:
            model.send(sc)

    for lang, own in sizes.items():
        if sum(map(sum, (own.values(), *(sizes[x].values() for x in small)))) > PIECE:
            fetch()
        if sum(own.values()) <= PIECE:
            small.append(lang)
            continue
        for (order, kind), count in sorted(own.items()):
            rows, shares = cells.where((F.col("lang") == lang) & (F.col("ord") == order) & (F.col("kind") == kind)), -(-count // PIECE)
            for i in range(shares):
                share = rows.where(F.pmod(F.xxhash64("gram"), F.lit(shares)) == i) if shares > 1 else rows
                model.add(lang, kind, order, share.select("gram", "n", "types").toPandas())
                fetch()
    fetch()
    model.send(sc)
    return model


def _scores(model: Model, values: list[str], langs: list[str] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cross-entropies (rows, languages), their per-symbol variances, symbols, whether a letter is there)."""
    c, starts = symbols(values)
    packed, at, first = grams(c, starts)
    lengths = np.diff(np.append(first, len(at)))
    log_p = model.log_probs(packed, langs)
    sums = [np.add.reduceat(lp[at].astype(np.float64), first) for lp in log_p]
    squares = [np.add.reduceat((lp * lp)[at].astype(np.float64), first) for lp in log_p]
    ce = -np.stack(sums, axis=1) / lengths[:, None]
    var = np.maximum(np.stack(squares, axis=1) / lengths[:, None] - ce**2, 0)
    letters = np.add.reduceat((c != 32).astype(np.int64), starts) > 0
    return ce, var, lengths, letters


def _learn(rows: DataFrame) -> Model | None:
    counts = written(gram_counts(rows), "lid-counts")
    return load_model(written(model_cells(counts).repartitionByRange("lang", "kind", "ord", "gram"), "lid-cells"))


def _fit(model: Model, unseen: DataFrame) -> DataFrame:
    """(lang, w, ce, sq, var) of rows (text, lang, by): sums over each language's texts under the model ``by``."""
    def run(batches):
        for rows, values in _blocks(batches, model.block_bytes()):
            keys = pd.DataFrame({c: rows.column(c).to_pylist() for c in ("lang", "by")})
            for (lang, by), own in keys.groupby(["lang", "by"]).groups.items():
                if by in model.langs:
                    ce, var, lengths, letters = _scores(model, [values[i] for i in own], [by])
                    yield pa.RecordBatch.from_pandas(pd.DataFrame({
                        "lang": lang, "ce": ce[:, 0], "var": var[:, 0], "len": lengths.astype(float)})[letters], preserve_index=False)

    seen = texts(unseen, "lang", "by").mapInArrow(run, "lang string, ce double, var double, len double")
    return seen.groupBy("lang").agg(F.sum("len").alias("w"), F.sum(F.col("ce") * F.col("len")).alias("ce"),
                                    F.sum(F.col("ce") * F.col("ce") * F.col("len")).alias("sq"),
                                    F.sum(F.col("var") * F.col("len")).alias("var"))


def train_model(train: DataFrame) -> Model | None:
    """The model of rows (text, lang), lang non-null; None if there are none.

    One distinct text in ``CALIBRATION_SHARE`` is set aside, and all of these
    calibrate the rejection. A language with fewer than ``SPARE`` of them, or
    fewer left to learn from, learns from all its texts; two models of half its
    distinct texts each are calibrated on the other half instead. A language of
    one distinct text takes the loosest limits of the others.
    """
    rows = train.where(F.col("text").rlike(r"\p{L}")).withColumn("_h", F.xxhash64("text"))
    aside = F.pmod(F.col("_h"), F.lit(CALIBRATION_SHARE)) == 0
    distinct = written(rows.select("lang", "_h").distinct(), "lid-texts")
    sides = distinct.groupBy("lang").agg(F.count_if(aside).alias("aside"), F.count_if(~aside).alias("left")).collect()   # one row a language
    few = [r["lang"] for r in sides if min(r["aside"], r["left"]) < SPARE]
    model = _learn(rows.where(~aside | F.col("lang").isin(few)))
    if model is None:
        return None
    stats = _fit(model, rows.where(aside & ~F.col("lang").isin(few)).withColumn("by", F.col("lang"))).collect()
    if few:
        place = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
        halves = distinct.where(F.col("lang").isin(few)).withColumn("half", place % 2)
        own = rows.join(F.broadcast(halves), ["lang", "_h"])
        trial = _learn(own.withColumn("lang", F.concat((1 - F.col("half")).cast("string"), "lang")))
        if trial is not None:
            stats += _fit(trial, own.withColumn("by", F.concat(F.col("half").cast("string"), "lang"))).collect()
    for r in stats:                              # one row a language
        mu = r["ce"] / r["w"]
        model.reject[r["lang"]] = (mu, max(r["sq"] / r["w"] - mu**2, 0.0) ** 0.5, (r["var"] / r["w"]) ** 0.5)
    if model.reject:
        loosest = tuple(map(max, zip(*model.reject.values(), strict=True)))
        for lang in model.langs:
            model.reject.setdefault(lang, loosest)
    return model


def _marked(docs: DataFrame, training: Column, carry: list[str]) -> DataFrame:
    """Columns ``carry`` of every row, with ``_pred, _score, _entropy, _rejected``."""
    model = train_model(docs.where(training & F.col("lang").isNotNull()).select("text", "lang"))
    src = texts(docs, *[c for c in carry if c != "text"])
    own = src.select(*[F.col(c) for c in carry]).schema

    def run(batches):
        m = model
        for rows, values in _blocks(batches, m.block_bytes() if m else BLOCK):
            n = len(values)
            pred, score = np.full(n, "und", dtype=object), np.zeros(n)
            entropy, rejected = np.full(n, np.nan), np.zeros(n, dtype=bool)
            if m is None:
                rejected[:] = [not any(map(str.isalpha, v)) for v in values]
            else:
                ce, _, lengths, letters = _scores(m, values)
                best = ce.argmin(axis=1)
                evidence = (ce - ce.min(axis=1)[:, None]) * np.minimum(lengths, CONFIDENT_CHARS)[:, None]
                score = np.where(letters, 1 / np.exp(-evidence).sum(axis=1), 0.0)
                entropy = np.where(letters, ce.min(axis=1), np.nan)
                limit = np.full((len(m.langs), 3), np.inf)
                for lang, x in m.reject.items():
                    limit[m.langs.index(lang)] = x
                mu, spread, one = limit[best].T
                rejected = ~letters | (entropy > mu + SIGMAS * (spread + one / np.sqrt(lengths)))
                pred = np.where(letters, np.array(m.langs, dtype=object)[best], "und")
            yield pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in carry], pa.array(pred.tolist(), pa.string()), pa.array(score),
                 pa.array(entropy, from_pandas=True), pa.array(rejected)],
                names=[*carry, "_pred", "_score", "_entropy", "_rejected"])

    schema = StructType([*own.fields, StructField("_pred", StringType()), StructField("_score", DoubleType()),
                         StructField("_entropy", DoubleType()), StructField("_rejected", BooleanType())])
    return src.mapInArrow(run, schema)


def identify(docs: DataFrame, training: Column) -> DataFrame:
    """Per row: ``doc_id, lang_pred, score, cross_entropy, rejected``.

    The models learn from the rows for which ``training`` holds and ``lang`` is
    not null; ``lang`` is read nowhere else. A null text, one without letters,
    and every text where no language was learned get ``und`` and score 0. The
    score (0 to 1) is the posterior of the predicted language, equal priors,
    from at most ``CONFIDENT_CHARS`` symbols' evidence. Ties go to the language
    first in code-point order. ``rejected`` marks texts without letters and
    texts that fit the predicted language worse than its training texts do
    (``SIGMAS`` spreads). Rows stay one to one; repeated rows agree; other
    columns are not read.
    """
    return _marked(docs, training, ["doc_id"]).select(
        "doc_id", F.col("_pred").alias("lang_pred"), F.col("_score").alias("score"),
        F.col("_entropy").alias("cross_entropy"), F.col("_rejected").alias("rejected"))


def fold(modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus)) == remainder, F.lit(False))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows whose text is not rejected, all columns kept."""
    return _marked(docs, ~fold(4, 2), docs.columns).where("NOT _rejected").select(*docs.columns)
