"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read once on the driver (its path is a parameter) and sent to
the tasks as bytes: a vocabulary file has a fixed size, well under a few MB.
Long texts are cut at safe boundaries first; every pre-split pattern token ends
there anyway, so the ids are those of the whole text.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from . import kernels as K
from .common import texts

PIECE_CHARS = 1 << 16
MAX_RANK_FILE = 64 << 20

# A letter or digit before a space or line end: no token of the pre-split
# pattern has white space after other characters, so one always ends here.
_SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?=[ \n])")

_encodings: dict[str, tuple] = {}


def read_ranks(path: str) -> bytes:
    """The bytes of a rank file; refuses one too large to send to every task."""
    with open(path, "rb") as f:
        raw = f.read(MAX_RANK_FILE + 1)
    if len(raw) > MAX_RANK_FILE:
        raise ValueError(f"rank file over {MAX_RANK_FILE} bytes: {path}")
    return raw


def encoding(raw: bytes, pattern: str) -> tuple:
    """(tiktoken encoding, token bytes by id), built once per Python worker."""
    key = hashlib.md5(raw + pattern.encode()).hexdigest()
    if key not in _encodings:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) }
        table = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), table
    return _encodings[key]


def pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """``text`` cut at the first safe boundary after every ``limit`` characters."""
    if len(text) <= limit:
        return [text]
    out, at = [], 0
    while len(text) - at > limit:
        cut = _SAFE.search(text, at + limit)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


def encode_text(enc, text: str) -> list[int]:
    if len(text) <= PIECE_CHARS:
        return enc.encode_ordinary(text)
    return [i for p in pieces(text) for i in enc.encode_ordinary(p)]


def _ranks(docs: DataFrame, ranks_path: str) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))


def _encoded(batches: Iterator[pa.RecordBatch], raw: Broadcast, pattern: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids) of batches (doc_id, text)."""
    enc, _ = encoding(raw.value, pattern)
    for batch in batches:
        offsets, _ = K.string_buffers(batch.column("text"))
        for a, b in K.row_blocks(offsets):
            ids = [encode_text(enc, t) for t in batch.column("text").slice(a, b - a).to_pylist()]
            ends = np.cumsum([0] + [len(x) for x in ids], dtype=np.int64)
            flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(ends[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, b - a),
                 pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))],
                names=["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], raw: Broadcast, pattern: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, decoded) of batches (doc_id, ids)."""
    _, table = encoding(raw.value, pattern)
    for batch in batches:
        column = batch.column("ids")
        ends = column.offsets.to_numpy()
        for a in range(0, len(column), 256):
            b = min(a + 256, len(column))
            flat = column.values[int(ends[a]):int(ends[b])].to_pylist()
            at = ends[a:b + 1] - ends[a]
            out = [b"".join(map(table.__getitem__, flat[at[i]:at[i + 1]])) for i in range(b - a)]
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(out, pa.binary())],
                                             names=["doc_id", "ids", "decoded"])


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every whole text, without special tokens.

    A null or empty text has no ids. Rows stay as they are: repeated rows, null
    ids and the order of rows need no care; other columns are not read.
    """
    raw, src = _ranks(docs, ranks_path), texts(docs.select("doc_id", "text"), "doc_id")
    return src.mapInArrow(lambda batches: _encoded(batches, raw, pattern),
                          f"doc_id {dict(src.dtypes)['doc_id']}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``: the raw bytes of the ids, joined."""
    raw, kind = _ranks(encoded, ranks_path), dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: _decoded(batches, raw, pattern), f"doc_id {kind}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, decoded): what ``decode`` makes of the rows of ``encode``, in one pass.

    ``decode(encode(docs))`` takes two Python workers a task, and Spark keeps idle
    workers for the stages that follow; here a task's one worker does both.
    """
    raw, src = _ranks(docs, ranks_path), texts(docs.select("doc_id", "text"), "doc_id")
    return src.mapInArrow(lambda batches: _decoded(_encoded(batches, raw, pattern), raw, pattern),
                          f"doc_id {dict(src.dtypes)['doc_id']}, ids array<int>, decoded binary")
