"""Text lines with their place: ``value`` and a sortable ``seq``.

``seq`` is the number of the file shifted by 40 bits plus the byte at which the
line starts, one bigint as the patterns and the upsert table take it, in batch and
in a stream. Files are cut into byte ranges that are read apart; a line belongs to
the range it starts in, so order holds across the ranges of a large file.

A stream keeps a log of the files it has found, one entry a trigger that found
some, in a folder of its own. Offsets count entries, so a replay or a restart reads
the same ranges under the same numbers, whatever has come or grown since.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..session import ship_package

POSITION_BITS = 40          # a file of up to 1 TiB; 2^23 files
RANGE_BYTES = 64 << 20
CHUNK = 4 << 20


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def list_files(path: str, order: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files of a folder (or of one file), by ``name`` or by ``time`` and name.

    Names that begin with ``_`` or ``.`` are left out, as Spark's readers do.
    """
    files, root = _filesystem(path)
    info = files.get_file_info(root)
    if info.type == pafs.FileType.File:
        found = [info]
    else:
        found = [f for f in files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
                 if f.type == pafs.FileType.File and not any(p[:1] in "_." for p in f.path[len(root):].split("/") if p)]
    found.sort(key=(lambda f: (f.mtime_ns, f.path)) if order == "time" else (lambda f: f.path))
    return [(f.path, f.size) for f in found]


class Range(InputPartition):
    def __init__(self, number: int, path: str, start: int, end: int):
        self.number, self.path, self.start, self.end = number, path, start, end


def ranges(files: list[tuple[int, str, int]], size: int) -> list[Range]:
    """Byte ranges of at most ``size`` of the files (number, path, bytes)."""
    return [Range(n, path, a, min(a + size, total)) for n, path, total in files for a in range(0, total, size)]


def read_range(root: str, part: Range):
    """Record batches (value, seq) of the lines that start in a range.

    Lines end at a line feed, a carriage return before it is dropped; the last line
    of a file needs none. Bytes that are not UTF-8 become replacement characters.
    """
    at, carry, skip = max(part.start - 1, 0), b"", part.start > 0
    with _filesystem(root)[0].open_input_file(part.path) as f:
        f.seek(at)
        while at < part.end:
            block = f.read(max(CHUNK, len(carry)))        # a line longer than that doubles the next read
            data = carry + block
            if skip:
                cut = data.find(b"\n") + 1
                if not cut:
                    if not block:
                        return
                    at, carry = at + len(data), b""
                    continue
                data, at, skip = data[cut:], at + cut, False
            lines = data.split(b"\n")
            carry = lines.pop()
            starts = at + np.cumsum([0] + [len(x) + 1 for x in lines], dtype=np.int64)
            at = int(starts[-1])
            if not block and carry:
                lines, starts, carry = [*lines, carry], np.append(starts, at + len(carry)), b""
            keep = int(np.searchsorted(starts[:-1], part.end))
            if keep:
                text = [(x[:-1] if x.endswith(b"\r") else x).decode(errors="replace") for x in lines[:keep]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(text, pa.string()), pa.array((part.number << POSITION_BITS) + starts[:keep])], names=["value", "seq"])
            if not block or keep < len(lines):
                return


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.order = options["path"], options.get("order", "name")
        self.size = int(options.get("range_bytes", RANGE_BYTES))

    def partitions(self):
        found = [(n, path, size) for n, (path, size) in enumerate(list_files(self.path, self.order))]
        return ranges(found, self.size) or [Range(0, "", 0, 0)]

    def read(self, part):
        if part.end > part.start:
            yield from read_range(self.path, part)


class _Stream(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.order, self.log = options["path"], options.get("order", "name"), options["log"]
        self.size = int(options.get("range_bytes", RANGE_BYTES))
        self.entries: list[list] | None = None          # what the log holds: [number, path, bytes] of every file

    def _entry(self, i: int) -> str:
        return f"{_filesystem(self.log)[1]}/{i:012d}.json"

    def _load(self) -> list[list]:
        if self.entries is None:
            files, root = _filesystem(self.log)
            files.create_dir(root, recursive=True)
            names = [f.path for f in files.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".json")]
            self.entries = []
            for name in sorted(names):
                with files.open_input_file(name) as f:
                    self.entries.append(json.loads(f.read()))
        return self.entries

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        entries = self._load()
        known = {path for e in entries for _, path, _ in e}
        new = [(path, size) for path, size in list_files(self.path, self.order) if path not in known]
        if new:
            entry = [[len(known) + i, path, size] for i, (path, size) in enumerate(new)]
            files, name = _filesystem(self.log)[0], self._entry(len(entries))
            with files.open_output_stream(f"{name}.tmp") as f:
                f.write(json.dumps(entry).encode())
            files.move(f"{name}.tmp", name)
            entries.append(entry)
        return {"entries": len(entries)}

    def partitions(self, start: dict, end: dict):
        found = [tuple(f) for e in self._load()[start["entries"]:end["entries"]] for f in e]
        return ranges(found, self.size) or [Range(0, "", 0, 0)]

    def read(self, part):
        if part.end > part.start:
            yield from read_range(self.path, part)

    def commit(self, end: dict) -> None:
        pass


class PositionedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "eventide_lines"

    def schema(self) -> str:
        return "value string, seq bigint"

    def reader(self, schema):
        return _Batch(dict(self.options))

    def streamReader(self, schema):
        return _Stream(dict(self.options))


def read_positioned_lines(spark: SparkSession, path: str, stream: bool = False, log: str | None = None,
                          order: str = "name", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines of the files under ``path`` as ``value`` with a bigint ``seq``: (file number, byte position).

    Files are numbered by ``order`` (``name`` or ``time``); a stream numbers the files
    that it finds together so, after all it found before, and keeps their numbers in
    the shared folder ``log``. Files must be whole when they appear. Empty files have
    no lines; an empty or missing folder gives none.
    """
    if stream and log is None:
        raise ValueError("a stream of positioned lines needs a folder for its log")
    if order not in ("name", "time"):
        raise ValueError(f"order must be name or time, not {order!r}")
    ship_package(spark)
    spark.dataSource.register(PositionedLines)
    r = (spark.readStream if stream else spark.read).format(PositionedLines.name()).option("order", order)
    r = r.option("range_bytes", str(range_bytes))
    return (r.option("log", log) if log else r).load(path)
