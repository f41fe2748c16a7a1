"""Streaming ETL with a refreshing dimension (J1 stream form, S4).

The dimension is re-read at the start of every micro-batch instead of being
bound into the plan: a plan-bound file scan fails once the dimension files
are replaced, and a bound snapshot would never change. What a micro-batch used
is published as a version in the shared folder, so a replay looks up the same
rows as the first run and a restart goes on from the last version.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.json import to_json_text
from ..operators.enrich import explode_enrich
from ..session import drop_folder, finished_ids, scratch_path
from ..sources.lines import write_lines

NO_VERSION = -1


class DimensionSnapshot:
    """A dimension in published versions: ``load`` is read once a micro-batch, the last non-empty rows hold.

    Folders under ``path`` (on storage that driver and executors share; keep it with
    the stream's checkpoint): ``version=<id>``, the rows that micro-batch ``<id>``
    found new, and ``used/batch=<id>``, the version that micro-batch looked up with.

    * A replayed micro-batch takes the version of its first run and does not load.
    * An empty load keeps the version before (only non-empty maps are published);
      so does one that fails, with a warning. A load that fails before any version
      was published is raised.
    * Rows equal to the version before (same count and sum of row hashes) are not
      written again.

    Without ``path`` a fresh scratch folder is taken, which no restart will find.
    """

    def __init__(self, load: Callable[[SparkSession], DataFrame], path: str | None = None):
        self.load, self.path = load, path

    def at(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The rows micro-batch ``batch_id`` looks up in; None before the first non-empty load."""
        self.path = self.path or scratch_path(spark, "dimension")
        ids = finished_ids(spark, f"{self.path}/used", "batch")
        if batch_id in ids:
            return self._version(spark, self._used(spark, batch_id)["version"])
        before = [i for i in ids if i < batch_id]
        last = self._used(spark, before[-1]) if before else {"version": NO_VERSION, "n": 0, "h": None}
        found = self._load(spark, batch_id, last)
        (spark.range(1).select(F.lit(found["version"]).cast("bigint").alias("version"), F.lit(found["n"]).cast("bigint").alias("n"),
                               F.lit(found["h"]).cast("decimal(38,0)").alias("h"))
         .write.mode("overwrite").parquet(f"{self.path}/used/batch={batch_id}"))
        for old in before[:-1]:                          # a replay needs the micro-batch before it, no older one
            drop_folder(spark, f"{self.path}/used/batch={old}")
        for old in finished_ids(spark, self.path, "version"):
            if old < last["version"]:
                drop_folder(spark, f"{self.path}/version={old}")
        return self._version(spark, found["version"])

    def _load(self, spark: SparkSession, batch_id: int, last: dict) -> dict:
        try:
            new = self.load(spark).persist()
            row = F.xxhash64(*[F.col(f"`{c}`") for c in new.columns]) if new.columns else F.lit(0)
            n, h = new.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(20,0)"))).first()
        except (PySparkException, Py4JJavaError) as e:
            if last["version"] == NO_VERSION:
                raise
            warnings.warn(f"dimension not read in micro-batch {batch_id}, version {last['version']} kept: {e}", stacklevel=3)
            return last
        try:
            if not n or (n, h) == (last["n"], last["h"]):
                return last
            new.write.mode("overwrite").parquet(f"{self.path}/version={batch_id}")
            return {"version": batch_id, "n": n, "h": h}
        finally:
            new.unpersist()

    def _used(self, spark: SparkSession, batch_id: int) -> dict:
        return spark.read.parquet(f"{self.path}/used/batch={batch_id}").first().asDict()

    def _version(self, spark: SparkSession, version: int) -> DataFrame | None:
        return None if version == NO_VERSION else spark.read.parquet(f"{self.path}/version={version}")


def enrich_per_batch(dimension: DimensionSnapshot, sink: str, array_col: str, carry: list[str],
                     key: str, dim_key: str, dim_value: str,
                     transform: Callable[[DataFrame], DataFrame] | None = None, lines: bool = False):
    """``foreachBatch`` function: refresh the dimension, explode and look up, write the batch.

    Batches are Parquet folders, or JSON lines with ``lines`` (K1).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        dim = dimension.at(batch.sparkSession, batch_id)
        if dim is None:
            dim = batch.sparkSession.createDataFrame([], f"{dim_key} string, {dim_value} string")
        out = explode_enrich(batch, array_col, carry, dim=dim, key=key, dim_key=dim_key,
                             dim_value=dim_value)
        if transform is not None:
            out = transform(out)
        if lines:
            write_lines(out.select(to_json_text(*[F.col(c) for c in out.columns]).alias("value")),
                        f"{sink}/batch={batch_id}", mode="overwrite")
        else:
            out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return write
