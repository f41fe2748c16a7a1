"""Text lines from files or a topic, and writing them back.

A topic needs the Spark Kafka package on the classpath
(``spark-sql-kafka-0-10``); without it, files are the transport. Every
line source returns ``value string`` plus ``seq``, the arrival order that the
patterns need: ``(partition, offset)`` for a topic, file modification time
and a per-file row number for files. A stream of files has no row number;
``with_arrival`` adds one inside a micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str | None = None, topic: str | None = None,
               bootstrap: str | None = None, stream: bool = False, starting: str = "earliest",
               max_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Lines as ``value`` with an arrival ``seq`` struct.

    ``starting`` is ``earliest`` or ``latest`` for a topic. ``max_per_trigger``
    limits offsets (topic) or files (directory) per micro-batch -- the
    write-rate limit of the change-capture job.
    """
    if topic is not None:
        r = spark.readStream if stream else spark.read
        r = (r.format("kafka").option("kafka.bootstrap.servers", bootstrap)
               .option("subscribe", topic).option("startingOffsets", starting))
        if stream and max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        for k, v in (options or {}).items():
            r = r.option(k, v)
        df = r.load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.struct("partition", "offset").alias("seq"))
    if path is None:
        raise ValueError("give a path or a topic")
    r = spark.readStream if stream else spark.read
    if stream and max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.text(path)
    order = [F.col("_metadata.file_modification_time").alias("mtime"), F.col("_metadata.file_path").alias("file")]
    if not stream:
        order.append(F.monotonically_increasing_id().alias("row"))
    return df.select("value", F.struct(*order).alias("seq"))


def with_arrival(batch: DataFrame, batch_id: int, out: str = "seq") -> DataFrame:
    """A micro-batch of file lines with a sortable arrival number instead of ``seq``.

    For ``foreachBatch``: rows are numbered within each file as read, after file
    time and name; the batch id comes first. (Spark cannot number rows of a
    stream outside a micro-batch.) A bigint, so patterns, precombine and upsert
    take it: 2^40 rows a batch.
    """
    rows = batch.withColumn("_row", F.monotonically_increasing_id())
    files = rows.groupBy("seq").agg(F.count(F.lit(1)).alias("_n"))          # one row a file
    before = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("seq").orderBy("_row"))
    return (rows.withColumn("_place", place).join(files, "seq")
            .withColumn("_at", F.lit(batch_id) * F.lit(1 << 40) + F.col("_before") + F.col("_place")).drop("seq", "_row", "_place", "_before")
            .withColumnRenamed("_at", out))


def write_lines(df: DataFrame, path: str | None = None, topic: str | None = None,
                bootstrap: str | None = None, value: str = "value", mode: str = "append") -> None:
    """Write a string column as lines to files or a topic (batch)."""
    out = df.select(F.col(value).cast("string").alias("value"))
    if topic is not None:
        (out.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic).save())
        return
    out.write.mode(mode).text(path)
