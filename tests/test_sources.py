from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sources.changes import snapshot_as_changes
from eventide.sources.dimension import read_dimension
from eventide.sources.json_table import read_json_table
from eventide.sources.lines import read_lines, write_lines
from eventide.sources.tables import read_table, register_views

SF = "/root/testdata/sf0.001"


def test_lines_round_trip_keeps_every_line(spark):
    path = scratch_path(spark, "t-lines")
    src = spark.createDataFrame([(f"l{i}",) for i in range(100)], "value string")
    write_lines(src, path)
    back = read_lines(spark, path)
    assert sorted(r.value for r in back.collect()) == sorted(f"l{i}" for i in range(100))
    assert back.select("seq.mtime", "seq.file", "seq.row").where(F.col("row").isNull()).count() == 0


def test_json_table_tolerant(spark):
    path = scratch_path(spark, "t-json")
    write_lines(spark.createDataFrame([('{"orderId":"a","orderMoney":1.5}',), ("garbage",), ('{"orderId":"b"}',)],
                                      "value string"), path)
    t = read_json_table(spark, "orderId string, orderMoney double, orderStatus int", path=path)
    assert sorted((r.orderId, r.orderMoney, r.orderStatus) for r in t.collect()) == [("a", 1.5, None), ("b", None, None)]


def test_dimension_file(spark):
    path = scratch_path(spark, "t-dim")
    spark.createDataFrame([("east", "US,CA"), ("west", "CA,")], "area string, countries string").write.parquet(path)
    assert {r.country: r.area for r in read_dimension(spark, path).collect()} == {"US": "east", "CA": "west"}


def test_snapshot_rows_are_inserts(spark):
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    assert [tuple(r) for r in snapshot_as_changes(df).collect()] == [("+I", 1, "a")]


def test_tables_and_views(spark):
    register_views(spark, SF, ["region", "nation"])
    assert spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0] == 25
    assert read_table(spark, SF, "events").count() == 1000


def test_line_stream_from_files_keeps_arrival_order(spark, tmp_path):
    from eventide.operators.sequence import adjacent_change
    from eventide.sources.lines import read_lines, with_arrival
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "a.txt").write_text("u1,1\nu1,2\nu2,1\n")
    lines = read_lines(spark, path=str(src), stream=True)

    def keep(batch, batch_id):
        with_arrival(batch, batch_id).write.parquet(f"{out}/batch={batch_id}")

    for extra in (None, "u1,2\nu1,1\n"):
        if extra:
            (src / "b.txt").write_text(extra)
        q = (lines.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
    rows = spark.read.parquet(str(out)).orderBy("seq")
    assert [r.value for r in rows.collect()] == ["u1,1", "u1,2", "u2,1", "u1,2", "u1,1"]
    events = rows.selectExpr("split(value, ',')[0] AS k", "split(value, ',')[1] AS v", "seq")
    assert [(r.prev_v, r.v) for r in adjacent_change(events, "k", ["seq"], "v").orderBy("seq").collect()] == [("1", "2"), ("2", "1")]
