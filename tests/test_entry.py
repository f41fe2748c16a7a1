import __spark_entry__ as entry


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.schema.simpleString() == "struct<item_id:bigint,window_end:timestamp_ntz,n:bigint,rank:int>"
    assert df.count() > 0
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(entry.QUERIES) <= set(o)
    assert all(callable(f) for f in q.values())
