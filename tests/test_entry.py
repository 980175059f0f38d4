import __spark_entry__


def test_contract(spark):
    names, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(names)
    assert len(names) > 50
    out = __spark_entry__.entry(spark)
    assert out.columns == ["id", "nodecount", "edgecount"]
    assert out.count() == 7
