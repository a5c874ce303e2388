import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) >= {"variable", "f"}


def test_catalogue_contract():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_every_query_builds_on_smoke_data(spark):
    """Every registered query runs end to end on sf0.001 (the small fixture tables)."""
    for name, fn in E.queries().items():
        fn(spark, E.SMOKE_DIR).write.format("noop").mode("overwrite").save()
