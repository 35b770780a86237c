import __spark_entry__ as entry


def test_registered_queries_have_unique_columns_and_sql():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) >= 100
    optional = set(entry._llm()[0])
    assert set(queries) - set(oracle) - optional == {"entity_match_supervised"}


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["series_id", "window_start", "count", "sum", "min", "max", "discrete_variance"]
    assert df.count() > 0
