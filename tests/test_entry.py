import __spark_entry__ as E

#: Queries that SQL cannot express; each is tested against a brute-force version instead.
NO_SQL = {"op1_toxicity_nbsvm", "op2_pii_feistel", "op3_best_fit_packing", "op4_byte_bpe", "op7_quality_rules", "pipeline"}


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "cod_organizador" in df.columns and "grupo" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(q) - set(o) <= NO_SQL
    assert len(q) >= 50


def test_all_queries_give_rows_on_smoke_data(spark):
    for name, fn in E.queries().items():
        df = fn(spark, "/root/testdata/sf0.001")
        assert len(set(df.columns)) == len(df.columns), name
        df.write.format("noop").mode("overwrite").save()
