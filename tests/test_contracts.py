import pytest

from vellum import contracts as C
from vellum.operators.contracts import (
    ContractError,
    cast_to_contract,
    contract_gaps,
    contract_report,
    domain_violations,
    require_contract,
    split_by_domain,
)


def test_thirteen_contracts_259_columns():
    assert len(C.CONTRACTS) == 13
    assert sum(len(c) for c in C.CONTRACTS.values()) == 259
    assert "cod_poductor" in C.PRIMAS_RAMAS_VARIAS
    assert "rec_Administrativo" in C.SEHPN151


def test_struct_carries_ranges():
    st = C.to_struct(C.DIM_COBERTURAS_AUT)
    rt = st["rt"]
    assert rt.dataType.simpleString() == "int"
    assert rt.metadata["max"] == 65535
    assert st["or_cobertura"].metadata["max"] == 4294967295


def test_missing_and_wrong_type_reported_together_extra_ok(spark):
    contract = {"a": "UInt32", "b": "String", "c": "Date"}
    df = spark.createDataFrame([(1, 2, "x")], "a bigint, b int, extra string")
    with pytest.raises(ContractError) as e:
        require_contract(df, contract, "ctx")
    msg = str(e.value)
    assert "b is int" in msg and "c is absent" in msg and "extra" not in msg
    assert [(g.column, g.wanted, g.found) for g in e.value.gaps] == [("b", "string", "int"), ("c", "date", None)]


def test_none_contract_disables(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert contract_gaps(df.schema, None) == [] and require_contract(df, None, "ctx") is df


def test_names_are_case_sensitive(spark):
    df = spark.createDataFrame([(1,)], "A bigint")
    assert [(g.column, g.found) for g in contract_gaps(df.schema, {"a": "UInt32"})] == [("a", None)]


def test_no_widening(spark):
    df = spark.createDataFrame([(1.0,)], "pormilaje double")
    assert len(contract_gaps(df.schema, {"pormilaje": "Float32"})) == 1


def test_domain_violations(spark):
    df = spark.createDataFrame([(5,), (4294967296,), (-1,), (None,)], "op bigint")
    row = domain_violations(df, {"op": "UInt32"}).first()
    assert row["rows"] == 4 and row["op_violations"] == 2
    good, bad = split_by_domain(df, {"op": "UInt32"})
    assert good.count() == 2 and bad.count() == 2


def test_cast_to_contract_counts_failures(spark):
    df = spark.createDataFrame([("5", "x"), ("abc", "y"), (None, None)], "op string, origen string")
    out = cast_to_contract(df, {"op": "UInt32", "origen": "String"}).orderBy("origen").collect()
    assert [r["_cast_failures"] for r in out] == [0, 0, 1]


def test_contract_report(spark):
    df = spark.createDataFrame([(1, "a")], "cod_rama bigint, cobertura string")
    rows = {r["column_name"]: r for r in contract_report(spark, df, C.COBERTURAS_RV_ETL, with_counts=True).collect()}
    assert rows["cod_rama"]["ok"] and rows["cod_rama"]["non_null"] == 1
    assert rows["pormilaje"]["found"] is None and not rows["pormilaje"]["ok"]


def test_guarded_try_cast_equals_try_cast(spark):
    import random

    from pyspark.sql import functions as F

    from vellum.functions.casts import guarded_try_cast

    edge = ["5", " 5 ", "+5", "5.0", ".5", "1e3", "1.5d", "NaN", "-inf", "0x10", "0x1p3", "١٢", "\t7\n", "", "1,5"]
    rnd = random.Random(7)
    alpha = "0123456789+-.eEdDfFxXpPnNaIity \t,"
    vals = edge + ["".join(rnd.choice(alpha) for _ in range(rnd.randint(0, 6))) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ["bigint", "int", "double", "float", "decimal(12,3)"]:
        same = guarded_try_cast(F.col("s"), t).eqNullSafe(F.col("s").try_cast(t))
        assert df.where(~same).count() == 0, t
