"""The four jobs on the frames the warehouse loader's own tests use."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vellum import contracts as C
from vellum.operators.contracts import ContractError
from vellum.plans import jobs


def _as_source(df, renames):
    inverse = {v: k for k, v in renames.items()}
    return df.select(*[F.col(c).alias(inverse[c]) for c in df.columns])


def sample_aut(spark, n=3):
    rows = [(f"C{i:02d}", i, "CAT", i, 1, 0, 1, 0, 0, 1) for i in range(n)]
    df = spark.createDataFrame(rows, C.to_struct(C.DIM_COBERTURAS_AUT))
    return _as_source(df, jobs.MOTOR_COVERAGES_RENAMES)


def sample_rv(spark, n=3):
    rows = [(i, 100 + i, f"Cob {i}", 1.5, "SI") for i in range(n)]
    df = spark.createDataFrame(rows, C.to_struct(C.COBERTURAS_RV_ETL))
    return _as_source(df, jobs.OTHER_COVERAGES_RENAMES)


def sample_org_sources(spark, n=3, memberships=None):
    s_rows = [
        (i + 1, 100 + i, f"JUAN PEREZ {i}", f"Calle {i}", 5000, 0, "CORDOBA", "CB", "DNI", 30000000 + i,
         f"20-3000000{i}-9", "CORDOBA", "14", 1000 + i, 3)
        for i in range(n)
    ]
    s = spark.createDataFrame(
        s_rows,
        "ININNA bigint, INNRDF bigint, DFNOMB string, DFDOMI string, DFCOPO bigint, DFCOPS bigint, "
        "LOLOCA string, LOPROC string, DFTIDO string, DFNRDO bigint, DFCUIT string, PRPROD string, "
        "PRRPRO string, INMATR bigint, ININTA int",
    )
    memberships = memberships if memberships is not None else [(i + 1, 1) for i in range(n)]
    rel = spark.createDataFrame(memberships, "GJINTE bigint, GJGRUP bigint")
    groups = spark.createDataFrame([(g, f"GRUPO {g}") for g in (1, 2)], "GPGRUP bigint, GPNOGR string")
    return {"SEHINT01": s, "SETGRJ": rel, "SETGRP": groups}


@pytest.mark.parametrize("n", [2, 3, 5, 7])
def test_motor_coverages_rows(spark, workdir, n):
    df = jobs.build_motor_coverages(spark, {"dims_coberturas_aut": sample_aut(spark, n)})
    res = jobs.publish(df, workdir("aut"), jobs.MOTOR_COVERAGES_TABLE)
    assert res == {"rows": n, "table": "coberturas_automotores"}


def test_motor_coverages_contract_error_writes_nothing(spark, workdir):
    bad = sample_aut(spark).withColumn("Rt", F.col("Rt").cast("bigint"))
    with pytest.raises(ContractError):
        jobs.build_motor_coverages(spark, {"dims_coberturas_aut": bad})


def test_other_coverages_skip_empty_even_with_wrong_types(spark, workdir):
    empty = spark.createDataFrame(
        [], "CodRama string, CodCobertura string, Cobertura string, Pormilaje string, Informe string"
    )
    df = jobs.build_other_coverages(spark, {"dims_coberturas_rv": empty})
    res = jobs.publish_other_coverages(df, workdir("rv-empty"))
    assert res["rows"] == 0 and res["written"] is False and res["table"] == "coberturas_ramas_varias"


def test_other_coverages_written(spark, workdir):
    df = jobs.build_other_coverages(spark, {"dims_coberturas_rv": sample_rv(spark, 3)})
    res = jobs.publish_other_coverages(df, workdir("rv"))
    assert res["rows"] == 3 and res["written"]


def test_organizers_title_case_and_contract(spark):
    df = jobs.build_organizers(spark, sample_org_sources(spark))
    rows = sorted(df.collect(), key=lambda r: r.cod_organizador)
    assert [r.nombre for r in rows] == ["Juan Perez 0", "Juan Perez 1", "Juan Perez 2"]
    assert {r.grupo for r in rows} == {"Grupo 1"}
    assert [r.localidad for r in rows] == ["CORDOBA"] * 3


def test_organizers_distinct_after_normalising(spark):
    src = sample_org_sources(spark, 2)
    s = src["SEHINT01"]
    # The same rows again, differing only in case and outer blanks of the name.
    twin = s.withColumn("DFNOMB", F.concat(F.lower("DFNOMB"), F.lit("  ")))
    src["SEHINT01"] = s.unionByName(twin)
    assert jobs.build_organizers(spark, src).count() == 2


def test_organizers_fan_out_and_missing_group(spark):
    src = sample_org_sources(spark, 3, memberships=[(1, 1), (1, 2), (2, 1)])
    rows = jobs.build_organizers(spark, src).collect()
    assert len(rows) == 4
    assert [r.cod_grupo for r in rows if r.cod_organizador == 3] == [None]


def test_organizers_filters(spark):
    src = sample_org_sources(spark, 3)
    s = src["SEHINT01"]
    src["SEHINT01"] = s.withColumn(
        "DFNOMB", F.when(F.col("ININNA") == 1, "libre ").when(F.col("ININNA") == 2, None).otherwise(F.col("DFNOMB"))
    )
    assert [r.cod_organizador for r in jobs.build_organizers(spark, src).collect()] == [3]
    # Plain binary comparison keeps the lower-case variant.
    assert jobs.build_organizers(spark, src, collation=None).count() == 2
    src["SEHINT01"] = s.withColumn("ININTA", F.lit(4))
    assert jobs.build_organizers(spark, src).count() == 0


def premium_rows(spark, dates):
    cols = list(jobs.PREMIUMS_RENAMES)
    rows = []
    for i, d in enumerate(dates):
        r = {c: None for c in cols}
        r.update({"FEmision": d, "Op": i + 1, "Poliza": 1000 + i, "CodOrganizador": 10, "Origen": "N"})
        rows.append(tuple(r[c] for c in cols))
    types = {v: C.spark_type(C.PRIMAS_AUTOMOTORES[v]).simpleString() for v in jobs.PREMIUMS_RENAMES.values()}
    schema = ", ".join(f"{k} {types[v]}" for k, v in jobs.PREMIUMS_RENAMES.items())
    return spark.createDataFrame(rows, schema)


def _summary(spark, dates, year=2025):
    src = {"primas_automotores": premium_rows(spark, dates)}
    r = jobs.premiums_summary(spark, year, src).first()
    return r.total_rows, r.months_processed, r.year


def test_premiums_totals(spark):
    dates = [dt.date(2025, 1, 15)] * 3 + [dt.date(2025, 2, 10)] * 5
    assert _summary(spark, dates) == (8, 2, 2025)


def test_premiums_empty_january(spark):
    assert _summary(spark, [dt.date(2025, 2, 1)]) == (0, 0, 2025)


def test_premiums_twelve_months(spark):
    assert _summary(spark, [dt.date(2025, m, 5) for m in range(1, 13)]) == (12, 12, 2025)


def test_premiums_gap_stops(spark):
    dates = [dt.date(2025, 1, 1), dt.date(2025, 2, 1), dt.date(2025, 4, 1), dt.date(2025, 5, 1)]
    assert _summary(spark, dates) == (2, 2, 2025)


def test_premiums_across_year_end_and_null_date(spark):
    dates = [dt.date(2025, m, 3) for m in range(1, 13)] + [dt.date(2026, 1, 3), dt.date(2026, 2, 3)]
    dates += [None, dt.date(2024, 12, 31)]
    assert _summary(spark, dates) == (14, 14, 2025)


def test_premiums_load_written_by_month(spark, workdir):
    dates = [dt.date(2025, 1, 15)] * 3 + [dt.date(2025, 2, 10)] * 5 + [dt.date(2025, 4, 1)]
    src = {"primas_automotores": premium_rows(spark, dates)}
    df = jobs.build_premiums(spark, 2025, src)
    path = workdir("premiums")
    assert jobs.publish_premiums(df, path)["rows"] == 8
    # Rerun with dynamic partition overwrite: same months, same rows.
    jobs.publish_premiums(jobs.build_premiums(spark, 2025, src), path)
    back = spark.read.parquet(path)
    assert back.count() == 8
    assert sorted(r.month for r in back.select("month").distinct().collect()) == [
        dt.date(2025, 1, 1),
        dt.date(2025, 2, 1),
    ]


def test_reuse_frames_in_joins(spark):
    cov = jobs.build_motor_coverages(spark, {"dims_coberturas_aut": sample_aut(spark, 3)})
    extra = spark.createDataFrame([("C00", 1), ("C01", 2), ("C02", 3)], "cod_cobertura string, extra bigint")
    out = extra.join(cov, "cod_cobertura", "left")
    assert out.count() == 3 and "rt" in out.columns
    org = jobs.build_organizers(spark, sample_org_sources(spark))
    prem = spark.createDataFrame([(1, 100.0), (2, 200.0), (3, 300.0)], "cod_organizador bigint, prima double")
    flat = prem.join(org, "cod_organizador", "left")
    assert flat.count() == 3 and "nombre" in flat.columns


def test_run_datasets_logs_and_blocks_on_failed_dependency(spark, workdir):
    dates = [dt.date(2025, 1, 15)] * 3 + [dt.date(2025, 2, 10)] * 5
    sources = {
        "dims_coberturas_aut": sample_aut(spark, 3),
        "dims_coberturas_rv": sample_rv(spark, 2),
        "primas_automotores": premium_rows(spark, dates),
        **sample_org_sources(spark, 3),
    }
    base = workdir("run")
    res = jobs.run_datasets(spark, sources, f"{base}/t", 2025, f"{base}/log")
    assert [(r["dataset"], r["ok"]) for r in res] == [
        ("coberturas_automotores", True),
        ("coberturas_ramas_varias", True),
        ("organizadores", True),
        ("primas_automotores_x_componente", True),
    ]
    assert res[3]["total_rows"] == 8 and res[3]["months_processed"] == 2
    # Break the organizers contract: premiums must not run.
    bad = dict(sources)
    bad["SEHINT01"] = sources["SEHINT01"].withColumn("INMATR", F.col("INMATR").cast("string"))
    res = jobs.run_datasets(spark, bad, f"{base}/t2", 2025, f"{base}/log")
    assert not res[2]["ok"] and "matricula" in res[2]["error"]
    assert not res[3]["ok"] and "organizadores" in res[3]["error"]
    log = spark.read.parquet(f"{base}/log")
    assert log.count() == 8 and log.where("not ok").count() == 2


def test_transform_hook_runs_before_the_contract(spark):
    def drop_odd(df):
        return df.where(F.col("or_cobertura") % 2 == 0)

    df = jobs.build_motor_coverages(spark, {"dims_coberturas_aut": sample_aut(spark, 5)}, transform=drop_odd)
    assert df.count() == 3
    with pytest.raises(ContractError):
        jobs.build_motor_coverages(
            spark, {"dims_coberturas_aut": sample_aut(spark, 2)}, transform=lambda d: d.drop("rt")
        )


def test_contract_at_source_and_destination_boundaries(spark, workdir):
    src = {"dims_coberturas_aut": sample_aut(spark, 3)}
    raw_contract = {"CodCobertura": "String", "Rt": "UInt16"}
    assert jobs.build_motor_coverages(spark, src, source_contract=raw_contract).count() == 3
    with pytest.raises(ContractError, match="source dims_coberturas_aut"):
        jobs.build_motor_coverages(spark, src, source_contract={"Rt": "UInt32"})
    df = jobs.build_motor_coverages(spark, src)
    with pytest.raises(ContractError, match="destination"):
        jobs.publish(df, workdir("dest"), "t", contract={"extra_col": "String"})
    assert jobs.publish(df, workdir("dest2"), "t", contract=C.DIM_COBERTURAS_AUT)["rows"] == 3


def test_premiums_from_a_file_override_loads_contiguous_months(spark, workdir):
    from vellum.sources.readers import override_source, read_csv

    dates = [dt.date(2025, 1, 15)] * 3 + [dt.date(2025, 2, 10)] * 5 + [dt.date(2025, 4, 1)] * 2
    path = workdir("premiums-csv")
    premium_rows(spark, dates).write.option("header", "true").csv(path)
    contract = {k: C.PRIMAS_AUTOMOTORES[v] for k, v in jobs.PREMIUMS_RENAMES.items()}
    override_source(spark, jobs.PREMIUMS_SOURCE, read_csv(spark, path, decimal_comma=False, contract=contract))
    try:
        r = jobs.premiums_summary(spark, 2025).first()
        assert (r.total_rows, r.months_processed) == (8, 2)
        assert jobs.build_premiums(spark, 2025).count() == 8
    finally:
        spark.catalog.dropTempView(jobs.PREMIUMS_SOURCE)
