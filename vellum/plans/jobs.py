"""The four warehouse datasets as pure ``build(...) -> DataFrame`` functions.

Each job reads its source relation(s) -- a DataFrame passed in, or the
catalog/temp view of the relation's name (which is how a run overrides the
source kind) -- renames to the output contract, applies its transformation,
and checks the contract on the schema (no job). Writing is separate
(``publish``), so any job's frame can be reused by another plan and Catalyst
optimises the whole composition.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum import contracts as C
from vellum.functions.text import CASE_INSENSITIVE, not_equal_collated
from vellum.operators.contracts import enforce
from vellum.operators.distinct import normalise_distinct
from vellum.operators.joins import left_chain
from vellum.operators.months import load_contiguous_months, month_prefix_summary
from vellum.sinks import write_counted, write_months

# ---- fixed values: source relations and column renames of the four jobs ----

MOTOR_COVERAGES_SOURCE = "dims_coberturas_aut"
MOTOR_COVERAGES_RENAMES = {
    "CodCobertura": "cod_cobertura",
    "OrCobertura": "or_cobertura",
    "CatCobertura": "cat_cobertura",
    "OrCatCobertura": "or_cat_cobertura",
    "Rt": "rt",
    "Rp": "rp",
    "It": "it",
    "Ip": "ip",
    "At": "at",
    "Ap": "ap",
}
MOTOR_COVERAGES_TABLE = "coberturas_automotores"

OTHER_COVERAGES_SOURCE = "dims_coberturas_rv"
OTHER_COVERAGES_RENAMES = {
    "CodRama": "cod_rama",
    "CodCobertura": "cod_cobertura",
    "Cobertura": "cobertura",
    "Pormilaje": "pormilaje",
    "Informe": "informe",
}
OTHER_COVERAGES_TABLE = "coberturas_ramas_varias"

ORGANIZERS_SOURCES = ("SEHINT01", "SETGRJ", "SETGRP")
ORGANIZERS_RENAMES = {
    "ININNA": "cod_organizador",
    "INNRDF": "nro_persona",
    "DFNOMB": "nombre",
    "DFDOMI": "domicilio",
    "DFCOPO": "cp",
    "DFCOPS": "cp_sufijo",
    "LOLOCA": "localidad",
    "LOPROC": "cod_provincia",
    "DFTIDO": "tipo_doc",
    "DFNRDO": "nro_doc",
    "DFCUIT": "cuit",
    "PRPROD": "provincia",
    "PRRPRO": "cod_inder_provincia",
    "INMATR": "matricula",
    "GPGRUP": "cod_grupo",
    "GPNOGR": "grupo",
}
ORGANIZERS_TYPE_CODE = 3
ORGANIZERS_EXCLUDED_NAME = "LIBRE"
ORGANIZERS_TABLE = "organizadores"

PREMIUMS_SOURCE = "primas_automotores"
PREMIUMS_RENAMES = {
    "FEmision": "femision",
    "FVigDesde": "fvigdesde",
    "FVigHasta": "fvighasta",
    "Op": "op",
    "Comp": "componente",
    "Supl": "suplemento",
    "CodRama": "cod_rama",
    "Poliza": "poliza",
    "SaComponente": "aa_componente",
    "Cap": "cap",
    "Var": "var",
    "Air": "air",
    "Origen": "origen",
    "AnioComponente": "anio_componente",
    "CodCoberturaAut": "cod_cobertura_aut",
    "CodTipoVeh": "cod_tipo_veh",
    "CodUsoVeh": "cod_uso_veh",
    "PrimaTarifaSupl": "prima_tarifa_suplemento",
    "BonPrimaSupl": "bon_prima_suplemento",
    "PremioSupl": "premio_suplemento",
    "PremioCobradoSupl": "premio_cobrado_suplemento",
    "CodOrganizador": "cod_organizador",
    "CodProductor": "cod_productor",
    "PrimaTarifaComp": "prima_tarifa_componente",
    "PrimaRcTarifaComp": "prima_rc_tarifa_componente",
    "PrimaCascoTarifaComp": "prima_casco_tarifa_componente",
    "PrimaNetaComp": "prima_neta_componente",
    "PrimaRcNetaComp": "prima_rc_neta_componente",
    "PrimaCascoNetaComp": "prima_casco_neta_componente",
}
PREMIUMS_DATASET = "primas_automotores_x_componente"

# ---- end of fixed values ---------------------------------------------------


def source(
    spark: SparkSession,
    name: str,
    sources: dict[str, DataFrame] | None = None,
    contract: dict[str, str] | None = None,
) -> DataFrame:
    """The relation ``name``: from ``sources`` if given there, else the catalog.

    ``contract`` checks the raw source (the first of the three boundaries;
    None = off, as in the four jobs)."""
    df = sources[name] if sources and name in sources else spark.table(name)
    return df.transform(enforce(contract, f"source {name}"))


def rename_project(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """``SELECT a AS x, b AS y, ...``: only the mapped columns, in mapping order."""
    return df.select(*[F.col(src).alias(dst) for src, dst in renames.items()])


def identity(df: DataFrame) -> DataFrame:
    """The default transformation step of every job (a job overrides it)."""
    return df


# ---- motor coverages -------------------------------------------------------


def build_motor_coverages(
    spark: SparkSession,
    sources: dict[str, DataFrame] | None = None,
    transform=identity,
    source_contract: dict[str, str] | None = None,
) -> DataFrame:
    raw = source(spark, MOTOR_COVERAGES_SOURCE, sources, source_contract)
    return (
        rename_project(raw, MOTOR_COVERAGES_RENAMES)
        .transform(transform)
        .transform(enforce(C.DIM_COBERTURAS_AUT, "coberturas_automotores"))
    )


# ---- other-line coverages --------------------------------------------------


def build_other_coverages(
    spark: SparkSession,
    sources: dict[str, DataFrame] | None = None,
    transform=identity,
    source_contract: dict[str, str] | None = None,
) -> DataFrame:
    """Renamed frame; the contract is checked by ``publish_other_coverages``
    only once the frame is known to be non-empty (an empty frame of any types
    is skipped, never rejected)."""
    raw = source(spark, OTHER_COVERAGES_SOURCE, sources, source_contract)
    return rename_project(raw, OTHER_COVERAGES_RENAMES).transform(transform)


def publish_other_coverages(df: DataFrame, path: str, **kw) -> dict:
    if df.isEmpty():
        return {"rows": 0, "table": OTHER_COVERAGES_TABLE, "written": False}
    enforce(C.COBERTURAS_RV_ETL, "coberturas_ramas_varias")(df)
    out = write_counted(df, path, **kw)
    return {"rows": out["rows"], "table": OTHER_COVERAGES_TABLE, "written": True}


# ---- organizers ------------------------------------------------------------


def organizers_frame(
    sehint01: DataFrame,
    setgrj: DataFrame,
    setgrp: DataFrame,
    *,
    type_code=ORGANIZERS_TYPE_CODE,
    excluded_name: str = ORGANIZERS_EXCLUDED_NAME,
    collation: str | None = CASE_INSENSITIVE,
) -> DataFrame:
    """organizer ⟕ membership ⟕ group, filtered, renamed, normalised, distinct.

    ``collation`` mirrors the source database's string comparison for the
    name filter (default: case- and trailing-blank-insensitive, as MySQL's
    default collation); ``None`` gives a plain binary ``<>``. A NULL name is
    always dropped (three-valued logic).
    """
    s = sehint01.where(
        (F.col("ININTA") == F.lit(type_code)) & not_equal_collated("DFNOMB", excluded_name, collation)
    )
    joined = left_chain(s, [(setgrj, "ININNA", "GJINTE"), (setgrp, "GJGRUP", "GPGRUP")])
    return normalise_distinct(rename_project(joined, ORGANIZERS_RENAMES), ["nombre", "grupo"])


def build_organizers(
    spark: SparkSession,
    sources: dict[str, DataFrame] | None = None,
    transform=identity,
    source_contract: dict[str, str] | None = None,
    **kw,
) -> DataFrame:
    """``source_contract`` is that of the organizers' own relation, the job's main source."""
    main, *others = ORGANIZERS_SOURCES
    s = source(spark, main, sources, source_contract)
    rel, gr = (source(spark, n, sources) for n in others)
    return (
        organizers_frame(s, rel, gr, **kw)
        .transform(transform)
        .transform(enforce(C.ORGANIZADORES, "organizadores"))
    )


# ---- motor premiums --------------------------------------------------------


def load_year(year: int | None) -> int:
    return datetime.date.today().year if year is None else year


def premiums_frame(raw: DataFrame, year: int) -> DataFrame:
    """Renamed premiums of the unbroken run of months from January of ``year``,
    with ``month`` (first day) for the partitioned write."""
    renamed = rename_project(raw, PREMIUMS_RENAMES)
    return load_contiguous_months(renamed, "femision", year)


def build_premiums(
    spark: SparkSession,
    year: int | None = None,
    sources: dict[str, DataFrame] | None = None,
    transform=identity,
    source_contract: dict[str, str] | None = None,
) -> DataFrame:
    """Premiums of the unbroken run of months from January of ``year`` (the current one by default)."""
    raw = source(spark, PREMIUMS_SOURCE, sources, source_contract)
    return (
        premiums_frame(raw, load_year(year))
        .transform(transform)
        .transform(enforce(C.PRIMAS_AUTOMOTORES, "primas_automotores"))
    )


def premiums_summary(spark: SparkSession, year: int | None = None, sources: dict[str, DataFrame] | None = None) -> DataFrame:
    """``(total_rows, months_processed, year)`` of the load, one row."""
    year = load_year(year)
    renamed = rename_project(source(spark, PREMIUMS_SOURCE, sources), PREMIUMS_RENAMES)
    return month_prefix_summary(renamed, "femision", year)


# ---- writing ---------------------------------------------------------------


def publish(df: DataFrame, path: str, table: str, contract: dict[str, str] | None = None, **kw) -> dict:
    """Append ``df``; ``{"rows", "table"}`` counted in the same job.

    ``contract`` checks the frame right before the write (the third
    boundary; None = off)."""
    enforce(contract, f"destination {table}")(df)
    out = write_counted(df, path, **kw)
    return {"rows": out["rows"], "table": table}


def publish_premiums(df: DataFrame, path: str, year: int | None = None, mode: str = "overwrite") -> dict:
    """Partitioned write of the load; ``total_rows``, ``months_processed`` and
    ``year`` observed in the same job. The kept months are contiguous by
    construction, so their count is max - min + 1 of the month index. A rerun
    that overwrites leaves no later month of an earlier run behind."""
    year = load_year(year)
    idx = F.year("month") * 12 + F.month("month")
    out = write_months(
        df,
        path,
        "month",
        mode=mode,
        metrics=[F.min(idx).alias("_lo"), F.max(idx).alias("_hi")],
        since=datetime.date(year, 1, 1),
    )
    months = 0 if out["rows"] == 0 else int(out["_hi"] - out["_lo"] + 1)
    return {
        "rows": out["rows"],
        "total_rows": out["rows"],
        "months_processed": months,
        "year": year,
        "table": PREMIUMS_DATASET,
    }


# ---- a run of all four datasets, recorded in the run-log table -------------

RUN_LOG_SCHEMA = (
    "dataset string, rows bigint, months bigint, started timestamp, ended timestamp, ok boolean, error string"
)
# Dataset order and dependencies (premiums after organizers and
# motor coverages).
DATASET_ORDER = [MOTOR_COVERAGES_TABLE, OTHER_COVERAGES_TABLE, ORGANIZERS_TABLE, PREMIUMS_DATASET]
DEPENDS_ON = {PREMIUMS_DATASET: [ORGANIZERS_TABLE, MOTOR_COVERAGES_TABLE]}


def run_datasets(
    spark: SparkSession,
    sources: dict[str, DataFrame] | None,
    target_dir: str,
    year: int | None,
    log_path: str,
    organizers_kw: dict | None = None,
) -> list[dict]:
    """Build and publish the four datasets in dependency order, appending one
    run-log row per dataset: (dataset, rows, months, started, ended, ok,
    error). A dataset whose dependencies did not succeed is not run and is
    logged as failed. Returns the results in order."""
    steps = {
        MOTOR_COVERAGES_TABLE: lambda p: publish(build_motor_coverages(spark, sources), p, MOTOR_COVERAGES_TABLE),
        OTHER_COVERAGES_TABLE: lambda p: publish_other_coverages(build_other_coverages(spark, sources), p),
        ORGANIZERS_TABLE: lambda p: publish(
            build_organizers(spark, sources, **(organizers_kw or {})), p, ORGANIZERS_TABLE
        ),
        PREMIUMS_DATASET: lambda p: publish_premiums(build_premiums(spark, year, sources), p, year),
    }
    ok_so_far: dict[str, bool] = {}
    log_rows, results = [], []
    for name in DATASET_ORDER:
        started = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        blocked = [d for d in DEPENDS_ON.get(name, []) if not ok_so_far.get(d)]
        res, err = {}, None
        if blocked:
            err = "dependencies not successful: " + ", ".join(blocked)
        else:
            try:
                res = steps[name](f"{target_dir.rstrip('/')}/{name}")
            except Exception as e:  # noqa: BLE001 - recorded in the run log
                err = f"{type(e).__name__}: {e}"
        ended = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
        ok_so_far[name] = err is None
        months = res.get("months_processed")
        log_rows.append((name, res.get("rows"), months, started, ended, err is None, err))
        results.append({"dataset": name, **res, "ok": err is None, "error": err})
    # One row per dataset run: the log is created where the runs happen.
    spark.createDataFrame(log_rows, RUN_LOG_SCHEMA).write.mode("append").parquet(log_path)
    return results
