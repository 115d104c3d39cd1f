"""The driver's TPC-H-like tables dressed as the jobs' source relations.

customer -> organizers (SEHINT01): c_custkey is the organizer code,
    c_mktsegment the type code, c_name the name.
customer ⋈ nation -> membership bridge (SETGRJ): organizer -> group, where
    the group of an organizer is the region of its nation.
region -> groups (SETGRP).
part -> motor coverages; supplier -> other-line coverages.
orders -> motor premiums, o_orderdate as the issue date.
events -> outcome log: user_id is the process, event_type <> 'error' = ok.

Columns the stand-in tables do not have are typed NULLs, so the jobs' renames
and contracts run unchanged on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import table_path

# Segment used as the organizer type code in the stand-in (the real job uses 3).
ORGANIZER_TYPE_SEGMENT = "AUTOMOBILE"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _null(type_name: str):
    return F.lit(None).cast(type_name)


def motor_coverage_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("CodCobertura"),
        F.col("p_partkey").alias("OrCobertura"),
        F.col("p_type").alias("CatCobertura"),
        F.col("p_size").cast("bigint").alias("OrCatCobertura"),
        F.col("p_size").alias("Rt"),
        _null("int").alias("Rp"),
        _null("int").alias("It"),
        _null("int").alias("Ip"),
        _null("int").alias("At"),
        _null("int").alias("Ap"),
    )


def other_coverage_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_nationkey").cast("bigint").alias("CodRama"),
        F.col("s_suppkey").alias("CodCobertura"),
        F.col("s_name").alias("Cobertura"),
        F.col("s_acctbal").cast("float").alias("Pormilaje"),
        _null("string").alias("Informe"),
    )


def organizer_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    sehint01 = c.select(
        F.col("c_custkey").alias("ININNA"),
        F.col("c_custkey").alias("INNRDF"),
        F.col("c_name").alias("DFNOMB"),
        _null("string").alias("DFDOMI"),
        _null("bigint").alias("DFCOPO"),
        _null("bigint").alias("DFCOPS"),
        _null("string").alias("LOLOCA"),
        F.col("c_nationkey").cast("string").alias("LOPROC"),
        _null("string").alias("DFTIDO"),
        _null("bigint").alias("DFNRDO"),
        _null("string").alias("DFCUIT"),
        _null("string").alias("PRPROD"),
        _null("string").alias("PRRPRO"),
        _null("bigint").alias("INMATR"),
        F.col("c_mktsegment").alias("ININTA"),
    )
    # nation has 25 rows by definition of the schema: a bounded broadcast.
    setgrj = c.select("c_custkey", "c_nationkey").join(
        F.broadcast(n.select("n_nationkey", "n_regionkey")),
        F.col("c_nationkey") == F.col("n_nationkey"),
    ).select(
        F.col("c_custkey").alias("GJINTE"),
        F.col("n_regionkey").cast("bigint").alias("GJGRUP"),
    )
    setgrp = r.select(F.col("r_regionkey").cast("bigint").alias("GPGRUP"), F.col("r_name").alias("GPNOGR"))
    return {"SEHINT01": sehint01, "SETGRJ": setgrj, "SETGRP": setgrp}


def premium_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    d = F.to_date("o_orderdate")
    b, dbl, s = "bigint", "double", "string"
    return o.select(
        d.alias("FEmision"),
        _null("date").alias("FVigDesde"),
        _null("date").alias("FVigHasta"),
        F.col("o_orderkey").alias("Op"),
        _null(b).alias("Comp"),
        _null(b).alias("Supl"),
        _null(b).alias("CodRama"),
        F.col("o_custkey").alias("Poliza"),
        _null(dbl).alias("SaComponente"),
        _null(b).alias("Cap"),
        _null(b).alias("Var"),
        _null(b).alias("Air"),
        F.col("o_orderstatus").alias("Origen"),
        _null(b).alias("AnioComponente"),
        F.col("o_orderpriority").alias("CodCoberturaAut"),
        _null(b).alias("CodTipoVeh"),
        _null(b).alias("CodUsoVeh"),
        _null(dbl).alias("PrimaTarifaSupl"),
        _null(dbl).alias("BonPrimaSupl"),
        _null(dbl).alias("PremioSupl"),
        _null(dbl).alias("PremioCobradoSupl"),
        F.col("o_custkey").alias("CodOrganizador"),
        _null(b).alias("CodProductor"),
        _null(dbl).alias("PrimaTarifaComp"),
        _null(dbl).alias("PrimaRcTarifaComp"),
        _null(dbl).alias("PrimaCascoTarifaComp"),
        F.col("o_totalprice").alias("PrimaNetaComp"),
        _null(dbl).alias("PrimaRcNetaComp"),
        _null(dbl).alias("PrimaCascoNetaComp"),
    )


def outcome_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(process, ts, seq, ok) from ``events``; ties in ts broken by event_id."""
    e = load(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("process"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        (F.col("event_type") != F.lit("error")).alias("ok"),
    )


def all_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = {
        "dims_coberturas_aut": motor_coverage_source(spark, sf_dir),
        "dims_coberturas_rv": other_coverage_source(spark, sf_dir),
        "primas_automotores": premium_source(spark, sf_dir),
    }
    out.update(organizer_sources(spark, sf_dir))
    return out
