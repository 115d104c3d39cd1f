"""Registered queries: one per operator / job, over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Queries that exercise a sink write below the session's shared
checkpoint folder and return the read-back. Column names match the DuckDB
oracle in ``vellum.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum import contracts as C
from vellum.functions.dates import month_range
from vellum.functions.text import (
    CASE_INSENSITIVE,
    collapse_spaces,
    not_equal_collated,
    strip_unicode,
    title_case,
)
from vellum.operators import contracts as K
from vellum.operators.checks import pre_checks
from vellum.operators.distinct import normalise_distinct
from vellum.operators.joins import flat_fact, left_chain
from vellum.operators.months import month_counts, month_prefix_by_key
from vellum.plans import jobs
from vellum.plans import standins as S
from vellum.session import shared_dir
from vellum.sources.readers import overridden_source, preview, read_csv, read_parquet, read_target
from vellum.plans.workbook_files import write_workbooks
from vellum.sources.workbooks import read_workbooks

Query = Callable[[SparkSession, str], DataFrame]

PREMIUM_YEAR = 1995  # first January with rows in the driver's orders
EMPTY_YEAR = 2002  # a January after the last order: nothing loads


def _t(spark, sf_dir, name):
    return S.load(spark, sf_dir, name)


# ---- projections, filters, joins, text -------------------------------------


def rename_projection(spark, sf_dir):
    return jobs.rename_project(S.premium_source(spark, sf_dir), jobs.PREMIUMS_RENAMES)


def code_and_name_filter(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.where(
        (F.col("c_mktsegment") == S.ORGANIZER_TYPE_SEGMENT) & (F.col("c_name") != F.lit("Customer#000000007"))
    ).select("c_custkey", "c_name", "c_mktsegment")


def collated_not_equal(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.where(not_equal_collated("p_name", "SMALL RING  ", CASE_INSENSITIVE)).select("p_partkey", "p_name")


def month_slice(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.where(month_range("o_orderdate", 1998, 3)).select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate")
    )


def left_chain_q(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, sf_dir, "region").select("r_regionkey", "r_name")
    out = left_chain(c, [(n, "c_nationkey", "n_nationkey"), (r, "n_regionkey", "r_regionkey")])
    return out.select("c_custkey", "c_name", "n_name", "r_name")


def organizers(spark, sf_dir):
    return jobs.build_organizers(spark, S.organizer_sources(spark, sf_dir), type_code=S.ORGANIZER_TYPE_SEGMENT)


def flat_fact_q(spark, sf_dir):
    premiums = jobs.rename_project(S.premium_source(spark, sf_dir), jobs.PREMIUMS_RENAMES).select(
        "op", "cod_organizador", "prima_neta_componente"
    )
    org = organizers(spark, sf_dir).select("cod_organizador", "nombre", "grupo")
    return flat_fact(premiums, org, "cod_organizador")


def title_case_q(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", title_case("p_name").alias("p_name_title"), title_case("p_type").alias("p_type_title"))


def strip_unicode_q(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", strip_unicode("text").alias("text_stripped"))


def collapse_spaces_q(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", collapse_spaces("text").alias("text_collapsed"))


def normalise_distinct_q(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select(F.col("p_name").alias("nombre"), F.col("p_type").alias("grupo"))
    return normalise_distinct(p, ["nombre", "grupo"])


# ---- sinks -----------------------------------------------------------------


def write_and_count(spark, sf_dir):
    df = jobs.build_motor_coverages(spark, {"dims_coberturas_aut": S.motor_coverage_source(spark, sf_dir)})
    path = shared_dir(spark, "coverages")
    res = jobs.publish(df, path, jobs.MOTOR_COVERAGES_TABLE)
    back = read_parquet(spark, path)
    return back.agg(
        F.lit(res["rows"]).cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("rows_read_back"),
        F.lit(res["table"]).alias("table_name"),
    )


def append_twice(spark, sf_dir):
    df = jobs.build_motor_coverages(spark, {"dims_coberturas_aut": S.motor_coverage_source(spark, sf_dir)})
    path = shared_dir(spark, "coverages-twice")
    first = jobs.publish(df, path, jobs.MOTOR_COVERAGES_TABLE)
    second = jobs.publish(df, path, jobs.MOTOR_COVERAGES_TABLE)
    back = read_parquet(spark, path)
    return back.agg(
        F.lit(first["rows"] + second["rows"]).cast("bigint").alias("rows_written"),
        F.count(F.lit(1)).alias("rows_read_back"),
        F.count_distinct("cod_cobertura").alias("distinct_codes"),
    )


def skip_empty(spark, sf_dir):
    src = S.other_coverage_source(spark, sf_dir)
    frames = {"all": src, "none": src.where(F.col("CodRama") < 0)}
    out = []
    for label, raw in frames.items():
        df = jobs.build_other_coverages(spark, {"dims_coberturas_rv": raw})
        res = jobs.publish_other_coverages(df, shared_dir(spark, f"rv-{label}"))
        out.append((label, res["rows"], res["written"], res["table"]))
    # One row per publish call: the write results themselves.
    return spark.createDataFrame(out, "input string, rows bigint, written boolean, table_name string")


def premiums_load(spark, sf_dir):
    df = jobs.build_premiums(spark, PREMIUM_YEAR, {"primas_automotores": S.premium_source(spark, sf_dir)})
    path = shared_dir(spark, "premiums")
    jobs.publish_premiums(df, path, PREMIUM_YEAR)
    back = read_parquet(spark, path)
    return back.select("op", "femision", "cod_organizador", "prima_neta_componente", "month")


def read_back(spark, sf_dir):
    """Organizers appended to a target, then read back from it by SQL."""
    path = shared_dir(spark, "organizers")
    jobs.publish(organizers(spark, sf_dir), path, jobs.ORGANIZERS_TABLE)
    return read_target(spark, path, "SELECT * FROM {target} WHERE cod_organizador >= :lo", lo=0)


def preview_q(spark, sf_dir):
    path = shared_dir(spark, "organizers-preview")
    jobs.publish(organizers(spark, sf_dir), path, jobs.ORGANIZERS_TABLE)
    return preview(spark, read_parquet(spark, path), ["cod_organizador", "cod_grupo"], 20)


# ---- months ----------------------------------------------------------------


def month_counts_q(spark, sf_dir):
    return month_counts(_t(spark, sf_dir, "orders"), "o_orderdate")


def month_prefix(spark, sf_dir):
    return jobs.premiums_summary(spark, PREMIUM_YEAR, {"primas_automotores": S.premium_source(spark, sf_dir)})


def month_prefix_empty_january(spark, sf_dir):
    return jobs.premiums_summary(spark, EMPTY_YEAR, {"primas_automotores": S.premium_source(spark, sf_dir)})


def month_prefix_by_customer(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return month_prefix_by_key(o, "o_orderdate", PREMIUM_YEAR, ["o_custkey"])


# ---- checks and contracts --------------------------------------------------


def pre_checks_q(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer")
    r = _t(spark, sf_dir, "region")
    return pre_checks(
        {
            "orders_in_1998": o.where(month_range("o_orderdate", 1998, 1, 12)),
            "automobile_customers": c.where(F.col("c_mktsegment") == S.ORGANIZER_TYPE_SEGMENT),
            "region_antarctica": r.where(F.col("r_name") == "ANTARCTICA"),
        }
    )


def contract_report_q(spark, sf_dir):
    df = jobs.build_organizers(spark, S.organizer_sources(spark, sf_dir), type_code=S.ORGANIZER_TYPE_SEGMENT)
    return K.contract_report(spark, df, C.ORGANIZADORES, with_counts=True)


# Stand-in contract for the large fact: lineitem's keys as unsigned columns,
# plus a signed quantity offset that can leave the UInt32 domain.
LINEITEM_CONTRACT = {
    "l_orderkey": "UInt32",
    "l_partkey": "UInt32",
    "l_suppkey": "UInt32",
    "l_linenumber": "UInt16",
    "qty_offset": "UInt32",
}


def domain_violations_q(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumn(
        "qty_offset", (F.col("l_quantity") - F.lit(25)).cast("bigint")
    )
    return K.domain_violations(li, LINEITEM_CONTRACT)


def typed_arrival(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    raw = o.select(
        F.col("o_orderkey").cast("string").alias("op"),
        F.col("o_orderpriority").alias("anio_componente"),
        F.col("o_orderstatus").alias("origen"),
    )
    contract = {"op": "UInt32", "anio_componente": "UInt32", "origen": "String"}
    typed = K.cast_to_contract(raw, contract)
    return typed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_cast_failures") > 0).cast("bigint").alias("rows_with_failures"),
        F.sum("_cast_failures").cast("bigint").alias("failed_values"),
        F.sum("op").cast("bigint").alias("op_sum"),
    )


# ---- sources ---------------------------------------------------------------


def csv_decimal_comma(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    # "473.274,17": thousands dots and a decimal comma, ';' as separator.
    text = o.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.translate(F.format_number("o_totalprice", 2), ",.", ".,").alias("o_totalprice"),
    )
    path = shared_dir(spark, "csv-decimal")
    text.write.mode("overwrite").option("header", "true").option("sep", ";").csv(path)
    return read_csv(spark, path, separator=";", decimal_comma=True)


def csv_scan(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    path = shared_dir(spark, "csv-part")
    p.write.mode("overwrite").option("header", "true").csv(path)
    contract = {"p_partkey": "UInt32", "p_name": "String", "p_size": "Int32", "p_retailprice": "Float64"}
    return read_csv(spark, path, decimal_comma=False, contract=contract)


def parquet_scan(spark, sf_dir):
    li = read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return li.where(month_range("l_shipdate", 1996, 1, 6)).select("l_orderkey", "l_linenumber", "l_quantity")


def source_override(spark, sf_dir):
    """Motor coverages read from a CSV copy registered under the source's name."""
    src = S.motor_coverage_source(spark, sf_dir)
    path = shared_dir(spark, "csv-coverages")
    src.write.mode("overwrite").option("header", "true").csv(path)
    # The source's columns are the contract's under their old names.
    schema_contract = {old: C.DIM_COBERTURAS_AUT[new] for old, new in jobs.MOTOR_COVERAGES_RENAMES.items()}
    csv_copy = read_csv(spark, path, decimal_comma=False, contract=schema_contract)
    with overridden_source(spark, jobs.MOTOR_COVERAGES_SOURCE, csv_copy):
        # No sources given: the job resolves its relation by name, i.e. the override.
        return jobs.build_motor_coverages(spark)


def workbook_folder(spark, sf_dir):
    """orders written as a folder of workbooks (one per Arrow batch, by the
    executors), then read back as one typed DataFrame."""
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderstatus"
    )
    folder = shared_dir(spark, "workbooks")
    books = int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_workbooks(o, folder, books=books).agg(F.sum("rows")).collect()
    contract = {
        "o_orderkey": "UInt32",
        "o_custkey": "UInt32",
        "o_totalprice": "Float64",
        "o_orderdate": "Date",
        "o_orderstatus": "String",
    }
    return read_workbooks(spark, folder, contract=contract)


def query_params(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return spark.sql(
        "SELECT c_custkey, c_name, c_acctbal FROM {src} WHERE c_mktsegment = :seg AND c_acctbal > :bal",
        args={"seg": "BUILDING", "bal": 5000.0},
        src=c,
    )


# ---- jobs ------------------------------------------------------------------


def coverages_motor(spark, sf_dir):
    return jobs.build_motor_coverages(spark, {"dims_coberturas_aut": S.motor_coverage_source(spark, sf_dir)})


def coverages_other(spark, sf_dir):
    return jobs.build_other_coverages(spark, {"dims_coberturas_rv": S.other_coverage_source(spark, sf_dir)})


def reuse_frame(spark, sf_dir):
    """A job's frame reused unwritten: lineitem ⟕ motor coverages."""
    cov = coverages_motor(spark, sf_dir).select("cod_cobertura", "cat_cobertura", "rt")
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("cod_cobertura")
    )
    return flat_fact(li, cov, "cod_cobertura")


def run_datasets(spark, sf_dir):
    """All four datasets published in order; the run-log table read back."""
    base = shared_dir(spark, "run")
    jobs.run_datasets(
        spark,
        S.all_sources(spark, sf_dir),
        f"{base}/targets",
        PREMIUM_YEAR,
        f"{base}/run_log",
        organizers_kw={"type_code": S.ORGANIZER_TYPE_SEGMENT},
    )
    log = read_parquet(spark, f"{base}/run_log")
    return log.select("dataset", "rows", "months", "ok", "error")


def _registry() -> dict[str, Query]:
    from vellum.plans import edge_queries as E
    from vellum.plans import history_queries as H
    from vellum.plans import runlog_queries as R

    q: dict[str, Query] = {
        "rename_projection": rename_projection,
        "code_and_name_filter": code_and_name_filter,
        "collated_not_equal": collated_not_equal,
        "month_slice": month_slice,
        "left_chain": left_chain_q,
        "flat_fact": flat_fact_q,
        "title_case": title_case_q,
        "strip_unicode": strip_unicode_q,
        "collapse_spaces": collapse_spaces_q,
        "normalise_distinct": normalise_distinct_q,
        "organizers": organizers,
        "write_and_count": write_and_count,
        "append_twice": append_twice,
        "skip_empty": skip_empty,
        "month_counts": month_counts_q,
        "month_prefix": month_prefix,
        "month_prefix_empty_january": month_prefix_empty_january,
        "month_prefix_by_customer": month_prefix_by_customer,
        "premiums_load": premiums_load,
        "pre_checks": pre_checks_q,
        "contract_report": contract_report_q,
        "domain_violations": domain_violations_q,
        "typed_arrival": typed_arrival,
        "csv_decimal_comma": csv_decimal_comma,
        "csv_scan": csv_scan,
        "parquet_scan": parquet_scan,
        "source_override": source_override,
        "read_back": read_back,
        "preview": preview_q,
        "workbook_folder": workbook_folder,
        "query_params": query_params,
        "coverages_motor": coverages_motor,
        "coverages_other": coverages_other,
        "reuse_frame": reuse_frame,
        "run_datasets": run_datasets,
    }
    q.update(R.QUERIES)
    q.update(E.QUERIES)
    q.update(H.QUERIES)
    return q


def queries() -> dict[str, Query]:
    return _registry()
