"""Registered queries on frames where simpler operators would go wrong, and their DuckDB SQL.

The given tables are tidy: no odd blanks in names, no empty months, no
unmatched keys. The frames here are derived from the whole tables with column
expressions, so that ``initcap`` for title case, ``trim`` for the Unicode
strip, an inner join for the left chain, all months for the contiguous ones,
or a contract that is only repeated would each turn a query red.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum import contracts as C
from vellum.contracts import spark_type, value_range
from vellum.functions.text import strip_unicode, title_case
from vellum.operators.contracts import contract_report
from vellum.operators.distinct import normalise_distinct
from vellum.operators.joins import left_chain
from vellum.plans import jobs
from vellum.plans import oracle as O
from vellum.plans import standins as S
from vellum.session import shared_dir
from vellum.sinks import write_counted
from vellum.sources.readers import read_csv, read_parquet, read_target

YEAR = 1995

# --- frames ------------------------------------------------------------------

#: Premium columns that ``orders`` lacks: a number per column, so that two swapped columns would show.
_NUMBERS = ["Comp", "Supl", "CodRama", "Cap", "Var", "Air", "AnioComponente", "CodTipoVeh", "CodUsoVeh", "CodProductor"]
_AMOUNTS = [
    "SaComponente", "PrimaTarifaSupl", "BonPrimaSupl", "PremioSupl", "PremioCobradoSupl", "PrimaTarifaComp", "PrimaRcTarifaComp",
    "PrimaCascoTarifaComp", "PrimaRcNetaComp", "PrimaCascoNetaComp",
]


def full_premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The premium source with values of its own in all 29 columns."""
    filled = {n: F.col("Op") * 100 + i for i, n in enumerate(_NUMBERS)}
    filled |= {n: F.col("PrimaNetaComp") * (i + 2) for i, n in enumerate(_AMOUNTS)}
    filled |= {"FVigDesde": F.date_add("FEmision", 1), "FVigHasta": F.add_months("FEmision", 12)}
    return S.premium_source(spark, sf_dir).withColumns(filled)


def gap_premiums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The premium source with March 1996 issued a month later: that month stands empty."""
    march = F.month("FEmision") + 12 * F.year("FEmision") == 3 + 12 * 1996
    return S.premium_source(spark, sf_dir).withColumn("FEmision", F.when(march, F.add_months("FEmision", 1)).otherwise(F.col("FEmision")))


def odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with ``odd``: names with apostrophes, commas, hyphens, digits, accents, mixed case and many kinds of blanks."""
    n, kind = F.col("p_name"), F.col("p_partkey") % 5
    odd = (
        F.when(kind == 0, F.concat(F.lit(" "), F.upper(n), F.lit("\t")))
        .when(kind == 1, F.concat(F.lit("  o'"), n, F.lit(",juan  3RA 3ra.x")))
        .when(kind == 2, F.replace(n, F.lit(" "), F.lit("-")))
        .when(kind == 3, F.concat(F.lit("Álvarez ñandú "), n, F.lit("　")))
        .otherwise(F.concat(F.lit("\n"), F.upper(F.substring(n, 1, 3)), n, F.lit("   ")))
    )
    return S.load(spark, sf_dir, "part").withColumn("odd", odd)


# --- queries -----------------------------------------------------------------


def rename_projection_full(spark, sf_dir):
    return jobs.rename_project(full_premiums(spark, sf_dir), jobs.PREMIUMS_RENAMES)


def left_chain_fanout(spark, sf_dir):
    """customer ⟕ orders (by a doubled key) ⟕ nation: customers without a match, with several, groups that no nation has."""
    c = S.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = S.load(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).alias("o_custkey"), (F.col("o_orderkey") % 40).cast("int").alias("o_group"))
    n = S.load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = left_chain(c, [(o, "c_custkey", "o_custkey"), (n, "o_group", "n_nationkey")])
    return out.select("c_custkey", "c_name", "o_group", "n_name")


def title_case_odd(spark, sf_dir):
    return odd_names(spark, sf_dir).select("p_partkey", title_case("odd").alias("title"))


def strip_unicode_odd(spark, sf_dir):
    return odd_names(spark, sf_dir).select("p_partkey", strip_unicode("odd").alias("stripped"))


def normalise_distinct_odd(spark, sf_dir):
    p = odd_names(spark, sf_dir)
    both = p.select("odd", "p_type").unionByName(p.select(F.upper("p_name").alias("odd"), "p_type"))
    return normalise_distinct(both.withColumnsRenamed({"odd": "nombre", "p_type": "grupo"}), ["nombre", "grupo"])


def month_prefix_gap(spark, sf_dir):
    """The un-keyed run meets an empty month and stops before it."""
    return jobs.premiums_summary(spark, YEAR, {jobs.PREMIUMS_SOURCE: gap_premiums(spark, sf_dir)})


def premiums_rerun_with_gap(spark, sf_dir):
    """A full load, then a rerun that ends at a gap: the first run's later months leave the table."""
    path = shared_dir(spark, "premiums-rerun")
    for raw in (S.premium_source(spark, sf_dir), gap_premiums(spark, sf_dir)):
        jobs.publish_premiums(jobs.build_premiums(spark, YEAR, {jobs.PREMIUMS_SOURCE: raw}), path, YEAR)
    return read_parquet(spark, path).select("op", "femision", "cod_organizador", "prima_neta_componente", "month")


def _organizers(spark, sf_dir):
    return jobs.build_organizers(spark, S.organizer_sources(spark, sf_dir), type_code=S.ORGANIZER_TYPE_SEGMENT)


def contract_report_broken(spark, sf_dir):
    """Organizers with a column of a wrong type, one missing, one to spare, and numbers out of their domain."""
    changed = {"cod_grupo": F.col("cod_grupo").cast("int"), "nro_persona": F.col("nro_persona") - 100, "spare": F.lit("x")}
    return contract_report(spark, _organizers(spark, sf_dir).drop("matricula").withColumns(changed), C.ORGANIZADORES, with_counts=True)


def csv_sink(spark, sf_dir):
    """part through the CSV destination, counted while written, read back by contract."""
    path = shared_dir(spark, "csv-sink")
    columns = ["p_partkey", "p_name", "p_size", "p_retailprice"]
    out = write_counted(S.load(spark, sf_dir, "part").select(*columns), path, fmt="csv", options={"header": "true", "escape": '"'})
    contract = {"p_partkey": "UInt32", "p_name": "String", "p_size": "Int32", "p_retailprice": "Float64"}
    back = read_csv(spark, path, decimal_comma=False, contract=contract)
    return back.withColumn("rows_written", F.lit(out["rows"]).cast("bigint"))


def table_sink(spark, sf_dir):
    """Organizers appended twice to a named table, read back from it by SQL."""
    name = f"vellum_organizers_{uuid.uuid4().hex}"
    first = write_counted(_organizers(spark, sf_dir), table=name)
    write_counted(_organizers(spark, sf_dir), table=name)
    sql = "SELECT cod_organizador, nombre, grupo, count(*) AS copies FROM {target} WHERE cod_organizador >= :lo GROUP BY ALL"
    return read_target(spark, table=name, sql=sql, lo=0).withColumn("rows_written", F.lit(first["rows"]).cast("bigint"))


def _quoted(c):
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def csv_quoted(spark, sf_dir):
    """Lines written as text: quotes, separators and line breaks inside quoted values; columns by position."""
    note = F.concat(F.lit('say "'), F.col("p_name"), F.lit('", '), F.col("p_brand"), F.lit("\n"), F.col("p_type"))
    path = shared_dir(spark, "csv-quoted")
    lines = F.concat_ws(",", F.col("p_partkey").cast("string"), _quoted(note), F.col("p_size").cast("string"))
    S.load(spark, sf_dir, "part").select(lines).write.text(path)
    contract = {"p_partkey": "UInt32", "note": "String", "p_size": "Int32"}
    return read_csv(spark, path, header=False, decimal_comma=False, contract=contract, multi_line=True)


def csv_long_integers(spark, sf_dir):
    """A column of 20-digit integers and one of 45 digits, types inferred: no digit is lost."""
    key = F.col("o_orderkey").cast("string")
    path = shared_dir(spark, "csv-long")
    lines = F.concat_ws(";", key, F.concat(F.lit("123456789012"), F.lpad(key, 8, "0")), F.concat(F.lit("9" * 37), F.lpad(key, 8, "0")))
    S.load(spark, sf_dir, "orders").select(lines).write.text(path)
    back = read_csv(spark, path, separator=";", header=False).toDF("o_orderkey", "wide", "wider")
    types = {f"{c}_type": F.lit(t) for c, t in back.dtypes}
    return back.select("o_orderkey", F.col("wide").cast("string").alias("wide"), "wider").withColumns(types)


def csv_stray_quotes(spark, sf_dir):
    """Quotes that never close, a value too many or too few: such lines are kept as they are, and take no neighbour with them."""
    key, name, kind = F.col("p_partkey").cast("string"), F.col("p_name"), F.col("p_partkey") % 7
    line = (
        F.when(kind == 0, F.concat(key, F.lit(',"'), name, F.lit(",1")))
        .when(kind == 1, F.concat_ws(",", key, name, F.lit("2"), F.lit("spare")))
        .when(kind == 2, F.concat_ws(",", key, name))
        .when(kind == 3, F.concat_ws(",", key, F.concat(F.lit('"'), name, F.lit(', ""3"""')), F.lit("x")))
        .otherwise(F.concat_ws(",", key, F.concat(name, F.lit(' 5"')), F.lit("4")))
    )
    path = shared_dir(spark, "csv-stray")
    S.load(spark, sf_dir, "part").select(line).write.text(path)
    contract = {"p_partkey": "UInt32", "p_name": "String", "n": "Int32"}
    return read_csv(spark, path, header=False, decimal_comma=False, contract=contract, with_failures=True)


def csv_bad_numbers(spark, sf_dir):
    """Decimal commas for odd keys, decimal dots for even ones: dots are counted as failures, never converted."""
    english = F.format_number("o_totalprice", 2)
    comma, dot = F.translate(english, ",.", ".,"), F.replace(english, F.lit(","), F.lit(""))
    price = F.when(F.col("o_orderkey") % 2 == 1, comma).otherwise(dot)
    path = shared_dir(spark, "csv-bad")
    S.load(spark, sf_dir, "orders").select(F.concat_ws(";", F.col("o_orderkey").cast("string"), price)).write.text(path)
    contract = {"o_orderkey": "UInt32", "o_totalprice": "Float64"}
    return read_csv(spark, path, separator=";", header=False, contract=contract, with_failures=True).drop("_broken_line")


QUERIES = {
    f.__name__: f
    for f in (
        rename_projection_full, left_chain_fanout, title_case_odd, strip_unicode_odd, normalise_distinct_odd, month_prefix_gap,
        premiums_rerun_with_gap, contract_report_broken, csv_sink, table_sink, csv_quoted, csv_bad_numbers, csv_long_integers,
        csv_stray_quotes,
    )
}

# --- DuckDB SQL ----------------------------------------------------------------


def _full_sql() -> str:
    value = {jobs.PREMIUMS_RENAMES[n]: f"o_orderkey * 100 + {i}" for i, n in enumerate(_NUMBERS)}
    value |= {jobs.PREMIUMS_RENAMES[n]: f"o_totalprice * {i + 2}" for i, n in enumerate(_AMOUNTS)}
    value |= {"fvigdesde": "CAST(o_orderdate AS DATE) + 1", "fvighasta": "CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE)"}
    return "SELECT " + ", ".join(f"{value.get(a, e)} AS {a}" for e, a in O.PREMIUM_COLUMNS) + " FROM orders"


_GAP = """gap AS (
  SELECT * REPLACE (CASE WHEN date_trunc('month', o_orderdate) = DATE '1996-03-01'
                         THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) ELSE CAST(o_orderdate AS DATE) END AS o_orderdate)
  FROM orders
),"""


def _on_gap(sql: str) -> str:
    return sql.replace("FROM orders", "FROM gap").replace("WITH ", f"WITH {_GAP}", 1)


_ODD = """CASE p_partkey % 5 WHEN 0 THEN chr(160) || upper(p_name) || chr(9) WHEN 1 THEN '  o''' || p_name || ',juan  3RA 3ra.x'
  WHEN 2 THEN replace(p_name, ' ', '-') WHEN 3 THEN 'Álvarez ñandú ' || p_name || chr(12288)
  ELSE chr(10) || upper(p_name[1:3]) || p_name || ' ' || chr(160) || ' ' END"""
_ODD_PART = f"(SELECT p_partkey, p_name, p_type, {_ODD} AS odd FROM part)"

_SPARK_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "DATE": "date"}


def measured_report(contract: dict[str, str], frame: str, present: list[str]) -> str:
    """A contract report whose found types are read from the frame itself."""
    labels = " ".join(f"WHEN '{d}' THEN '{t}'" for d, t in _SPARK_NAMES.items())
    wanted = ", ".join(f"('{n}', '{spark_type(t).simpleString()}')" for n, t in contract.items())
    counts = []
    for name in present:
        rng = value_range(contract[name])
        bad = f"count(*) FILTER (WHERE {name} < {rng[0]} OR {name} > {rng[1]})" if rng else "CAST(0 AS BIGINT)"
        counts.append(f"SELECT '{name}' AS column_name, count({name}) AS non_null, {bad} AS out_of_domain FROM frame")
    return f"""WITH frame AS ({frame}), wanted(column_name, expected) AS (VALUES {wanted}),
types AS (SELECT column_name, CASE column_type {labels} END AS found FROM (DESCRIBE {frame})),
counts AS ({" UNION ALL ".join(counts)})
SELECT w.column_name, w.expected, t.found, coalesce(t.found = w.expected, false) AS ok, c.non_null, c.out_of_domain
FROM wanted w LEFT JOIN types t USING (column_name) LEFT JOIN counts c USING (column_name)"""


def oracle_sql() -> dict[str, str]:
    org = O.ORGANIZERS
    broken = (
        "SELECT * EXCLUDE (matricula) REPLACE (CAST(cod_grupo AS INTEGER) AS cod_grupo, nro_persona - 100 AS nro_persona), "
        f"'x' AS spare FROM ({org})"
    )
    return {
        "contract_report": measured_report(C.ORGANIZADORES, org, list(C.ORGANIZADORES)),
        "contract_report_broken": measured_report(C.ORGANIZADORES, broken, [c for c in C.ORGANIZADORES if c != "matricula"]),
        "rename_projection_full": _full_sql(),
        "left_chain_fanout": "SELECT c_custkey, c_name, CAST(o_orderkey % 40 AS INTEGER) AS o_group, n_name FROM customer "
        "LEFT JOIN orders ON c_custkey = 2 * o_custkey LEFT JOIN nation ON o_orderkey % 40 = n_nationkey",
        "title_case_odd": f"SELECT p_partkey, {O.t1('odd')} AS title FROM {_ODD_PART}",
        "strip_unicode_odd": f"SELECT p_partkey, {O.t2('odd')} AS stripped FROM {_ODD_PART}",
        "normalise_distinct_odd": f"SELECT DISTINCT {O.norm('odd')} AS nombre, {O.norm('p_type')} AS grupo FROM "
        f"(SELECT odd, p_type FROM {_ODD_PART} UNION ALL SELECT upper(p_name), p_type FROM part)",
        "month_prefix_gap": _on_gap(O.month_prefix_sql(YEAR)),
        "premiums_rerun_with_gap": _on_gap(O.PREMIUMS_LOAD),
        "csv_sink": "SELECT p_partkey, p_name, p_size, p_retailprice, (SELECT count(*) FROM part) AS rows_written FROM part",
        "table_sink": "SELECT cod_organizador, nombre, grupo, 2 * count(*) AS copies, "
        f"(SELECT count(*) FROM ({org})) AS rows_written FROM ({org}) WHERE cod_organizador >= 0 GROUP BY cod_organizador, nombre, grupo",
        "csv_quoted": "SELECT p_partkey, 'say \"' || p_name || '\", ' || p_brand || chr(10) || p_type AS note, p_size FROM part",
        "csv_long_integers": "SELECT o_orderkey, '123456789012' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS wide, "
        f"'{'9' * 37}' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS wider, "
        "'bigint' AS o_orderkey_type, 'decimal(38,0)' AS wide_type, 'string' AS wider_type FROM orders",
        "csv_stray_quotes": """SELECT CASE WHEN k > 2 THEN p_partkey END AS p_partkey,
  CASE WHEN k > 3 THEN p_name || ' 5"' WHEN k = 3 THEN p_name || ', "3"' END AS p_name, CASE WHEN k > 3 THEN 4 END AS n,
  CAST(k = 3 AS INTEGER) AS _cast_failures,
  CASE k WHEN 0 THEN p_partkey || ',"' || p_name || ',1' WHEN 1 THEN p_partkey || ',' || p_name || ',2,spare'
         WHEN 2 THEN p_partkey || ',' || p_name END AS _broken_line
FROM (SELECT *, p_partkey % 7 AS k FROM part)""",
        "csv_bad_numbers": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice END AS o_totalprice, "
        "CASE WHEN o_orderkey % 2 = 1 THEN 0 ELSE 1 END AS _cast_failures FROM orders",
    }
