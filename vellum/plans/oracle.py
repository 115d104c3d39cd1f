"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on DuckDB over views named after the driver's tables and
returns the same column names and types as the Spark query.
"""

from __future__ import annotations

# Title case / strip / collapse in DuckDB (RE2): \s there is ASCII only, so
# Unicode white space is spelt out: \t \n \v \f \r, U+0085 and \p{Z}.
_WS = r"[\t\n\x0B\f\r\x{85}\p{Z}]"


def t1(x: str) -> str:
    return (
        "array_to_string(list_transform(regexp_extract_all(" + x + r", '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'), "
        "lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def t2(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


# Python's re \s (collapse) also takes U+001C..U+001F.
_PY_WS = r"[\t\n\x0B\f\r\x{1C}-\x{1F}\x{85}\p{Z}]"


def collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{_PY_WS}+', ' ', 'g'), '^ | $', '', 'g')"


def norm(x: str) -> str:
    return t2(t1(x))


PREMIUM_COLUMNS = [
    ("CAST(o_orderdate AS DATE)", "femision"),
    ("NULL::DATE", "fvigdesde"),
    ("NULL::DATE", "fvighasta"),
    ("o_orderkey", "op"),
    ("NULL::BIGINT", "componente"),
    ("NULL::BIGINT", "suplemento"),
    ("NULL::BIGINT", "cod_rama"),
    ("o_custkey", "poliza"),
    ("NULL::DOUBLE", "aa_componente"),
    ("NULL::BIGINT", "cap"),
    ("NULL::BIGINT", "var"),
    ("NULL::BIGINT", "air"),
    ("o_orderstatus", "origen"),
    ("NULL::BIGINT", "anio_componente"),
    ("o_orderpriority", "cod_cobertura_aut"),
    ("NULL::BIGINT", "cod_tipo_veh"),
    ("NULL::BIGINT", "cod_uso_veh"),
    ("NULL::DOUBLE", "prima_tarifa_suplemento"),
    ("NULL::DOUBLE", "bon_prima_suplemento"),
    ("NULL::DOUBLE", "premio_suplemento"),
    ("NULL::DOUBLE", "premio_cobrado_suplemento"),
    ("o_custkey", "cod_organizador"),
    ("NULL::BIGINT", "cod_productor"),
    ("NULL::DOUBLE", "prima_tarifa_componente"),
    ("NULL::DOUBLE", "prima_rc_tarifa_componente"),
    ("NULL::DOUBLE", "prima_casco_tarifa_componente"),
    ("o_totalprice", "prima_neta_componente"),
    ("NULL::DOUBLE", "prima_rc_neta_componente"),
    ("NULL::DOUBLE", "prima_casco_neta_componente"),
]


def _select(cols) -> str:
    return ",\n  ".join(f"{e} AS {a}" for e, a in cols)


RENAME_PROJECTION = f"SELECT\n  {_select(PREMIUM_COLUMNS)}\nFROM orders"

ORGANIZERS = f"""
SELECT DISTINCT
  c.c_custkey AS cod_organizador,
  c.c_custkey AS nro_persona,
  {norm('c.c_name')} AS nombre,
  NULL::VARCHAR AS domicilio,
  NULL::BIGINT AS cp,
  NULL::BIGINT AS cp_sufijo,
  NULL::VARCHAR AS localidad,
  CAST(c.c_nationkey AS VARCHAR) AS cod_provincia,
  NULL::VARCHAR AS tipo_doc,
  NULL::BIGINT AS nro_doc,
  NULL::VARCHAR AS cuit,
  NULL::VARCHAR AS provincia,
  NULL::VARCHAR AS cod_inder_provincia,
  NULL::BIGINT AS matricula,
  CAST(r.r_regionkey AS BIGINT) AS cod_grupo,
  {norm('r.r_name')} AS grupo
FROM customer c
LEFT JOIN (
  SELECT c2.c_custkey AS gjinte, n.n_regionkey AS gjgrup
  FROM customer c2 JOIN nation n ON c2.c_nationkey = n.n_nationkey
) rel ON c.c_custkey = rel.gjinte
LEFT JOIN region r ON rel.gjgrup = r.r_regionkey
WHERE c.c_mktsegment = 'AUTOMOBILE' AND lower(rtrim(c.c_name)) <> 'libre'
"""

MOTOR_COVERAGES = """
SELECT CAST(p_partkey AS VARCHAR) AS cod_cobertura, p_partkey AS or_cobertura,
  p_type AS cat_cobertura, CAST(p_size AS BIGINT) AS or_cat_cobertura, p_size AS rt,
  NULL::INTEGER AS rp, NULL::INTEGER AS it, NULL::INTEGER AS ip, NULL::INTEGER AS at,
  NULL::INTEGER AS ap
FROM part
"""

OTHER_COVERAGES = """
SELECT CAST(s_nationkey AS BIGINT) AS cod_rama, s_suppkey AS cod_cobertura,
  s_name AS cobertura, CAST(s_acctbal AS FLOAT) AS pormilaje, NULL::VARCHAR AS informe
FROM supplier
"""


def _month_runs(year: int, keys: str = "") -> str:
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""
m AS (
  SELECT {k}(year(o_orderdate) - {year}) * 12 + month(o_orderdate) - 1 AS idx, count(*) AS n
  FROM orders WHERE o_orderdate >= DATE '{year}-01-01' GROUP BY ALL
),
r AS (SELECT *, row_number() OVER ({part}ORDER BY idx) - 1 AS rn FROM m),
kept AS (SELECT * FROM r WHERE idx = rn)"""


def month_prefix_sql(year: int) -> str:
    return f"""WITH {_month_runs(year)}
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, count(*) AS months_processed, {year} AS year
FROM kept"""


PREMIUMS_LOAD = f"""WITH {_month_runs(1995)}
SELECT o_orderkey AS op, CAST(o_orderdate AS DATE) AS femision, o_custkey AS cod_organizador,
  o_totalprice AS prima_neta_componente, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
FROM orders
WHERE o_orderdate >= DATE '1995-01-01'
  AND (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 IN (SELECT idx FROM kept)
"""

MONTH_PREFIX_BY_CUSTOMER = f"""WITH {_month_runs(1995, 'o_custkey')}
SELECT o_custkey, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS months_processed
FROM kept GROUP BY o_custkey
"""


_EXISTS = {
    "orders_in_1998": "SELECT 1 FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'",
    "automobile_customers": "SELECT 1 FROM customer WHERE c_mktsegment = 'AUTOMOBILE'",
    "region_antarctica": "SELECT 1 FROM region WHERE r_name = 'ANTARCTICA'",
}
PRE_CHECKS = (
    "\nUNION ALL\n".join(f"SELECT '{k}' AS check_name, EXISTS ({v}) AS passed" for k, v in _EXISTS.items())
    + "\nUNION ALL\nSELECT 'all', "
    + " AND ".join(f"EXISTS ({v})" for v in _EXISTS.values())
)

# The outcome log replayed literally, one step per outcome (recursive CTE).
_WALK = """
ev AS (
  SELECT user_id AS process, ts, event_id AS seq, event_type <> 'error' AS ok,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i
  FROM events
),
walk AS (
  SELECT process, CAST(0 AS BIGINT) AS i, 'IDLE' AS state,
         CAST(NULL AS TIMESTAMP) AS started, CAST(NULL AS TIMESTAMP) AS ended
  FROM (SELECT DISTINCT process FROM ev) p
  UNION ALL
  SELECT w.process, e.i,
    CASE WHEN NOT e.ok THEN 'FAILED' WHEN w.state = 'IDLE' THEN 'RUNNING'
         WHEN w.state = 'RUNNING' THEN 'SUCCESS' ELSE 'IDLE' END,
    CASE WHEN e.ok AND w.state = 'IDLE' THEN e.ts
         WHEN e.ok AND w.state IN ('SUCCESS', 'FAILED') THEN NULL ELSE w.started END,
    CASE WHEN e.ok AND w.state IN ('IDLE', 'SUCCESS', 'FAILED') THEN NULL ELSE e.ts END
  FROM walk w JOIN ev e ON e.process = w.process AND e.i = w.i + 1
),
last AS (
  SELECT process, max(i) AS n, count(*) AS outcomes, count(*) FILTER (WHERE NOT ok) AS failures
  FROM ev GROUP BY process
),
final AS (SELECT w.*, l.outcomes, l.failures FROM walk w JOIN last l ON w.process = l.process AND w.i = l.n)
"""

LIFECYCLE_STATUS = f"WITH RECURSIVE {_WALK}\nSELECT process, state AS status, outcomes, failures FROM final"

LIFECYCLE_AUDIT = f"""WITH RECURSIVE {_WALK}
SELECT e.process, e.ts, e.seq, e.ok, p.state AS from_state, w.state AS to_state
FROM ev e
JOIN walk w ON w.process = e.process AND w.i = e.i
JOIN walk p ON p.process = e.process AND p.i = e.i - 1
"""

RUN_DURATION = f"""WITH RECURSIVE {_WALK}
SELECT process, state AS status, started, ended,
  CASE WHEN state IN ('SUCCESS', 'FAILED') AND started IS NOT NULL AND ended IS NOT NULL
       THEN (epoch_us(ended) - epoch_us(started)) / 1000000.0 END AS duration_s
FROM final
"""

MAY_RUN = f"""WITH RECURSIVE {_WALK},
procs AS (SELECT DISTINCT user_id AS process FROM events),
edges AS (
  SELECT DISTINCT process, depends_on FROM (
    SELECT process, process // 2 AS depends_on FROM procs
    UNION ALL SELECT process, process // 3 FROM procs
  ) WHERE process <> depends_on
)
SELECT p.process,
  coalesce(bool_and(CASE WHEN e.depends_on IS NOT NULL THEN coalesce(f.state = 'SUCCESS', false) END), true) AS may_run,
  count(e.depends_on) AS dependencies
FROM procs p
LEFT JOIN edges e ON p.process = e.process
LEFT JOIN final f ON e.depends_on = f.process
GROUP BY p.process
"""

RUN_LOG_LATEST = """
SELECT process, ts AS last_ts, seq AS last_seq, ok AS last_ok, runs FROM (
  SELECT user_id AS process, ts, event_id AS seq, event_type <> 'error' AS ok,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
    count(*) OVER (PARTITION BY user_id) AS runs
  FROM events
) WHERE rn = 1
"""


RUN_DATASETS = f"""
SELECT 'coberturas_automotores' AS dataset, count(*) AS rows, NULL::BIGINT AS months, true AS ok,
  NULL::VARCHAR AS error FROM part
UNION ALL SELECT 'coberturas_ramas_varias', count(*), NULL, true, NULL FROM supplier
UNION ALL SELECT 'organizadores', count(*), NULL, true, NULL FROM ({ORGANIZERS})
UNION ALL SELECT 'primas_automotores_x_componente', total_rows, months_processed, true, NULL
  FROM ({month_prefix_sql(1995)})
"""


def oracle_sql() -> dict[str, str]:
    from vellum.plans.edge_queries import oracle_sql as edge_sql
    from vellum.plans.history_queries import oracle_sql as history_sql

    org = ORGANIZERS
    return edge_sql() | history_sql() | {
        "rename_projection": RENAME_PROJECTION,
        "code_and_name_filter": "SELECT c_custkey, c_name, c_mktsegment FROM customer "
        "WHERE c_mktsegment = 'AUTOMOBILE' AND c_name <> 'Customer#000000007'",
        "collated_not_equal": "SELECT p_partkey, p_name FROM part WHERE lower(rtrim(p_name)) <> 'small ring'",
        "month_slice": "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders "
        "WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3",
        "left_chain": "SELECT c_custkey, c_name, n_name, r_name FROM customer "
        "LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
        "flat_fact": "SELECT o.o_orderkey AS op, o.o_custkey AS cod_organizador, "
        "o.o_totalprice AS prima_neta_componente, org.nombre, org.grupo "
        f"FROM orders o LEFT JOIN ({org}) org ON o.o_custkey = org.cod_organizador",
        "title_case": f"SELECT p_partkey, {t1('p_name')} AS p_name_title, {t1('p_type')} AS p_type_title FROM part",
        "strip_unicode": f"SELECT doc_id, {t2('text')} AS text_stripped FROM documents",
        "collapse_spaces": f"SELECT doc_id, {collapse('text')} AS text_collapsed FROM documents",
        "normalise_distinct": f"SELECT DISTINCT {norm('p_name')} AS nombre, {norm('p_type')} AS grupo FROM part",
        "organizers": org,
        "write_and_count": "SELECT count(*) AS rows, count(*) AS rows_read_back, "
        "'coberturas_automotores' AS table_name FROM part",
        "append_twice": "SELECT 2 * count(*) AS rows_written, 2 * count(*) AS rows_read_back, "
        "count(DISTINCT p_partkey) AS distinct_codes FROM part",
        "skip_empty": "SELECT 'all' AS input, count(*) AS rows, count(*) > 0 AS written, "
        "'coberturas_ramas_varias' AS table_name FROM supplier UNION ALL "
        "SELECT 'none', count(*) FILTER (WHERE s_nationkey < 0), count(*) FILTER (WHERE s_nationkey < 0) > 0, "
        "'coberturas_ramas_varias' FROM supplier",
        "month_counts": "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS rows "
        "FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1",
        "month_prefix": month_prefix_sql(1995),
        "month_prefix_empty_january": month_prefix_sql(2002),
        "month_prefix_by_customer": MONTH_PREFIX_BY_CUSTOMER,
        "premiums_load": PREMIUMS_LOAD,
        "pre_checks": PRE_CHECKS,
        "domain_violations": "SELECT count(*) AS rows, "
        "count(*) FILTER (WHERE l_orderkey < 0 OR l_orderkey > 4294967295) AS l_orderkey_violations, "
        "count(*) FILTER (WHERE l_partkey < 0 OR l_partkey > 4294967295) AS l_partkey_violations, "
        "count(*) FILTER (WHERE l_suppkey < 0 OR l_suppkey > 4294967295) AS l_suppkey_violations, "
        "count(*) FILTER (WHERE l_linenumber < 0 OR l_linenumber > 65535) AS l_linenumber_violations, "
        "count(*) FILTER (WHERE CAST(trunc(l_quantity - 25) AS BIGINT) < 0 "
        "OR CAST(trunc(l_quantity - 25) AS BIGINT) > 4294967295) AS qty_offset_violations FROM lineitem",
        "typed_arrival": "SELECT count(*) AS rows, "
        "count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS BIGINT) IS NULL) "
        "AS rows_with_failures, "
        "count(*) FILTER (WHERE o_orderpriority IS NOT NULL AND TRY_CAST(o_orderpriority AS BIGINT) IS NULL) "
        "AS failed_values, CAST(sum(o_orderkey) AS BIGINT) AS op_sum FROM orders",
        "csv_decimal_comma": "SELECT o_orderkey, o_totalprice FROM orders",
        "csv_scan": "SELECT p_partkey, p_name, p_size, p_retailprice FROM part",
        "parquet_scan": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
        "WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1996-07-01'",
        "source_override": MOTOR_COVERAGES,
        "read_back": f"SELECT * FROM ({org}) WHERE cod_organizador >= 0",
        "preview": f"SELECT * FROM ({org}) ORDER BY cod_organizador, cod_grupo LIMIT 20",
        "workbook_folder": "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, "
        "o_orderstatus FROM orders",
        "query_params": "SELECT c_custkey, c_name, c_acctbal FROM customer "
        "WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000.0",
        "coverages_motor": MOTOR_COVERAGES,
        "coverages_other": OTHER_COVERAGES,
        "reuse_frame": "SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_partkey AS VARCHAR) AS cod_cobertura, "
        "p.p_type AS cat_cobertura, p.p_size AS rt FROM lineitem l "
        "LEFT JOIN part p ON CAST(l.l_partkey AS VARCHAR) = CAST(p.p_partkey AS VARCHAR)",
        "run_datasets": RUN_DATASETS,
        "run_log_latest": RUN_LOG_LATEST,
        "lifecycle_status": LIFECYCLE_STATUS,
        "lifecycle_audit": LIFECYCLE_AUDIT,
        "run_duration": RUN_DURATION,
        "may_run": MAY_RUN,
    }
