"""Registered queries of time joins, histories, mergeable aggregates, arrival and sessions, and their DuckDB SQL."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators import arrival, history, readiness, rollups, runs, sessions, temporal
from vellum.operators.joins import flat_fact
from vellum.plans import standins as S
from vellum.plans.runlog_queries import process_edges
from vellum.session import shared_dir

# --- frames ----------------------------------------------------------------------


def price_periods(spark, sf_dir) -> DataFrame:
    """A period a line: its supplier's price from the shipping date for as many days as the quantity."""
    li = S.load(spark, sf_dir, "lineitem")
    fd = F.to_date("l_shipdate")
    return li.select("l_suppkey", "l_orderkey", "l_linenumber", fd.alias("fd"), F.date_add(fd, F.col("l_quantity").cast("int")).alias("fh"))


def order_points(spark, sf_dir) -> DataFrame:
    """Orders dealt to suppliers, a third of them to one; some without a supplier, some without a date."""
    k = F.col("o_orderkey")
    supplier = F.when(k % 3 == 0, 7).when(k % 10 == 1, None).otherwise(F.col("o_custkey") % 100).cast("bigint")
    return S.load(spark, sf_dir, "orders").select(
        "o_orderkey", supplier.alias("l_suppkey"), F.when(k % 11 != 2, F.to_date("o_orderdate")).alias("o_date")
    )


def dated_events(spark, sf_dir) -> DataFrame:
    """Events as visits of customers on days of the orders' years, a third of them of one customer."""
    i = F.col("event_id")
    day = F.date_add(F.lit(dt.date(1995, 1, 1)), (i * 37 % 2500).cast("int"))
    who = F.when(i % 3 == 0, 7).when(i % 50 == 1, None).otherwise(F.col("user_id")).cast("bigint")
    return S.load(spark, sf_dir, "events").select("event_id", who.alias("o_custkey"), F.when(i % 41 != 5, day).alias("day"))


def past_orders(spark, sf_dir) -> DataFrame:
    return S.load(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("order_day"), "o_orderkey", "o_totalprice")


def quarter_snapshots(spark, sf_dir) -> DataFrame:
    """A snapshot a quarter: customers that ordered in it, with attributes that change now and then; rows repeat."""
    o = S.load(spark, sf_dir, "orders").select("o_custkey", F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("at"), "o_orderstatus", "o_orderpriority")
    low = o.groupBy("o_custkey", "at").agg(F.min("o_orderstatus").alias("status"), F.nullif(F.min("o_orderpriority"), F.lit("1-URGENT")).alias("priority"))
    return low.unionByName(low.where("o_custkey % 5 = 0"))


def later_orders(spark, sf_dir) -> DataFrame:
    """A later load of the orders: some gone, some come, some changed, some twice."""
    o, k = _orders(spark, sf_dir), F.col("o_orderkey")
    changed = o.where(k % 11 != 0).withColumns({
        "o_totalprice": F.when(k % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")),
    })
    come = o.where(k % 19 == 0).withColumn("o_orderkey", k + 100_000_000)
    return changed.unionByName(come).unionByName(changed.where(k % 23 == 0)).unionByName(changed.where(k % 29 == 0).withColumn("o_custkey", F.col("o_custkey") + 1))


def _orders(spark, sf_dir) -> DataFrame:
    return S.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def premium_facts(spark, sf_dir) -> DataFrame:
    """Premiums with the year, a line that is NULL now and then, the origin, and whole cents."""
    k = F.col("o_orderkey")
    return S.load(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.when(k % 7 != 0, F.substring("o_orderpriority", 1, 1)).alias("line"),
        F.col("o_orderstatus").alias("origin"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"), "o_custkey",
    )


CUBE = {"premiums": ("count", "*"), "cents": ("sum", "cents"), "least": ("min", "cents"), "most": ("max", "cents"), "lines": ("count", "line")}
LATE = dt.date(1997, 1, 1)

# --- queries -----------------------------------------------------------------------


def interval_join(spark, sf_dir):
    """Orders with all prices valid on their day."""
    return temporal.interval_join(order_points(spark, sf_dir), price_periods(spark, sf_dir), "l_suppkey", "o_date")


def interval_join_left(spark, sf_dir):
    """Orders with the span of their supplier's shipments, open for every third one: orders outside of any stay with NULLs."""
    spans = price_periods(spark, sf_dir).groupBy("l_suppkey").agg(F.min("fd").alias("s"), F.max("fh").alias("e"))
    spans = spans.select("l_suppkey", F.date_add("s", 400).alias("fd"), F.when(F.col("l_suppkey") % 3 != 0, F.date_sub("e", 300)).alias("fh"))
    return temporal.interval_join(order_points(spark, sf_dir), spans, "l_suppkey", "o_date", how="left")


def asof_join(spark, sf_dir):
    """Every visit with its customer's last order of an earlier day."""
    return temporal.asof_join(dated_events(spark, sf_dir), past_orders(spark, sf_dir), "o_custkey", "day", "order_day", tie="o_orderkey")


def asof_join_within(spark, sf_dir):
    """Every visit with its customer's last order of that day or up to 90 days before."""
    return temporal.asof_join(
        dated_events(spark, sf_dir), past_orders(spark, sf_dir), "o_custkey", "day", "order_day", tie="o_orderkey", strict=False, within=90
    )


def scd2_history(spark, sf_dir):
    return history.scd2(quarter_snapshots(spark, sf_dir), "o_custkey", "at", ["status", "priority"])


def scd2_late_snapshot(spark, sf_dir):
    """The history of all snapshots but one, written and read again, and that one put in late."""
    shots = quarter_snapshots(spark, sf_dir)
    path = shared_dir(spark, "scd2")
    history.scd2(shots.where(F.col("at") != LATE), "o_custkey", "at", ["status", "priority"]).write.parquet(path)
    late = shots.where(F.col("at") == LATE).drop("at")
    until = shots.where(F.col("at") > LATE).agg(F.min("at")).first()[0]
    return history.with_late_snapshot(spark.read.parquet(path), late, "o_custkey", ["status", "priority"], LATE, until)


def snapshot_diff(spark, sf_dir):
    return history.snapshot_diff(_orders(spark, sf_dir), later_orders(spark, sf_dir), "o_orderkey")


def premiums_cube(spark, sf_dir):
    return rollups.cube(premium_facts(spark, sf_dir), ["year", "line", "origin"], CUBE)


def premiums_rollup(spark, sf_dir):
    return rollups.rollup(premium_facts(spark, sf_dir), ["year", "line", "origin"], CUBE)


def premiums_grouping_sets(spark, sf_dir):
    return rollups.grouping_sets(premium_facts(spark, sf_dir), [["year", "origin"], ["line"], []], CUBE)


def distinct_by_span(spark, sf_dir):
    """Customers a year and in all: sketches a month, stored and merged, beside the exact numbers."""
    facts = S.load(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), "o_custkey")
    path = shared_dir(spark, "sketches")
    rollups.distinct_sketches(facts, ["month"], "o_custkey").write.parquet(path)
    stored = spark.read.parquet(path).withColumn("span", F.explode(F.array(F.year("month"), F.lit(0))))
    exact = facts.withColumn("span", F.explode(F.array(F.year("month"), F.lit(0)))).groupBy("span").agg(F.countDistinct("o_custkey").alias("customers"))
    both = exact.join(rollups.merged_distinct(stored, ["span"]), "span")
    off = F.abs(F.col("estimate") - F.col("customers")) / F.col("customers")
    return both.select("span", "customers", (off <= rollups.hll_error()).alias("within_error"))


def price_quantiles(spark, sf_dir):
    """Median, 90 and 99 per cent of the order prices a priority, a third of the orders in one of them."""
    facts = S.load(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, "hot").otherwise(F.col("o_orderpriority")).alias("line"), "o_totalprice")
    return rollups.exact_quantiles(facts, "line", "o_totalprice", [0.5, 0.9, 0.99])


CONTRACT = {"user_id": "UInt32", "value": "Float64", "event_type": "String"}


def _as_json(spark, sf_dir) -> DataFrame:
    e, kind = S.load(spark, sf_dir, "events"), F.col("event_id") % 7
    plain = F.to_json(F.struct("user_id", "value", "event_type"))
    text = (
        F.when(kind == 1, F.to_json(F.struct("user_id", "event_type")))
        .when(kind == 2, F.to_json(F.struct("user_id", "value", "event_type", F.lit(1).alias("zone"), F.struct("value").alias("more"))))
        .when(kind == 3, F.to_json(F.struct("user_id", F.lit("much").alias("value"), "event_type")))
        .when(kind == 4, F.concat(plain, F.lit(",")))
        .when(kind == 5, F.lit("[1, 2]"))
        .when((kind == 6) & (F.col("event_id") % 2 == 0), F.lit(None))
        .otherwise(plain)
    )
    return e.select("event_id", text.alias("json"))


def variant_arrival(spark, sf_dir):
    return arrival.variant_arrival(_as_json(spark, sf_dir), "json", CONTRACT).drop("_variant")


def variant_report(spark, sf_dir):
    return arrival.arrival_report(arrival.variant_arrival(_as_json(spark, sf_dir), "json", CONTRACT), CONTRACT)


def _sessions(spark, sf_dir, gap, longest):
    log = S.load(spark, sf_dir, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")))
    return sessions.sessions(log, "user_id", "ts", gap, longest, F.col("event_type") == "error")


def event_sessions(spark, sf_dir):
    """Sessions with a gap of an hour."""
    return _sessions(spark, sf_dir, 3600, None)


def event_sessions_split(spark, sf_dir):
    """Sessions with a gap of six hours, in parts of a day."""
    return _sessions(spark, sf_dir, 21_600, 86_400)


def event_windows(spark, sf_dir):
    """Events a type in windows of a day, every six hours."""
    return sessions.sliding_counts(S.load(spark, sf_dir, "events"), "ts", "event_type", "1 day", "6 hours")


BUCKETS = 8


def bucketed_sides(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """lineitem and orders as tables with buckets on the order key, below the shared folder; the names are free again."""
    out = []
    for name, key, columns in (("lineitem", "l_orderkey", ["l_orderkey", "l_linenumber", "l_quantity"]), ("orders", "o_orderkey", ["o_orderkey", "o_custkey", "o_orderstatus"])):
        table = f"vellum_{name}_{uuid.uuid4().hex}"
        source = S.load(spark, sf_dir, name).select(*columns).withColumnRenamed(key, "orderkey")
        source.repartition(BUCKETS, "orderkey").write.bucketBy(BUCKETS, "orderkey").sortBy("orderkey").option("path", shared_dir(spark, f"bucketed-{name}")).saveAsTable(table)
        out.append(spark.table(table))
        # The data stay where the path says; the frame knows its files and buckets.
        spark.sql(f"DROP TABLE {table}")
    return out[0], out[1]


def bucketed_flat_fact(spark, sf_dir):
    """Lines with their orders from bucketed tables."""
    return flat_fact(*bucketed_sides(spark, sf_dir), "orderkey")


def transitive_readiness(spark, sf_dir):
    """Processes over whole chains: p waits for p // 2 and p // 3, and process 1 for 5, which closes cycles."""
    status = runs.lifecycle_status(S.outcome_log(spark, sf_dir)).select("process", "status")
    path = shared_dir(spark, "process-status")
    status.write.parquet(path)
    status = spark.read.schema("process bigint, status string").parquet(path)
    procs = status.select("process")
    edges = process_edges(procs).unionByName(procs.where("process = 1").withColumn("depends_on", F.lit(5).cast("bigint")))
    return readiness.transitive_readiness(procs, edges, status)


QUERIES = {
    f.__name__: f
    for f in (
        interval_join, interval_join_left, asof_join, asof_join_within, scd2_history, scd2_late_snapshot, snapshot_diff, premiums_cube,
        premiums_rollup, premiums_grouping_sets, distinct_by_span, price_quantiles, variant_arrival, variant_report, event_sessions,
        event_sessions_split, event_windows, bucketed_flat_fact, transitive_readiness,
    )
}

# --- DuckDB SQL ----------------------------------------------------------------------

_POINTS = """points AS (
  SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 10 = 1 THEN NULL ELSE o_custkey % 100 END AS BIGINT) AS l_suppkey,
         CASE WHEN o_orderkey % 11 <> 2 THEN CAST(o_orderdate AS DATE) END AS o_date FROM orders
), lines AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS fd, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS fh FROM lineitem
)"""
_VISITS = """visits AS (
  SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 50 = 1 THEN NULL ELSE user_id END AS BIGINT) AS o_custkey,
         CASE WHEN event_id % 41 <> 5 THEN DATE '1995-01-01' + CAST(event_id * 37 % 2500 AS INTEGER) END AS day FROM events
), past AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day, o_orderkey, o_totalprice FROM orders
)"""


def _asof(test: str) -> str:
    return f"""WITH {_VISITS}, best AS (
  SELECT v.event_id, max(row(p.order_day, p.o_orderkey, p.o_totalprice)) AS b FROM visits v JOIN past p
  ON v.o_custkey = p.o_custkey AND {test} GROUP BY v.event_id
)
SELECT v.*, b[1] AS order_day, b[2] AS o_orderkey, b[3] AS o_totalprice FROM visits v LEFT JOIN best USING (event_id)"""


_SCD2 = """WITH RECURSIVE shots AS (
  SELECT o_custkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS shot, min(o_orderstatus) AS status, nullif(min(o_orderpriority), '1-URGENT') AS priority
  FROM orders GROUP BY 1, 2
), dates AS (
  SELECT shot, lead(shot) OVER (ORDER BY shot) AS next FROM (SELECT DISTINCT shot FROM shots)
), numbered AS (
  SELECT s.*, d.next, row_number() OVER (PARTITION BY o_custkey ORDER BY shot) AS n FROM shots s JOIN dates d USING (shot)
), walk AS (
  SELECT o_custkey, n, status, priority, shot AS fd, next AS fh FROM numbered WHERE n = 1
  UNION ALL
  SELECT s.o_custkey, s.n, s.status, s.priority,
         CASE WHEN w.fh = s.shot AND w.status IS NOT DISTINCT FROM s.status AND w.priority IS NOT DISTINCT FROM s.priority THEN w.fd ELSE s.shot END, s.next
  FROM walk w JOIN numbered s ON s.o_custkey = w.o_custkey AND s.n = w.n + 1
)
SELECT o_custkey, status, priority, fd, arg_max(struct_pack(e := fh), n).e AS fh FROM walk GROUP BY o_custkey, status, priority, fd"""

_DIFF = """WITH b AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
), c AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM b WHERE o_orderkey % 11 <> 0
), a AS (
  SELECT * FROM c UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice FROM b WHERE o_orderkey % 19 = 0
  UNION ALL SELECT * FROM c WHERE o_orderkey % 23 = 0 UNION ALL SELECT o_orderkey, o_custkey + 1, o_orderstatus, o_totalprice FROM c WHERE o_orderkey % 29 = 0
), n AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(sum(x) AS BIGINT) AS n_before, CAST(sum(y) AS BIGINT) AS n_after
  FROM (SELECT *, 1 AS x, 0 AS y FROM b UNION ALL SELECT *, 0, 1 FROM a) GROUP BY ALL HAVING sum(x) <> sum(y)
), gone AS (SELECT * FROM n WHERE n_after = 0), come AS (SELECT * FROM n WHERE n_before = 0), pairs AS (
  SELECT o_orderkey FROM n GROUP BY o_orderkey
  HAVING count(*) = 2 AND sum(n_before) FILTER (WHERE n_after = 0) = 1 AND sum(n_after) FILTER (WHERE n_before = 0) = 1
)
SELECT n.o_orderkey, CASE WHEN n_after = 0 THEN 'deleted' WHEN n_before = 0 THEN 'inserted' ELSE 'recounted' END AS kind, n_before, n_after,
       '' AS changed_columns, o_custkey, o_orderstatus, o_totalprice FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM pairs)
UNION ALL
SELECT c.o_orderkey, 'changed', 1, 1, concat_ws(',', CASE WHEN c.o_custkey IS DISTINCT FROM g.o_custkey THEN 'o_custkey' END,
         CASE WHEN c.o_orderstatus IS DISTINCT FROM g.o_orderstatus THEN 'o_orderstatus' END,
         CASE WHEN c.o_totalprice IS DISTINCT FROM g.o_totalprice THEN 'o_totalprice' END), c.o_custkey, c.o_orderstatus, c.o_totalprice
FROM come c JOIN gone g USING (o_orderkey) WHERE c.o_orderkey IN (SELECT o_orderkey FROM pairs)"""


def _sets(keys: list[str], by: str) -> str:
    id_of = " + ".join(f"{1 << (len(keys) - 1 - i)} * grouping({k})" for i, k in enumerate(keys))
    return f"""SELECT {", ".join(keys)}, CAST({id_of} AS BIGINT) AS grouping_id, count(*) AS premiums, CAST(sum(cents) AS BIGINT) AS cents,
  min(cents) AS least, max(cents) AS most, count(rline) AS lines
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority[1:1] END AS line, line AS rline,
             o_orderstatus AS origin, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders) GROUP BY {by}"""


def _sessions_sql(gap: int, longest: int | None) -> str:
    part = f"CAST(floor((epoch_us(ts) - epoch_us(session_start)) / {longest * 1_000_000}) AS BIGINT)" if longest else "CAST(0 AS BIGINT)"
    return f"""WITH log AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id, ts, event_type FROM events
), marked AS (
  SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) <= {gap * 1_000_000} THEN 0 ELSE 1 END AS new FROM log
), numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM marked
), started AS (
  SELECT *, min(ts) OVER (PARTITION BY user_id, s) AS session_start FROM numbered
)
SELECT user_id, session_start, {part} AS part, min(ts) AS started, max(ts) AS ended, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS flagged
FROM started GROUP BY user_id, session_start, {part}"""


# The status: no failure -> the number of trues; else the trues after the last false.
_READINESS = """WITH RECURSIVE log AS (
  SELECT user_id AS process, ts, event_id AS seq, event_type <> 'error' AS ok FROM events
), marks AS (
  SELECT process, max(row(ts, seq)) FILTER (WHERE NOT ok) AS last_false FROM log GROUP BY process
), final AS (
  SELECT process, count(*) FILTER (WHERE NOT ok) AS f, count(*) FILTER (WHERE ok AND (last_false IS NULL OR row(ts, seq) > last_false)) AS k
  FROM log JOIN marks USING (process) GROUP BY process
), done AS (
  SELECT process, CASE WHEN f = 0 THEN k % 3 = 2 ELSE k > 0 AND (k - 1) % 3 = 2 END AS ok FROM final
), edges AS (
  SELECT DISTINCT process, d AS needs FROM (SELECT process, unnest([process // 2, process // 3]) AS d FROM done) WHERE d <> process
  UNION SELECT process, 5 FROM done WHERE process = 1
), reach AS (
  SELECT process, needs, 1 AS depth, [process, needs] AS path FROM edges
  UNION ALL
  SELECT r.process, e.needs, r.depth + 1, list_append(r.path, e.needs) FROM reach r JOIN edges e ON r.needs = e.process
  WHERE NOT list_contains(r.path[2:], e.needs) AND r.needs <> r.process
), pairs AS (
  SELECT process, needs, min(depth) AS depth FROM reach GROUP BY process, needs
), per AS (
  SELECT p.process, count(*) AS prerequisites, max(depth) AS depth, min(row(depth, p.needs)) FILTER (WHERE NOT coalesce(d.ok, false)) AS b,
         bool_or(p.process = p.needs) AS in_cycle, bool_and(coalesce(d.ok, false)) AS every
  FROM pairs p LEFT JOIN done d ON p.needs = d.process GROUP BY p.process
)
SELECT process, coalesce(prerequisites, 0) AS prerequisites, CAST(coalesce(depth, 0) AS INTEGER) AS depth, b[2] AS first_blocking,
       coalesce(in_cycle, false) AS in_cycle, coalesce(every, true) AND NOT coalesce(in_cycle, false) AS may_run
FROM done LEFT JOIN per USING (process)"""


def oracle_sql() -> dict[str, str]:
    return {
        "interval_join": f"WITH {_POINTS} SELECT p.*, l_orderkey, l_linenumber, fd, fh FROM points p JOIN lines l ON p.l_suppkey = l.l_suppkey AND fd <= o_date AND o_date < fh",
        "interval_join_left": f"""WITH {_POINTS}, spans AS (
  SELECT l_suppkey, min(fd) + 400 AS fd, CASE WHEN l_suppkey % 3 <> 0 THEN max(fh) - 300 END AS fh FROM lines GROUP BY l_suppkey
) SELECT p.*, fd, fh FROM points p LEFT JOIN spans s ON p.l_suppkey = s.l_suppkey AND fd <= o_date AND (fh IS NULL OR o_date < fh)""",
        "asof_join": _asof("p.order_day < v.day"),
        "asof_join_within": _asof("p.order_day <= v.day AND v.day - p.order_day <= 90"),
        "scd2_history": _SCD2,
        "scd2_late_snapshot": _SCD2,
        "snapshot_diff": _DIFF,
        "premiums_cube": _sets(["year", "line", "origin"], "CUBE (year, line, origin)"),
        "premiums_rollup": _sets(["year", "line", "origin"], "ROLLUP (year, line, origin)"),
        "premiums_grouping_sets": _sets(["year", "origin", "line"], "GROUPING SETS ((year, origin), (line), ())"),
        "distinct_by_span": """SELECT span, count(DISTINCT o_custkey) AS customers, true AS within_error
FROM (SELECT CAST(unnest([year(o_orderdate), 0]) AS INTEGER) AS span, o_custkey FROM orders) GROUP BY span""",
        "price_quantiles": """SELECT line, count(*) AS n, quantile_cont(o_totalprice, 0.5) AS p50, quantile_cont(o_totalprice, 0.9) AS p90,
  quantile_cont(o_totalprice, 0.99) AS p99
FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE o_orderpriority END AS line, o_totalprice FROM orders) GROUP BY line""",
        "variant_arrival": _arrival_sql(),
        "variant_report": f"""WITH a AS ({_arrival_sql()}), f(field) AS (VALUES ('user_id'), ('value'), ('event_type'))
SELECT field, count(*) FILTER (WHERE NOT u AND NOT m) AS fit, count(*) FILTER (WHERE u) AS unfit, count(*) FILTER (WHERE m) AS missing, count(_malformed) AS malformed_rows
FROM (SELECT field, _malformed, list_contains(string_split(_unfit, ','), field) AS u, list_contains(string_split(_missing, ','), field) AS m FROM a, f) GROUP BY field""",
        "event_sessions": _sessions_sql(3600, None),
        "event_sessions_split": _sessions_sql(21_600, 86_400),
        "event_windows": """SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, event_type, count(*) AS events
FROM (SELECT unnest([time_bucket(INTERVAL 6 HOUR, ts) - i * INTERVAL 6 HOUR FOR i IN range(4)]) AS w, event_type FROM events) GROUP BY ALL""",
        "transitive_readiness": _READINESS,
        "bucketed_flat_fact": "SELECT l_orderkey AS orderkey, l_linenumber, l_quantity, o_custkey, o_orderstatus FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey",
    }


def _arrival_sql() -> str:
    full = "k IN (0, 2) OR (k = 6 AND event_id % 2 = 1)"
    plain = """'{"user_id":' || user_id || ',"value":' || value || ',"event_type":"' || event_type || '"}'"""
    return f"""SELECT event_id, CASE WHEN {full} OR k IN (1, 3) THEN user_id END AS user_id, CASE WHEN {full} THEN value END AS value,
  CASE WHEN {full} OR k IN (1, 3) THEN event_type END AS event_type, CASE WHEN k = 3 THEN 'value' ELSE '' END AS _unfit,
  CASE WHEN {full} OR k = 3 THEN '' WHEN k = 1 THEN 'value' ELSE 'user_id,value,event_type' END AS _missing,
  CASE WHEN k = 2 THEN 'more,zone' ELSE '' END AS _extra, CASE WHEN k = 5 THEN '[1, 2]' WHEN k = 4 THEN {plain} || ',' END AS _malformed
FROM (SELECT *, event_id % 7 AS k FROM events)"""
