"""Readers for the source kinds: database (JDBC), CSV, Parquet, workbooks.

Every reader returns a lazy DataFrame. Column pruning and filter pushdown
reach the Parquet scan and the JDBC query on their own; for a database, a
parallel read needs either ``predicates`` (one partition per predicate, e.g.
one per month) or a numeric ``partition_column`` with bounds.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.contracts import spark_type
from vellum.functions.casts import guarded_try_cast
from vellum.functions.dates import add_months, month_start

# Default ports of the database flavours (fixed values).
DEFAULT_PORTS = {"postgresql": 5432, "mysql": 3306}


def jdbc_url(flavour: str, host: str = "localhost", port: int | None = None, database: str = "") -> str:
    """JDBC url for ``postgresql`` / ``mysql`` / ``sqlite`` (``database`` = file)."""
    if flavour == "sqlite":
        return f"jdbc:sqlite:{database}"
    if flavour not in DEFAULT_PORTS:
        raise ValueError(f"unknown database flavour {flavour!r}")
    return f"jdbc:{flavour}://{host}:{port or DEFAULT_PORTS[flavour]}/{database}"


def sql_literal(value, backslash_escapes: bool = False) -> str:
    """A Python value as SQL text: NULL, numbers, booleans, text, dates, timestamps, lists for IN."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"{value} has no SQL literal")
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        text = value.replace("\\", "\\\\") if backslash_escapes else value
        return "'" + text.replace("'", "''") + "'"
    if isinstance(value, (list, tuple, set, frozenset)):
        if not value:
            raise ValueError("an empty list has no SQL literal")
        return "(" + ", ".join(sql_literal(v, backslash_escapes) for v in value) + ")"
    raise TypeError(f"no SQL literal for {type(value).__name__}")


#: Parts of a SQL text in which a colon is no parameter, a cast's double colon, then the parameter.
_SQL_PART = re.compile(r"""'(?:[^']|'')*'|"(?:[^"]|"")*"|`[^`]*`|--[^\n]*|/\*.*?\*/|::|:([A-Za-z_]\w*)""", re.S)


def bind_parameters(query: str, parameters: dict | None, backslash_escapes: bool = False) -> str:
    """The query with its ``:name`` parameters as literals; quoted text, comments and ``::`` casts are left alone.

    Every named parameter must be given, and every given one must occur. ``backslash_escapes``: for MySQL,
    whose text literals take the backslash as an escape.
    """
    if parameters is None:
        return query
    used = set()

    def literal(m: re.Match) -> str:
        name = m.group(1)
        if name is None:
            return m.group(0)
        if name not in parameters:
            raise KeyError(f"no value for parameter :{name}")
        used.add(name)
        return sql_literal(parameters[name], backslash_escapes)

    bound = _SQL_PART.sub(literal, query)
    if unused := sorted(set(parameters) - used):
        raise KeyError(f"parameters that the query does not have: {unused}")
    return bound


def read_jdbc(
    spark: SparkSession,
    url: str,
    *,
    query: str | None = None,
    table: str | None = None,
    parameters: dict | None = None,
    predicates: list[str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    properties: dict | None = None,
) -> DataFrame:
    """Run SQL (or read a table) in a database; the result as a DataFrame. ``parameters`` are the query's ``:names``."""
    if query is not None:
        query = bind_parameters(query, parameters, backslash_escapes=url.startswith("jdbc:mysql"))
    props = dict(properties or {})
    if predicates:
        relation = table or f"({query}) vellum_q"
        return spark.read.jdbc(url, relation, predicates=predicates, properties=props)
    reader = spark.read.format("jdbc").option("url", url)
    for k, v in props.items():
        reader = reader.option(k, v)
    if query is not None and partition_column is None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", table or f"({query}) vellum_q")
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 1))
        )
    return reader.load()


def month_predicates(date_column: str, year: int, months: int = 12) -> list[str]:
    """One range predicate per month from January of ``year`` (for ``predicates=``)."""
    start = month_start(year, 1)
    out = []
    for i in range(months):
        lo, hi = add_months(start, i), add_months(start, i + 1)
        out.append(f"{date_column} >= '{lo.isoformat()}' AND {date_column} < '{hi.isoformat()}'")
    return out


def read_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


_COMMA_NUMBER = r"^\s*[-+]?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?\s*$"
#: Integers that surely fit bigint, and those that surely fit decimal(38,0).
_BIGINT = r"^\s*-?\d{1,18}\s*$"
_WIDE_INTEGER = r"^\s*-?\d{1,38}\s*$"
_WIDER_INTEGER = r"^\s*-?\d{39,}\s*$"
#: A separator that no text has; a line that holds it all the same comes whole in the second column.
_NO_SEPARATOR = "\x1f"


def _decimal_comma_to_number(c):
    """"1.234,25" -> "1234.25"; NULL for text that is not in the comma form, such as "1.5"."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(c), r"\.", ""), ",", ".")
    return F.when(c.rlike(_COMMA_NUMBER), plain)


def _present(c):
    return c.isNotNull() & (F.trim(c) != "")


def _csv_lines(spark: SparkSession, path: str, header: bool, options: dict[str, str]) -> DataFrame:
    """The lines of the files (but for each file's header) as one text column."""
    reader = spark.read.options(**{k: v for k, v in options.items() if k in ("encoding", "charset", "lineSep")})
    reader = reader.option("header", str(header).lower()).option("sep", _NO_SEPARATOR).option("quote", "")
    raw = reader.option("columnNameOfCorruptRecord", "whole").schema("line string, whole string").csv(path)
    return raw.select(F.coalesce("whole", "line").alias("line"))


def _csv_fields(spark: SparkSession, path: str, separator: str, header: bool, multi_line: bool, options: dict[str, str], width: int | None) -> DataFrame:
    """All columns as text, and ``_broken_line``: the line where it does not parse, whose columns are then NULL."""
    quote = options.get("quote", '"')
    how = {"quote": quote, "escape": quote, **options, "sep": separator, "header": str(header).lower()}
    # Without a header it is the contract that says how many columns there are, else the first line.
    known = [f"_c{i}" for i in range(width)] if width is not None and not header else None
    names = known or spark.read.options(**how, multiLine=str(multi_line).lower()).csv(path).columns
    inner = ", ".join([*[f"c{i} string" for i in range(len(names))], "broken string"])
    how |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    if multi_line:
        parsed = spark.read.options(**how, multiLine="true").schema(inner).csv(path).select(F.struct("*").alias("r"), F.col("broken").alias("_b"))
    else:
        # A quote that opens a value and is never closed makes the number of quotes odd.
        line, mark = F.col("line"), F.lit(quote)
        odd = (F.length(line) - F.length(F.replace(line, mark, F.lit("")))) % 2 == 1
        opens = line.startswith(quote) | line.contains(separator + quote)
        lines = _csv_lines(spark, path, header, options)
        parsed = lines.select("line", F.from_csv("line", inner, how).alias("r"))
        unclosed = odd & opens if len(quote) == 1 else F.lit(False)
        parsed = parsed.select("r", F.when(unclosed, line).otherwise(F.col("r.broken")).alias("_b"))
    cells = [F.when(F.col("_b").isNull(), F.col(f"r.c{i}")).alias(n) for i, n in enumerate(names)]
    return parsed.select(*cells, F.col("_b").alias("_broken_line"))


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    separator: str = ",",
    decimal_comma: bool = True,
    header: bool = True,
    contract: dict[str, str] | None = None,
    schema: T.StructType | None = None,
    multi_line: bool = False,
    with_failures: bool = False,
    **options,
) -> DataFrame:
    """CSV scan, quotes doubled inside quoted values, with the decimal comma on by default.

    Numbers are read as text and converted with column expressions. With
    ``contract`` / ``schema`` a value that is not a number of the expected form
    (with ``decimal_comma``: grouped or plain digits and a comma, so never
    "1.5") is a failure. Columns are matched by header name, or by position
    when ``header`` is False. Without a contract, text columns whose every
    non-empty value is a number are converted (one aggregation pass, the cost
    of Spark's own inference): integers to bigint, to decimal(38,0) where one has
    more than 18 digits, and left as text beyond 38; others to double. Without
    ``decimal_comma`` the types are those of Spark's own inference.

    Nothing is lost in silence. A line that does not parse (a quoted value
    that is not closed, more or fewer values than columns) and a value that fails its
    cast end the query with an error that shows them, unless ``with_failures`` is set: then
    they become NULL, ``_cast_failures`` counts the row's failed values, and
    ``_broken_line`` holds the line.

    Files are split and read in parallel, a line a row. ``multi_line``: values may hold
    line breaks inside quotes. Each file is then read whole by one task, and an unclosed
    quote takes in all that follows in its file; so this is the caller's choice, never
    made from the data.
    """
    if contract is not None:
        schema = T.StructType([T.StructField(n, spark_type(t), True) for n, t in contract.items()])
    options = {k: str(v) for k, v in options.items()}
    raw = _csv_fields(spark, path, separator, header, multi_line, options, len(schema.fields) if schema is not None else None)
    names, broken = raw.columns[:-1], F.col("_broken_line")

    if schema is None and not decimal_comma:
        reader = spark.read.options(**{"quote": '"', "escape": '"', **options}).option("inferSchema", "true").option("multiLine", str(multi_line).lower())
        inferred = reader.option("header", str(header).lower()).option("sep", separator).csv(path).schema
        schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, inferred.fields, strict=True)])
    if schema is not None:
        texts = [F.col(f"`{f.name if header else names[i]}`") for i, f in enumerate(schema.fields)]
        plain = [
            _decimal_comma_to_number(c) if decimal_comma and isinstance(f.dataType, _NUMERIC) else c
            for c, f in zip(texts, schema.fields, strict=True)
        ]
        typed = [(f.name, c, guarded_try_cast(p, f.dataType)) for c, p, f in zip(texts, plain, schema.fields, strict=True)]
    else:
        # One aggregation: per column, how many values there are, and how many have none of the forms of numbers.
        probes = []
        for i, name in enumerate(names):
            c = F.col(f"`{name}`")
            probes.append(F.count_if(_present(c)).alias(f"any{i}"))
            probes.append(F.count_if(_present(c) & c.rlike(_WIDER_INTEGER)).alias(f"wider{i}"))
            for kind, pattern in (("num", _COMMA_NUMBER), ("int", _BIGINT), ("wide", _WIDE_INTEGER)):
                probes.append(F.count_if(_present(c) & ~c.rlike(pattern)).alias(f"{kind}{i}"))
        stats = raw.agg(*probes).first().asDict()
        typed = []
        for i, name in enumerate(names):
            c = F.col(f"`{name}`")
            if not stats[f"any{i}"] or stats[f"wider{i}"]:
                typed.append((name, c, c))
            elif not stats[f"int{i}"]:
                typed.append((name, c, guarded_try_cast(F.trim(c), "bigint")))
            elif not stats[f"wide{i}"]:
                typed.append((name, c, guarded_try_cast(F.trim(c), "decimal(38,0)")))
            elif not stats[f"num{i}"]:
                typed.append((name, c, guarded_try_cast(_decimal_comma_to_number(c), "double")))
            else:
                typed.append((name, c, c))
    if with_failures:
        count = sum((F.when(_present(c) & cast.isNull(), 1).otherwise(0) for _, c, cast in typed), F.lit(0))
        return raw.select(*[cast.alias(name) for name, _, cast in typed], count.alias("_cast_failures"), "_broken_line")
    complaint = F.raise_error(F.concat(F.lit("CSV line does not parse: "), broken))
    cells = []
    for name, c, cast in typed:
        bad = F.raise_error(F.concat(F.lit(f"CSV value of {name} is not of its type: "), c))
        cells.append(F.when(broken.isNotNull(), complaint).when(_present(c) & cast.isNull(), bad).otherwise(cast).alias(name))
    return raw.select(*cells)


def read_source(spark: SparkSession, kind: str, **kw) -> DataFrame:
    """Dispatch on the source kind: mysql/postgresql/sqlite/csv/excel/parquet."""
    kind = kind.lower()
    if kind in ("mysql", "postgresql", "sqlite", "jdbc"):
        return read_jdbc(spark, kw.pop("url"), **kw)
    if kind == "csv":
        return read_csv(spark, kw.pop("path"), **kw)
    if kind == "parquet":
        return read_parquet(spark, kw.pop("path"), **kw)
    if kind in ("excel", "xlsx", "workbook"):
        from vellum.sources.workbooks import read_workbooks

        return read_workbooks(spark, kw.pop("path"), **kw)
    raise ValueError(f"unknown source kind {kind!r}")


def override_source(spark: SparkSession, relation: str, df: DataFrame) -> None:
    """Make ``df`` answer to the source relation's name for the jobs' SQL."""
    df.createOrReplaceTempView(relation)


@contextmanager
def overridden_source(spark: SparkSession, relation: str, df: DataFrame) -> Iterator[None]:
    """``override_source`` for the plans built inside the block; the name is free again afterwards."""
    override_source(spark, relation, df)
    try:
        yield
    finally:
        spark.catalog.dropTempView(relation)


def read_target(spark: SparkSession, path: str | None = None, sql: str | None = None, *, table: str | None = None, **args) -> DataFrame:
    """Read a written target (a Parquet path or a named table) back, optionally
    through SQL over it: the table is ``{target}`` in ``sql``; named
    ``:params`` come from ``args``."""
    target = spark.table(table) if table is not None else spark.read.parquet(path)
    if sql is None:
        return target
    return spark.sql(sql, args=args or None, target=target)


def preview(spark: SparkSession, table: DataFrame, order_by: list[str], n: int = 20) -> DataFrame:
    """First ``n`` rows of a target table in key order (a top-n, not a sample)."""
    return table.orderBy(*order_by).limit(n)
