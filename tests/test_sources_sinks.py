import os

import pytest
from pyspark.sql import functions as F

from vellum.operators.checks import all_passed, pre_checks
from vellum.session import local_path
from vellum.sinks import write_counted, write_months
from vellum.sources.readers import bind_parameters, jdbc_url, month_predicates, read_csv, read_source


def _write_text(path, text):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "part-0.csv"), "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_decimal_comma_inferred(spark, workdir):
    path = workdir("csv")
    _write_text(path, "a;b\n1,5;x\n1.234,25;y\n")
    df = read_csv(spark, path, separator=";")
    assert dict(df.dtypes)["a"] == "double"
    assert sorted(r.a for r in df.collect()) == [1.5, 1234.25]


def test_csv_decimal_comma_with_contract_by_header_name(spark, workdir):
    path = workdir("csv2")
    _write_text(path, "b;a\nx;1,5\ny;\n")
    df = read_csv(spark, path, separator=";", contract={"a": "Float64", "b": "String"})
    assert [tuple(r) for r in df.orderBy("b").collect()] == [(1.5, "x"), (None, "y")]


def test_csv_default_separator_quoted_decimal(spark, workdir):
    path = workdir("csv3")
    _write_text(path, 'a,b\n"2,5",x\n')
    assert read_source(spark, "csv", path=path).first().a == 2.5


def test_write_counted_and_append(spark, workdir):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    path = workdir("sink")
    assert write_counted(df, path)["rows"] == 10
    assert write_counted(df, path)["rows"] == 10
    assert spark.read.parquet(path).count() == 20


def test_csv_sink_round_trip(spark, workdir):
    df = spark.range(5).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    path = workdir("csv-sink")
    assert write_counted(df, path, fmt="csv", options={"header": "true"})["rows"] == 5
    back = read_csv(spark, path, decimal_comma=False)
    assert back.count() == 5


def test_jdbc_helpers():
    assert jdbc_url("mysql", "h", database="db") == "jdbc:mysql://h:3306/db"
    assert jdbc_url("postgresql", "h", database="db") == "jdbc:postgresql://h:5432/db"
    assert jdbc_url("sqlite", database="/x.db") == "jdbc:sqlite:/x.db"
    preds = month_predicates("FEmision", 2025, 12)
    assert len(preds) == 12 and preds[11].endswith("< '2026-01-01'")


def test_pre_checks(spark):
    a = spark.range(3)
    b = spark.range(0)
    rows = {r.check_name: r.passed for r in pre_checks({"a": a, "b": b}).collect()}
    assert rows == {"a": True, "b": False, "all": False}
    assert all_passed({"a": a}) is True


def test_jdbc_options():
    from vellum.sinks import jdbc_options

    opts = jdbc_options("jdbc:postgresql://h:5432/db", "public.t", driver="org.postgresql.Driver", batchsize=1000)
    assert opts == {
        "url": "jdbc:postgresql://h:5432/db",
        "dbtable": "public.t",
        "driver": "org.postgresql.Driver",
        "batchsize": "1000",
    }


def test_read_source_dispatch(spark, workdir):
    import pytest as _pytest

    from vellum.plans.workbook_files import write_workbooks

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, s string")
    pq = workdir("dispatch-pq")
    df.write.parquet(pq)
    assert read_source(spark, "parquet", path=pq).count() == 2
    books = workdir("dispatch-xlsx")
    write_workbooks(df, books).collect()
    got = read_source(spark, "excel", path=books, contract={"id": "UInt32", "s": "String"})
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "b")]
    with _pytest.raises(ValueError):
        read_source(spark, "clickhouse")


def test_csv_quotes_and_line_breaks(spark, workdir):
    path = workdir("csv-quotes")
    _write_text(path, 'a,b\n1,"say ""hi"", ok"\n2,"x\ny"\n3,plain\n')
    rows = read_csv(spark, path, contract={"a": "UInt32", "b": "String"}, multi_line=True).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [(1, 'say "hi", ok'), (2, "x\ny"), (3, "plain")]
    assert sorted(tuple(r) for r in read_csv(spark, path, multi_line=True).collect()) == [tuple(r) for r in rows]
    # Without the caller's word for it a line is a row, and the two halves are shown.
    broken = read_csv(spark, path, contract={"a": "UInt32", "b": "String"}, with_failures=True).where("_broken_line IS NOT NULL")
    assert sorted(r._broken_line for r in broken.collect()) == ['2,"x', 'y"']


def test_a_stray_quote_takes_no_other_row_with_it(spark, workdir):
    path = workdir("csv-stray")
    _write_text(path, 'a,b\n1,"5\n2,7\n3,8\n4\n5,6,7\n6,say 5" wide\n7,x\x1fy\n')
    got = read_csv(spark, path, contract={"a": "UInt32", "b": "String"}, with_failures=True)
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    want = [(None, None, 0, '1,"5'), (2, "7", 0, None), (3, "8", 0, None), (None, None, 0, "4"), (None, None, 0, "5,6,7")]
    want += [(6, 'say 5" wide', 0, None), (7, "x\x1fy", 0, None)]
    assert rows == sorted(want, key=str)
    assert got.agg(F.count("_broken_line")).first()[0] == 3
    with pytest.raises(Exception, match="CSV line does not parse"):
        read_csv(spark, path, contract={"a": "UInt32", "b": "String"}).collect()


def test_a_failed_cast_is_an_error_unless_it_is_counted(spark, workdir):
    path = workdir("csv-cast")
    _write_text(path, "a;b\n1;x\nzz;y\n;z\n")
    with pytest.raises(Exception, match="CSV value of a is not of its type: zz"):
        read_csv(spark, path, separator=";", contract={"a": "UInt32", "b": "String"}).collect()
    got = read_csv(spark, path, separator=";", contract={"a": "UInt32", "b": "String"}, with_failures=True)
    assert sorted((r.b, r.a, r._cast_failures) for r in got.collect()) == [("x", 1, 0), ("y", None, 1), ("z", None, 0)]


def test_long_integers_keep_every_digit(spark, workdir):
    path = workdir("csv-long")
    _write_text(path, f"a;b;c;d;e\n1;12345678901234567890;{'1' * 45};9;12345678901234567890\n-2;-5;3;123456789012345678;1,5\n")
    df = read_csv(spark, path, separator=";")
    assert [t for _, t in df.dtypes] == ["bigint", "decimal(38,0)", "string", "bigint", "double"]
    rows = [tuple(map(str, r))[:4] for r in df.orderBy("a").collect()]
    assert rows == [("-2", "-5", "3", "123456789012345678"), ("1", "12345678901234567890", "1" * 45, "9")]
    # Spark's own inference, taken without the decimal comma, widens likewise.
    assert dict(read_csv(spark, path, separator=";", decimal_comma=False).dtypes)["b"].startswith("decimal")


def test_parameters_become_literals_of_the_query():
    import datetime as dt

    sql = "SELECT a::int, ':x' FROM t -- :x\nWHERE a = :x AND b IN :y AND c = :x /* :z */ AND d < :day"
    bound = bind_parameters(sql, {"x": "O'Hara\\", "y": [1, None, 2.5, True], "day": dt.date(2025, 1, 2)})
    assert bound == (
        "SELECT a::int, ':x' FROM t -- :x\nWHERE a = 'O''Hara\\' AND b IN (1, NULL, 2.5, TRUE) AND c = 'O''Hara\\' /* :z */ "
        "AND d < DATE '2025-01-02'"
    )
    assert bind_parameters("x = :a", {"a": "\\'"}, backslash_escapes=True) == r"x = '\\'''"
    assert bind_parameters("x = :a", None) == "x = :a"
    assert bind_parameters("t > :t", {"t": dt.datetime(2025, 1, 2, 3, 4)}) == "t > TIMESTAMP '2025-01-02 03:04:00'"
    bad = [("x = :a", {}, KeyError), ("x", {"a": 1}, KeyError), (":a", {"a": float("nan")}, ValueError), (":a", {"a": []}, ValueError), (":a", {"a": object()}, TypeError)]
    for query, given, kind in bad:
        with pytest.raises(kind):
            bind_parameters(query, given)


def test_csv_without_header_is_named_by_position(spark, workdir):
    path = workdir("csv-position")
    _write_text(path, "1;1,5;x\n2;;y\n")
    df = read_csv(spark, path, separator=";", header=False, contract={"k": "UInt32", "v": "Float64", "s": "String"})
    assert df.columns == ["k", "v", "s"]
    assert sorted(tuple(r) for r in df.collect()) == [(1, 1.5, "x"), (2, None, "y")]


def test_numbers_that_are_not_in_the_comma_form_are_null_and_counted(spark, workdir):
    path = workdir("csv-dots")
    _write_text(path, "v;i\n1.5;1.5\n1234.56;7\n1.234,5;1.234\n-2,25;x\n;\n12.34,5;\n")
    df = read_csv(spark, path, separator=";", contract={"v": "Float64", "i": "UInt32"}, with_failures=True)
    got = sorted((tuple(r) for r in df.collect()), key=str)
    want = [(None, None, 2), (None, 7, 1), (1234.5, 1234, 0), (-2.25, None, 1), (None, None, 0), (None, None, 1)]
    assert got == sorted([(*w, None) for w in want], key=str)
    # Without a contract such a column stays text.
    assert dict(read_csv(spark, path, separator=";").dtypes)["v"] == "string"


def test_a_rerun_with_fewer_months_removes_the_later_ones(spark, workdir):
    import datetime as dt

    path = workdir("stale")
    df = spark.createDataFrame([(dt.date(2024, 12, 1), 0), (dt.date(2025, 1, 1), 1), (dt.date(2025, 2, 1), 2), (dt.date(2025, 3, 1), 3)], "month date, v int")
    months = lambda: sorted(r.v for r in spark.read.parquet(path).collect())
    write_months(df, path)
    write_months(df.where("v IN (1, 2)"), path, since=dt.date(2025, 1, 1))
    assert months() == [0, 1, 2]
    assert write_months(df.where("v = 1"), path, since=dt.date(2025, 1, 1), rebalance=False)["rows"] == 1
    assert months() == [0, 1]
    write_months(df.limit(0), path, since=dt.date(2025, 1, 1))
    assert months() == [0]


def test_year_defaults_to_the_current_one(spark):
    import datetime as dt

    from vellum.plans import jobs

    year = dt.date.today().year
    raw = spark.createDataFrame([(dt.date(year, 1, 5), 1), (dt.date(year, 3, 5), 2)], "FEmision date, Op bigint")
    missing = [c for c in jobs.PREMIUMS_RENAMES if c not in raw.columns]
    raw = raw.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])
    row = jobs.premiums_summary(spark, sources={jobs.PREMIUMS_SOURCE: raw}).first()
    assert (row.total_rows, row.months_processed, row.year) == (1, 1, year)


def test_organizers_take_a_source_contract(spark):
    import pytest as _pytest

    from vellum.operators.contracts import ContractError
    from vellum.plans import jobs, standins

    sources = standins.organizer_sources(spark, "/root/testdata/sf0.001")
    jobs.build_organizers(spark, sources, source_contract={"ININNA": "UInt32"}, type_code="AUTOMOBILE")
    with _pytest.raises(ContractError):
        jobs.build_organizers(spark, sources, source_contract={"ININNA": "String"}, type_code="AUTOMOBILE")
