from pyspark.sql import functions as F

from vellum.functions.text import (
    CASE_ACCENT_INSENSITIVE,
    CASE_INSENSITIVE,
    collapse_spaces,
    normalise_name,
    not_equal_collated,
    strip_unicode,
    title_case,
)


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_title_case_then_strip(spark):
    values = ["  O'CONNOR-PEREZ,JUAN  3RA 3RA.x\t", "ÁLVAREZ ñandú", " LIBRE ", "", None]
    got = _one(spark, values, normalise_name)
    assert got == ["O'Connor-Perez,Juan  3ra 3ra.X", "Álvarez Ñandú", "Libre", "", None]


def test_title_case_any_non_alnum_is_a_boundary(spark):
    assert _one(spark, ["JUAN PEREZ 1", "a_b.c-d/e"], title_case) == ["Juan Perez 1", "A_B.C-D/E"]


def test_strip_unicode_keeps_inner_space(spark):
    assert _one(spark, ["\t a  b   "], strip_unicode) == ["a  b"]


def test_collapse_spaces(spark):
    got = _one(spark, ["  some   text\t\there \n", "x", None, "   "], collapse_spaces)
    assert got == ["some text here", "x", None, ""]


def test_not_equal_plain_vs_collated(spark):
    names = ["LIBRE", "libre", "Libre ", None, "X"]
    df = spark.createDataFrame([(v,) for v in names], "s string")
    plain = [r.s for r in df.where(not_equal_collated("s", "LIBRE", None)).collect()]
    coll = [r.s for r in df.where(not_equal_collated("s", "LIBRE", CASE_INSENSITIVE)).collect()]
    assert sorted(plain) == sorted(["libre", "Libre ", "X"])
    assert coll == ["X"]


def test_accent_insensitive_collation(spark):
    df = spark.createDataFrame([("LIBRÉ",), ("Y",)], "s string")
    assert [r.s for r in df.where(not_equal_collated("s", "libre", CASE_ACCENT_INSENSITIVE)).collect()] == ["Y"]


def test_title_case_upper_mapping_and_alphabetic_runs(spark):
    got = _one(spark, ["ßa straße", "ǆungla", "İSTANBUL", "ⓐbc"], title_case)
    assert got == ["SSa Straße", "Ǆungla", "İstanbul", "Ⓐbc"]
