"""Property tests: Column expressions against plain-Python models."""

import re
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from vellum.functions.text import WHITE_SPACE, collapse_spaces, normalise_name, strip_unicode, title_case

ALPHABET = "abcXYZáéñÜ019 '-,.#_/\t\n\x1c\x1f\x85\xa0\u2003\u3000"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=24), min_size=1, max_size=40)


def _is_word_char(ch: str) -> bool:
    return unicodedata.category(ch)[0] in ("L", "N")


def py_title(s: str) -> str:
    out, prev_word = [], False
    for ch in s:
        w = _is_word_char(ch)
        out.append(ch.upper() if w and not prev_word else ch.lower() if w else ch)
        prev_word = w
    return "".join(out)


def py_strip(s: str) -> str:
    return s.strip(WHITE_SPACE)


def py_collapse(s: str) -> str:
    # The metadata-cleaning rule itself.
    return re.sub(r"\s+", " ", s).strip()


@settings(max_examples=15, deadline=None)
@given(texts)
def test_text_functions_match_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(
        "s",
        title_case("s").alias("t"),
        strip_unicode("s").alias("p"),
        collapse_spaces("s").alias("c"),
        normalise_name("s").alias("n"),
    ).collect()
    for r in rows:
        assert r.t == py_title(r.s)
        assert r.p == py_strip(r.s)
        assert r.c == py_collapse(r.s)
        assert r.n == py_strip(py_title(r.s))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 40)), min_size=1, max_size=60))
def test_keyed_month_prefix_property(spark, pairs):
    import datetime as dt

    from vellum.operators.months import month_prefix_by_key

    # (key, months after January 2025): dates on the 1st of that month.
    rows = [(k, dt.date(2025 + m // 12, m % 12 + 1, 1)) for k, m in pairs]
    df = spark.createDataFrame(rows, "k int, d date")
    got = {r.k: (r.total_rows, r.months_processed) for r in month_prefix_by_key(df, "d", 2025, ["k"]).collect()}
    want = {}
    for k in {k for k, _ in pairs}:
        months = {m for kk, m in pairs if kk == k}
        n = 0
        while n in months:
            n += 1
        if n:
            want[k] = (sum(1 for kk, m in pairs if kk == k and m < n), n)
    assert got == want
