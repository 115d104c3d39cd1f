import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import infilling as fim

SCHEMA = "doc_id long, text string, form int, _t string, _h0 int"
SPLIT = {"char": re.compile("(?s)."), "word": re.compile(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+"), "line": re.compile("[^\n]*\n|[^\n]+")}


def brute(doc, text, unit="char", plain=10, spm=20, salt="1:"):
    text = text or ""
    parts = SPLIT[unit].findall(text)
    digest = hashlib.sha256((salt + ("null" if doc is None else str(doc))).encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(parts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    x, y = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, m, z = "".join(parts[:x]), "".join(parts[x:y]), "".join(parts[y:])
    if h[3] % 100 < spm:
        return n, "spm", len(a), len(m), f"<S>{z}<P>{a}<M>{m}"
    return n, "psm", len(a), len(m), f"<P>{a}<S>{z}<M>{m}"


def texts():
    rng = random.Random(4)
    alphabet = ["a", "b ", "é", "中", "🙂", "\n", " ", "\t", "x" * 30, "<", "P>", "\x00"]
    out = ["".join(rng.choices(alphabet, k=rng.randint(0, 400))) for _ in range(150)]
    return out + [None, "", "a", "🙂", "<P>", "a<S>b", "<M", "<" * 50, "\n\n\n", "   ", "same", "same", "é中🙂" * 20_000, "x" * 300_000 + "🙂"]


@pytest.mark.parametrize("unit", fim.UNITS)
def test_against_brute_force(spark, unit):
    rows = [*enumerate(texts()), (None, "no id"), (3, "an id again"), (-5, "below zero " * 9)]
    df = spark.createDataFrame([(i, t, 1, "z", 2) for i, t in rows], SCHEMA).repartition(4)
    made = fim.fill_in_middle(df, unit=unit, block=16)
    assert made.columns == ["doc_id", "text", "_t", "_h0", "n", "form", "prefix_chars", "middle_chars", "output"]
    made = made.withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = made.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text, unit)
        assert r.back == (r.text or "") and r._t == "z"
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_unknown_unit(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(spark.createDataFrame([], SCHEMA), unit="page")


def test_trees_of_every_height_give_every_cut():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(["a", "é", "中", "🙂"], n)) for n in [0, 1, 2, 3, 5, 8, 13, 40, 100, 0, 257]]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    for block in (1, 3, 8, 64):
        starts, points = fim.unit_starts(data, offsets, "char")
        forest = fim.Forest(starts, points, offsets, block)
        # A node of the tree covers as many blocks as its lowest set bit says.
        for row, t in enumerate(texts):
            raw = t.encode()
            per_block = [sum((c & 0xC0) != 0x80 for c in raw[x : x + block]) for x in range(0, len(raw), block)]
            for p in range(1, len(per_block) + 1):
                assert forest.trees[0][forest.base[row] + p - 1] == sum(per_block[p - (p & -p) : p])
            k = np.arange(len(t) + 1)
            byte, before = forest.cut(np.full(len(k), row), k)
            assert byte.tolist() == [offsets[row] + len(t[:i].encode()) for i in k] and before.tolist() == k.tolist()
