import random

from pyspark.sql import functions as F

from vellum.llm import licenses
from vellum.llm.licenses import RELATIVES, TEMPLATES, THRESHOLD, WINDOW, own_licence, scan_licences, terms_of, weights


def brute(text):
    idf, other, vectors = weights(TEMPLATES, RELATIVES)
    best = None
    for line in (text or "").split("\n"):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        if not any(a in low for a in licenses.ANCHORS):
            continue
        words = terms_of(low)
        half = WINDOW // 2
        for at in range(0, max(len(words) - half - 1, 0) + 1, half):
            w = words[at : at + WINDOW]
            weight = {t: w.count(t) * idf.get(t, other) for t in set(w)}
            norm = sum(x * x for x in weight.values()) ** 0.5
            for name, v in vectors.items():
                score = round(sum(x * v.get(t, 0) for t, x in weight.items()) / norm, 6) if norm else 0
                numbers = {t for t in v if t.isdigit()} <= set(w)
                if score >= THRESHOLD and numbers and (best is None or (-score, name) < (-best[0], best[1])):
                    best = (score, name)
    return best


def test_scores_against_brute_force(spark):
    rng = random.Random(2)
    filler = [f"w{i}" for i in range(50)]
    texts = [None, "", "no notice", "license", "Licensed", "\n".join([*TEMPLATES.values()])]
    for notice in [*TEMPLATES.values(), *RELATIVES.values()]:
        texts += [notice, notice.upper(), notice.replace(" ", "$$$ "), "x y\n" + notice + "\nz", f"{rng.choice(filler)} {notice}"]
        texts += [" ".join(rng.choices(filler, k=500)) + " " + notice + " " + " ".join(rng.choices(filler, k=100)), notice.replace("the ", "a ")]
    texts.append("word " * 5000 + "Released under the MIT License. " * 40)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.o for r in df.select("i", own_licence(F.col("text")).alias("o")).collect()}
    for i, t in enumerate(texts):
        expected = brute(t)
        assert (got[i] is None) == (expected is None), t
        if expected:
            assert got[i].template == expected[1] and abs(got[i].score - expected[0]) < 2e-6
    for name, notice in {**TEMPLATES, **RELATIVES}.items():
        assert got[texts.index(notice)].template == name


def test_inheritance_from_the_nearest_ancestor(spark):
    mit, gpl, apache = TEMPLATES["MIT"], TEMPLATES["GPL-3.0"], TEMPLATES["Apache-2.0"]
    files = [
        ("LICENSE", mit), ("a.py", "code"), ("lib/b.py", None), ("lib/vendor/COPYING.txt", gpl), ("lib/vendor/x/y/c.py", ""),
        ("lib/vendor/d.py", apache), ("lib/vendor.py", "code"), (None, "code"), (None, gpl), ("/abs/e.py", "code"), ("lib/vendor/x/license.md", "nothing said"),
        ("a.py", "code"),
    ]
    df = spark.createDataFrame([(p, t, "x", 1) for p, t in files], "p string, text string, licence string, _dir int")
    out = scan_licences(df, F.col("p"))
    assert out.columns == ["path", "own_licence", "own_score", "licence", "licence_dir", "levels_up"]
    got = sorted(((r.path, r.own_licence, r.licence, r.licence_dir, r.levels_up) for r in out.collect()), key=str)
    assert got == sorted([
        ("LICENSE", "MIT", "MIT", None, 0), ("a.py", None, "MIT", "", 1), ("a.py", None, "MIT", "", 1), ("lib/b.py", None, "MIT", "", 2),
        ("lib/vendor/COPYING.txt", "GPL-3.0", "GPL-3.0", None, 0), ("lib/vendor/x/y/c.py", None, "GPL-3.0", "lib/vendor", 3),
        ("lib/vendor/d.py", "Apache-2.0", "Apache-2.0", None, 0), ("lib/vendor.py", None, "MIT", "", 2), (None, None, None, None, None),
        (None, "GPL-3.0", "GPL-3.0", None, 0), ("/abs/e.py", None, "MIT", "", 2), ("lib/vendor/x/license.md", None, "GPL-3.0", "lib/vendor", 2),
    ], key=str)
    assert scan_licences(df.limit(0), F.col("p")).count() == 0


def test_no_python_on_the_executors(spark):
    plan = spark.createDataFrame([("a", "b")], "p string, text string").select(own_licence(F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_clashing_columns_are_kept_or_replaced(spark):
    df = spark.createDataFrame([("a/LICENSE", TEMPLATES["MIT"], 1, 2, 3, 4), ("a/b.py", "x", 5, 6, 7, 8)], "path string, text string, _above int, _dir int, licence int, _own int")
    out = scan_licences(df, F.col("path"), keep=df.columns)
    assert out.columns == ["text", "_above", "_dir", "_own", "path", "own_licence", "own_score", "licence", "licence_dir", "levels_up"]
    got = {r.path: (r._above, r._dir, r._own, r.licence, r.licence_dir, r.levels_up) for r in out.collect()}
    assert got == {"a/LICENSE": (1, 2, 4, "MIT", None, 0), "a/b.py": (5, 6, 8, "MIT", "a", 1)}
