import random

import numpy as np
import pyarrow as pa
from llm_brute import near_groups, shingles, varied_texts

from vellum.llm import minhash
from vellum.llm.hashing import shingle_sets
from vellum.llm.minhash import near_duplicates, neighbour_pairs, one_of_each, shared_counts

SCHEMA = "doc_id long, text string, source string, n string, group_id int, cid int, tk int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", "n", 1, 2, 3) for i, t in rows], SCHEMA).repartition(4)


def brute(rows, k):
    sets, comp = near_groups([t for _, t in rows], k)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return sorted(((i, len(s), least.get(c), i is not None and i == least.get(c)) for (i, _), s, c in zip(rows, sets, comp)), key=str)


def test_sets_have_the_sizes_and_overlaps_of_word_shingles():
    texts = varied_texts(random.Random(1))
    for k in (4, 5):
        got = [None] * len(texts)
        for limit in (1 << 20, 300):
            for a, b, sets, bounds in shingle_sets(pa.array(texts, pa.string()), k, limit):
                for i in range(a, b):
                    got[i] = set(sets[bounds[i - a] : bounds[i - a + 1]].tolist())
            expected = [shingles(t, k) for t in texts]
            assert [len(x) for x in got] == [len(x) for x in expected]
            for i in range(0, len(texts), 3):
                for j in range(i):
                    assert len(got[i] & got[j]) == len(expected[i] & expected[j])


def test_against_brute_force_with_nulls_copies_and_repeated_rows(spark):
    texts = varied_texts(random.Random(2), 60)
    rows = list(enumerate(texts)) + [(3, texts[3]), (3, texts[3]), (None, texts[9]), (None, "only this one has no id at all here"), (77_000, "x " * 50_000)]
    for k in (4, 5):
        got = near_duplicates(frame(spark, rows), shingle=k).select("doc_id", "n_shingles", "component_id", "kept")
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, k)


def test_a_large_region_is_closed_by_the_exact_way(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"c{rng.randrange(1000)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = near_duplicates(frame(spark, rows), shingle=4, leaf=3, near=1, block=16).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 4)


def test_one_document_of_each_group_stays(spark):
    texts = varied_texts(random.Random(5), 30)
    rows = list(enumerate(texts)) + [(0, texts[0]), (500, None), (500, None), (None, "nobody knows this text but me and you")]
    df = frame(spark, rows)
    got = one_of_each(df, shingle=5)
    assert got.columns == df.columns
    _, comp = near_groups([t for _, t in rows], 5)
    firsts = {}
    for i, ((doc, t), c) in enumerate(zip(rows, comp)):
        firsts[c] = min(firsts.get(c, (True, 0, "")), (doc is None, doc or 0, t or "")) if c in firsts else (doc is None, doc or 0, t or "")
    wordless = [(d, t) for d, t in rows if not shingles(t, 5)]
    expected = [(d if not n else None, t) for n, d, t in (firsts[c] for c in set(comp) if shingles(rows[c][1], 5))] + wordless
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_empty_table(spark):
    empty = frame(spark, [(1, "a")]).limit(0)
    assert near_duplicates(empty).count() == 0
    assert one_of_each(empty).count() == 0


def test_neighbours_of_sorted_keys():
    rng = np.random.default_rng(3)
    key = rng.integers(0, 3, (400, 7))
    key[:, 0] = rng.integers(0, 2, 400)
    key = key[np.lexsort(key.T[::-1])]
    first, second, region, large = neighbour_pairs(key, 2, 8, 2)
    pairs = set(zip(first.tolist(), second.tolist()))
    for i in range(400):
        for j in range(i):
            same = int((np.cumprod(key[i] == key[j])).sum())
            if region[i] == region[j]:
                assert same >= 3
            if same >= 3 and not large[region[i]]:
                assert (j, i) in pairs
            if same >= 3 and i - j <= 2:
                assert (j, i) in pairs
            if (j, i) in pairs:
                assert same >= 3


def test_shared_counts_of_blocks():
    rng = np.random.default_rng(8)
    sets = [np.unique(np.concatenate([rng.integers(0, 60, rng.integers(0, 50)), rng.integers(0, 10**6, 20)])).astype(np.uint64) for _ in range(70)]
    left, right = sets[:30], sets[20:]
    got = shared_counts(left, right)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in right] for a in left]


def test_signatures_estimate_similarity():
    x = np.unique(np.random.default_rng(1).integers(0, 2**63, 2000).astype(np.uint64))
    a, b = x[:1800], x[200:]
    s = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 512)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.08
