import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vellum.llm import alignment, chunks

JSON, MODEL = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a int, row string, a_ids string"


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(JSON)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=MODEL)


def ends(words, ids):
    out, at = [], 0
    for i in ids:
        at += len(words[i])
        out.append(at)
    return out


def brute(plain, texts):
    """Per text (a ids, b ids, links, groups as text), without tokens where bytes differ."""
    words = chunks.byte_level(JSON).words, chunks.pieces_after_blank(MODEL).words
    out = []
    for t in texts:
        whole = (" " + (t or "")).encode()
        a, b = plain[0].encode(" " + t, add_special_tokens=False).ids if t else [], plain[1].encode(t) if t else []
        if not t or any(b"".join(w[i] for i in ids) != whole for w, ids in zip(words, (a, b))):
            out.append(([], [], [], ""))
            continue
        ea, eb = ends(words[0], a), ends(words[1], b)
        spans = [[(x, y) for x, y in zip([0, *e[:-1]], e)] for e in (ea, eb)]
        links, j = [], 0
        for i, (x, y) in enumerate(spans[0]):
            while spans[1][j][1] <= x:
                j += 1
            links += [(a[i], b[k]) for k in range(j, len(b)) if spans[1][k][0] < y] if len(b) < 3000 else []
        groups, i, j = [], 0, 0
        for c in sorted(set(ea) & set(eb)):
            x, y = ea.index(c, i) + 1, eb.index(c, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        out.append((a, b, links, ";".join(groups)))
    return out


def texts():
    rng = random.Random(8)
    words = ["the", "house", " ", "  ", "\n", "\t\t", "naïve", "中文字", "🙂", "'s", "don't", "123", "<|endoftext|>", "</s>", "<0x41>", "\xa0", "　", "Привет", "​", "!!!", "\x00", "x" * 40]
    out = ["".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(120)]
    out += [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    return out + [None, "", " ", "  ", "a", "a ", " a", "▁", "a ▁ b", "a▁b", "中" * 500, "same text", "same text", "\n" * 70, "a" + " " * 300 + "b"]


def test_against_brute_force_and_both_joins(spark, plain):
    rows = [*enumerate(texts()), (None, "an id is missing"), (3, "an id again")]
    df = spark.createDataFrame([(i, t, 1, "r", "s") for i, t in rows], SCHEMA).repartition(3)
    made = brute(plain, [t for _, t in rows])
    n = Counter(x for _, _, links, _ in made for x in links)
    best = {}
    for (_, b), c in n.items():
        best[b] = max(best.get(b, 0), c)
    want = sorted(
        (-1 if i is None else i, len(a), len(b), g.count(";") + 1 if g else 0, len(x), sum(n[p] == best[p[1]] for p in x), sum(n[p] for p in x),
         hashlib.sha256(g.encode()).hexdigest() if g else "")
        for (i, _), (a, b, x, g) in zip(rows, made)
    )
    assert sum(w[1] == 0 for w in want) == 5
    for broadcast in (alignment.BROADCAST_PAIRS, 0):
        out = alignment.alignment_summary(df, JSON, MODEL, broadcast_pairs=broadcast)
        assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in out.collect()) == want


def test_arrays_of_the_operator(spark):
    df = spark.createDataFrame([(1, "unbelievable stories", 1, "r", "s")], SCHEMA)
    out = alignment.align(df, JSON, MODEL)
    assert out.columns == ["doc_id", "text", "n_a", "row", "a_ids", "b_ids", "a_cuts", "b_cuts", "b_from", "b_to"]
    r = out.first()
    words = chunks.byte_level(JSON).words, chunks.pieces_after_blank(MODEL).words
    a, b = ends(words[0], r.a_ids), ends(words[1], r.b_ids)
    assert [a[i - 1] for i in r.a_cuts] == [b[i - 1] for i in r.b_cuts] == sorted(set(a) & set(b))
    for i, (x, y) in enumerate(zip([0, *a[:-1]], a)):
        overlapping = [j for j, (u, v) in enumerate(zip([0, *b[:-1]], b)) if u < y and x < v]
        assert overlapping == list(range(r.b_from[i], r.b_to[i] + 1))


def test_an_empty_table(spark):
    assert alignment.alignment_summary(spark.createDataFrame([], SCHEMA), JSON, MODEL).count() == 0


@pytest.mark.parametrize("lane", [1, 3, 64])
def test_gallop_and_ranks_on_random_ends(lane):
    rng = np.random.default_rng(lane)
    docs = []
    for _ in range(60):
        total = int(rng.integers(0, 300))
        sides = [sorted({total, *rng.integers(1, total + 1, rng.integers(0, 1 + total // rng.integers(1, 9))).tolist()}) if total else [] for _ in range(2)]
        docs.append((total, sides))
    base = np.cumsum([0] + [t for t, _ in docs])
    flat = [np.array([b + e for b, (_, s) in zip(base, docs) for e in s[k]], np.int64) for k in range(2)]
    at = [np.append(0, np.cumsum([len(s[k]) for _, s in docs])) for k in range(2)]
    a_common, b_common, first, last = alignment.intersect(flat[0], at[0], flat[1], at[1], lane)
    assert flat[0][a_common].tolist() == flat[1][b_common].tolist() == sorted(set(flat[0].tolist()) & set(flat[1].tolist()))
    assert last.tolist() == np.searchsorted(flat[1], flat[0]).tolist()
    start = np.append(0, flat[0][:-1])
    assert first.tolist() == np.searchsorted(flat[1], start, "right").tolist()


def test_ids_of_chunks_are_those_of_whole_texts(plain):
    cache = chunks.ChunkCache([chunks.byte_level(JSON), chunks.pieces_after_blank(MODEL)])
    odd = [t for t in texts() if t] + ["word " * 9 + "  x\x85 y᠎ z﻿ w", "tail   ", "line \n next \r\n end "]
    for some in (odd, odd[::-1]):
        numbers, bounds = cache.chunks(" " + t for t in some)
        for k, whole in enumerate(([plain[0].encode(" " + t, add_special_tokens=False).ids for t in some], [plain[1].encode(t) for t in some])):
            ids, at = cache.ids(numbers, bounds, k)
            assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == whole
        assert [all(cache.sound[numbers[x:y]]) for x, y in zip(bounds[:-1], bounds[1:])] == ["▁" not in t for t in some]


def test_chunks_that_do_not_fall_apart_are_encoded_one_by_one():
    def joined(texts):  # a vocabulary that ignores where chunks end
        return [[0] * (len(t) // 3) + [1] * (len(t) % 3) for t in texts]

    cache = chunks.ChunkCache([chunks.Vocabulary(joined, [b" ab", b"x"])])
    numbers, bounds = cache.chunks([" ab ab", " a", " abcd ab"])
    ids, at = cache.ids(numbers, bounds)
    assert [ids[x:y].tolist() for x, y in zip(at[:-1], at[1:])] == [[0, 0], [1, 1], [0, 1, 1, 0]]
    assert [bool(cache.sound[n]) for n in numbers] == [True, True, False, False, True]


def test_windows_join_to_the_text_and_the_cache_starts_anew(plain, monkeypatch):
    text = " one two  three\n four" * 500
    assert "".join(chunks.windows(text, 100)) == text and len(list(chunks.windows(text, 100))) > 50
    assert list(chunks.windows("x" * 1000, 100)) == ["x" * 1000]
    monkeypatch.setattr(chunks, "MOST_CHUNKS", 5)
    monkeypatch.setattr(chunks, "WINDOW", 64)
    cache = chunks.ChunkCache([chunks.byte_level(JSON)])
    for i in range(20):
        t = f" number {i} of many" * 30
        numbers, bounds = cache.chunks([t])
        assert cache.ids(numbers, bounds)[0].tolist() == plain[0].encode(t, add_special_tokens=False).ids
        assert len(cache.numbers) < 20
