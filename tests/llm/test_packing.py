import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from vellum.llm import packing

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    return packing.Encoder(JSON, None)


def test_both_libraries_agree_in_the_proven_range(plain):
    both = packing.Encoder(JSON, RANKS)
    cps = [c for c in [*range(0x250), *range(0x2010, 0x2028)]]
    for c in cps:
        for t in (f"a{chr(c)}{chr(c)}1 {chr(c)}!{chr(c)}", f" {chr(c)}", f"{chr(c)}'s{chr(c)}\n{chr(c)} ", f"{chr(c)}  {chr(c)}x"):
            assert not packing.UNPROVEN.search(t)
            assert both.fast.encode_ordinary(t) == plain.ids(t).tolist(), hex(c)
    for t in ("中文 text", "<|endoftext|> is text", "", "é" * 3000, "🙂 ok"):
        assert both.ids(t).tolist() == plain.ids(t).tolist()
    assert 50256 not in both.ids("<|endoftext|>").tolist()


def check(rows, texts, plain, length):
    """Every document's pieces are its ids, and every sequence is gapless and no longer than allowed."""
    of_doc, of_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
        of_seq[r.sequence_id].append(r)
    for doc, text in texts.items():
        ids = np.append(plain.ids(text or ""), 0).astype("<u4")
        pieces = sorted(of_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and sum(r.length for r in pieces) == len(ids)
        assert all(r.length == length for r in pieces[1:]) and (len(pieces) == 1 or len(ids) > length)
        at = 0
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    for rs in of_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(of_seq)


def test_documents_are_packed_whole_and_gapless(spark, plain):
    texts = {i: "word " * ((i * 37) % 90) + "é" for i in range(300)} | {900: None, 901: "", 902: "long text " * 700, 903: "x" * 9000}
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in texts.items()], "doc_id long, text string, item int, length string").repartition(4)
    out = packing.pack_documents(df, JSON, RANKS, length=64)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = out.collect()
    n = check(rows, texts, plain, 64)
    assert n <= 1.03 * -(-sum(r.length for r in rows) // 64)
    assert packing.pack_documents(df.limit(0), JSON, RANKS).count() == 0


def test_repeated_rows_and_null_ids_are_documents_of_their_own(spark):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (None, "same")], "doc_id long, text string")
    rows = packing.pack_documents(df, JSON, RANKS, length=64).collect()
    assert sorted((r.doc_id or 0, r.piece) for r in rows) == [(0, 0), (1, 0), (1, 0)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)] and packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(5, 4) == [(0, 1), (1, 4)] and packing.cut(11, 4) == [(0, 3), (3, 4), (7, 4)]


def brute_best_fit(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] + s <= capacity]
        if fits:
            bins[max(fits, key=lambda b: bins[b])] += s
        else:
            bins.append(s)
    return sorted(bins)


def test_best_fit_and_genetic_steps():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 101, 400)
    packer = packing.Packer(sizes, 100, 1)
    _, _, fill = packer.fresh(0.0)
    assert sorted(fill.tolist()) == brute_best_fit(sizes.tolist(), 100)
    a, b = packer.fresh(0.3), packer.fresh(0.5)
    for _ in range(20):
        for child in (packer.crossover(a, b), packer.mutation(a)):
            (n, _), bin_of, fill = child
            assert np.bincount(bin_of, sizes).astype(int).tolist() == fill.tolist() and fill.max() <= 100 and n == len(fill)
            assert (bin_of >= 0).all()
    best = packer.evolve([a[1], b[1]], 4, 30)
    assert best.max() + 1 <= min(a[0][0], b[0][0])


def test_crossover_injects_whole_sequences():
    packer = packing.Packer(np.array([60, 40, 50, 50, 70, 30]), 100, 3)
    good = packer.finished(np.array([0, 0, 1, 1, 2, 2]))
    bad = packer.finished(np.array([0, 1, 1, 2, 3, 4]))
    child = packer.crossover(bad, good)
    assert child[0][0] <= bad[0][0]
    assert packer.evolve([bad[1], good[1]], 2, 5).max() + 1 == 3
