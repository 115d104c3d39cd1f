import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from vellum.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def exact():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBPE(PATH)


def ids_of(own, texts, limit=bpe.SLICE):
    out = []
    for _, _, ids, bounds in own.encode_rows(pa.array(texts, pa.string()), limit):
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
    return out


PIECES = ["'", "s", "re", "ll", "ve", " ", "  ", "\n", "\t", "a", "B", "é", "1", "٣", "!", "?", "，", "　", " ", "中", "🙂",
          "'s", "'t", "'m", "'d", "\r\n", "x" * 70, "-" * 90, "​", "́", "\x00", "<|endoftext|>"]


def test_random_mixtures_equal_the_library(own, exact):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(6000)]
    texts += ["", None, "'", "''s", " 's", "a'sb's's", "\n\n\na", "  a", "a  ", "it's we'll they've 'RE"]
    expected = [exact.encode_ordinary(t or "") for t in texts]
    assert ids_of(own, texts) == expected
    assert ids_of(own, texts, limit=50) == expected


def test_every_third_codepoint_equals_the_library(own, exact):
    texts = [f"a{chr(c)}{chr(c)}1 {chr(c)}!{chr(c)}" for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    assert ids_of(own, texts) == [exact.encode_ordinary(t) for t in texts]


def test_long_pieces_and_long_texts(own, exact):
    rng = random.Random(5)
    texts = ["a" * 5000, "".join(rng.choices("abcde", k=3000)), " " * 4000, "é" * 2000 + "x", "word and number 12 " * 20_000]
    assert ids_of(own, texts, limit=10_000) == [exact.encode_ordinary(t) for t in texts]


def test_scan_is_the_same_for_any_block_size():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 8, 1000).astype(np.uint8)
    symbols[[0, 300, 301]] += 8
    state, expected = 0, []
    for s in symbols:
        expected.append(bool(bpe.STARTS[int(s) * 8 + state]))
        state = int(bpe.NEXT[int(s) * 8 + state])
    for block in (1, 2, 7, 128, 4096):
        assert bpe.scan_states(symbols, block).tolist() == expected


def test_cache_is_bounded_and_harmless(exact):
    small = bpe.ByteBPE(PATH, cache_entries=50)
    texts = [f"word{i} other{i % 7} {'z' * (i % 90)}" for i in range(400)]
    assert ids_of(small, texts, limit=200) == [exact.encode_ordinary(t) for t in texts]
    assert len(small.cache) <= 200


def test_operators_round_trip_with_clashing_columns(spark, exact):
    texts = ["Hello wörld's 42 tests\n\n  end", "", None, "Hello wörld's 42 tests\n\n  end", "x" * 300_000]
    df = spark.createDataFrame([(i, t, [1], "d") for i, t in enumerate(texts)], "doc_id long, text string, _ids array<int>, starts string")
    encoded = bpe.encode(df, PATH)
    assert encoded.columns == ["doc_id", "text", "_ids", "ids", "starts"]
    for r in encoded.collect():
        assert r.ids == exact.encode_ordinary(r.text or "")
        lengths = [len(exact.decode_single_token_bytes(i)) for i in r.ids]
        assert r.starts == [sum(lengths[:k]) for k in range(len(lengths))] if len(lengths) < 100 else True
    back = bpe.decode(encoded.withColumnRenamed("_ids", "decoded"), PATH)
    assert back.columns == ["doc_id", "text", "ids", "starts", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    for r in bpe.encode_digests(df, PATH).collect():
        ids, raw = exact.encode_ordinary(texts[r.doc_id] or ""), (texts[r.doc_id] or "").encode()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest()
    assert bpe.encode_digests(df.limit(0), PATH).count() == 0 and bpe.encode(df.limit(0), PATH).count() == 0


def test_decoding_places_tokens_by_their_offsets(own):
    texts = ["", "Hello wörld's 42 tests", None, "\n\n  end 中🙂", ""]
    for _, _, ids, bounds in own.encode_rows(pa.array(texts, pa.string())):
        starts = own.token_offsets(ids, bounds)
        whole, ends = own.decode_at(ids, starts, bounds)
        assert [whole[a:b].tobytes().decode() for a, b in zip(ends[:-1], ends[1:])] == [t or "" for t in texts]
        # The tokens' order does not matter, their offsets do.
        a, b = bounds[1:3]
        back = np.arange(len(ids))
        back[a : b - 1] = back[a : b - 1][::-1]
        assert own.decode_at(ids[back], starts[back], bounds)[0].tobytes() == whole.tobytes()
        shifted = starts.copy()
        shifted[bounds[1] + 1] += 1
        assert own.decode_at(ids, shifted, bounds)[0].tobytes() != whole.tobytes()


def test_the_digests_depend_on_the_offsets(spark):
    df = spark.createDataFrame([(1, "Hello wörld's 42 tests")], "doc_id long, text string")
    right = bpe.encode_digests(df, PATH).first()
    plain = bpe.ByteBPE(PATH)
    ids, bounds = next((i, b) for _, _, i, b in plain.encode_rows(pa.array(["Hello wörld's 42 tests"])))
    starts = plain.token_offsets(ids, bounds)
    assert right.decoded_sha256 == hashlib.sha256(plain.decode_at(ids, starts, bounds)[0].tobytes()).hexdigest()
    assert right.decoded_sha256 != hashlib.sha256(plain.decode_at(ids, np.append(starts[:1], starts[1:] + 1), bounds)[0].tobytes()).hexdigest()
