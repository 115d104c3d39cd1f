import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from vellum.llm import packing

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n", "<|endoftext|", "é <|endoftext|> 中文", "plain text", "", "中文"]


def test_ids_are_those_of_a_plain_tokenizer(spark):
    plain = Tokenizer.from_file(JSON)
    want = [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert want[0] == [64, 220, 50256, 275]
    for ranks in (RANKS, None):
        assert [packing.encoder(JSON, ranks).ids(t).tolist() for t in TEXTS] == want
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack_documents(df, JSON, RANKS).collect()}
    assert got == {i: (len(w) + 1, zlib.crc32(np.array([*w, packing.END], "<u4").tobytes())) for i, w in enumerate(want)}


def test_long_runs_are_encoded_as_by_a_plain_tokenizer(spark):
    plain = Tokenizer.from_file(JSON)
    n = 1_000_000
    runs = [" " * n, "\t" * n, "\n" * n, "\r\n" * (n // 2), " \n\t" * (n // 3), "\xa0" * 20_000, " " * 9_999, " " * 10_000, "\n" * 300_000 + " "]
    texts = [t for r in runs for t in ("a" + r + "b", r)] + ["x" * n, "7" * n, "!" * n, "-=" * (n // 2), "a " * (n // 2)]
    enc = packing.encoder(JSON, RANKS)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [enc.ids(t).tolist() for t in texts] == want
    df = spark.createDataFrame(list(enumerate(texts[:4])), "doc_id long, text string")
    got = packing.pieces(df, JSON, RANKS).groupBy("doc_id").sum("length").collect()
    assert dict(map(tuple, got)) == {i: len(w) + 1 for i, w in enumerate(want[:4])}
