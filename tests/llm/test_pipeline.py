import random
from collections import Counter

import corpus_pipeline as cp
import public_tokenizers
from llm_brute import near_groups, varied_texts
from test_classifiers import brute_toxicity, corpus, rule_score

from vellum.llm import packing, quality, toxicity
from vellum.llm.pii import DEMO_KEY, Pseudonyms

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _c0 string, score int"
PACKED = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def write(spark, folder, rows):
    _, labels = corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1) for i, t in rows], DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_are_named_and_ordered():
    assert [n for n, _ in cp.STAGES] == ["quality", "toxicity", "near_copies", "pii", "packing"]


def test_run_against_a_brute_force_version(spark, workdir):
    rows, _ = corpus()
    texts = varied_texts(random.Random(9), 25)
    rows = rows + [(1000 + i, t) for i, t in enumerate(texts)] + [(2000, "plain words then +1 (743) 555-3824 and re.46@mail8.example.com and more of them")]
    rows += [(1001, texts[1]), (None, "a text whose id is not known but which is long enough to count"), (3000, "long " * 30_000)]
    folder = workdir("pipeline-test")
    write(spark, folder, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")

    # Quality and toxicity: the models learnt in the stages, evaluated plainly.
    model = quality.fit(docs, labels)
    left = [(i, t) for i, t in rows if rule_score(model, t) >= 0.5]
    kept = cp.keep_quality(spark, docs, folder)
    assert kept.columns == docs.columns
    key = lambda x: (str(x[0]), str(x[1]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(left, key=key) and 0 < len(left) < len(rows)
    kept = spark.createDataFrame(kept.collect(), docs.schema)
    model = toxicity.fit(kept, labels)
    left2 = [(i, t) for i, t in left if brute_toxicity(model, t) < 0.7]
    kept = cp.drop_toxic(spark, kept, folder)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(left2, key=key) and len(left2) < len(left)
    kept = spark.createDataFrame(kept.collect(), docs.schema)

    # Near copies: the smallest known id of each group, one row.
    sets, comp = near_groups([t for _, t in left2], 5)
    best, wordless = {}, []
    for (i, t), s, c in zip(left2, sets, comp):
        if not s:
            wordless.append((i, t))
        elif c not in best or (i is None, i or 0, t) < (best[c][0] is None, best[c][0] or 0, best[c][1]):
            best[c] = (i, t)
    left3 = list(best.values()) + wordless
    kept = cp.drop_near_copies(spark, kept, folder)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i or -1 for i, _ in left3) and len(left3) < len(left2)
    kept = spark.createDataFrame(kept.collect(), docs.schema)

    # PII.
    worker = Pseudonyms(DEMO_KEY)
    left4 = {r.doc_id: r.text if r.text is None else worker.replace(r.text)[0] for r in kept.collect()}
    kept = cp.replace_pii(spark, kept, folder)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == left4
    assert all(r.n_chars == len(r.text or "") for r in kept.collect())
    assert "743" not in (left4[2000] or "") and "re.46" not in left4[2000]

    # Packing, as the whole run gives it.
    out = cp.run(spark, folder)
    assert out.columns == PACKED
    packed = out.collect()
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), None)
    lengths = Counter()
    for r in packed:
        lengths[r.doc_id] += r.length
    assert dict(lengths) == {i: len(encode.ids(t or "")) + 1 for i, t in left4.items()}
    filled = Counter()
    for r in packed:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and all(r.offset + r.length <= filled[r.sequence_id] for r in packed)


def test_empty_table(spark, workdir):
    folder = workdir("pipeline-empty")
    write(spark, folder, [])
    out = cp.run(spark, folder)
    assert out.columns == PACKED and out.count() == 0
