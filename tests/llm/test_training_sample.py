import random

from vellum.llm import quality, toxicity
from vellum.llm.common import checkpointed
from vellum.llm.quality import training_sample


def test_the_sample_is_taken_from_labels_whose_document_is_there(spark):
    ids = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (ids[0], None)], "doc_id long, quality int")
    there = ids[-60:]
    docs = spark.createDataFrame([(i, f"text {i}") for i in there] + [(there[0], "a copy")] * 300 + [(None, "none"), (10_000, "unlabelled")], "doc_id long, text string")
    rows = training_sample(docs, labels, "quality", 50).collect()
    # All 50 are found although hundreds of labels have no document, and a repeated id takes one place.
    assert len(rows) == 50 and len({r.text for r in rows}) == 50
    every = training_sample(docs, labels, "quality", 1000).collect()
    assert sorted(r.text for r in every) == sorted(["a copy", *(f"text {i}" for i in there[1:])])
    assert all(r._y == int(r.text.split()[1]) % 2 for r in every if r.text != "a copy")
    assert training_sample(docs.limit(0), labels, "quality", 10).count() == 0


def test_the_fits_passes_follow_the_sample_and_not_the_shuffles(spark, monkeypatch, capsys):
    """The sample is bounded, and so are the tasks of every pass over it; its vectors take one Python step (before: 60 tasks a pass, two steps)."""
    rng = random.Random(4)
    words = ["plain", "word", "here", "and", "there", "awful", "nasty"]
    rows = [(i, " ".join(rng.choices(words[:5], k=12)) + (" awful nasty 123 ###" if i % 3 == 0 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    seen, plans = [], []

    def recorded(df, *how):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)
        out = checkpointed(df, *how)
        seen.append(out.rdd.getNumPartitions())
        return out

    for module in (quality, toxicity):
        monkeypatch.setattr(module, "checkpointed", recorded)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert quality.fit(docs, labels, trees=2).rules and len(toxicity.fit(docs, labels).hashes)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(seen) == 5 and max(seen) <= 1 + quality.SAMPLE // quality.ROWS_A_TASK
    assert not any("EvalPython" in p for p in plans)
