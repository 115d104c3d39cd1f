"""Quality classifier: a sparse rule ensemble over text statistics.

A random forest on a bounded sample of labelled rows supplies candidate rules:
every path from a root to an inner node or leaf is a conjunction of threshold
tests on text statistics. A lasso logistic regression over the rules keeps the
few that matter. The kept rules are compiled into one Spark column expression,
so scoring is a narrow pass: statistics, rule sum, logistic function, all in
the JVM, without a shuffle and without the labels.

The sample: labelled rows outside the held-out third, the first ``SAMPLE``
of them in the order of a hash of the id (a documented, fixed bound). Labels,
language, source and id are never features.

Defined results: a NULL text counts as empty; empty texts get the score that
their (zero) statistics give; repeated rows get equal scores, row by row; a
NULL id is scored and held out of nothing. Without training rows, or with one
class only, every score is the smoothed rate of the training labels (0.5 if
there are none). Clashing further columns are kept as they are.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import checkpointed, held_out, in_training, prepare, table

SAMPLE = 20_000
#: Of the sample; every pass of the fits is a task a partition, so they follow the sample's bound and not the session's shuffles.
ROWS_A_TASK = 2_500
THRESHOLD = 0.5
TREES, DEPTH, LASSO = 12, 4, 0.002
SEED = 7

STATISTICS = (
    "n_words",
    "n_chars",
    "word_length",
    "distinct_words",
    "adjacent_repeats",
    "upper",
    "digits",
    "symbols",
    "line_length",
    "repeated_lines",
)


def statistics(text: Column) -> tuple[list[tuple[str, Column]], list[tuple[str, Column]]]:
    """(intermediate columns, statistics over them), all built-in column functions."""
    t = F.col("_t")
    kept = lambda pattern: F.length(F.regexp_replace(t, pattern, "")).cast("double")
    base = [
        ("_t", F.coalesce(text, F.lit(""))),
        ("_w", F.filter(F.split(t, r"[ \t\n\r\f\x0B]+"), lambda x: x != "")),
        ("_l", F.filter(F.split(t, "\n"), lambda x: x != "")),
    ]
    chars, words, lines = F.length(t).cast("double"), F.size("_w").cast("double"), F.size("_l").cast("double")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    repeats = F.size(F.filter(F.col("_w"), lambda x, i: (i > 0) & (x == F.get(F.col("_w"), i - 1)))).cast("double")
    columns = [
        words,
        chars,
        ratio(chars, words),
        ratio(F.size(F.array_distinct("_w")).cast("double"), words),
        ratio(repeats, words),
        ratio(kept(r"[^\p{Lu}]+"), chars),
        ratio(kept(r"[^0-9]+"), chars),
        ratio(kept(r"[^#$%&*|!@^~=<>{}\\_+]+"), chars),
        ratio(chars, lines),
        ratio(lines - F.size(F.array_distinct("_l")), lines),
    ]
    return base, list(zip(STATISTICS, columns, strict=True))


def with_statistics(df: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """``keep`` and one struct column ``_s`` of statistics."""
    base, stats = statistics(F.col(text_col))
    out = df.select(*[c.alias(f"_k{i}") for i, c in enumerate(keep)], base[0][1].alias("_t"))
    out = out.withColumn("_w", base[1][1]).withColumn("_l", base[2][1])
    return out.select(*[f"_k{i}" for i in range(len(keep))], F.struct(*[c.alias(n) for n, c in stats]).alias("_s"))


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is_upper_bound, threshold) tests."""

    tests: tuple[tuple[str, bool, float], ...]

    def column(self, stats: str = "_s") -> Column:
        out = F.lit(True)
        for name, upper, value in self.tests:
            c = F.col(f"{stats}.{name}")
            out = out & ((c <= value) if upper else (c > value))
        return out


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self, stats: str = "_s") -> Column:
        """The logistic score as one column expression over the statistics."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(stats), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def _tightened(tests: list[tuple[str, bool, float]]) -> Rule:
    """One test per statistic and direction, in a fixed order."""
    best: dict[tuple[str, bool], float] = {}
    for name, upper, value in tests:
        old = best.get((name, upper))
        best[name, upper] = value if old is None else (min(old, value) if upper else max(old, value))
    return Rule(tuple(sorted((n, u, v) for (n, u), v in best.items())))


def path_rules(debug_string: str) -> list[Rule]:
    """Every path of the trees in a Spark forest's printed form, as rules."""
    rules, stack = [], []
    for line in debug_string.splitlines():
        if re.match(r"\s*Tree ", line):
            stack = []
            continue
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+\w.]+)\)", line)
        if m:
            depth = len(m[1])
            stack = [x for x in stack if x[0] < depth]
            stack.append((depth, (STATISTICS[int(m[2])], m[3] == "<=", float(m[4]))))
            rules.append(_tightened([test for _, test in stack]))
    return list(dict.fromkeys(rules))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, _y) of at most ``sample`` labelled documents; no label outside the training part is read.

    Only labels whose document is there count towards the sample; of rows that repeat an id the
    smallest text stands for it. The sample's ids are bounded, so they are broadcast and the
    documents are not shuffled, but for the sample's own.
    """
    there = docs.select(F.col(id_col).alias("_there"))
    ids = (
        labels.where(in_training(id_col) & F.col(id_col).isNotNull() & F.col(label).isin(0, 1))
        .join(there, F.col(id_col) == F.col("_there"), "left_semi")
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(F.col(label)).cast("double").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("_d"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(ids), F.col("_d") == F.col("_id")).groupBy("_id", "_y").agg(F.min("text").alias("text")).select("text", "_y")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    text_col: str = "text",
    id_col: str = "doc_id",
    sample: int = SAMPLE,
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
) -> RuleModel:
    """Learn the rule ensemble from at most ``sample`` labelled rows."""
    prepare(docs.sparkSession)
    # Written first: over an aggregation the statistics would be folded into it, and computed again wherever one is used.
    written = checkpointed(training_sample(docs, labels, label, sample, id_col, text_col), sample, ROWS_A_TASK)
    rows = with_statistics(written, "text", [F.col("_y")])
    rows = rows.select(F.col("_k0").alias("label"), "_s").withColumn(
        "features", array_to_vector(F.array(*[F.col(f"_s.{n}") for n in STATISTICS]))
    )
    rows = checkpointed(rows)
    n, positive = rows.agg(F.count("*"), F.sum("label")).first()
    positive = positive or 0.0
    prior = math.log((positive + 1) / (n - positive + 1))
    if not 0 < positive < n:
        return RuleModel(prior)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=5, subsamplingRate=0.7,
        featureSubsetStrategy="onethird", seed=SEED,
    ).fit(rows)
    rules = path_rules(forest.toDebugString)
    if not rules:
        return RuleModel(prior)
    table_of_rules = checkpointed(
        rows.select("label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("features"))
    )
    lr = LogisticRegression(maxIter=60, regParam=lasso, elasticNetParam=1.0, tol=1e-5).fit(table_of_rules)
    weights = lr.coefficients.toArray()
    kept = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-9]
    return RuleModel(float(lr.intercept), kept)


def scored(docs: DataFrame, model: RuleModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default, but an older ``score``) and ``score``: a narrow pass."""
    prepare(docs.sparkSession)
    names = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    out = with_statistics(docs, text_col, [F.col(f"`{c}`") for c in names])
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)], model.score().alias("score"))


def accepted(docs: DataFrame, model: RuleModel, text_col: str = "text", at_least: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with their columns.

    Written with a generator: a plain filter would be pushed below the
    statistics, with their expressions copied into it for every test of every rule.
    """
    prepare(docs.sparkSession)
    out = with_statistics(docs, text_col, [F.col(f"`{c}`") for c in docs.columns])
    names = [F.col(f"_k{i}").alias(c) for i, c in enumerate(docs.columns)]
    score = model.score()
    passed = out.select(*[f"_k{i}" for i in range(len(names))], F.explode(F.when(score >= at_least, F.array(F.lit(True)))).alias("_pass"))
    return passed.select(*names)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the rules learnt from the training part of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = scored(docs, fit(docs, labels), keep=["doc_id"])
    return out.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
