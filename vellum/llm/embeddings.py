"""Embedding near-dedup: spherical k-means cells and blocked cosine products within them.

Vectors of one label are compared with each other, nothing else. Equal
vectors are first folded into one weighted point. Per label, spherical k-means
on a bounded sample gives centroids (the index); every point is native in the
cell of its nearest centroid. A cell that is still large gets an index of its own,
fitted on a sample of its natives, so that the number of cells follows the number
of points; it stays whole where the sample would visit half of the new cells (a dense
clump, which no index can split). Then a point visits the cells in which partners can be native. For a
unit vector x with nearest centroid c and another centroid d of the same index, a partner at
angle theta or less can be native in d only if ``x.(c - d) <= sin(theta) * |c - d|``,
and only if ``angle(x, d) <= theta + r``, r being the widest angle of d's natives to d;
so no link is lost, however the centroids lie. Both hold seen from the partner
too, so of two cells only one sends visitors to the other. Within a cell, natives
are cut into blocks; every two native blocks meet once, and native blocks meet
visitor blocks, as dense products in double precision. A block pair emits link
counts and a spanning forest of its links, never its pairs. The
forests are joined into components by label propagation on Spark.

Defined results: a vector that is NULL, empty, zero, or holds NULL or
non-finite components, or whose label is NULL, links with nothing and is its
own component. Vectors of different lengths do not link. Rows that repeat an
id are vectors of their own with their own counts; a NULL id stays NULL (its
component is NULL unless it links to a known id) and is not kept. An empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from vellum.llm.common import checkpointed, prepare, session_partitions, table
from vellum.llm.components import connected_components, forest

THRESHOLD = 0.93
SAMPLE_PER_GROUP = 8192
CELL_TARGET = 2048
MOST_CELLS = 512
#: Points of a block: the larger, the fewer times a point is sent.
BLOCK = 4096
#: A cell with more natives gets an index of its own.
SPLIT_ABOVE = 8192
#: Points that look for the cells to visit together, with the whole index of their group.
VISIT_ROWS = 16384
#: Wider than rounding: a pair is never kept apart by the border test's own arithmetic.
SLACK = 1e-9
ANGLE_SLACK = 1e-6


def usable(vector: Column) -> Column:
    """Neither NULL nor empty nor zero, all components finite."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(values) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in values])
    return x / np.sqrt((x * x).sum(1))[:, None]


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit rows, seeded far from each other; an emptied cluster takes the worst-placed row."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    far = 1.0 - x @ x[chosen[0]]
    for _ in range(k - 1):
        # The next seed is drawn by its distance from the seeds so far; where none is left, any row will do.
        weight = np.cumsum(np.maximum(far, 0.0) + 1e-12)
        chosen.append(min(int(np.searchsorted(weight, rng.random() * weight[-1])), len(x) - 1))
        far = np.minimum(far, 1.0 - x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        near = x @ c.T
        at = near.argmax(1)
        new = np.zeros_like(c)
        np.add.at(new, at, x)
        size = np.sqrt((new * new).sum(1))
        empty = np.flatnonzero(size < 1e-12)
        worst = np.argsort(near.max(1), kind="stable")[: len(empty)]
        new[empty], size[empty] = x[worst], 1.0
        c = new / size[:, None]
    return c


def _centroids(cell_target: int, most_cells: int, sine: float, must: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_h", kind="stable")
        x = unit_rows(pdf["_v"])
        k = int(min(most_cells, max(1, -(-int(pdf["_n"].iloc[0]) // cell_target)), len(x)))
        c = spherical_kmeans(x, k) if k > 1 else x[:1]
        # A dense clump: its points would visit most of its cells, so blocks of the whole cell are as good.
        if not must and (k == 1 or 2 * (1 + cells_of(x, c, sine)[1].sum(1).mean()) > k):
            return pd.DataFrame(columns=["_g", "_cell", "_c", "_k"])
        return pd.DataFrame({"_g": pdf["_g"].iloc[0], "_cell": pdf["_cell"].iloc[0], "_c": [c.ravel()], "_k": len(c)})

    return run


def cells_of(x: np.ndarray, c: np.ndarray, sine: float) -> tuple[np.ndarray, np.ndarray]:
    """(native cell of each unit row, whether a partner of the row can be native in each other cell)."""
    dots = x @ c.T
    native = dots.argmax(1)
    gap = np.sqrt(np.maximum(2.0 - 2.0 * np.clip(c @ c.T, -1, 1), 0.0))
    excess = dots[np.arange(len(x)), native][:, None] - dots
    visits = excess <= sine * gap[native] + SLACK
    visits[np.arange(len(x)), native] = False
    return native, visits


def sends(native: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Whether points native in a cell visit each other cell, or wait for its visitors: one of the two, dealt evenly."""
    return ((native[:, None] + to) % 2 == 0) == (native[:, None] < to)


def _matrix(index: pd.DataFrame, at: int = 0) -> np.ndarray:
    return np.asarray(index["_c"].iloc[at]).reshape(int(index["_k"].iloc[at]), -1)


def _assign(points: pd.DataFrame, centroids: pd.DataFrame) -> pd.DataFrame:
    """Points with their nearest centroid and its cosine."""
    if not len(points) or not len(centroids):
        return pd.DataFrame(columns=["_g", "_cell", "_sub", "_dot", "_p", "_m", "_v"])
    dots = unit_rows(points["_v"]) @ _matrix(centroids).T
    out = points[["_g", "_cell", "_p", "_m", "_v"]].copy()
    out["_sub"], out["_dot"] = dots.argmax(1), dots.max(1)
    return out


def cells_to_visit(x: np.ndarray, cell: np.ndarray, sub: np.ndarray, index: pd.DataFrame, threshold: float):
    """(row, cell, sub) of every visit of the unit rows, native in (cell, sub).

    ``index``: the centroids of the cells in the row of cell -1, and a row per cell: its populated
    parts (_subs), the smallest cosine of their natives (_least), and the parts' centroids (none: not split).
    """
    theta = math.acos(threshold)
    sine = math.sin(theta)
    centres = _matrix(index[index["_cell"] == -1])
    cells = index[index["_cell"] >= 0].sort_values("_cell")
    parts = [np.asarray(v, np.int64) for v in cells["_subs"]]
    starts = np.concatenate([[0], np.cumsum([len(v) for v in parts])])
    # Populated parts are numbered through, for the choice of who visits whom.
    numbers = cells["_cell"].to_numpy(np.int64)
    codes = np.concatenate([n * (1 << 20) + v for n, v in zip(numbers, parts)])
    own = np.searchsorted(codes, cell * (1 << 20) + sub)
    _, near = cells_of(x, centres, sine)
    found = []
    for i, number in enumerate(numbers.tolist()):
        at = np.flatnonzero(near[:, number] | (cell == number))
        least = np.clip(np.asarray(cells["_least"].iloc[i], np.float64), -1, 1)
        reach = np.cos(np.minimum(math.pi, theta + np.arccos(least) + ANGLE_SLACK)) - SLACK
        if cells["_c"].iloc[i] is None:
            visits = (x[at] @ centres[number])[:, None] >= reach
        else:
            finer = _matrix(cells, i)
            nearest, within = cells_of(x[at], finer, sine)
            within[np.arange(len(at)), nearest] = True
            visits = within[:, parts[i]] & ((x[at] @ finer.T)[:, parts[i]] >= reach)
        row, part = np.nonzero(visits & sends(own[at], starts[i] + np.arange(len(parts[i]))))
        found.append(np.stack([at[row], np.full(len(row), number), parts[i][part]]))
    return np.concatenate(found, axis=1)


def _visit(threshold: float):
    def run(points: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        visitors = [points.iloc[:0][["_g", "_cell", "_sub", "_p", "_m", "_v"]]]
        for i in range(0, len(points), 2048):
            some = points.iloc[i : i + 2048]
            cell, sub = some["_cell"].to_numpy(np.int64), some["_sub"].to_numpy(np.int64)
            row, to, part = cells_to_visit(unit_rows(some["_v"]), cell, sub, index, threshold)
            visitors.append(some.iloc[row][["_g", "_p", "_m", "_v"]].assign(_cell=to, _sub=part))
        return pd.concat(visitors)

    return run


def _compare(threshold: float):
    """One (native block, other block) pair of a cell: link counts of both blocks' points, and a forest."""

    def run(key: tuple, natives: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        same = int(key[3]) == int(key[4])
        others = natives if same else others
        out = {"_p": [], "_q": [], "_links": []}
        if len(natives) and len(others):
            x, y = unit_rows(others["_v"]), unit_rows(natives["_v"])
            p, q = others["_p"].to_numpy(np.int64), natives["_p"].to_numpy(np.int64)
            p_rows, q_rows = others["_m"].to_numpy(np.int64), natives["_m"].to_numpy(np.int64)
            linked = np.empty((len(x), len(y)), bool)
            p_links, q_links = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
            # A few hundred rows at a time: the products are bounded, only the links of the block pair are held.
            for i in range(0, len(x), 512):
                some = slice(i, i + 512)
                linked[some] = (x[some] @ y.T >= threshold) & (p[some][:, None] != q[None, :])
                p_links[some] = linked[some] @ q_rows
                if not same:
                    q_links += p_rows[some] @ linked[some]
            a, b = forest(linked, p, q)
            ids, links = np.append(p, q), np.append(p_links, q_links)
            hit = np.flatnonzero(links)
            out = {
                "_p": np.concatenate([ids[hit], a]),
                "_q": np.concatenate([np.full(len(hit), -1), b]),
                "_links": np.concatenate([links[hit], np.zeros(len(a), np.int64)]),
            }
        return pd.DataFrame(out).astype({"_p": "int64", "_q": "int64", "_links": "int64"})

    return run


CELL = ["_g", "_cell"]
PART = [*CELL, "_sub"]


def _with_index(points: DataFrame, index: DataFrame, keys: list[str], rows: int, run, schema: str) -> DataFrame:
    """``run(points, index)`` on slices of about ``rows`` points of equal keys; the keys' index rows go to each slice."""
    width = 2 * session_partitions(points.sparkSession)
    slices = checkpointed(points.groupBy(*keys).agg(F.ceil(F.count("*") / rows).cast("int").alias("_slices")))
    unit = [*keys, "_slice"]
    dealt = points.join(slices, keys).withColumn("_slice", F.pmod(F.xxhash64("_p"), F.col("_slices")).cast("int")).drop("_slices")
    spread = index.join(slices, keys).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    dealt, spread = dealt.toDF(*dealt.columns), spread.toDF(*spread.columns)
    pairs = dealt.repartition(width, *unit).groupBy(*unit).cogroup(spread.repartition(width, *unit).groupBy(*unit))
    return pairs.applyInPandas(run, schema)


def _fitted(points: DataFrame, sizes: DataFrame, sample: int, run) -> DataFrame:
    """An index per cell of ``sizes`` (_n points), on all its points up to ``sample``, else on a share by hash of half that size."""
    sized = points.select(*CELL, "_v", F.xxhash64("_v").alias("_h")).join(sizes, CELL)
    share = F.least(F.lit(1.0), F.lit(0.5 * sample) / F.col("_n"))
    chosen = sized.where((F.pmod(F.col("_h"), F.lit(1 << 20)) / float(1 << 20) < share) | (F.col("_n") <= sample))
    return checkpointed(chosen.groupBy(*CELL).applyInPandas(run, "_g long, _cell long, _c array<double>, _k int"))


def placed_points(
    points: DataFrame,
    threshold: float = THRESHOLD,
    cell_target: int = CELL_TARGET,
    most_cells: int = MOST_CELLS,
    sample: int = SAMPLE_PER_GROUP,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """Points (_g group, _p id, _m weight, _v vector) in cells: a native row each, and a visitor row where a partner may be."""
    kind = points.schema["_v"].dataType.simpleString()
    sine = math.sqrt(1.0 - threshold * threshold)
    assigned = f"_g long, _cell long, _sub long, _dot double, _p long, _m long, _v {kind}"
    points = points.select("_g", F.lit(-1).cast("long").alias("_cell"), "_p", "_m", "_v")
    sizes = points.groupBy(*CELL).agg(F.count("*").alias("_n"))
    coarse = _fitted(points, sizes, sample, _centroids(cell_target, most_cells, sine, must=True))
    natives = _with_index(points, coarse, CELL, 4096, _assign, assigned)
    natives = checkpointed(natives.withColumn("_cell", F.col("_sub")).withColumn("_sub", F.lit(0).cast("long")))
    large = checkpointed(natives.groupBy(*CELL).agg(F.count("*").alias("_n")).where(F.col("_n") > split_above))
    fine = coarse.limit(0) if large.isEmpty() else _fitted(natives, large, sample, _centroids(cell_target, most_cells, sine, must=False))
    if not fine.isEmpty():
        again = natives.join(fine.select(*CELL), CELL)
        finer = _with_index(again.drop("_sub", "_dot"), fine, CELL, 4096, _assign, assigned)
        natives = checkpointed(finer.unionByName(natives.join(fine.select(*CELL), CELL, "left_anti")))
    # At most ``most_cells`` parts a cell are gathered: their numbers and the smallest cosine of their natives.
    least = natives.groupBy(*PART).agg(F.min("_dot").alias("_least"))
    parts = least.groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("_sub", "_least"))).alias("_parts"))
    parts = parts.select(*CELL, F.col("_parts._sub").alias("_subs"), F.col("_parts._least").alias("_least"))
    index = parts.join(fine, CELL, "left").unionByName(coarse, allowMissingColumns=True)
    placed = f"_g long, _cell long, _sub long, _p long, _m long, _v {kind}"
    visitors = _with_index(natives.drop("_dot"), checkpointed(index), ["_g"], VISIT_ROWS, _visit(threshold), placed)
    return natives.drop("_dot").withColumn("_native", F.lit(True)).unionByName(checkpointed(visitors.withColumn("_native", F.lit(False))))


def embedding_links(
    df: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cell_target: int = CELL_TARGET,
    most_cells: int = MOST_CELLS,
    sample: int = SAMPLE_PER_GROUP,
    block: int = BLOCK,
    split_above: int = SPLIT_ABOVE,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = df.sparkSession
    prepare(spark)
    width = 2 * session_partitions(spark)
    # Single-precision vectors are moved as they are; the products are in double precision.
    single = isinstance(df.schema[vector_col].dataType, ArrayType) and isinstance(df.schema[vector_col].dataType.elementType, FloatType)
    number = "float" if single else "double"
    rows = df.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(F.col(vector_col), lambda x: x.cast(number)).alias("_v"),
        F.col(label_col).alias("_label"),
    )
    rows = rows.withColumn("_usable", usable(F.col("_v")) & F.col("_label").isNotNull())
    rows = rows.withColumn("_v", F.when(F.col("_usable"), F.transform("_v", lambda x: x + F.lit(0.0).cast(number))))
    # Vectors are told apart by 128 bits of hashes; the seeds differ, so the halves are independent.
    rows = checkpointed(rows.withColumns({"_h1": F.xxhash64("_v"), "_h2": F.xxhash64(F.lit(7), F.col("_v"))}))
    same = ["_label", "_h1", "_h2"]
    # Equal vectors of a label are one point: its first row, its smallest id and how many rows it stands for.
    folded = rows.where("_usable").groupBy(*same).agg(F.min("_row").alias("_p"), F.min("vec_id").alias("_id"), F.count("*").alias("_m"))
    folded = checkpointed(folded)
    # A group is a label and a length.
    group = F.xxhash64(F.col("_label").cast("string"), F.size("_v")).alias("_g")
    points = rows.select("_row", "_label", "_v").join(folded.select(F.col("_p").alias("_row"), "_p", "_m"), "_row").select(group, "_p", "_m", "_v")
    placed = placed_points(points, threshold, cell_target, most_cells, sample, split_above)
    # Blocks of a cell: every two native blocks once, and every native block with every block of visitors.
    cells = placed.groupBy(*PART).agg(
        F.ceil(F.count_if("_native") / block).cast("int").alias("_nb"), F.ceil(F.count_if(~F.col("_native")) / block).cast("int").alias("_vb")
    )
    cells = checkpointed(cells.where("_nb > 0"))
    inside = placed.join(cells, PART).withColumn("_at", F.xxhash64("_p"))
    own = F.pmod(F.col("_at"), F.col("_nb")).cast("int")
    unit = [*PART, "_b", "_o"]
    natives = (
        inside.where("_native")
        .withColumn("_b", own)
        .withColumn("_o", F.explode(F.sequence(F.col("_b"), F.col("_nb") + F.col("_vb") - 1)))
    )
    # A block is not sent to itself: the native side of that pair is both.
    visitor = F.col("_nb") + F.pmod(F.col("_at"), F.greatest(F.col("_vb"), F.lit(1))).cast("int")
    others = (
        inside.withColumn("_o", F.when(F.col("_native"), own).otherwise(visitor))
        .withColumn("_last", F.when(F.col("_native"), F.col("_o")).otherwise(F.col("_nb")) - 1)
        .where("_last >= 0")
        .withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_last"))))
    )
    compared = (
        natives.select(*unit, "_p", "_m", "_v").toDF(*unit, "_p", "_m", "_v").repartition(width, *unit).groupBy(*unit)
        .cogroup(others.select(*unit, "_p", "_m", "_v").repartition(width, *unit).groupBy(*unit))
        .applyInPandas(_compare(threshold), "_p long, _q long, _links long")
    )
    compared = checkpointed(compared)
    counts = compared.where("_q < 0").groupBy("_p").agg(F.sum("_links").alias("_links"))
    edges = compared.where("_q >= 0").select(F.col("_p").alias("a"), F.col("_q").alias("b"))
    comp = connected_components(edges)
    per_point = checkpointed(
        folded.join(counts, "_p", "left").join(comp.withColumnRenamed("node", "_p"), "_p", "left")
        .withColumn("_comp", F.coalesce("component", "_p"))
        .withColumn("_n", F.coalesce("_links", F.lit(0)) + F.col("_m") - 1)
    )
    smallest = checkpointed(per_point.groupBy("_comp").agg(F.min("_id").alias("component_id")))
    per_point = checkpointed(per_point.join(smallest, "_comp").select(*same, "_n", "component_id"))
    linked = rows.where("_usable").select(*same, "vec_id").join(per_point, same).select("vec_id", F.col("_n").alias("n_links"), "component_id")
    alone = rows.where("NOT _usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all embeddings within equal labels, at cosine 0.93."""
    return embedding_links(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.w, b.w) >= 0.93
), reach(id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), comp AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
), n AS (
  SELECT a, count(*) AS n_links FROM links GROUP BY a
)
SELECT c.id AS vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, c.id = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.a = c.id
"""
