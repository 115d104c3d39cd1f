"""MinHash near-dedup with an LSH forest: sorted signature orders and their neighbours.

1. Every document becomes its set of hashed word shingles, a 128-bit
   fingerprint of that set and a MinHash signature. Documents of equal sets
   are one class from here on.
2. The signature is cut into trees; each tree's part of it, most significant
   hash first, is a sort key. All (tree, key, class) rows are range-partitioned
   and sorted, which is the forest written out: classes that share a prefix
   are neighbours. A hot region is spread over many partitions by its key and
   class, never gathered.
3. A region is a shared prefix of ``least_depth`` hashes. Small regions give
   all their pairs. In larger ones the depth adapts: sub-regions that are small
   at some greater depth give all their pairs, and everywhere the nearest
   neighbours in order (longest common prefix) are candidates.
4. Candidates are confirmed on the full shingle sets; confirmed links give
   components.
5. The exact way for the rest: a region that was too large for all its pairs,
   or was cut by a partition's border, can still hold links between different
   components. There, members outside the region's largest component are compared
   with all members of the region, in pairs of blocks: one product of the blocks'
   full sets gives all shared counts, and a forest of the links goes out, no pairs.

What remains is MinHash's own chance: a pair at similarity 0.8 shares no prefix
of 3 hashes in any of 16 trees with probability 1e-5, one at 0.9 with 1e-9.

Defined results: a NULL text, or one without words, has an empty set, is
linked with nothing and is its own component; fewer words than a shingle make
one shingle of all of them; repeated rows belong to one class; a NULL id is
the component of nothing (a class without any id has a NULL component) and
its row is not kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.bitfilter import with_hits
from vellum.llm.common import checkpointed, concat_ranges, prepare, session_partitions, table
from vellum.llm.components import connected_components, forest
from vellum.llm.hashing import mixed, shingle_sets

TREES, DEPTH, LEAST_DEPTH = 16, 6, 3
LEAF = 16
NEIGHBOURS = 2
BLOCK = 256
PERCENT = 80
BROADCAST_REGIONS = 100_000


def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(97)
    return rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def signatures(sets: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """MinHash signatures (rows x n, uint32) of rows whose sets are not empty."""
    a, b = multipliers(n)
    x = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, n), np.uint32)
    for k in range(n):
        out[:, k] = np.minimum.reduceat(x * a[k] + b[k], bounds[:-1])
    return out


def _sketch(size: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "tk", "n", "f1", "f2", "sig"]
        for batch in batches:
            for a, b, sets, bounds in shingle_sets(batch.column(2), size):
                n = np.diff(bounds)
                filled = np.flatnonzero(n)
                f1, f2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                sig = [None] * (b - a)
                if len(filled):
                    cut = bounds[filled]
                    f1[filled] = np.add.reduceat(mixed(sets), cut)
                    f2[filled] = np.add.reduceat(mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), cut)
                    made = signatures(sets, np.append(cut, bounds[-1]), hashes)
                    for row, s in zip(filled, made, strict=True):
                        sig[row] = s.tobytes()
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(n, pa.int64()),
                    pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(sig, pa.binary()),
                ], names=names)

    return run


def sketches(df: DataFrame, id_col: str, text_col: str, size: int, hashes: int) -> DataFrame:
    """doc_id, text key, set size, fingerprint and signature (NULL for empty sets) of each row."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_sketch(size, hashes), "doc_id long, tk long, n long, f1 long, f2 long, sig binary")


# --- the forest ----------------------------------------------------------------


def _orders(trees: int, depth: int):
    """(tree, key, cid, n): each tree's hashes as a big-endian key, whose byte order is its sort order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = len(batch)
            if not rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(rows, trees, depth)
            flat = sig.astype(">u4").tobytes()
            width = 4 * depth
            keys = pa.Array.from_buffers(pa.binary(width), rows * trees, [None, pa.py_buffer(flat)]).cast(pa.binary())
            take = pa.array(np.repeat(np.arange(rows), trees))
            tree = pa.array(np.tile(np.arange(trees, dtype=np.int32), rows))
            yield pa.RecordBatch.from_arrays([tree, keys, batch.column(0).take(take), batch.column(2).take(take)], names=["tree", "key", "cid", "n"])

    return run


def neighbour_pairs(key: np.ndarray, least: int, leaf: int, near: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Candidates among sorted keys (rows x (1 + depth): tree, hashes).

    Returns (first positions, second positions, region number of each row, whether each region is too large for all pairs).
    """
    n, depth = len(key), key.shape[1] - 1
    same = np.cumprod(key[1:] == key[:-1], axis=1).sum(1)  # tree and hashes shared with the row above
    shared = np.append(0, same)  # 1 + depth levels; 0 for the first row
    region = np.cumsum(shared < 1 + least) - 1
    size = np.bincount(region)
    # The depth at which a row's (sub-)region is small enough to give all its pairs.
    enough = np.full(n, depth + 2)
    for d in range(depth, least - 1, -1):
        part = np.cumsum(shared < 1 + d) - 1
        enough = np.where(np.bincount(part)[part] <= leaf, 1 + d, enough)
    first, second = [], []
    levels = shared
    for s in range(1, min(leaf, n)):
        # Levels shared by rows i and i - s: the least of what neighbouring rows share between them.
        levels = np.minimum(levels[1:], shared[1 : n - s + 1])
        i = np.arange(s, n)
        in_region = levels >= 1 + least
        if not in_region.any():
            break
        take = in_region & ((levels >= enough[i]) | (s <= near))
        second.append(i[take])
        first.append(i[take] - s)
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *first]), np.concatenate([empty, *second]), region, size > leaf


def _neighbours(depth: int, least: int, leaf: int, near: int, percent: int):
    """Over a sorted partition: kind 0 candidate pairs (a, b); kind 1 open regions; kind 2 rows at the partition's borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        part = ctx.partitionId() if ctx else 0
        names = ["kind", "a", "b", "tree", "region"]
        schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()), ("region", pa.binary())])

        def rows(kind, a, b, tree, region):
            k = pa.array(np.full(len(a), kind, np.int32))
            return pa.RecordBatch.from_arrays([k, pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(tree, pa.int32()), pa.array(region, pa.binary())], schema=schema)

        def done(tree, key, cid, n, opened: bool, closes: bool):
            """All of these rows, which hold whole regions but for the first and last of a partition."""
            hashes = np.frombuffer(b"".join(key), ">u4").reshape(len(key), depth).astype(np.int64)
            i, j, region, large = neighbour_pairs(np.column_stack([tree, hashes]), least, leaf, near)
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            fits = (100 * low >= percent * high) & (cid[i] != cid[j])
            i, j = i[fits], j[fits]
            a, b = np.minimum(cid[i], cid[j]), np.maximum(cid[i], cid[j])
            code = np.unique(np.column_stack([a, b]), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            none = [None] * len(code)
            yield rows(0, code[:, 0], code[:, 1], none, none)
            if opened:
                large[0] = True
            if closes:
                large[-1] = True
            begin = np.searchsorted(region, np.flatnonzero(large))
            yield rows(1, [None] * len(begin), [None] * len(begin), tree[begin], [key[x][: 4 * least] for x in begin])

        held, first, last = None, True, None
        for batch in batches:
            if not len(batch):
                continue
            new = (batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy(), batch.column(3).to_numpy())
            if first and held is None:
                yield rows(2, new[2][:1], [2 * part], new[0][:1], [new[1][0][: 4 * least]])
            last = rows(2, new[2][-1:], [2 * part + 1], new[0][-1:], [new[1][-1][: 4 * least]])
            if held is not None:
                new = (np.append(held[0], new[0]), held[1] + new[1], np.append(held[2], new[2]), np.append(held[3], new[3]))
            # Rows of the last region wait for the next batch; a region longer than two batches goes on in pieces.
            tree, key, cid, n = new
            cut = len(key) - 1
            while cut > 0 and tree[cut - 1] == tree[-1] and key[cut - 1][: 4 * least] == key[-1][: 4 * least]:
                cut -= 1
            in_pieces = cut == 0 and len(key) > 20_000
            if in_pieces:
                cut = len(key) - near
            if cut > 0:
                yield from done(tree[:cut], key[:cut], cid[:cut], n[:cut], first, in_pieces)
                first = in_pieces
            held = (tree[cut:], key[cut:], cid[cut:], n[cut:])
            if in_pieces:
                held = (tree[cut - near :], key[cut - near :], cid[cut - near :], n[cut - near :])
        if held is not None:
            yield from done(*held, first, True)
            yield last

    return run


# --- confirmation --------------------------------------------------------------


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets, bounds in shingle_sets(batch.column(1), size):
                raw = sets.tobytes()
                of = [raw[8 * x : 8 * y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(of, pa.binary())], names=["cid", "members"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                # Sorted distinct values: those equal to their successor once both are sorted together are shared.
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b) whose full shingle sets reach the similarity."""
    left = sets.select(F.col("cid").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("members").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return checkpointed(joined.mapInArrow(_confirm(percent), "a long, b long"))


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members each left set shares with each right set.

    Members that only few sets hold are paired off directly; common ones go
    into dense products, a few thousand members at a time.
    """
    sizes = [np.array([len(x) for x in side]) for side in (left, right)]
    values, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    row = [np.repeat(np.arange(len(s)), s) for s in sizes]
    code = [code[: len(row[0])], code[len(row[0]) :]]
    held = [np.bincount(c, minlength=len(values)) for c in code]
    dense = held[0] * held[1] > 256
    out = np.zeros((len(left), len(right)), np.int64)
    # Rare members: every (left row, right row) that holds one.
    order = np.argsort(code[1], kind="stable")
    rare = np.flatnonzero(~dense[code[0]] & (held[1][code[0]] > 0))
    first = np.cumsum(held[1]) - held[1]
    for at in range(0, len(rare), 1 << 14):
        part = rare[at : at + (1 << 14)]
        n = held[1][code[0][part]]
        np.add.at(out, (np.repeat(row[0][part], n), row[1][order[concat_ranges(first[code[0][part]], n)]]), 1)
    # Common members: 0/1 matrices.
    common = np.flatnonzero(dense)
    place = np.full(len(values), -1)
    place[common] = np.arange(len(common))
    for at in range(0, len(common), 4096):
        m = []
        for r, c, s in zip(row, code, sizes, strict=True):
            x = np.zeros((len(s), min(4096, len(common) - at)), np.float32)
            k = place[c] - at
            hit = (place[c] >= at) & (k < x.shape[1])
            x[r[hit], k[hit]] = 1
            m.append(x)
        out += np.rint(m[0] @ m[1].T).astype(np.int64)
    return out


def _links_between(percent: int):
    """Links between a block of a region's outsiders and a block of its members, as a forest."""

    def run(outside: pd.DataFrame, inside: pd.DataFrame) -> pd.DataFrame:
        a = b = np.zeros(0, np.int64)
        if len(outside) and len(inside):
            left = [np.frombuffer(x, np.uint64) for x in outside["members"]]
            right = [np.frombuffer(x, np.uint64) for x in inside["members"]]
            shared = shared_counts(left, right)
            n, m = (np.array([len(x) for x in side]) for side in (left, right))
            linked = 100 * shared >= percent * (n[:, None] + m[None, :] - shared)
            linked &= outside["comp"].to_numpy()[:, None] != inside["comp"].to_numpy()[None, :]
            a, b = forest(linked, outside["cid"].to_numpy(np.int64), inside["cid"].to_numpy(np.int64))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def near_duplicates(
    df: DataFrame,
    shingle: int = 5,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    trees: int = TREES,
    depth: int = DEPTH,
    least_depth: int = LEAST_DEPTH,
    leaf: int = LEAF,
    near: int = NEIGHBOURS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, tk (xxhash64 of its text), n_shingles, component_id, kept, group_id.

    group_id numbers the components; it is NULL for documents without words.

    Documents are linked at ``100 * shared >= percent * union`` of their distinct shingles.
    """
    spark = df.sparkSession
    prepare(spark)
    hashes = trees * depth
    docs = checkpointed(sketches(df, id_col, text_col, shingle, hashes))
    filled = docs.where("n > 0")
    # Classes of equal sets; the smallest (id, text key) stands for the class.
    classes = (
        filled.groupBy("n", "f1", "f2")
        .agg(F.min(F.struct("doc_id", "tk")).alias("rep"), F.min("doc_id").alias("least_id"), F.first("sig").alias("sig"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = checkpointed(classes)
    # The forest: all trees' orders, range-partitioned and sorted.
    orders = classes.select("cid", "sig", "n").mapInArrow(_orders(trees, depth), "tree int, key binary, cid long, n long")
    sorted_orders = orders.repartitionByRange(session_partitions(spark), "tree", "key", "cid").sortWithinPartitions("tree", "key", "cid")
    found = checkpointed(
        sorted_orders.mapInArrow(_neighbours(depth, least_depth, leaf, near, percent), "kind int, a long, b long, tree int, region binary")
    )
    # Partitions' border rows of one region are neighbours in order too.
    border = found.where("kind = 2").withColumn("before", F.lag("a").over(Window.partitionBy("tree", "region").orderBy("b")))
    border = border.where("before <> a").select(F.least("a", "before").alias("a"), F.greatest("a", "before").alias("b"))
    n_found = found.count()
    pairs = checkpointed(found.where("kind = 0").select("a", "b").unionByName(border).distinct(), n_found)
    open_regions = checkpointed(found.where("kind = 1").select("tree", "region").distinct(), n_found)
    # Members of open regions, with what the exact way needs.
    width = 4 * least_depth
    # Broadcast up to so many rows of 16 bytes; else the orders move to their regions.
    regions = F.broadcast(open_regions) if open_regions.count() <= BROADCAST_REGIONS else open_regions
    members = orders.select("tree", F.substring("key", 1, width).alias("region"), "cid", "n").join(regions, ["tree", "region"])
    members = checkpointed(members)
    # Full sets of everything that may have to be confirmed.
    wanted = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).unionByName(members.select("cid")).distinct()
    wanted = checkpointed(classes.select("cid", "rep.doc_id", "rep.tk").join(wanted, "cid"))
    texts = df.select(F.col(id_col).cast("long").alias("_d"), F.xxhash64(text_col).alias("_t"), F.col(text_col).alias("text"))
    # Texts that nothing wants stay where they are.
    texts = with_hits(texts, F.xxhash64("_d", "_t"), wanted, F.xxhash64("doc_id", "tk")).where("_hit")
    texts = texts.join(wanted, F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_t") == F.col("tk")))
    sets = checkpointed(texts.select("cid", "text").mapInArrow(_sets(shingle), "cid long, members binary").dropDuplicates(["cid"]))
    links = confirmed(pairs, sets, percent)
    comp = checkpointed(connected_components(links), 2 * n_found)
    # The exact way for the rest.
    member_comp = members.join(comp, members["cid"] == comp["node"], "left").select(
        "tree", "region", "cid", "n", F.coalesce("component", "cid").alias("comp")
    )
    member_comp = checkpointed(member_comp)
    major = (
        member_comp.groupBy("tree", "region", "comp").agg(F.count("*").alias("c"))
        .groupBy("tree", "region")
        .agg(F.max_by("comp", F.struct("c", "comp")).alias("major"), F.sum("c").alias("size"), F.max("c").alias("inside"), F.count("*").alias("comps"))
        .where("comps > 1")
        .select("tree", "region", "major", F.ceil((F.col("size") - F.col("inside")) / block).cast("int").alias("lefts"),
                F.ceil(F.col("size") / block).cast("int").alias("rights"))
    )
    major = checkpointed(major, n_found)
    rest = member_comp.join(major, ["tree", "region"]).join(sets, "cid").withColumn("at", F.xxhash64("cid", F.lit(1)))
    unit = ["tree", "region", "i", "j"]
    outside = rest.where("comp <> major").withColumn("i", F.pmod("at", "lefts")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("rights") - 1)))
    inside = rest.withColumn("j", F.pmod("at", "rights")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
    names = [*unit, "cid", "comp", "members"]
    sides = [
        side.select("tree", "region", F.col("i").cast("int"), F.col("j").cast("int"), "cid", "comp", "members").toDF(*names)
        .repartition(2 * session_partitions(spark), *unit).groupBy(*unit)
        for side in (outside, inside)
    ]
    more = checkpointed(sides[0].cogroup(sides[1]).applyInPandas(_links_between(percent), "a long, b long").distinct(), n_found)
    if not more.isEmpty():
        # The components so far are stars already; only what joins them is new.
        stars = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
        comp = connected_components(stars.unionByName(more))
    # Back to classes, then to documents.
    placed = classes.join(comp, classes["cid"] == comp["node"], "left").withColumn("comp", F.coalesce("component", "cid"))
    placed = checkpointed(placed.select("n", "f1", "f2", "least_id", "comp"))
    smallest = checkpointed(placed.groupBy("comp").agg(F.min("least_id").alias("component_id")))
    placed = checkpointed(placed.join(smallest, "comp").select("n", "f1", "f2", "component_id", F.col("comp").alias("group_id")))
    columns = ["doc_id", "tk", F.col("n").alias("n_shingles")]
    linked = filled.join(placed, ["n", "f1", "f2"]).select(*columns, "component_id", "group_id")
    alone = docs.where("n = 0").select(*columns, F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group_id"))
    out = linked.unionByName(alone)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.select("doc_id", "tk", "n_shingles", "component_id", kept.alias("kept"), "group_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``df`` that stay when one document of each near-duplicate group does.

    Of a group the smallest known id stays, of rows that repeat it one; documents without words all stay.
    """
    found = checkpointed(near_duplicates(df, id_col=id_col, text_col=text_col, **how))
    copies = found.where("group_id IS NOT NULL").groupBy("group_id", "doc_id", "tk").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tk", "copies")).alias("f")
    firsts = checkpointed(copies.groupBy("group_id").agg(first))
    stay = firsts.select(F.col("f.doc_id").alias("_d"), F.col("f.tk").alias("_t"), F.col("f.copies").alias("_c"))
    wordless = found.where("group_id IS NULL").select(F.col("doc_id").alias("_d"), F.col("tk").alias("_t")).distinct()
    stay = stay.unionByName(wordless.withColumn("_c", F.lit(1).cast("long")))
    # Rows that may go: those of a group but for its first, and first ones that are repeated.
    is_first = F.col("f.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("f.tk") == F.col("tk")) & (F.col("copies") == 1)
    leaving = copies.join(firsts, "group_id").where(~is_first).select("doc_id", "tk")
    # Positional names, so that no column of the input can clash with ours.
    plain = df.toDF(*[f"_k{i}" for i in range(len(df.columns))])
    the_id, the_text = F.col(f"_k{df.columns.index(id_col)}").cast("long"), F.col(f"_k{df.columns.index(text_col)}")
    marked = with_hits(plain, F.xxhash64(the_id, F.xxhash64(the_text)), leaving, F.xxhash64("doc_id", "tk"))
    # All others stay where they are; only rows that may go meet the exact join.
    same = the_id.eqNullSafe(F.col("_d")) & (F.xxhash64(the_text) == F.col("_t"))
    rows = marked.where("_hit").join(stay, same)
    if not firsts.where("f.copies > 1").isEmpty():
        rows = rows.where("_c = 1").unionByName(rows.where("_c > 1").dropDuplicates(["_d", "_t"]))
    names = [F.col(f"_k{i}").alias(c) for i, c in enumerate(df.columns)]
    return marked.where("NOT _hit").select(*names).unionAll(rows.select(*names))


def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents at 0.8 of their 4-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4).drop("tk", "group_id")


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
    FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
  ) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.shared >= 80 * (na.n + nb.n - p.shared)
), reach(id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), comp AS (
  SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT c.id AS doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, c.id = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.doc_id = c.id
"""
