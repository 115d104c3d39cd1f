"""Cross-tokenizer alignment: two tokenizations of a text matched by galloping intersection of their byte ends.

Each text, with a blank before it, is tokenized twice: A by a byte-level JSON
file, B by a piece model that puts the blank there itself. The ends of the
tokens in bytes are two ascending lists. The shorter one drives: each of its
ends is looked for in the longer one from the place of the end before, by
doubling steps and then a binary search between the last two. Many documents,
and the parts of long ones, gallop in step as lanes of numpy arrays. Ends found
in both lists are common: they slice the tokens into groups. The rank of every
end in the other list gives, by differences, the range of B tokens that each A
token overlaps; these pairs are the links.

``align`` returns per row ``a_ids``, ``b_ids``, ``a_cuts``, ``b_cuts`` (how many A and
B tokens end at or before each common end), ``b_from`` and ``b_to`` (first and last
overlapping B token of each A token). ``link_counts`` adds up, over the corpus, how many links
join each id pair; ``alignment_summary`` holds each document's links against these counts.

Tokens are encoded a distinct chunk at a time (``chunks``). Counts are pre-added
within each task. Each text's distinct pairs are written once to the shared
folder; their counts are joined back, broadcast only where the table of counts
is within ``BROADCAST_PAIRS`` rows (24 bytes each), else by a shuffle.

Defined results: a text that is NULL or empty, or whose A or B bytes differ
from blank + text (one with U+2581, say), has no tokens: zeros and an empty digest.
Very long texts are scanned in windows. Special tokens' strings are plain text.
Repeated rows are documents of their own; a NULL id stays NULL; of several best pairs of a B id
all are best; an empty table gives no rows. Kept columns (``align``) called like a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.bpe import _kept, spell, spelling_table
from vellum.llm.chunks import ChunkCache, byte_level, pieces_after_blank
from vellum.llm.common import concat_ranges, prepare, row_slices, session_partitions, table, utf8_rows
from vellum.session import shared_dir

#: Bytes of text that gallop together, and ends that one lane takes.
SLICE_BYTES = 1 << 20
LANE = 64
#: Most rows of the table of pair counts that is broadcast: 24 bytes a row.
BROADCAST_PAIRS = 1_000_000
#: Distinct pairs that a task adds up before it hands them on.
HELD_PAIRS = 2_000_000
#: Ids of a vocabulary at most, and the bits of an id pair's lower half.
MOST_TOKENS, PAIR_BITS = 1 << 18, 20


class Pair:
    """Two vocabularies and the cache of both."""

    def __init__(self, json_path: str, model_path: str):
        both = [byte_level(json_path), pieces_after_blank(model_path)]
        if max(len(v.words) for v in both) > MOST_TOKENS:
            raise ValueError(f"a vocabulary has more than {MOST_TOKENS} ids")
        self.lengths = [v.lengths for v in both]
        self.cache = ChunkCache(both)


_PAIRS: dict[tuple[str, str], Pair] = {}


def tokenizer_pair(json_path: str, model_path: str) -> Pair:
    """Both tokenizers, loaded once a process."""
    key = json_path, model_path
    if key not in _PAIRS:
        _PAIRS[key] = Pair(*key)
    return _PAIRS[key]


# --- the intersection ------------------------------------------------------------


def gallop(ends: np.ndarray, start: np.ndarray, stop: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For lanes of driving ends ``ends[start:stop]``, the place in ``ends[low:high]`` of the first end that is not smaller.

    Both ranges of a lane ascend, and the last driving end is not above the last of the other list.
    Returns the places lane after lane.
    """
    out = np.empty(int((stop - start).sum()), np.int64)
    to = np.cumsum(stop - start) - (stop - start)
    at, last = low.copy(), high - 1
    for t in range(int((stop - start).max(initial=0))):
        live = np.flatnonzero(start + t < stop)
        wanted, here, end = ends[start[live] + t], at[live], last[live]
        # Doubling steps while the end there is still smaller.
        step = np.ones(len(live), np.int64)
        under, over = here - 1, here
        far = np.flatnonzero(ends[over] < wanted)
        while len(far):
            under[far] = over[far]
            over[far] = np.minimum(here[far] + step[far], end[far])
            step[far] *= 2
            far = far[ends[over[far]] < wanted[far]]
        # Binary search between the last two places.
        wide = np.flatnonzero(over - under > 1)
        while len(wide):
            middle = (under[wide] + over[wide]) >> 1
            small = ends[middle] < wanted[wide]
            under[wide[small]] = middle[small]
            over[wide[~small]] = middle[~small]
            wide = wide[over[wide] - under[wide] > 1]
        at[live] = over
        out[to[live] + t] = over
    return out


def intersect(a_ends: np.ndarray, a_bounds: np.ndarray, b_ends: np.ndarray, b_bounds: np.ndarray, lane: int = LANE):
    """Ends of many documents, each's ascending and closing alike, against each other.

    Returns (is each A end common, is each B end common, first and last B token, counted through all documents, that each A token overlaps).
    """
    ends = np.concatenate([a_ends, b_ends])
    n_a, n_b = np.diff(a_bounds), np.diff(b_bounds)
    by_a = n_a <= n_b
    drive = np.where(by_a, a_bounds[:-1], len(a_ends) + b_bounds[:-1])
    drive_stop = drive + np.where(by_a, n_a, n_b)
    other = np.where(by_a, len(a_ends) + b_bounds[:-1], a_bounds[:-1])
    other_stop = other + np.where(by_a, n_b, n_a)
    # Lanes of a bounded number of driving ends; each starts at its place by one search of the whole list.
    lanes = -(-(drive_stop - drive) // lane)
    doc = np.repeat(np.arange(len(lanes)), lanes)
    start = concat_ranges(np.zeros(len(lanes), np.int64), lanes) * lane + drive[doc]
    stop = np.minimum(start + lane, drive_stop[doc])
    low = np.where(by_a[doc], len(a_ends) + np.searchsorted(b_ends, ends[start]), np.searchsorted(a_ends, ends[start]))
    place = gallop(ends, start, stop, low, other_stop[doc])
    index = concat_ranges(start, stop - start)
    hit = ends[place] == ends[index]
    common = np.zeros(len(ends), bool)
    common[index[hit]] = True
    common[place[hit]] = True
    a_common, b_common = common[: len(a_ends)], common[len(a_ends) :]
    # Rank of each A end among the B ends: found where A drives, elsewhere from the ranks of the B ends among the A ends.
    b_to = np.empty(len(a_ends), np.int64)
    from_a = index < len(a_ends)
    b_to[index[from_a]] = place[from_a] - len(a_ends)
    if not by_a.all():
        rank, of_b = place[~from_a], index[~from_a] - len(a_ends)
        # B ends below A end i are those with at most i A ends at or below them.
        below = np.zeros(len(a_ends) + 1, np.int64)
        np.add.at(below, rank + b_common[of_b], 1)
        counted = np.cumsum(below)[:-1]
        slow = np.repeat(~by_a, n_a)
        # Documents that A drives add nothing to ``below``: their B tokens are counted apart.
        shift = np.cumsum(np.where(by_a, n_b, 0)) - np.where(by_a, n_b, 0)
        b_to[slow] = (counted + np.repeat(shift, n_a))[slow]
    b_from = np.append(0, b_to[:-1] + a_common[:-1])[: len(a_ends)]
    return a_common, b_common, b_from, b_to


# --- DataFrame operators -----------------------------------------------------------

_ARRAYS = ("a_ids", "b_ids", "a_cuts", "b_cuts", "b_from", "b_to")


def _align_rows(pair: Pair, texts: list[str]):
    """Six flat arrays of the texts and the bounds of each text's part in them."""
    cache = pair.cache
    chunks, bounds = cache.chunks(" " + t if t else "" for t in texts)
    unsound = np.flatnonzero(~cache.sound[chunks])
    if len(unsound):
        bad = np.zeros(len(texts), bool)
        bad[np.searchsorted(bounds, unsound, "right") - 1] = True
        n = np.diff(bounds)
        chunks = chunks[~np.repeat(bad, n)]
        bounds = np.append(0, np.cumsum(np.where(bad, 0, n)))
    (a, a_at), (b, b_at) = cache.ids(chunks, bounds, 0), cache.ids(chunks, bounds, 1)
    a_ends, b_ends = np.cumsum(pair.lengths[0][a]), np.cumsum(pair.lengths[1][b])
    a_common, b_common, b_from, b_to = intersect(a_ends, a_at, b_ends, b_at)
    a_cut, b_cut = np.flatnonzero(a_common) + 1, np.flatnonzero(b_common) + 1
    cut_at = np.searchsorted(a_cut, a_at, "right")
    here_a, here_b = np.repeat(a_at[:-1], np.diff(cut_at)), np.repeat(b_at[:-1], np.diff(cut_at))
    base = np.repeat(b_at[:-1], np.diff(a_at))
    return (a, b, a_cut - here_a, b_cut - here_b, b_from - base, b_to - base), (a_at, b_at, cut_at, cut_at, a_at, a_at)


def _aligned(json_path: str, model_path: str, n: int):
    """Batches whose first ``n`` columns are kept and whose next is the text -> batches of the kept columns and the arrays."""
    names = [f"_k{i}" for i in range(n)] + [f"_{c}" for c in _ARRAYS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(json_path, model_path)
        for batch in batches:
            _, offsets = utf8_rows(batch.column(n))
            for x, y in row_slices(offsets, SLICE_BYTES):
                texts = [t or "" for t in batch.column(n).slice(x, y - x).to_pylist()]
                arrays, bounds = _align_rows(pair, texts)
                lists = [
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))
                    for values, at in zip(arrays, bounds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*[c.slice(x, y - x) for c in batch.columns[:n]], *lists], names=names)

    return run


def align(df: DataFrame, json_path: str, model_path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default) and the six arrays of the module's description."""
    prepare(df.sparkSession)
    names, columns, fields = _kept(df, keep, _ARRAYS)
    more = [T.StructField(f"_{c}", T.ArrayType(T.IntegerType())) for c in _ARRAYS]
    done = df.select(*columns, F.col(text_col).alias("_t")).mapInArrow(_aligned(json_path, model_path, len(names)), T.StructType([*fields, *more]))
    return done.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)], *[F.col(f"_{c}").alias(c) for c in _ARRAYS])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after another, and the rows' bounds."""
    at = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].astype(np.int64), at - at[0]


def group_strings(arrays, bounds) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows' groups, written ``a1,a2|b1;a3|b2`` with a mark after every token, and the rows' bounds."""
    (a, b, a_cut, b_cut), (a_at, b_at, cut_at) = arrays, bounds
    n_cut = np.diff(cut_at)
    a_end, b_end = a_cut + np.repeat(a_at[:-1], n_cut), b_cut + np.repeat(b_at[:-1], n_cut)
    n_a, n_b = np.diff(a_end, prepend=0), np.diff(b_end, prepend=0)
    # Within a group the A tokens come first: an A token moves on by the B tokens of earlier groups, a B token by A's up to its own.
    mixed = np.empty(len(a) + len(b), np.int64)
    mixed[np.arange(len(a)) + np.repeat(b_end - n_b, n_a)] = a
    mixed[np.arange(len(b)) + np.repeat(a_end, n_b)] = b
    decimals = _decimals()
    text = spell(mixed, decimals)
    after = np.cumsum(decimals[2][mixed])
    text[after[a_end + b_end - n_b - 1] - 1] = ord("|")
    text[after[a_end + b_end - 1] - 1] = ord(";")
    return text, np.append(0, after)[a_at + b_at]


_DECIMALS: list = []


def _decimals():
    if not _DECIMALS:
        _DECIMALS.append(spelling_table([b"%d," % i for i in range(MOST_TOKENS)]))
    return _DECIMALS[0]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row its counts, the digest of its groups, its distinct id pairs and how often each is linked."""
    names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    for batch in batches:
        (a, a_at), (b, b_at), (a_cut, cut_at), (b_cut, _), (first, _), (last, _) = (_flat(c) for c in batch.columns[2:8])
        text, at = group_strings((a, b, a_cut, b_cut), (a_at, b_at, cut_at))
        digest = [hashlib.sha256(text[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        n_links = last - first + 1
        base = np.repeat(b_at[:-1], np.diff(a_at))
        pair = (np.repeat(a, n_links) << PAIR_BITS) | b[concat_ranges(first + base, n_links)]
        link_at = np.append(0, np.cumsum(n_links))[a_at]
        pairs, times = [], []
        for x, y in zip(link_at[:-1].tolist(), link_at[1:].tolist(), strict=True):
            p, t = np.unique(pair[x:y], return_counts=True)
            pairs.append(p)
            times.append(t)
        bounds = pa.array(np.append(0, np.cumsum([len(p) for p in pairs])), pa.int32())
        empty = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), *[pa.array(np.diff(x)) for x in (a_at, b_at, cut_at, link_at)], pa.array(digest, pa.string()),
            pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([empty, *pairs]))),
            pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([empty, *times]), pa.int32())),
        ], names=names)


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of the rows' pairs, added up within the task as far as ``HELD_PAIRS`` go."""

    def summed(pairs, times):
        p, at = np.unique(np.concatenate(pairs), return_inverse=True)
        return p, np.bincount(at, np.concatenate(times), len(p)).astype(np.int64)

    def batch_of(p, n):
        for x in range(0, len(p), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(p[x : x + 100_000]), pa.array(n[x : x + 100_000])], names=["pair", "n"])

    held, new = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [[], []]
    for batch in batches:
        for k, c in enumerate(batch.columns):
            new[k].append(_flat(c)[0])
        if sum(map(len, new[0])) > HELD_PAIRS:
            held, new = summed([held[0], *new[0]], [held[1], *new[1]]), [[], []]
            if len(held[0]) > HELD_PAIRS:
                yield from batch_of(*held)
                held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    yield from batch_of(*summed([held[0], *new[0]], [held[1], *new[1]]))


def link_counts(summaries: DataFrame) -> DataFrame:
    """Corpus-wide: pair, n (links that join the two ids), best (the highest n of the pair's B id)."""
    counts = summaries.select("pairs", "times").mapInArrow(_added_up, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1))
    return counts.withColumn("best", F.max("n").over(of_b))


def alignment_summary(
    df: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    aligned = _aligned(json_path, model_path, 2)
    schema = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    path = shared_dir(spark, "alignment")
    # The arrays of ``align`` are summed up where they are made; they are several times the text.
    rows.mapInArrow(lambda batches: _summaries(aligned(batches)), schema).write.option("compression", "zstd").parquet(path)
    summaries = spark.read.schema(schema).parquet(path)
    counts_path = shared_dir(spark, "alignment-counts")
    link_counts(summaries).write.parquet(counts_path)
    counts = spark.read.schema("pair long, n long, best long").parquet(counts_path)
    small = counts.count() <= broadcast_pairs
    links = summaries.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    joined = links.join(F.broadcast(counts) if small else counts.hint("merge"), "pair")
    of_row = joined.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    out = summaries.drop("pairs", "times").join(of_row, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizations of every document, matched by byte ends."""
    import public_tokenizers

    return alignment_summary(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
