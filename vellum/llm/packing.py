"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents are tokenised, closed by an end id, and cut into pieces where they
are longer than a sequence (the first piece takes the remainder). Full pieces
are sequences of their own. The others are dealt by a hash into blocks of some
thousand pieces; a block is one packing problem, evolved on several islands:

* an island starts from best-fit-decreasing packings with perturbed orders;
* a crossover injects whole well-filled sequences of one parent into the other,
  removes the sequences that hold duplicates of the injected pieces, and puts
  the displaced pieces back by best fit, largest first;
* a mutation dissolves the worst-filled sequences the same way;
* after each epoch every island receives its neighbour's elite, through a join
  on (block, island); the last epoch's best island gives the block's result.

Evolution of a block ends early when its number of sequences equals the lower
bound. Only piece lengths and numbers travel; the ids stay where they are made.

Token ids are those of the ``tokenizers`` library for the JSON file. Texts
whose characters all lie in a range where it is proven (by a test over every
codepoint) to agree with ``tiktoken`` on the same vocabulary's rank file are
encoded by ``tiktoken``, about 3.5 times faster; all others by ``tokenizers``,
and so are texts that hold an added token of the JSON file (<|endoftext|>), which
gets its own id there, and texts with a run of 10,000 white-space characters or more.

Defined results: a NULL or empty text is one piece of the end id alone;
repeated rows are documents of their own; a NULL id stays NULL; ties of length
are broken by piece number; a very long text is encoded whole and cut into as many pieces as it
fills; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import checkpointed, prepare, session_partitions, table

LENGTH = 2048
END = 0
BLOCK_PIECES = 8192
ISLANDS, EPOCHS, POPULATION, OFFSPRING = 3, 2, 4, 6
#: Outside this range the two libraries' Unicode tables are not taken for granted.
UNPROVEN = re.compile("[^\\x00-ɏ‐-‧]")


#: ``tiktoken``'s pattern backtracks over runs of white space and gives up on some hundred thousand characters (tested to
#: agree up to this length); texts with longer runs go to ``tokenizers``, which takes any.
LONG_BLANKS = re.compile(r"\s{10000}")


class Encoder:
    """Ids of texts, as ``tokenizers`` gives them; added tokens of the JSON file are ordinary text unless ``added`` is set."""

    def __init__(self, json_path: str, rank_path: str | None, added: bool = False):
        self.json_path, self._full, self.fast, self.added, self.holds_added = json_path, None, None, added, None
        if added:
            with open(json_path, encoding="utf-8") as f:
                tokens = json.load(f).get("added_tokens") or []
            # A token matched on normalised text may be spelt otherwise in the text: then nothing is taken for granted.
            exact = all(not t.get("normalized") for t in tokens)
            self.holds_added = re.compile("|".join(re.escape(t["content"]) for t in tokens) if exact else "") if tokens else None
        if rank_path:
            import public_tokenizers
            import tiktoken

            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def full(self):
        """The JSON file's tokenizer, loaded when a text first needs it."""
        if self._full is None:
            from tokenizers import Tokenizer

            self._full = Tokenizer.from_file(self.json_path)
            self._full.encode_special_tokens = not self.added
        return self._full

    def ids(self, text: str) -> np.ndarray:
        proven = self.fast is not None and (text.isascii() or not UNPROVEN.search(text))
        if proven and not (self.holds_added and self.holds_added.search(text)) and not LONG_BLANKS.search(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(json_path: str, rank_path: str | None) -> Encoder:
    """The contract's encoder: the tokenizer's default, in which added tokens have their ids."""
    key = json_path, rank_path
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key, added=True)
    return _ENCODERS[key]


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; all but the first are full."""
    first = (n - 1) % length + 1
    return [(0, first), *((s, length) for s in range(first, n, length))]


def _pieces(json_path: str, rank_path: str | None, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(json_path, rank_path)
        for batch in batches:
            rows, piece, start, size, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(enc.ids(text.as_py() or ""), np.uint32(end)).astype("<u4")
                for k, (s, n) in enumerate(cut(len(ids), length)):
                    rows.append(i)
                    piece.append(k)
                    start.append(s)
                    size.append(n)
                    crc.append(zlib.crc32(ids[s : s + n].tobytes()))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int64()), pa.array(crc, pa.int64()),
            ], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(df: DataFrame, json_path: str, rank_path: str | None, length: int = LENGTH, end: int = END, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    prepare(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_pieces(json_path, rank_path, length, end), "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the genetic algorithm -----------------------------------------------------


def best_fit(order, sizes: list[int], bin_of: np.ndarray, fill: list[int], capacity: int) -> None:
    """Put the pieces, in this order, each into the fullest sequence that still takes it; new ones are opened."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some sequence has room r
    for b, f in enumerate(fill):
        if f < capacity:
            room[capacity - f].append(b)
            open_rooms |= 1 << (capacity - f)
    for i in order:
        s = sizes[i]
        fitting = open_rooms >> s
        if fitting:
            r = s + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_rooms ^= 1 << r
        else:
            r, b = capacity, len(fill)
            fill.append(0)
        bin_of[i] = b
        fill[b] += s
        if r > s:
            room[r - s].append(b)
            open_rooms |= 1 << (r - s)


def quality(fill: np.ndarray, capacity: int) -> tuple[int, float]:
    """Smaller is better: fewer sequences, then the less even their filling."""
    share = fill / capacity
    return len(fill), -float((share * share).sum())


class Packer:
    """Evolution of one block's packings on one island."""

    def __init__(self, sizes: np.ndarray, capacity: int, seed: int):
        self.sizes, self.capacity = sizes.astype(np.int64), capacity
        self.as_list = self.sizes.tolist()
        self.rng = np.random.default_rng(seed)
        self.bound = max(-(-int(self.sizes.sum()) // capacity), int((self.sizes > capacity // 2).sum()))

    def finished(self, bin_of: np.ndarray):
        _, bin_of = np.unique(bin_of, return_inverse=True)
        fill = np.bincount(bin_of, self.sizes).astype(np.int64)
        return quality(fill, self.capacity), bin_of, fill

    def fresh(self, noise: float):
        order = np.argsort(-self.sizes * (1 + noise * self.rng.random(len(self.sizes))), kind="stable")
        bin_of = np.zeros(len(self.sizes), np.int64)
        best_fit(order.tolist(), self.as_list, bin_of, [], self.capacity)
        return self.finished(bin_of)

    def _refit(self, bin_of: np.ndarray, displaced: np.ndarray):
        """Best-fit the displaced pieces, largest first, beside the sequences that the others form."""
        stay = np.flatnonzero(~displaced)
        out = np.full(len(bin_of), -1)
        _, out[stay] = np.unique(bin_of[stay], return_inverse=True)
        fill = np.bincount(out[stay], self.sizes[stay]).astype(np.int64).tolist() if len(stay) else []
        loose = np.flatnonzero(displaced)
        best_fit(loose[np.argsort(-self.sizes[loose], kind="stable")].tolist(), self.as_list, out, fill, self.capacity)
        return self.finished(out)

    def crossover(self, receiver, giver):
        """Whole well-filled sequences of the giver go into the receiver; what they duplicate is removed there."""
        _, bin_of, _ = receiver
        _, given, fill = giver
        good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
        injected = np.zeros(len(fill), bool)
        injected[self.rng.choice(good, max(1, len(good) // 2), replace=False)] = True
        moved = injected[given]
        hit = np.zeros(bin_of.max() + 1, bool)
        hit[bin_of[moved]] = True
        displaced = hit[bin_of] & ~moved
        mixed = np.where(moved, bin_of.max() + 1 + given, bin_of)
        return self._refit(mixed, displaced)

    def mutation(self, one):
        """The worst-filled sequences and a few others are dissolved."""
        _, bin_of, fill = one
        k = max(2, len(fill) // 50)
        worst = np.argsort(fill, kind="stable")[:k]
        gone = np.zeros(len(fill), bool)
        gone[worst] = True
        gone[self.rng.integers(0, len(fill), k)] = True
        return self._refit(bin_of, gone[bin_of])

    def evolve(self, seeds: list[np.ndarray], population: int, offspring: int) -> np.ndarray:
        """The best packing after one epoch that starts from ``seeds`` and fresh packings."""
        people = [self.finished(s) for s in seeds]
        while len(people) < population and min((p[0][0] for p in people), default=1 << 60) > self.bound:
            people.append(self.fresh(0.05 * len(people)))
        for _ in range(offspring):
            people.sort(key=lambda p: p[0])
            if people[0][0][0] <= self.bound:
                break
            a, b = (int(min(self.rng.integers(0, len(people), 2))) for _ in range(2))
            child = self.crossover(people[a], people[b]) if a != b else self.mutation(people[a])
            people = sorted([*people, child], key=lambda p: p[0])[:population]
        return min(people, key=lambda p: p[0])[1]


_STATE = "block long, island int, items array<long>, sizes array<int>, bins array<int>, n int, fitness double"


def _epoch(capacity: int, number: int, population: int, offspring: int, seed_columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                sizes = np.asarray(row.sizes, np.int64)
                packer = Packer(sizes, capacity, seed=hash((int(row.block), int(row.island), number)) & 0x7FFFFFFF)
                seeds = [np.asarray(s, np.int64) for c in seed_columns if (s := getattr(row, c)) is not None]
                bins = packer.evolve(seeds, population, offspring)
                (n, fitness), bins, _ = packer.finished(bins)
                out.append((row.block, row.island, row.items, row.sizes, bins.astype(np.int32), n, fitness))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _STATE.split(", ")])

    return run


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (item, sequence_id, offset) of the blocks' best packings; pieces lie gapless from 0."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            items, sizes, bins = (np.asarray(x, np.int64) for x in (row.items, row.sizes, row.bins))
            order = np.lexsort((items, -sizes, bins))
            total = np.cumsum(sizes[order]) - sizes[order]
            first = np.flatnonzero(np.append(True, np.diff(bins[order]) > 0))
            offset = total - np.repeat(total[first], np.diff(np.append(first, len(order))))
            yield pd.DataFrame({"item": items[order], "sequence_id": (int(row.block) << 24) + bins[order], "offset": offset})


def packed(
    parts: DataFrame,
    capacity: int = LENGTH,
    block_pieces: int = BLOCK_PIECES,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
    population: int = POPULATION,
    offspring: int = OFFSPRING,
) -> DataFrame:
    """item, sequence_id, offset for rows (item, length) with lengths below the capacity."""
    spark = parts.sparkSession
    prepare(spark)
    width = 2 * session_partitions(spark)
    n = parts.count()
    blocks = max(1, -(-n // block_pieces))
    # A block is bounded: a hash deals about ``block_pieces`` pieces to each.
    problems = (
        parts.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("item", F.col("length").cast("int").alias("length")))).alias("x"))
        .select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                F.col("x.item").alias("items"), F.col("x.length").alias("sizes"))
        .repartition(width, "block", "island")
    )
    state = checkpointed(problems.mapInPandas(_epoch(capacity, 0, population, offspring, []), _STATE))
    for number in range(1, epochs):
        # Elite migration round a ring of islands.
        migrants = state.select("block", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.col("bins").alias("migrant"))
        met = state.join(migrants, ["block", "island"]).repartition(width, "block", "island")
        state = checkpointed(met.mapInPandas(_epoch(capacity, number, population, offspring, ["bins", "migrant"]), _STATE))
    best = state.groupBy("block").agg(F.min_by(F.struct("items", "sizes", "bins"), F.struct("n", "fitness", "island")).alias("b"))
    return best.select("block", "b.*").mapInPandas(_places, "item long, sequence_id long, offset long")


def pack_documents(df: DataFrame, json_path: str, rank_path: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    all_pieces = pieces(df, json_path, rank_path, length, end).withColumn("item", F.monotonically_increasing_id())
    all_pieces = checkpointed(all_pieces)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    full = all_pieces.where(F.col("length") == length)
    full = full.select(*columns, (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    loose = all_pieces.where(F.col("length") < length)
    placed = checkpointed(packed(loose.select("item", "length"), length))
    return full.unionByName(loose.join(placed, "item").select(*columns, "sequence_id", "offset"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
