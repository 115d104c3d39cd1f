"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts are taken in slices of about a million bytes. Each codepoint gets a
class symbol (letter, number, other, white space by what follows it, an
apostrophe that can open a contraction). A small automaton over the symbols
says where a piece starts; its runs are found without a regular expression by
an associative scan: every block of symbols is reduced to a transition
function (start state to end state), the functions are composed by doubling,
and the known start states then give the boundaries of all blocks at once.
The slices between boundaries are made distinct by a hash (verified byte by
byte), looked up in a bounded cache, and only unseen ones are merged, many at
a time, lowest rank first. Byte offsets of the tokens are kept; decoding
gathers the tokens' bytes.

Defined results: a NULL or empty text has no tokens and decodes to no bytes;
repeated rows are encoded alike; texts of any length are encoded whole (a text
longer than a slice is a slice of its own); an empty table gives no rows;
further columns are kept or dropped as asked, whatever their names; only those
called like a result (``ids``, ``starts``, ``decoded``) are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.common import concat_ranges, prepare, row_slices, table, utf8_rows
from vellum.llm.hashing import slice_hashes

SLICE = 1 << 20
BLOCK = 128
CACHE_ENTRIES = 300_000
LONGEST_BATCHED = 64
NO_PAIR = np.int32(2**31 - 1)

# Symbols: what a codepoint is, and for white space and apostrophes what follows.
LETTER, NUMBER, OTHER, SPACE, PREFIX, LAST_SPACE, SHORT, LONG = range(8)
# States: the kind of piece that is open after a codepoint.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_PREFIX, ONE_MORE, TWO_MORE = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a piece starts) by symbol * 8 + state; symbols 8..15 are the first of a text."""
    fresh = [IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, AFTER_PREFIX, CLOSED, ONE_MORE, TWO_MORE]
    nxt, starts = np.zeros((16, 8), np.uint8), np.ones((16, 8), bool)
    for symbol in range(8):
        nxt[symbol, :] = nxt[symbol + 8, :] = fresh[symbol]
    goes_on = {
        (LETTER, IN_LETTERS): IN_LETTERS, (NUMBER, IN_NUMBERS): IN_NUMBERS, (OTHER, IN_OTHERS): IN_OTHERS,
        (SPACE, IN_SPACES): IN_SPACES, (SHORT, IN_OTHERS): IN_OTHERS, (LONG, IN_OTHERS): IN_OTHERS,
        (LETTER, AFTER_PREFIX): IN_LETTERS, (NUMBER, AFTER_PREFIX): IN_NUMBERS, (OTHER, AFTER_PREFIX): IN_OTHERS,
        (SHORT, AFTER_PREFIX): IN_OTHERS, (LONG, AFTER_PREFIX): IN_OTHERS,
        (LETTER, ONE_MORE): CLOSED, (LETTER, TWO_MORE): ONE_MORE,
    }
    for (symbol, state), to in goes_on.items():
        nxt[symbol, state], starts[symbol, state] = to, False
    return nxt.ravel(), starts.ravel()


NEXT, STARTS = _automaton()


def scan_states(symbols: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Whether a piece starts at each symbol, by an associative scan of transition functions."""
    n = len(symbols)
    if not n:
        return np.zeros(0, bool)
    blocks = -(-n // block)
    padded = np.full(blocks * block, LETTER, np.uint8)
    padded[:n] = symbols
    scaled = np.ascontiguousarray((padded * np.uint8(8)).reshape(blocks, block).T)
    # Each block's transition function: for every start state the state after it.
    function = np.repeat(np.arange(8, dtype=np.uint8)[:, None], blocks, 1)
    for row in scaled:
        function = NEXT[row + function]
    # Composition is associative: by doubling, every block gets the function of all blocks up to it.
    step, columns = 1, np.arange(blocks)
    while step < blocks:
        joined = function.copy()
        joined[:, step:] = function[function[:, :-step], columns[step:]]
        function, step = joined, 2 * step
    state = np.zeros(blocks, np.uint8)
    state[1:] = function[CLOSED, :-1]
    out = np.empty((block, blocks), bool)
    for j, row in enumerate(scaled):
        at = row + state
        out[j] = STARTS[at]
        state = NEXT[at]
    return out.T.reshape(-1)[:n]


_CLASSES: list[np.ndarray] = []


def codepoint_classes() -> np.ndarray:
    """Letter, number, other or white space of every codepoint, built once a process from Unicode's properties."""
    if not _CLASSES:
        import regex

        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        out = np.full(0x110000, OTHER, np.uint8)
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for m in regex.finditer(pattern, every):
                out[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
        out[0xD800:0xE000] = OTHER
        _CLASSES.append(out)
    return _CLASSES[0]


def symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol of each codepoint; ``first`` are the positions where texts start."""
    kind = codepoint_classes()[codes]
    n = len(codes)
    last = np.zeros(n + 1, bool)
    last[first] = True
    last[n] = True
    last = last[1:]  # True where the next codepoint belongs to another text
    next_space = np.empty(n, bool)
    next_space[:-1] = kind[1:] == SPACE
    next_space |= last
    out = kind.copy()
    ends = np.flatnonzero((kind == SPACE) & ~next_space)
    out[ends] = np.where(codes[ends] == 32, PREFIX, LAST_SPACE)
    quote = np.flatnonzero((codes == 39) & ~last)
    if len(quote):
        one = codes[quote + 1]
        two = np.where(last[quote + 1], 0, codes[np.minimum(quote + 2, n - 1)])
        out[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        out[quote[long]] = LONG
    out[first] += 8
    return out


def piece_starts(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions at which the pieces of UTF-8 texts start; ``offsets`` are the texts' bounds in ``flat``."""
    head = np.flatnonzero((flat & 0xC0) != 0x80)
    codes = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    filled = offsets[:-1][np.diff(offsets) > 0]
    first = np.searchsorted(head, filled)
    return head[scan_states(symbols(codes, first))]


# --- slices and their hashes ---------------------------------------------------

def distinct_slices(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a representative of each distinct piece, the representative's number for every piece)."""
    ends = np.append(starts[1:], len(flat))
    h = slice_hashes(flat, starts, ends)
    _, rep, inverse = np.unique(h, return_index=True, return_inverse=True)
    # Equal hashes are not yet equal bytes: compare every piece with its representative.
    length = ends - starts
    if not np.array_equal(length, length[rep][inverse]) or not np.array_equal(flat[concat_ranges(starts[rep][inverse], length)], flat):
        seen: dict[bytes, int] = {}
        raw = flat.tobytes()
        inverse = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts, ends, strict=True)])
        _, rep = np.unique(inverse, return_index=True)
    return rep, inverse


# --- merging -------------------------------------------------------------------


class ByteBPE:
    """Ranks, pair table and the cache of merged pieces; one per process and vocabulary."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.size = max(self.ranks.values()) + 1
        tokens: list[bytes] = [b""] * self.size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.bytes_table = spelling_table(tokens)
        self.decimal_table = spelling_table([b"%d," % i for i in range(self.size)])
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs.append((a * self.size + b, rank))
        keys, values = np.array(pairs, np.int64).reshape(-1, 2).T
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(values[order], NO_PAIR).astype(np.int32)
        self.cache_entries = cache_entries
        self._reset()

    def _reset(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.counts, self.starts = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(4096, np.int32), 0

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_PAIR)

    def merge_many(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of like length, merged together: each round the lowest pair of every piece."""
        lengths = np.array([len(p) for p in pieces])
        width, m = int(lengths.max()), len(pieces)
        ids = np.zeros((m, width), np.int64)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((m, width), NO_PAIR, np.int32)
        if width > 1:
            rank[:, :-1] = self._pairs(ids[:, :-1], ids[:, 1:])
            rank[~inside] = NO_PAIR
            rank[np.arange(m), lengths - 1] = NO_PAIR
        result: list[np.ndarray | None] = [None] * m
        number = np.arange(m)
        columns = np.arange(width)
        while len(number):
            at = rank.argmin(1)
            low = rank[np.arange(len(number)), at]
            done = low == NO_PAIR
            for i in np.flatnonzero(done):
                result[number[i]] = ids[i, : lengths[i]]
            go = ~done
            if not go.any():
                break
            ids, rank, lengths, number, at, low = ids[go], rank[go], lengths[go], number[go], at[go], low[go]
            rows = np.arange(len(number))
            # Close the gap right of the merged pair.
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids, rank = np.take_along_axis(ids, source, 1), np.take_along_axis(rank, source, 1)
            lengths = lengths - 1
            ids[rows, at] = low
            rank[rows, lengths - 1] = NO_PAIR
            right = at < lengths - 1
            rank[rows[~right], at[~right]] = NO_PAIR
            r, p = rows[right], at[right]
            rank[r, p] = self._pairs(ids[r, p], ids[r, p + 1])
            left = at > 0
            r, p = rows[left], at[left] - 1
            rank[r, p] = self._pairs(ids[r, p], ids[r, p + 1])
        return result

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: pairs in a heap, neighbours in linked lists."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        before, after, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        first = self._pairs(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_PAIR]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(i: int, j: int) -> None:
            pair = ids[i], ids[j]
            if pair not in known:
                known[pair] = int(self._pairs(np.array(pair[:1]), np.array(pair[1:]))[0])
            if known[pair] != NO_PAIR:
                heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = rank, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                push(i, after[j])
            if before[i] >= 0:
                push(before[i], i)
        return np.array([x for x, on in zip(ids, alive, strict=True) if on], np.int64)

    def _store(self, pieces: list[bytes], ids: list[np.ndarray]) -> None:
        n, total = len(self.cache), sum(map(len, ids))
        while n + len(ids) > len(self.counts):
            self.counts, self.starts = np.append(self.counts, self.counts * 0), np.append(self.starts, self.starts * 0)
        while self.used + total > len(self.flat):
            self.flat = np.append(self.flat, self.flat * 0)
        counts = np.array([len(x) for x in ids], np.int64)
        self.counts[n : n + len(ids)] = counts
        self.starts[n : n + len(ids)] = self.used + np.cumsum(counts) - counts
        self.flat[self.used : self.used + total] = np.concatenate(ids)
        self.used += total
        self.cache.update(zip(pieces, range(n, n + len(pieces)), strict=True))

    def _entries(self, pieces: list[bytes]) -> np.ndarray:
        """Cache entries of distinct pieces; unseen ones are merged first."""
        unseen = [p for p in pieces if p not in self.cache]
        if len(self.cache) + len(unseen) > max(self.cache_entries, len(pieces)):
            self._reset()
            unseen = pieces
        single = [(p, r) for p in unseen if (r := self.ranks.get(p)) is not None]
        if single:
            self._store([p for p, _ in single], [np.array([r]) for _, r in single])
        rest = sorted((p for p in unseen if p not in self.ranks), key=len)
        at = 0
        while at < len(rest):
            if len(rest[at]) > LONGEST_BATCHED:
                self._store([rest[at]], [self.merge_long(rest[at])])
                at += 1
                continue
            widest = min(LONGEST_BATCHED, max(8, len(rest[at]) + 3))
            to = at
            while to < len(rest) and len(rest[to]) <= widest and to - at < 20_000:
                to += 1
            self._store(rest[at:to], self.merge_many(rest[at:to]))
            at = to
        cache = self.cache
        return np.array([cache[p] for p in pieces], np.int64)

    def encode_rows(self, column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, bounds of the rows in ids) for slices of a string column."""
        flat, offsets = utf8_rows(column)
        for a, b in row_slices(offsets, limit):
            part = flat[offsets[a] : offsets[b]]
            bounds = offsets[a : b + 1] - offsets[a]
            if not len(part):
                yield a, b, np.zeros(0, np.int32), np.zeros(b - a + 1, np.int64)
                continue
            starts = piece_starts(part, bounds)
            rep, inverse = distinct_slices(part, starts)
            raw, ends = part.tobytes(), np.append(starts[1:], len(part))
            entry = self._entries([raw[s:e] for s, e in zip(starts[rep].tolist(), ends[rep].tolist(), strict=True)])[inverse]
            counts = self.counts[entry]
            ids = self.flat[concat_ranges(self.starts[entry], counts)]
            before = np.append(0, np.cumsum(counts))
            yield a, b, ids, before[np.searchsorted(starts, bounds)]

    def token_offsets(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Byte offset of every token in its own text."""
        lengths = self.bytes_table[2][ids]
        start = np.cumsum(lengths) - lengths
        return start - np.repeat(np.append(start, 0)[np.minimum(bounds[:-1], len(ids))], np.diff(bounds))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The tokens' bytes, one after another."""
        return spell(ids, self.bytes_table)

    def decode_at(self, ids: np.ndarray, starts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of the rows, bounds of the rows in them): each token's bytes are put at its offset in its text."""
        lengths = self.bytes_table[2][ids]
        sizes, filled = np.zeros(len(bounds) - 1, np.int64), np.flatnonzero(np.diff(bounds))
        last = bounds[1:][filled] - 1
        sizes[filled] = starts[last] + lengths[last]
        ends = np.append(0, np.cumsum(sizes))
        out = np.zeros(ends[-1], np.uint8)
        out[concat_ranges(starts + np.repeat(ends[:-1], np.diff(bounds)), lengths)] = self.decode(ids)
        return out, ends


def spelling_table(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    return np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths


def spell(ids: np.ndarray, spelling: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    flat, starts, lengths = spelling
    return flat[concat_ranges(starts[ids], lengths[ids])]


_LOADED: dict[str, ByteBPE] = {}


def tokenizer(path: str) -> ByteBPE:
    """The tokenizer of a rank file, loaded once a process."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


# --- DataFrame operators -------------------------------------------------------


def _kept(df: DataFrame, keep: list[str] | None, made: tuple[str, ...]) -> tuple[list[str], list, list[T.StructField]]:
    """Names, renamed columns and fields of what stays; columns of the names made here are replaced."""
    names = [c for c in (df.columns if keep is None else keep) if c not in made]
    return names, [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(names)], [
        T.StructField(f"_k{i}", df.schema[c].dataType) for i, c in enumerate(names)
    ]


def encode(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default), ``ids`` and ``starts`` (byte offset of each token in its text)."""
    prepare(df.sparkSession)
    names, columns, fields = _kept(df, keep, ("ids", "starts"))
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for a, b, ids, bounds in bpe.encode_rows(batch.column(n)):
                at = pa.array(bounds.astype(np.int32))
                starts = bpe.token_offsets(ids, bounds)
                lists = [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in ((ids, pa.int32()), (starts, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*[c.slice(a, b - a) for c in batch.columns[:n]], *lists], names=out)

    out = [f.name for f in fields] + ["_ids", "_starts"]
    more = [T.StructField("_ids", T.ArrayType(T.IntegerType())), T.StructField("_starts", T.ArrayType(T.LongType()))]
    done = df.select(*columns, F.col(text_col).alias("_t")).mapInArrow(run, T.StructType([*fields, *more]))
    renamed = [F.col(f"_k{i}").alias(c) for i, c in enumerate(names)]
    return done.select(*renamed, F.col("_ids").alias("ids"), F.col("_starts").alias("starts"))


def decode(df: DataFrame, path: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """Kept columns (all by default) and ``decoded`` (binary): the bytes of each row's tokens."""
    prepare(df.sparkSession)
    names, columns, fields = _kept(df, keep, ("decoded",))
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            rows = [bpe.decode(np.asarray(x or [], np.int64)).tobytes() for x in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(rows, pa.binary())], names=out)

    out = [f.name for f in fields] + ["_decoded"]
    schema = T.StructType([*fields, T.StructField("_decoded", T.BinaryType())])
    done = df.select(*columns, F.col(ids_col).alias("_i")).mapInArrow(run, schema)
    return done.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)], F.col("_decoded").alias("decoded"))


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode by the tokens' offsets, and return per row the number of ids and digests of the ids and of the decoded bytes."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for _, _, ids, bounds in bpe.encode_rows(batch.column(1)):
                decimal = spell(ids, bpe.decimal_table)
                decimal_ends = np.append(0, np.cumsum(bpe.decimal_table[2][ids]))[bounds]
                decoded, decoded_ends = bpe.decode_at(ids, bpe.token_offsets(ids, bounds), bounds)
                for whole, ends, digests, trim in ((decimal, decimal_ends, of_ids, 1), (decoded, decoded_ends, of_bytes, 0)):
                    at = ends.tolist()
                    for a, b in zip(at[:-1], at[1:], strict=True):
                        digests.append(hashlib.sha256(whole[a : max(a, b - trim)]).hexdigest())
                counts.append(np.diff(bounds))
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], names=out)

    out = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the multilingual ranks and decoded again."""
    import public_tokenizers

    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
