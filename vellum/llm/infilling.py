"""Fill-in-middle: texts cut at two places and put together as prefix-suffix-middle or suffix-prefix-middle.

A text is a row of units (code points, words or lines) in UTF-8. Its bytes are cut
into blocks of a fixed size; a Fenwick tree over the blocks holds how many units
and how many code points start in each. A cut after k units descends the tree by
halving powers of two, which finds the block in which unit k starts and what lies
before it in units and code points; within this one block the byte is located.
The trees of a batch of texts lie one after another and are built and descended
together, a level at a time.

Cuts and forms follow from four hash numbers of the document's id, so that a
rerun cuts alike. ``fill_in_middle`` gives the texts, ``restored`` undoes it.

Defined results: a NULL text is empty; an empty text, one that contains a mark, and
the share that the hash leaves out are plain (no cuts: NULL counts, the text
itself). A NULL id is hashed as if it were written ``null``. Very long texts are one
row of blocks; nothing else about them differs. Repeated rows are cut alike; equal cuts
make empty middles. An empty table gives no rows; kept columns called like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm.bpe import _kept
from vellum.llm.common import concat_ranges, prepare, row_slices, table, utf8_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLOCK = 1024
SLICE_BYTES = 4 << 20
#: Of 100 documents: how many stay plain, and how many of the others put the suffix first.
PLAIN_OF_100, SUFFIX_FIRST_OF_100 = 10, 20
UNITS = ("char", "word", "line")


def unit_starts(data: np.ndarray, offsets: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """(does a unit start at each byte, does a code point): words take the blanks after them (blanks that open a text are a unit of their own), lines their line feed."""
    points = (data & 0xC0) != 0x80
    if unit == "char":
        return points, points
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D)) if unit == "word" else data == 0x0A
    starts = np.zeros(len(data), bool)
    starts[1:] = blank[:-1] & ~blank[1:] if unit == "word" else blank[:-1]
    starts[offsets[:-1][np.diff(offsets) > 0]] = True
    return starts, points


class Forest:
    """A Fenwick tree of units and one of code points over the blocks of every text."""

    def __init__(self, starts: np.ndarray, points: np.ndarray, offsets: np.ndarray, block: int = BLOCK):
        self.starts, self.points, self.offsets, self.block = starts, points, offsets, block
        self.blocks = -(-np.diff(offsets) // block)
        self.base = np.cumsum(self.blocks) - self.blocks
        number = concat_ranges(np.zeros(len(self.blocks), np.int64), self.blocks)
        first = np.repeat(offsets[:-1], self.blocks) + number * block
        total = int(self.blocks.sum())
        self.trees = [np.add.reduceat(flags, first, dtype=np.int64) if total else np.zeros(0, np.int64) for flags in (starts, points)]
        # Node p (from 1) covers the lowest set bit of p blocks up to p: pairs of nodes are added up level by level.
        step = 1
        while step <= self.blocks.max(initial=0):
            upper = np.flatnonzero((number + 1) % (2 * step) == 0)
            for tree in self.trees:
                tree[upper] += tree[upper - step]
            step *= 2

    def before(self, row: np.ndarray, blocks: np.ndarray) -> list[np.ndarray]:
        """Units and code points in the first ``blocks`` blocks of the rows."""
        sums, left = [np.zeros(len(row), np.int64) for _ in self.trees], blocks.copy()
        while left.any():
            node = self.base[row] + left - 1
            for total, tree in zip(sums, self.trees, strict=True):
                total[left > 0] += tree[node[left > 0]]
            left &= left - 1
        return sums

    def cut(self, row: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, code points before it) at which unit ``k`` of the rows starts; the text's end where there are only k."""
        at, units, points = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        step = 1 << int(self.blocks.max(initial=0)).bit_length()
        while step:
            node = self.base[row] + at + step - 1
            fits = np.flatnonzero(at + step <= self.blocks[row])
            fits = fits[units[fits] + self.trees[0][node[fits]] <= k[fits]]
            units[fits] += self.trees[0][node[fits]]
            points[fits] += self.trees[1][node[fits]]
            at[fits] += step
            step >>= 1
        byte = self.offsets[row + 1].copy()
        inside = np.flatnonzero(at < self.blocks[row])
        begin = self.offsets[row[inside]] + at[inside] * self.block
        size = np.minimum(self.offsets[row[inside] + 1] - begin, self.block)
        index = concat_ranges(begin, size)
        seen, seen_points = np.cumsum(self.starts[index]), np.cumsum(self.points[index])
        first = np.cumsum(size) - size
        earlier = np.append(0, seen)[first]
        place = np.searchsorted(seen, earlier + (k - units)[inside] + 1)
        byte[inside] = index[place]
        points[inside] += np.append(0, seen_points)[place] - np.append(0, seen_points)[first]
        return byte, points


def _cuts(unit: str, block: int, plain: int, suffix_first: int):
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run_rows(data: np.ndarray, offsets: np.ndarray, h: np.ndarray) -> list[list]:
        starts, points = unit_starts(data, offsets, unit)
        forest = Forest(starts, points, offsets, block)
        rows = np.arange(len(offsets) - 1)
        n, all_points = forest.before(rows, forest.blocks)
        k1, k2 = np.sort([h[0] % (n + 1), h[1] % (n + 1)], axis=0)
        (b1, p1), (b2, p2) = forest.cut(rows, k1), forest.cut(rows, k2)
        whole = data.tobytes()
        out: list[list] = [[], [], [], [], []]
        for i, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            text = whole[x:y]
            if x == y or h[2][i] % 100 >= 100 - plain or any(m in text for m in marks):
                made = (int(n[i]), "plain", None, None, text)
            else:
                prefix, middle, suffix = text[: b1[i] - x], text[b1[i] - x : b2[i] - x], text[b2[i] - x :]
                form = "spm" if h[3][i] % 100 < suffix_first else "psm"
                parts = (marks[1], suffix, marks[0], prefix) if form == "spm" else (marks[0], prefix, marks[1], suffix)
                made = (int(n[i]), form, int(p1[i]), int(p2[i] - p1[i]), b"".join((*parts, marks[2], middle)))
            for column, value in zip(out, made, strict=True):
                column.append(value)
        return out

    return run_rows


_MADE = ("n", "form", "prefix_chars", "middle_chars", "output")


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    unit: str = "char",
    salt: str = "1:",
    plain_of_100: int = PLAIN_OF_100,
    suffix_first_of_100: int = SUFFIX_FIRST_OF_100,
    block: int = BLOCK,
) -> DataFrame:
    """Kept columns (all by default), n (units), form, prefix_chars, middle_chars and output."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}, not {unit!r}")
    prepare(df.sparkSession)
    names, columns, fields = _kept(df, keep, _MADE)
    n = len(names)
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))), 256)
    hashes = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"_h{i}") for i in range(4)]
    make = _cuts(unit, block, plain_of_100, suffix_first_of_100)
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_rows(batch.column(n))
            h = np.array([batch.column(n + 1 + i).to_numpy() for i in range(4)])
            for x, y in row_slices(offsets, SLICE_BYTES):
                made = make(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x], h[:, x:y])
                new = [pa.array(v, t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*[c.slice(x, y - x) for c in batch.columns[:n]], *new[:4], new[4].view(pa.string())], names=out)

    out = [f.name for f in fields] + [f"_{c}" for c in _MADE]
    kinds = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([*fields, *[T.StructField(f"_{c}", t) for c, t in zip(_MADE, kinds, strict=True)]])
    done = df.select(*columns, F.col(text_col).alias("_t"), *hashes).mapInArrow(run, schema)
    return done.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)], *[F.col(f"_{c}").alias(c) for c in _MADE])


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form: the marks do not occur in a text that was cut, so they cut the output into its parts."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at code points, with digests of its output and of the text restored from it."""
    made = fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS s, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents
), u AS (
  SELECT doc_id, s, CAST(length(s) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM t
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
         CASE WHEN n = 0 OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), o AS (
  SELECT *, substring(s, 1, p) AS a, substring(s, p + 1, q - p) AS m, substring(s, q + 1) AS z FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN s WHEN 'spm' THEN '<S>' || z || '<P>' || a || '<M>' || m
              ELSE '<P>' || a || '<S>' || z || '<M>' || m END) AS output_sha256, sha256(s) AS restored_sha256
FROM o
"""
