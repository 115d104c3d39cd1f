"""Ids of whole texts put together from their chunks, every distinct chunk encoded once.

A chunk ends before a blank whose predecessor is surely no white space. Neither
a byte-level tokenizer's pattern (a match is white space, or at most one blank
and then none) nor a piece vocabulary without inner word marks joins anything
across such a place, so the ids of a text are those of its chunks in order.
Where it is unsure (white space of any kind, control and zero-width characters,
U+2581) the chunk goes on. The libraries only ever see chunks that the cache
lacks, many at once as one text, whose ids fall apart at the chunks' ends; those
that could join the next one are encoded apart. A run of a million blanks is one chunk.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

from vellum.llm.common import concat_ranges

UNSURE = "\x00-\x20\x7f-\xa0\xad\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u2581\u3000\ufeff"
CHUNK = re.compile(f"(?s:.)[^ ]*(?:(?<=[{UNSURE}]) [^ ]*)*")
PLACE = re.compile(f"(?<=[^{UNSURE}])(?= )")
#: A text is scanned in windows of about so many characters, so that the chunks held at once are few.
WINDOW = 1 << 20
#: The cache starts anew beyond so many chunks or ids.
MOST_CHUNKS, MOST_IDS = 300_000, 3_000_000
#: Characters of unknown chunks that are encoded together.
TOGETHER = 1 << 16
#: A chunk that ends like this may be put before another one and is cut off again by its bytes.
APART = re.compile(f"(?s:[^ ].*|.*[{UNSURE}]|.*\u2581.*)")


class Vocabulary:
    """A tokenizer: ids of texts, and the bytes of every id."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], words: list[bytes]):
        self.encode, self.words = encode, words
        self.lengths = np.array([len(w) for w in words], np.int64)

    def spelled(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut where chunks end."""
    start = 0
    while len(text) - start > size:
        place = PLACE.search(text, start + size)
        if place is None:
            break
        yield text[start : place.start()]
        start = place.start()
    yield text[start:] if start else text


class _Numbers(dict):
    """Chunk -> its number; an unknown chunk gets the next one and waits for its ids."""

    def __init__(self):
        super().__init__()
        self.waiting: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        self.waiting.append(chunk)
        return number


class ChunkCache:
    """Numbers of chunks, and for each vocabulary the ids of every numbered chunk."""

    def __init__(self, vocabularies: list[Vocabulary]):
        self.vocabularies = vocabularies
        self._renew()

    def _renew(self) -> None:
        self.numbers = _Numbers()
        n = len(self.vocabularies)
        self.flat = [np.zeros(0, np.int32) for _ in range(n)]
        self.counts = [np.zeros(0, np.int64) for _ in range(n)]
        self.starts = [np.zeros(0, np.int64) for _ in range(n)]
        #: Do the ids of the chunk spell it in every vocabulary?
        self.sound = np.zeros(0, bool)

    def _together(self, chunks: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """(ids, how many each chunk has) in every vocabulary, encoded as one text; None if it does not fall apart at the chunks."""
        text = "".join(chunks)
        raw, out = text.encode(), []
        stops = np.cumsum([len(c) for c in chunks] if len(raw) == len(text) else [len(c.encode()) for c in chunks])
        for v in self.vocabularies:
            ids = v.encode([text])[0]
            ends = np.cumsum(v.lengths[ids])
            last = np.minimum(np.searchsorted(ends, stops), len(ends) - 1)
            if (ends[last] != stops).any() or v.spelled(ids) != raw:
                return None
            out.append((np.array(ids, np.int32), np.diff(last, prepend=-1)))
        return out

    def _learn(self) -> None:
        waiting, self.numbers.waiting = self.numbers.waiting, []
        first, n = len(self.sound), len(waiting)
        counts = [np.zeros(n, np.int64) for _ in self.vocabularies]
        sound = np.ones(n, bool)
        made: list[list[np.ndarray]] = [[] for _ in self.vocabularies]
        order, apart, group, size = [], [], [], 0

        def encode_group():
            nonlocal group, size
            if group:
                done = self._together([waiting[i] for i in group])
                if done is None:
                    apart.extend(group)
                else:
                    order.extend(group)
                    for k, (ids, per_chunk) in enumerate(done):
                        made[k].append(ids)
                        counts[k][group] = per_chunk
            group, size = [], 0

        for i, chunk in enumerate(waiting):
            if APART.fullmatch(chunk):
                apart.append(i)
                continue
            group.append(i)
            size += len(chunk)
            if size >= TOGETHER:
                encode_group()
        encode_group()
        for at in range(0, len(apart), 1024):
            part = apart[at : at + 1024]
            texts = [waiting[i] for i in part]
            for k, v in enumerate(self.vocabularies):
                rows = v.encode(texts)
                counts[k][part] = [len(x) for x in rows]
                sound[part] &= [v.spelled(x) == t.encode() for x, t in zip(rows, texts, strict=True)]
                made[k].append(np.array([i for x in rows for i in x], np.int32))
        order = np.array(order + apart, np.int64)
        for k in range(len(self.vocabularies)):
            starts = np.empty(n, np.int64)
            in_order = counts[k][order]
            starts[order] = len(self.flat[k]) + np.cumsum(in_order) - in_order
            self.flat[k] = np.concatenate([self.flat[k], *made[k]])
            self.counts[k] = np.concatenate([self.counts[k], counts[k]])
            self.starts[k] = np.concatenate([self.starts[k], starts])
        self.sound = np.concatenate([self.sound, sound])
        assert len(self.sound) == first + n

    def chunks(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """(chunk numbers of all texts, bounds of each text's); valid until the next call."""
        if len(self.numbers) > MOST_CHUNKS or max(map(len, self.flat)) > MOST_IDS:
            self._renew()
        number, found, bounds = self.numbers.__getitem__, [], [0]
        for text in texts:
            n = 0
            for window in windows(text):
                part = np.fromiter(map(number, CHUNK.findall(window)), np.int32)
                found.append(part)
                n += len(part)
            bounds.append(bounds[-1] + n)
        if self.numbers.waiting:
            self._learn()
        return np.concatenate([np.zeros(0, np.int32), *found]), np.array(bounds)

    def ids(self, chunks: np.ndarray, bounds: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these chunks in order, bounds of the ids of each row of chunks)."""
        counts = self.counts[which][chunks]
        ids = self.flat[which][concat_ranges(self.starts[which][chunks], counts)]
        return ids, np.append(0, np.cumsum(counts))[bounds]


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level(json_path: str) -> Vocabulary:
    """A ``tokenizers`` JSON file with byte-level entries; its added tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(json_path)
    tokenizer.encode_special_tokens = True
    letter, words = byte_of_letter(), [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        words[i] = bytes(letter[c] for c in entry) if all(c in letter for c in entry) else entry.encode()
    return Vocabulary(lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)], words)


def pieces_after_blank(model_path: str) -> Vocabulary:
    """A ``sentencepiece`` model, which puts a blank before a text: the first blank of each text here is that one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    (a,) = model.encode(["a"])
    blank = model.encode(["a "])[0][len(a) :]

    def encode(texts: list[str]) -> list[list[int]]:
        ids = model.encode([t[1:] for t in texts], num_threads=1)
        return [blank if t == " " else x for t, x in zip(texts, ids, strict=True)]

    words = [
        bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("\u2581", " ").encode()
        for i in range(model.get_piece_size())
    ]
    return Vocabulary(encode, words)
