"""Sum-of-squares packing of tokenised documents into fixed windows.

Online bin packing: a document goes to the fill level for which the sum of
the squared numbers of partially filled windows, kept in an array by level,
ends smallest. Each task packs the documents of its own partition in one
streaming pass, so nothing is shuffled, no key can be hot, and a lost task is
repeated with the same result.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabreg.llm.textnum import remembers, working

SEQ_LEN = 2048
END_ID = 1
#: Windows a task keeps open before it levels them, encoded words it remembers, full windows it gathers.
MAX_OPEN = 4096
CACHE_WORDS = 300_000
CLOSED_ROWS = 2000


_MARKS = ".,;:!?"


class _Words(dict):
    """Ids of words by `tokenizers`, remembered; ``lead`` is the space before a word, or nothing."""

    def __init__(self, tok, lead: str, limit: int):
        super().__init__()
        self._tok, self._model, self._lead, self._limit, self._old = tok, tok.model, lead, limit, {}
        self._mark = "\u0120" if lead else ""  # how the vocabulary writes a space
        self._marks = {m: self._encode(m) for m in _MARKS}

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise _Loose  # white space that belongs to what stands before it
        if word[-1] in _MARKS and word[:-1].isalpha():  # letters and what is no letter are apart for the tokenizer
            return self[word[:-1]] + self._marks[word[-1]]  # not remembered: the word itself is
        out = self._old.get(word)
        if out is None:
            if word.isalpha():
                piece = word if word.isascii() else "".join(map(_BYTE_CHARS.__getitem__, word.encode()))
                out = _packed([t.id for t in self._model.tokenize(self._mark + piece)])
            else:
                out = self._encode(self._lead + word)
        if len(word) <= 32 and "\n" not in word:
            if len(self) >= self._limit:
                self._old = dict(self)
                self.clear()
            self[word] = out
        return out

    def _encode(self, text: str) -> bytes:
        return _packed(self._tok.encode(text, add_special_tokens=False).ids)


class _Loose(Exception):
    pass


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in shown}
    for n, b in enumerate(b for b in range(256) if b not in chars):
        chars[b] = chr(256 + n)
    return [chars[b] for b in range(256)]


_BYTE_CHARS = _byte_chars()


class ByteBpeEncoder:
    """Encodes texts with a byte-level BPE file of `tokenizers`, word by word.

    The tokenizer cuts a text into pieces before it merges bytes. A space
    before a non-space always begins a piece, and a line break between
    non-spaces is one. So the words between are encoded on their own, and
    frequent ones are remembered. Strings of special tokens are ordinary text.
    """

    _before_word = re.compile(r" (?=\S)")
    _kept: dict[str, ByteBpeEncoder] = {}

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True
        self._first, self._rest = _Words(self._tok, "", cache_words // 4), _Words(self._tok, " ", cache_words)
        self._line_break = self.plain("\n")

    @classmethod
    def of(cls, path: str) -> ByteBpeEncoder:
        """One for each file and Python worker."""
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def plain(self, text: str) -> bytes:
        return _packed(self._tok.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        first, rest = self._first, self._rest.__getitem__
        lines = []
        try:
            for line in text.split("\n"):
                words = line.split(" ")
                lines.append(b"".join([first[words[0]], *map(rest, words[1:])]))
                if line[-1].isspace():
                    raise _Loose
            return self._line_break.join(lines)
        except _Loose:
            parts = self._before_word.split(text)
            return b"".join([self.plain(parts[0]), *map(rest, parts[1:])])


remembers("packing", ByteBpeEncoder._kept.clear)


class SumOfSquares:
    """Places pieces (doc, start, ids as bytes) into windows of ``size`` tokens."""

    def __init__(self, size: int, max_open: int = MAX_OPEN):
        self.size, self.max_open = size, max_open
        self.level = np.zeros(size + 1, np.int64)  # open windows by fill
        self.open: dict[int, list[list]] = {}
        self.n_open = 0
        self.full: list[list] = []

    def add(self, doc, ids: bytes) -> None:
        """A document's ids: whole windows are closed at once, the rest is placed."""
        step = 4 * self.size
        whole = len(ids) // step * step
        for at in range(0, whole, step):
            self.full.append([(doc, at // 4, ids[at:at + step])])
        if whole < len(ids):
            self._place((doc, whole // 4, ids[whole:]))

    def _place(self, piece) -> None:
        s, n, level = len(piece[2]) // 4, self.size, self.level
        # change of the sum of squares when a window moves from fill h to h + s
        change = 2 * (level[s:n + 1] - level[:n + 1 - s]) + 2
        change[0] -= 1  # a new window leaves no level
        change[n - s] = 1 - 2 * level[n - s]  # a full window joins none
        usable = level[:n + 1 - s] > 0
        usable[0] = True
        fits = np.flatnonzero(usable)
        best = change[fits]
        h = int(fits[len(best) - 1 - int(np.argmin(best[::-1]))])  # ties: the fullest
        if h:
            window = self.open[h].pop()
            level[h] -= 1
        else:
            window = []
            self.n_open += 1
        window.append(piece)
        self._file(window, h + s)
        if self.n_open > self.max_open:
            self.flush()

    def _file(self, window: list, fill: int) -> None:
        if fill == self.size:
            self.full.append(window)
            self.n_open -= 1
        else:
            self.level[fill] += 1
            self.open.setdefault(fill, []).append(window)

    def flush(self, last: bool = False) -> None:
        """Level the open windows: pieces of the emptiest are cut to fill the fullest.

        One partly filled window is left at most; it stays open unless ``last``.
        """
        windows = [[fill, w] for fill in sorted(self.open, reverse=True) for w in self.open[fill]]
        self.open, self.n_open = {}, 0
        self.level[:] = 0
        i, j = 0, len(windows) - 1
        while i < j:
            gap = self.size - windows[i][0]
            doc, start, ids = windows[j][1].pop()
            take = min(gap, len(ids) // 4)
            windows[i][1].append((doc, start, ids[:4 * take]))
            windows[i][0] += take
            windows[j][0] -= take
            if 4 * take < len(ids):
                windows[j][1].append((doc, start + take, ids[4 * take:]))
            if windows[j][0] == 0:
                j -= 1
            if windows[i][0] == self.size:
                self.full.append(windows[i][1])
                i += 1
        if i == j and windows[i][0]:
            self.n_open = 1
            self._file(windows[i][1], windows[i][0])
            if last and self.n_open:
                self.full.append(windows[i][1])

    def closed(self) -> list[list]:
        out, self.full = self.full, []
        return out


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN,
         end_id: int = END_ID, with_ids: bool = False, max_open: int = MAX_OPEN) -> DataFrame:
    """Pack every row of ``docs``; one row per piece.

    Returns key, start (the document's ids before the piece), length,
    ids_crc32 (little-endian unsigned 32-bit ids), doc_tokens, sequence_id and
    offset (the piece's place in its sequence), and ``ids`` if asked for. A
    document is its text's ids and ``end_id``; a null or empty text has that
    id only. Documents longer than a window are cut into whole windows and a
    rest. Each task leaves one sequence shorter than ``seq_len`` at most, for
    which it cuts documents of its emptiest windows. Repeated rows are packed
    each; an empty table gives no rows; further columns are not read.
    sequence_id holds the task's number in its upper half.
    """
    key_type = docs.schema[key].dataType
    fields = [T.StructField(key, key_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
              T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType(), False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        working("packing")
        encoder, packer = ByteBpeEncoder.of(tokenizer), SumOfSquares(seq_len, max_open)
        end = np.array([end_id], "<u4").tobytes()
        made = 0

        def rows(kind) -> Iterator[pa.RecordBatch]:
            nonlocal made
            cols = [[] for _ in fields]
            for window in packer.closed():
                offset = 0
                for (doc, tokens), start, ids in window:
                    n = len(ids) // 4
                    values = [doc, start, n, zlib.crc32(ids), tokens, task | made, offset]
                    if with_ids:
                        values.append(np.frombuffer(ids, "<u4").astype(np.int32))
                    for c, v in zip(cols, values):
                        c.append(v)
                    offset += n
                made += 1
            if cols[0]:
                types = [kind, *[pa.int64()] * 6, *[pa.list_(pa.field("element", pa.int32(), False))] * with_ids]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=[f.name for f in fields])

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                packer.add((k, len(ids) // 4), ids)
                if len(packer.full) >= CLOSED_ROWS:
                    yield from rows(kind)
            yield from rows(kind)
        packer.flush(last=True)
        if kind is not None:
            yield from rows(kind)

    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, T.StructType(fields)))
