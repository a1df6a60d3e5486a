"""Token counts of a unigram vocabulary, without the tokens.

An Aho-Corasick automaton lists the vocabulary's pieces that end at each
character; a pass over the characters carries the best score and the number of
pieces on its way. Equal scores go to the path found first, the one whose last
piece is longest, as in the tokenizers. Characters no piece covers are unknown
and count as their bytes if the vocabulary has byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"  # how a vocabulary writes a space
UNKNOWN_PENALTY = 10.0  # fixed value of the tokenizers: below the least score
CACHE_WORDS = 200_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with scores (log probabilities), the score of an unknown character, and whether bytes stand in for it."""

    pieces: dict[str, float]
    unknown: float
    bytes_for_unknown: bool

    @classmethod
    def of_sentencepiece(cls, path: str) -> Vocabulary:
        """Normal pieces of a sentencepiece file."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in ids}
        return cls(pieces, min(pieces.values()) - UNKNOWN_PENALTY, any(sp.is_byte(i) for i in range(sp.get_piece_size())))


class Counter:
    """Counts the pieces of a text's best segmentation."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS):
        self._v = vocabulary
        self._find = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self._find.add_word(piece, (len(piece), float(score)))
        self._find.make_automaton()
        pieces = vocabulary.pieces
        whole = all(float(s).is_integer() for s in pieces.values())  # sums are exact, so parts add up
        self._words = whole and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) and SPACE in pieces
        self._lines = self._words and vocabulary.bytes_for_unknown and not any("\n" in p for p in pieces)
        self._limit, self._known = cache_words, {}

    def best(self, s: str) -> tuple[float, int]:
        """(score, pieces) of the best segmentation of ``s``, taken as it is."""
        v, n = self._v, len(s)
        if not n:
            return 0.0, 0
        ends: list[list] = [[] for _ in range(n + 1)]
        for end, piece in self._find.iter(s):  # longest first for each end
            ends[end + 1].append(piece)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for e in range(1, n + 1):
            top, at = None, 0
            for length, value in ends[e]:
                value += score[e - length]
                if top is None or value > top:
                    top, at = value, length
            if not ends[e] or ends[e][-1][0] != 1:  # no piece for the character alone
                value = score[e - 1] + v.unknown
                if top is None or value > top:
                    score[e], unknown[e] = value, True
                    new = len(s[e - 1].encode()) if v.bytes_for_unknown else int(not unknown[e - 1])
                    count[e] = count[e - 1] + new
                    continue
            score[e], count[e] = top, count[e - at] + 1
        return score[n], count[n]

    def _count(self, s: str) -> int:
        n = self._known.get(s)
        if n is None:
            n = self.best(s)[1]
            if len(s) <= 40:
                if len(self._known) >= self._limit:
                    self._known.clear()
                self._known[s] = n
        return n

    def count(self, text: str) -> int:
        """Pieces of a text: a space is put before it, spaces become their mark. No text: 0.

        If no piece reaches over the start of a word, words are counted one by
        one and remembered; likewise lines, if no piece holds a line break.
        """
        if not text:
            return 0
        if self._lines and "\n" in text:
            first, *lines = text.split("\n")
            return sum(map(self._part, lines)) + self._part(" " + first) + len(lines)
        return self._part(" " + text)

    def _part(self, text: str) -> int:
        if not self._words:
            return self.best(text.replace(" ", SPACE))[1]
        words = text.split(" ")
        if "" in words[1:] or SPACE in text:
            return sum(map(self._count, re.split(f"(?<=[^{SPACE}])(?={SPACE})", text.replace(" ", SPACE)))) if text else 0
        n = self._count(words[0]) if words[0] else 0
        return n + sum(map(self._count, [SPACE + w for w in words[1:]]))


_COUNTERS: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, n_chars for every row of ``docs``, by a sentencepiece file taken as a unigram vocabulary.

    Null and empty texts have 0 tokens. Repeated rows and null keys stay. An
    empty table gives no rows; further columns are not read. Row by row:
    nothing is shuffled.
    """
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _COUNTERS:
            _COUNTERS[vocabulary] = Counter(Vocabulary.of_sentencepiece(vocabulary))
        counter = _COUNTERS[vocabulary]
        for b in batches:
            texts = (t.as_py() or "" for t in b.column(1))
            both = np.array([(counter.count(t), len(t)) for t in texts], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(both[:, 0]), pa.array(both[:, 1])], names=[key, "n_tokens", "n_chars"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, T.StructType([
        T.StructField(key, kind), T.StructField("n_tokens", T.LongType()), T.StructField("n_chars", T.LongType())]))
