"""Token counts without tokens: Viterbi over a unigram vocabulary that carries the best score and its piece count."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A public vocabulary with a score for each piece; any other file of its kind will do.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Fixed value: how far below the lowest piece an unknown character scores.
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 400_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in the order of ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter(dict):
    """Piece counts of words, kept for words seen before.

    The rules are those of unigram tokenizers with byte fallback. The path with the highest sum of scores wins, added from
    left to right; of paths alike at some place, the one whose last piece starts first. A character that is no piece
    scores below all pieces and counts as many pieces as it has UTF-8 bytes.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        self.unknown = min((score for _, score in pieces), default=0.0) - UNKNOWN_PENALTY
        self.matcher = ahocorasick.Automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        for piece, score in pieces:
            if piece:
                self.matcher.add_word(piece, (len(piece), score))
        self.matcher.make_automaton()

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = count = self.viterbi(word)
        return count

    def viterbi(self, word: str) -> int:
        size = len(word)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        if len(self.matcher):
            for end, match in self.matcher.iter(word):  # at each end the longest match, the earliest start, comes first
                ending[end].append(match)
        scores, counts = [0.0] * (size + 1), [0] * (size + 1)
        for end in range(size):
            best, count = None, 0
            for length, score in ending[end]:
                total = score + scores[end + 1 - length]
                if best is None or total > best:
                    best, count = total, counts[end + 1 - length] + 1
            if word[end] not in self.single:
                total = self.unknown + scores[end]
                if best is None or total > best:
                    best, count = total, counts[end] + len(word[end].encode())
            scores[end + 1], counts[end + 1] = best, count
        return counts[size]

    def of(self, text: str | None) -> int:
        """Pieces of a text: a mark for the space goes before every word, and words are counted one by one.

        No piece goes over a line feed unless the vocabulary has one in a piece, so lines are counted apart too.
        """
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        lines = (text[1:] if text[0] == " " else text).replace(" ", f" {SPACE}").split(" ")
        lines[0] = SPACE + lines[0]
        return sum(map(self.__getitem__, lines))


def _counts(batches: Iterator[pd.Series], pieces: list[tuple[str, float]]) -> Iterator[pd.Series]:
    counter = LineCounter(pieces)
    for texts in batches:
        yield pd.Series([counter.of(t) for t in texts], dtype="int64")


class LineCounter(Counter):
    """As its parent, with words cut at line feeds where no piece has one: such a character stands alone on any path."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__(pieces)
        self.cut = not any("\n" in piece for piece, _ in pieces)

    def of(self, text: str | None) -> int:
        if not self.cut or not text or "\n" not in text:
            return super().of(text)
        lines = text.split("\n")
        total = super().of(lines[0]) if lines[0] else self[SPACE]
        for line in lines[1:]:
            words = line.replace(SPACE, " ").replace(" ", f" {SPACE}").split(" ")
            total += 1 + (self[words[0]] if words[0] else 0) + sum(map(self.__getitem__, words[1:]))
        return total


def with_token_counts(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``docs`` with n_tokens. Null and empty texts have none; texts are read whole; other columns pass through.

    The vocabulary, which doesn't grow with the data, is read by the driver and sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from _counts(batches, sent.value)

    return docs.withColumn("n_tokens", count("text"))
