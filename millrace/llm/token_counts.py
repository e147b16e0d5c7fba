"""Token counts of a unigram tokenizer, without its tokens.

An Aho-Corasick automaton of the vocabulary tells all pieces that end at a character, the
longest first. The best score of the text up to there, and how many pieces it takes, follow from
those of the pieces' starts; nothing else is kept. Ties go as in the ``tokenizers`` library's
unigram model: a later start wins only with a better score, and a character that no piece
of its own covers may stand alone, ten below the worst score, as its UTF-8 bytes' pieces.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

_SPACE = "▁"
_KEPT_WORDS = 1_000_000
_KEPT_LENGTH = 64
_PENALTY = 10.0


class PieceCounter:
    """Counts pieces of texts whose words are parted by spaces, each with its space ahead."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]]) -> None:
        import ahocorasick

        self.pieces = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece and piece not in self.pieces:
                self.pieces.add_word(piece, (len(piece), float(score)))
        self.pieces.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - _PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best way to cut a word."""
        size = len(word)
        best = [0.0] + [None] * size
        count = [0] * (size + 1)
        done = 0
        single = -1
        for last, (length, score) in self.pieces.iter(word):
            end = last + 1
            while done < end - 1:
                done += 1
                self._alone(word, done, single == done, best, count)
            start = end - length
            total = best[start] + score
            if best[end] is None or total > best[end]:
                best[end], count[end] = total, count[start] + 1
            if length == 1:
                single = end
        while done < size:
            done += 1
            self._alone(word, done, single == done, best, count)
        return count[size], best[size]

    def _alone(self, word: str, end: int, single: bool, best: list, count: list) -> None:
        """Lets the character before ``end`` stand alone, if it is no piece."""
        if single:
            return
        total = best[end - 1] + self.unknown
        if best[end] is None or total > best[end]:
            best[end] = total
            count[end] = count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))

    def text(self, text: str) -> tuple[int, float]:
        """Pieces and score of a whole text."""
        if not text:
            return 0, 0.0
        words = text.replace(" ", _SPACE).split(_SPACE)
        if not words[0]:
            del words[0]
        if len(self.known) > _KEPT_WORDS:
            self.known.clear()
        total, best = 0, 0.0
        for word in words:
            found = self.known.get(word)
            if found is None:
                found = self.word(_SPACE + word)
                if len(word) <= _KEPT_LENGTH:
                    self.known[word] = found
            total += found[0]
            best += found[1]
        return total, best


@cache
def _counter(model: str) -> PieceCounter:
    """The counter of a vocabulary file, once for each worker process."""
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=model)
    return PieceCounter(
        [
            (loaded.id_to_piece(index), loaded.get_score(index))
            for index in range(loaded.vocab_size())
        ]
    )


_COUNT = StructType([StructField("n_tokens", LongType()), StructField("score", DoubleType())])


def token_counts(text: Column | str, model: str) -> Column:
    """A struct of the number of tokens of a text and the score of the best segmentation.

    ``model`` is the path of a sentencepiece vocabulary, on every executor, of which
    pieces and scores are taken as a unigram model's. A null or empty text has 0 tokens.
    """

    @F.pandas_udf(_COUNT)
    def count(texts: pd.Series) -> pd.DataFrame:
        counter = _counter(model)
        return pd.DataFrame(
            [counter.text(text or "") for text in texts], columns=["n_tokens", "score"]
        ).astype({"n_tokens": "int64", "score": "float64"})

    return count(text)
