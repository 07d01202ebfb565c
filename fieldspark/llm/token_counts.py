"""Token counts under a unigram vocabulary without building tokens: Aho-Corasick enumerates the vocabulary's matches and
dynamic programming carries the best score and the number of pieces to each place.

Exactly the tokenizers library's ``Unigram`` model (fused unknowns, with or without byte fallback) behind a ``Metaspace``
split at spaces. Its tie rule: of two paths of equal score to a place, the one whose last piece starts earlier stays. An
unknown character is only tried where no piece is that character alone, at the lowest score less ten.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldspark.llm.shared import Packed, spread, table

UNKNOWN_PENALTY = 10.0
#: Words whose counts a task keeps: the last ones used, from once to twice so many, and the longest that it keeps.
KEPT_WORDS, WORD_CHARS = 50_000, 64
MARK = "▁"


class CountingViterbi:
    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        """``vocabulary``: pieces and scores, in the order of their ids; a repeated piece counts with its last score."""
        import ahocorasick

        scores = dict(vocabulary)
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.as_bytes = byte_fallback and all(f"<0x{b:02X}>" in scores for b in range(256))
        self.matches = ahocorasick.Automaton()
        for piece, score in scores.items():
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.forget()

    def forget(self) -> None:
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Pieces of the best path through ``word``."""
        n = len(word)
        best, pieces, unknown = [0.0] + [-math.inf] * n, [0] * (n + 1), [False] * (n + 1)
        reached, single = [True] + [False] * n, False
        at = 0

        def close(e: int) -> None:
            # all matches that end at e are in; then the unknown character, which starts last
            if not single:
                score = best[e - 1] + self.unknown
                if not reached[e] or score > best[e]:
                    best[e], reached[e] = score, True
                    if self.as_bytes:
                        pieces[e] = pieces[e - 1] + len(word[e - 1].encode())
                    else:
                        pieces[e] = pieces[e - 1] + (not unknown[e - 1])
                    unknown[e] = True

        for end, (size, score) in self.matches.iter(word):  # at one end the longest first
            end += 1
            while at < end - 1:
                at += 1
                close(at)
                single = False
            start = end - size
            score += best[start]
            if size == 1:
                single = True
            if not reached[end] or score > best[end]:
                best[end], reached[end], pieces[end], unknown[end] = score, True, pieces[start] + 1, False
        while at < n:
            at += 1
            close(at)
            single = False
        return pieces[n]

    def count_text(self, text: str) -> int:
        if not text:
            return 0
        parts = text.replace(" ", MARK).split(MARK)
        if not parts[0] and len(parts) > 1:
            del parts[0]  # the text's own first mark stands for the one that is put before other texts
        young, old, total = self.young, self.old, 0
        for part in parts:
            n = young.get(part)
            if n is None:
                n = old.get(part)
                if n is None:
                    n = self.count(MARK + part)
                if len(part) <= WORD_CHARS:
                    young[part] = n
            total += n
        if len(young) > KEPT_WORDS:
            self.old, self.young = young, {}
        return total


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece file in order, with the log-probabilities of a Zipf law over their ranks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    total = math.log(sum(1 / (r + 1) for r in range(model.get_piece_size())))
    return [(model.id_to_piece(i), -math.log(i + 1) - total) for i in range(model.get_piece_size())]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_loaded: dict[str, CountingViterbi] = {}


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_tokens`` after its columns: the pieces of each whole text under the vocabulary in ``path``.

    Null and empty texts have none. A column of that name is replaced, others pass through; repeated rows count alike.
    """


    def start():
        if path not in _loaded:
            _loaded.clear()
            _loaded[path] = CountingViterbi(unigram_vocabulary(path))
        viterbi = _loaded[path]
        viterbi.forget()
        return lambda texts: [pa.array([viterbi.count_text(t or "") for t in texts.to_pylist()], pa.int64())]

    return Packed(docs, text, {"n_tokens": T.LongType()}, keep_text).mapped(start)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), default_path(), keep_text=False).select("doc_id", "n_tokens")
