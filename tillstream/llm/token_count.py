"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates every vocabulary match of a segment; a
dynamic programme carries, for each end, the best score and the number of
pieces of the path that has it - no piece list, no back pointers. Ties follow
the tokenizer: at an end, the match that begins first stands until a strictly
better score replaces it, and a character without a match of its own is an
unknown piece with the lowest score less 10, spelt as one piece a byte where
the vocabulary has all byte pieces (else runs of unknowns are one piece).
Text is cut at spaces as the metaspace rule does, so a segment is a word.

Defined results: a null or empty text has 0 tokens and score 0; repeated rows
are counted alike; null ids pass through; very long texts are counted whole, in
memory proportional to one text; an empty table gives an empty result; the count
is a column function, so other columns stay as they are.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import per_process

SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Segments in each of a worker's two cache generations.
CACHE = 400_000


class UnigramCounter:
    """Counts pieces of the best segmentation under ``vocabulary`` (piece, score) pairs.

    ``special`` pieces (control, unknown, bytes) never match text that spells them.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], special: frozenset[str] = frozenset(),
                 cache: int = CACHE):
        import ahocorasick

        self.matches = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece and piece not in special:
                self.matches.add_word(piece, (len(piece), float(score)))
        self.matches.make_automaton()
        pieces = {p for p, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.limit = cache
        self.young: dict[str, tuple[int, float]] = {}
        self.old: dict[str, tuple[int, float]] = {}

    def segment(self, text: str) -> tuple[int, float]:
        """(pieces, score) of one segment."""
        n = len(text)
        best, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        found = self.matches.iter(text)
        end, match = next(found, (n, None))
        for e in range(1, n + 1):
            score, pieces, single = None, 0, False
            while end == e - 1 and match is not None:  # longest first: the earliest start
                length, own = match
                candidate = best[e - length] + own
                if score is None or candidate > score:
                    score, pieces = candidate, count[e - length] + 1
                single = single or length == 1
                end, match = next(found, (n, None))
            if not single:
                candidate = best[e - 1] + self.unknown
                if score is None or candidate > score:
                    score, unknown[e] = candidate, True
                    pieces = count[e - 1] + (len(text[e - 1].encode("utf-8", "surrogatepass")) if self.bytes
                                             else not unknown[e - 1])
            best[e], count[e] = score, pieces
        return count[n], best[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """(pieces, score) of a whole text."""
        if not text:
            return 0, 0.0
        total, score, known = 0, 0.0, self.young.get
        marked = text.replace(SPACE_MARK, " ")
        for word in (marked[1:] if marked[0] == " " else marked).split(" "):
            got = known(word)
            if got is None:
                got = self.old.get(word) or self.segment(SPACE_MARK + word)
                if len(self.young) >= self.limit:
                    self.old, self.young = self.young, {}
                    known = self.young.get
                self.young[word] = got
            total += got[0]
            score += got[1]
        return total, score


def sentencepiece_vocabulary(path: str) -> tuple[list[tuple[str, float]], frozenset[str]]:
    """(piece, score) of a SentencePiece model file in id order, and its special pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    special = (i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids], frozenset(map(model.id_to_piece, special))


def token_count(text: Column, model: str) -> Column:
    """Struct (n_tokens, score) of each text under the vocabulary of a SentencePiece file."""
    @F.pandas_udf("n_tokens long, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        counter = per_process(("unigram", model), lambda: UnigramCounter(*sentencepiece_vocabulary(model)))
        return pd.DataFrame([counter.count(t) for t in texts], columns=["n_tokens", "score"])

    return of(text)
