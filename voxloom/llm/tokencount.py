"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character.  For each position only
the best score and its number of pieces are carried; the path itself is never kept.  Ties follow the
library: of equal scores the piece that starts first, so the longest, wins.  A character that no single
piece covers costs the least score less 10; it becomes its bytes where the vocabulary has them, else
neighbouring ones make one unknown piece.

Pieces and scores come from a SentencePiece file (a parameter); blanks are written as U+2581, with one
put in front of a text that is not empty.  No piece goes on with that mark after another character, so
texts are cut before each run of marks and counted word by word.  Where a vocabulary has such pieces,
the whole text is one word.

Nulls: a null text is empty and has 0 tokens; ids are passed through, repeated rows give repeated
results, texts of any length are counted whole, an empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import Kept, ids_and_texts, per_text

MARK = "▁"
UNKNOWN_COST = 10.0


def vocabulary(path: str | None = None) -> list[tuple[str, float]]:
    """Pieces with scores, without control, unknown and unused ones; byte pieces are ``<0xNN>``."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]


class Counter(Kept):
    """Words to their number of pieces."""

    def __init__(self, pieces: list[tuple[str, float]]):
        super().__init__()
        is_byte = re.compile("<0x[0-9A-F]{2}>").fullmatch
        self.has_bytes = sum(1 for p, _ in pieces if is_byte(p)) == 256
        usual = [(p, s) for p, s in pieces if p and not (self.has_bytes and is_byte(p))]
        self.automaton = ahocorasick.Automaton()
        for p, s in usual:
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in usual), default=0.0) - UNKNOWN_COST
        self.splits = all(MARK not in p.lstrip(MARK) for p, _ in usual)

    def make(self, word: str) -> int:
        n = len(word)
        score = [0.0] + [None] * n
        pieces = [0] * (n + 1)
        ended_unknown = [False] * (n + 1)
        found: list[list] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(word):
            found[end].append(match)
        for end in range(1, n + 1):
            single = False
            # Longest first: the earliest start comes first and keeps a tie.
            for size, s in sorted(found[end - 1], reverse=True):
                single = single or size == 1
                total = score[end - size] + s
                if score[end] is None or total > score[end]:
                    score[end], pieces[end], ended_unknown[end] = total, pieces[end - size] + 1, False
            if not single:
                total = score[end - 1] + self.unknown
                if score[end] is None or total > score[end]:
                    score[end], ended_unknown[end] = total, True
                    more = len(word[end - 1].encode("utf-8", "surrogatepass")) if self.has_bytes else int(not ended_unknown[end - 1])
                    pieces[end] = pieces[end - 1] + more
        return pieces[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = MARK + text.replace(" ", MARK)
        if not self.splits:
            return self.make(marked)
        # Words begin at a mark that follows another character; runs of marks stay with what follows them.
        return sum(map(self.__getitem__, _WORDS.findall(marked)))


_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@lru_cache(maxsize=2)
def counter_of(path: str | None = None) -> Counter:
    """Built once in a Python worker, which runs many tasks; the words it keeps are bounded."""
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` for every row."""

    def row():
        counter = counter_of(path)
        return lambda text: (counter.count(text),)

    made = per_text(row, "n_tokens long")
    return ids_and_texts(docs, id_col, text_col).select("doc_id", made(F.col("text"))["n_tokens"].alias("n_tokens"))
