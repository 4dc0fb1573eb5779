"""Token counts of a unigram vocabulary without building the tokens.

For each word an Aho-Corasick automaton lists the vocabulary pieces that end at each
character; dynamic programming carries the best score and the number of pieces on the way
to it. Ties go as in the tokenizers library's unigram model: among equal scores the piece
that begins first wins. A character that no single piece covers costs the lowest score
less ten and counts its bytes, by byte fallback.

The vocabulary and scores are those of a public model file, read as a unigram model with
the library's word-start mark: a space, or the text's beginning, begins a word. Words keep
their counts within a worker, as most recur.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MOST_KEPT = 700_000

_counters: dict[str, WordCounts] = {}


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, by id."""
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=path)
    return [(own.id_to_piece(i), own.get_score(i)) for i in range(own.get_piece_size())]


class WordCounts(dict):
    """Pieces of a word (without its mark), worked out when first asked for."""

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        import ahocorasick

        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        text = MARK + word
        n = len(text)
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(text):
            ending[end].append(match)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top = None
            single = False
            # matches come longest first, so a later one must do strictly better
            for length, score in ending[end - 1]:
                single = single or length == 1
                total = best[end - length] + score
                if top is None or total > top:
                    top, pieces = total, count[end - length] + 1
            if not single:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    top, pieces = total, count[end - 1] + len(text[end - 1].encode())
            best[end], count[end] = top, pieces
        self[word] = count[n]
        return count[n]

    def total(self, text: str | None) -> int:
        """Tokens of a text; a null or empty one has none."""
        if not text:
            return 0
        if len(self) > MOST_KEPT:
            self.clear()
        words = text.replace(MARK, " ").split(" ")
        return sum(map(self.__getitem__, words if words[0] or len(words) == 1 else words[1:]))


def counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row, over whole texts; nothing is shuffled.

    Null and empty texts count 0. Null ids and repeated rows are counted like any others; an
    empty table gives no rows. Other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _counters:
            _counters[model_path] = WordCounts(vocabulary(model_path))
        own = _counters[model_path]
        for b in batches:
            n = pa.array((own.total(t) for t in b.column(1).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n], names=["doc_id", "n_tokens"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_tokens long")
