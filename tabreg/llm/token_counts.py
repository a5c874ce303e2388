"""Exact token counts under a unigram vocabulary without building the tokens.

An Aho-Corasick automaton over the vocabulary enumerates the pieces that end at every
character; a Viterbi pass carries the best score and the number of pieces of its path.
Ties follow the ``tokenizers`` Unigram model: the score is compared strictly, and of equal
paths to a position the one whose last piece starts first stays. A character without a piece
of its own costs the lowest score minus 10; its run of such characters becomes one piece, or
its UTF-8 bytes where the vocabulary has byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tabreg.llm.base import text_or_empty

SPACE = "▁"           # the vocabulary's mark of a space
UNKNOWN_PENALTY = 10.0     # fixed value of the library's unigram model


def read_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in id order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


class UnigramCounter:
    """``count(text)``: number of pieces of the best path. Words (runs of spaces plus what
    follows up to the next space) are counted one by one and remembered, in a memo of bounded
    size; that is exact because no piece has a space after another character (checked)."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown_id: int = 0, memo: int = 400_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        best: dict[str, float] = dict(vocabulary)
        unknown = vocabulary[unknown_id][0]
        for piece, score in best.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown_score = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.as_bytes = all(f"<0x{b:02X}>" in best for b in range(256))
        self.unknown_piece = unknown
        self.inner_space = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in best)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.seen: dict[str, int] = {}
        self.memo = memo

    def count(self, text: str) -> int:
        """The text has a space put before it, and spaces become marks, as the file's
        tokenizer does; the empty text has no piece."""
        if not text:
            return 0
        marked = SPACE + text.replace(" ", SPACE)
        if self.inner_space:
            return self.viterbi(marked)
        seen, total = self.seen, 0
        for word in self.words.findall(marked):
            n = seen.get(word)
            if n is None:
                n = self.viterbi(word)
                if len(word) <= 64:
                    if len(seen) >= self.memo:
                        seen.clear()
                    seen[word] = n
            total += n
        return total

    def viterbi(self, s: str) -> int:
        n = len(s)
        score: list[float | None] = [None] * (n + 1)
        # pieces on the best path, and whether it ends in an unknown character
        count, open_unknown = [0] * (n + 1), [False] * (n + 1)
        score[0] = 0.0
        matches = self.automaton.iter(s)
        end, found = next(matches, (n, None))
        for at in range(n):
            target, pieces, unknown, single = None, 0, False, False
            while end == at:                              # longest match first: earliest start first
                length, value = found
                start = at + 1 - length
                single = single or length == 1
                if score[start] is not None:
                    s_new = score[start] + value
                    if target is None or s_new > target:
                        target, pieces, unknown = s_new, count[start] + 1, False
                end, found = next(matches, (n, None))
            if not single and score[at] is not None:
                s_new = score[at] + self.unknown_score
                if target is None or s_new > target:
                    width = len(s[at].encode("utf-8", "replace"))
                    more = width if self.as_bytes else 0 if open_unknown[at] else 1
                    target, pieces, unknown = s_new, count[at] + more, True
            score[at + 1], count[at + 1], open_unknown[at + 1] = target, pieces, unknown
        return count[n]


_COUNTERS: dict[str, UnigramCounter] = {}


def _counter(model_path: str) -> UnigramCounter:
    if model_path not in _COUNTERS:
        _COUNTERS[model_path] = UnigramCounter(read_vocabulary(model_path))
    return _COUNTERS[model_path]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, n_chars`` of every whole text, one row per input row. A null or
    empty text has 0 tokens; null ids stay; other columns are ignored. One pass over the
    table without a shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([counter.count(t) for t in texts], pa.int64()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[id_col, "n_tokens", "n_chars"])

    rows = docs.select(docs[id_col].cast("long").alias(id_col), text_or_empty(docs[text_col]).alias("text"))
    return rows.mapInArrow(count, f"`{id_col}` long, n_tokens long, n_chars long")
