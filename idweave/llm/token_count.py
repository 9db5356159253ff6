"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton enumerates the vocabulary's pieces in a run of text;
dynamic programming over end positions carries the best score and its number
of pieces, nothing else. Ties follow the tokenizer: a later candidate must be
strictly better, and candidates of one end come longest first; a character
that is no piece itself may stand alone at the unknown score and counts its
UTF-8 bytes.

A text is scored run by run: where no piece holds two neighbouring characters
in that order, every path has a boundary between them, so runs are independent
and their counts are cached. Scores are whole numbers, so sums are exact.

Defined results: null and empty texts have no tokens; a null id stays null;
repeated rows are counted each; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

SPACE, UNKNOWN_PENALTY, CACHE_RUNS = "▁", 10.0, 600_000


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the normal pieces of a sentencepiece model file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class UnigramCounter:
    """Counts the pieces of the best segmentation; ``limit`` runs are held at most."""

    def __init__(self, vocabulary: list[tuple[str, float]], limit: int = CACHE_RUNS):
        self.automaton, self.limit = ahocorasick.Automaton(), limit
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.runs: dict[str, int] = {}
        self.set_patterns(vocabulary)

    def set_patterns(self, vocabulary: list[tuple[str, float]]) -> None:
        """``pattern`` matches runs between forced boundaries, ``coarse`` the same for texts with a rare character.

        An opener is a sign that no piece holds right after a letter or digit:
        a run may begin there. ``rare`` are the other characters that a piece
        holds before an opener. A run also begins at a space mark after
        anything else, if no piece holds one inside.
        """
        pairs = {p[i:i + 2] for p, _ in vocabulary for i in range(len(p) - 1)}
        plain = lambda c: c.isalpha() or c.isdecimal() or c == SPACE
        late = {b for a, b in pairs if plain(a) and a != SPACE}
        openers = {"\n"} | {chr(c) for c in range(0x21, 0x7F) if not plain(chr(c))} - late
        self.rare = {a for a, b in pairs if b in openers and a not in openers and a != SPACE}
        inside = any(b == SPACE and a != SPACE for a, b in pairs)
        self.coarse = regex.compile("(?s).+" if inside else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        held = "".join(f"\\u{ord(c):04x}" for c in sorted(openers))
        self.pattern = self.coarse if inside else regex.compile(
            f"{SPACE}*[{held}]+[^{SPACE}{held}]*|{SPACE}*[^{SPACE}{held}]+|{SPACE}+")

    def runs_of(self, text: str) -> list[str]:
        """The runs of a text; a space is marked and one is put in front, as the tokenizer does."""
        marked = SPACE + text.replace(" ", SPACE)
        return (self.pattern if self.rare.isdisjoint(marked) else self.coarse).findall(marked)

    def viterbi(self, run: str) -> int:
        """Pieces of the best segmentation of a run."""
        n = len(run)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        at = 0  # positions up to here have their best path

        def fill(to: int) -> None:
            """Positions after ``at`` up to ``to`` that no piece ends at: their character is unknown."""
            nonlocal at
            while at < to:
                best[at + 1], count[at + 1] = best[at] + self.unknown, count[at] + len(run[at].encode())
                at += 1

        end, score, pieces, single = -1, 0.0, 0, True
        for e, (size, s) in self.automaton.iter(run):
            e += 1
            if e != end:
                if end >= 0:
                    self._close(run, best, count, end, score, pieces, single)
                    at = end
                fill(e - 1)
                end, score, pieces, single = e, None, 0, False
            candidate = best[e - size] + s
            if score is None or candidate > score:
                score, pieces = candidate, count[e - size] + 1
            single = single or size == 1
        if end >= 0:
            self._close(run, best, count, end, score, pieces, single)
            at = end
        fill(n)
        return count[n]

    def _close(self, run, best, count, end, score, pieces, single) -> None:
        """Fix the best path to ``end``; a last character that is no piece may stand alone."""
        if not single and best[end - 1] + self.unknown > score:
            score, pieces = best[end - 1] + self.unknown, count[end - 1] + len(run[end - 1].encode())
        best[end], count[end] = score, pieces

    def count(self, values: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [self.runs_of(v) if v else [] for v in values]
        new = set().union(*split) - self.runs.keys()
        if len(self.runs) + len(new) > self.limit:
            self.runs.clear()
            new = set().union(*split)
        viterbi = self.viterbi
        self.runs.update((r, viterbi(r)) for r in new)
        get = self.runs.__getitem__
        return [sum(map(get, runs)) for runs in split]


@cache
def _counter(path: str) -> UnigramCounter:
    return UnigramCounter(read_vocabulary(path))


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_chars and n_tokens under the unigram vocabulary of a model file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            for part in slices(batch):
                values = [v or "" for v in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(np.array([len(v) for v in values], dtype=np.int64)),
                    pa.array(counter.count(values), pa.int64())], names=["id", "n_chars", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id bigint, n_chars bigint, n_tokens bigint")
