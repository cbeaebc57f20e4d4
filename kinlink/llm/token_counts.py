"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton over the vocabulary's pieces enumerates every match; dynamic programming keeps, for each position, the
best score and the number of pieces behind it, never the pieces. The rules are those of a unigram tokenizer: scores add up in double
precision, paths to a position are tried by rising start and only a strictly better score replaces one, a character without a
piece of its own costs ten less than the lowest score, and a run of such characters becomes one token for each of its bytes
(byte fallback) or one unknown token.

White space: every space becomes U+2581 and one is put in front. If no piece has U+2581 behind another character, none crosses the
start of a word, so words are segmented on their own, and each distinct word only once while it stays in the cache.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words kept by each task's cache; when it is full it starts anew.
CACHE = 400_000


class Unigram:
    """Counts tokens; pieces are (text, score), byte pieces <0x00> to <0xFF> switch byte fallback on."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int | None = 0):
        import ahocorasick

        names = {p for p, _ in pieces}
        self.fallback = all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        last = {p: s for p, s in pieces}  # as in a vocabulary's map, the last of equal pieces counts
        for i, (p, _) in enumerate(pieces):
            if p:
                self.automaton.add_word(p, (len(p), last[p], i == unknown))
        self.automaton.make_automaton()
        crossing = re.compile(f"[^{MARK}]{MARK}")
        # without byte fallback a run of unknown characters must not reach over the mark either
        self.by_word = (self.fallback or MARK in names) and not any(crossing.search(p) for p in names)
        self.unit = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.cache: dict[str, int] = {}

    def segment(self, text: str) -> int:
        """Tokens of a text, by one pass of the automaton and one of the recurrence."""
        n = len(text)
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(text):
            ends[end].append(match)
        # the automaton gives the pieces that end at a position longest first: by rising start, the order that ties follow
        score, count, run = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        cost = (lambda c: len(c.encode())) if self.fallback else (lambda c: 0)
        for end in range(n):
            best, pieces, unknown = None, 0, 0
            single = False
            for length, s, is_unknown in ends[end]:
                single |= length == 1
                total = s + score[end + 1 - length]
                if best is None or total > best:
                    start = end + 1 - length
                    best, pieces, unknown = total, count[start] + 1, 0
                    if is_unknown:
                        unknown = 1
            if not single:
                total = self.unknown_score + score[end]
                if best is None or total > best:
                    best, unknown = total, 1
                    # fused with the unknown character before it: bytes each, or one token for the run
                    pieces = count[end] + (cost(text[end]) if self.fallback else int(not run[end]))
            score[end + 1], count[end + 1], run[end + 1] = best, pieces, unknown
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = MARK + text.replace(" ", MARK)
        if not self.by_word:
            return self.segment(text)
        total, cache = 0, self.cache
        for unit in self.unit.findall(text):
            n = cache.get(unit)
            if n is None:
                if len(cache) >= CACHE:
                    cache.clear()
                n = self.segment(unit)
                if len(unit) <= 64:
                    cache[unit] = n
            total += n
        return total


def pieces_of(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file; its control pieces match no text and are left out by an impossible spelling."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    return [("" if model.is_control(i) or model.is_unknown(i) else model.id_to_piece(i), model.get_score(i)) for i in range(n)]


@lru_cache(maxsize=2)
def counter(path: str) -> Unigram:
    return Unigram(pieces_of(path), None)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) for each row of docs (doc_id, text; other columns are ignored).

    A null or empty text has none. Whole texts are counted, unit by unit with numbers alone, so a very long one takes a few bytes for each
    character of its longest unit. Repeated rows give repeated rows; no rows give no rows.
    """

    def run(batches):
        model = counter(path)
        for batch in batches:
            counts = [model.count(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long")
