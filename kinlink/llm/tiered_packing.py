"""Hierarchical packing into windows of several lengths.

Texts become the ids of a byte-level BPE file with an end id behind each. Every task packs the documents of its own partition, in blocks of BLOCK_IDS ids, so
ids are never shuffled and a task holds one block (or one document, if that is longer). In a block

1. a document gives its whole windows of the longest tier as they are, and what is left is routed to the shortest tier that holds it;
2. from the longest tier down, each routed part opens a window of its tier, largest first;
3. the window's gap takes the largest part of the shorter tiers that fits, again and again, and the last gap takes a slice of the
   longest part of those tiers (of its own tier, if they are used up); the slice's rest is routed anew.

A window is written once it is full. What the last window of a block lacks comes from the next block; at the end of a partition its content is cut at
powers of two. So every sequence is as long as a tier or as a power of two and nothing is padded; each window costs one cut at most.

Sequences of a tier are then dealt into step groups of about `step` ids: sorted by their attention work (the sum of their parts' squared lengths) and dealt
in turn, so groups of a tier differ by one sequence at most and by little work, and `step_at` spreads each tier's groups evenly over a run.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered
from .packing import ids_of

#: Window lengths, powers of two.
TIERS = (256, 512, 1024, 2048)
#: Ids that a task packs at once.
BLOCK_IDS = 4_000_000
#: Ids of a step group.
STEP = 65_536
#: Characters of a text that are encoded at once; the break before a word behind a word is one of the tokenizer's own.
LONG = 1 << 18
_BREAK = re.compile(r"[a-z](?= [a-z])")

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier long"


def encoded(text: str, path: str, end_id: int, most: int = LONG) -> np.ndarray:
    """The ids of a whole text and the end id; long texts are encoded in parts that the tokenizer would part, too."""
    out, a = [], 0
    while len(text) - a > most:
        found = _BREAK.search(text, a + most)
        if not found:
            break
        out.append(np.array(ids_of(text[a : found.end()], path), "<u4"))
        a = found.end()
    out.append(np.array([*ids_of(text[a:], path), end_id], "<u4"))
    return np.concatenate(out)


class Packer:
    """Packs parts (document, start, length); full windows come out as lists of (document, start, length, offset)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = sorted(tiers, reverse=True)
        self.parts: list[list[tuple[int, int]]] = [[] for _ in range(self.tiers[0] + 1)]
        self.mask = 0  # bit n: there is a part of length n

    def _put(self, doc: int, start: int, length: int) -> None:
        self.parts[length].append((doc, start))
        self.mask |= 1 << length

    def _take(self, length: int) -> tuple[int, int]:
        part = self.parts[length].pop()
        if not self.parts[length]:
            self.mask ^= 1 << length
        return part

    def _longest(self, most: int) -> int:
        """The length of the longest part of at most `most` ids, 0 for none."""
        return max(0, (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def add(self, doc: int, size: int) -> Iterator[list[tuple[int, int, int, int]]]:
        whole = size // self.tiers[0] * self.tiers[0]
        for a in range(0, whole, self.tiers[0]):
            yield [(doc, a, self.tiers[0], 0)]
        if size > whole:
            self._put(doc, whole, size - whole)

    def windows(self) -> Iterator[list[tuple[int, int, int, int]]]:
        """Full windows, tier by tier; the parts of the last one, if it stays open, go back."""
        for tier, lower in pairwise([*self.tiers, 0]):
            while (n := self._longest(tier)) > lower:
                window, used = [], 0
                while used < tier and self.mask:
                    gap = tier - used
                    n = self._longest(gap)
                    if n:
                        doc, start = self._take(n)
                    else:
                        long = self._longest(tier // 2) or self._longest(tier)
                        doc, start = self._take(long)
                        self._put(doc, start + gap, long - gap)
                        n = gap
                    window.append((doc, start, n, used))
                    used += n
                if used < tier:
                    for doc, start, n, _ in window:
                        self._put(doc, start, n)
                    return
                yield window

    def rest(self) -> Iterator[list[tuple[int, int, int, int]]]:
        """What windows() left, cut at powers of two, the largest first."""
        left = sum(n * len(x) for n, x in enumerate(self.parts))
        while left:
            size = min(1 << (left.bit_length() - 1), self.tiers[0])
            window, used = [], 0
            while used < size:
                n = self._longest(self.tiers[0])
                doc, start = self._take(n)
                if n > size - used:
                    self._put(doc, start + size - used, n - size + used)
                    n = size - used
                window.append((doc, start, n, used))
                used += n
            left -= size
            yield window


def packed(docs: DataFrame, path: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The pieces (PIECES) of each row of docs (doc_id, text), packed partition by partition."""

    def run(batches):
        part, numbers = TaskContext.get().partitionId() << 40, iter(range(1 << 40))
        packer, ids, names, held = Packer(tiers), {}, {}, 0
        count = 0

        def rows(windows):
            out = []
            for window in windows:
                number, size = part + next(numbers), sum(x[2] for x in window)
                out += [(names[d], a, n, zlib.crc32(ids[d][a : a + n].tobytes()), len(ids[d]), number, offset, size) for d, a, n, offset in window]
            kinds = [pa.int64()] * 8
            columns = list(zip(*out, strict=True)) or [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

        def kept():
            """Documents with a part that still waits."""
            some = {d for x in packer.parts for d, _ in x}
            return {d: ids[d] for d in some}, {d: names[d] for d in some}

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids[count], names[count] = encoded(text or "", path, end_id), doc
                held += len(ids[count])
                yield rows(packer.add(count, len(ids[count])))
                count += 1
                if held >= block_ids:
                    yield rows(packer.windows())
                    ids, names = kept()
                    held = 0
        yield rows(packer.windows())
        yield rows(packer.rest())

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, PIECES)


def tiered_packing(docs: DataFrame, path: str, end_id: int = 1, tiers: tuple[int, ...] = TIERS, step: int = STEP) -> DataFrame:
    """PIECES with step_group and step_at (0 to 1) for docs (doc_id, text).

    A null or empty text is its end id alone, a null doc_id stays null, repeated rows are packed as often as they occur, an empty table gives no rows,
    other columns are ignored.
    """
    pieces = cut(packed(docs, path, end_id, tiers))
    work = F.sum(F.col("length") * F.col("length"))
    sequences = pieces.groupBy("sequence_id", "tier").agg(work.alias("work"))
    dealt = numbered(sequences, "tier", F.asc("work"), F.asc("sequence_id"))
    groups = F.broadcast(sequences.groupBy("tier").agg(F.ceil(F.count("*") * F.col("tier") / step).cast("long").alias("groups")))
    turn = (F.col("at") - 1) % F.col("groups")
    placed = dealt.join(groups, "tier").select("sequence_id", (turn * 64 + F.round(F.log2("tier")).cast("long")).alias("step_group"), ((turn + 0.5) / F.col("groups")).alias("step_at"))
    return pieces.join(placed, "sequence_id").select(*(x.split()[0] for x in PIECES.split(", ")), "step_group", "step_at")
