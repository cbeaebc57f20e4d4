"""Best-fit packing with certified bin counts.

Texts become pieces of at most `capacity` ids, the ids of a byte-level BPE file with an end id behind each document. Full
pieces are sequences as they are. The others are packed in rounds: each partition runs best-fit decreasing and compares its
bins with a lower bound from dual-feasible functions; a partition that meets the bound is certified and its bins
are final, but for the emptiest, which holds what the bound's rounding wastes. In a partition with a gap only full bins stay.
The documents of all other bins move on, are dealt anew over fewer partitions and packed again, until one partition is left.
A partition holds about PER_PARTITION pieces (a few numbers each); while nine in ten pieces would move again, that doubles,
up to eight times as many, and then the exchange ends.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, back, cut, released

CAPACITY = 2048
#: Pieces that one task packs.
PER_PARTITION = 60_000


@lru_cache(maxsize=4)
def encoder(path: str):
    """The byte-level BPE of a tokenizers file, with its ids; the string of a special token is that token, as in the library's default call.

    The merges of such a file are numbered like its ids, so a rank-based BPE engine gives the same ids (tested against the
    tokenizers library), about four times as fast.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(chars[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


#: A run without a break that the BPE engine would take quadratic time over.
_LONG_RUN = re.compile(r"\S{4000}|\s{4000}")


@lru_cache(maxsize=2)
def _exact(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids_of(text: str, path: str) -> list[int]:
    if len(text) >= 4000 and _LONG_RUN.search(text):
        return _exact(path).encode(text, add_special_tokens=False).ids
    return encoder(path).encode(text, allowed_special="all")


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, ids: bool = False) -> DataFrame:
    """The pieces of each row of docs (doc_id, text): its ids and the end id, cut so that only the first may be shorter.

    A null or empty text is its end id alone. With ids, the piece's ids follow as an array.
    """

    def run(batches):
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                all_ids = np.array([*ids_of(text or "", path), end_id], "<u4")
                first = (len(all_ids) - 1) % capacity + 1
                a = 0
                for i, b in enumerate(range(first, len(all_ids) + 1, capacity)):
                    out.append((doc, i, a, b - a, zlib.crc32(all_ids[a:b].tobytes()), *([all_ids[a:b].tolist()] if ids else [])))
                    a = b
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int64())] if ids else [])]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(released(run), PIECES + (", ids array<long>" if ids else ""))


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the total and of two families of dual-feasible functions.

    u_k(x) = x if (k + 1)x is whole, else floor((k + 1)x) / k; and for a threshold e <= 1/2: 1 above 1 - e, 0 below e, x between.
    """
    if not len(sizes):
        return 0
    size, count = np.unique(sizes, return_counts=True)
    best = -(-int((size * count).sum()) // capacity)
    for k in range(1, 21):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    for e in np.unique(size[size <= capacity // 2]):
        value = np.where(size > capacity - e, capacity, np.where(size < e, 0, size))
        best = max(best, -(-int((value * count).sum()) // capacity))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each size, and the number of bins: largest first, into the fullest bin that has room."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r: a bin has room r
    used = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fit = mask >> s
        if fit:
            r = s + (fit & -fit).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, used
            used += 1
        bins[i], offsets[i] = b, capacity - r
        if r > s:
            room[r - s].append(b)
            mask |= 1 << (r - s)
    return bins, offsets, used


def _pack(capacity: int):
    """Packs one partition: rows with the bin, the offset and whether the bin is final."""

    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        t = pa.concat_tables(tables)
        order = np.lexsort([t.column(c).to_numpy() for c in ("uid", "length")])
        t = t.take(pa.array(order))
        sizes = t.column("length").to_numpy()
        bins, offsets, used = best_fit_decreasing(sizes, capacity)
        fill = np.bincount(bins, sizes, used)
        done = bins != fill.argmin() if used == lower_bound(sizes, capacity) else fill[bins] == capacity
        t = t.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets)).append_column("done", pa.array(done))
        yield from t.to_batches()

    return run


def pack(cuts: DataFrame, capacity: int = CAPACITY, per_partition: int = PER_PARTITION) -> DataFrame:
    """Adds sequence_id and offset to pieces (length from 1 to capacity; other columns stay as they are, but those of the new names are replaced).

    Repeated rows are packed as often as they occur. No rows give no rows.
    """
    columns = cuts.columns
    cuts = cut(aside(cuts, length="length").withColumn("uid", F.monotonically_increasing_id()))
    place = lambda turn: F.lit(turn + 1) * 2**56 + F.spark_partition_id().cast("long") * 2**28 + F.col("bin")
    out = cuts.filter(F.col("length") == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = cuts.filter(F.col("length") < capacity).select("uid", "length")
    left, turn, size = rest.count(), 0, per_partition
    while left:
        parts = -(-left // size)
        dealt = rest.repartition(parts, F.lit(0) if parts == 1 else F.xxhash64("uid", F.lit(turn)))
        packed = cut(dealt.mapInArrow(released(_pack(capacity)), "uid long, length long, bin long, offset long, done boolean").withColumn("sequence_id", place(turn)))
        moving = packed.filter("not done").count()
        stuck = moving > 0.9 * left
        last = parts == 1 or moving == 0 or stuck and size >= 8 * per_partition
        size *= 1 + stuck
        out = out.unionByName((packed if last else packed.filter("done")).select("uid", "sequence_id", "offset"))
        if last:
            break
        rest, left, turn = packed.filter("not done").select("uid", "length"), moving, turn + 1
    return cuts.join(out, "uid").select(*back(columns, ("sequence_id", "offset")), "sequence_id", "offset")
