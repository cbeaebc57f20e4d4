"""Shared plumbing: tables, lineage cuts, byte-level word hashing, connected components."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

#: The white space of every word rule here: 0x20 and 0x09-0x0D; a word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows and bytes that cross to Python at once, so that workers stay small whatever the texts' lengths.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's. Bounds the session's Arrow batches, in rows and in bytes, unless they are bounded more tightly."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key)
        if not now.isdigit() or int(now) > most or int(now) == 0:
            spark.conf.set(key, str(most))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder the session names in spark.checkpoint.dir.

    Without one only a local master gets a folder of its own: elsewhere executors would not share it, and this raises.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints"))
    return df.checkpoint(eager=True)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, a task over Arrow batches, which gives its free memory back at its end: workers stay for the session's later tasks, and allocators keep what a task has freed."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)

    return task


def crc_fold(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def aside(docs: DataFrame, **own: str) -> DataFrame:
    """docs with its columns renamed to _in0, _in1, ... and the named ones added anew, so that no column of docs can clash with an operator's."""
    at = {c: f"_in{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*at.values()).withColumns({name: F.col(at[c]) for name, c in own.items()})


def back(columns: list[str], without: tuple[str, ...] = ()) -> list[F.Column]:
    """The columns that aside() renamed, but for some names."""
    return [F.col(f"_in{i}").alias(c) for i, c in enumerate(columns) if c.lower() not in without]


def numbered(rows: DataFrame, key: str, *then: F.Column) -> DataFrame:
    """rows with `at`, each row's place (from 1) among those of equal key (a long column without nulls) in the order of `then`.

    One global sort; a key may span partitions. Each partition continues at most one key of the one before, so what is added to its places is a table
    of no more rows than partitions.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_own", T.LongType())])
    number = rows.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(number).to_numpy(zero_copy_only=False)
            start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            own = np.arange(len(keys)) - np.repeat(start, np.diff(np.append(start, len(keys)))) + 1
            if keys[0] == last:
                own[: start[1] if len(start) > 1 else len(keys)] += seen
            last, seen = keys[-1], own[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(own)], schema.names)

    placed = cut(rows.orderBy(key, *then).mapInArrow(run, schema))
    spans = placed.groupBy(key, "_part").agg(F.max("_own").alias("_many"))
    before = F.sum("_many").over(W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    later = spans.select(key, "_part", before.alias("_before")).filter("_before is not null")
    return placed.join(F.broadcast(later), [key, "_part"], "left").select(*rows.columns, (F.col("_own") + F.coalesce("_before", F.lit(0))).alias("at"))


# --- words of many texts at once -------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)  # one random value for each byte
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> list[np.ndarray]:
    """Powers of the odd base, and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers.append(np.cumprod(factors, dtype=np.uint64))
    return _powers


def string_chunks(column: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts of about `most` bytes (a longer text alone); null reads as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        yield a, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, in order, and the number of each text's first word (with the total at the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[off[:-1][off[:-1] < len(data)]] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    ends = off[1:][off[1:] > 0] - 1
    after[ends] = False
    end = np.flatnonzero(inside & ~after) + 1
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * up[: len(data)], out=total[1:], dtype=np.uint64)
    words = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return words, np.searchsorted(start, off)


# --- connected components ---------------------------------------------------------------------


#: A star is large if it has more than this part of all links.
STARS = 500
#: Links (16 bytes each) up to which one task finds the components.
LOCAL = 1_000_000


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all links (u, v) by union-find, in a single task."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((find(u), find(v)))
            parent[high] = low
    found = [(x, find(x)) for x in list(parent) if parent[x] != x]
    for a in range(0, len(found), 50_000):
        node, label = zip(*found[a : a + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(label, pa.int64())], ["node", "label"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of edges (a, b) that is not itself that smallest one.

    Up to LOCAL links are one task's union-find. More alternate large-star and small-star until nothing changes: each round is a grouped
    minimum and an equi-join, links stay distributed, and the number of rounds grows with the logarithm of the longest path. A star with over a
    STARS-th of all links is joined by broadcast (there are at most 2 * STARS of them), so it isn't one task's.
    """

    def star(rows: DataFrame, links: int) -> DataFrame:
        """rows (u, v) with m, the smallest of u and its neighbours."""
        low = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("many")).withColumn("m", F.least("u", "m"))
        bound = max(1, links // STARS)
        hot = F.broadcast(low.filter(F.col("many") > bound).select("u", F.col("m").alias("hot")))
        known = rows.join(hot, "u", "left")
        rest = known.filter("hot is null").select("u", "v").join(low.filter(F.col("many") <= bound).select("u", "m"), "u")
        return rest.unionByName(known.filter("hot is not null").select("u", "v", F.col("hot").alias("m")))

    cur = cut(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    links, seen = cur.count(), None
    if links <= LOCAL:
        return cut(cur.coalesce(1).mapInArrow(_united, "node long, label long"))
    cur = cut(cur.distinct())
    while True:
        sym = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(sym, 2 * links).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        pair = F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        cur = cut(star(large, links).select(pair.alias("p")).select("p.u", "p.v").filter("u != v").distinct())
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("label"))
        links, seen = now[0], now
