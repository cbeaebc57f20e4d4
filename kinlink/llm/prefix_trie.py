"""The trie of conversations' beginnings, built level by level.

At each depth the live conversations are grouped by (parent node, next turn); a group is a node and its smallest conv_id is the node's name. A
node whose members all go on alike to their ends (as one without company does) is the top of a chain: its members leave the
loop, and the nodes below it are those of its smallest member's turns. So there are as many rounds as the longest beginning that conversations
share before they part. Then the levels are rolled up from the deepest: each joins what its children add up to.

Turns are held as digests (SHA-256 of role and text) in arrays of BLOCK levels, so texts are shuffled nowhere and a long conversation is never one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, numbered

#: Turns that a conversation c takes from the one it is filed under, c - c % GROUP: crc32 of c in decimal, modulo HEADS.
GROUP, HEADS = 100, 6
#: Levels in one array.
BLOCK = 1024
#: A node is large if it has more than this part of all conversations; those are met by broadcast, and there are fewer of them than this.
LARGE = 500
#: Rows (a conversation's next BLOCK levels each) up to which a round is one task's, without shuffles.
FEW = 20_000
#: Ids digested in one string.
CHUNK = 8192
EMPTY = hashlib.sha256(b"").hexdigest()
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

_RESTS = ("r1", "r2", "r3")


def _head() -> Column:
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, key, chars): the turns (conv_id, turn, role, text) of each conversation in order, null turns first, equal ones by digest. Rows without conv_id belong to none."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    own = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("key"), F.char_length(text).cast("long").alias("chars"))
    return cut(numbered(own, "conv_id", F.asc_nulls_first("turn"), F.asc("key")).select("conv_id", "at", "key", "chars"))


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) and (conv_id, depth, key, chars): each conversation with the first turns of the one that it is filed under in place of its own."""
    sizes = own.groupBy("conv_id").agg(F.max("at").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    first = F.col("conv_id") % GROUP == 0
    bases = sizes.filter(first).select(F.col("conv_id").alias("base"), F.least("n", F.lit(HEADS - 1)).alias("most"))
    taken = F.least(_head(), F.coalesce("most", F.lit(0)))
    convs = cut(sizes.select("conv_id", "n", base.alias("base")).join(bases, "base", "left").select("conv_id", "base", taken.alias("taken"), (taken + F.greatest(F.lit(0), F.col("n") - _head())).alias("length")))
    heads = own.filter(first & (F.col("at") < HEADS)).select(F.col("conv_id").alias("base"), F.col("at").alias("depth"), "key", "chars")
    begun = convs.join(heads, "base").filter("depth <= taken").select("conv_id", "depth", "key", "chars")
    rest = own.filter(F.col("at") > _head()).join(convs.select("conv_id", "taken"), "conv_id").select("conv_id", (F.col("at") - _head() + F.col("taken")).alias("depth"), "key", "chars")
    return convs.select("conv_id", "length"), begun.unionByName(rest)


def _marks(depth: Column, key: Column) -> dict[str, Column]:
    """Three 32-bit numbers of a turn at its depth; their sums over the turns to come tell whether conversations go on alike."""
    x, y = F.xxhash64(depth, key), F.xxhash64(key, depth)
    low = F.lit(0xFFFFFFFF).cast("long")
    return {"r1": x.bitwiseAND(low), "r2": F.shiftrightunsigned(x, 32), "r3": y.bitwiseAND(low)}


def blocks_of(convs: DataFrame, made: DataFrame) -> DataFrame:
    """(conv_id, block, turns, length, rest, r1, r2, r3): BLOCK levels as an array by depth; the sums run from the block's first level to the end, rest over the characters."""
    marks = made.withColumns(_marks(F.col("depth"), F.col("key"))).withColumn("block", F.floor((F.col("depth") - 1) / BLOCK).cast("int"))
    grouped = marks.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("depth", "key", "chars"))).alias("turns"), F.sum("chars").alias("rest"), *(F.sum(r).alias(r) for r in _RESTS))
    onward = W.partitionBy("conv_id").orderBy(F.desc("block"))
    return cut(grouped.withColumns({c: F.sum(c).over(onward) for c in ("rest", *_RESTS)}).join(convs, "conv_id"))


def _small(rows: DataFrame, many: int) -> DataFrame:
    """In one partition if there are few, so that groups and joins of what comes of them need no shuffle."""
    return rows.coalesce(1) if many <= FEW else rows


def _joined(live: DataFrame, nodes: DataFrame, bound: int) -> DataFrame:
    """live rows with their nodes by (parent, key): nodes of more than bound members by broadcast, so that none is one task's."""
    named = ["parent", "key", "node", "n_convs", "chain"]
    large = F.broadcast(nodes.filter(F.col("n_convs") > bound).select(*named[:2], *(F.col(c).alias(f"large_{c}") for c in named[2:])))
    known = live.join(large, ["parent", "key"], "left")
    others = known.filter("large_node is null").join(nodes.filter((F.col("n_convs") > 1) & (F.col("n_convs") <= bound)).select(*named), ["parent", "key"])
    met = known.filter("large_node is not null").select(*live.columns, *(F.col(f"large_{c}").alias(c) for c in named[2:]))
    return others.select(*live.columns, *named[2:]).unionByName(met)


def _levels(blocks: DataFrame, root: int, total: int) -> tuple[list[tuple[DataFrame, int]], list[DataFrame]]:
    """The nodes of each depth from 1 with the conversations that came that far, and (conv_id, depth, node) of the conversations that end at nodes with company."""
    live = blocks.filter("block = 0").withColumn("parent", F.lit(root).cast("long"))
    levels: list[tuple[DataFrame, int]] = []
    ends: list[DataFrame] = []
    depth, bound, many = 0, max(1, total // LARGE), total
    while True:
        at, depth = depth % BLOCK, depth + 1
        if at == 0 and depth > 1:
            live = _small(live.select("conv_id", "parent").join(blocks.filter(F.col("block") == depth // BLOCK), "conv_id"), many)
        turn = F.col("turns")[at]
        marks = _marks(F.lit(depth).cast("long"), F.col("key"))
        now = live.withColumns({"key": turn["key"], "chars": turn["chars"]}).withColumns({r: F.col(r) - marks[r] for r in _RESTS} | {"rest": F.col("rest") - F.col("chars")})
        grouped = now.groupBy("parent", "key").agg(
            F.min("conv_id").alias("node"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.max("rest").alias("rest"), F.max("length").alias("length"),
            F.max(F.struct(*_RESTS)).alias("most"), F.min(F.struct(*_RESTS)).alias("least"),
        )
        nodes = cut(grouped.withColumn("chain", F.col("most") == F.col("least")).drop("most", "least"))
        levels.append((nodes, many))
        moved = cut(_joined(now.drop("chars"), nodes, bound))
        ends.append(moved.filter(F.col("chain") | (F.col("length") == depth)).select("conv_id", F.col("length").alias("depth"), "node"))
        live = moved.filter(~F.col("chain") & (F.col("length") > depth)).drop("parent", "key", "n_convs", "chain").withColumnRenamed("node", "parent")
        many = nodes.filter(~F.col("chain")).agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
        if not many:
            return levels, ends
        live = _small(live, many)


def _digests(ends: DataFrame) -> DataFrame:
    """(depth, conv_id, ends_sha256): the digest of each node's ids in ascending order. Ranges of ids become strings first, so a node of any size passes as few rows, streamed through its digest."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held: list[int] = []
        last = None
        for batch in batches:
            for depth, node, conv in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held and ((depth, node) != last or len(held) == CHUNK):
                    rows.append((*last, held[0], ",".join(map(str, held))))
                    held = []
                last = depth, node
                held.append(conv)
            yield _rows(rows)
            rows = []
        if held:
            yield _rows([(*last, held[0], ",".join(map(str, held)))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, rows = None, None, []
        for batch in batches:
            for depth, node, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (depth, node) == last:
                    state.update(b",")
                else:
                    if state:
                        rows.append((*last, state.hexdigest()))
                    last, state = (depth, node), hashlib.sha256()
                state.update(ids.encode())
        if state:
            rows.append((*last, state.hexdigest()))
        a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], ["depth", "conv_id", "ends_sha256"])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["depth", "node", "first", "ids"])

    ordered = ends.select(F.col("depth").cast("long").alias("depth"), "node", "conv_id").repartitionByRange("depth", "node", "conv_id").sortWithinPartitions("depth", "node", "conv_id")
    dealt = ordered.mapInArrow(strings, "depth long, node long, first long, ids string").repartition("depth", "node").sortWithinPartitions("depth", "node", "first")
    return dealt.mapInArrow(digest, "depth long, conv_id long, ends_sha256 string")


def _under_tops(blocks: DataFrame, tops: DataFrame, alike: bool) -> DataFrame:
    """The nodes below the tops (conv_id, depth, n_convs) of chains: their smallest member's further turns. Only alike conversations save anything there."""
    top = tops.select("conv_id", F.col("depth").alias("top"), "n_convs")
    below = blocks.join(top, "conv_id").filter((F.col("block") + 1) * BLOCK > F.col("top"))
    each = below.select("conv_id", "block", "length", "n_convs", "top", "rest", F.explode("turns").alias("t")).select("*", "t.depth", "t.chars").drop("t")
    before = F.coalesce(F.sum("chars").over(W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    saved = (F.col("n_convs") - 1) * (F.col("rest") - before) if alike else F.lit(0).cast("long")
    every = each.withColumn("saved_tokens", saved).filter(F.col("depth") > F.col("top"))
    return every.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs", (F.col("depth") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), "saved_tokens")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row (COLUMNS) for each node of the trie over conversations (conv_id, turn, role, text), as long and string columns.

    A null role or text reads as empty, a null turn comes first, turns of equal number follow their digests, repeated rows are repeated turns. Rows
    with a null conv_id belong to no conversation. An empty table has no nodes, not even a root. Other columns are ignored.
    """
    convs, made = rebuilt(turns(conversations))
    total, root = convs.agg(F.count("*"), F.min("conv_id")).first()
    if not total:
        return conversations.sparkSession.createDataFrame([], ", ".join(f"{c} {'string' if c == COLUMNS[-1] else 'long'}" for c in COLUMNS))
    blocks = blocks_of(convs, made)
    levels, ends = _levels(blocks, root, total)
    out, kids = [], None
    for depth in range(len(levels), 0, -1):
        nodes, many = levels[depth - 1]
        nodes, chain = _small(nodes, many).withColumn("depth", F.lit(depth).cast("long")), F.col("chain")
        own = nodes.filter(chain).select("node", "depth", "parent", "n_convs", (F.col("length") > depth).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * (F.col("chars") + F.col("rest"))).alias("saved_tokens"))
        if kids is not None:
            saved = (F.col("n_convs") - 1) * F.col("chars") + F.col("saved")
            parted = nodes.filter(~chain).join(kids, "node").select("node", "depth", "parent", "n_convs", F.col("many").alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"))
            own = _small(own.unionByName(cut(parted)), many)
        out.append(own.select(F.col("node").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"))
        kids = own.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("many"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    none = F.lit(0).cast("long")
    zero = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).select("conv_id", none.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs")
    children = kids.agg(F.sum("many").alias("many"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    out.append(zero.crossJoin(F.broadcast(children)).select("*", F.coalesce("many", none).alias("n_children"), F.coalesce("leaves", none + 1).alias("n_leaves"), F.coalesce("saved", none).alias("saved_tokens")).drop("many", "leaves", "saved"))
    single, company = F.col("n_convs") == 1, F.col("n_convs") > 1
    tops = [nodes.filter("chain").select(F.col("node").alias("conv_id"), F.lit(i + 1).cast("long").alias("depth"), "n_convs") for i, (nodes, _) in enumerate(levels)]
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    # a node's only member ends there if nothing follows; all others meet their digests
    alone = union([_under_tops(blocks, union([x.filter(single) for x in tops]), False), *(x.filter(single) for x in out[:-1])])
    alone = alone.withColumn("ends_sha256", F.when(F.col("n_children") == 0, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY))
    others = union([_under_tops(blocks, union([x.filter(company) for x in tops]), True), *(x.filter(company) for x in out[:-1]), out[-1]])
    ended = convs.filter("length = 0").select("conv_id", F.col("length").alias("depth"), F.lit(root).cast("long").alias("node"))
    others = others.join(_digests(union([ended, *ends])), ["depth", "conv_id"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))
    return alone.select(*COLUMNS).unionByName(others.select(*COLUMNS))
