"""MinHash near-dedup from bottom-k sketches of one hash function.

Words are lower-cased (A-Z only) maximal runs outside 0x20 and 0x09-0x0D. A document's set holds its distinct 5-word
shingles (with fewer words the whole sequence; none without words). Two documents are linked when
100 * intersection >= 75 * union on their full sets.

1. One Arrow pass hashes all texts to sets, each with a fingerprint and its bottom-`k` sketch. Equal sets collapse into one
   representative, the smallest id, by a grouped minimum, so copies never meet as pairs.
2. Inverted lists of retained values. At the threshold two sketches share fewer values than six standard deviations below the mean
   (27 of 64) with a probability below 1e-8 (sets of up to 64 shingles are their own sketch). Values of one document link nothing, and a
   document needs only its `kept - shared + 1` rarest values (prefix filter): two documents that share enough values share
   one of those.
3. The union sketch (the smallest `k` values of two sketches) estimates the similarity of each list's smallest document with the
   others; what it can't rule out joins the two, and so does one more try against a document of the list's commonest component. Lists that
   still hold documents of several components, beside that smallest one, are compared inside, in sub-lists of bounded size that move
   ids and sketches, and give the links that join components; documents of the commonest one meet only those outside it. So a
   cluster is a component of pairs that look alike by their sketches; a passage that unlike documents share makes none.
4. The full sets of a cluster are compared in blocks of bounded size; the lists give overlaps, the sketch of the union
   (bottom 256) estimates the similarity, and an exact count confirms each link that still joins two components. Small clusters
   share a task. A large one has HUBS of its documents in all its blocks, which joins what a group of near copies has
   in each; what is then outside its largest component is compared with the other blocks by sketches, and only documents that look
   alike across blocks send their full sets again.
5. Components of the links: one task's union-find up to a bounded number of links, large-star and small-star beyond.

Texts are read again for the members of clusters only; a bit set of their ids, of bounded size, holds back the others before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import components, cut, mix, released, string_chunks, word_hashes

K, UNION_K = 64, 256
#: Shingles in a block, about 8 bytes each in a task.
BLOCK = 500_000
#: Documents of a large cluster that all its blocks hold.
HUBS = 32
#: Sketches that one task compares with each other.
SUBLIST = 8192
#: Parts in which inverted lists meet their heads, and documents in a part where they meet their majority; they change no result.
SALTS, PART = 256, 1000
#: Bits of the set of wanted ids, at most (32 MB); a fuller set only lets more texts through.
MOST_BITS = 1 << 28
_FULL = np.uint64(2**64 - 1)
_STEP = np.uint64(0xD1342543DE82EF95)


def least_share(percent: int, k: int) -> float:
    """The share of k retained values below which that similarity is six standard deviations away."""
    p = percent / 100
    return max(0.0, p - 6 * (p * (1 - p) / k) ** 0.5)


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, data, off in string_chunks(column):
        words, first = word_hashes(data, off)
        run = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for i in range(width):
            run = mix(run * _STEP + words[i : i + len(run)])
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                yield np.unique(run[a : b - width + 1])
            elif b > a:
                h = np.full(1, b - a, np.uint64)
                for x in words[a:b]:
                    h = mix(h * _STEP + x)
                yield h
            else:
                yield run[:0]


def _sketches(k: int):
    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[:k].view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "fp", "vals"],
            )

    return run


def _rows(sets: list[np.ndarray], k: int) -> np.ndarray:
    """The smallest k values of each set, a row each, filled with the largest number."""
    out = np.full((len(sets), k), _FULL)
    for i, s in enumerate(sets):
        out[i, : min(len(s), k)] = s[:k]
    return out


def _column_rows(column: pa.ChunkedArray | pa.Array, k: int = K) -> np.ndarray:
    """_rows() of a column of sketches."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = column.offsets.to_numpy()
    held = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    out = np.full((len(column), k), _FULL)
    out[np.arange(k) < np.diff(off)[:, None]] = held[off[0] : off[-1]] if len(off) else held
    return out


def likeness(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Similarities estimated from the sketch of the union, row by row, and whether they leave the similarity possible."""
    k = a.shape[1]
    both = np.sort(np.concatenate((a, b), axis=1), axis=1)
    real = both != _FULL
    new = np.ones(both.shape, bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    whole = np.maximum(size_a, size_b) <= k  # both sketches are the sets
    inside = real & ((np.cumsum(new & real, axis=1) <= k) | whole[:, None])
    like = (~new & inside).sum(1) / np.maximum(1, (new & inside).sum(1))
    return like, np.where(whole, like >= percent / 100 - 1e-9, like >= least_share(percent, k))


def _parents(known: list[int] | None, n: int):
    """A union-find over n places: (find, join)."""
    first: dict[int, int] = {}
    parent = list(range(n)) if known is None else [first.setdefault(label, i) for i, label in enumerate(known)]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x: int, y: int) -> None:
        parent[find(x)] = find(y)

    return find, join


def _overlaps(heads: list[np.ndarray], size: np.ndarray, percent: int):
    """A function of i: the places before i whose retained values and size leave the similarity with i possible."""
    n = len(heads)
    shared_least = max(1, int(K * least_share(percent, K)))
    owner = np.repeat(np.arange(n), [len(h) for h in heads])
    _, value, count = np.unique(np.concatenate(heads), return_inverse=True, return_counts=True)
    order = np.argsort(value, kind="stable")
    lists = np.split(owner[order], np.cumsum(count)[:-1])
    value = np.split(value, np.cumsum([len(h) for h in heads])[:-1])

    def near(i: int) -> np.ndarray:
        own = [x for v in value[i] if len(x := lists[v]) > 1]
        if not own:
            return np.zeros(0, np.int64)
        shared = np.bincount(np.concatenate(own), minlength=n)[:i]
        least = np.minimum(size[:i], size[i])
        most = np.maximum(size[:i], size[i])
        need = np.where(most <= K, np.ceil(most * percent / 100), np.minimum(shared_least, np.ceil(least * percent / 100)))
        return np.flatnonzero((shared >= np.maximum(1, need)) & (100 * least >= percent * most))

    return near


def forest(ids: list[int], sets: list[np.ndarray], percent: int, known: list[int] | None = None, side: np.ndarray | None = None, block: np.ndarray | None = None, sizes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the components of these sets, beyond the known components (labels); with side, only pairs across the sides and from different blocks.

    Full sets confirm each link exactly. With sizes, the sets are sketches of sets of these sizes, and their estimate decides.
    """
    n, k = len(ids), UNION_K if sizes is None else K
    size = np.array([len(s) for s in sets]) if sizes is None else sizes
    find, join = _parents(known, n)
    near = _overlaps([s[:K] for s in sets], size, percent)
    big = _rows(sets, k)
    links = []
    for i in range(n):
        at = near(i)
        if side is not None:
            at = at[(side[at] != side[i]) & (block[at] != block[i])]
        if not len(at):
            continue
        root = find(i)
        at = np.array([j for j in at if find(j) != root], np.int64)
        for part in np.array_split(at, len(at) // 2048 + 1):
            if not len(part):
                continue
            like, keep = likeness(np.broadcast_to(big[i], (len(part), k)), big[part], np.broadcast_to(size[i], len(part)), size[part], percent)
            for j in part[keep][np.argsort(-like[keep], kind="stable")]:
                if find(j) == find(i):
                    continue
                if sizes is None:
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * common < percent * (size[i] + size[j] - common):
                        continue
                join(i, int(j))
                links.append((ids[i], ids[j]))
    return links


LINK = "a long, b long"


def _link_table(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _links(percent: int):
    """Confirmed links of each cluster of a group of rows with texts."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("cluster", "ascending"), ("doc_id", "ascending")])
        ids, cluster = group.column("doc_id").to_pylist(), group.column("cluster").to_numpy()
        sets = [s for c in group.column("text").chunks for s in shingle_sets(c)]
        edges = [*np.flatnonzero(np.diff(cluster, prepend=cluster[0] - 1)), len(ids)]
        found = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            how = {}
            if "side" in group.column_names:
                how = {x: group.column(x).to_numpy()[a:b] for x in ("side", "block")} | {"known": group.column("component").to_pylist()[a:b]}
            found += forest(ids[a:b], sets[a:b], percent, **how) if b - a > 1 else []
        return _link_table(found)

    return run


def _sketch_links(percent: int):
    """Links by sketches that join components in a group of rows (rep, n, label, vals)."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        sizes = group.column("n").to_numpy()
        rows = _column_rows(group.column("vals"))
        sets = [r[: min(K, n)] for r, n in zip(rows, sizes, strict=True)]
        return _link_table(forest(group.column("rep").to_pylist(), sets, percent, known=group.column("label").to_pylist(), sizes=sizes))

    return run


def _across(percent: int):
    """Of a group of sketches, the documents that look alike across sides, blocks and components."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        size, side, block, part = (group.column(x).to_numpy() for x in ("n", "side", "block", "component"))
        rows = _column_rows(group.column("vals"))
        near = _overlaps([r[: min(K, n)] for r, n in zip(rows, size, strict=True)], size, percent)
        met = np.zeros(len(size), bool)
        for i in range(len(size)):
            at = near(i)
            at = at[(side[at] != side[i]) & (block[at] != block[i]) & (part[at] != part[i])]
            for some in np.array_split(at, len(at) // 2048 + 1):
                if len(some):
                    _, keep = likeness(np.broadcast_to(rows[i], (len(some), K)), rows[some], np.broadcast_to(size[i], len(some)), size[some], percent)
                    met[some[keep]] = True
                    met[i] |= keep.any()
        return group.filter(pa.array(met)).drop_columns(["vals", "n"])

    return run


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b, na, nb) of representatives whose sketches don't rule out the similarity."""

    def run(batches):
        for batch in batches:
            _, keep = likeness(*(_column_rows(batch.column(x)) for x in ("va", "vb")), *(batch.column(x).to_numpy() for x in ("na", "nb")), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    sized = pairs.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).distinct()
    left = sized.join(sets.select(F.col("rep").alias("a"), F.col("vals").alias("va")), "a")
    return left.join(sets.select(F.col("rep").alias("b"), F.col("vals").alias("vb")), "b").select("a", "b", "na", "nb", "va", "vb").mapInArrow(released(run), LINK)


def _majority(rest: DataFrame) -> DataFrame:
    """rest (v, rep, n, label, parts), lists that hold documents of several labels, with what is known of each list.

    many, few, top, pick, least: its documents, those outside the commonest label, that label, one of its documents, the list's smallest document.
    """
    # a document of many lists meets another pick in each
    by = rest.groupBy("v", "label").agg(F.count("*").alias("c"), F.min("rep").alias("least"), F.max("parts").alias("parts"), F.min(F.struct(F.xxhash64("v", "rep"), "rep", "n")).alias("pick"))
    top = by.groupBy("v").agg(F.sum("c").alias("many"), F.count("*").alias("labels"), F.min("least").alias("least"), F.max("parts").alias("parts"), F.max(F.struct("c", "label", "pick")).alias("top")).filter("labels > 1")
    known = top.select("v", "many", "least", (F.col("many") - F.col("top.c")).alias("few"), F.col("top.label").alias("top"), F.col("top.pick").alias("pick"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = rest.withColumn("part", F.expr("cast(pmod(xxhash64(rep, 4), parts) as int)"))
    return dealt.join(known, ["v", "part"]).drop("part", "parts")


def _sublists(mixed: DataFrame) -> DataFrame:
    """(task, part, rep, n, label) from the lists of _majority().

    Lists that hang together and have up to SUBLIST documents in all are one task, each document in it once. Other lists are tasks of their
    own; of a list longer than SUBLIST, every sub-list meets each part of what is outside the commonest label, and nothing else.
    """
    rows = cut(mixed.drop("pick"))
    chain = components(rows.select(F.col("least").alias("a"), F.col("rep").alias("b")))
    held = rows.join(chain.withColumnRenamed("node", "rep").withColumnRenamed("label", "chain"), "rep", "left").withColumn("chain", F.coalesce("chain", "rep"))
    docs = held.select("chain", "rep", "n", "label").distinct()
    sizes = docs.groupBy("chain").agg(F.count("*").alias("size"))
    small = docs.join(sizes.filter(F.col("size") <= SUBLIST), "chain").select(F.col("chain").alias("task"), F.lit(-1).alias("part"), "rep", "n", "label")
    large = held.join(sizes.filter(F.col("size") > SUBLIST), "chain").withColumns({"blocks": F.ceil(F.col("many") / SUBLIST).cast("int"), "parts": F.when(F.col("many") > SUBLIST, F.ceil(F.col("few") / SUBLIST)).otherwise(1).cast("int")})
    block, part = F.expr("cast(pmod(xxhash64(rep), blocks) as int)"), F.expr("cast(pmod(xxhash64(rep, 2), parts) as int)")
    large = large.withColumns({"block": block, "own": part})
    met = "transform(sequence(0, parts - 1), p -> p * blocks + block)"
    meets = "if(blocks = 1 or label = top, array(), transform(sequence(0, blocks - 1), b -> own * blocks + b))"
    large = large.select(F.col("v").alias("task"), F.explode(F.expr(f"array_distinct(concat({met}, {meets}))")).alias("part"), "rep", "n", "label")
    return small.unionByName(large)


def clusters(sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, cluster, n) for each representative of sets (rep, n, vals) that looks like another by its sketch."""
    index = sets.select("rep", "n", F.explode("vals").alias("v"))
    often = index.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1")
    # up to this size every partner's sketch is its whole set; a larger partner's sketch may lack shared values
    need = F.when(F.col("n") <= K * percent // 100, F.ceil(F.col("n") * percent / 100)).otherwise(max(1, int(K * least_share(percent, K))))
    per = W.partitionBy("rep")
    prefix = index.join(often, "v").select("rep", "v", "n", F.row_number().over(per.orderBy("df", "v")).alias("rank"), F.count("*").over(per).alias("many")).filter(F.col("rank") <= F.col("many") - need + 1)
    prefix = cut(prefix.select("rep", "v", "n"))
    # a list is met in SALTS parts, each with its own copy of the list's head, so that no task holds all of a long list
    salt = F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(SALTS)).cast("int")
    prefix = prefix.withColumn("salt", salt)
    part = prefix.groupBy("v", "salt").agg(F.min(F.struct("rep", "n")).alias("head"), F.count("*").alias("many"))
    head = part.groupBy("v").agg(F.min("head").alias("head"), F.sum("many").alias("many")).filter("many > 1")
    lists = prefix.join(part.select("v", "salt").join(head, "v"), ["v", "salt"]).drop("salt").filter("rep != head.rep")
    linked = cut(_alike(lists.select(F.col("head.rep").alias("a"), F.col("rep").alias("b"), F.col("head.n").alias("na"), F.col("n").alias("nb")), sets, percent))
    label = components(linked)
    labelled = lambda label: lists.filter("many > 2").select("v", "rep", "n", F.ceil(F.col("many") / PART).cast("int").alias("parts")).join(label.select(F.col("node").alias("rep"), "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    # what the smallest document of its lists didn't join is tried against one of the commonest label in each
    rest = labelled(label)
    tried = _majority(rest).filter("label != top").select(F.col("pick.rep").alias("a"), F.col("rep").alias("b"), F.col("pick.n").alias("na"), F.col("n").alias("nb"))
    linked = linked.unionByName(cut(_alike(tried, sets, percent)))
    label = components(linked)
    rest = labelled(label)
    inside = _sublists(_majority(rest)).join(sets.select("rep", "vals"), "rep")
    more = cut(inside.groupBy("task", "part").applyInArrow(_sketch_links(percent), LINK))
    joined = label if more.isEmpty() else components(linked.unionByName(more))
    joined = joined.unionByName(joined.select(F.col("label").alias("node"), "label").distinct())
    return joined.join(prefix.select(F.col("rep").alias("node"), "n").distinct(), "node").select(F.col("node").alias("doc_id"), F.col("label").alias("cluster"), "n")


def _with_text(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (doc_id, other columns) joined with docs (doc_id, text); most texts of other ids stay out of the shuffle."""
    bits = 1 << int(min(MOST_BITS.bit_length() - 1, max(16, (16 * wanted.count()).bit_length())))
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    word = wanted.select(F.floor(slot / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {bits}) % 64 as int))").alias("bit")).groupBy("word").agg(F.expr("bit_or(bit)").alias("bit")).toArrow()
    held = np.zeros(bits // 64, np.int64)
    held[word.column("word").to_numpy()] = word.column("bit").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(held.view(np.uint8))

    def run(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            keep = shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.select([0, 1]).filter(pa.array(keep.astype(bool)))

    near = docs.filter("doc_id is not null").select("doc_id", "text", slot.alias("slot")).mapInArrow(released(run), "doc_id long, text string")
    return near.join(wanted, "doc_id")


def _cluster_links(docs: DataFrame, sets: DataFrame, member: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that span the components of docs (doc_id, text) inside the clusters; member is (doc_id, cluster, n)."""
    blocks = member.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    dealt = cut(member.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")))
    large = dealt.filter("blocks > 1")
    total = dealt.agg(F.sum("n"), F.count_if(F.col("blocks") > 1)).first()
    tasks = max(1, 2 * (total[0] or 0) // BLOCK)
    hubs = large.withColumn("rank", F.row_number().over(W.partitionBy("cluster").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))).filter(F.col("rank") <= HUBS).select("doc_id", F.lit(True).alias("hub"))
    places = F.when(F.col("hub"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    placed = dealt.join(hubs, "doc_id", "left").select("doc_id", "cluster", F.col("blocks") > 1, F.explode(places).alias("place")).toDF("doc_id", "cluster", "large", "place")
    # small clusters share tasks of about a block
    task = F.when(F.col("large"), F.col("cluster")).otherwise(-1 - F.pmod(F.xxhash64("cluster"), F.lit(tasks)))
    links = cut(_with_text(docs, placed.withColumn("task", task).drop("large")).groupBy("task", "place").applyInArrow(_links(percent), LINK))
    if not total[1]:
        return links
    # of each large cluster, what is outside the largest component, against all other blocks
    label = components(links.join(large.select(F.col("doc_id").alias("a")), "a", "left_semi"))
    known = large.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "cluster", "n", "blocks", "block", F.coalesce("label", "doc_id").alias("component"))
    counts = known.groupBy("cluster", "component").agg(F.count("*").alias("many"))
    largest = counts.groupBy("cluster").agg(F.max(F.struct("many", "component")).alias("top"))
    outside = counts.join(largest, "cluster").filter("component != top.component").groupBy("cluster").agg(F.first("top.component").alias("top"), F.ceil(F.sum("many") / SUBLIST).cast("int").alias("parts"))
    roled = known.join(outside, "cluster").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("parts")).cast("int"))
    met = F.expr("transform(sequence(0, parts - 1), p -> struct(p as part, block as place, 0 as side))")
    meets = F.expr("if(component = top, array(), transform(sequence(0, blocks - 1), b -> struct(part as part, b as place, 1 as side)))")
    roled = roled.select(F.col("doc_id").alias("rep"), "cluster", "n", "block", "component", F.explode(F.concat(met, meets)).alias("role")).select("rep", "cluster", "n", "block", "component", "role.*")
    kept = "rep long, cluster long, block int, component long, part int, place int, side int"
    alike = cut(roled.join(sets.select("rep", "vals"), "rep").groupBy("cluster", "part", "place").applyInArrow(_across(percent), kept))
    if alike.isEmpty():
        return links
    again = _with_text(docs, alike.withColumnRenamed("rep", "doc_id"))
    return links.unionByName(cut(again.groupBy("cluster", "part", "place").applyInArrow(_links(percent), LINK)))


def near_dedup(docs: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text; other columns are ignored).

    Null or wordless texts have an empty set, link with nothing and are kept. Repeated rows share a set and so a component; each
    repeat of the smallest id is kept. A row without a doc_id joins the component of its text; alone it has a null
    component and is kept. No rows give no rows.
    """
    sketched = cut(docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(released(_sketches(K)), "doc_id long, n long, fp binary, vals array<long>"))
    sets = sketched.filter("n > 0 and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.any_value("n").alias("n"), F.any_value("vals").alias("vals"))
    sets = cut(sets)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    links = _cluster_links(own, sets, clusters(sets, percent), percent)
    label = components(links)
    by_set = sets.select("fp", "rep").join(label.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("label", "rep").alias("component"))
    out = sketched.select("doc_id", "n", "fp").join(by_set, "fp", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.col("component").isNull()).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of docs that near_dedup keeps; of equal rows of a kept doc_id one stays. All rows without a doc_id stay.

    An id that occurs with different texts (or other columns, of any type) keeps each of those rows, so nothing is lost by chance. Rows are equal
    if their JSON is; the join has them by id already, so repeats go without a second shuffle where it was not a broadcast.
    """
    whole = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), {"ignoreNullFields": "false"}), 256)
    kept = near_dedup(docs, percent).filter("kept and doc_id is not null").select("doc_id").distinct()
    with_id = docs.filter("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn("_of_whole_row", whole).dropDuplicates(["doc_id", "_of_whole_row"])
    with_id = with_id.select(*(F.col(f"`{c}`") for c in docs.columns))
    return with_id.unionByName(docs.filter("doc_id is null"))
