"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line with its line break, so together the paragraphs are the whole text. A paragraph of over LONGEST code points
is cut further, behind each word whose last three letters' hash says so (one in WORDS); the parts are its leaves, a shorter paragraph is one. A
section ends at a leaf whose hash says so (one in LEAVES) or that holds an empty line. No rule looks at a place in the text, so edges
follow the content: an edit changes the leaves of the paragraphs it touches, their sections and the root, and nothing else. The digest of
a section is that of its leaves' digests, the root that of the sections'. Equal roots mean equal texts (128 bits).

A fingerprint is text: the root, "|", and the sections, ";" between them; a section is the start of its digest, "=", and its
leaves, "," between them, each the start of its digest, "." and its length. likeness() descends from the root: equal subtrees
count whole, unequal sections are compared leaf by leaf.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix

LONGEST, WORDS, LEAVES = 32, 5, 8
#: Row groups in order of id, each streamed by one task.
BUCKETS, BUCKET_ROWS = 65536, 5000


def leaves(text: str) -> list[str]:
    if len(text) <= LONGEST and "\n" not in text:
        return [text] if text else []
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    line = np.flatnonzero((c[:-1] == 10) & (c[1:] != 10)) + 1  # paragraphs but the first
    space = (c == 32) | (c - 9 < 5)
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    last = np.flatnonzero(~space & np.concatenate((space[1:], [True])))
    # a cut lies before a word that follows a chosen one in its paragraph, and this must be long
    own = np.searchsorted(line, first, "right")
    edges = np.concatenate(([0], line, [len(c)]))
    fits = np.flatnonzero((own[:-1] == own[1:]) & (np.diff(edges)[own[:-1]] > LONGEST))
    end, size = last[fits], last[fits] - first[fits]
    key = c[end].astype(np.uint64)
    for back in (1, 2):
        key |= np.where(size >= back, c[np.maximum(end - back, 0)], 0).astype(np.uint64) << np.uint64(21 * back)
    cuts = first[fits[mix(key) % np.uint64(WORDS) == 0] + 1]
    edges = np.unique(np.concatenate((edges, cuts))).tolist()
    return [text[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def fingerprint(text: str | None) -> str:
    """The tree of a text; null and empty texts have the tree without leaves."""
    sections, own, names = [], [], []
    digests = []

    def close() -> None:
        digest = xxhash.xxh3_128_digest(b"".join(own))
        digests.append(digest)
        sections.append(f"{digest.hex()[:16]}={','.join(names)}")
        own.clear()
        names.clear()

    for leaf in leaves(text or ""):
        digest = xxhash.xxh3_128_digest(leaf.encode())
        own.append(digest)
        names.append(f"{digest.hex()[:8]}.{len(leaf)}")
        if digest[-1] % LEAVES == 0 or "\n\n" in leaf:
            close()
    if own:
        close()
    return f"{xxhash.xxh3_128_hexdigest(b''.join(digests))}|{';'.join(sections)}"


def _sections(tree: str) -> list[str]:
    return tree[33:].split(";")


def _size(section: str) -> int:
    return sum(int(leaf[9:]) for leaf in _leaves_of(section))


def _leaves_of(section: str) -> list[str]:
    """Names of a section's leaves: eight digits, a point, the length."""
    return section[17:].split(",") if len(section) > 17 else []


def likeness(a: str, b: str) -> float:
    """The share of the longer text that lies in leaves both have, from 0 to 1; 1 for equal roots."""
    if a[:32] == b[:32]:
        return 1.0
    p, q = Counter(_sections(a)), Counter(_sections(b))
    same = sum(_size(s) * n for s, n in (p & q).items())
    rest_a, rest_b = (Counter(leaf for s, n in only.items() for leaf in _leaves_of(s) * n) for only in (p - q, q - p))
    size = same + max(sum(int(leaf[9:]) * n for leaf, n in rest.items()) for rest in (rest_a, rest_b))
    same += sum(int(leaf[9:]) * min(n, rest_b[leaf]) for leaf, n in rest_a.items() if leaf in rest_b)
    return min(1.0, same / size) if size else 1.0


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """(start, end) of the parts of text a, in code points, whose leaves text b lacks."""
    x, y = _sections(a), _sections(b)
    only_a, only_b = Counter(x) - Counter(y), Counter(y) - Counter(x)
    spare = Counter(leaf for s, n in only_b.items() for leaf in _leaves_of(s) * n)
    at, out = 0, []
    for section in x:
        differs = only_a[section] > 0
        only_a[section] -= differs
        for leaf in _leaves_of(section):
            n = int(leaf[9:])
            if differs:
                if spare[leaf] > 0:
                    spare[leaf] -= 1
                elif out and out[-1][1] == at:
                    out[-1] = (out[-1][0], at + n)
                else:
                    out.append((at, at + n))
            at += n
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) for each row of docs (doc_id, text)."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t) for t in batch.column(1).to_pylist()], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (bucket, ghost, doc_id, text) so dealt and sorted that a bucket is a run of descending ids and ends with a ghost of the row that follows.

    The order is by falling id, a null id last, equal ids by a hash of the text. Quantiles of the ids bound the buckets, at
    most BUCKETS of them and a partition each; one row for each bucket is known to the driver. Texts are shuffled once.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    rows = docs.count()
    many = max(1, min(BUCKETS, rows // BUCKET_ROWS))
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / many for i in range(1, many)], 0.2 / many))) if many > 1 else []
    if bounds:
        from pyspark.ml.feature import Bucketizer

        numbered = Bucketizer(splits=[-float("inf"), *bounds, float("inf")], inputCol="_id", outputCol="_b").transform(docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0))))
        bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(F.col("_b").cast("int"))
        docs = numbered.withColumn("bucket", bucket).drop("_id", "_b")
    else:
        docs = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(0))
    first = sorted(docs.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"), F.min(F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).alias("h")).collect(), reverse=True)
    # the first row of each bucket stands as a ghost at the end of the one before; the very first one at the end of the last
    to = [(r.bucket, first[i - 1].bucket, r.doc_id, r.h) for i, r in enumerate(first)]
    spark = docs.sparkSession
    heads = F.broadcast(spark.createDataFrame(to, "b int, goal int, top long, h long"))
    ghosts = docs.join(heads, (F.col("bucket") == F.col("b")) & (F.col("doc_id").eqNullSafe(F.col("top"))) & (F.col("h").isNull() | (F.col("h") == F.xxhash64("text"))))
    every = docs.select("bucket", F.lit(0).alias("ghost"), "doc_id", "text").unionByName(ghosts.select(F.col("goal").alias("bucket"), F.lit(1).alias("ghost"), "doc_id", "text"))
    return every.repartitionById(len(bounds) + 2, F.col("bucket") + 1).sortWithinPartitions("bucket", "ghost", F.desc_nulls_last("doc_id"), F.xxhash64("text"))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """The digest of op10: each text against its edited text and the next document's, for each row of docs (doc_id, text; other columns are ignored).

    A null text is empty. Repeated rows follow each other, each with a row of its own; rows of one id are in the order of their texts' hash,
    rows without an id come last. A single row is its own next. No rows give no rows.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches):
        held = None  # the row whose next one is not known yet
        for batch in batches:
            out = []
            for bucket, ghost, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                text = text or ""
                own = fingerprint(text)
                if held and held[0] == bucket:
                    _, was, before, tree = held
                    m = len(before) // 3
                    edited = before[: len(before) - m] + text[:m]
                    other = fingerprint(edited)
                    out.append((was, len(before), hashlib.sha256(edited.encode()).hexdigest(), tree, other, likeness(tree, other), likeness(tree, own)))
                held = None if ghost else (bucket, doc, text, own)
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
