"""Tiered packing, the trie of conversations' beginnings and phrase collocations against brute force and edge cases."""

import collections
import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest

from kinlink.llm import collocations, common, prefix_trie, queries, tiered_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def document(i, text, lang="en"):
    return (i, text, lang, "a", len(text) if text is not None else None)


# --- 11 tiered packing ------------------------------------------------------------------------


def whole(windows, sizes, longest):
    """Every id in one piece, offsets without gaps, lengths that are powers of two."""
    seen = collections.defaultdict(list)
    for window in windows:
        at = 0
        for doc, start, n, offset in window:
            assert n > 0 and offset == at
            at += n
            seen[doc].append((start, n))
        assert at <= longest and at & (at - 1) == 0
    for doc, size in enumerate(sizes):
        at = 0
        for start, n in sorted(seen[doc]):
            assert start == at
            at += n
        assert at == size
    return seen


@pytest.mark.parametrize("tiers", [(256, 512, 1024, 2048), (8, 16), (4,)])
def test_packer(tiers):
    r = random.Random(3)
    for _ in range(60):
        sizes = [r.choice([1, 2, tiers[0], tiers[-1], r.randrange(1, 3 * tiers[-1])]) for _ in range(r.randrange(40))]
        packer = tiered_packing.Packer(tiers)
        windows = []
        for doc, size in enumerate(sizes):
            windows += packer.add(doc, size)
            if r.random() < 0.1:
                windows += packer.windows()
        windows += packer.windows()
        full = len(windows)
        assert all(sum(x[2] for x in w) in tiers for w in windows)
        windows += packer.rest()
        seen = whole(windows, sizes, tiers[-1])
        assert len(windows) - full <= tiers[-1].bit_length()  # one open window, cut at powers of two
        cuts = sum(len(x) for x in seen.values()) - sum(-(-n // tiers[-1]) for n in sizes)
        assert cuts <= len(windows)


def test_gaps_take_shorter_parts_first():
    packer = tiered_packing.Packer((256, 512, 1024, 2048))
    for doc, size in enumerate([1500, 400, 148]):
        list(packer.add(doc, size))
    assert list(packer.windows()) == [[(0, 0, 1500, 0), (1, 0, 400, 1500), (2, 0, 148, 1900)]]


def packing_rows(spark, rows, **more):
    return tiered_packing.tiered_packing(spark.createDataFrame(rows, DOCS).repartition(3), PATH, **more).collect()


def test_tiered_packing(spark):
    r = random.Random(4)
    rows = [document(i, " ".join(r.choice(["red", "house", "Übung", "日本", "x1"]) for _ in range(r.choice([0, 1, 9, 200, 900, 4000])))) for i in range(120)]
    rows += [document(500, None), document(501, ""), document(None, "no id"), document(None, "no id"), document(7, "again"), document(8, "<|endoftext|> a")]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    ids = {}
    for i, text, *_ in rows:
        ids.setdefault(i, []).append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    found = packing_rows(spark, rows, step=8192)
    by_sequence, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for x in found:
        by_sequence[x.sequence_id].append(x)
        by_doc[x.doc_id].append(x)
        assert any(y[x.start : x.start + x.length] and zlib.crc32(b"".join(v.to_bytes(4, "little") for v in y[x.start : x.start + x.length])) == x.ids_crc32 and len(y) == x.doc_tokens for y in ids[x.doc_id])
    for pieces in by_sequence.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at & (at - 1) == 0 and {x.tier for x in pieces} == {at}
        assert len({x.step_group for x in pieces}) == 1
    assert {d: sum(x.length for x in v) for d, v in by_doc.items()} == {d: sum(map(len, v)) for d, v in ids.items()}
    for tier in {x.tier for x in found}:
        steps = collections.Counter({x.sequence_id: x.step_group for x in found if x.tier == tier}.values())
        assert max(steps.values()) - min(steps.values()) <= 1 and max(steps.values()) * tier <= 8192 + tier
    assert sorted({x.step_at for x in found}) and all(0 < x.step_at < 1 for x in found)


def test_tiered_packing_in_small_blocks(spark):
    rows = [document(i, "word " * (i * 7 % 400)) for i in range(60)]
    found = tiered_packing.packed(spark.createDataFrame(rows, DOCS).coalesce(1), PATH, block_ids=1000).collect()
    sizes = collections.Counter()
    for x in found:
        sizes[x.sequence_id] += x.length
    assert all(n & (n - 1) == 0 for n in sizes.values())
    assert sum(x.length for x in found) == sum({x.doc_id: x.doc_tokens for x in found}.values())
    assert sum(n not in tiered_packing.TIERS for n in sizes.values()) <= 8


def test_tiered_packing_frames(spark):
    assert packing_rows(spark, []) == []
    more = spark.createDataFrame([document(1, "a b")], DOCS).selectExpr("*", "1 as tier", "map(1, 2) as length", "'x' as sequence_id", "struct(1) as at")
    assert [(x.doc_id, x.start, x.length) for x in tiered_packing.tiered_packing(more, PATH).orderBy("start").collect()][0][0] == 1


def test_long_texts_are_encoded_in_parts():
    r = random.Random(6)
    text = " ".join(r.choice(["alpha", "Beta", "it's", "x1", "  ", "é", "\n", "end.", "gamma"]) for _ in range(4000))
    assert list(tiered_packing.encoded(text, PATH, 1, most=100)) == list(tiered_packing.encoded(text, PATH, 1))


# --- 12 prefix trie ---------------------------------------------------------------------------


def plain_trie(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = turns.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        path = tuple(base[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    digest = lambda cs: hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], digest(ends.get(p, []))) for p, m in members.items()) if turns else []


TURNS = "conv_id long, turn int, role string, text string"


def trie(spark, rows):
    return sorted(tuple(x) for x in prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS).repartition(3)).collect())


def conversations(r, n):
    rows = []
    for _ in range(n):
        c = r.choice([r.randrange(-250, 900), r.randrange(3) * 100, 10**12 + r.randrange(40)])
        rows += [(c, r.choice([t, t, None]) if r.random() < 0.05 else t, r.choice(["user", "assistant", None]) if r.random() < 0.1 else ("user", "assistant")[t % 2], r.choice(["hi", "yes", "no", "Ünï", "", None])) for t in range(r.choice([1, 2, 3, 5, 9]))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, seed):
    rows = conversations(random.Random(seed), 120) + [(None, 0, "user", "no id")] * 2
    assert trie(spark, rows) == plain_trie(rows)


def test_trie_of_copies_and_long_conversations(spark, monkeypatch):
    """Copies leave the loop together, so levels are as many as turns that are shared before conversations part."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    long = [(c, t, "user", f"turn {t}") for c in (110, 1120, 2140, 77) for t in range(23)] + [(3150, t, "user", f"turn {t}" if t < 9 else "other") for t in range(12)]
    hot = [(c, t, "user", "the same") for c in range(4000, 4040) for t in range(3)]
    rows = long + hot + [(5000 + i, 0, "user", "alone") for i in range(3)]
    assert trie(spark, rows) == plain_trie(rows)
    levels = []
    real = prefix_trie._levels
    monkeypatch.setattr(prefix_trie, "_levels", lambda *a: levels.append(real(*a)) or levels[-1])
    trie(spark, [(c, t, "user", f"turn {t}") for c in (110, 1120, 2140) for t in range(23)])
    assert len(levels[0][0]) == 1


def test_trie_without_company(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LARGE", 1)  # no node is large
    rows = conversations(random.Random(9), 60)
    assert trie(spark, rows) == plain_trie(rows)
    assert trie(spark, []) == []
    rows = [(3, 0, "user", "one")]  # crc32("3") % 6 is above 0 and conversation 0 is absent: its only turn goes
    assert trie(spark, rows) == plain_trie(rows)


def test_trie_ignores_other_columns(spark):
    rows = conversations(random.Random(4), 20)
    more = spark.createDataFrame(rows, TURNS).selectExpr("*", "map(1, 2) as key", "'x' as node", "1 as at", "struct(1) as chars", "2 as depth", "3 as parent")
    assert sorted(tuple(x) for x in prefix_trie.prefix_trie(more).collect()) == plain_trie(rows)


def test_numbers_across_partitions(spark):
    rows = [(r % 3 if r % 2 else 1, r * 7919 % 1000) for r in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else all falls into one partition
    try:
        found = common.numbered(df, "k", "v").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    for k in (0, 1, 2):
        own = sorted((x.at, x.v) for x in found if x.k == k)
        assert [a for a, _ in own] == list(range(1, len(own) + 1))
        assert [v for _, v in own] == sorted(v for i, v in rows if i == k)


# --- 13 collocations --------------------------------------------------------------------------


def plain_collocations(rows, max_n=3, least=10, inside=50, top=2000):
    f = collections.defaultdict(collections.Counter)
    n = collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_n + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        held = collections.Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    held[p[i : i + m]] = max(held[p[i : i + m]], a)
        scored = []
        for p, a in candidates.items():
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            if 100 * held[p] < inside * a:
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def phrases(spark, rows, **more):
    return sorted(tuple(x) for x in collocations.collocations(spark.createDataFrame(rows, "text string, lang string").repartition(3), **more).collect())


def texts(r, n):
    words = ["new", "York", "city", "ice", "cream", "the", "of", "ÉTÉ", "a-b", " x", "No"]
    sentence = lambda: " ".join(r.choice(words) if r.random() < 0.6 else "New York city" for _ in range(r.randrange(30)))
    return [(r.choice([".", ", ", "\n", "\t", "  ", "?!"]).join(sentence() for _ in range(4)), r.choice(["en", "de", "a b", None])) for _ in range(n)]


@pytest.mark.parametrize("more", [{}, {"max_n": 4, "least": 3, "inside": 70, "top": 25}, {"max_n": 2, "least": 1}])
def test_collocations_against_brute_force(spark, more):
    rows = texts(random.Random(2), 150) + [(None, "en"), ("", None), (" \t. ", "fr"), ("red tape. " * 12, "und"), ("red tape! " * 5, None), ("red tape! " * 5, None)]
    assert phrases(spark, rows, **more) == plain_collocations(rows, **more)


def test_collocations_frames(spark):
    assert phrases(spark, []) == []
    assert phrases(spark, [("one two three", "en")]) == []
    rows = [("one two " * 40_000, "en")]  # one piece of 80,000 words
    assert phrases(spark, rows) == plain_collocations(rows)
    more = spark.createDataFrame([("red tape. " * 12, "en")], "text string, lang string").selectExpr("*", "map(1, 2) as key", "'x' as phrase", "1 as f", "2 as a", "3 as w", "4 as i", "'p' as piece")
    assert [tuple(x) for x in collocations.collocations(more).collect()] == plain_collocations([("red tape. " * 12, "en")])


def test_only_ngrams_of_frequent_parts_are_counted(spark):
    """Each word is frequent, `a b` and `b c` are, `a b c` is, and 500 pairs are rare."""
    rows = [("a b c. " * 12 + ". ".join(f"a x{i} c" for i in range(500)), "en"), (" ".join(f"x{i}" for i in range(500)), "en"), ("a b c " * 3, "fr")]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    parts = spark.createDataFrame([("a b\ten",), ("b c\ten",)], "key string")
    keys = [x.key for x in collocations.longer_ngrams(docs, 3, parts).collect()]
    assert keys.count("a b c\ten") == 12 and len(keys) < 20  # the bit set lets few others through
    assert collocations.longer_ngrams(docs, 3, parts.limit(0)).count() == 0
    assert phrases(spark, rows, max_n=4) == plain_collocations(rows, max_n=4)


def test_queries_of_the_three_are_registered():
    assert {"op11_tiered_packing", "op12_prefix_trie", "op13_collocations"} <= set(queries.queries())
    assert {"op12_prefix_trie", "op13_collocations"} <= set(queries.oracle_sql())
