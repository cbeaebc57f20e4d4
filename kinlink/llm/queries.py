"""The thin queries opN_<name> over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .common import table


def op7_near_dedup(spark, sf_dir):
    from .near_dedup import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"))


def op1_secret_scan(spark, sf_dir):
    from .secret_scan import KINDS, secrets

    found = secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select("doc_id", *map(count, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op2_mixing(spark, sf_dir):
    from .common import cut
    from .mixing import mix, words_of

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", words_of().alias("size"))
    taken = F.col("size") * F.col("copies")
    return mix(cut(docs)).select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies", "rate")


def op3_language_id(spark, sf_dir):
    from .language_id import language_id

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id(docs).select("doc_id", "held_out", "lang_pred", "score", "bits", "rejected")


def op4_html_text(spark, sf_dir):
    from .html_text import main_text

    return main_text(table(spark, sf_dir, "pages"))


def op5_token_counts(spark, sf_dir):
    import public_tokenizers

    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_packing(spark, sf_dir):
    import public_tokenizers

    from .packing import pack, pieces

    return pack(pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op8_toxicity(spark, sf_dir):
    from .toxicity import toxicity

    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op9_quality(spark, sf_dir):
    from .quality import MEASURES, quality

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality(docs).select("doc_id", *MEASURES, "base_failed", "kept", *(F.round(c, 6).alias(c) for c in ("class_distance", "word_distance")))


def op10_fingerprint(spark, sf_dir):
    from .fingerprints import edited_pairs

    return edited_pairs(table(spark, sf_dir, "documents"))


def op11_tiered_packing(spark, sf_dir):
    import public_tokenizers

    from .tiered_packing import tiered_packing

    return tiered_packing(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_prefix_trie(spark, sf_dir):
    from .prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_collocations(spark, sf_dir):
    from .collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


# --- SQL, where it can express the rows ---------------------------------------------------------


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + f"|{_any_case('api')}_?{_any_case('key')}"
_PATTERNS = {"assign": rf"""(?:{_KEYWORDS})["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
_VALUE = rf"""^(?:{_KEYWORDS})["'']?\x20*[:=]\x20*["'']?"""
_HOLDS = {"assign": f"length(regexp_replace(m, '{_VALUE}', '')) >= 6", "access": "length(m) >= 20", "hex": "length(m) >= 24"}


def _spans(kind: str, number: int) -> str:
    """Matches and the pieces between them give the places."""
    found = f"SELECT doc_id, regexp_extract_all(t, '{_PATTERNS[kind]}') AS ms, string_split_regex(t, '{_PATTERNS[kind]}') AS ps FROM d"
    each = f"SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM ({found})"
    placed = f"SELECT doc_id, ms[i] AS m, coalesce(list_sum(list_transform(ps[1:i], lambda x: length(x))), 0)::BIGINT + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)::BIGINT AS a FROM ({each})"
    return f"SELECT doc_id, '{kind}' AS kind, {number} AS k, a, a + length(m) AS b FROM ({placed}) WHERE {_HOLDS[kind]}"


#: The base and its digest. The kinds with checksums are no SQL; the tables given have none of them.
_OP1 = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), s AS ({' UNION ALL '.join(_spans(k, i) for i, k in enumerate(_PATTERNS))}),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS c, count(*) FILTER (k = 2) AS h, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k) AS spans FROM s GROUP BY 1)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""

_SPLIT = r"list_filter(string_split_regex({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_OP7 = rf"""WITH RECURSIVE w AS (SELECT doc_id, {_SPLIT.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
sh AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
item AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sh),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM item a JOIN item b ON a.h = b.h AND a.doc_id <> b.doc_id AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT link.a, reach.seen FROM link JOIN reach ON link.b = reach.node),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sh JOIN least ON node = doc_id"""


def _op9() -> str:
    from . import quality as q

    js = lambda p, r: f"(0.5::DOUBLE * (CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {r})) ELSE 0 END + CASE WHEN {r} > 0 THEN {r} * log2(2 * {r} / ({p} + {r})) ELSE 0 END))"
    counted = lambda pattern: f"len(regexp_extract_all(t, '{pattern}'))"
    kinds = {"upper": counted(r"\p{Lu}"), "letter": counted(r"[\p{L}\p{M}]") + " - " + counted(r"\p{Lu}"), "digit": counted(r"\p{Nd}"), "space": counted(r"[\x20\x09-\x0D]"), "point": counted(r"[.,;:!?''\"()\[\]-]"), "symbol": counted(r"[#*$%&|<>]")}
    names = list(kinds)
    other = " - ".join(["length(t)", *(f"c_{n}" for n in names)])
    classes = [*(f"c_{n}" for n in names), "c_other"]
    return rf"""WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_SPLIT.format("coalesce(text, '')")} AS w FROM documents),
c0 AS (SELECT *, {', '.join(f'{e} AS c_{n}' for n, e in kinds.items())} FROM d), c AS (SELECT *, {other} AS c_other FROM c0),
cr AS (SELECT lang AS l, {', '.join(f'sum({x}) / greatest(1, sum(length(t)))::DOUBLE AS r_{x}' for x in classes)} FROM c GROUP BY 1),
cd AS (SELECT doc_id, sqrt(greatest(0, {' + '.join(js(f'({x} / greatest(1, length(t))::DOUBLE)', f'r_{x}') for x in classes)})) AS class_distance FROM c JOIN cr ON c.lang IS NOT DISTINCT FROM cr.l),
lw AS (SELECT doc_id, lang, unnest(list_transform(w, lambda x: lower(x))) AS word FROM d),
wc AS (SELECT lang, word, count(*) AS n FROM lw GROUP BY 1, 2), tot AS (SELECT lang, sum(n) AS total FROM wc GROUP BY 1),
top AS (SELECT wc.lang, word, n / total::DOUBLE AS q FROM wc JOIN tot ON wc.lang IS NOT DISTINCT FROM tot.lang QUALIFY row_number() OVER (PARTITION BY wc.lang ORDER BY n DESC, word) <= {q.COMMON}),
qs AS (SELECT lang, sum(q) AS q FROM top GROUP BY 1),
dw AS (SELECT doc_id, lang, word, count(*) AS k FROM lw GROUP BY 1, 2, 3),
hit AS (SELECT dw.doc_id, k / len(w)::DOUBLE AS p, q FROM dw JOIN top ON dw.word = top.word AND dw.lang IS NOT DISTINCT FROM top.lang JOIN d ON d.doc_id = dw.doc_id),
agg AS (SELECT doc_id, sum({js('p', 'q')}) AS js, sum(p) AS p, sum(q) AS q FROM hit GROUP BY 1),
wd0 AS (SELECT d.doc_id, coalesce(agg.js, 0) AS js, greatest(0, 1 - coalesce(agg.p, 0)) AS po, greatest(0, 1 - qs.q) AS qo, qs.q - coalesce(agg.q, 0) AS absent FROM d LEFT JOIN agg ON agg.doc_id = d.doc_id LEFT JOIN qs ON d.lang IS NOT DISTINCT FROM qs.lang),
wd AS (SELECT doc_id, coalesce(sqrt(greatest(0, js + 0.5::DOUBLE * absent + {js('po', 'qo')})), 0) AS word_distance FROM wd0),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
dup AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM dup) GROUP BY 1),
base AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, {counted(r"[#*$%&|<>]")}::BIGINT AS n_symbols,
  (len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
f AS (SELECT base.*, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, class_distance, word_distance FROM base JOIN cd USING (doc_id) JOIN wd USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND class_distance <= {q.MAX_CLASSES} + {q.SLACK} / sqrt(greatest(1, n_words)) AND word_distance <= {q.MAX_WORDS} + {q.SLACK} / sqrt(greatest(1, n_words)) AS kept, round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance FROM f"""


_OP12 = """WITH RECURSIVE bits(i, j, c) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL SELECT i, j + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE j < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE j = 8),
o AS (SELECT conv_id AS c, coalesce(text, '') AS x, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, count(*) AS n, c - c % 100 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, x: xor(a >> 8, any_value(t)[(xor(a, x) & 255) + 1])), 4294967295) % 6 AS h FROM o, tab GROUP BY c),
m AS (SELECT s.*, least(s.h, coalesce(least(z.n, 5), 0)) AS k FROM s LEFT JOIN s z ON z.c = s.b),
r AS (SELECT m.c, o.p AS d, o.k, length(o.x) AS chars FROM m JOIN o ON o.c = m.b AND o.p <= m.k UNION ALL SELECT m.c, o.p - m.h + m.k, o.k, length(o.x) FROM m JOIN o ON o.c = m.c AND o.p > m.h),
w AS (SELECT c, d, chars, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS path FROM r UNION ALL SELECT c, 0, 0, '' FROM m),
e AS (SELECT c, d, chars, min(c) OVER (PARTITION BY d, path) AS rep, count(*) OVER (PARTITION BY d, path) AS n, d = max(d) OVER (PARTITION BY c) AS last FROM w),
nodes AS (SELECT d, rep, n, chars FROM e WHERE c = rep),
up AS (SELECT nodes.*, e.rep AS parent FROM nodes LEFT JOIN e ON e.c = nodes.rep AND e.d = nodes.d - 1),
kids AS (SELECT d - 1 AS d, parent AS rep, count(*) AS many FROM up WHERE d > 0 GROUP BY 1, 2),
roll AS (SELECT e.d, e.rep, count(*) FILTER (kids.many IS NULL) AS leaves, sum((nodes.n - 1) * nodes.chars) AS saved FROM nodes JOIN e ON e.c = nodes.rep AND e.d <= nodes.d LEFT JOIN kids ON kids.d = nodes.d AND kids.rep = nodes.rep GROUP BY 1, 2),
ends AS (SELECT d, rep, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha FROM e WHERE last GROUP BY 1, 2)
SELECT up.rep AS conv_id, up.d AS depth, up.parent AS parent_conv_id, up.n AS n_convs, coalesce(kids.many, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(sha, sha256('')) AS ends_sha256 FROM up JOIN roll ON roll.d = up.d AND roll.rep = up.rep LEFT JOIN kids ON kids.d = up.d AND kids.rep = up.rep LEFT JOIN ends ON ends.d = up.d AND ends.rep = up.rep"""

_OP13 = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest([1, 2, 3]) AS m FROM p) WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY 1),
c AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.m, k.phrase, k.w, k.a, k.k, x.f AS l, y.f AS r, ((1000000::HUGEINT * k.a * k.a) // (x.f::HUGEINT * y.f))::BIGINT AS score FROM k
  JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
e AS (SELECT lang, unnest([array_to_string(w[1:m - 1], ' '), array_to_string(w[2:m], ' ')]) AS phrase, a FROM c WHERE m = 3),
o AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.lang = b.lang AND e.phrase = b.phrase AND 100 * e.a >= 50 * b.a)),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000"""


def oracle_sql():
    return {"op1_secret_scan": _OP1, "op7_near_dedup": _OP7, "op9_quality": _op9(), "op12_prefix_trie": _OP12, "op13_collocations": _OP13}
