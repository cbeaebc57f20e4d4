"""Language identification by interpolated Kneser-Ney character models.

Learning: one Arrow pass counts the words (runs of letters, lower case) of each language, Spark adds up the distinct words, and a
second pass over those makes counts of ORDER-grams of characters (a word has ORDER - 1 start marks and an end mark). Lower orders
have continuation counts. Discounts and counts come from all n-grams, and the model holds all of them, whatever their number, so it grows with the
distinct n-grams of the input. Only a caller who gives `cells` gets a smaller model: where the distinct n-grams of an order times the languages exceed that
number, the order loses its rarest n-grams (by the highest share that any language gives them); their probability goes to their contexts' back-off weights.

The model is one table for all languages: for each order sorted hashes of the n-grams that any language has, and by row the
interpolated log-probability under every language; the same for contexts and back-off weights. Looking up a character is a
binary search, one more for each order that lacks the n-gram.

A text gets the language of the lowest cross-entropy for each character. The score is the posterior of that language with each
word as one observation. A text whose cross-entropy lies far above what the language's own words have (mean and deviation by
word, measured on the learned words) is marked as rejected; calibration uses no held-out row.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, cut, mix

ORDER = 5
START, END = "\x02", "\x03"
#: Deviations above a language's mean at which a text is rejected, and bits for each character added to that.
REJECT_DEVIATIONS, REJECT_BITS = 6.0, 0.25
#: Words in a task's cache, and code points whose words are held at once.
CACHE, CHUNK = 400_000, 1 << 20
_LETTERS = re.compile(r"[^\W\d_]+")
# word characters that are neither letters nor decimal digits (½, ², Ⅷ), to a space
_NUMBERS = {i: " " for i in range(128, 0x110000) if unicodedata.category(chr(i)) in ("Nl", "No")}
_NUMBER_CHARS = frozenset(map(chr, _NUMBERS))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    text = text.lower()
    if not text.isascii() and not _NUMBER_CHARS.isdisjoint(text):
        text = text.translate(_NUMBERS)
    return _LETTERS.findall(text)


def chunks(texts: list[str | None], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    a, size = 0, 0
    for b, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield a, b + 1
            a, size = b + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words with their marks, and the place of each word's end behind its own."""
    pad = START * (ORDER - 1)
    joined = "".join([f"{pad}{w}{END}" for w in words])
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), np.cumsum([len(w) + ORDER for w in words])


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), len(columns), np.uint64)
    for c in columns:
        h = mix(h * _STEP + c.astype(np.uint64))
    return h


@dataclass
class Pruned:
    """What is left of each order's n-grams, by language (codes and counts), with what all of them say.

    totals: for each n-gram left, the count of its context; rare: n-grams counted once and twice.
    """

    levels: dict[int, list[tuple[np.ndarray, np.ndarray]]]
    totals: dict[int, list[np.ndarray]]
    rare: dict[int, list[tuple[int, int]]]
    alphabet: int


class Model:
    """keys[k], logp[k] for n-grams of k characters; back_keys[k], back[k] for contexts of k characters."""

    def __init__(self, languages: list[str], grams: list[np.ndarray], counts: list[np.ndarray], pruned: Pruned | None = None):
        """grams: for each language the code points of its ORDER-grams, a row each, and their counts; of no use if pruned is given."""
        self.languages = languages
        n = len(languages)
        alphabet = pruned.alphabet if pruned else len(np.unique(np.concatenate([g[:, -1] for g in grams]))) + 1
        self.keys: dict[int, np.ndarray] = {}
        self.logp: dict[int, np.ndarray] = {}
        self.back_keys: dict[int, np.ndarray] = {}
        self.back: dict[int, np.ndarray] = {}
        levels: dict[int, list] = pruned.levels if pruned else {ORDER: list(zip(grams, counts, strict=True))}
        for k in range(ORDER - 1, 0, -1) if not pruned else ():  # continuation counts: how many longer n-grams end in this one
            levels[k] = []
            for g, _ in levels[k + 1]:
                _, first, many = np.unique(_hash([g[:, i] for i in range(1, k + 1)]), return_index=True, return_counts=True)
                levels[k].append((g[first, 1:], many))
        floor = np.full(n, 1.0 / alphabet)
        for k in range(1, ORDER + 1):
            every = np.concatenate([g for g, _ in levels[k]])
            hashes = _hash([every[:, i] for i in range(k)])
            self.keys[k], first = np.unique(hashes, return_index=True)
            every = every[first]
            context = _hash([every[:, i] for i in range(k - 1)]) if k > 1 else np.zeros(len(every), np.uint64)
            self.back_keys[k - 1], at = np.unique(context, return_inverse=True)
            back = np.ones((len(self.back_keys[k - 1]), n))
            own = np.zeros((len(every), n))
            for j, (g, c) in enumerate(levels[k]):
                row = np.searchsorted(self.keys[k], _hash([g[:, i] for i in range(k)]))
                ones, twos = pruned.rare[k][j] if pruned else (int((c == 1).sum()), int((c == 2).sum()))
                discount = ones / (ones + 2 * twos) if ones and twos else 0.5
                held = np.bincount(at[row], c, len(back))
                kinds = np.bincount(at[row], minlength=len(back))
                total = held.copy()
                if pruned:
                    total[at[row]] = pruned.totals[k][j]
                seen = total > 0
                back[seen, j] = np.maximum((total[seen] - held[seen] + discount * kinds[seen]) / total[seen], 1e-9)
                own[row, j] = np.maximum(c - discount, 0) / total[at[row]]
            lower = np.broadcast_to(floor, own.shape) if k == 1 else np.exp(self._look([every[:, i] for i in range(1, k)]))
            self.logp[k] = np.log(own + back[at] * lower).astype(np.float32)
            self.back[k - 1] = np.log(back).astype(np.float32)
            if k == 1:
                self.unseen = (self.back[0][0] + np.log(floor)).astype(np.float32)

    def _look(self, columns: list[np.ndarray]) -> np.ndarray:
        """Log-probability, under every language, of each row's last character behind the others."""
        total = np.zeros((len(columns[0]), len(self.languages)), np.float32)
        left = np.arange(len(columns[0]))
        for k in range(len(columns), 0, -1):
            own = [c[left] for c in columns[len(columns) - k :]]
            key = _hash(own)
            row = np.minimum(np.searchsorted(self.keys[k], key), len(self.keys[k]) - 1)
            hit = self.keys[k][row] == key
            total[left[hit]] += self.logp[k][row[hit]]
            left = left[~hit]
            if not len(left):
                break
            if k == 1:
                total[left] += self.unseen
                break
            key = _hash([c[~hit] for c in own[:-1]])
            row = np.minimum(np.searchsorted(self.back_keys[k - 1], key), len(self.back_keys[k - 1]) - 1)
            known = self.back_keys[k - 1][row] == key
            total[left[known]] += self.back[k - 1][row[known]]
        return total

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word its log-probability under every language, and its characters (the end counts as one)."""
        codes, ends = _codes(words)
        sizes = np.diff(ends, prepend=0) - (ORDER - 1)
        places = np.ones(len(codes), bool)
        begins = ends - sizes - (ORDER - 1)
        for i in range(ORDER - 1):
            places[begins + i] = False
        at = np.flatnonzero(places)
        total = self._look([codes[at - ORDER + 1 + i] for i in range(ORDER)])
        return np.add.reduceat(total, np.concatenate(([0], np.cumsum(sizes)[:-1]))), sizes


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows of docs (lang, text), counted in each task before the shuffle."""

    def run(batches):
        counts: dict[str, Counter] = {}

        def out():
            rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            counts.clear()
            for a in range(0, len(rows), 50_000):
                lang, word, n = zip(*rows[a : a + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())], ["lang", "word", "n"])

        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                for lang, text in zip(langs[a:b], texts[a:b], strict=True):
                    counts.setdefault(lang, Counter()).update(words_of(text or ""))
                if sum(map(len, counts.values())) > CACHE:
                    yield from out()
        yield from out()

    return docs.select(F.col("lang").cast("string"), "text").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _grams(batches):
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
        for lang in sorted(set(langs)):
            own = np.flatnonzero(langs == lang)
            c: Counter = Counter()
            for i in own:
                padded = START * (ORDER - 1) + words[i] + END
                for j in range(len(padded) - ORDER + 1):
                    c[padded[j : j + ORDER]] += n[i]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(list(c), pa.string()), pa.array([int(x) for x in c.values()], pa.int64())], ["lang", "gram", "n"])


def _by_language(rows: DataFrame, languages: list[str], k: int) -> list[tuple[np.ndarray, ...]]:
    """Of rows (lang, gram, numbers) each language's code points, a row for each n-gram of k characters, and its numbers."""
    table = rows.toArrow()
    lang = pc.index_in(table.column("lang"), pa.array(languages)).to_numpy()
    codes = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer("".join(c.to_pylist()).encode("utf-32-le"), np.uint32) for c in table.column("gram").chunks)]).reshape(-1, k)
    numbers = [table.column(c).to_numpy() for c in table.column_names[2:]]
    return [tuple(x[lang == i] for x in (codes, *numbers)) for i in range(len(languages))]


def _most_shared(level: DataFrame, most: int) -> DataFrame:
    """(gram): about `most` n-grams at most, those of the highest share in any language, to an eighth of a power of two."""
    total = level.groupBy("lang").agg(F.sum("n").alias("total"))
    step = level.join(F.broadcast(total), "lang").groupBy("gram").agg(F.floor(8 * F.log2(F.max(F.col("n") / F.col("total")))).cast("int").alias("step"))
    sizes = sorted(((r.step, r["count"]) for r in step.groupBy("step").count().collect()), reverse=True)
    lowest, held = sizes[0]
    for at, size in sizes[1:]:
        held += size
        if held > most:
            break
        lowest = at
    return step.filter(F.col("step") >= lowest).select("gram")


def _prune(grams: DataFrame, languages: list[str], most: int) -> Pruned:
    out = Pruned({}, {}, {}, 0)
    level = grams
    for k in range(ORDER, 0, -1):
        rare = {r.lang: (r.ones, r.twos) for r in level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()}
        out.rare[k] = [rare[x] for x in languages]
        context = F.substring("gram", 1, k - 1).alias("context")
        totals = level.groupBy("lang", context).agg(F.sum("n").alias("total"))
        size = level.select("gram").distinct().count()
        kept = level.join(_most_shared(level, most), "gram", "left_semi") if size > most else level
        own = _by_language(kept.select("lang", "gram", "n", context).join(totals, ["lang", "context"]).select("lang", "gram", "n", "total"), languages, k)
        out.levels[k], out.totals[k] = [(g, n) for g, n, _ in own], [t for *_, t in own]
        if k == 1:
            out.alphabet = size + 1
        else:
            level = cut(level.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(F.count("*").alias("n")))
    return out


def learn(docs: DataFrame, cells: int | None = None) -> tuple[Model | None, dict[str, tuple[float, float]]]:
    """The model of docs (lang, text) and, for each language, mean and deviation of bits a character by word; None without words. With `cells` the model may hold fewer n-grams, see above."""
    counts = cut(word_counts(docs.filter("lang is not null and text is not null")))
    grams = cut(counts.mapInArrow(_grams, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    languages = sorted(r.lang for r in grams.select("lang").distinct().collect())
    if not languages:
        return None, {}
    most = None if cells is None else max(1, cells // len(languages))
    if most is None or grams.select("gram").distinct().count() <= most:
        own = _by_language(grams, languages, ORDER)
        model = Model(languages, [g for g, _ in own], [n for _, n in own])
    else:
        model = Model(languages, [], [], _prune(grams, languages, most))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def bits(batches):
        for batch in batches:
            words = batch.column(1).to_pylist()
            if not words:
                continue
            scores, sizes = shared.value.score(words)
            own = scores[np.arange(len(words)), [shared.value.languages.index(x) for x in batch.column(0).to_pylist()]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(-own.astype(float) / math.log(2)), pa.array(sizes, pa.int64())], ["lang", "n", "bits", "size"])

    scored = counts.filter(F.col("lang").isin(languages)).mapInArrow(bits, "lang string, n long, bits double, size long")
    n_, b, s = F.col("n"), F.col("bits"), F.col("size")
    moments = scored.groupBy("lang").agg(F.sum(n_ * b).alias("b"), F.sum(n_ * s).alias("s"), F.sum(n_).alias("w"), F.sum(n_ * b * b).alias("bb"), F.sum(n_ * b * s).alias("bs"), F.sum(n_ * s * s).alias("ss")).collect()
    spread = {}
    for r in moments:
        mean = r.b / r.s  # bits a character; a word's bits differ from mean * size by a deviation
        spread[r.lang] = (mean, math.sqrt(max(0.0, (r.bb - 2 * mean * r.bs + mean * mean * r.ss) / r.w)) * r.w / r.s)
    return model, spread


def classify(docs: DataFrame, model: Model | None, spread: dict[str, tuple[float, float]]) -> DataFrame:
    """(doc_id, lang_pred, score, bits, rejected) for each row of docs (doc_id, text; other columns are ignored).

    A null text, or one without a letter, is `und` with score 0, rejected. So is every text if nothing could be learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, spread))

    def run(batches):
        model, spread = shared.value
        cache: dict[str, int] = {}
        table, sizes = np.zeros((0, 0), np.float32), np.zeros(0, np.int64)
        for batch in batches:
            texts, rows = batch.column(1).to_pylist(), []
            for a, b in chunks(texts):
                found = [words_of(t) if t and model else [] for t in texts[a:b]]
                new = list(set().union(*found).difference(cache))
                if new:
                    if len(cache) + len(new) > CACHE:
                        cache, new = {}, list(set().union(*found))
                    scores, n = model.score(new)
                    base = len(cache)
                    table = np.concatenate((table[:base], scores)) if base else scores
                    sizes = np.concatenate((sizes[:base], n)) if base else n
                    cache.update(zip(new, range(base, base + len(new)), strict=True))
                for words in found:
                    if not words:
                        rows.append(("und", 0.0, None, True))
                        continue
                    at = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
                    entropy = -table[at].sum(0, dtype=np.float64) / sizes[at].sum()
                    best = int(entropy.argmin())
                    score = 1.0 / np.exp(np.maximum(-700, (entropy[best] - entropy) * len(words))).sum()
                    bits = float(entropy[best] / math.log(2))
                    mean, deviation = spread.get(model.languages[best], (bits, 0.0))
                    rows.append((model.languages[best], float(score), bits, bits > mean + REJECT_BITS + REJECT_DEVIATIONS * deviation / math.sqrt(len(words))))
            lang, score, bits, rejected = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "bits", "rejected"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, bits double, rejected boolean")


def language_id(docs: DataFrame) -> DataFrame:
    """classify() by a model of the rows of docs (doc_id, text, lang) outside the held-out fold (crc32 of the id modulo 4 is 2), and held_out.

    Rows without a doc_id, text or lang teach nothing; a row without a doc_id is not held out.
    """
    model, spread = learn(docs.filter(crc_fold() != 2).select("lang", "text"))
    return classify(docs, model, spread).withColumn("held_out", F.coalesce(crc_fold() == 2, F.lit(False)))
