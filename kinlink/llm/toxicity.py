"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word (a run of letters, lower case) enters as the embedding of its hash plus those of its character n-grams (2 to 5, with marks at
both ends), so unseen words of a known shape are understood. Windows of WIDTH words overlap by WIDTH - STRIDE; each goes through
a GRU in both directions, attention pools the states and a linear layer gives the window's logit. A text's score is the
calibrated logit of its highest window; every window of every text is scored.

Training: of the labelled rows offered, SAMPLE of each class (those of the smallest hash) with all windows of their whole
texts. The label belongs to the text, the evidence to a few windows: after a warm-up on all windows, each epoch trains
on the highest windows of each text under the current network. A fifth of the sample is left for the calibration, which also
undoes the sampling of the classes.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, mix, released
from .language_id import chunks, words_of

WIDTH, STRIDE = 32, 24
SAMPLE = 1500
BUCKETS, DIM, HIDDEN, ATTENTION = 1 << 16, 12, 8, 8
GRAMS = (2, 5)
THRESHOLD = 0.3
CACHE = 150_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def word_features(words: list[str], at_once: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word bucket, n-gram buckets one word after the other, n-grams of each word); n-grams lie in the second half."""
    parts = [_features(words[a : a + at_once]) for a in range(0, len(words), at_once)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    joined = "".join([f"\x02{w}\x03" for w in words])
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    left = ends[owner] - np.arange(len(codes))  # characters up to the word's end
    h = np.zeros(len(codes), np.uint64)
    found, whose = [], []
    for k in range(1, GRAMS[1] + 1):
        n = len(codes) - k + 1
        if n <= 0:
            break
        h = mix(h[:n] * _STEP + codes[k - 1 :])
        if k >= GRAMS[0]:
            fits = left[:n] >= k
            found.append((h[fits] % np.uint64(BUCKETS)).astype(np.int32) + BUCKETS)
            whose.append(owner[:n][fits])
    grams, whose = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    whole = np.add.reduceat(mix(codes * _STEP + (np.arange(len(codes)) - (ends - sizes)[owner]).astype(np.uint64)), ends - sizes)
    return (mix(whole) % np.uint64(BUCKETS)).astype(np.int32), grams[order], np.bincount(whose, minlength=len(words)).astype(np.int32)


class Network:
    """Row 0 of a word table stands for the empty places of a short window."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        normal = lambda *s, scale=None: (r.standard_normal(s) * (scale or 1 / np.sqrt(s[0]))).astype(np.float32)
        self.embed = normal(2 * BUCKETS, DIM, scale=0.01)
        self.dense = {}
        for d in "fb":
            self.dense |= {f"W{d}": normal(DIM, 3 * HIDDEN), f"U{d}": normal(HIDDEN, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.dense |= {"A": normal(2 * HIDDEN, ATTENTION), "c": np.zeros(ATTENTION, np.float32), "v": normal(ATTENTION), "w": normal(2 * HIDDEN), "o": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def words(self, features) -> np.ndarray:
        """A vector for each word."""
        word, grams, many = features
        out = self.embed[word].copy()
        starts = np.concatenate(([0], np.cumsum(many, dtype=np.int64)[:-1]))
        for a in range(0, len(word), 8192):
            b = min(a + 8192, len(word))
            rows = self.embed[grams[starts[a] : starts[b - 1] + many[b - 1]]]
            out[a:b] += np.add.reduceat(rows, starts[a:b] - starts[a]) / np.sqrt(many[a:b, None]).astype(np.float32)
        return out.astype(np.float32, copy=False)

    def inputs(self, vectors: np.ndarray) -> dict[str, np.ndarray]:
        """What each word adds to the gates of either direction, with row 0 in front."""
        vectors = np.concatenate((np.zeros((1, DIM), np.float32), vectors))
        return {d: vectors @ self.dense[f"W{d}"] + self.dense[f"b{d}"] for d in "fb"}

    def _run(self, gates: np.ndarray, at: np.ndarray, d: str, keep: bool):
        u, n = self.dense[f"U{d}"], HIDDEN
        h = np.zeros((len(at), n), np.float32)
        states, saved = np.empty((WIDTH, len(at), n), np.float32), []
        for t in range(WIDTH) if d == "f" else range(WIDTH - 1, -1, -1):
            g, x = h @ u, gates[at[:, t]]
            zr = _sigmoid(x[:, : 2 * n] + g[:, : 2 * n])
            z, r = zr[:, :n], zr[:, n:]
            new = np.tanh(x[:, 2 * n :] + r * g[:, 2 * n :])
            if keep:
                saved.append((t, h, z, r, new, g[:, 2 * n :]))
            h = new + z * (h - new)
            states[t] = h
        return states, saved

    def forward(self, inputs: dict[str, np.ndarray], at: np.ndarray, keep: bool = False):
        """Logits of windows of table rows (n by WIDTH)."""
        p = self.dense
        runs = {d: self._run(inputs[d], at, d, keep) for d in "fb"}
        both = np.concatenate((runs["f"][0], runs["b"][0]), axis=2)
        a = np.tanh(both @ p["A"] + p["c"])
        e = a @ p["v"] - 1e4 * (at.T == 0)
        e = np.exp(e - e.max(0))
        share = e / e.sum(0)
        pooled = (share[:, :, None] * both).sum(0)
        logit = pooled @ p["w"] + p["o"][0]
        return (logit, (runs, both, a, share, pooled)) if keep else logit

    def backward(self, at: np.ndarray, vectors: np.ndarray, saved, dlogit: np.ndarray):
        """Gradients of the dense parameters, and of the words' vectors."""
        p, n = self.dense, HIDDEN
        runs, both, a, share, pooled = saved
        grad = {"w": pooled.T @ dlogit, "o": np.array([dlogit.sum()], np.float32)}
        dpooled = dlogit[:, None] * p["w"]
        dboth = share[:, :, None] * dpooled
        dshare = (both * dpooled).sum(2)
        de = share * (dshare - (share * dshare).sum(0))
        grad["v"] = np.tensordot(de, a, ((0, 1), (0, 1)))
        da = de[:, :, None] * p["v"] * (1 - a * a)
        grad["A"], grad["c"] = np.tensordot(both, da, ((0, 1), (0, 1))), da.sum((0, 1))
        dboth += da @ p["A"].T
        dvectors = np.zeros_like(vectors)
        words = at.T.reshape(-1)
        order = np.argsort(words, kind="stable")
        edges = np.flatnonzero(np.diff(words[order], prepend=-1))
        inputs = vectors[words]
        spread = np.zeros_like(inputs)
        for i, d in enumerate("fb"):
            u, w = p[f"U{d}"], p[f"W{d}"]
            du = np.zeros_like(u)
            dxs = np.empty((WIDTH, len(at), 3 * n), dboth.dtype)
            dh = np.zeros((len(at), n), dboth.dtype)
            for t, h, z, r, new, g in reversed(runs[d][1]):
                dh = dh + dboth[t][:, i * n : (i + 1) * n]
                dnew = dh * (1 - z) * (1 - new * new)
                dx = np.concatenate((dh * (h - new) * z * (1 - z), dnew * g * r * (1 - r), dnew), axis=1)
                dxs[t] = dx
                dx[:, 2 * n :] *= r
                du += h.T @ dx
                dh = dh * z + dx @ u.T
            flat = dxs.reshape(-1, 3 * n)
            grad |= {f"U{d}": du, f"b{d}": flat.sum(0), f"W{d}": inputs.T @ flat}
            spread += flat @ w.T
        dvectors[words[order[edges]]] = np.add.reduceat(spread[order], edges)
        return grad, dvectors


def windows_of(numbers: np.ndarray) -> np.ndarray:
    """All overlapping windows of a text's word numbers (0 fills a short one); an empty text has one empty window."""
    n = len(numbers)
    if n <= WIDTH:
        out = np.zeros((1, WIDTH), numbers.dtype)
        out[0, :n] = numbers
        return out
    starts = np.append(np.arange(0, n - WIDTH, STRIDE), n - WIDTH)
    return numbers[starts[:, None] + np.arange(WIDTH)]


def train(texts: list[str], labels: np.ndarray, prior: float, epochs: int = 9, seed: int = 7) -> Network:
    """A network for these texts; prior is the share of label 1 among all labelled rows."""
    r = np.random.default_rng(seed)
    net = Network(seed)
    split = [words_of(t or "") for t in texts]
    vocabulary = {w: i + 1 for i, w in enumerate(sorted(set().union(*split)))}
    features = word_features(list(vocabulary)) if vocabulary else None
    parts, owner = [], []
    for i, ws in enumerate(split):
        every = windows_of(np.array([vocabulary[w] for w in ws], np.int32))
        parts.append(every)
        owner += [i] * len(every)
    at, owner = np.concatenate(parts), np.array(owner, np.int32)
    del split, parts
    order = np.lexsort((r.random(len(labels)), labels))
    held = np.zeros(len(labels), bool)
    held[order[::5]] = True
    if features is None:
        net.shift = float(np.log(prior / (1 - prior)))
        return net
    # repetition is no evidence: windows of one to three words of label 0, each repeated, are texts of label 0 as well
    texts_in = len(labels)
    spare = np.unique(at[(labels[owner] == 0) & ~held[owner]])
    spare = r.permutation(spare[spare > 0])[: 2 * len(labels)]
    if len(spare):
        runs = np.stack([np.sort(r.choice(r.choice(spare, r.integers(1, 4)), WIDTH)) for _ in range(len(labels))])
        at, owner = np.concatenate((at, runs)), np.concatenate((owner, np.arange(texts_in, 2 * texts_in)))
        labels, held = np.concatenate((labels, np.zeros(texts_in, labels.dtype))), np.concatenate((held, np.zeros(texts_in, bool)))
    starts = np.concatenate(([0], np.cumsum(features[2], dtype=np.int64)[:-1]))
    moments = {k: [np.zeros_like(x), np.zeros_like(x)] for k, x in net.dense.items()}
    squares = np.full(len(net.embed), 1e-8, np.float32)
    turn = 0

    def logits() -> np.ndarray:
        inputs = net.inputs(net.words(features))
        return np.concatenate([net.forward(inputs, at[a : a + 4096]) for a in range(0, len(at), 4096)])

    def step(rows: np.ndarray) -> None:
        nonlocal turn
        turn += 1
        used, numbered = np.unique(at[rows], return_inverse=True)
        used, numbered = (used[1:], numbered) if used[0] == 0 else (used, numbered + 1)
        numbered = numbered.reshape(len(rows), WIDTH)
        many = features[2][used - 1]
        begin = np.concatenate(([0], np.cumsum(many, dtype=np.int64)[:-1]))
        grams = features[1][np.repeat(starts[used - 1] - begin, many) + np.arange(many.sum())]
        own = (features[0][used - 1], grams, many)
        table = net.words(own)
        logit, saved = net.forward(net.inputs(table), numbered, keep=True)
        y = labels[owner[rows]]
        dlogit = ((_sigmoid(logit) - y) / len(rows)).astype(np.float32)
        grad, dtable = net.backward(numbered, np.concatenate((np.zeros((1, DIM), np.float32), table)), saved, dlogit)
        for k, g in grad.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            net.dense[k] -= (0.01 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
        spread = np.concatenate((dtable[1:], np.repeat(dtable[1:] / np.sqrt(many[:, None]), many, axis=0)))
        where = np.concatenate((own[0], grams))
        order = np.argsort(where, kind="stable")
        where = where[order]
        edges = np.flatnonzero(np.diff(where, prepend=-1))
        rows_, total = where[edges], np.add.reduceat(spread[order], edges)
        squares[rows_] += (total * total).mean(1)
        net.embed[rows_] -= 0.1 * total / np.sqrt(squares[rows_])[:, None]

    learn = np.flatnonzero(~held[owner])
    for epoch in range(epochs):
        if epoch < 2:
            rows = learn
        else:
            now = logits()
            by = np.lexsort((-now, owner))
            first = np.flatnonzero(np.diff(owner[by], prepend=-1))
            rank = np.arange(len(by)) - np.repeat(first, np.diff(np.append(first, len(by))))
            # one window of a text of label 1, up to three of another
            rows = by[(rank < np.where(labels[owner[by]] == 1, 1, 3)) & ~held[owner[by]]]
            ones = rows[labels[owner[rows]] == 1]
            rows = np.concatenate((rows, *[ones] * (len(rows) // max(1, 2 * len(ones)))))
        rows = r.permutation(rows)
        for a in range(0, len(rows), 256):
            step(rows[a : a + 256])
    top = np.full(len(labels), -np.inf)
    np.maximum.at(top, owner, logits())
    net.scale, net.shift = calibrate(top[held], labels[held], prior)
    return net


def calibrate(logit: np.ndarray, y: np.ndarray, prior: float) -> tuple[float, float]:
    """Scale and shift of a logistic fit, each class weighted to its share among all labelled rows."""
    share = y.mean()
    if share in (0.0, 1.0):
        return 1.0, 0.0
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    x = np.stack((np.clip(logit, -12, 12), np.ones_like(logit)), 1)
    goal = np.where(y == 1, 0.98, 0.02)
    theta = np.array([1.0, 0.0])

    def loss(theta: np.ndarray) -> float:
        z = x @ theta
        return float((weight * (np.logaddexp(0, z) - goal * z)).sum() + 0.5 * ((theta - [1, 0]) ** 2).sum())

    for _ in range(100):
        q = _sigmoid(x @ theta)
        gradient = x.T @ (weight * (q - goal)) + (theta - [1, 0])
        step = np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + np.eye(2), gradient)
        while loss(theta - step) > loss(theta) and np.abs(step).max() > 1e-9:
            step = step / 2
        theta = theta - step
    scale, shift = float(max(theta[0], 0.05)), float(theta[1])
    low, high = np.quantile(x[y == 0, 0], 0.995), np.quantile(x[y == 1, 0], 0.03)
    if high > low:  # the classes are apart: the threshold goes to the middle of the gap
        shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - scale * (low + high) / 2)
    return scale, shift


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | float:
    """A network from labels (doc_id, toxic) and the texts of docs; with labels of one class or none, that class's number (0 for none)."""
    labels = labels.filter("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    counts = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return 1.0 if counts.get(1) else 0.0
    chosen = [labels.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("doc_id", "text", "toxic")
    prior = counts[1] / (counts[0] + counts[1])

    def fit(batches):
        """The sample is bounded, so it is one task; the driver only gets the network."""
        table = pa.Table.from_batches(batches, pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("toxic", pa.int32())]))
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending"), ("toxic", "ascending")])
        y = table.column("toxic").to_numpy()
        if len(set(y.tolist())) < 2:
            net = float(y[0]) if len(y) else 0.0
        else:
            texts = table.column("text").to_pylist()
            del table
            net = train(texts, y, prior)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])

    found = rows.repartition(1).mapInArrow(released(fit), "net binary").collect()
    return pickle.loads(found[0].net) if found else 0.0


def score(docs: DataFrame, net: Network | float, keep: bool = False, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for each row of docs (doc_id, text); with keep, the rows of docs that are not predicted toxic.

    A null, empty or letterless text is one empty window. Rows are scored one by one, so repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    where, key = docs.columns.index("text"), docs.columns.index("doc_id")

    def scores(texts: list[str | None], state: dict) -> np.ndarray:
        net = shared.value
        if isinstance(net, float):
            return np.full(len(texts), net)
        out = np.empty(len(texts))
        for a, b in chunks(texts, 1 << 19):
            split = [words_of(t or "") for t in texts[a:b]]
            cache = state["cache"]
            new = list(set().union(*split).difference(cache))
            if len(cache) + len(new) > CACHE and cache:
                cache.clear()
                state["rows"] = state["empty"]
                new = list(set().union(*split))
            if new:
                base = len(cache) + 1
                fresh = net.inputs(net.words(word_features(new)))
                state["rows"] = {d: np.concatenate((state["rows"][d], fresh[d][1:])) for d in "fb"}
                cache.update(zip(new, range(base, base + len(new)), strict=True))
            parts = [windows_of(np.fromiter(map(cache.__getitem__, ws), np.int64, len(ws))) for ws in split]
            at = np.concatenate(parts)
            logit = np.concatenate([net.forward(state["rows"], at[i : i + 4096]) for i in range(0, len(at), 4096)])
            out[a:b] = np.maximum.reduceat(logit, np.cumsum([0, *map(len, parts[:-1])]))
        return _sigmoid(net.scale * out + net.shift).round(6)  # what lies below depends on the batch's shape

    def run(batches):
        net = shared.value
        empty = None if isinstance(net, float) else net.inputs(np.zeros((0, DIM), np.float32))
        state = {"cache": {}, "rows": empty, "empty": empty}
        for batch in batches:
            got = scores(batch.column(where).to_pylist(), state)
            if keep:
                yield batch.filter(pa.array(got < threshold))
            else:
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(got), pa.array((got >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.mapInArrow(released(run), docs.schema if keep else f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """score() by a network of the labels outside the held-out fold (crc32 of the id modulo 4 is 2), and held_out (false without an id)."""
    docs = docs.select("doc_id", "text")
    net = learn(docs, labels.filter(crc_fold() != 2))
    return score(docs, net).withColumn("held_out", F.coalesce(crc_fold() == 2, F.lit(False)))
