r"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own embedding (words of the training sample; others share one) beside the mean
embedding of its hashed byte trigrams, so that unknown words are judged by their letters.  A GRU
reads each window of ``window`` words in both directions, attention pools the states, and a logistic
unit scores the window.  A document is scored by the largest logit over all its overlapping windows
(``stride`` words apart, the last one flush with the end: a passage of up to window - stride + 1 words
is whole in one of them), calibrated by logistic regression on texts
that took no part in training, weighted to the classes' true shares.

Training labels hold for documents, not windows: a toxic text is represented by the window that
stands out most, first by word statistics, then by the network itself.

Defined results: a null or empty text is scored as an empty window; with no labelled rows of both
classes the score is the share of toxic labels (0 if none); repeated rows are scored alike; texts
repeated in the labels count as often as they occur; a null label is not learned from; other columns
are ignored.  ``per_class`` and ``most_chars`` bound the labelled texts that the driver trains on.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectext
from .common import cut, map_batches

_NO_WORD = np.uint64(0)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _gates(x):
    """As ``sigmoid``, with less work a number; large arguments are exact either way."""
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Net:
    """Parameters and passes.  ``keys``: sorted hashes of known words; embedding 0 is any other."""

    def __init__(self, keys: np.ndarray, hidden=8, word_dims=8, char_dims=8, buckets=4096, seed=7, dtype=np.float32):
        rng = np.random.default_rng(seed)
        d, h = word_dims + char_dims, hidden
        init = lambda *s, scale=None: (rng.standard_normal(s) * (scale or s[0] ** -0.5)).astype(dtype)
        self.keys, self.hidden, self.buckets = keys, h, buckets
        self.p = {"word": init(len(keys) + 1, word_dims, scale=0.1), "char": init(buckets, char_dims, scale=0.3), "att": init(2 * h), "out": init(2 * h), "bias": np.zeros(1, dtype)}
        for side in "fb":
            self.p |= {f"w{side}": init(d, 3 * h), f"u{side}": init(h, 3 * h), f"c{side}": np.zeros(3 * h, dtype)}

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
        """Of distinct words: embedding rows, trigram buckets of all words, and each word's first."""
        row = np.zeros(len(hashes), np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            row = np.where(self.keys[at] == hashes, at + 1, 0)
        size = ends - starts
        first = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        at = np.repeat(starts, size) + within
        fold = np.arange(256, dtype=np.uint32)
        fold[65:91] += 32
        mid = fold[data[at]]
        before = np.where(within > 0, np.concatenate(([0], mid[:-1])), 1).astype(np.uint32) if len(mid) else mid
        after = np.where(within < np.repeat(size, size) - 1, np.concatenate((mid[1:], [0])), 2).astype(np.uint32) if len(mid) else mid
        code = ((before << np.uint32(16)) | (mid << np.uint32(8)) | after) * np.uint32(2654435761)
        return row, ((code >> np.uint32(12)) % np.uint32(self.buckets)).astype(np.int64), first, size

    def inputs(self, row, bucket, first, size):
        if not len(row):
            return np.zeros((0, self.p["wf"].shape[0]), self.p["word"].dtype)
        chars = np.add.reduceat(self.p["char"][bucket], first, axis=0) / size[:, None].astype(self.p["char"].dtype)
        return np.concatenate([self.p["word"][row], chars], 1)

    def _direction(self, side, projected, index, mask, keep):
        """States of one direction, (time, window, hidden), and what the backward pass needs."""
        p, h = self.p, self.hidden
        steps = index.shape[1]
        state = np.zeros((len(index), h), p["word"].dtype)
        states, saved = np.empty((steps, len(index), h), p["word"].dtype), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            x, g = projected[index[:, t]], state @ p[f"u{side}"]
            gates = _gates(x[:, : 2 * h] + g[:, : 2 * h])
            r, z = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * g[:, 2 * h :])
            after = new + z * (state - new)
            if mask is not None:
                after = np.where(mask[:, t, None], after, state)
            if keep:
                saved.append((t, state, r, z, new, g[:, 2 * h :]))
            states[t] = state = after
        return states, saved

    def forward(self, x, index, mask=None, keep=False):
        """Logits of windows: ``index`` (window, time) into the distinct words' inputs ``x``."""
        p = self.p
        parts = [self._direction(s, x @ p[f"w{s}"] + p[f"c{s}"], index, mask, keep) for s in "fb"]
        states = np.concatenate([parts[0][0], parts[1][0]], 2)
        e = states @ p["att"]
        if mask is not None:
            e = np.where(mask.T, e, -1e9)
        a = np.exp(e - e.max(0))
        a /= a.sum(0)
        if mask is not None:
            a = a * mask.any(1)
        pooled = np.einsum("tb,tbh->bh", a, states)
        return pooled @ p["out"] + p["bias"][0], (states, a, pooled, parts)

    def gradient(self, features, index, mask, labels, weights):
        """Loss and gradients of one batch."""
        p, h = self.p, self.hidden
        x = self.inputs(*features)
        logit, (states, a, pooled, parts) = self.forward(x, index, mask, keep=True)
        prob = sigmoid(logit)
        loss = float(-(weights * (labels * np.log(prob + 1e-12) + (1 - labels) * np.log(1 - prob + 1e-12))).sum())
        d = (weights * (prob - labels)).astype(x.dtype)
        g = {"out": pooled.T @ d, "bias": np.array([d.sum()], x.dtype)}
        dpool = d[:, None] * p["out"]
        da = np.einsum("bh,tbh->tb", dpool, states)
        de = a * (da - (a * da).sum(0))
        g["att"] = np.einsum("tb,tbh->h", de, states)
        dstates = a[:, :, None] * dpool + de[:, :, None] * p["att"]
        dx = np.zeros_like(x)
        for n, side in enumerate("fb"):
            u, du = p[f"u{side}"], np.zeros_like(p[f"u{side}"])
            dproj = np.zeros((len(x), 3 * h), x.dtype)
            carry = np.zeros((len(index), h), x.dtype)
            for t, state, r, z, new, gn in reversed(parts[n][1]):
                dh = carry + dstates[t, :, n * h : (n + 1) * h]
                live = dh if mask is None else dh * mask[:, t, None]
                dn = live * (1 - z) * (1 - new * new)
                dz = live * (state - new) * z * (1 - z)
                dr = dn * gn * r * (1 - r)
                dgate = np.concatenate([dr, dz, dn * r], 1)
                carry = live * z + dgate @ u.T
                if mask is not None:
                    carry = carry + dh * ~mask[:, t, None]
                du += state.T @ dgate
                np.add.at(dproj, index[:, t], np.concatenate([dr, dz, dn], 1))
            g[f"u{side}"], g[f"w{side}"], g[f"c{side}"] = du, x.T @ dproj, dproj.sum(0)
            dx += dproj @ p[f"w{side}"].T
        row, bucket, _, size = features
        dims = p["word"].shape[1]
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], row, dx[:, :dims])
        np.add.at(g["char"], bucket, np.repeat(dx[:, dims:] / size[:, None].astype(x.dtype), size, axis=0))
        return loss, g


def window_starts(n: int, window: int, stride: int) -> np.ndarray:
    """Starts of all overlapping windows of an n-word text."""
    if n <= window:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - window, stride)
    return np.append(starts, n - window)


class Model:
    def __init__(self, net: Net | None, window: int, slope: float, offset: float, stride: int = 6):
        self.net, self.window, self.slope, self.offset, self.stride = net, window, slope, offset, stride

    def text_logits(self, column: pa.Array) -> np.ndarray:
        """The largest window logit of each text."""
        out = np.empty(len(column), np.float64)
        for first, end, data, offsets in vectext.chunks(column, 1 << 20):
            starts, ends, bounds = vectext.word_spans(data, offsets, vectext.PUNCT)
            hashes, sample, inverse = np.unique(vectext.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
            x = self.net.inputs(*self.net.words(data, starts[sample], ends[sample], hashes))
            counts = np.diff(bounds)
            out[first:end] = self.net.p["bias"][0]
            full = np.flatnonzero(counts >= self.window)
            if len(full):
                rel = [window_starts(int(counts[d]), self.window, self.stride) for d in full]
                begin = np.concatenate([r + bounds[d] for r, d in zip(rel, full, strict=True)])
                logits = np.concatenate([self.net.forward(x, inverse[begin[i : i + 2048, None] + np.arange(self.window)])[0] for i in range(0, len(begin), 2048)])
                size = np.array([len(r) for r in rel])
                out[first + full] = np.maximum.reduceat(logits, np.cumsum(size) - size)
            short = np.flatnonzero((counts > 0) & (counts < self.window))
            for i in range(0, len(short), 2048):
                part = short[i : i + 2048]
                mask = np.arange(self.window) < counts[part][:, None]
                at = np.where(mask, bounds[:-1][part][:, None] + np.arange(self.window), 0)
                out[first + part] = self.net.forward(x, inverse[at], mask)[0]
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(column), self.offset)
        return sigmoid(self.slope * self.text_logits(column) + self.offset)


class _Sample:
    """Words of the training texts."""

    def __init__(self, texts: list[str]):
        self.data, self.offsets = vectext.buffers(pa.array(texts, pa.string()))
        self.starts, self.ends, self.bounds = vectext.word_spans(self.data, self.offsets, vectext.PUNCT)
        self.keys, self.at, self.inverse = np.unique(vectext.span_hashes(self.data, self.starts, self.ends), return_index=True, return_inverse=True)


def _adam(net: Net, features, windows, masks, labels, weights, epochs, rate, seed):
    rng, m, v, step = np.random.default_rng(seed), {}, {}, 0
    row, bucket, first, size = features
    batch = int(np.clip(len(windows) // 24, 32, 256))
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            b = order[i : i + batch]
            used, index = np.unique(windows[b], return_inverse=True)
            own = size[used]
            pick = np.repeat(first[used], own) + np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            _, g = net.gradient((row[used], bucket[pick], np.cumsum(own) - own, own), index.reshape(windows[b].shape), masks[b], labels[b], weights[b] / weights[b].sum())
            step += 1
            for k, d in g.items():
                m[k] = 0.9 * m.get(k, 0) + 0.1 * d
                v[k] = 0.999 * v.get(k, 0) + 0.001 * d * d
                net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(net.p[k].dtype)


def train(texts: list[str], labels: np.ndarray, shares: tuple[float, float], window: int = 24, most_words: int = 20_000, rounds: int = 3, epochs: int = 8, rate: float = 0.01, seed: int = 7) -> Model:
    """Fit the network to labelled texts.  ``shares``: rows in all that a text of class 0, 1 stands for."""
    labels = np.asarray(labels)
    held = np.random.default_rng(seed).random(len(texts)) < 0.2  # for calibration
    sample = _Sample(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(sample.bounds))
    pairs = np.unique(doc * len(sample.keys) + sample.inverse)
    in_doc, word = pairs // max(len(sample.keys), 1), pairs % max(len(sample.keys), 1)
    fit = ~held[in_doc]
    count = [np.bincount(word[fit & (labels[in_doc] == c)], minlength=len(sample.keys)) + 0.5 for c in (0, 1)]
    n = [max(1, int((labels[~held] == c).sum())) for c in (0, 1)]
    z = (np.log(count[1] / n[1]) - np.log(count[0] / n[0])) / np.sqrt(1 / count[0] + 1 / count[1])
    common = np.argsort(-(count[0] + count[1]), kind="stable")[:most_words]
    del doc, pairs, in_doc, word, fit  # as large as the sample's words
    net = Net(np.sort(sample.keys[common]), seed=seed)
    features = net.words(sample.data, sample.starts[sample.at], sample.ends[sample.at], sample.keys)
    rng = np.random.default_rng(seed + 1)
    model = Model(net, window, 1.0, 0.0)
    sizes = np.diff(sample.bounds)
    use = np.flatnonzero(~held & (sizes > 0))
    starts = [window_starts(int(sizes[d]), window, window // 2) for d in use]
    owner = np.repeat(np.arange(len(use)), [len(x) for x in starts])
    first = np.concatenate(starts) if len(use) else np.empty(0, np.int64)
    head = np.searchsorted(owner, np.arange(len(use) + 1))

    def windows(at):
        d = use[owner[at]]
        place = first[at][:, None] + np.arange(window)
        mask = place < sizes[d][:, None]
        return sample.inverse[np.where(mask, place, 0) + sample.bounds[d][:, None]], mask

    for turn in range(rounds):
        worth = np.empty(len(owner))
        x = net.inputs(*features) if turn else None
        for i in range(0, len(owner), 4096):
            index, mask = windows(np.arange(i, min(i + 4096, len(owner))))
            worth[i : i + 4096] = net.forward(x, index, mask)[0] if turn else np.where(mask, np.maximum(z[index], 0) ** 2, 0).sum(1)
        order = np.lexsort((-worth, owner))
        chosen = [order[head[:-1]], rng.integers(head[:-1], head[1:])]
        chosen = np.unique(np.concatenate([chosen[0], chosen[1][labels[use] == 0]]))
        y = labels[use[owner[chosen]]].astype(np.float32)
        w = np.where(y > 0, (len(y) - y.sum()) / max(y.sum(), 1), 1.0).astype(np.float32)
        _adam(net, features, *windows(chosen), y, w, epochs, rate / (1 + turn), seed + turn)
    out = np.flatnonzero(held) if len(np.unique(labels[held])) == 2 else np.arange(len(texts))
    logits = model.text_logits(pa.array([texts[i] for i in out], pa.string()))
    model.slope, model.offset = _calibrated(logits, labels[out], np.where(labels[out] > 0, shares[1], shares[0]))
    return model


def _calibrated(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of one variable, by Newton steps, slightly damped."""
    w = w / w.mean()
    beta = np.array([1.0, 0.0])
    f = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        p = sigmoid(f @ beta)
        grad = f.T @ (w * (p - y)) + 0.1 * (beta - [1.0, 0.0])
        hess = (f * (w * p * (1 - p))[:, None]).T @ f + 0.1 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(beta[0]), 0.05), float(beta[1])


def _drawn(labelled: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(id, y) of the ``per_class`` labels of least hash of each class, and all labels of each."""
    sizes = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    least = lambda c: labelled.where(F.col("y") == c).orderBy(F.xxhash64("id"), "id").limit(per_class)
    return least(0).unionByName(least(1)), sizes


def _bounded(rows: DataFrame, most_rows: int, most_chars: int) -> list:
    """Of (y, text, n, h): rows by hash, as many as both bounds allow; a text that would exceed the
    rest of ``most_chars`` is passed over."""
    heads = rows.select("h", "n").orderBy("h", "n").limit(most_rows).collect()
    left, held = most_chars, set()
    for h, group in itertools.groupby(heads, key=lambda r: r["h"]):
        need = sum(r["n"] for r in group)
        if need <= left:
            left -= need
            held.add(h)
    return rows.where(F.col("h").isin(*held)).orderBy("h", "n", "y").limit(most_rows).select("y", "text").collect() if held else []


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 2000, window: int = 24, most_chars: int = 16_000_000) -> Model:
    """Learn from the labelled rows of ``docs``.

    The sample is the ``per_class`` labels of least hash of each class: so few ids that they are sent
    to the texts, which stay where they are.  The driver holds ``most_chars`` characters of them.
    """
    y = labels.where(F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("y"))
    have = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    drawn, sizes = _drawn(y, per_class)
    total = sum(sizes.values())
    rows = have.join(F.broadcast(drawn), "id")  # 2 * per_class ids
    rows = cut(rows.select("y", "text", F.length("text").alias("n"), F.xxhash64("text").alias("h")))
    rows = _bounded(rows, 3 * per_class, most_chars)
    found = np.array([r["y"] for r in rows], np.int64)
    if len(np.unique(found)) < 2:
        return Model(None, window, 0.0, sizes.get(1, 0) / total if total else 0.0)
    shares = tuple(sizes[c] / max(1, int((found == c).sum())) for c in (0, 1))
    return train([r["text"] for r in rows], found, shares, window)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) for every row, from the text alone; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by most_words and buckets

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        s = shared.value.scores(b.column(1))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], [id_col, "score", "predicted"])

    return map_batches(docs.select(id_col, text_col), batch, f"`{id_col}` {kind}, score double, predicted int")
