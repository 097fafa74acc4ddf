r"""Language identification by nearest centroid.

A text is a vector of TF-IDF weights over hashed byte trigrams of its lower-cased letters (``dims``
buckets, sublinear counts, unit length).  Document frequencies come from all training texts.  For
each language a spherical k-means over a bounded sample gives several centroids; a text gets the
language of the centroid of largest cosine.  A text whose best cosine is below that language's
rejection radius (a low quantile of its own training texts) is ``rejected``: far from everything
learned.  The score compares the best languages and falls with the distance.

Defined results: a null text, or one without a letter, is ``und`` with score 0; an empty training
table gives ``und`` throughout; repeated rows count as often as they occur; a null label is not
learned from; other columns are ignored.  ``per_language`` bounds the texts that the driver holds.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectext
from .common import map_batches

_LETTER = re.compile(r"[^\W\d_]")
#: Bytes as they count for trigrams: letters (ASCII folded to lower case, all of UTF-8), else a gap.
_FOLD = np.full(256, 0, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    """Whether a text has an alphabetic character (fractions and superscripts are none)."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text or ""))


def trigram_counts(data: np.ndarray, offsets: np.ndarray, dims: int) -> np.ndarray:
    """One row of trigram counts for each text of a chunk."""
    rows = len(offsets) - 1
    out = np.zeros((rows, dims), np.float32)
    if len(data) < 3:
        return out
    f = _FOLD[data].astype(np.uint32)
    code = (f[:-2] << np.uint32(16)) | (f[1:-1] << np.uint32(8)) | f[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(32 - (dims - 1).bit_length())).astype(np.int64)
    live = (f[1:-1] != 0) | ((f[:-2] != 0) & (f[2:] != 0))
    for i in range(rows):
        a, b = offsets[i], max(offsets[i], offsets[i + 1] - 2)
        if b > a:
            out[i] = np.bincount(bucket[a:b][live[a:b]], minlength=dims)
    return out


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def _chunked(column: pa.Array, dims: int):
    """Counts for texts of a column, a few hundred at a time."""
    for first, end, data, offsets in vectext.chunks(column, 1 << 20):
        for a in range(0, end - first, 256):
            b = min(a + 256, end - first)
            yield first + a, first + b, trigram_counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], dims)


def document_frequencies(texts: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """Texts that hold each bucket, and all texts; summed on the executors, ``dims`` rows arrive."""

    def run(batches):
        total, n = np.zeros(dims, np.int64), 0
        for b in batches:
            for first, end, counts in _chunked(b.column(0), dims):
                total += (counts > 0).sum(0)
                n += end - first
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], ["bucket", "n"])

    found = texts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out, n = np.zeros(dims, np.int64), 0
    for r in found:
        if r["bucket"] < 0:
            n = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, n


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids (unit length) from farthest-point starts; deterministic."""
    mean = x.mean(0)
    centres = [mean / max(np.linalg.norm(mean), 1e-9)]
    while len(centres) < min(k, len(x)):
        near = np.max(x @ np.array(centres).T, 1)
        centres.append(x[np.argsort(near, kind="stable")[len(x) // 50]])  # not the very farthest: that is noise
    c = np.array(centres)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, 1)
        sums = np.array([x[own == j].sum(0) if (own == j).any() else c[j] for j in range(len(c))])
        new = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        if np.allclose(new, c, atol=1e-5):
            break
        c = new
    sizes = np.bincount(np.argmax(x @ c.T, 1), minlength=len(c))
    return c[sizes >= max(2, len(x) // 100)] if (sizes >= max(2, len(x) // 100)).any() else c[:1]


class Model:
    def __init__(self, idf, names, centres, owners, radii):
        self.idf, self.names, self.centres, self.owners, self.radii = idf, names, centres, owners, radii

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language numbers, scores and rejections."""
        cosine = unit(counts, self.idf) @ self.centres.T
        best = np.full((len(counts), len(self.names)), -1.0, np.float32)
        for j in range(len(self.names)):
            best[:, j] = cosine[:, self.owners == j].max(1)
        pick = best.argmax(1)
        top = best[np.arange(len(best)), pick]
        weight = np.exp((best - top[:, None]) * 20)
        score = np.clip(np.clip(top, 0, 1) ** 0.5 / weight.sum(1), 0, 1)
        return pick, score, top < self.radii[pick]


def fit(texts: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = 4096, centroids: int = 4, per_language: int = 1500, reject_quantile: float = 0.002) -> Model | None:
    """Learn from ``texts``.  The sample is, of each language, the ``per_language`` texts of least hash
    among those whose hash falls in its share; copies of a text count once in it."""
    t = texts.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    df, n = document_frequencies(t.select("text"), dims)
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    sizes = {r["lang"]: r["count"] for r in t.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(per_language / size)).otherwise(share)
    t = t.withColumn("draw", F.pmod(F.xxhash64("text"), F.lit(1 << 40)))

    def batch(b: pa.RecordBatch):
        draws = b.column(2).to_numpy()
        for first, end, counts in _chunked(b.column(1), dims):
            _, new = np.unique(draws[first:end], return_index=True)  # of copies in a chunk one is enough
            rows = [counts[i] for i in new]
            yield pa.RecordBatch.from_arrays([b.column(0)[first:end].take(pa.array(new)), b.column(2)[first:end].take(pa.array(new)), pa.array([c.astype(np.uint16).tobytes() for c in np.minimum(rows, 65535)], pa.binary())], ["lang", "draw", "counts"])

    rows = map_batches(t.where(F.col("draw") / float(1 << 40) < share), batch, "lang string, draw long, counts binary").toLocalIterator()
    sampled: dict[str, dict[int, np.ndarray]] = {}
    for r in rows:
        own = sampled.setdefault(r["lang"], {})
        if r["draw"] not in own and (len(own) < per_language or r["draw"] < max(own)):
            own[r["draw"]] = unit(np.frombuffer(bytes(r["counts"]), np.uint16)[None, :].astype(np.float32), idf)[0]
            if len(own) > per_language:
                del own[max(own)]
    held = {lang: [own[d] for d in sorted(own)] for lang, own in sampled.items()}
    names = sorted(held)
    if not names:
        return None
    centres, owners, radii = [], [], []
    for j, name in enumerate(names):
        x = np.array(held.pop(name))
        c = spherical_kmeans(x, centroids)
        centres.append(c)
        owners += [j] * len(c)
        radii.append(float(np.quantile((x @ c.T).max(1), reject_quantile)) * 0.9)
    return Model(idf, names, np.concatenate(centres), np.array(owners), np.array(radii, np.float32))


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, rejected) for every row, from the text alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # dims * (centroids + 1) floats

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        texts = b.column(1).to_pylist()
        names, scores, far = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if m is not None:
            lettered = np.array([has_letter(t) for t in texts], bool)
            for first, end, counts in _chunked(b.column(1), len(m.idf)):
                pick, score, rejected = m.predict(counts)
                for i in np.flatnonzero(lettered[first:end]):
                    names[first + i], scores[first + i], far[first + i] = m.names[pick[i]], score[i], rejected[i]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(names), pa.array(scores, pa.float64()), pa.array(far)], [id_col, "lang_pred", "score", "rejected"])

    return map_batches(docs.select(id_col, text_col), batch, f"`{id_col}` {kind}, lang_pred string, score double, rejected boolean")
