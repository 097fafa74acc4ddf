r"""Benchmark decontamination: SimHash of item-sized windows, multi-index blocks, exact verification.

Texts and items are words of letters and digits, lower-cased.  A window can only be similar to an
item if they share a five-word shingle, so windows stand where an item's shingle occurs, aligned as
the shared shingle lies in the item.  Each such window of the item's length is fingerprinted (64-bit
SimHash of its words).  The item fingerprints are indexed by eight 8-bit blocks: two fingerprints
within radius r differ in at most r // 8 bits of some block, and each block's table lists the items
within that many bits of every value, so no fingerprint within the radius is missed.  An item of
whose shingles the whole text has enough weight is a candidate in its windows whatever the
fingerprints say, so the radius loses no item.  Candidates are verified on whole shingle multisets: the weight of the item's shingles found in the window, over the
weight of all the item's shingles (rarer among the items: heavier), must reach ``similarity``.

Items are read in blocks of bounded size, and several blocks are matched with all rows in one scan, so
neither the number of items nor of documents is limited.  Rarity is counted among the items of a block.

Defined results: null and empty texts match nothing; an item of fewer than five words matches a text
that is exactly its words; an empty or null item matches nothing; repeated rows match each; of an
item's windows in one text the most similar, then first, is returned; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectext

_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1)
#: For every number of bits, and every block value, the values within as many bits.
_NEAR = [[np.flatnonzero(_BIT[value ^ np.arange(256)] <= bits).tolist() for value in range(256)] for bits in range(9)]
COLUMNS = "item_id long, similarity double, first_word long, n_words long, start long, end long"


def simhash(hashes: np.ndarray) -> int:
    """64-bit fingerprint of words: per bit, the majority of the words' hash bits."""
    votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


class Index:
    """One block of items."""

    def __init__(self, ids: list[int], texts: list[str], words: int, radius: int, similarity: float):
        self.ids, self.words, self.radius, self.similarity = ids, words, radius, similarity
        data, offsets = vectext.buffers(pa.array(texts, pa.string()))
        starts, ends, bounds = vectext.word_spans(data[offsets[0] : offsets[-1]], offsets - offsets[0], vectext.PUNCT)
        hashes = vectext.span_hashes(data[offsets[0] : offsets[-1]], starts, ends)
        runs, ranges = vectext.shingles(hashes, bounds, words)
        self.length = np.diff(bounds)
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(ranges))
        place = (np.arange(len(runs)) - ranges[owner]).astype(np.int32)
        order = np.lexsort((place, owner, runs))
        self.keys, self.owner, self.place = runs[order], owner[order], place[order]
        distinct, first, same = np.unique(self.keys, return_index=True, return_inverse=True)
        new = np.ones(len(self.keys), np.int64)
        new[1:] = (self.keys[1:] != self.keys[:-1]) | (self.owner[1:] != self.owner[:-1])
        weight = np.log1p(len(ids) / np.add.reduceat(new, first)) if len(distinct) else np.empty(0)
        self.weight = weight[same]
        # the distinct shingles of each item, with counts and weights, one item behind the other
        order = np.lexsort((same, self.owner))
        new = np.ones(len(order), bool)
        new[1:] = (same[order][1:] != same[order][:-1]) | (self.owner[order][1:] != self.owner[order][:-1])
        at = np.flatnonzero(new)
        self.item_keys, self.item_weights = self.keys[order][at], self.weight[order][at]
        self.item_counts = np.diff(np.append(at, len(order))).astype(np.int32)
        self.item_bounds = np.searchsorted(self.owner[order][at], np.arange(len(ids) + 1))
        self.totals = np.bincount(self.owner, self.weight, len(ids))
        # a bit table in front of the exact search: most shingles of a text are no item's
        self.shift = np.uint64(64 - 22)
        self.front = np.zeros(1 << 22, bool)
        self.front[(self.keys >> self.shift).astype(np.int64)] = True
        self.prints: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.length[self.length > 0]):
            own = np.flatnonzero(self.length == size)
            prints = np.array([simhash(hashes[bounds[i] : bounds[i + 1]]) for i in own], np.uint64)
            blocks = prints.astype(">u8").view(np.uint8).reshape(-1, 8)
            # of each block the items by its value, and where each value begins
            listed = np.argsort(blocks, axis=0, kind="stable").astype(np.int32).T
            begins = np.array([np.searchsorted(blocks[listed[b], b], np.arange(257)) for b in range(8)], np.int32)
            self.prints[int(size)] = own, prints, listed, begins

    def within(self, size: int, fingerprint: int) -> np.ndarray:
        """All items of ``size`` words within the radius, by the block tables."""
        own, prints, listed, begins = self.prints[size]
        near = _NEAR[self.radius // 8]
        hit = np.zeros(len(own), bool)
        for b, value in enumerate(fingerprint.to_bytes(8, "big")):
            for v in near[value]:
                if begins[b, v + 1] > begins[b, v]:
                    hit[listed[b, begins[b, v] : begins[b, v + 1]]] = True
        at = np.flatnonzero(hit)
        apart = _BIT[(prints[at] ^ np.uint64(fingerprint)).view(np.uint8).reshape(-1, 8)].sum(1)
        return own[at[apart <= self.radius]]

    def candidates(self, runs: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        at = np.flatnonzero(self.front[(runs >> self.shift).astype(np.int64)])
        if len(at) and len(self.keys):
            pos = np.minimum(np.searchsorted(self.keys, runs[at]), len(self.keys) - 1)
            return at[self.keys[pos] == runs[at]]
        return at[:0]

    def match(self, hashes: np.ndarray, runs: np.ndarray, hits: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Item number to (similarity, first word, words) for one text."""
        n = len(hashes)
        windows: dict[tuple[int, int], set[int]] = {}
        held: dict[int, dict[int, float]] = {}
        for h in hits.tolist():
            a, b = np.searchsorted(self.keys, runs[h], "left"), np.searchsorted(self.keys, runs[h], "right")
            for item, place, weight in zip(self.owner[a:b].tolist(), self.place[a:b].tolist(), self.weight[a:b].tolist(), strict=True):
                size = int(self.length[item])
                if size < self.words:
                    if size == n:
                        windows.setdefault((size, 0), set()).add(item)
                else:
                    windows.setdefault((size, min(max(h - place, 0), max(n - size, 0))), set()).add(item)
                held.setdefault(item, {})[place] = weight
        enough = {item for item, own in held.items() if sum(own.values()) >= self.similarity * self.totals[item] - 1e-9}
        best: dict[int, tuple[float, int, int]] = {}
        for size, start in sorted(windows):
            window = hashes[start : start + size]
            own, count = np.unique(runs[start : start + max(len(window) - self.words + 1, 1)], return_counts=True)
            for item in sorted({*self.within(size, simhash(window)).tolist(), *(windows[size, start] & enough)}):
                a, b = self.item_bounds[item : item + 2]
                _, i, j = np.intersect1d(self.item_keys[a:b], own, assume_unique=True, return_indices=True)
                score = float((self.item_weights[a:b][i] * np.minimum(self.item_counts[a:b][i], count[j])).sum()) / self.totals[item] if self.totals[item] else 0.0
                if score >= self.similarity - 1e-12 and score > best.get(item, (0.0,))[0] + 1e-12:
                    best[item] = (score, start, len(window))
        return best


def item_blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[tuple[list[int], list[str]]]:
    """The items, ``most`` at a time on the driver."""
    ids, texts = [], []
    for r in items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null").toLocalIterator():
        ids.append(r["id"])
        texts.append(r["text"])
        if len(ids) == most:
            yield ids, texts
            ids, texts = [], []
    if ids:
        yield ids, texts


def _found(index: Index, column: pa.Array):
    """(row, item, similarity, first word, words, start, end) of a column's texts."""
    for first, _, data, offsets in vectext.chunks(column):
        starts, ends, bounds = vectext.word_spans(data, offsets, vectext.PUNCT)
        hashes = vectext.span_hashes(data, starts, ends)
        runs, ranges = vectext.shingles(hashes, bounds, index.words)
        hits = index.candidates(runs)
        cuts = np.searchsorted(hits, ranges)
        for d in np.flatnonzero(np.diff(cuts)):
            own = index.match(hashes[bounds[d] : bounds[d + 1]], runs[ranges[d] : ranges[d + 1]], hits[cuts[d] : cuts[d + 1]] - ranges[d])
            for item, (score, at, size) in sorted(own.items()):
                a, b = starts[bounds[d] + at], ends[bounds[d] + at + size - 1]
                head = len(data[offsets[d] : a].tobytes().decode())
                yield first + int(d), index.ids[item], score, at, size, head, head + len(data[a:b].tobytes().decode())


def _scans(docs, items, item_id, item_text, words, radius, similarity, block, blocks):
    """For each scan of the documents the broadcast indexes of up to ``blocks`` blocks of items."""
    sc, held = docs.sparkSession.sparkContext, []
    for ids, texts in item_blocks(items, item_id, item_text, block):
        held.append(sc.broadcast(Index(ids, texts, words, radius, similarity)))  # bounded by ``block`` items
        if len(held) == blocks:
            yield held
            held = []
    if held:
        yield held


def contaminations(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", words: int = 5, similarity: float = 0.8, radius: int = 20, block: int = 20_000, blocks: int = 4) -> DataFrame:
    """One row per document and item whose passage it holds: ids, similarity, words and span (code points).

    A task holds the indexes of ``block`` times ``blocks`` items, some 2 KB each, and reads the texts
    once for as many.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, {COLUMNS}"
    out = None
    for held in _scans(docs, items, item_id, item_text, words, radius, similarity, block, blocks):

        def run(batches, held=held):
            for b in batches:
                rows = [r for shared in held for r in _found(shared.value, b.column(1))]
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(columns[0])), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()), *(pa.array(c, pa.int64()) for c in columns[3:])], [id_col, *[c.split(" ")[0] for c in COLUMNS.split(", ")]])

        part = docs.select(id_col, text_col).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", words: int = 5, similarity: float = 0.8, radius: int = 20, block: int = 20_000, blocks: int = 4) -> DataFrame:
    """The documents that hold no item's passage, all columns as they were; no shuffle."""
    at = docs.columns.index(text_col)
    for held in _scans(docs, items, item_id, item_text, words, radius, similarity, block, blocks):

        def run(batches, held=held):
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for shared in held:
                    keep[[r[0] for r in _found(shared.value, b.column(at))]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
