r"""Sequence packing by Karmarkar-Karp multiway differencing.

Texts are tokenised on the executors and packed there, without a shuffle: each task streams its
documents, cuts full sequences off long ones as it goes, and gathers what is left, in pieces of at
most ``piece_tokens``, into blocks of about ``block_windows`` sequences.  In a block, partial
partitions are merged, the two of widest spread first and largest sums against smallest, until one
k-way partition with near-equal windows is left.  If a window exceeds the capacity, k rises and the
differencing starts again.  Memory is one Arrow batch, one block (``block_items`` pieces at most), the
ids of one text and a piece cache bounded in bytes; texts longer than ``chunk_bytes`` are tokenised in
parts that end where pieces do, whole.

Tokenising: a text is cut where the tokenizer's own splitting always cuts (around a single space or
newline between two visible characters), so that whole pieces can be looked up by hash; pieces not
seen before go to the tokenizer.  Strings of special tokens in a text are ordinary text.

Defined results: a null or empty text is the end id alone; repeated rows are packed each; a null id
stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import vectext

COLUMNS = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


#: How a byte-level BPE without options splits text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def merger(tokenizer_path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizers file on an engine with less overhead for short strings.

    Its ids are those of ``tokenizers`` (tests compare them): merges apply in the order of ids.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        whole = json.load(f)
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    ranks = {bytes(byte[c] for c in token): i for token, i in whole["model"]["vocab"].items() if all(c in byte for c in token)}
    for t in whole["added_tokens"]:
        ranks.pop(t["content"].encode(), None)
    return tiktoken.Encoding("merger", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Token ids of many texts at once, through a cache of pieces (hash to ids).

    The cache holds ``most_pieces`` pieces and ``most_ids`` ids (together under 40 MB), in storage that
    is allocated once; when either is full it is emptied, and the pieces of a single chunk that would
    not fit even then are not kept.
    """

    def __init__(self, tokenizer_path: str, most_pieces: int = 1 << 20, most_ids: int = 1 << 22):
        self.encode_piece = merger(tokenizer_path).encode_ordinary
        self.most = most_pieces
        self.store = np.empty(most_ids, np.uint32)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.first, self.size = np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.held = 0

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.encode_piece(p) for p in pieces]
        size = np.array([len(x) for x in ids], np.int32)
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _learn(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        first = (self.held + np.cumsum(size) - size).astype(np.int32)
        self.store[self.held : self.held + len(ids)] = ids
        self.held += len(ids)
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.size = np.insert(self.keys, at, keys), np.insert(self.first, at, first), np.insert(self.size, at, size)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, and the bounds of each text's."""
        starts, bounds = pieces(data, offsets)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        keys, sample, inverse = np.unique(vectext.span_hashes(data, starts, ends, vectext.CODES), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != keys[inside]
        store, first, size = self.store, np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[~new], size[~new] = self.first[at[~new]], self.size[at[~new]]
        if new.any():
            more, sizes = self._encoded([data[starts[i] : ends[i]].tobytes().decode() for i in sample[new]])
            size[new] = sizes
            if len(self.keys) + len(sizes) <= self.most and self.held + len(more) <= len(store):
                first[new] = self.held + np.cumsum(sizes) - sizes
                self._learn(keys[new], more, sizes)
            else:  # too many: this chunk's ids alone, and the cache begins anew with its new pieces
                old = ~new
                known = store[np.repeat(first[old] - (np.cumsum(size[old]) - size[old]), size[old]) + np.arange(int(size[old].sum()))]
                first[old] = len(more) + np.cumsum(size[old]) - size[old]
                first[new] = np.cumsum(sizes) - sizes
                store = np.concatenate([more, known])
                self._forget()
                if len(sizes) <= self.most and len(more) <= len(self.store):
                    self._learn(keys[new], more, sizes)
        size, first = size[inverse], first[inverse]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = store[np.repeat(first - total[:-1], size) + np.arange(total[-1])]
        return ids, total[bounds]


def parts_of(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """A text in parts of about ``most`` bytes, cut only where pieces begin."""
    at = 0
    while at < len(data):
        reach = most
        while True:
            # a piece's start depends on its neighbours, so the last bytes of a reach do not count
            part = data[at : at + reach]
            starts = pieces(part, np.array([0, len(part)]))[0] if at + reach < len(data) else None
            if starts is None or (starts > 0).any():
                break
            reach *= 2
        end = len(data) if starts is None else at + int(starts[-1])
        yield data[at:end]
        at = end


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pieces of a chunk, and each text's range of them.

    Next to a cut only printable ASCII, two-byte characters but those of lead byte C2, or (behind
    it) lead bytes that begin no white space count as visible.
    """
    n = len(data)
    at = offsets[:-1][np.diff(offsets) > 0]
    if n < 3:
        return at, np.searchsorted(at, offsets)
    visible = (data > 0x20) & (data < 0x7F)
    two = (data >= 0xC3) & (data <= 0xDF)
    ahead = visible | two | (data >= 0xE4)
    behind = visible.copy()
    behind[1:] |= two[:-1]
    gap = np.zeros(n, bool)
    gap[1:-1] = behind[:-2] & ahead[2:]
    edge = at[at > 0]
    gap[edge] = gap[edge - 1] = False  # a text's own first and last characters have no neighbour
    newline = gap & (data == 10)
    start = gap & (data == 32) | newline
    start[1:] |= newline[:-1]
    start[at] = True
    starts = np.flatnonzero(start)
    return starts, np.searchsorted(starts, offsets)


def difference(sizes: np.ndarray, k: int) -> tuple[np.ndarray, list[list[int]]]:
    """Karmarkar-Karp: window sums (descending) and the items of each window.

    A partial partition only holds its windows that are not empty, so all of them together are never
    larger than the items.
    """
    if k == 1:
        return np.array([sizes.sum()]), [list(range(len(sizes)))]
    left, right = [], []  # of merged contents; contents below the number of items are items
    n = len(sizes)
    heap = [(-s, i, [(-s, i)], None) for i, s in enumerate(sizes.tolist())]
    heapq.heapify(heap)

    def opened(sums, held):
        """Window sums and contents; small partitions are lists of (-sum, content)."""
        if held is not None:
            return sums, held
        return np.array([-s for s, _ in sums]), np.array([i for _, i in sums])

    tick = n
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        both = len(a) + len(b) - k  # windows that neither side leaves empty
        if both <= 0 and x is None and y is None:
            sums, held = sorted(a + b), None
            least, most = -sums[-1][0], -sums[0][0]
        else:
            (a, x), (b, y), both = opened(a, x), opened(b, y), max(0, both)
            alone = len(a) - both
            joined = n + len(left) + np.arange(both)
            left += x[alone:].tolist()
            right += y[len(b) - both :][::-1].tolist()
            sums = np.concatenate([a[:alone], a[alone:] + b[len(b) - both :][::-1], b[: len(b) - both]])
            held = np.concatenate([x[:alone], joined, y[: len(b) - both]])
            order = np.argsort(-sums, kind="stable")
            sums, held = sums[order], held[order]
            least, most = int(sums[-1]), int(sums[0])
        heapq.heappush(heap, ((least if len(sums) == k else 0) - most, tick, sums, held))
        tick += 1
    sums, held = opened(*heap[0][2:])
    windows = []
    for content in held.tolist():
        items, stack = [], [content]
        while stack:
            c = stack.pop()
            if c < n:
                items.append(c)
            else:
                stack += (right[c - n], left[c - n])
        windows.append(items)
    return sums, windows


def pack_block(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Windows of items, none over ``capacity``, as near to equal as differencing makes them."""
    if not len(sizes):
        return []
    k = -(-int(sizes.sum()) // capacity)
    while True:
        sums, windows = difference(sizes, k)
        if sums[0] <= capacity:
            return [w for w in windows if w]
        k = max(k + 1, -(-k * int(sums[0] + capacity) // (2 * capacity)))


class Packer:
    """Gathers (document, ids) and gives rows of pieces, block by block."""

    def __init__(self, capacity: int, piece: int, windows: int, items: int, first_id: int):
        self.capacity, self.piece, self.most, self.most_items, self.next = capacity, piece, capacity * windows, items, first_id
        self._clear()

    def _clear(self):
        self.items, self.total = [], 0

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        n, at = len(ids), 0
        while n - at >= self.capacity:
            yield doc, at, self.capacity, n, self.next, 0, ids[at : at + self.capacity].tobytes()
            self.next += 1
            at += self.capacity
        while at < n:
            end = min(n, at + self.piece)
            self.items.append((doc, at, end - at, n, ids[at:end] if n <= self.capacity else ids[at:end].copy()))  # else the whole text's ids would stay
            self.total += end - at
            at = end
            if self.total >= self.most or len(self.items) >= self.most_items:
                yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        for window in pack_block(np.array([x[2] for x in self.items], np.int64), self.capacity):
            offset = 0
            for i in sorted(window):
                doc, start, length, n, ids = self.items[i]
                yield doc, start, length, n, self.next, offset, ids.tobytes()
                offset += length
            self.next += 1
        self._clear()


_encoders: dict[str, Encoder] = {}


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1, piece_tokens: int = 512, block_windows: int = 128, block_items: int = 1 << 14, chunk_bytes: int = 1 << 20) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (little-endian
    unsigned 32-bit).  ``tokenizer_path`` must exist on every executor."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        if tokenizer_path not in _encoders:
            _encoders[tokenizer_path] = Encoder(tokenizer_path)
        encoder, packer = _encoders[tokenizer_path], Packer(capacity, piece_tokens, block_windows, block_items, (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40)
        end, type_ = np.array([end_id], np.uint32), None

        def out(rows):
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], type_), *(pa.array(c, pa.int64()) for c in columns[1:6]), pa.array(columns[6], pa.binary())], [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for b in batches:
            type_ = b.column(0).type
            names = b.column(0).to_pylist()
            for first, last, data, offsets in vectext.chunks(b.column(1), chunk_bytes):
                rows = []
                if last - first == 1 and len(data) > chunk_bytes:
                    parts = [encoder.encode(part, np.array([0, len(part)]))[0] for part in parts_of(data, chunk_bytes)]
                    rows += packer.add(names[first], np.concatenate([*parts, end]))
                else:
                    ids, bounds = encoder.encode(data, offsets)
                    for i in range(last - first):
                        rows += packer.add(names[first + i], np.concatenate([ids[bounds[i] : bounds[i + 1]], end]))
                if rows:
                    yield out(rows)
        if type_ is not None and (rows := list(packer.flush())):
            yield out(rows)

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {COLUMNS}")
