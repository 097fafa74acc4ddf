r"""Line dedup by pairwise alignment.

Lines are compared without case and outer white space.  The rare hashes that bring documents together
are not of single lines, of which one may be in a third of all documents, but of the shortest runs of
adjacent lines with at least ``min_words`` words, those that lose them without their last or without
their first line; a text has two to a line at most.  Of every such run the document of least id that has
it is its first holder; a later document is aligned with the first holders of its runs, so the pairs
grow with the lines, never with the square of a group, and no run is too common to count.  Every block
of enough words is covered by the shortest runs inside it, so whatever document shares it, it is found.

Two documents are aligned by patience diff: lines unique to both sides anchor (a line repeated within
a document by its n-th occurrence), the longest increasing run of anchors stands, and gaps are
aligned in turn.  Runs of aligned lines with at least ``min_words`` words are deleted from the later
document, and so are those that the earlier one has in another place or once for several.  Of the
documents with a line the first keeps it, so no line is lost from the table.

Defined results: a null text or null id passes unchanged; a text without words has no lines to
share; rows that repeat an id and text are one document and are changed alike; of rows that repeat
an id with different texts each is aligned by itself; equal texts under different ids: the later one
is emptied; other columns pass through.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectext
from .common import attach, cut, map_batches

_NEWLINE = vectext.byte_class((0x0A, 0x0A))


def line_table(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """(id, key of the text, line hashes (0: no word), words a line, hashes of the shortest runs)."""

    def batch(b: pa.RecordBatch):
        for first, end, data, offsets in vectext.chunks(b.column(2)):
            hashes, counts, sizes = lines(data, offsets)
            at = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            starts, ends = shortest_runs(counts, sizes, min_words)
            runs = vectext.span_hashes(np.arange(len(hashes)), starts, ends, vectext.mix(hashes))
            of = np.searchsorted(starts, at).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0)[first:end],
                    b.column(1)[first:end],
                    pa.ListArray.from_arrays(pa.array(at), pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(counts, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(of), pa.array(runs.view(np.int64))),
                ],
                ["doc", "key", "hashes", "words", "runs"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    known = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    return map_batches(known, batch, f"doc {kind}, key long, hashes array<long>, words array<int>, runs array<long>")


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and word counts of all \\n-split lines of a chunk, and lines of each text."""
    breaks = np.flatnonzero(data == 10)
    sizes = np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]) + 1
    # every text's first line starts where the text does, every other line behind a newline
    ends_of = np.cumsum(sizes)
    starts = np.empty(int(ends_of[-1]) if len(sizes) else 0, np.int64)
    first = ends_of - sizes
    inner = np.ones(len(starts), bool)
    inner[first] = False
    starts[first] = offsets[:-1]
    starts[inner] = breaks + 1
    w, e, _ = vectext.word_spans(data, offsets, vectext.SPACE)
    owner = np.searchsorted(starts, w, "right") - 1
    counts = np.bincount(owner, minlength=len(starts)) if len(w) else np.zeros(len(starts), np.int64)
    hashes = np.zeros(len(starts), np.uint64)
    has = np.flatnonzero(counts)
    if len(has):
        upto = np.cumsum(counts)
        hashes[has] = vectext.span_hashes(data, w[(upto - counts)[has]], e[upto[has] - 1])
        hashes[has] |= np.uint64(1)
    return hashes, counts, sizes


def shortest_runs(counts: np.ndarray, sizes: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, by start, of the shortest runs of texts of ``sizes`` lines: from every line
    with a word to the nearest end, and to every such line from the nearest start."""
    least = max(min_words, 1)
    upto = np.concatenate(([0], np.cumsum(counts)))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    has = np.flatnonzero(counts)
    text = np.searchsorted(bounds, has, "right") - 1
    ends = np.searchsorted(upto, upto[has] + least)
    starts = np.searchsorted(upto, upto[has + 1] - least, "right") - 1
    down, up = ends <= bounds[text + 1], starts >= bounds[text]
    both = np.unique(np.stack([np.concatenate((has[down], starts[up])), np.concatenate((ends[down], has[up] + 1))]), axis=1)
    return both[0], both[1]


def _numbered(values: list[int], low: int, high: int) -> dict[tuple[int, int], int]:
    """(line, its n-th occurrence) to position."""
    seen: dict[int, int] = {}
    out = {}
    for i in range(low, high):
        v = values[i]
        if v:
            seen[v] = n = seen.get(v, 0) + 1
            out[v, n] = i
    return out


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs increasing on both sides (given increasing on the first)."""
    tails, at, back = [], [], [None] * len(pairs)
    for i, (_, j) in enumerate(pairs):
        p = bisect.bisect_left(tails, j)
        back[i] = at[p - 1] if p else None
        if p == len(tails):
            tails.append(j)
            at.append(i)
        else:
            tails[p], at[p] = j, i
    out, i = [], at[-1] if at else None
    while i is not None:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of equal lines, increasing on both sides."""
    out, work = [], [(0, len(a), 0, len(b))]
    while work:
        al, ah, bl, bh = work.pop()
        while al < ah and bl < bh and a[al] == b[bl]:
            out.append((al, bl))
            al, bl = al + 1, bl + 1
        while al < ah and bl < bh and a[ah - 1] == b[bh - 1]:
            ah, bh = ah - 1, bh - 1
            out.append((ah, bh))
        if al == ah or bl == bh:
            continue
        left, right = _numbered(a, al, ah), _numbered(b, bl, bh)
        repeated = {v for side in (left, right) for v, n in side if n > 1}
        anchors = sorted((i, right[k]) for k, i in left.items() if k[0] not in repeated and k in right)
        if not anchors:  # no line is unique on both sides: the n-th occurrences stand for themselves
            anchors = sorted((i, right[k]) for k, i in left.items() if k in right)
        anchors = _increasing(anchors)
        i0, j0 = al, bl
        for i, j in anchors:
            out.append((i, j))
            work.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        if anchors:
            work.append((i0, ah, j0, bh))
    return sorted(out)


def common_lines(earlier: list[int], later: list[int], words: list[int], min_words: int) -> list[int]:
    """Lines of ``later`` in aligned runs of at least ``min_words`` words, or in runs of as many that
    stand in ``earlier`` anywhere."""
    out, run, total, before = [], [], 0, None
    for i, j in [*patience(earlier, later), (-9, -9)]:
        if before != (i - 1, j - 1):
            if total >= min_words:
                out += [x for x in run if later[x]]
            run, total = [], 0
        before = (i, j)
        if j >= 0:
            run.append(j)
            total += words[j]
    here, gone = set(earlier), set(out)
    if any(v and v in here and j not in gone for j, v in enumerate(later)):
        # a line that is not in ``later`` has no words here: no run across it can be one of ``later``
        count = {v: n for v, n in zip(later, words, strict=True) if v}
        known = {tuple(earlier[s:e]) for s, e in _runs([count.get(v, 0) for v in earlier], min_words)}
        for s, e in _runs(words, min_words):
            if tuple(later[s:e]) in known:
                gone.update(j for j in range(s, e) if later[j])
    return sorted(gone)


def _runs(counts: list[int], min_words: int) -> list[tuple[int, int]]:
    starts, ends = shortest_runs(np.array(counts, np.int64), np.array([len(counts)]), min_words)
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def deletions(table: DataFrame, min_words: int) -> DataFrame:
    """(doc, key, deleted: line positions) from a line table."""
    own = table.select("doc", F.explode(F.array_distinct("runs")).alias("run"))
    first = own.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n")).where("first <> last").drop("last")
    pairs = attach(own, cut(first), "run", "first", "doc").where("doc <> first").select("doc", "first").distinct()
    sides = pairs.join(table.select(F.col("doc").alias("first"), F.col("hashes").alias("earlier")), "first").join(table, "doc")

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [common_lines(a, l, w, min_words) for a, l, w in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(rows, pa.list_(pa.int32()))], ["doc", "key", "deleted"])

    kind = table.schema["doc"].dataType.simpleString()
    found = map_batches(sides.select("doc", "key", "earlier", "hashes", "words"), batch, f"doc {kind}, key long, deleted array<int>")
    return found.where(F.size("deleted") > 0).groupBy("doc", "key").agg(F.array_distinct(F.flatten(F.collect_list("deleted"))).alias("deleted"))


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores behind it until no column is called so."""
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 8, count_col: str = "lines_deleted") -> DataFrame:
    """All rows and columns of ``docs``, with common blocks deleted from later documents' texts, and
    ``count_col`` (int; ``free_name`` of it where ``docs`` has such a column, which passes through)."""
    gone = deletions(cut(line_table(docs, id_col, text_col, min_words)), min_words)
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    d = d.withColumns({"_doc": F.col(f"_row.`{id_col}`"), "_key": F.xxhash64(F.col(f"_row.`{text_col}`"))})
    gone = gone.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), F.col("deleted").alias("_deleted"))
    d = d.join(gone, ["_doc", "_key"], "left").withColumn("_lines", F.when(F.col("_deleted").isNotNull(), F.split(F.col(f"_row.`{text_col}`"), "\n", -1)))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_deleted"), lambda i: F.get("_lines", i))
    text = F.when(F.col("_deleted").isNull(), F.col(f"_row.`{text_col}`")).otherwise(F.array_join(kept, "\n"))
    out = [text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return d.select(*out, F.coalesce(F.size("_deleted"), F.lit(0)).alias(free_name(count_col, docs.columns)))
