r"""N-gram Jaccard join by PartEnum signatures, exact at the threshold.

A document's set is its distinct five-word shingles.  Sets of sizes a <= c with Jaccard similarity
t differ in at most (a + c)(1 - t)/(1 + t) shingles, and c <= a/t.  Sizes fall into bands of ratio
1/t; a set joins its own band and the next, so similar sets meet in a band.  In a band whose sets
differ in at most k shingles, the domain is cut into n > k parts by hash; a set that differs from
its similar sets in at most h <= k shingles agrees with them in at least n - h parts.  If more than
h of its parts hold two shingles or more, one of those parts agrees: their projections are its
signatures (a frequent line or passage then makes no signature of one common shingle).  Otherwise
it also signs with its parts of one shingle, and if n - h parts or more are empty, with its prefix
(the size - ceil(t size) + 1 least shingles): two such sets share one of those if they are similar.
No link is lost.

Equal sets are one node.  Signatures travel in binary blocks, 7 bytes each.  Sets with a signature
in common form a bucket; each bucket's first document is compared with the others (pairs grow with
the rows, not their square).  Buckets that then still hold several components are searched for pairs
between components; a parity sketch, whose distance never exceeds that of the sets, rules out nearly
all of them without texts.  Where many are left for each member, only the pairs of a few spanning
forests of the bucket's components are verified in a round, so they too grow with the rows; such buckets
are searched again with the components that then are left, and after ``rounds`` rounds all remaining
pairs are verified.  A large bucket is searched as pairs of bounded blocks of its members, so that no task
holds it whole.  Every candidate is verified on the whole sets; links
become components by large-star/small-star rounds.

Defined results: a null or empty text has no shingles, is linked with nothing and is its own
component; a text of one to four words has its whole sequence as its only shingle; rows that share an
id are one document, whose text is, of those with words, the one of least hash, while ``n_shingles`` is
each row's own; a null id has a null component; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectext
from .common import attach, components, cut, map_batches

_BIT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint16)


class Bands:
    """Bands of sizes, and for each the greatest difference k and the number of parts n."""

    def __init__(self, percent: int):
        self.percent = percent
        self.upper = [0]
        self._plan: dict[int, tuple[int, int]] = {}

    def of(self, size: int) -> int:
        while self.upper[-1] < size:
            self.upper.append((self.upper[-1] + 1) * 100 // self.percent)
        return next(i for i, u in enumerate(self.upper) if u >= size) if len(self.upper) < 8 else int(np.searchsorted(self.upper, size))

    def plan(self, band: int) -> tuple[int, int]:
        if band not in self._plan:
            while len(self.upper) <= band:
                self.upper.append((self.upper[-1] + 1) * 100 // self.percent)
            most = self.upper[band]
            k = 2 * most * (100 - self.percent) // (100 + self.percent)
            n = max(k + 2, -(-135 * (k + 1) // 100))
            self._plan[band] = k, n
        return self._plan[band]

    def reach(self, size: int, band: int) -> int:
        """The greatest difference between a set of ``size`` and a similar one in the band."""
        most = min(self.upper[band], size * 100 // self.percent)
        return (size + most) * (100 - self.percent) // (100 + self.percent)


def sets_of(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    starts, ends, bounds = vectext.word_spans(data, offsets, vectext.SPACE)
    return vectext.distinct(*vectext.shingles(vectext.span_hashes(data, starts, ends), bounds, words))


def sketch(values: np.ndarray, bands: Bands) -> list[bytes]:
    """Parity sketches of a set for its own band and the next: bit = parity of a cell's shingles."""
    out = []
    band = bands.of(len(values))
    for b in (band, band + 1):
        bits = sketch_bits(bands, b)
        cell = (values >> np.uint64(20)) & np.uint64(bits - 1)
        out.append(np.packbits((np.bincount(cell.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes())
    return out


def sketch_bits(bands: Bands, band: int) -> int:
    bands.plan(band)
    return max(512, 1 << (4 * bands.upper[band] // 5).bit_length())


def signatures(values: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures of one set."""
    size, out, risky = len(values), [], False
    band = bands.of(size)
    for b in (band, band + 1):
        k, n = bands.plan(b)
        if not k:
            continue
        x = vectext.mix(values ^ np.uint64((b + 1) * 0x9E3779B97F4A7C15 & vectext._MASK))
        part = ((x >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
        count, h = np.bincount(part, minlength=n), bands.reach(size, b)
        held = count > 1
        if int(held.sum()) <= h:
            held = count > 0
        y = vectext.mix(x)
        low = np.bincount(part, (y & np.uint64(0x3FFFFFF)).astype(np.float64), n)[held]
        high = np.bincount(part, (y >> np.uint64(38)).astype(np.float64), n)[held]
        out.append(vectext.mix(low.astype(np.uint64) * vectext._ORDER[0] + high.astype(np.uint64) * vectext._ORDER[1] + (np.flatnonzero(held) + (b << 40)).astype(np.uint64)))
        risky |= int((count == 0).sum()) >= n - h
    if risky:
        out.append(vectext.mix(values[: size - -(-bands.percent * size // 100) + 1] ^ vectext._ORDER[2]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def set_table(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc, hash of the text, n, key: digest of the set, null if empty; sketches for two bands)."""
    bands = Bands(percent)

    def batch(b: pa.RecordBatch):
        for first, end, data, offsets in vectext.chunks(b.column(1)):
            sets = sets_of(data, offsets, words)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sketches = [sketch(s, bands) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)[first:end], b.column(2)[first:end], pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array([bands.of(len(s)) for s in sets], pa.int32()), *(pa.array([x[i] for x in sketches], pa.binary()) for i in (0, 1))],
                ["doc", "hash", "n", "key", "band", "own", "next"],
            )

    return map_batches(docs.withColumn("hash", F.xxhash64("text")), batch, "doc long, hash long, n long, key binary, band int, own binary, next binary")


def signature_blocks(docs: DataFrame, parts: int, words: int, percent: int) -> DataFrame:
    """(part, ids, sigs, refs) blocks; ``docs`` is (doc, text).

    A task signs each set once, so that a large group of copies costs one document a task.
    """
    bands = Bands(percent)

    def run(batches):
        seen: set[bytes] = set()
        for b in batches:
            for first, end, data, offsets in vectext.chunks(b.column(1)):
                sigs, owners = [], []
                names = np.array(b.column(0)[first:end].to_pylist(), np.int64)
                for i, s in enumerate(sets_of(data, offsets, words)):
                    if not len(s) or (digest := hashlib.blake2b(s.tobytes(), digest_size=16).digest()) in seen:
                        continue
                    seen.add(digest)
                    own = signatures(s, bands)
                    sigs.append(own)
                    owners.append(np.full(len(own), i, np.int64))
                if not sigs:
                    continue
                sig, owner = np.concatenate(sigs), np.concatenate(owners)
                part = ((sig >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                rows = [p for p in range(parts) if cuts[p + 1] > cuts[p]]
                blocks = []
                for p in rows:
                    at = order[cuts[p] : cuts[p + 1]]
                    used, ref = np.unique(owner[at], return_inverse=True)
                    low = (sig[at] & np.uint64((1 << 40) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                    blocks.append((names[used].astype("<i8").tobytes(), low.tobytes(), ref.astype("<u4" if len(used) > 65535 else "<u2").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *(pa.array([x[j] for x in blocks], pa.binary()) for j in range(3))], ["part", "ids", "sigs", "refs"])

    return docs.mapInArrow(run, "part int, ids binary, sigs binary, refs binary")


def _groups(batches, names):
    """Runs of rows of one key (first column, rows sorted by it) as dicts of lists."""
    key, held = None, None
    for b in batches:
        columns = [b.column(i).to_pylist() for i in range(len(names))]
        for row in zip(*columns, strict=True):
            if held is None or row[0] != key:
                if held is not None:
                    yield key, held
                key, held = row[0], [[] for _ in names]
            for x, y in zip(held, row, strict=True):
                x.append(y)
    if held is not None:
        yield key, held


def buckets(blocks: DataFrame, parts: int) -> DataFrame:
    """(bucket, leader, doc) of all sets that share a signature; buckets of equal members are one."""

    def run(batches):
        for _, (_, ids, sigs, refs) in _groups(batches, ("part", "ids", "sigs", "refs")):
            sig, doc = [], []
            for i, s, r in zip(ids, sigs, refs, strict=True):
                names = np.frombuffer(i, "<i8")
                raw = np.zeros((len(s) // 5, 8), np.uint8)
                raw[:, :5] = np.frombuffer(s, np.uint8).reshape(-1, 5)
                sig.append(raw.view("<u8")[:, 0])
                doc.append(names[np.frombuffer(r, "<u4" if len(r) == 4 * len(raw) else "<u2")])
            sig, doc = np.concatenate(sig), np.concatenate(doc)
            order = np.argsort(sig, kind="stable")
            sig, doc = sig[order], doc[order]
            same = sig[1:] == sig[:-1]
            many = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            sig, doc = sig[many], doc[many]
            if not len(sig):
                continue
            order = np.lexsort((doc, sig))
            sig, doc = sig[order], doc[order]
            fresh = np.concatenate(([True], (sig[1:] != sig[:-1]) | (doc[1:] != doc[:-1])))
            sig, doc = sig[fresh], doc[fresh]
            start = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
            size = np.diff(np.append(start, len(sig)))
            members = np.add.reduceat(vectext.mix(doc.view(np.uint64)), start) + size.astype(np.uint64)
            _, pick = np.unique(members, return_index=True)
            pick = pick[size[pick] > 1]
            at = np.repeat(start[pick], size[pick]) + np.arange(int(size[pick].sum())) - np.repeat(np.cumsum(size[pick]) - size[pick], size[pick])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(members[pick].view(np.int64), size[pick])), pa.array(np.repeat(doc[start[pick]], size[pick])), pa.array(doc[at])], ["bucket", "leader", "doc"])

    dealt = blocks.repartition(parts, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "bucket long, leader long, doc long").distinct()


def _far(a: list, b: list, percent: int) -> np.ndarray:
    """Which pairs of (n, band, own, next) can't be similar, by sizes and sketches."""
    out = np.zeros(len(a), bool)
    for i, ((n, p, x0, x1), (m, q, y0, y1)) in enumerate(zip(a, b, strict=True)):
        if min(n, m) * 100 < percent * max(n, m) or abs(p - q) > 1:
            out[i] = True
            continue
        x, y = (x0, y0) if p == q else (x1, y0) if p < q else (x0, y1)
        apart = int.bit_count(int.from_bytes(x, "big") ^ int.from_bytes(y, "big"))
        out[i] = apart * (100 + percent) > (n + m) * (100 - percent)
    return out


_SIDE = ("n", "band", "own", "next")


def _side(sets: DataFrame, name: str) -> DataFrame:
    return sets.select(F.col("doc").alias(name), F.struct(*_SIDE).alias(f"s_{name}"))


def near_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[tuple(x[c] for c in _SIDE) for x in b.column(i).to_pylist()] for i in (2, 3)]
        keep = pa.array(~_far(*rows, percent))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(keep)

    return map_batches(pairs.join(_side(sets, "a"), "a").join(_side(sets, "b"), "b").select("a", "b", "s_a", "s_b"), batch, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    worded = docs.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    texts = worded.join(ids, "doc", "left_semi").dropDuplicates(["doc"])

    def batch(b: pa.RecordBatch):
        known: dict[int, np.ndarray] = {}
        for first in range(0, b.num_rows, 512):
            part = b.slice(first, 512)
            left = part.column(0).to_pylist()
            keep = []
            for i, (a, right) in enumerate(zip(left, _column_sets(part.column(3), words), strict=True)):
                if a not in known:
                    known.clear()  # rows of a pair's first document mostly stand together
                    known[a] = _column_sets(part.column(2)[i : i + 1], words)[0]
                common = len(np.intersect1d(known[a], right, assume_unique=True))
                keep.append(100 * common >= percent * (len(known[a]) + len(right) - common))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    sides = pairs.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("y")), "b")
    return map_batches(sides.select("a", "b", "x", "y"), batch, "a long, b long")


def _column_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    return [s for _, _, data, offsets in vectext.chunks(column) for s in sets_of(data, offsets, words)]


def _forests(u: np.ndarray, v: np.ndarray, order: np.ndarray, most: int) -> tuple[list[int], bool]:
    """Of edges (u, v), taken in ``order``: those of ``most`` forests, each of what the ones before left
    over, and whether any edge is left."""
    chosen, rest = [], order.tolist()
    nodes = len(np.unique(np.concatenate([u, v])))
    u, v = u.tolist(), v.tolist()
    for _ in range(most):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (p := parent.get(x, x)) != x:
                parent[x] = x = parent.get(p, p)
            return x

        left, joined = [], 0
        for at, e in enumerate(rest):
            x, y = root(u[e]), root(v[e])
            if x == y:
                left.append(e)
                continue
            parent[x] = y
            chosen.append(e)
            joined += 1
            if joined == nodes - 1:
                left += rest[at + 1 :]
                break
        rest = left
    return chosen, bool(rest)


def cross_pairs(members: DataFrame, percent: int, parts: int, forests: int = 0, turn: int = 0, dense: int = 8) -> DataFrame:
    """(a, b) pairs of different components in a bucket that sketches don't rule out.

    With ``forests``, of a bucket that has over ``dense`` such pairs a member only those of as many
    spanning forests of its components are returned, so they grow with its members, not their square;
    the bucket is then named in a row (again) of its own.  The first ``turn`` takes the nearest pairs
    first, others any.
    ``members``: (bucket, block, doc, component, n, band, own, next).
    """

    def run(batches):
        told: set[tuple[int, int]] = set()  # similar sets meet in many buckets
        for key, (_, doc, comp, n, band, own, after) in _groups(batches, range(7)):
            edges = []
            doc, comp, n, band = np.array(doc, np.int64), np.array(comp, np.int64), np.array(n), np.array(band)
            for p in np.unique(band):
                # sets of band p with those of p, by p's sketches; with those of p + 1, by p + 1's
                for q, x, y in ((p, own, own), (p + 1, after, own)):
                    i, j = np.flatnonzero(band == p), np.flatnonzero(band == q)
                    if not len(i) or not len(j):
                        continue
                    a = np.stack([np.frombuffer(x[k], np.uint8) for k in i])
                    b = np.stack([np.frombuffer(y[k], np.uint8) for k in j])
                    for r, k in enumerate(i):
                        ok = (comp[j] != comp[k]) & (np.minimum(n[j], n[k]) * 100 >= percent * np.maximum(n[j], n[k]))
                        if q == p:
                            ok &= doc[j] > doc[k]
                        at = np.flatnonzero(ok)
                        if not len(at):
                            continue
                        apart = _BIT[a[r] ^ b[at]].sum(1, dtype=np.int64)
                        near = apart * (100 + percent) <= (n[j[at]] + n[k]) * (100 - percent)
                        if near.any():
                            at = j[at[near]]
                            edges.append((np.full(len(at), k, np.int32), at.astype(np.int32), (apart[near] / (n[at] + n[k])).astype(np.float32)))
            if not edges:
                continue
            i, j, score = (np.concatenate(x) for x in zip(*edges, strict=True))
            more = False
            if forests and len(i) > dense * len(doc):
                order = score if not turn else vectext.mix((doc[i] * 31 + doc[j]).view(np.uint64) + np.uint64(turn))
                chosen, more = _forests(comp[i], comp[j], np.argsort(order, kind="stable"), forests)
                i, j = i[chosen], j[chosen]
            found = set(zip(np.minimum(doc[i], doc[j]).tolist(), np.maximum(doc[i], doc[j]).tolist(), strict=True)) - told
            if len(told) > 1_000_000:
                told.clear()
            told |= found
            rows = [(*x, None) for x in sorted(found)] + [(None, None, key["bucket"])] * more
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["a", "b", "again"])

    key = F.struct("bucket", "block").alias("key")
    dealt = members.select(key, "doc", "component", *_SIDE).repartition(parts, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a long, b long, again long").distinct()


def _blocks(mixed: DataFrame, named: DataFrame, large_bucket: int) -> DataFrame:
    """Members of mixed buckets; a bucket of several blocks is searched as pairs of blocks (i, j)."""
    blocks = F.ceil(F.col("size") / large_bucket).cast("int")
    own = F.pmod(F.xxhash64("doc"), blocks).cast("int")
    spread = mixed.withColumns({"blocks": blocks, "i": own}).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("bucket", F.concat_ws(":", F.least("i", "j"), F.greatest("i", "j")).alias("block"), "doc", "component")
    return spread.join(named.select("doc", *_SIDE), "doc")


def _mixed(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket rows with components, of buckets that hold several."""
    comps = components(links)
    rows = rows.join(comps.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    mixed = rows.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x <> y").select("bucket", "size")
    return rows.join(mixed, "bucket")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, per_part: int = 1_000_000, large_bucket: int = 2000, forests: int = 3, rounds: int = 6) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    ``per_part``: signatures that one task sorts; ``large_bucket``: members that one task holds;
    ``forests``, ``rounds``: how the search between components goes (see ``cross_pairs``).
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sets = cut(set_table(d, words, percent))
    known = d.where(F.col("doc").isNotNull())
    worded = sets.where(F.col("doc").isNotNull() & F.col("key").isNotNull())
    clash = worded.groupBy("doc").agg(F.min("hash").alias("chosen"), F.max("hash").alias("other"), F.count("*").alias("rows")).where("chosen <> other")
    clash = cut(clash.drop("other"))
    if not clash.isEmpty():  # ids of several texts: only one of them takes part
        known = attach(known.withColumn("hash", F.xxhash64("text")), clash, "doc", "chosen", "hash", "rows").where("chosen is null or chosen = hash").select("doc", "text")
        worded = attach(worded, clash, "doc", "chosen", "hash", "rows").where("chosen is null or chosen = hash").drop("chosen")
    total = sets.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-int(total * 0.7) // per_part), min(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 50_000))
    rows = cut(buckets(signature_blocks(known, parts, words, percent), parts))
    named = worded.dropDuplicates(["doc"])
    links = cut(verified(near_pairs(rows.where("leader <> doc").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct(), named, percent), known, words, percent))
    members = rows.drop("leader")
    for turn in range(rounds + 1):
        # in the last turn all pairs that are left, whatever their number
        search = forests if turn < rounds else 0
        found = cut(cross_pairs(_blocks(cut(_mixed(members, links)), named, large_bucket), percent, parts, search, turn))
        more = cut(verified(found.where("a is not null").select("a", "b"), known, words, percent))
        again = found.where("again is not null").select(F.col("again").alias("bucket")).distinct()
        if not search or again.isEmpty():
            links = cut(links.unionByName(more))
            break
        members, links = cut(members.join(again, "bucket", "left_semi")), cut(links.unionByName(more))
    # copies: the least id of equal sets stands for all
    first = cut(named.groupBy("key").agg(F.min("doc").alias("rep"), F.count("*").alias("copies")))
    ends = links.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    of = cut(attach(named.select("doc", "key").join(ends, "doc", "left_semi"), first, "key", "rep", "doc", "copies").select("doc", "rep"))
    edge = links.join(of.select(F.col("doc").alias("a"), F.col("rep").alias("u")), "a").join(of.select(F.col("doc").alias("b"), F.col("rep").alias("v")), "b").where("u <> v").select(F.col("u").alias("a"), F.col("v").alias("b"))
    comps = components(edge).withColumnRenamed("node", "rep")
    classes = cut(first.join(comps, "rep", "left").select("key", "copies", F.coalesce("component", "rep").alias("component")))
    found = attach(named.select("doc", "key"), classes, "key", "component", "doc", "copies").select("doc", "component")
    whole = sets.where(F.col("doc").isNotNull()).select("doc", "n").join(found, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    out = whole.unionByName(sets.where(F.col("doc").isNull()).select("doc", "n", F.col("doc").alias("component")))
    return out.select(F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component stays: that of least id.  Rows with a null id stay."""
    found = similar_components(docs, id_col, text_col, **options)
    gone = found.where(F.col("component_id") < F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])
