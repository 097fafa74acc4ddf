import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import DATA

from brinewake.llm import language_id, packing, queries, toxicity, vectext
from brinewake.llm.common import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", " ", "a", "Hello world, it's  fine.\nNew\n\nline \t tab", "é ü x　y ß z  q", "xé éx", "<|endoftext|> plain", "日本語 テキスト 日本", "😀 😀😀\n😀", "a\r\n b\x1c c\x85 d", "'s 'll don't 12 345x", " lead and trail ", "\n\n\n", "word " * 700]


def test_ids_are_those_of_tokenizers():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    encoder = packing.Encoder(PATH, most_pieces=20)
    rng = np.random.default_rng(0)
    alphabet = list("ab c\n é  .'s1 \t日😀\x85")
    texts = TEXTS + ["".join(rng.choice(alphabet, 25)) for _ in range(300)]
    for size in (1 << 21, 50):
        for first, last, data, offsets in vectext.chunks(pa.array(texts, pa.string()), size):
            ids, bounds = encoder.encode(data, offsets)
            for i in range(last - first):
                assert ids[bounds[i] : bounds[i + 1]].tolist() == t.encode(texts[first + i], add_special_tokens=False).ids, texts[first + i]


def test_long_texts_are_tokenised_in_parts():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    encoder = packing.Encoder(PATH, most_pieces=100, most_ids=300)
    rng = np.random.default_rng(8)
    words = ["a", "été", "\n", "\n\n", " ", "x\u3000y", "日本語", "12", "'s", "word", "ﬁ", "\x85", "😀", "."]
    for join in ("", " "):
        text = join.join(rng.choice(words, 3000))
        raw = np.frombuffer(text.encode(), np.uint8)
        for most in (20, 500, 10**6):
            parts = list(packing.parts_of(raw, most))
            assert np.array_equal(np.concatenate(parts), raw) and (most < 1000) == (len(parts) > 1)
            got = np.concatenate([encoder.encode(p, np.array([0, len(p)]))[0] for p in parts])
            assert got.tolist() == t.encode(text, add_special_tokens=False).ids


def test_packing_query_against_tokenizers(spark):
    """Every row of op4 over its whole table: ids, counts, offsets and sizes from ``tokenizers`` alone."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    want = {r["doc_id"]: np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4") for r in queries.table(spark, DATA, "documents").collect()}
    pieces, used = {}, {}
    for r in queries.op4_packing(spark, DATA).collect():
        ids = want[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, ids in want.items():
        assert _gapless(pieces[i]) == len(ids)
    sizes = [_gapless(x) for x in used.values()]
    assert max(sizes) <= 2048 and sum(sizes) / (2048 * len(sizes)) > 0.9


def _gapless(spans):
    at = 0
    for start, length in sorted(spans):
        assert start == at
        at += length
    return at


def test_many_tiny_items_are_packed_in_bounded_blocks():
    packer = packing.Packer(2048, 512, 128, 1 << 10, 0)
    one = np.array([1], np.uint32)
    rows = [r for i in range(5000) for r in packer.add(i, one)]
    assert len(packer.items) < 1 << 10
    rows += packer.flush()
    assert sorted(r[0] for r in rows) == list(range(5000))


def test_differencing_is_near_equal_and_whole():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 513, 600)
    sums, windows = packing.difference(sizes, 80)
    assert sorted(i for w in windows for i in w) == list(range(600))
    assert sums[0] - sums[-1] < 40
    packed = packing.pack_block(sizes, 2048)
    assert max(int(sizes[w].sum()) for w in packed) <= 2048
    assert len(packed) <= 1.03 * sizes.sum() / 2048 + 1
    assert packing.pack_block(np.array([2048, 2048, 1]), 2048) == [[0], [1], [2]] or len(packing.pack_block(np.array([2048, 2048, 1]), 2048)) == 3


def test_packing_edges(spark, edge, nothing):
    got = packing.pack(edge, PATH).collect()
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == list(np.cumsum([0, *[r["length"] for r in rows]])[:-1])
        assert sum(r["length"] for r in rows) <= 2048
    assert [(r["length"], r["ids"]) for r in got if r["doc_id"] == 1] == [(1, b"\x01\0\0\0")]
    pieces = sorted((r["start"], r["length"]) for r in got if r["doc_id"] == 4)
    assert pieces[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(pieces, pieces[1:], strict=False))
    assert packing.pack(nothing, PATH).count() == 0


@pytest.mark.parametrize("many", [1, 10**6])
def test_components(spark, many):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (7, 9), (20, 30), (30, 40), (40, 50), (50, 60), (60, 70), (5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), many=many).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 4), 1), **dict.fromkeys((7, 8, 9), 7), **dict.fromkeys(range(20, 71, 10), 20)}


def test_language_on_held_out_rows(spark):
    docs = queries.table(spark, DATA, "documents").select("doc_id", "lang")
    got = queries.op8_language_id(spark, DATA).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.95


def test_language_features_and_verdicts_against_plain_loops(spark):
    """Trigrams, weights and the nearest centroid, by dictionaries and lists."""
    import math

    texts = ["Hello, World 12", "été à Paris", "", "a", "日本語のテキスト", "xYz"]
    dims = 512
    (_, _, counts), *_ = language_id._chunked(pa.array(texts), dims)

    def grams(t):
        raw = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in t.encode()]
        out = {}
        for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
            if b or a and c:
                k = ((a << 16 | b << 8 | c) * 2654435761 & 0xFFFFFFFF) >> (32 - 9)
                out[k] = out.get(k, 0) + 1
        return out

    for row, t in zip(counts, texts, strict=True):
        assert {int(k): int(row[k]) for k in np.flatnonzero(row)} == grams(t)
    docs = queries.table(spark, DATA, "documents")
    model = language_id.fit(docs.where(~queries.held_out()), per_language=100)
    rows = docs.where("text is not null").limit(60).collect()
    got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    dims = len(model.idf)
    for r in rows:
        x = {}
        raw = [b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in r["text"].encode()]
        for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
            if b or a and c:
                k = ((a << 16 | b << 8 | c) * 2654435761 & 0xFFFFFFFF) >> (32 - dims.bit_length() + 1)
                x[k] = x.get(k, 0) + 1
        x = {k: math.log1p(n) * float(model.idf[k]) for k, n in x.items()}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1
        cosine = [sum(v / norm * float(centre[k]) for k, v in x.items()) for centre in model.centres]
        best = {}
        for c, owner in zip(cosine, model.owners, strict=True):
            best[model.names[owner]] = max(best.get(model.names[owner], -1), c)
        if not any(ch.isalpha() for ch in r["text"]):
            assert got[r["doc_id"]]["lang_pred"] == "und"
        else:
            assert best[got[r["doc_id"]]["lang_pred"]] == pytest.approx(max(best.values()), abs=1e-5)


def test_letters_are_alphabetic():
    assert [language_id.has_letter(t) for t in (None, "", "½ ² 12_3", "½a", "é", "日", "①", "ª")] == [False, False, False, True, True, True, False, True]


def test_the_language_sample_counts_copies_once(spark):
    rows = [("the same words again and again", "en")] * 500 + [(f"other words number {i} stand here", "en") for i in range(40)] + [(f"autres mots {i} ici", "fr") for i in range(40)]
    d = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    a, b = (language_id.fit(x, per_language=30) for x in (d, d.repartition(2)))
    assert np.allclose(a.centres, b.centres) and a.names == b.names == ["en", "fr"]


def test_language_edges(spark, edge, nothing):
    assert {r["lang_pred"] for r in language_id.identify(edge, None).collect()} == {"und"}
    assert language_id.fit(nothing) is None
    model = language_id.fit(edge, per_language=10)
    got = {r["doc_id"]: r for r in language_id.identify(edge, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert got[4]["lang_pred"] == "en" and 0 <= got[4]["score"] <= 1
    assert language_id.identify(nothing, model).count() == 0


def test_gradient_against_differences():
    s = toxicity._Sample(["a bad idiot here now", "good words only today fine", "you idiot", "the"])
    net = toxicity.Net(np.sort(s.keys[:5]), buckets=64, dtype=np.float64)
    f = net.words(s.data, s.starts[s.at], s.ends[s.at], s.keys)
    place = np.arange(5)
    size = np.diff(s.bounds)
    index = np.minimum(place, size[:, None] - 1) + s.bounds[:-1, None]
    mask, y, w = place < size[:, None], np.array([1, 0, 1, 0.0]), np.ones(4) / 4
    _, g = net.gradient(f, s.inverse[index], mask, y, w)
    rng = np.random.default_rng(0)
    for k, p in net.p.items():
        for _ in range(5):
            i = tuple(rng.integers(0, n) for n in p.shape)
            kept = p[i]
            p[i] = kept + 1e-5
            up = net.gradient(f, s.inverse[index], mask, y, w)[0]
            p[i] = kept - 1e-5
            down = net.gradient(f, s.inverse[index], mask, y, w)[0]
            p[i] = kept
            assert (up - down) / 2e-5 == pytest.approx(g[k][i], abs=1e-8)


def test_all_overlapping_windows():
    for n, stride in itertools.product((0, 1, 23, 24, 25, 36, 100), (1, 6, 12)):
        starts = toxicity.window_starts(n, 24, stride)
        assert all(b - a <= stride for a, b in itertools.pairwise(starts))
        covered = {i for s in starts for i in range(s, min(s + 24, n))}
        assert covered == set(range(n))
        assert starts[-1] == max(0, n - 24)


def test_toxicity_learns_and_reads_whole_texts(spark, edge, nothing):
    rng = np.random.default_rng(3)
    calm, bad = [f"w{i}" for i in range(300)], ["fool", "scumbag"]

    def text(toxic, n=60):
        w = list(rng.choice(calm, n))
        if toxic:
            w[int(rng.integers(0, n))] = bad[int(rng.integers(0, 2))]
        return " ".join(w)

    y = np.array([i % 3 == 0 for i in range(400)], np.int64)
    model = toxicity.train([text(t) for t in y], y, (1.0, 1.0))
    z = np.array([i % 2 for i in range(100)])
    s = model.scores(pa.array([text(t) for t in z]))
    assert ((s >= 0.5) == z).mean() >= 0.9
    far = " ".join([*rng.choice(calm, 5000), "fool"])
    assert model.scores(pa.array([far]))[0] >= 0.5
    got = toxicity.score_toxicity(edge, model).collect()
    assert len(got) == edge.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_toxicity(nothing, model).count() == 0
    label = spark.createDataFrame([(1, 1), (4, 1), (5, 0), (5, None), (6, 0), (None, 1)], "doc_id long, toxic int")
    assert len(toxicity.score_toxicity(edge, toxicity.fit(edge, label)).collect()) == edge.count()
    none = toxicity.fit(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["score"] for r in toxicity.score_toxicity(edge, none).collect()} == {0.0}


def test_toxicity_on_held_out_rows(spark):
    """Area under the curve, and errors, over all labelled rows that took no part in learning."""
    data = "/root/testdata/sf0.1"
    y = queries.table(spark, data, "labels").select("doc_id", "toxic").where("toxic is not null")
    got = queries.op10_toxicity(spark, data).where("held_out").join(y, "doc_id").collect()
    score, toxic = np.array([r["score"] for r in got]), np.array([r["toxic"] > 0 for r in got])
    above = (score[toxic][:, None] > score[~toxic]).mean() + 0.5 * (score[toxic][:, None] == score[~toxic]).mean()
    assert above >= 0.9
    assert (score[toxic] >= 0.5).mean() >= 0.8 and (score[~toxic] >= 0.5).mean() <= 0.05


def test_the_sample_is_bounded(spark):
    rows = spark.createDataFrame([(i % 2, "x" * n, n, i) for i, n in enumerate([5, 5000, 7, 9, 11])], "y int, text string, n int, h long")
    assert [len(r["text"]) for r in toxicity._bounded(rows, 10, 30)] == [5, 7, 9]
    assert [len(r["text"]) for r in toxicity._bounded(rows, 2, 10**6)] == [5, 5000]
    assert toxicity._bounded(rows, 10, 4) == []
    labelled = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(500)], "id long, y int")
    drawn, sizes = toxicity._drawn(labelled, 40)
    assert sizes == {0: 450, 1: 50} and {r["y"]: r["count"] for r in drawn.groupBy("y").count().collect()} == {0: 40, 1: 40}
