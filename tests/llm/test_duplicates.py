import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import DATA
from hypothesis import given, settings
from hypothesis import strategies as st

from brinewake.llm import decontam, line_dedup, ngram_join, queries, vectext
from brinewake.llm.common import attach


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def sets(texts):
    out = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        out[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def closure(s):
    parent = {i: i for i in s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(s)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            common = len(s[i] & s[j])
            if common and 100 * common >= 80 * (len(s[i]) + len(s[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in s}


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 150), st.integers(0, 10**6), st.integers(0, 60))
def test_similar_sets_share_a_signature(size, seed, edits):
    """Whatever two sets are similar, they have a signature in common, and sketches let them pass."""
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
    keep = a[rng.random(len(a)) > edits / 200]
    b = np.unique(np.concatenate([keep, rng.integers(0, 2**63, int(rng.integers(0, edits // 4 + 1)), dtype=np.uint64)]))
    if not len(b):
        return
    common = len(np.intersect1d(a, b))
    if 100 * common < 80 * (len(a) + len(b) - common) or np.array_equal(a, b):
        return
    bands = ngram_join.Bands(80)
    assert set(ngram_join.signatures(a, bands).tolist()) & set(ngram_join.signatures(b, bands).tolist())
    side = [(len(x), bands.of(len(x)), *ngram_join.sketch(x, bands)) for x in (a, b)]
    assert not ngram_join._far(side[:1], side[1:], 80)[0]


def test_shingles_against_tuples():
    texts = ["", "one", "a b c d", "a b c d e", "a  b\tc\nd e f", "A b C d e F é", "x " * 9]
    for _, _, data, offsets in vectext.chunks(pa.array(texts)):
        got = ngram_join.sets_of(data, offsets, 5)
    want = sets(list(enumerate(texts)))
    assert [len(g) for g in got] == [len(want[i]) for i in range(len(texts))]
    assert np.array_equal(got[4], got[5][np.isin(got[5], got[4])]) is (want[4] <= want[5])


def test_join_against_brute_force(spark):
    rng = random.Random(1)
    base = [[rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(rng.choice((3, 8, 40, 120)))] for _ in range(25)]
    texts = [None, "", "solo"]
    for w in base:
        for _ in range(6):
            v = list(w)
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                v[rng.randrange(len(v))] = "new" + str(rng.randrange(10**6))
            texts.append(" ".join(v))
    rows = list(enumerate(texts)) + [(5, texts[5])]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    got = ngram_join.similar_components(d).collect()
    s = sets(list(enumerate(texts)))
    want = closure(s)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == (len(s[r["doc_id"]]), want[r["doc_id"]]), r


def test_join_edges(edge):
    got = ngram_join.similar_components(edge).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, None: None, 7: 7, 8: 8, 9: 9}


def test_forests_span_and_name_what_is_left():
    rng = np.random.default_rng(9)
    for _ in range(50):
        u, v = rng.integers(0, 12, (2, 40))
        u, v = u[u != v], v[u != v]
        for most in (1, 2, 50):
            chosen, more = ngram_join._forests(u, v, np.arange(len(u)), most)
            assert len(set(chosen)) == len(chosen) <= most * 11 and more == (len(chosen) < len(u))
            of = lambda edges: _roots([(int(u[e]), int(v[e])) for e in edges])
            assert of(chosen) == of(range(len(u)))


def _roots(edges):
    group = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    return {x: min(g) for x, g in group.items()}


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_a_group_whose_members_mostly_miss_each_other(spark, rounds):
    """Many near copies of one text, each pair near the threshold: the same classes as by all pairs,
    however many rounds of forests go before the whole search."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(210)]
    texts = []
    for _ in range(90):
        v = list(base)
        for _ in range(rng.choice((2, 3))):
            v[rng.randrange(210)] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(v))
    s = sets(list(enumerate(texts)))
    near = [100 * (c := len(s[i] & s[j])) >= 80 * (len(s[i]) + len(s[j]) - c) for i in s for j in range(i)]
    assert 0.05 < np.mean(near) < 0.95
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_components(d, rounds=rounds, large_bucket=40).collect()}
    assert got == closure(s)


def test_join_of_nothing_and_of_clashing_ids(spark, nothing):
    assert ngram_join.similar_components(nothing).count() == 0
    one, two = ("a b c d e f g h i j k l m n o p q r s t", "z y x w v u t s r q p o n m l k j i h g")
    rows = [(1, one), (2, two), (5, one), (5, two), (5, None), (7, one + " more"), (None, one), (None, None)]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for _ in range(2) for r in ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    five = {c for i, _, c in got if i == 5}
    assert five in ({1}, {2})  # of the two texts always the same one counts
    assert {(i, c) for i, _, c in got if i in (1, 2)} == {(1, 1), (2, 2)}
    assert {n for i, n, _ in got if i == 5} == {0, 16} and (None, 16, None) in got and (None, 0, None) in got


def test_a_text_that_does_not_count_hides_no_link(spark):
    """Of an id's two texts one is left out; the others that have it are still linked."""
    one, two = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(5, one), (5, two), (6, one), (7, two), (8, one + " end"), (9, two + " end")]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()}
    assert got in ({5: 5, 6: 5, 8: 5, 7: 7, 9: 7}, {5: 5, 7: 5, 9: 5, 6: 6, 8: 6})


def test_keep_first(spark, edge, nothing):
    kept = ngram_join.keep_first(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "5", "7", "8", "9", "None", "None"])
    assert ngram_join.keep_first(nothing).count() == 0


def test_attach_with_hot_keys(spark):
    """A key of a third of the rows, null keys, keys without a value; all ways give the plain join."""
    keys = ["hot"] * 300 + [None] * 200 + [f"k{i % 60}" for i in range(400)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")
    one = spark.createDataFrame([(k, f"v{k}", keys.count(k)) for k in {*keys} - {None, "k7"}], "k string, v string, n long")
    want = {i: None if k in (None, "k7") else f"v{k}" for i, k in enumerate(keys)}
    for most in (1000, 10, 3):
        got = attach(rows, one, "k", "v", "id", most=most)
        assert got.columns == ["id", "k", "v"]
        assert {r["id"]: r["v"] for r in got.collect()} == want and got.count() == len(keys)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_is_a_common_subsequence(a, b):
    got = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
    if a == b:
        assert len(got) == len(a)


def test_lines_go_from_later_documents_and_none_is_lost(spark):
    block = ["this passage of many words stands in several documents", "and has a second line of many words too"]
    own = lambda i: [f"own line {i} {k} with some words of its own here" for k in range(3)]
    texts = {1: own(1) + block, 2: block + own(2), 3: own(3), 4: own(4)[:1] + block + own(4)[1:], 5: own(1) + block}
    d = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(d).collect()}
    assert got == {1: texts[1], 2: own(2), 3: own(3), 4: own(4), 5: [""]}


def test_passages_of_lines_first_held_elsewhere_go(spark):
    a, b, c = (f"five words of line {x}" for x in "abc")
    long = [f"five words of line {i}" for i in range(12)]
    texts = {1: [a], 2: [b], 3: [c], 4: [c, b, a], 10: [a, b, c], 20: ["own line", a, b, c], **{30 + i: [x] for i, x in enumerate(long)}, 50: long, 60: [*long, "own"]}
    d = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(d).collect()}
    assert got == {**texts, 20: ["own line"], 60: ["own"]}


def test_every_block_of_any_earlier_document_goes(spark):
    """All pairs of documents, all runs of lines, blank ones too."""
    rng = random.Random(7)
    pool = ["", " ", "a b", "c d e", "f g h i j", "k l m n o p q r", "s", *(f"only {i} x" for i in range(12))]
    texts = {i: [rng.choice(pool) for _ in range(rng.randrange(1, 9))] for i in range(60)}
    for i in range(60, 90):
        block = texts[rng.randrange(60)] + texts[rng.randrange(60)]
        texts[i] = [f"own {i}", *block[rng.randrange(4) :], "s"]
    lines = {i: [x.strip() for x in t] for i, t in texts.items()}
    want = {}
    for i, later in lines.items():
        gone = set()
        for s in range(len(later)):
            for e in range(s + 1, len(later) + 1):
                if sum(len(x.split()) for x in later[s:e]) >= 8 and any(later[s:e] == lines[k][p : p + e - s] for k in range(i) for p in range(len(lines[k]))):
                    gone |= {j for j in range(s, e) if later[j]}
        want[i] = [x for j, x in enumerate(texts[i]) if j not in gone]
    d = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(d).collect()}
    assert got == {i: "\n".join(t) for i, t in want.items()}
    assert any(len(want[i]) < len(texts[i]) for i in want)


def test_a_column_of_the_counts_name_passes_through(spark):
    text = "the very same line of eight words or more"
    d = spark.createDataFrame([(1, text, "own"), (2, text, "own")], "doc_id long, text string, lines_deleted string")
    out = line_dedup.dedup_lines(d)
    assert out.columns == ["doc_id", "text", "lines_deleted", "lines_deleted_"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, text, "own", 0), (2, "", "own", 1)]


def test_dedup_edges(edge, nothing):
    out = line_dedup.dedup_lines(edge)
    assert out.columns == [*edge.columns, "lines_deleted"]
    rows = out.collect()
    assert len(rows) == edge.count()
    assert {(r["doc_id"], r["lines_deleted"]) for r in rows if r["lines_deleted"]} == {(6, 2)}
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_decontamination_against_brute_force(spark):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    grams = lambda w: Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, DATA, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, DATA, "benchmark").collect()]
    got = {(r["doc_id"], r["item_id"]): r for r in queries.op7_decontamination(spark, DATA).collect()}
    want = set()
    for d, t in docs:
        g = grams(words(t))
        want |= {(d, i) for i, x in items if (s := grams(words(x))) and sum(min(n, g[k]) for k, n in s.items()) >= 0.85 * s.total()}
    assert want == set(got)
    text, item = dict(docs), dict(items)
    for (d, i), r in got.items():
        assert words(text[d][r["start"] : r["end"]]) == words(item[i]) or r["similarity"] < 1


def test_edited_passages_and_blocks_of_items(spark):
    rng = random.Random(2)
    items = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(n)) for n in (30, 60, 40, 3)]
    edited = items[1].split()
    edited[20] = "changed"
    noise = lambda: " ".join(f"n{rng.randrange(10**6)}" for _ in range(80))
    docs = [(0, noise() + " " + items[0].upper() + ", " + noise()), (1, " ".join(edited) + " " + noise()), (2, noise()), (3, items[3]), (4, noise() + " " + items[3]), (5, None), (6, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([*enumerate(items), (9, None), (10, "")], "item_id long, text string")
    for block, blocks in ((1, 1), (1, 3), (100, 4)):
        assert sorted((r["doc_id"], r["item_id"]) for r in decontam.contaminations(d, b, block=block, blocks=blocks).collect()) == [(0, 0), (1, 1), (3, 3)]
    assert sorted(r["doc_id"] for r in decontam.decontaminate(d, b).collect()) == [2, 4, 5, 6]


def test_edited_passages_at_the_production_threshold():
    """Items of which the last fifth is replaced, at similarity 0.8 and the radius in use."""
    rng = np.random.default_rng(6)
    items = [[f"w{v}" for v in rng.integers(0, 10**9, 60)] for _ in range(1500)]
    index = decontam.Index(list(range(1500)), [" ".join(x) for x in items], 5, 20, 0.8)
    docs = [" ".join([*(f"n{v}" for v in rng.integers(0, 10**9, 30)), *x[:49], *(f"n{v}" for v in rng.integers(0, 10**9, 40))]) for x in items]
    got = {(row, item) for row, item, *_ in decontam._found(index, pa.array(docs))}
    assert got == {(i, i) for i in range(1500)}


def test_blocks_find_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(4)
    texts = [" ".join(f"x{v}" for v in rng.integers(0, 10**6, 20)) for _ in range(50)]
    index = decontam.Index(list(range(50)), texts, 5, 20, 0.8)
    own, prints, *_ = index.prints[20]
    for _ in range(200):
        p = int(prints[rng.integers(0, 50)])
        for bit in rng.choice(64, int(rng.integers(0, 30)), replace=False):
            p ^= 1 << int(bit)
        want = {int(i) for i, q in zip(own, prints.tolist(), strict=True) if int.bit_count(p ^ q) <= 20}
        assert set(index.within(20, p).tolist()) == want


def test_decontamination_edges(edge, nothing):
    assert decontam.contaminations(edge, nothing.selectExpr("doc_id as item_id", "text")).count() == 0
    assert decontam.decontaminate(nothing, edge.selectExpr("doc_id as item_id", "text")).count() == 0
