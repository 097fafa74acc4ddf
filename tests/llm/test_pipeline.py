import re

import pytest
from compare import DATA

import corpus_pipeline
from brinewake.llm import queries
from brinewake.llm.common import cut


def test_stages_and_their_columns():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_pipeline_over_the_small_table(spark):
    docs = queries.table(spark, DATA, "documents")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, DATA).collect()
    kept = {r["doc_id"] for r in packed}
    leaks = {r["doc_id"] for r in queries.op7_decontamination(spark, DATA).collect()}
    assert kept < ids and not kept & leaks
    assert len(kept) >= 0.4 * len(ids)
    fill = {}
    for r in packed:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= 2048


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_every_stage_against_brute_force_on_its_own_input(spark):
    """What each stage keeps and changes, from the table that its predecessor left."""
    from test_duplicates import closure, lower, sets

    stages = dict(corpus_pipeline.STAGES)
    docs = cut(stages["quality"](spark, queries.table(spark, DATA, "documents"), DATA))
    verdict = {r["doc_id"]: r["kept"] for r in queries.op2_quality_rules(spark, DATA).collect()}
    before = rows(queries.table(spark, DATA, "documents"))
    assert rows(docs) == {i: t for i, t in before.items() if verdict[i]}
    # every run of eight words or more of adjacent lines that an earlier document has goes
    before = rows(docs)
    docs = cut(stages["line_dedup"](spark, docs, DATA))
    lines = {i: [lower(x).strip(" \t\r\x0b\x0c") for x in t.split("\n")] for i, t in before.items()}
    known: set[tuple[str, ...]] = set()
    want = {}
    for i in sorted(lines):
        own = lines[i]
        runs = [(s, e) for s in range(len(own)) for e in range(s + 1, min(s + 12, len(own)) + 1) if len(" ".join(own[s:e]).split()) >= 8]
        gone = {j for s, e in runs if tuple(own[s:e]) in known for j in range(s, e) if own[j]}
        known |= {tuple(own[s:e]) for s, e in runs}
        text = "\n".join(x for j, x in enumerate(before[i].split("\n")) if j not in gone)
        if not gone or text.strip():
            want[i] = text
    assert rows(docs) == want
    assert all(r["n_chars"] == len(r["text"]) for r in docs.collect() if want[r["doc_id"]] != before[r["doc_id"]])
    # one document of each group stays
    before = rows(docs)
    docs = cut(stages["near_duplicates"](spark, docs, DATA))
    group = closure(sets(before.items()))
    assert rows(docs) == {i: t for i, t in before.items() if group[i] == i}
    # no passage of the benchmark is left, and nothing else goes
    before = rows(docs)
    docs = cut(stages["decontamination"](spark, docs, DATA))
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    items = [f" {' '.join(words(r['text']))} " for r in queries.table(spark, DATA, "benchmark").collect()]
    after = rows(docs)
    whole = {i for i, t in before.items() if any(x in f" {' '.join(words(t))} " for x in items)}
    assert not whole & set(after) and set(after) <= set(before)
    grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, items)]
    for i in set(before) - set(after):
        w = words(before[i])
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        assert max(len(g & own) / len(g) for g in grams if g) >= 0.6
    # all that is left is packed, each id once
    packed = stages["packing"](spark, docs, DATA).collect()
    spans = {}
    for r in packed:
        spans.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    assert set(spans) == set(after)
    for x in spans.values():
        assert sum(n for _, n, _ in x) == x[0][2]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_edges_and_on_nothing(spark, edge, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for d in (edge, nothing, edge.withColumnRenamed("words", "lines_deleted")):
        out = stage(spark, d, DATA)
        if name != "packing":
            assert out.columns == d.columns and out.dtypes == d.dtypes
        got = out.collect()
        if d is nothing:
            assert got == []
        elif name == "packing":
            assert {r["doc_id"] for r in got} == {r["doc_id"] for r in d.collect()}
        elif name == "decontamination":
            assert len(got) == d.count()
        elif name == "quality":
            assert got == []  # all of them fail the base rule
        else:
            assert {1, 2, 3, 4, 5, 7, 8, 9, None} <= {r["doc_id"] for r in got} and 6 not in {r["doc_id"] for r in got}
