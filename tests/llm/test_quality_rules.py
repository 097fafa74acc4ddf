import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinewake.llm import quality_rules as q


def stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    k, covered = Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2)), set()
    for j in range(len(w) - 2):
        if k[tuple(w[j : j + 3])] > 1:
            covered |= {j, j + 1, j + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_statistics_against_brute_force(spark):
    rng = random.Random(5)
    pool = ["a", "b", "cé", "d#", "\n", " \x0b", "\t", " ", " ", "<x>", "😀"]
    texts = [None, "", *(" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(120)), *("".join(rng.choice(pool) for _ in range(20)) for _ in range(60))]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r[1:]) for r in q.with_statistics(d).select("_row.doc_id", *q.STATS).collect()}
    for i, t in enumerate(texts):
        assert got[i] == stats(t), (i, t)


def test_chi_square():
    assert q.chi_square_quantile(0.95, 1) == pytest.approx(3.841459, abs=1e-5)
    assert q.chi_square_quantile(0.975, 5) == pytest.approx(12.832502, abs=1e-5)


def sample(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = ["w" + "abcdefghijklmnop"[i % 16] * (1 + i % 7) + str(i) for i in range(4000)]
    rows = []
    for i in range(n):
        words = list(rng.choice(vocabulary, int(np.exp(rng.normal(5, 0.5))) + 55))
        if i % 25 == 0:
            words = [w + "#$%&" for w in words]
        rows.append((i, " ".join(words), "en", f"s{i % 2}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_outliers_go_and_clean_rows_stay(spark):
    d = sample(spark)
    got = {r["doc_id"]: r for r in q.quality_report(d).collect()}
    assert all(not got[i]["kept"] for i in range(0, 600, 25))
    assert all(got[i]["kept"] for i in range(600) if i % 25)
    kept = q.quality_filter(d)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["kept"]}


def test_tables_of_pipes_go_and_rare_symbols_stay(spark):
    """One symbol every two or three words is the only oddity of the tables."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        words = [f"word{k}" for k in rng.integers(0, 4000, int(np.exp(rng.normal(5, 0.5))) + 55)]
        if i % 20 == 0:
            words = [w + " |" * (k % (2 + i // 20 % 2) == 0) for k, w in enumerate(words)]
        elif i % 20 == 1:
            words[7] += "%"
        rows.append((i, " ".join(words), "en", "s"))
    got = {r["doc_id"]: r["kept"] for r in q.quality_report(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i] for i in range(0, 600, 20))
    assert all(got[i] for i in range(600) if i % 20)


def test_estimate_resists_a_third_of_outliers(spark):
    """MCD against numpy's mean of the clean rows: a far cluster of 20 % must not move it."""
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (1000, q.P))
    x[:200] += 15
    rows = [("en", "s", *map(float, r)) for r in x]
    d = spark.createDataFrame(rows, "_lang string, _source string, " + ", ".join(f"x{i} double" for i in range(q.P)))
    e = {r["key"]: r for r in q.fit(d).collect()}
    assert set(e) == {"0", "1\x01en", "2\x01en\x01s"}
    assert np.abs(np.array([e["0"][f"m{i}"] for i in range(q.P)]) - x[200:].mean(0)).max() < 0.25


def exact_mcd(x, coverage=0.75):
    """Mean and floored covariance of the h documents of least determinant, by trying all subsets."""
    n, floors = len(x), np.diag(np.square(q.FLOORS))
    scale = coverage / q.chi_square_cdf(q.chi_square_quantile(coverage, q.P), q.P + 2)
    best = min((x[list(s)] for s in itertools.combinations(range(n), math.ceil(n * coverage))), key=lambda y: np.linalg.det(np.cov(y.T, bias=True) * scale + floors))
    return best.mean(0), np.cov(best.T, bias=True) * scale + floors


def exact_verdicts(groups, prior, cutoff):
    """Which rows are near their group's estimate, drawn towards lang and table, by the plain formulas."""
    every = np.concatenate([x for x in groups.values()])
    mean, cov = exact_mcd(every)
    cov = cov * (1 + prior / len(every))
    out = {}
    for lang in sorted({lang for lang, _ in groups}):
        own = np.concatenate([x for (k, _), x in groups.items() if k == lang])
        for name, x in groups.items():
            if name[0] == lang:
                m, c = mean, cov
                for y in (own, x):
                    w, (a, b) = len(y) / (len(y) + prior), exact_mcd(y)
                    c = w * b + (1 - w) * c + w * (1 - w) * np.outer(a - m, a - m)
                    m = m + w * (a - m)
                out[name] = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m) <= cutoff
    return out


@pytest.mark.parametrize("prior", [2.0, 50.0])
def test_verdicts_against_all_subsets(spark, prior):
    """Small groups, each with planted outliers, against the determinant of every h-subset."""
    rng = np.random.default_rng(11)
    groups = {(lang, source): rng.normal(3 * j, 0.3, (9, q.P)) for j, (lang, source) in enumerate([("en", "a"), ("en", "b")])}
    for x in groups.values():
        x[:2] += rng.choice([-1, 1], (2, q.P)) * 60
    rows = [(k, s, i, *map(float, r)) for (k, s), x in groups.items() for i, r in enumerate(x)]
    d = spark.createDataFrame(rows, "_lang string, _source string, i int, " + ", ".join(f"x{i} double" for i in range(q.P))).withColumn("base_failed", F.lit(False))
    cutoff = q.chi_square_quantile(1 - q.TAIL, q.P)
    got = {(r["_lang"], r["_source"], r["i"]): r["kept"] for r in q._verdicts(d, q.fit(d), prior, cutoff).collect()}
    want = {(k, s, i): bool(v) for (k, s), x in exact_verdicts(groups, prior, cutoff).items() for i, v in enumerate(x)}
    assert got == want
    assert not any(got[k, s, i] for k, s in groups for i in (0, 1))


def test_a_small_group_passes_into_its_parent(spark):
    """The estimate of a group moves with its size from its lang's to its own, without a jump."""
    rng = np.random.default_rng(4)
    means = []
    for n in (2, 50, 1250):
        x = np.concatenate([rng.normal(0, 0.5, (3000, q.P)), rng.normal(4, 0.5, (n, q.P))])
        rows = [("en", "big" if i < 3000 else "small", *map(float, r)) for i, r in enumerate(x)]
        d = spark.createDataFrame(rows, "_lang string, _source string, " + ", ".join(f"x{i} double" for i in range(q.P)))
        e = {r["_group"]: r["_estimate"]["m0"] for r in q.shrunk(q.fit(d), 50.0).collect()}
        means.append(e["en\x01small"])
    assert means == sorted(means) and means[0] < 0.5 and means[1] == pytest.approx(2, abs=0.5) and means[-1] > 3.5


def test_many_groups_and_a_hot_one(spark, monkeypatch):
    """Beyond the bound, hot groups are broadcast and the others joined by key: the same verdicts."""
    d = sample(spark, 300).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 30).cast("string"))))
    want = {r["doc_id"]: (r["kept"], round(r["distance"], 6)) for r in q.quality_report(d).collect()}
    monkeypatch.setattr(q, "MOST_GROUPS", 5)
    assert {r["doc_id"]: (r["kept"], round(r["distance"], 6)) for r in q.quality_report(d).collect()} == want


def test_native_plan(spark):
    plan = q.quality_report(sample(spark, 60))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_edges(spark, edge, nothing):
    got = q.quality_report(edge)
    rows = got.collect()
    assert len(rows) == edge.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[4]["n_words"] == 140_000 and by[4]["n_repeat_words"] == 140_000 and not by[4]["kept"]
    assert q.quality_filter(nothing).columns == nothing.columns
