r"""Quality rules: robust multivariate outliers by minimum covariance determinant, JVM-side only.

Five statistics of each text are transformed to near-normal scale.  For every (lang, source), every
lang and the whole table, a minimum-covariance-determinant location and scatter is fitted by C-steps
from two deterministic starts (median and MAD; mean and covariance); of the two the one of smaller
determinant stands.  The estimate of a (lang, source) is then drawn towards that of its lang, and that
towards the whole table's, with the weight of ``prior`` documents, so a small group's estimate passes
into its parent's without a switch by size (mean and scatter of the pooled documents, the distance of
the two means included); the whole table's scatter is widened by 1 + prior / n.  A document whose
Mahalanobis distance from its group's estimate exceeds a chi-square cutoff is rejected.

A C-step is one pass with map-side sums: documents add their moments to a histogram of distances
(64 bins to each doubling), and the bins up to the h-th document give the next estimate.  A task
holds a group's bins at most, whatever the group's size; nothing is collected or sampled, and
estimates reach the documents without dealing those out by group.

Defined results: null or empty text has no words and fails the base rule; a null lang or source
groups with the empty string; a table without documents that pass the base rule has no estimates;
repeated rows count as often as they occur; other columns pass through untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import attach, cut

_SPACES = r"[\x20\x09-\x0D]+"
_LOW = (1 << 24) - 1
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Least standard deviation of each transformed statistic: a statistic that is constant for most
#: documents of a group (no symbols, no repeated lines) must not make its first deviation an outlier.
#: Symbols have as much room as repeated lines: alone, some nine a hundred words reach the cutoff.
FLOORS = (0.5, 0.15, 0.5, 0.5, 0.7)
#: Chi-square tail of the cutoff, a usual level for Mahalanobis outliers.
TAIL = 1e-3
#: Documents that the parent's estimate counts for: ten for each statistic.
PRIOR = 50.0
P = len(FLOORS)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def chi_square_cdf(x: float, k: float) -> float:
    """By the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, y = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= y / n
        total += term
    return min(1.0, total * math.exp(a * math.log(y) - y - math.lgamma(a)))


def chi_square_quantile(p: float, k: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, k) < p else (low, mid)
    return high


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as column ``_row`` and the five statistics, row by row, without a shuffle.

    Words in repeated 3-word windows: windows are hashed to 64 bits, the upper 40 carry the order
    and the lower 24 the position in one sort of longs; where two different windows of a text agree
    in 40 bits, or it has 2**24 words, structs of the full hash are sorted instead.
    """
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), t.alias("_t"))
    d = d.select(
        "_row",
        "_t",
        F.filter(F.split("_t", _SPACES, -1), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda x: F.trim(x, F.lit(" \t\n\x0b\x0c\r")) != "").alias("_l"),
    )
    d = d.select(
        "_row",
        "_w",
        F.size("_w").cast("long").alias("n_words"),
        (F.length(F.regexp_replace("_t", _SPACES, ""))).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
    )
    windows = F.when(F.size("_w") >= 3, F.transform(F.sequence(F.lit(0), F.size("_w") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))))
    base = [c for c in ("_row", *STATS[:4])]
    d = d.select(*base, F.coalesce(windows, F.array().cast("array<bigint>")).alias("_h"))
    d = d.select(*base, "_h", (F.size("_h") - F.size(F.array_distinct("_h"))).alias("_again"))
    high = F.transform("_h", lambda h: F.shiftrightunsigned(h, 24))
    d = d.select(*base, "_h", "_again", F.when(F.col("_again") > 0, (F.size("_h") <= _LOW) & (F.size("_h") - F.size(F.array_distinct(high)) == F.col("_again"))).alias("_clean"))
    packed = F.sort_array(F.transform("_h", lambda h, i: h.bitwiseAND(F.lit(~_LOW)).bitwiseOR(i.cast("long"))))
    full = F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("i"))))
    d = d.select(*base, "_again", F.when(F.col("_clean"), packed).alias("_k"), F.when(~F.col("_clean"), full).alias("_f"))
    near = lambda a, b: F.shiftrightunsigned(a.bitwiseXOR(b), 24) == 0
    same = lambda x, y: F.coalesce(near(x, y), F.lit(False))
    fast = F.transform(F.filter("_k", lambda k, i: same(k, F.get("_k", i - 1)) | same(k, F.get("_k", i + 1))), lambda k: k.bitwiseAND(F.lit(_LOW)))
    hit = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    slow = F.transform(F.filter("_f", lambda x, i: hit(x, F.get("_f", i - 1)) | hit(x, F.get("_f", i + 1))), lambda x: x["i"])
    d = d.select(*base, "_again", F.sort_array(F.coalesce(fast, slow, F.array().cast("array<bigint>"))).alias("_at"))
    # each repeated window covers 3 words, less what the next one covers too
    covered = F.aggregate(F.transform("_at", lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get("_at", i + 1) - x, F.lit(3).cast("long")))), F.lit(0).cast("long"), lambda s, x: s + x)
    d = d.select(*base, F.when(F.col("_again") > 0, covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"))
    # a generator is a fence: no filter above it can pull the expressions below it into itself
    return d.select("_row", F.inline(F.array(F.struct(*STATS))))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def features() -> list[Column]:
    """The transformed statistics (only for texts with a word)."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda c: F.log1p(F.col(c) * 100.0 / n)
    return [F.log(n), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), share("n_symbols"), share("n_dup_lines"), share("n_repeat_words")]


def _scatter(d: DataFrame) -> DataFrame:
    """From sums n, s_i, q_ij to mean m_i, the floored covariance c_ij and its Cholesky factor l_ij."""
    d = d.withColumns({f"m{i}": F.col(f"s{i}") / F.col("w") for i in range(P)})
    d = d.withColumns({f"c{i}{j}": (F.col(f"q{i}{j}") / F.col("w") - F.col(f"m{i}") * F.col(f"m{j}")) * F.col("scale") + F.lit(FLOORS[i] ** 2 if i == j else 0.0) for i, j in PAIRS})
    return _cholesky(d)


def _cholesky(d: DataFrame) -> DataFrame:
    for i, j in PAIRS:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        d = d.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    return d.withColumn("log_det", sum((F.log(f"l{i}{i}") for i in range(P)), F.lit(0.0)) * 2)


_ESTIMATE = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i, j in PAIRS]
_MOMENTS = [f"m{i}" for i in range(P)] + [f"c{i}{j}" for i, j in PAIRS]
#: Groups whose estimates are sent to all tasks, some 200 bytes each.
MOST_GROUPS = 20_000


def with_distance(d: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance of x0.. from the estimate beside it."""
    for i in range(P):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        d = d.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return d.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(P)), F.lit(0.0))).drop(*[f"y{i}" for i in range(P)])


def _levels() -> Column:
    return F.explode(F.array(F.lit("0"), F.concat(F.lit("1\x01"), F.col("_lang")), F.concat(F.lit("2\x01"), F.col("_lang"), F.lit("\x01"), F.col("_source"))))


def _starts(x: DataFrame) -> DataFrame:
    """Two first estimates of every group."""
    sums = [F.count("*").cast("double").alias("w"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS]]
    classical = _scatter(x.groupBy("key").agg(*sums).withColumn("scale", F.lit(1.0)))
    long = x.select("key", F.posexplode(F.array(*[F.floor(F.col(f"x{i}") * 64).cast("int") for i in range(P)])).alias("dim", "bin"))
    bins = long.groupBy("key", "dim", "bin").count()
    of = W.partitionBy("key", "dim")
    bins = bins.withColumns({"upto": F.sum("count").over(of.orderBy("bin")), "n": F.sum("count").over(of)})
    middle = bins.where("2 * upto >= n").groupBy("key", "dim").agg(F.min("bin").alias("median"))
    off = bins.join(middle, ["key", "dim"]).withColumn("off", F.abs(F.col("bin") - F.col("median"))).groupBy("key", "dim", "median", "off", "n").agg(F.sum("count").alias("count"))
    off = off.withColumn("upto", F.sum("count").over(of.orderBy("off"))).where("2 * upto >= n").groupBy("key", "dim", "median").agg(F.min("off").alias("mad"), F.max("n").alias("n"))
    value = lambda i, c: F.max(F.when(F.col("dim") == i, F.col(c)))
    robust = off.groupBy("key").agg(F.max("n").alias("n"), *[((value(i, "median") + 0.5) / 64).alias(f"m{i}") for i in range(P)], *[((value(i, "mad") + 0.5) / 64 * 1.4826).alias(f"sd{i}") for i in range(P)])
    robust = _cholesky(robust.withColumns({f"c{i}{j}": F.col(f"sd{i}") ** 2 + FLOORS[i] ** 2 if i == j else F.lit(0.0) for i, j in PAIRS}))
    counted = classical.select("key", F.lit(0).alias("start"), F.col("w").cast("long").alias("n"), *_ESTIMATE)
    return counted.unionByName(robust.select("key", F.lit(1).alias("start"), F.col("n"), *_ESTIMATE))


def _with_starts(x: DataFrame, at: DataFrame) -> DataFrame:
    """Rows of ``x``, once for each estimate (one or two) of their key."""
    both = at.groupBy("key").agg(F.max("n").alias("n"), F.collect_list(F.struct("start", *_ESTIMATE)).alias("_e"))
    d = attach(x, cut(both), "key", "_e", "x0", most=MOST_GROUPS)
    return d.select(*x.columns, F.inline("_e"))


def fit(stats: DataFrame, coverage: float = 0.75, steps: int = 3) -> DataFrame:
    """MCD estimates (key, n, means, floored covariance) of every group of all three levels.

    ``stats``: _lang, _source, x0.. of the documents that pass the base rule.
    """
    x = stats.select(_levels().alias("key"), *[f"x{i}" for i in range(P)])
    scale = coverage / chi_square_cdf(chi_square_quantile(coverage, P), P + 2)
    at = cut(_starts(x))
    for step in range(steps):
        d = with_distance(_with_starts(x, at)).withColumn("bin", F.floor(F.log2(F.col("d2") + 1) * 64).cast("int"))
        sums = [F.count("*").cast("double").alias("w"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(P)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in PAIRS]]
        names = ["w", *[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in PAIRS]]
        bins = d.groupBy("key", "start", "bin").agg(*sums)
        of = W.partitionBy("key", "start")
        bins = bins.withColumns({"before": F.sum("w").over(of.orderBy("bin")) - F.col("w"), "n": F.sum("w").over(of)}).where(F.col("before") < F.ceil(F.col("n") * coverage))
        best = bins.groupBy("key", "start").agg(F.max("n").alias("n"), *[F.sum(c).alias(c) for c in names]).withColumn("scale", F.lit(scale))
        at = _scatter(best).select("key", "start", F.col("n").cast("long").alias("n"), "log_det", *_ESTIMATE, *[c for c in _MOMENTS if c not in _ESTIMATE])
        if step == steps - 1:
            row = W.partitionBy("key").orderBy("log_det", "start")
            at = at.withColumn("rank", F.row_number().over(row)).where("rank = 1").select("key", "n", *_MOMENTS)
        at = cut(at)
    return at


def shrunk(estimates: DataFrame, prior: float) -> DataFrame:
    """(group: lang and source, n, e: means and Cholesky factor) of every group of the last level, drawn
    towards its parents."""
    of = {c: F.col(f"e.{c}") for c in ("n", *_MOMENTS)}
    d = estimates.where(F.col("key").startswith("2")).select(F.split("key", "\x01", 3).alias("k"), F.struct("n", *_MOMENTS).alias("e2"))
    d = d.select(F.get("k", F.lit(1)).alias("lang"), F.get("k", F.lit(2)).alias("source"), "e2")
    known = estimates.select("key", F.struct("n", *_MOMENTS).alias("e"))
    langs = known.where(F.col("key").startswith("1")).select(F.split("key", "\x01", 2)[1].alias("lang"), of["n"].alias("n"), F.col("e").alias("e1"))
    d = attach(d, langs, "lang", "e1", "source").crossJoin(F.broadcast(known.where("key = '0'").select(F.col("e").alias("e0"))))  # one row
    whole = F.lit(1.0) + prior / F.col("e0.n")
    d = d.withColumns({f"m{i}": F.col(f"e0.m{i}") for i in range(P)} | {f"c{i}{j}": F.col(f"e0.c{i}{j}") * whole for i, j in PAIRS})
    for level in ("e1", "e2"):
        own = F.col(f"{level}.n") / (F.col(f"{level}.n") + prior)
        off = {i: F.col(f"{level}.m{i}") - F.col(f"m{i}") for i in range(P)}
        mean = {f"_m{i}": F.col(f"m{i}") + own * off[i] for i in range(P)}
        spread = {f"_c{i}{j}": own * F.col(f"{level}.c{i}{j}") + (1 - own) * F.col(f"c{i}{j}") + own * (1 - own) * off[i] * off[j] for i, j in PAIRS}
        d = d.withColumns(mean | spread)
        d = d.withColumns({c: F.col(f"_{c}") for c in _MOMENTS}).drop(*[f"_{c}" for c in _MOMENTS])
    return _cholesky(d).select(_group(F.col("lang"), F.col("source")).alias("_group"), F.col("e2.n").alias("n"), F.struct(*_ESTIMATE).alias("_estimate"))


def _group(lang: Column, source: Column) -> Column:
    return F.concat(lang, F.lit("\x01"), source)


def _verdicts(rows: DataFrame, estimates: DataFrame, prior: float, cutoff: float) -> DataFrame:
    """Adds ``distance`` and ``kept`` to rows with the statistics, _lang, _source and x0.. ."""
    d = rows.withColumn("_group", _group(F.col("_lang"), F.col("_source")))
    d = attach(d, cut(shrunk(estimates, prior)), "_group", "_estimate", "x0", most=MOST_GROUPS)
    d = with_distance(d.select("*", "_estimate.*").drop("_estimate", "_group"))
    far = F.coalesce(F.col("d2") > cutoff, F.lit(False))
    return d.withColumn("distance", F.sqrt("d2")).withColumn("kept", ~(F.col("base_failed") | far)).drop("d2", *_ESTIMATE)


def _prepared(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    clean = lambda c: F.translate(F.coalesce(F.col(f"_row.{c}").cast("string"), F.lit("")), "\x01", " ")
    d = with_statistics(docs, text_col).withColumn("base_failed", base_failed()).withColumns({"_lang": clean(lang_col), "_source": clean(source_col)})
    return d.withColumns({f"x{i}": c for i, c in enumerate(features())})


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", prior: float = PRIOR, tail: float = TAIL) -> DataFrame:
    """One row per document: id, statistics, base_failed, distance, kept.

    ``tail``: the chi-square tail beyond which a document is an outlier; ``prior``: documents that the
    estimate of a group's parent counts for.  Texts are read once.
    """
    d = _prepared(docs, text_col, lang_col, source_col)
    slim = cut(d.select(F.col(f"_row.{id_col}").alias(id_col), *STATS, "base_failed", "_lang", "_source", *[f"x{i}" for i in range(P)]))
    estimates = fit(slim.where(~F.col("base_failed")))
    return _verdicts(slim, estimates, prior, chi_square_quantile(1 - tail, P)).select(id_col, *STATS, "base_failed", "kept", "distance")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", prior: float = PRIOR, tail: float = TAIL) -> DataFrame:
    """The documents that pass, all columns as they were.

    The statistics are computed once for the fit and again for the verdict: that costs less than
    shuffling all texts to meet verdicts by id, and needs no unique id.
    """
    d = _prepared(docs, text_col, lang_col, source_col)
    estimates = fit(cut(d.where(~F.col("base_failed")).select("_lang", "_source", *[f"x{i}" for i in range(P)])))
    return _verdicts(d, estimates, prior, chi_square_quantile(1 - tail, P)).where("kept").select("_row.*")
