"""Balancing, chunking and splitting of clip metadata.

Durations are whole microseconds, so sums and cutoffs are exact.  All running sums are blocked
(``running_before``): a label with a third of all rows spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranges import running_before

SHUFFLE_BLOCK = 1 << 20


def shuffled(row_id: Column, seed: int = 42) -> Column:
    """An order that depends on id and seed alone, the same in any partitioning (ties: by id)."""
    return F.pmod(row_id * F.lit(2654435761) + F.lit(seed), F.lit(2147483648))


def class_totals(meta: DataFrame, classes: Sequence[str]) -> DataFrame:
    """(label, rank, total_us, n): every class of the list, 0 where it has no rows."""
    spark: SparkSession = meta.sparkSession
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in classes])).alias("rank", "label"))
    sums = meta.groupBy("label").agg(F.sum("duration_us").alias("total_us"), F.count("*").alias("n"))
    return names.join(sums, "label", "left").select("label", "rank", F.coalesce("total_us", F.lit(0)).alias("total_us"), F.coalesce("n", F.lit(0)).alias("n"))


def extreme_classes(totals: DataFrame) -> DataFrame:
    """One row: the classes of greatest and least total; of equal ones the first of the list."""
    place = lambda sign: F.struct(F.col("total_us") * sign, F.col("rank"))
    return totals.agg(F.min_by("label", place(-1)).alias("largest"), F.min_by("label", place(1)).alias("smallest"), F.max("total_us").alias("most_us"), F.min("total_us").alias("least_us"))


def head(rows: DataFrame, order: Sequence[str], last: int = 50) -> DataFrame:
    """Rows 0 to ``last`` by ``order``, the last included (the report's 51 rows): the limit is the feature."""
    return rows.orderBy(*order).limit(last + 1)


def batch(rows: DataFrame, order: Sequence[str], first: int, size: int = 10) -> DataFrame:
    """Rows ``first`` + 1 to ``first`` + ``size`` by ``order``, counted from 0: a slice of a listing.

    Only the rows up to the slice's end are sorted, so no task holds the listing.
    """
    upto = rows.orderBy(*order).limit(first + size + 1)
    return upto.orderBy(*order).offset(first + 1)


def above_noise(rows: DataFrame, background: str | int = "background", label: str = "label", value: str = "std", alpha: float = 0.0, digits: int = 9) -> DataFrame:
    """Adds ``valid``: whether a vessel row's fluctuation reaches the background's mean and ``alpha``
    deviations; background rows always are.  The limit is rounded, so sums in another order agree."""
    quiet = F.when(F.col(label) == background, F.col(value))
    limit = rows.agg(F.round(F.avg(quiet) + alpha * F.coalesce(F.stddev_pop(quiet), F.lit(0.0)), digits).alias("_limit"))
    d = rows.crossJoin(F.broadcast(limit))  # one row
    return d.withColumn("valid", (F.col(label) == background) | F.coalesce(F.col(value) >= F.col("_limit"), F.lit(False))).drop("_limit")


def _scalars(totals: DataFrame, **columns: Column) -> DataFrame:
    return F.broadcast(totals.agg(*[c.alias(n) for n, c in columns.items()]))  # one row


def undersampled(meta: DataFrame, classes: Sequence[str], row: str = "row_id") -> DataFrame:
    """Rows of each class, in order, until the smallest class's total is reached (at least one)."""
    totals = class_totals(meta, classes)
    d = running_before(meta.join(totals.select("label"), "label", "left_semi"), ("label",), row, (), F.col("duration_us"), "before_us")
    first = meta.groupBy("label").agg(F.min(row).alias("first"))
    d = d.join(first, "label").crossJoin(_scalars(totals, least=F.min("total_us")))
    return d.where((F.col("before_us") < F.col("least")) | (F.col(row) == F.col("first"))).drop("before_us", "first", "least")


def oversampled(meta: DataFrame, classes: Sequence[str], limit: int = 2, row: str = "row_id", seed: int = 42) -> DataFrame:
    """Shuffled rows of each class, repeated from the start, until the target is reached.

    Target: the smallest total times min(limit, largest / smallest).  Adds ``copy`` (0, 1, ...).
    """
    totals = class_totals(meta, classes)
    d = meta.withColumn("at", shuffled(F.col(row), seed))
    d = running_before(d, ("label",), "at", (row,), F.col("duration_us"), "before_us", SHUFFLE_BLOCK).drop("at")
    d = d.join(totals.select("label", "total_us"), "label")
    d = d.crossJoin(_scalars(totals, least=F.min("total_us"), most=F.max("total_us"))).withColumn("target", F.least(F.col("least") * limit, F.col("most")))
    d = d.where((F.col("least") > 0) & (F.col("before_us") < F.col("target")))
    copies = F.expr("(target - before_us - 1) div total_us")
    return d.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies))).drop("before_us", "total_us", "least", "most", "target")


def chunks(meta: DataFrame, classes: Sequence[str], seconds: int, background: str = "background", row: str = "row_id") -> DataFrame:
    """One row for each ``seconds`` of a clip (``sub_init``), while its class's earlier clips sum up,
    in whole seconds, to no more than the largest vessel class's total."""
    totals = class_totals(meta, classes).where(F.col("label") != background)
    whole = F.expr("duration_us div 1000000")
    d = running_before(meta.where(F.col("label").isin(*classes)), ("label",), row, (), whole, "before", 1 << 16)
    d = d.crossJoin(_scalars(totals, most=F.max("total_us"))).where(F.col("before") * 1_000_000 <= F.col("most"))
    d = d.withColumn("whole", whole).where("whole > 0")
    return d.withColumn("sub_init", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1, F.lit(seconds).cast("long")))).drop("before", "most", "whole")


def capped_background(meta: DataFrame, classes: Sequence[str], background: str = "background", row: str = "row_id", seed: int = 42) -> DataFrame:
    """Shuffled background rows up to and with the one that crosses the largest vessel class's total;
    vessel rows all stay."""
    totals = class_totals(meta, classes).where(F.col("label") != background)
    b = meta.where(F.col("label") == background).withColumn("at", shuffled(F.col(row), seed))
    b = running_before(b, ("label",), "at", (row,), F.col("duration_us"), "before_us", SHUFFLE_BLOCK).drop("at")
    b = b.crossJoin(_scalars(totals, most=F.max("total_us"))).where("before_us <= most").drop("before_us", "most")
    vessels = [c for c in classes if c != background]
    return b.unionByName(meta.where(F.col("label").isin(*vessels)).select(*b.columns))


def split(meta: DataFrame, classes: Sequence[str], validation: float = 0.2, test: float = 0.1, row: str = "row_id", seed: int = 42) -> DataFrame:
    """Adds ``split``: of the shuffled rows the first share is test, the next validation, the rest
    train; shares are of smallest class times number of classes."""
    totals = class_totals(meta, classes)
    d = meta.withColumn("at", shuffled(F.col(row), seed))
    d = running_before(d, (), "at", (row,), F.lit(1).cast("long"), "position", SHUFFLE_BLOCK).drop("at")
    d = d.crossJoin(_scalars(totals, base=F.min("n") * len(classes)))
    a = F.floor(F.col("base") * test)
    b = a + F.floor(F.col("base") * validation)
    return d.withColumn("split", F.when(F.col("position") < a, "test").when(F.col("position") < b, "validation").otherwise("train")).drop("position", "base")
