"""Shared helpers: Arrow row maps, scratch tables, connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``f`` to each Arrow batch; one row in memory at least, one batch at most."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                out = f(batch)
                if out is not None:
                    yield from [out] if isinstance(out, pa.RecordBatch) else out

    return df.mapInArrow(run, schema)


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that is unset, on one machine, a temporary folder of our own is set; a cluster without
    a shared folder is an error, since each executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="brinewake-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage there.

    The rows survive the loss of any executor.  An application's tables stand in one folder, which the
    driver deletes when it ends.
    """
    spark = df.sparkSession
    folder = f"{scratch_root(spark)}/tables/{spark.sparkContext.applicationId}"
    if folder not in _doomed:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _doomed.add(folder)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_doomed: set[str] = set()


def attach(rows: DataFrame, one: DataFrame, key: str, value: str, spread: str, n: str = "n", most: int = 1000) -> DataFrame:
    """``rows`` with column ``value`` of ``one`` by ``key``; NULL where there is none.

    ``one`` has a row for each key, with the number ``n`` of rows that have it (a written table: it is
    read three times).  No key makes a hot task: up to ``most`` keys are broadcast; of more keys, those
    with over 1 / ``most`` of all rows, fewer than ``most`` by their number, and the rest is joined by
    key.  There, rows that are done or have no key are dealt out by ``spread``.
    """
    values = one.select(F.col(key).alias("_key"), F.struct(F.col(value).alias("v")).alias("_one"))
    total, keys = one.agg(F.sum(n), F.count("*")).first()
    if keys <= most:
        return rows.join(F.broadcast(values), F.col(key) == F.col("_key"), "left").withColumn(value, F.col("_one.v")).drop("_key", "_one")
    hot = one.where(F.col(n) > total / most).select(F.col(key).alias("_hot"), F.struct(F.col(value).alias("v")).alias("_found"))
    d = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").drop("_hot")
    done = F.col("_found").isNotNull() | F.col(key).isNull()
    d = d.withColumn("_salt", F.when(done, F.pmod(F.hash(spread), F.lit(1 << 20)) + 1).otherwise(0))
    d = d.withColumn("_by", F.when(done, F.lit(None)).otherwise(F.col(key)))
    cold = one.where(F.col(n) <= total / most).select(F.col(key).alias("_key"), F.lit(0).alias("_none"), F.struct(F.col(value).alias("v")).alias("_one"))
    d = d.join(cold, F.col("_by").eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_none")), "left")
    return d.withColumn(value, F.coalesce(F.col("_found.v"), F.col("_one.v"))).drop("_key", "_none", "_one", "_found", "_salt", "_by")


def _with_least(d: DataFrame, hot: bool) -> DataFrame:
    """Adds m, the least v of each u; where there are many rows, a u of very many is not one task."""
    least = d.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return attach(d, cut(least), "u", "m", "v") if hot else d.join(least.drop("n"), "u")


def components(edges: DataFrame, src: str = "a", dst: str = "b", most_rounds: int = 60, many: int = 1_000_000) -> DataFrame:
    """Connected components of an undirected edge table: (node, component), component = least node.

    Alternating large-star and small-star rounds; every round is a few shuffles of the edge
    table, written to the shared folder, and the driver sees one count a round.  From ``many`` edges on
    hot nodes, such as a star's centre, are joined by broadcast.  Nodes without an edge are not returned.
    """
    pairs = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v").distinct()
    pairs = cut(pairs)
    for _ in range(most_rounds):
        before, hot = pairs, pairs.count() >= many
        # large star: each node's larger neighbours point to the least of the neighbourhood
        both = before.select("u", "v").unionByName(before.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, hot).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        # small star: each node's smaller neighbours, and itself, point to the least of them
        small = _with_least(cut(large) if hot else large, hot)
        pairs = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # done when every edge is a star's: no centre is itself a leaf
        if pairs.select("v").distinct().join(pairs.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty() and not _two_centres(pairs):
            return pairs.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node").unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _two_centres(pairs: DataFrame) -> bool:
    return not pairs.groupBy("u").agg(F.min("v").alias("x"), F.max("v").alias("y")).where("x <> y").isEmpty()
