"""Writers.  Every one is idempotent: a finished key is left out by a manifest, not by luck."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Parquet, partitioned by columns that later scans prune on."""
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def append_csv(df: DataFrame, path: str) -> None:
    """Append; each row of ``df`` is written once however many writers there are."""
    df.write.mode("append").csv(path, header=True)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path, ignoreNullFields=True)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(F.col(df.columns[0]).cast("string").alias("value")).write.mode(mode).text(path)


def write_new(df: DataFrame, path: str, key: str) -> None:
    """Append only rows whose key is not yet in the table at ``path``."""
    spark = df.sparkSession
    from pyspark.errors import AnalysisException

    try:
        done = spark.read.parquet(path).select(key).distinct()
        df = df.join(done, key, "left_anti")
    except AnalysisException:  # nothing written yet
        pass
    df.write.mode("append").parquet(path)
