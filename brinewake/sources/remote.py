"""Remote archive as a Spark data source: file listings per deployment and bounded fetches.

The client is injected (any object with ``list(filter) -> names`` and ``fetch(name) -> bytes``), so
that credentials come from the environment of the caller and tests need no network.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def query_deployments(spark: SparkSession, devices: Sequence[str], client: Callable[[], object]) -> DataFrame:
    """Deployments of the devices, one request a task: (device, begin, end, latitude, longitude, depth,
    location); those without begin or end go.

    The client's ``deployments(device)`` gives dicts with those keys.
    """
    kind = "device string, begin string, end string, latitude double, longitude double, depth double, location string"
    names = spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in devices])).alias("device"))

    def run(batches: Iterator[pa.RecordBatch]):
        api = client()
        for b in batches:
            for device in b.column(0).to_pylist():
                rows = [{**r, "device": device} for r in api.deployments(device)]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(f.split(" ")[0]) for r in rows], pa.float64() if f.endswith("double") else pa.string()) for f in kind.split(", ")], [f.split(" ")[0] for f in kind.split(", ")])

    found = names.repartition(len(devices), "device").mapInArrow(run, kind)
    return found.where((F.coalesce("begin", F.lit("")) != "") & (F.coalesce("end", F.lit("")) != ""))


def write_deployments(found: DataFrame, folder: str) -> None:
    """A folder a device, rows by begin: the form that ``text.read_deployments`` reads."""
    found.repartition("device").sortWithinPartitions("device", "begin").write.mode("overwrite").partitionBy("device").csv(folder, header=True)


def deployment_filters(deployments: DataFrame, kind: str, devices: dict[str, Column | str], extensions: dict[str, str]) -> DataFrame:
    """Request rows (device, begin, end, extension): recordings by each hydrophone's own code,
    position and water files by the fixed device given for the kind."""
    device = devices[kind]
    return deployments.select((F.lit(device) if isinstance(device, str) else device).alias("device"), "begin", "end", F.lit(extensions[kind]).alias("extension"))


def list_files(filters: DataFrame, client: Callable[[], object], parallel: int = 20) -> DataFrame:
    """(device, name) of all remote files, one request row a task at most ``parallel`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]):
        api = client()
        for b in batches:
            for row in b.to_pylist():
                names = sorted(api.list(row))
                yield pa.RecordBatch.from_arrays([pa.array([row["device"]] * len(names), pa.string()), pa.array(names, pa.string())], ["device", "name"])

    return filters.repartition(parallel).mapInArrow(run, "device string, name string").distinct()


def fetch(names: DataFrame, client: Callable[[], object], parallel: int = 20) -> DataFrame:
    """(name, content) of the files; at most ``parallel`` requests run at once, one file in memory each."""

    def run(batches: Iterator[pa.RecordBatch]):
        api = client()
        for b in batches:
            for name in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([api.fetch(name)], pa.binary())], ["name", "content"])

    return names.select("name").repartition(parallel).mapInArrow(run, "name string, content binary")
