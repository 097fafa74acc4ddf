"""Text, JSON, CSV, Arrow and XML-in-text inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import times

# fixed values: the form of an AIS line, and the fields of a water reading
LINE = r"^\w{15}\.\w{4} !"
READINGS = ("t1", "c1", "p1", "sal", "sv")


def file_name(path: Column | None = None) -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path") if path is None else path, "/"), -1)


def name_parts(name: Column) -> tuple[Column, Column]:
    """(device, start) of ``DEVICE_20200131T235959.123Z....``."""
    return F.regexp_extract(name, r"^([^_]+)_", 1), times.parse_compact(F.regexp_extract(name, r"_(\d{8}T\d{6}\.\d{3}Z)", 1))


def split_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines of the AIS form, split into ``ts`` (TIMESTAMP_NTZ) and ``payload``; others go."""
    parts = F.split(text, "Z ", 2)
    d = lines.where(F.col(text).rlike(LINE)).withColumn("_parts", parts).where(F.size("_parts") == 2)
    d = d.withColumns({"ts": times.parse_compact(F.concat(F.get("_parts", F.lit(0)), F.lit("Z"))), "payload": F.get("_parts", F.lit(1))})
    return d.drop("_parts", text)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(file_name().alias("file"), "value")


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """JSON arrays of sparse messages; absent keys are NULL."""
    return schemas.without_nan(spark.read.schema(schemas.POSITION).json(path, multiLine=True).withColumn("file", file_name()))


def read_deployments(spark: SparkSession, path: str) -> DataFrame:
    """One CSV per device, the file's stem being the device, or a folder ``device=NAME`` each."""
    d = spark.read.schema(schemas.DEPLOYMENT).option("recursiveFileLookup", "true").csv(path, header=True)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/device=([^/]+)/", 1)
    device = F.when(folder != "", folder).otherwise(F.regexp_replace(file_name(), r"\.csv$", ""))
    return d.withColumn("device", device).where("begin is not null and end is not null")


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return schemas.without_nan(spark.read.schema(schema).csv(path, header=True))


def read_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A CSV of one of the data sets' own forms: ``schemas.FORMS`` has their names and columns."""
    return read_csv(spark, path, schemas.FORMS[kind])


def read_arrow(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Legacy Arrow IPC (Feather) files, whole files as binary, decoded on the executors."""
    import pyarrow as pa

    wanted = spark.createDataFrame([], schema).schema

    def run(batches):
        import io

        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(wanted)
        for b in batches:
            for content in b.column(0).to_pylist():
                t = pa.ipc.open_file(io.BytesIO(content)).read_all()
                t = pa.table({f.name: t[f.name].cast(f.type) if f.name in t.column_names else pa.nulls(len(t), f.type) for f in target})
                yield from t.to_batches()

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, wanted)


def parse_water(lines: DataFrame, text: str = "value") -> DataFrame:
    """``timestamp <?xml ...>`` lines to date and readings; lines without exactly one marker go.

    The path datapacket/data is cut out once, each reading from that by a pattern of its own: no
    reader is set up for a row.  A reading that is absent or no number is NULL.
    """
    d = lines.withColumn("_parts", F.split(text, r"<\?xml", -1)).where(F.size("_parts") == 2)
    d = d.withColumns({"date": times.parse_compact(F.trim(F.get("_parts", F.lit(0)))), "_body": F.regexp_extract(F.get("_parts", F.lit(1)), r"(?s)<datapacket\b[^>]*>.*?<data\b[^>]*>(.*?)</data\s*>", 1)})
    reading = lambda c: F.nanvl(F.regexp_extract("_body", rf"<{c}(?:\s[^>]*)?>([^<]*)</{c}\s*>", 1).try_cast("double"), F.lit(None).cast("double"))
    return d.withColumns({c: reading(c) for c in READINGS}).drop("_parts", "_body", text)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, length, modified) of files; contents are not read."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return d.select("path", file_name(F.col("path")).alias("name"), "length", F.col("modificationTime").alias("modified"))
