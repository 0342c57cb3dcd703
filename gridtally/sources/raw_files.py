"""Raw events as landed: immutable files under dt=YYYY-MM-DD/hour=HH, by UTC event hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import schemas
from gridtally.functions import as_instant
from gridtally.operators import params
from gridtally.sources import files

# Default folders under the bucket and the size of one landed file.
TOPIC = "heatmap.events.raw"
JSON_FOLDER, PARQUET_FOLDER = "topics", "topics-parquet"
RECORDS_PER_FILE = 5000


def raw_base(bucket: str, file_format: str = "json", folder: str = JSON_FOLDER, topic: str = TOPIC) -> str:
    """Root of a topic's landed files. Parquet swaps the folder only when it was left at default."""
    folder = folder.strip("/")
    if file_format == "parquet" and folder == JSON_FOLDER:
        folder = PARQUET_FOLDER
    return f"{bucket.rstrip('/')}/{folder}/{topic}"


def _load(spark: SparkSession, base: str, file_format: str, folders: list[str] | None = None) -> DataFrame:
    """Landed rows of the named folders only, or of all.

    Only these folders are listed, however many others there are. Where a streaming sink has written, its
    log names the finished files; it is read instead of any folder, so unfinished ones stay unseen.
    """
    reader = spark.read.schema(schemas.LANDED_EVENT).format(file_format)
    if folders is None or files.existing(spark, [f"{base}/_spark_metadata"]):
        return reader.load(base)
    there = files.existing(spark, [f"{base}/{folder}" for folder in folders])
    if not there:
        return spark.createDataFrame([], schemas.LANDED_EVENT)
    return reader.option("basePath", base).load(there)


def _read(spark: SparkSession, base: str, file_format: str, dt, hour) -> DataFrame:
    if dt is None:
        rows = _load(spark, base, file_format)
        return rows if hour is None else rows.filter(F.col("hour") == params.hour(hour))
    day = params.day(dt)
    if hour is None:
        return _load(spark, base, file_format, [f"dt={day}"]).filter(F.col("dt") == F.lit(day))
    at = params.hour(hour)
    rows = _load(spark, base, file_format, [f"dt={day}/hour={at:02d}"])
    return rows.filter((F.col("dt") == F.lit(day)) & (F.col("hour") == at))


def read_raw_json(spark: SparkSession, base: str, dt=None, hour=None) -> DataFrame:
    """JSON lines, all of them or one day or hour; the schema is given, never inferred."""
    return _read(spark, base, "json", dt, hour)


def read_raw_parquet(spark: SparkSession, base: str, dt=None, hour=None) -> DataFrame:
    return _read(spark, base, "parquet", dt, hour)


def read_bucket_partition(spark: SparkSession, base: str, dt, hour, file_format: str = "json") -> DataFrame:
    """Exactly one hour folder. The filter is on partition columns, so no other folder is opened."""
    return _read(spark, base, file_format, params.day(dt), params.hour(hour))


def read_bucket_range(spark: SparkSession, base: str, first, last, file_format: str = "json") -> DataFrame:
    """All hour folders from day ``first`` to day ``last``, both included."""
    low, high = params.day(first), params.day(last)
    there = files.children(spark, base)
    days = [name for name in there if f"dt={low}" <= name <= f"dt={high}"]
    # Days may lie below other folders (by client); then the whole tree is listed.
    by_day = not any("=" in name and not name.startswith("dt=") for name in there)
    rows = _load(spark, base, file_format, days if by_day else None)
    return rows.filter(F.col("dt").between(F.lit(low), F.lit(high)))


def read_files_since(spark: SparkSession, base: str, since, file_format: str = "json") -> DataFrame:
    """All landed events of files that were written at ``since`` or later.

    An event cannot have been received after its file was written, so whatever arrived from ``since`` on is
    among them. The condition is on the file's own time, so older files are listed but not opened.
    """
    rows = _load(spark, base, file_format)
    return rows.filter(F.col("_metadata.file_modification_time") >= F.lit(str(since)).cast("timestamp"))


def at_folder_hour(raw: DataFrame) -> DataFrame:
    """Landed events whose time is the hour of their folder, which is what they count for.

    So an event whose own time does not parse, or is of another hour, counts alike in every job.
    """
    start = F.make_timestamp(F.year("dt"), F.month("dt"), F.dayofmonth("dt"), F.col("hour"), F.lit(0), F.lit(0))
    return raw.withColumn("event_time", start)


def with_landing_hour(events: DataFrame) -> DataFrame:
    """Add the folder columns dt and hour from the event time."""
    instant = as_instant(F.col("event_time"), events.schema["event_time"].dataType.simpleString())
    return events.withColumns(
        {"dt": F.date_format(instant, "yyyy-MM-dd"), "hour": F.date_format(instant, "HH")}
    )


def land_batch(events: DataFrame, base: str, file_format: str = "json", mode: str = "append") -> None:
    """Write raw events into hour folders.

    REBALANCE gathers each hour into few files and lets AQE split an hour that is too big for one
    task, so one busy hour does not become one writer.
    """
    rows = with_landing_hour(events).hint("rebalance", "dt", "hour")
    rows.write.mode(mode).partitionBy("dt", "hour").format(file_format).option(
        "compression", "snappy" if file_format == "parquet" else "none"
    ).save(base)
