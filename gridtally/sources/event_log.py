"""Keyed log records: encoding, and batch or streaming reads from Kafka or files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import schemas

POINTER_TOPIC, LISTEN_TOPIC = "heatmap.events.raw", "user.listen.raw"


def encode_log_records(rows: DataFrame, key: list[str], fields: list[str] | None = None) -> DataFrame:
    """(key, value) records: key parts joined by ``|``, value the row as JSON.

    Unset optional fields are left out of the JSON.
    """
    body = F.to_json(F.struct(*(fields or rows.columns)))
    return rows.select(F.concat_ws("|", *key).alias("key"), body.alias("value"))


def encode_pointer_events(events: DataFrame) -> DataFrame:
    return encode_log_records(events, ["client_id", "screen_id"], schemas.RAW_EVENT.fieldNames())


def encode_listens(listens: DataFrame) -> DataFrame:
    return encode_log_records(listens, ["user_id"], schemas.LISTEN_EVENT.fieldNames())


def write_log(records: DataFrame, brokers: str, topic: str) -> None:
    """Publish to Kafka; needs the Kafka connector package on the class path."""
    records.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def read_kafka_stream(spark: SparkSession, brokers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Subscribe to a topic; needs the Kafka connector package on the class path."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    return stream.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def read_file_stream(
    spark: SparkSession, path: str, schema=schemas.LOG_RECORD, file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of files as a stream: log records or any rows with a known schema."""
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
