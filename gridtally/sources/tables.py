"""Partitioned Parquet tables: tiers rewritten bucket by bucket, and delta tables of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally import schemas
from gridtally.operators.rollups import KEYS
from gridtally.session import saved
from gridtally.sources import files

# Folder columns of each tier, derived from bucket_start: hourly tables by day and hour.
TIER_FOLDERS = {"hourly": ["dt", "hour"], "daily": ["dt"], "weekly": ["dt"]}
_FOLDER_TYPES = {"dt": T.DateType(), "hour": T.IntegerType()}


def _with_folders(rows: DataFrame, tier: str) -> DataFrame:
    made = {"dt": F.to_date("bucket_start"), "hour": F.hour("bucket_start")}
    return rows.withColumns({name: made[name] for name in TIER_FOLDERS[tier]})


def read_tier(spark: SparkSession, path: str, tier: str) -> DataFrame:
    folders = [T.StructField(n, _FOLDER_TYPES[n]) for n in TIER_FOLDERS[tier]]
    return spark.read.schema(T.StructType(schemas.TIER_ROW.fields + folders)).parquet(path)


def write_tier(rows: DataFrame, path: str, tier: str, mode: str = "append") -> None:
    """Append rows to a tier, sorted inside each file so row groups can be skipped on reads."""
    _sorted_writer(rows, tier).mode(mode).parquet(path)


def _sorted_writer(rows: DataFrame, tier: str):
    folders = TIER_FOLDERS[tier]
    placed = _with_folders(rows.select(*KEYS, "count"), tier).hint("rebalance", *folders)
    return placed.sortWithinPartitions(*folders, *KEYS).write.partitionBy(*folders)


def replace_buckets(rows: DataFrame, path: str, tier: str, buckets: list) -> None:
    """Make the given buckets of a tier hold exactly ``rows``, however often it is run.

    ``rows`` is computed and written to the shared folder first: a failure while computing leaves
    the table as it was, and rows may be computed from the table itself. Buckets that got rows are
    then swapped in one dynamic partition overwrite; the folders of buckets that are now empty,
    which such an overwrite would leave alone, are removed through the file system. The number of Spark
    jobs does not depend on the number of buckets. Other buckets are not touched.
    """
    spark = rows.sparkSession
    # A row per replaced bucket: the list came from the caller.
    wanted = spark.createDataFrame([(str(b),) for b in buckets], "bucket string")
    wanted = wanted.select(F.col("bucket").cast("timestamp").alias("bucket_start")).distinct()
    staged = saved(rows.join(wanted, "bucket_start", "left_semi").select(*KEYS, "count"), "replace")
    filled = staged.select("bucket_start").distinct()
    empty = _with_folders(wanted.join(filled, "bucket_start", "left_anti"), tier).collect()
    _sorted_writer(staged, tier).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    files.remove_folders(spark, path, ["/".join(f"{n}={b[n]}" for n in TIER_FOLDERS[tier]) for b in empty])


def append_delta(rows: DataFrame, path: str, batch_id: int, by: list[str]) -> None:
    """Write one micro-batch's rows into its own folder; a replayed batch overwrites itself."""
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batch={batch_id}")


def read_deltas(
    spark: SparkSession, path: str, schema: T.StructType, base: str | None = None, folded: int | None = None
) -> DataFrame:
    """All micro-batches' rows, with the ``batch`` folder column.

    With a compacted ``base`` that holds the batches up to ``folded``, only later folders are read
    next to it.
    """
    full = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    deltas = spark.read.schema(full).option("basePath", path).parquet(path)
    if base is None:
        return deltas
    old = spark.read.schema(schema).parquet(base).withColumn("batch", F.lit(folded).cast("bigint"))
    return deltas.filter(F.col("batch") > folded).unionByName(old)


def current_history(deltas: DataFrame) -> DataFrame:
    """History with insert-as-overwrite: the last written row of each key."""
    keys = ["user_id", "day", "listened_at", "event_id"]
    order = Window.partitionBy(*keys).orderBy(F.desc("batch"), F.desc("position"), "song_id", "provider")
    return deltas.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "batch", "position")


def compact(rows: DataFrame, path: str, by: list[str], order: list[str]) -> None:
    """Write folded rows as few sorted files per folder, into a new table path."""
    placed = rows.hint("rebalance", *by) if by else rows.hint("rebalance")
    placed.sortWithinPartitions(*by, *order).write.partitionBy(*by).parquet(path)
