"""Aggregate tables in an external database, through Spark's JDBC source.

Connection options (url, user, password, driver) are always passed in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridtally.operators import params


def jdbc_read_subquery(
    spark: SparkSession, options: dict[str, str], table: str, columns: list[str], where: str = "1 = 1",
    split: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """Read ``columns`` of the rows matching ``where``; both are evaluated by the database.

    ``split`` = (column, lower, upper, partitions) reads in parallel. Without it the read is one
    task, which is right only for a small result.
    """
    reader = spark.read.format("jdbc").options(**options)
    subquery = f"(SELECT {', '.join(columns)} FROM {table} WHERE {where}) sub"
    if split:
        column, lower, upper, parts = split
        if column not in columns:
            raise ValueError("split column must be selected")
        reader = reader.options(
            partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(parts)
        )
    return reader.option("dbtable", subquery).load()


def read_day(spark: SparkSession, options: dict[str, str], table: str, dt, partitions: int = 16) -> DataFrame:
    """One day of a finer tier, split by cell column over ``partitions`` reads."""
    day = params.day(dt)
    return _read_days(spark, options, table, f"DATE(bucket_start) = '{day}'", partitions)


def read_week(spark: SparkSession, options: dict[str, str], table: str, week_start, partitions: int = 16) -> DataFrame:
    from datetime import timedelta

    start = params.monday(week_start)
    where = f"DATE(bucket_start) BETWEEN '{start}' AND '{start + timedelta(days=6)}'"
    return _read_days(spark, options, table, where, partitions)


def _read_days(spark, options, table, where, partitions) -> DataFrame:
    columns = ["client_id", "screen_id", "bucket_start", "cell_x", "cell_y", "count"]
    return jdbc_read_subquery(spark, options, table, columns, where, ("cell_y", 0, 200, partitions))


def jdbc_append(rows: DataFrame, options: dict[str, str], table: str, batch_size: int = 10_000, writers: int = 16) -> None:
    """Append an aggregate; at most ``writers`` connections write at a time."""
    rows.coalesce(writers).write.format("jdbc").mode("append").options(**options).option(
        "dbtable", table
    ).option("batchsize", str(batch_size)).save()
