"""Intermediate tables, tightly compressed, whose shuffle files go as soon as the table is written."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gridtally.session import saved

_CLEAN_UP = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for one block; those before come back after it."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stored(df: DataFrame, name: str, **conf: str) -> DataFrame:
    """Like ``saved``, with extra settings (dots as two underscores) while it runs."""
    with settings(df.sparkSession, _CLEAN_UP | {k.replace("__", "."): v for k, v in conf.items()}):
        return saved(df, name)
