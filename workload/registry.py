"""Registration of queries next to their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.session import pin_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps leave as zone-less UTC, the type the given tables use."""
    moments = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in moments}) if moments else df


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) callable; without ``sql`` the driver checks rows only."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(build(pin_utc(spark), sf_dir.rstrip("/")))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add
