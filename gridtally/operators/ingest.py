"""Admission of event batches: validation, routing, stamping, exploding, decoding."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.functions import is_blank, is_rfc3339, strip_blanks, utc_text, whole_number

# Batch size limit and the characters and length of a safe id.
MAX_BATCH_EVENTS = 5000
SAFE_ID = r"[a-zA-Z0-9_\-\.]{1,128}"


def _event_fault(event: Column) -> Column:
    # A coordinate that is not sent counts as 0.0.
    x, y = (F.coalesce(event[name], F.lit(0.0)) for name in ("x_norm", "y_norm"))
    outside = (x < 0) | (x > 1) | (y < 0) | (y > 1)
    return (
        F.when(is_blank(event["event_type"]), "missing_event_type")
        .when(outside, "invalid_normalized_coords")
        .when(~is_rfc3339(event["event_time"]), "invalid_event_time")
    )


def validate_batch(batches: DataFrame) -> DataFrame:
    """Add ``reason``: the first rule the batch breaks, NULL when it is accepted.

    Batch rules come first, then the events in array order, each with its own first broken rule.
    """
    count = F.coalesce(F.size("events"), F.lit(0))
    faults = F.filter(F.transform("events", _event_fault), lambda fault: fault.isNotNull())
    reason = (
        F.when(is_blank(F.col("client_id")), "missing_client_id")
        .when(is_blank(F.col("screen_id")), "missing_screen_id")
        .when(count <= 0, "empty_events")
        .when(count > MAX_BATCH_EVENTS, "too_many_events")
        .otherwise(F.get(faults, F.lit(0)))
    )
    return batches.withColumn("reason", reason)


def route_rejects(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted batches, rejected batches with their reason)."""
    return validated.filter("reason IS NULL").drop("reason"), validated.filter("reason IS NOT NULL")


def enrich_received_at(df: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Overwrite any client-sent received_at with the arrival time."""
    arrival = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    kind = df.schema["received_at"].dataType if "received_at" in df.columns else T.TimestampType()
    return df.withColumn("received_at", utc_text(arrival) if kind == T.StringType() else arrival)


def explode_batches(batches: DataFrame) -> DataFrame:
    """One row per event in the raw event layout; ids are copied as sent, not trimmed.

    A received_at on the batch (its arrival) wins over whatever the client put on the events.
    """
    stamped = "received_at" in batches.columns
    carried = ["client_id", "screen_id", "batch_id"] + (["received_at"] if stamped else [])
    return batches.select(*carried, F.explode("events").alias("event")).select(
        "client_id", "screen_id", "batch_id", "event.event_time",
        F.coalesce("event.x_norm", F.lit(0.0)).alias("x_norm"),
        F.coalesce("event.y_norm", F.lit(0.0)).alias("y_norm"),
        "event.event_type", "received_at" if stamped else "event.received_at",
    )


def decode_log(records: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, undecodable records). Bad records are set aside, never fatal.

    A record that holds no object (blank, ``null``, an array, a bare value) is bad too; ``{}`` is an
    object with nothing set, hence good. The parsed row is taken out with ``inline``, so a record is parsed
    once, not once per use.
    """
    marked = T.StructType(schema.fields + [T.StructField("_bad", T.StringType())])
    row = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    parsed = records.select(*[F.col(c).alias(f"_{c}") for c in records.columns], F.inline(F.array(row)))
    holds_object = F.coalesce(F.col("_value").rlike(r"^\s*\{"), F.lit(False))
    broken = ~holds_object | F.col("_bad").isNotNull()
    good = parsed.filter(~broken).select(*schema.fieldNames())
    return good, parsed.filter(broken).select(*[F.col(f"_{c}").alias(c) for c in records.columns])


def coerce_cells(rows: DataFrame) -> DataFrame:
    """Numbers or whole-number text to int cells and a bigint count; other rows are skipped."""
    targets = {"cell_x": "int", "cell_y": "int", "count": "bigint"}
    typed = rows.withColumns(
        {
            name: whole_number(F.col(name), rows.schema[name].dataType.simpleString(), kind)
            for name, kind in targets.items()
        }
    )
    return typed.dropna(subset=list(targets))


def valid_ids(requests: DataFrame, columns: tuple[str, ...] = ("client_id", "screen_id")) -> DataFrame:
    """Trim the id columns and add ``error``: the first id that is not safe, else NULL.

    The pattern ends at the very end of the id, since ``$`` would let a last line feed pass.
    """
    trimmed = requests.withColumns({name: strip_blanks(F.col(name)) for name in columns})
    checks = [
        F.when(~F.coalesce(F.col(name).rlike(rf"^{SAFE_ID}\z"), F.lit(False)), f"invalid_{name}")
        for name in columns
    ]
    return trimmed.withColumn("error", F.coalesce(*checks))
