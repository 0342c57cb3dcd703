"""Admission of event batches as two streaming queries over one source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtally.functions import utc_text
from gridtally.operators import ingest
from gridtally.streaming import sinks, streams


def admit_batches(
    batches: Callable[[], DataFrame], base: str, quarantine: str, checkpoints: str,
    file_format: str = "json", every: str | None = sinks.LAND_EVERY, hour_writers: int = 16,
) -> list[StreamingQuery]:
    """Validate, stamp, deduplicate, explode and land event batches; keep rejects with a reason.

    ``batches`` opens the stream, once per query. Batches are stamped with the time of their
    micro-batch, whatever received_at they were sent with. Dedup state and landed files commit together, so
    a batch whose landing failed is not mistaken for a duplicate when it is retried. ``hour_writers`` is how
    many tasks write one hour: choose it by the size of the busiest hour of a micro-batch.
    """
    accepted, _ = ingest.route_rejects(ingest.validate_batch(batches()))
    _, rejected = ingest.route_rejects(ingest.validate_batch(batches()))
    events = ingest.explode_batches(streams.dedup_batches_stream(ingest.enrich_received_at(accepted)))
    events = events.withColumn("received_at", utc_text(F.col("received_at")))
    landed = sinks.land_events(events, base, f"{checkpoints}/landed", file_format, every, hour_writers=hour_writers)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    kept = (
        rejected.writeStream.format("parquet")
        .option("path", quarantine)
        .option("checkpointLocation", f"{checkpoints}/quarantine")
        .trigger(**trigger)
        .start()
    )
    return [landed, kept]
