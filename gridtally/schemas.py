"""Fixed schemas of the rows the engine reads and writes."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

BATCH_EVENT = _struct(
    ("event_time", _S), ("x_norm", _D), ("y_norm", _D), ("event_type", _S), ("received_at", _S)
)

EVENT_BATCH = _struct(
    ("client_id", _S), ("screen_id", _S), ("batch_id", _S), ("events", T.ArrayType(BATCH_EVENT))
)

RAW_EVENT = _struct(
    ("client_id", _S), ("screen_id", _S), ("batch_id", _S), ("event_time", _S),
    ("x_norm", _D), ("y_norm", _D), ("event_type", _S), ("received_at", _S),
)

# Landing folders carry the event hour: dt=YYYY-MM-DD/hour=HH.
LANDED_EVENT = T.StructType(
    RAW_EVENT.fields + [T.StructField("dt", T.DateType()), T.StructField("hour", _I)]
)

TIER_ROW = _struct(
    ("client_id", _S), ("screen_id", _S), ("bucket_start", T.TimestampType()),
    ("cell_x", _I), ("cell_y", _I), ("count", _L),
)

LISTEN_EVENT = _struct(
    ("event_id", _S), ("user_id", _S), ("song_id", _S), ("provider", _S), ("listened_at", _L)
)

DAILY_COUNT = _struct(("user_id", _S), ("day", T.DateType()), ("song_id", _S), ("listen_count", _L))

LOG_RECORD = _struct(("key", _S), ("value", _S))

STATUS_EVENT = _struct(
    ("user_id", _S), ("provider", _S), ("status", _S), ("error", _S),
    ("ts", T.TimestampType()), ("seq", _L),
)
