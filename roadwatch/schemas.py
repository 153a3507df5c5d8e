"""Fixed schemas of the records the jobs exchange."""

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields])


_S, _L, _D, _I = StringType(), LongType(), DoubleType(), IntegerType()

SIGHTING = _schema(
    ("area_id", _S), ("road_id", _S), ("monitor_id", _S), ("camera_id", _S),
    ("action_time", _L), ("car", _S), ("speed", _D),
)
SPEED_LIMIT = _schema(
    ("area_id", _S), ("road_id", _S), ("monitor_id", _S), ("speed_limit", _D),
)
SPEEDING_RECORD = _schema(
    ("car", _S), ("monitor_id", _S), ("road_id", _S), ("real_speed", _D),
    ("limit_speed", _D), ("action_time", _L),
)
BEHAVIOUR_EVENT = _schema(
    ("guid", _L), ("event_id", _S), ("timestamp", _L), ("act_time", _I),
)
CLICK = _schema(("user", _S), ("page", _S), ("seconds", _L))
USER_EVENT = _schema(("id", _S), ("event", _S))
