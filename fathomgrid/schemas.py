"""Fixed schemas of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_STR, _LONG, _DOUBLE, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

OBJECTS = _fields(("key", _STR), ("size", _LONG), ("modified", _TS))

CALIBRATION = _fields(("DATASET_NAME", _STR), ("INSTRUMENT_NAME", _STR), ("CAL_STATE", _STR))

CRUISE_INDEX = _fields(
    ("cruise", _STR), ("ship", _STR), ("sensor", _STR), ("datagram", _STR),
    ("file_count", _LONG), ("total_size", _LONG), ("calibrated", T.BooleanType()),
    ("start_date", _STR), ("end_date", _STR),
)

NMEA = _fields(
    ("cruise", _STR), ("file_name", _STR), ("seq", _LONG), ("ts", _TS),
    ("latitude", _DOUBLE), ("longitude", _DOUBLE),
)

PINGS = _fields(("cruise", _STR), ("file_name", _STR), ("ping_idx", _LONG), ("ping_time", _TS))

SOUNDINGS = _fields(
    ("cruise", _STR), ("file_name", _STR), ("channel", _STR), ("frequency", T.FloatType()),
    ("ping_idx", _LONG), ("ping_time", _TS),
    ("echo_range", T.ArrayType(_DOUBLE)), ("sv", T.ArrayType(_DOUBLE)),
)

FILE_STATUS = _fields(
    ("file_name", _STR), ("cruise_name", _STR), ("ship_name", _STR), ("sensor_name", _STR),
    ("pipeline_status", _STR), ("pipeline_time", _TS), ("event_seq", _LONG), ("zarr_bucket", _STR), ("zarr_path", _STR),
    ("min_echo_range", T.DecimalType(18, 4)), ("max_echo_range", T.DecimalType(18, 4)),
    ("num_ping_time_dropna", _LONG), ("start_time", _STR), ("end_time", _STR),
    ("frequencies", T.ArrayType(_DOUBLE)), ("channels", T.ArrayType(_STR)),
)

CRUISE_CUBE = _fields(
    ("cruise", _STR), ("file_name", _STR), ("time_idx", _LONG), ("frequency", T.FloatType()),
    ("ts", _DOUBLE), ("latitude", T.FloatType()), ("longitude", T.FloatType()),
    ("sv", T.ArrayType(T.FloatType())), ("time_tile", _LONG),
)

CUBE_CHUNK = _fields(
    ("frequency", T.FloatType()), ("time_idx", _LONG), ("sv", T.ArrayType(T.FloatType())),
    ("cruise", _STR), ("time_tile", _LONG), ("depth_tile", T.IntegerType()), ("file_name", _STR),
)

# Columns of Spark's reader of whole files.
FILE_CONTENT = _fields(
    ("path", _STR), ("modificationTime", T.TimestampType()), ("length", _LONG), ("content", T.BinaryType()),
)

TIME_AXIS = _fields(
    ("time_idx", _LONG), ("ts", _DOUBLE), ("latitude", T.FloatType()), ("longitude", T.FloatType()),
    ("cruise", _STR), ("file_name", _STR),
)

DEPTH_AXIS = _fields(("depth_idx", T.IntegerType()), ("depth", _DOUBLE), ("cruise", _STR))

FEATURE = _fields(
    ("id", _STR), ("type", _STR),
    ("properties", _fields(("latitude", _DOUBLE), ("longitude", _DOUBLE))),
    ("geometry", _fields(("type", _STR), ("coordinates", T.ArrayType(_DOUBLE)))),
)

FEATURE_COLLECTION = _fields(("type", _STR), ("features", T.ArrayType(FEATURE)))

STAGE_MESSAGE = _fields(
    ("prefix", _STR), ("ship_name", _STR), ("cruise_name", _STR), ("sensor_name", _STR),
    ("input_bucket", _STR), ("output_bucket", _STR), ("input_file_name", _STR),
)

NOTIFICATION = _fields(
    ("Records", T.ArrayType(_fields(("Sns", _fields(("Message", _STR)))))),
)
