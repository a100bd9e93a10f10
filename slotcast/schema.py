"""Fixed schemas of the domain tables and the check applied on read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEATHER_COLUMNS = [
    "apparent_temperature",
    "dew_point",
    "humidity",
    "temperature",
    "cloud_cover",
    "wind_bearing",
    "wind_speed",
]


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_text, _int, _real = T.StringType(), T.IntegerType(), T.DoubleType()
_time, _date = T.TimestampNTZType(), T.DateType()

READINGS = _struct(("series_id", _text), ("ts", _time), ("mw", _real), ("feed", _text))
LOAD = _struct(("series_id", _text), ("datetime", _time), ("block_load", _real))
WEATHER = _struct(
    ("series_id", _text), ("datetime", _time), *[(name, _real) for name in WEATHER_COLUMNS]
)
FORECAST = _struct(
    ("series_id", _text),
    ("date", _date),
    ("start_time", _text),
    ("end_time", _text),
    ("forecast", _real),
    ("horizon", _int),
    ("version", _text),
    ("created_at", _time),
    ("revision_no", _int),
)
FORECAST_LATEST = _struct(*[(f.name, f.dataType) for f in FORECAST if f.name != "revision_no"])
ACCURACY = _struct(
    ("series_id", _text),
    ("date", _date),
    ("time", _text),
    ("block_load", _real),
    ("forecast", _real),
    ("mae", _real),
    ("mae_4", _real),
    ("mae_12", _real),
    ("mae_96", _real),
    ("avg_load_4", _real),
    ("avg_load_12", _real),
    ("avg_load_96", _real),
    ("horizon", _int),
    ("version", _text),
)
DEVIATION = _struct(
    ("series_id", _text),
    ("date", _date),
    ("start_time", _text),
    ("end_time", _text),
    ("previous_revision_forecast", _real),
    ("current_revision_forecast", _real),
    ("deviation", _real),
    ("deviation_value", _int),
    ("created_at", _time),
    ("revision_no", _int),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema``; NaN in real columns becomes null.

    A missing column raises when the plan is analysed, before any task runs.
    """
    columns = []
    for field in schema:
        column = F.col(field.name).cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            column = F.when(~F.isnan(column), column)
        columns.append(column.alias(field.name))
    return df.select(*columns)
