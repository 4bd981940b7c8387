"""The two table shapes of the library and the key that identifies a series.

``points`` is the tall form, one row per datapoint, and is what aggregates,
filters and joins run on. ``blocks`` holds many points of one series in a row
and serves packing, unpacking and sinks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.text import percent_encode

POINT_TYPE = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("elev", T.LongType()),
        T.StructField("v_long", T.LongType()),
        T.StructField("v_double", T.DoubleType()),
        T.StructField("v_bool", T.BooleanType()),
        T.StructField("v_str", T.StringType()),
    ]
)
POINT_FIELDS = POINT_TYPE.fieldNames()
VALUE_FIELDS = ["v_long", "v_double", "v_bool", "v_str"]

_STRING_MAP = T.MapType(T.StringType(), T.StringType())
METADATA_FIELDS = ["class", "labels", "attributes"]
HEADER_FIELDS = ["base", "bucketcount", "bucketspan", "lastbucket"]

POINTS_SCHEMA = T.StructType(
    [
        T.StructField("class", T.StringType()),
        T.StructField("labels", _STRING_MAP),
        T.StructField("attributes", _STRING_MAP),
        *POINT_TYPE.fields,
    ]
)
BLOCKS_SCHEMA = T.StructType(
    [
        *POINTS_SCHEMA.fields[:3],
        *[T.StructField(name, T.LongType()) for name in HEADER_FIELDS],
        T.StructField("count", T.LongType()),
        T.StructField("points", T.ArrayType(POINT_TYPE)),
    ]
)

# A series is identified by its class and the canonical text of its labels.
SERIES_KEY = ["class", "label_key"]


def empty_string_map() -> Column:
    return F.create_map().cast(_STRING_MAP)


def label_text(labels: Column) -> Column:
    """Canonical text of a label map: ``k=v`` sorted by key, percent-encoded."""
    entries = F.sort_array(F.map_entries(F.coalesce(labels, empty_string_map())))
    pairs = F.transform(
        entries,
        lambda e: F.concat(
            percent_encode(e["key"]), F.lit("="), percent_encode(F.coalesce(e["value"], F.lit("")))
        ),
    )
    return F.array_join(pairs, ",")


def known_label_text(labels: Mapping[str, Column]) -> Column:
    """``label_text`` for label names known when the plan is built.

    It needs no higher-order function, so it stays inside generated code.
    """
    pairs = [
        F.concat(percent_encode(F.lit(name)), F.lit("="), percent_encode(labels[name]))
        for name in sorted(labels)
    ]
    return F.concat_ws(",", *pairs) if pairs else F.lit("")


def with_series_key(df: DataFrame) -> DataFrame:
    """Make ``class`` non-null and add ``label_key`` unless it is present."""
    if "label_key" in df.columns:
        return df
    return df.withColumns(
        {"class": F.coalesce("class", F.lit("")), "label_key": label_text(F.col("labels"))}
    )


def selector_text(class_: Column | str = "class", label_key: Column | str = "label_key") -> Column:
    """``class{k=v,...}``, the canonical selector of a series."""
    class_ = F.col(class_) if isinstance(class_, str) else class_
    label_key = F.col(label_key) if isinstance(label_key, str) else label_key
    return F.concat(percent_encode(class_), F.lit("{"), label_key, F.lit("}"))


def with_selector(df: DataFrame) -> DataFrame:
    """Add the canonical ``selector`` of each row's series."""
    return with_series_key(df).withColumn("selector", selector_text())


def typed_value(value: Column, data_type: T.DataType) -> dict[str, Column]:
    """The four value columns, with ``value`` in the one of its type."""
    columns = {name: F.lit(None).cast(POINT_TYPE[name].dataType) for name in VALUE_FIELDS}
    if isinstance(data_type, T.BooleanType):
        columns["v_bool"] = value
    elif isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        columns["v_long"] = value.cast("bigint")
    elif isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        columns["v_double"] = value.cast("double")
    elif isinstance(data_type, (T.StringType, T.VarcharType, T.CharType)):
        columns["v_str"] = value.cast("string")
    else:
        raise ValueError(f"unsupported value type: {data_type.simpleString()}")
    return columns


def to_points(
    df: DataFrame,
    class_: Column,
    ts: Column,
    value: Column,
    *,
    labels: Mapping[str, Column] | None = None,
    attributes: Mapping[str, Column] | None = None,
    lat: Column | None = None,
    lon: Column | None = None,
    elev: Column | None = None,
    keep: Iterable[str] = (),
    drop_null_values: bool = False,
) -> DataFrame:
    """Read any table as points. ``ts`` is in ticks; absent parts are null.

    A null label value counts as the empty string. A null ``value`` fails the
    query, or with ``drop_null_values`` its row is no point: a point without a
    value has no text form, so it must not be counted either.
    """
    if (lat is None) != (lon is None):
        raise ValueError("lat and lon come together")
    label_values = {
        name: F.coalesce(column.cast("string"), F.lit("")) for name, column in (labels or {}).items()
    }
    attribute_values = {
        name: F.coalesce(column.cast("string"), F.lit("")) for name, column in (attributes or {}).items()
    }

    def as_map(values: Mapping[str, Column]) -> Column:
        if not values:
            return empty_string_map()
        return F.create_map(*[part for name in sorted(values) for part in (F.lit(name), values[name])])

    def optional(column: Column | None, type_name: str) -> Column:
        return F.lit(None).cast(type_name) if column is None else column.cast(type_name)

    value_type = df.select(value.alias("value")).schema["value"].dataType
    columns = {
        "class": F.coalesce(class_.cast("string"), F.lit("")),
        "labels": as_map(label_values),
        "attributes": as_map(attribute_values),
        "label_key": known_label_text(label_values),
        "ts": ts.cast("bigint"),
        "lat": optional(lat, "double"),
        "lon": optional(lon, "double"),
        "elev": optional(elev, "bigint"),
        **typed_value(value, value_type),
    }
    has_value = value.isNotNull()
    if not drop_null_values:
        failure = F.raise_error(F.lit("a point without a value")).cast("boolean")
        has_value = F.when(has_value, True).otherwise(failure)
    return df.where(has_value).select(
        *[column.alias(name) for name, column in columns.items()], *keep
    )


def point_struct() -> Column:
    """The point columns of a row as one struct, ordered as ``POINT_TYPE``."""
    return F.struct(*POINT_FIELDS)


def arity() -> Column:
    """Fields of a point in its shortest form, from 2 (tick, value) to 5."""
    has_location = F.col("lat").isNotNull()
    has_elevation = F.col("elev").isNotNull()
    return (
        F.when(has_location & has_elevation, 5)
        .when(has_location, 4)
        .when(has_elevation, 3)
        .otherwise(2)
    )
