"""Converting nested values between the script form and the relational form.

In the relational form map keys are text, the elements of a set are wrapped in
one-field structs (a bag), and values of any other type are text. In the script
form a bag is an array of plain values and a struct is a list. The conversion
follows the type of the column, so it is built once per plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KEPT = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.StringType,
    T.BinaryType,
    T.TimestampType,
    T.TimestampNTZType,
    T.NullType,
)


def to_portable(column: Column, data_type: T.DataType) -> Column:
    """A value of ``data_type`` in relational form."""
    if isinstance(data_type, T.MapType):
        value_type = data_type.valueType
        keyed = F.transform_keys(column, lambda k, v: k.cast("string"))
        return F.transform_values(keyed, lambda k, v: to_portable(v, value_type))
    if isinstance(data_type, T.ArrayType):
        element_type = data_type.elementType
        if isinstance(element_type, T.StructType):
            return F.transform(column, lambda e: to_portable(e, element_type))
        return F.transform(column, lambda e: F.struct(to_portable(e, element_type).alias("x")))
    if isinstance(data_type, T.StructType):
        fields = [
            to_portable(column[field.name], field.dataType).alias(field.name)
            for field in data_type.fields
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(data_type, _KEPT):
        return column
    return column.cast("string")


def from_portable(column: Column, data_type: T.DataType, convbags: bool = True) -> Column:
    """A relational value of ``data_type`` in script form.

    ``convbags=False`` leaves a bag at the top level as it is; bags inside other
    values are always converted. A struct becomes a list when its fields have one
    type, and otherwise stays a struct, as an array cannot mix types.
    """
    if isinstance(data_type, T.MapType):
        value_type = data_type.valueType
        return F.transform_values(column, lambda k, v: from_portable(v, value_type))
    if isinstance(data_type, T.ArrayType):
        if not convbags:
            return column
        element_type = data_type.elementType
        if isinstance(element_type, T.StructType) and len(element_type.fields) == 1:
            only = element_type.fields[0]
            return F.transform(column, lambda e: from_portable(e[only.name], only.dataType))
        return F.transform(column, lambda e: from_portable(e, element_type))
    if isinstance(data_type, T.StructType):
        fields = [
            from_portable(column[field.name], field.dataType).alias(field.name)
            for field in data_type.fields
        ]
        one_type = len({field.dataType for field in data_type.fields}) == 1
        return F.when(column.isNotNull(), F.array(*fields) if one_type else F.struct(*fields))
    if isinstance(data_type, _KEPT):
        return column
    raise TypeError(f"no script form for {data_type.simpleString()}")


def _convert(df: DataFrame, convert: Callable[[Column, T.DataType], Column], names: tuple[str, ...]):
    chosen = names or tuple(df.columns)
    return df.withColumns({name: convert(F.col(name), df.schema[name].dataType) for name in chosen})


def columns_to_portable(df: DataFrame, *names: str) -> DataFrame:
    """Convert columns, all by default, to relational form."""
    return _convert(df, to_portable, names)


def columns_from_portable(df: DataFrame, *names: str, convbags: bool = True) -> DataFrame:
    """Convert columns, all by default, to script form."""
    return _convert(df, lambda c, t: from_portable(c, t, convbags), names)


def new_bag(element_type: T.DataType) -> Column:
    """An empty bag of elements of ``element_type``."""
    row = element_type if isinstance(element_type, T.StructType) else T.StructType([T.StructField("x", element_type)])
    return F.array().cast(T.ArrayType(row))


def add(df: DataFrame, left: str, right: str | Column) -> Column:
    """``left + right``: appends to a bag, concatenates text, adds numbers.

    An element that is no struct is converted and wrapped before it is appended.
    """
    element = F.col(right) if isinstance(right, str) else right
    left_type = df.schema[left].dataType
    right_type = df.select(element.alias("e")).schema["e"].dataType
    if isinstance(left_type, T.ArrayType) and isinstance(left_type.elementType, T.StructType):
        converted = to_portable(element, right_type)
        if not isinstance(right_type, T.StructType):
            converted = F.struct(converted.alias(left_type.elementType.fieldNames()[0]))
        return F.array_append(left, converted.cast(left_type.elementType))
    if isinstance(left_type, T.StringType) or isinstance(right_type, T.StringType):
        return F.concat(F.col(left).cast("string"), element.cast("string"))
    return F.col(left) + element
