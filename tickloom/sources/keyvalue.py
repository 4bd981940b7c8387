"""Key-value records in any format, with settings taken from a profile.

Hadoop formats have no DataFrame reader or writer: their records pass through
Python one by one. Use them to exchange data with other systems only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.portable import columns_from_portable, columns_to_portable

# Hadoop formats and the record classes they are read and written with.
SEQUENCE_INPUT = "org.apache.hadoop.mapreduce.lib.input.SequenceFileInputFormat"
SEQUENCE_OUTPUT = "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat"
NULL_WRITABLE = "org.apache.hadoop.io.NullWritable"
BYTES_WRITABLE = "org.apache.hadoop.io.BytesWritable"
TEXT_WRITABLE = "org.apache.hadoop.io.Text"


def resolve_profile(settings: Mapping[str, str], suffix: str = "") -> dict[str, str]:
    """Settings of a profile.

    Each setting named ``NAME.<suffix>`` replaces ``NAME``. Settings of other
    profiles are kept as they are.
    """
    resolved = dict(settings)
    if suffix:
        ending = f".{suffix}"
        for name, value in settings.items():
            if name.endswith(ending):
                resolved[name[: -len(ending)]] = value
    return resolved


def _take_format(settings: Mapping[str, str], suffix: str) -> tuple[str, dict[str, str]]:
    resolved = resolve_profile(settings, suffix)
    name = resolved.pop("format", None)
    if name is None:
        raise ValueError("the settings name no format")
    options = {k: v for k, v in resolved.items() if not (suffix and k.endswith(f".{suffix}"))}
    return name, options


def kv_source(
    spark: SparkSession,
    path: str,
    settings: Mapping[str, str],
    suffix: str = "",
    key: str = "key",
    value: str = "value",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """``(key, value)`` of a table in the format the settings name.

    ``key`` and ``value`` are columns of the stored table. The other settings are
    options of the format.
    """
    name, options = _take_format(settings, suffix)
    reader = spark.read.format(name).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    pairs = reader.load(path).select(F.col(key).alias("key"), F.col(value).alias("value"))
    return columns_to_portable(pairs)


def kv_sink(pairs: DataFrame, path: str, settings: Mapping[str, str], suffix: str = "") -> None:
    """Write two-column rows in the format the settings name."""
    if len(pairs.columns) != 2:
        raise ValueError(f"expected 2 columns, got {len(pairs.columns)}")
    name, options = _take_format(settings, suffix)
    renamed = columns_from_portable(pairs.toDF("key", "value"))
    renamed.write.format(name).options(**options).save(path)


def hadoop_source(
    spark: SparkSession,
    path: str,
    input_format: str,
    key_class: str,
    value_class: str,
    schema: T.StructType | str,
    conf: Mapping[str, str] | None = None,
    suffix: str = "",
) -> DataFrame:
    """``(key, value)`` records of a Hadoop input format."""
    records = spark.sparkContext.newAPIHadoopFile(
        path, input_format, key_class, value_class, conf=resolve_profile(conf or {}, suffix)
    )
    return spark.createDataFrame(records, schema)


def hadoop_sink(
    pairs: DataFrame,
    path: str,
    output_format: str,
    key_class: str,
    value_class: str,
    conf: Mapping[str, str] | None = None,
    suffix: str = "",
) -> None:
    """Write two-column rows with a Hadoop output format.

    Text, binary, double and boolean columns are taken. Whole numbers must be cast
    first, as their record class would depend on their size.
    """
    if len(pairs.columns) != 2:
        raise ValueError(f"expected 2 columns, got {len(pairs.columns)}")
    for field in pairs.schema:
        if isinstance(field.dataType, T.IntegralType):
            raise ValueError(f"cast {field.name!r} to text or double before writing")
    pairs.rdd.map(lambda row: (row[0], row[1])).saveAsNewAPIHadoopFile(
        path, output_format, key_class, value_class, conf=resolve_profile(conf or {}, suffix)
    )


def _single_binary(df: DataFrame) -> None:
    if len(df.columns) != 1 or not isinstance(df.schema[0].dataType, T.BinaryType):
        raise ValueError(f"expected a single binary column, got {df.schema.simpleString()}")


def bytes_sink(df: DataFrame, path: str) -> None:
    """Write rows of a single binary column."""
    _single_binary(df)
    df.write.parquet(path)


def sequence_file_sink(df: DataFrame, path: str) -> None:
    """Write a single binary column as ``(null, bytes)`` records.

    Sequence files are block-compressed.
    """
    _single_binary(df)
    df.rdd.map(lambda row: (None, bytearray(row[0]))).saveAsNewAPIHadoopFile(
        path,
        SEQUENCE_OUTPUT,
        NULL_WRITABLE,
        BYTES_WRITABLE,
        conf={
            "mapreduce.output.fileoutputformat.compress": "true",
            "mapreduce.output.fileoutputformat.compress.type": "BLOCK",
        },
    )


def sequence_file_source(spark: SparkSession, path: str) -> DataFrame:
    """The bytes of ``(null, bytes)`` records."""
    records = spark.sparkContext.newAPIHadoopFile(path, SEQUENCE_INPUT, NULL_WRITABLE, BYTES_WRITABLE)
    return spark.createDataFrame(records.map(lambda pair: (pair[1],)), "value binary")
