"""Text lines as a source and a sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.dump import RUN_LINES, update_stream


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files, with the place of each line in its file.

    ``place`` orders lines within the file block they were read from, and
    ``block_start`` orders the blocks of a file.
    """
    return (
        spark.read.text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("place"),
        )
        .where(F.length(F.trim("line")) > 0)
    )


def write_lines(lines: DataFrame, path: str) -> None:
    """Write ``line`` as text files, each as its partition is.

    A file must not be cut where ``spark.sql.files.maxRecordsPerFile`` says, since
    its next lines may go on with a series that the lines before them name.
    """
    lines.select("line").write.option("maxRecordsPerFile", 0).text(path)


def write_update_stream(
    points: DataFrame, path: str, ready: DataFrame | None = None, run_lines: int = RUN_LINES
) -> None:
    """Write points, and lines that are ready, as files of lines, each readable on its own."""
    write_lines(update_stream(points, ready, run_lines), path)
