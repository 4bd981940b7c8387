"""Text form of points: ``TS/LAT:LON/ELEV CLASS{LABELS} VALUE``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed by the text format: a decimal number and the parts of a line. The brace
# tells a line that names its series, even with an empty class and no labels.
NUMBER_PATTERN = r"-?[0-9.]+(?:[eE][-+]?\d+)?"
LINE_PATTERN = (
    r"^(=?)(-?\d+)/(?:("
    + NUMBER_PATTERN
    + r"):("
    + NUMBER_PATTERN
    + r"))?/(-?\d+)?\s+(?:([^{\s\x01]*)(\{)([^}\x01]*)\}\s+)?(.+)$"
)
LINE_PARTS = ["mark", "ts", "lat", "lon", "elev", "class", "brace", "labels", "value"]
LONG_PATTERN = r"^-?\d+$"
DOUBLE_PATTERN = r"^(?:" + NUMBER_PATTERN + r"|NaN|-?Infinity)$"
STRING_PATTERN = r"^'[^']*'$"

_PART_MARK = "\x01"


def percent_encode(text: Column) -> Column:
    """Percent-encode, with a space as ``%20``."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def percent_decode(text: Column) -> Column:
    """Undo percent-encoding; null when the text is not validly encoded. A ``+`` is itself."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def position_text() -> Column:
    """``TS/LAT:LON/ELEV`` of a point row."""
    location = F.concat(F.col("lat").cast("string"), F.lit(":"), F.col("lon").cast("string"))
    return F.concat(
        F.col("ts").cast("string"),
        F.lit("/"),
        F.coalesce(location, F.lit("")),
        F.lit("/"),
        F.coalesce(F.col("elev").cast("string"), F.lit("")),
    )


def value_text() -> Column:
    """Value of a point row: ``T``/``F``, a number, or a quoted encoded string.

    A point without any value fails the query, as a null line would lose it.
    """
    return F.coalesce(
        F.col("v_double").cast("string"),
        F.col("v_long").cast("string"),
        F.when(F.col("v_bool"), "T").when(~F.col("v_bool"), "F"),
        F.concat(F.lit("'"), percent_encode(F.col("v_str")), F.lit("'")),
        F.raise_error(F.lit("a point without a value")).cast("string"),
    )


def full_line(selector: Column) -> Column:
    """A line that names its series."""
    return F.concat(position_text(), F.lit(" "), selector, F.lit(" "), value_text())


def continuation_line() -> Column:
    """A line that belongs to the series of the line before it."""
    return F.concat(F.lit("="), position_text(), F.lit(" "), value_text())


def with_line_parts(df: DataFrame, line: str, name: str) -> DataFrame:
    """Add the parts of a line as an array, null when the line is malformed.

    One pattern match per line: the parts are rewritten with a separator that
    the pattern does not accept inside them, then split.
    """
    rewritten = _PART_MARK.join(f"${n}" for n in range(1, len(LINE_PARTS) + 1))
    marked = F.regexp_replace(F.trim(F.col(line)), LINE_PATTERN, rewritten)
    split = df.withColumn(name, F.split(marked, _PART_MARK, len(LINE_PARTS)))
    return split.withColumn(name, F.when(F.size(name) == len(LINE_PARTS), F.col(name)))


def parsed_value(text: Column) -> dict[str, Column]:
    """The four typed value columns; all null when the text is no value."""
    is_long = text.rlike(LONG_PATTERN)
    return {
        "v_long": F.when(is_long, text.try_cast("bigint")),
        "v_double": F.when(~is_long & text.rlike(DOUBLE_PATTERN), text.try_cast("double")),
        "v_bool": F.when(text == "T", True).when(text == "F", False),
        "v_str": F.when(
            text.rlike(STRING_PATTERN), percent_decode(F.substring(text, F.lit(2), F.length(text) - 2))
        ),
    }


def label_entries(text: Column) -> Column:
    """Array of ``(key, value)`` of ``k=v,k=v``; a part badly encoded is null."""

    def entry(pair: Column) -> Column:
        parts = F.split(pair, "=", 2)
        value = F.when(F.size(parts) == 2, parts[1]).otherwise(F.lit(""))
        return F.struct(
            percent_decode(parts[0]).alias("key"), percent_decode(value).alias("value")
        )

    pairs = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))
    return F.transform(pairs, entry)


def labels_of_entries(entries: Column) -> Column:
    """Label map of entries; null when a part is null or a key occurs twice."""
    keys = F.array_distinct(F.array_compact(entries["key"]))
    values = F.array_compact(entries["value"])
    whole = (F.size(keys) == F.size(entries)) & (F.size(values) == F.size(entries))
    return F.when(whole, F.map_from_entries(entries))


def parsed_labels(text: Column) -> Column:
    """Label map of a canonical label text."""
    return F.map_from_entries(label_entries(text))
