"""Deterministic ids of text: of 60 bits for everybody, or of 64 bits under a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.keyed import keyed_id
from tickloom.model import with_series_key


def text_id(text: Column | str) -> Column:
    """First 15 hexadecimal digits of the MD5 of ``text``, as a bigint."""
    text = F.col(text) if isinstance(text, str) else text
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def with_series_ids(df: DataFrame, key: bytes | None = None) -> DataFrame:
    """Add ``class_id`` and ``labels_id``, under a ``key`` of 16 bytes if there is one.

    Equal labels give equal ids whatever the class. Ids can collide, so joins
    use them together with the series key.
    """
    ids = {"class_id": "class", "labels_id": "label_key"}
    return with_series_key(df).withColumns(
        {name: text_id(of) if key is None else keyed_id(of, key) for name, of in ids.items()}
    )
