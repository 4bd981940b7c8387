"""Points and frames for tests."""

from pyspark.sql import Row

from tickloom.model import POINTS_SCHEMA, with_series_key


def point(class_="c", labels=None, ts=0, lat=None, lon=None, elev=None, attributes=None, **value):
    values = {"v_long": None, "v_double": None, "v_bool": None, "v_str": None, **value}
    return Row(
        **{"class": class_},
        labels=labels or {},
        attributes=attributes or {},
        ts=ts,
        lat=lat,
        lon=lon,
        elev=elev,
        **values,
    )


def frame(spark, *points):
    return spark.createDataFrame(
        [tuple(p[name] for name in POINTS_SCHEMA.fieldNames()) for p in points], POINTS_SCHEMA
    )


def same_points(a, b):
    names = ["class", "label_key", *POINTS_SCHEMA.fieldNames()[3:]]
    rows = lambda df: sorted(map(tuple, with_series_key(df).select(*names).collect()), key=repr)
    assert rows(a) == rows(b)
