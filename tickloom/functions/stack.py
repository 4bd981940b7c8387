"""Stacks of values held in a row: structs by position and levelled arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.ids import text_id
from tickloom.functions.keyed import keyed_id


def stack_to_struct(*values: Column) -> Column:
    """Values as one struct ``e0, e1, ...`` with the top first."""
    if not values:
        raise ValueError("a stack needs at least one value")
    return F.struct(*[value.alias(f"e{place}") for place, value in enumerate(values)])


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Fields of a struct column as columns, in place of it."""
    others = [name for name in df.columns if name != column]
    return df.select(*others, f"{column}.*")


def flatten_bag(df: DataFrame, column: str) -> DataFrame:
    """One row per element of a bag, its fields as columns; empty bags vanish."""
    others = [name for name in df.columns if name != column]
    return df.select(*others, F.inline(column))


def levelled_stack(*values: Column) -> Column:
    """Values as an array of ``(level, obj)``, the first at level 0."""
    return F.array(
        *[
            F.struct(F.lit(level).cast("int").alias("level"), value.cast("string").alias("obj"))
            for level, value in enumerate(values)
        ]
    )


def stack_get(stack: Column, index: Column | int) -> Column:
    """First element whose level is ``index``, or null."""
    index = F.lit(index) if isinstance(index, int) else index
    return F.try_element_at(F.filter(stack, lambda e: e["level"] == index), F.lit(1))


def stack_order(stack: Column, key: bytes | None = None) -> Column:
    """Stack elements by level, then by the id of the object, under a ``key`` if there is one.

    A negative level or an element without an object fails the query.
    """
    def place(e: Column) -> Column:
        problem = F.when(e["level"] < 0, "negative stack level").when(
            e["level"].isNull() | e["obj"].isNull(), "stack element without level or object"
        )
        level = F.when(problem.isNull(), e["level"]).otherwise(F.raise_error(problem).cast("int"))
        id = text_id(e["obj"]) if key is None else keyed_id(e["obj"], key)
        return F.struct(level.alias("level"), id.alias("id"), e["obj"].alias("obj"))

    return F.array_sort(F.transform(stack, place))
