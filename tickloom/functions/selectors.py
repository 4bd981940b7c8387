"""Series selectors: ``class{label=value,label~regex}``.

The class is exact, or a regular expression after ``~``. Regular expressions
match whole values. A label name is looked up in the labels and, only when
absent there, in the attributes; a name in neither rejects the series. Class,
names and values are percent-decoded, so a comma in a value is written ``%2C``,
a brace ``%7B``; a ``+`` is itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

_LITERAL = re.compile(r"[A-Za-z0-9_ /:@-]+")
_PREFIX = re.compile(r"([A-Za-z0-9_ /:@-]+)\.[*+]")


@dataclass(frozen=True)
class Match:
    """A condition on one text: equality, or a whole-text regular expression."""

    text: str
    is_regex: bool

    def on(self, column: Column) -> Column:
        if not self.is_regex:
            return column == self.text
        return column.rlike(f"\\A(?:{self.text})\\z")

    def pushable(self, column: Column) -> Column | None:
        """A condition implied by this one that file formats can evaluate."""
        if not self.is_regex:
            return column == self.text
        literals, prefixes = [], []
        for choice in self.text.split("|"):
            prefix = _PREFIX.fullmatch(choice)
            if prefix:
                prefixes.append(prefix.group(1))
            elif _LITERAL.fullmatch(choice):
                literals.append(choice)
            else:
                return None
        conditions = [column.isin(literals)] if literals else []
        conditions += [column.startswith(prefix) for prefix in prefixes]
        return reduce(or_, conditions)


@dataclass(frozen=True)
class Selector:
    class_match: Match
    label_matches: tuple[tuple[str, Match], ...]

    def condition(self, class_: Column, labels: Column, attributes: Column) -> Column:
        parts = [self.class_match.on(class_)]
        for name, match in self.label_matches:
            found = F.coalesce(labels.getItem(name), attributes.getItem(name))
            parts.append(match.on(found))
        return reduce(and_, parts)


def parse_selector(text: str) -> Selector:
    shape = re.fullmatch(r"([^{}]*)(?:\{([^{}]*)\})?", text.strip())
    if shape is None:
        raise ValueError(f"malformed selector: {text!r}")
    class_text, label_text = shape.group(1), shape.group(2) or ""
    class_match = (
        Match(unquote(class_text[1:]), True)
        if class_text.startswith("~")
        else Match(unquote(class_text), False)
    )
    label_matches = []
    for term in filter(None, (part.strip() for part in label_text.split(","))):
        parts = re.fullmatch(r"([^=~]+)([=~])(.*)", term)
        if parts is None:
            raise ValueError(f"malformed label condition {term!r} in selector {text!r}")
        name, kind, value = parts.groups()
        label_matches.append((unquote(name), Match(unquote(value), kind == "~")))
    for match in [class_match, *(m for _, m in label_matches)]:
        if match.is_regex:
            re.compile(match.text)
    return Selector(class_match, tuple(label_matches))


def pushable_classes(*selectors: str) -> Callable[[Column], Column] | None:
    """What the selectors say about a class, for a column of raw classes.

    None when they do not narrow it, or may select series without a class.
    """
    matches = [parse_selector(text).class_match for text in selectors]
    narrow = all(m.pushable(F.lit("")) is not None for m in matches)
    if not narrow or any(re.fullmatch(m.text, "") if m.is_regex else m.text == "" for m in matches):
        return None
    return lambda class_: reduce(or_, [m.pushable(class_) for m in matches])


def selector_condition(
    *selectors: str,
    class_: Column | None = None,
    labels: Column | None = None,
    attributes: Column | None = None,
) -> Column:
    """Condition that holds for series matching any of the selectors.

    When every selector narrows the class to known values or prefixes, that is
    added as a plain condition beside the patterns, so it reaches the scan.
    """
    if not selectors:
        raise ValueError("at least one selector is needed")
    class_ = F.col("class") if class_ is None else class_
    labels = F.col("labels") if labels is None else labels
    attributes = F.col("attributes") if attributes is None else attributes
    parsed = [parse_selector(text) for text in selectors]
    condition = reduce(or_, [s.condition(class_, labels, attributes) for s in parsed])
    pushable = [s.class_match.pushable(class_) for s in parsed]
    if all(p is not None for p in pushable):
        condition = reduce(or_, pushable) & condition
    return condition
