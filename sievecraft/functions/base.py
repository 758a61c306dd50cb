"""Small building blocks for column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Text without Unicode blanks at both ends; null becomes empty."""
    # One match from the first to the last letter; blanks inside the text are not tried one by one.
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"(?Us)^\s*+(.*\S)", 1)


def blank(text: Column) -> Column:
    # The first letter that is no blank decides.
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)\S")


def non_empty(text: Column) -> Column:
    """The text, or null if it is blank."""
    return F.when(~blank(text), text)


def chars(text: Column) -> Column:
    """The characters of a text in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), ""), lambda c: c != "")


def lines(text: Column) -> Column:
    """Lines without outer blanks; empty ones go."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), strip), lambda x: x != "")
