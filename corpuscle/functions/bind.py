"""Evaluate an expression once and use it several times inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed a single time per row.

    A lambda body is evaluated per element, outer expressions included, so an
    array that a lambda refers to must be bound first.
    """
    return F.element_at(F.transform(F.array(value), lambda bound: body(bound)), 1)
