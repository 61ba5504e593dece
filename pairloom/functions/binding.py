"""Naming a value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once.

    A lambda over an array evaluates everything it mentions once per element;
    a lambda variable, as here, is only read.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
