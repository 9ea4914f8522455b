"""Naming an intermediate value inside a Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a variable that holds ``value``.

    A Column used twice is written into the plan twice.  The lambda variable of a
    one-element array stands for it instead, so plans of nested formulas stay small
    and the value is computed once.
    """
    return F.transform(F.array(value), body).getItem(0)
