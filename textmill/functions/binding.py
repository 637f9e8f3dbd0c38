"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it.

    Without this the optimizer puts the whole expression of ``value`` in every such place when
    it merges projections.
    """
    return F.transform(F.array(value), use)[0]
