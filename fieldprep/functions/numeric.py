"""Counters as numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldprep.functions.text import to_number


def total_at_least_one(*counters: Column) -> Column:
    """Sum of counters; unknown if any is unknown; a sum of 0 stands for one."""
    summed = reduce(lambda a, b: a + b, [to_number(c) for c in counters])
    return F.when(summed == 0, F.lit(1.0)).otherwise(summed)
