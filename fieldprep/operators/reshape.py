"""Unions, stacking, unpivoting, splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def union_by_name(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; a column a table lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def literal_rows(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """A handful of constant rows as an expression of one row: its size is fixed and known to the planner."""
    names = [part.strip().split()[0] for part in schema.split(",")]
    kinds = [part.strip().split(None, 1)[1] for part in schema.split(",")]
    items = [
        F.struct(*[(v if isinstance(v, Column) else F.lit(v)).cast(k).alias(n) for v, n, k in zip(r, names, kinds)])
        for r in rows
    ]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*items)))


def append_rows(df: DataFrame, schema: str, rows: Sequence[tuple]) -> DataFrame:
    return df.unionByName(literal_rows(df.sparkSession, schema, rows), allowMissingColumns=True)


def stack_slots(
    df: DataFrame,
    keep: Sequence[str],
    slots: Sequence[Mapping[str, Column]],
    require: Sequence[Sequence[str]],
    slot_column: str | None = None,
) -> DataFrame:
    """Repeated column groups to rows in one scan.

    ``slots`` gives the fields of each slot, ``require`` the fields that must be present in it.
    """
    items = []
    for number, (fields, needed) in enumerate(zip(slots, require), 1):
        ok = reduce(lambda a, b: a & b, [fields[n].isNotNull() for n in needed], F.lit(True))
        item = F.struct(F.lit(number).alias("__slot"), *[c.alias(n) for n, c in fields.items()])
        items.append(F.when(ok, item))
    rows = df.select(*keep, F.inline(F.array_compact(F.array(*items))))
    return rows.withColumnRenamed("__slot", slot_column) if slot_column else rows.drop("__slot")


def stacked_distinct(df: DataFrame, columns: Sequence[str], alias: str) -> DataFrame:
    """Distinct values over several columns."""
    return df.select(F.explode(F.array(*columns)).alias(alias)).distinct()


def unpivot_capped(
    df: DataFrame, keep: Sequence[str], columns: Sequence[str], name: str, value: str, cap: float = 1
) -> DataFrame:
    """Counter columns to rows, capped, only those above zero."""
    long = df.select(*keep, *[F.col(c).cast("double") for c in columns]).unpivot(list(keep), list(columns), name, value)
    return long.withColumn(value, F.least(F.col(value), F.lit(float(cap)))).filter(F.col(value) > 0)


def split_to_columns(df: DataFrame, column: str, names: Sequence[str], separator: str = ",") -> DataFrame:
    """First parts of a separated text as columns; missing parts NULL, surplus parts dropped."""
    parts = F.split(F.col(column), separator, -1)
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)}).drop(column)
