"""Group statistics on rows, group numbers and row numbers without unbounded windows.

A plain window puts a whole group into one task. Here a statistic is aggregated first
and joined back, and numbering runs per range partition with carried offsets, so a key
that holds a third of all rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldprep.operators.joins import null_safe_join
from fieldprep.session import cut_lineage


def attach_group_stats(df: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]) -> DataFrame:
    """Group aggregates on every row of the group."""
    per_group = df.groupBy(*keys).agg(*[c.alias(a) for a, c in stats.items()])
    return null_safe_join(df, per_group, list(keys))


def number_rows(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (), alias: str = "row_number") -> DataFrame:
    """Row numbers 1, 2, … over a total order, per key or over the whole table.

    Rows are range-partitioned by (keys, order) and laid down in reliable storage; each
    partition numbers its own share of a key and adds what earlier partitions hold of it.
    Only a key that crosses a partition boundary needs such an offset, so there are fewer
    offsets than partitions and broadcasting them is bounded.
    """
    key_order = [F.col(k).asc_nulls_first() for k in keys]
    spread = df.repartitionByRange(*key_order, *order)
    if not keys:
        return _number_all(spread, order, alias)
    laid = cut_lineage(spread.withColumn("__part", F.spark_partition_id()))
    shares = laid.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        shares.withColumn("__before", F.sum("__rows").over(earlier))
        .filter(F.col("__before").isNotNull())
        .select(*keys, "__part", "__before")
    )
    local = F.row_number().over(Window.partitionBy(*keys, "__part").orderBy(*order))
    numbered = laid.withColumn("__local", local.cast("bigint"))
    joined = null_safe_join(numbered, F.broadcast(offsets), [*keys, "__part"])
    return joined.withColumn(alias, F.col("__local") + F.coalesce("__before", F.lit(0))).drop(
        "__local", "__before", "__part"
    )


def _number_all(spread: DataFrame, order: Sequence[Column], alias: str) -> DataFrame:
    """Whole-table numbering: position inside the partition plus the sizes of earlier partitions."""
    laid = cut_lineage(spread.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    # The id is the partition number in the high bits and the position in the low 33 bits.
    part, position = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit(2**33 - 1))
    placed = laid.withColumns({"__part": part, "__local": position + 1})
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    # One row per partition: small enough for one task and for broadcasting, whatever the data.
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    joined = placed.join(F.broadcast(offsets), "__part")
    return joined.withColumn(alias, F.col("__local") + F.col("__before")).drop("__at", "__part", "__local", "__before")


def dense_group_id(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """Consecutive group number in key order, NULL keys last. Numbers the distinct keys, not the rows."""
    groups = number_rows(df.select(*keys).distinct(), [F.col(k).asc_nulls_last() for k in keys], alias=alias)
    return null_safe_join(df, groups, list(keys))


def batch_ids(df: DataFrame, order: Sequence[Column], size: int = 100, alias: str = "batch_id") -> DataFrame:
    """Consecutive batches of a work list."""
    numbered = number_rows(df, order, alias="__row")
    return numbered.withColumn(alias, F.ceil(F.col("__row") / size).cast("bigint")).drop("__row")
