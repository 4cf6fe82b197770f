"""Writers and the compute-once cache."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldprep.sources.versions import current, filesystem, publish


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    gather: bool = False,
) -> None:
    """Write one table, replacing what is there.

    Partitioned tables are written where the rows are: sources arrive year by year, so a task
    holds few partitions. ``gather`` moves the rows of a partition together first, at the price of
    a shuffle, for sources that mix them; a large partition is still split over several tasks.
    """
    if partition_by and gather:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write several named tables below a folder; returns their paths."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    for name, df in tables.items():
        write_table(df, paths[name], fmt)
    return paths


def write_ordered(df: DataFrame, path: str, order: Sequence[Column], fmt: str = "parquet") -> None:
    """Sort once, at the sink, by range partitioning."""
    write_table(df.orderBy(*order), path, fmt)


def filter_label(
    year: int | None = None, field: str | None = None, preset_label: str | None = None
) -> str:
    """Name of a summary by its scope and by the filter that made it."""
    scope = "all_years" if year is None else str(year)
    base = f"Waterbodies_with_Inspection_Data_Summaries_{scope}"
    if preset_label:
        return f"{base}_{preset_label}"
    return f"{base}_{field}_filtered" if field else base


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end: its folder holds the marker of a committed job."""
    where, files = filesystem(spark, f"{path.rstrip('/')}/_SUCCESS")
    return files.exists(where)


def read_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    refresh: bool = False,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """A stored table if there is one, else build it, publish it and read it back.

    A new one is a new version (see ``versions``): until it is whole, and if its writer stops on the
    way, readers find the earlier one. A plain table counts as stored if it was committed. No path
    is refused.
    """
    if not path:
        raise ValueError("no path for the stored table given")
    found = current(spark, path) or (path if committed(spark, path) else None)
    if refresh or found is None:
        found = publish(spark, path, lambda folder: write_table(build(), folder, fmt, partition_by))
    return spark.read.format(fmt).load(found)


def counted(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Row counts taken while the table is computed for its real purpose, not by an extra pass."""
    seen = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(a) for a, c in conditions.items()]]
    return df.observe(seen, *metrics), seen
