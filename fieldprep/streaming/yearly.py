"""Yearly tables that arrive one by one, in any order, and again.

A year is published whole: its cleaned rows with their own craft counts, and what it adds to the
counts per id. Both are one version (see ``sources.versions``), so a year is replaced in one step
and a replay changes nothing. Craft counts are pooled over all rows of an id, whichever year they are
in; that is done when the tables are read, from the sums that each year keeps.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fieldprep.operators.reshape import union_by_name
from fieldprep.plans.cleaning import clean_classified, craft_parts, pool_craft
from fieldprep.plans.combining import combine_year
from fieldprep.plans.run import Lookups
from fieldprep.sources.sinks import write_table
from fieldprep.sources.versions import children, current, publish

ARRIVALS = "year int, path string"


def publish_year(raw: DataFrame, year: int, fouled: DataFrame, lookups: Lookups, path: str) -> None:
    """Clean one yearly table and make it what ``path`` holds of that year.

    Each stage is stored before the next reads it: classifying reads the canonical table more than
    once, by the columns it needs, and the rules after it work on rows that are settled.
    """
    spark = raw.sparkSession

    def stage(folder: str, df: DataFrame) -> DataFrame:
        write_table(df, folder)
        return spark.read.schema(df.schema).parquet(folder)

    def write(folder: str) -> None:
        made = stage(f"{folder}/canonical", combine_year(raw, year, fouled))
        rows, adds = craft_parts(made, year, lookups.craft_types, lookups.craft_categories)
        rows = stage(f"{folder}/classified", rows)
        write_table(clean_classified(rows, lookups.corrections, lookups.abbreviations), f"{folder}/rows")
        if adds is not None:
            write_table(adds, f"{folder}/adds")

    publish(spark, f"{path.rstrip('/')}/{year}", write)


def read_years(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned rows of all years that were published, craft counts pooled over all of them."""
    years = [n for n in children(spark, path) if n.isdigit()]
    folders = [f for f in (current(spark, f"{path.rstrip('/')}/{n}") for n in years) if f]
    if not folders:
        raise ValueError(f"no year published in {path}")
    rows = union_by_name([spark.read.parquet(f"{f}/rows") for f in folders])
    adds = [spark.read.parquet(f"{f}/adds") for f in folders if "adds" in children(spark, f)]
    return pool_craft(rows, union_by_name(adds)) if adds else rows


def arriving_years(
    spark: SparkSession,
    arrivals: str,
    read: Callable[[int, str], DataFrame],
    fouled: Mapping[int, DataFrame],
    lookups: Lookups,
    path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Publish the years that notes in ``arrivals`` tell of (CSV: year, path), then stop.

    A restart continues where it ended. A year told of twice in a batch is published from its last
    path in order; lists of a year without one are empty.
    """
    reader = spark.readStream.schema(ARRIVALS).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def store(batch: DataFrame, _: int) -> None:
        # Notes, a handful of short rows; the tables they name are not read here.
        told = dict(sorted((row.year, row.path) for row in batch.distinct().collect()))
        for year, where in told.items():
            nothing = spark.createDataFrame([], "`Inspection ID` string")
            publish_year(read(year, where), year, fouled.get(year, nothing), lookups, path)

    return reader.csv(arrivals).writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
