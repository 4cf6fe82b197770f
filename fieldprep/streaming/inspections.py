"""Arriving extracts through the same combining and cleaning as a full run, appended by year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldprep.plans.cleaning import clean_inspections
from fieldprep.plans.combining import ID, combine_sources
from fieldprep.plans.run import Lookups
from fieldprep.streaming.append import append_stream


def append_inspections(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    fouled_recent: DataFrame,
    lookups: Lookups,
    path: str,
    checkpoint: str,
    fmt: str = "csv",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Clean what has arrived in ``source`` and append the inspections that ``path`` does not hold yet.

    Every rule for extracts looks at one record and at lookups, so a batch is cleaned as the whole
    would be. Pooling craft classes over repeated ids concerns yearly tables, which do not arrive here.
    """

    def clean(batch: DataFrame) -> DataFrame:
        made = combine_sources({}, batch, {}, fouled_recent)
        known = (lookups.corrections, lookups.craft_types, lookups.craft_categories, lookups.abbreviations)
        return clean_inspections(made, *known).everything

    return append_stream(spark, source, schema, clean, path, ["Year", ID], "Year", checkpoint, fmt, glob, files_per_batch)
