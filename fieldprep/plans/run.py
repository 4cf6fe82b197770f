"""The whole chain, stage by stage, with stored tables in between."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fieldprep.operators.filters import keep_year
from fieldprep.operators.spatial import in_space_order
from fieldprep.plans.cleaning import CleanTables, clean_inspections, clean_views
from fieldprep.plans.combining import combine_sources
from fieldprep.plans.polygons import (
    RowFilter,
    placename_worklist,
    resolve_placenames,
    summarise_to_polygons,
    summary_layer,
    waterbody_layer,
)
from fieldprep.plans.reports import label_layers, report_tables, strict_high_risk, with_destination_region
from fieldprep.session import stored as laid_down
from fieldprep.sources.readers import table_or_read
from fieldprep.sources.sinks import read_or_build, write_table, write_tables

CANONICAL = "AllYears_Canonical"
CLEAN_NAMES = ("AllYears_All_Columns", "AllYears_Selected_Columns", "AllYears_high_risk", "AllYears_mussel_fouled")


@dataclass(frozen=True)
class Sources:
    """Raw tables and hand-kept lists."""

    years: Mapping[int, DataFrame]
    extracts: DataFrame
    fouled_by_year: Mapping[int, DataFrame]
    fouled_recent: DataFrame


@dataclass(frozen=True)
class Lookups:
    corrections: DataFrame
    craft_types: DataFrame
    craft_categories: DataFrame
    abbreviations: DataFrame
    gazetteer: DataFrame


@dataclass(frozen=True)
class Layers:
    """Polygon parts and station points."""

    states: DataFrame
    stations: DataFrame
    regions: DataFrame
    waterbodies: DataFrame


def store_canonical(df: DataFrame, folder: str) -> DataFrame:
    path = f"{folder.rstrip('/')}/{CANONICAL}"
    write_table(df, path, partition_by=["Year"])
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prepare_inspections(
    spark: SparkSession, sources: Sources, lookups: Lookups, folder: str, full_repair: bool = False
) -> CleanTables:
    """Combine, clean and store the four tables; returns them read back, partitioned by year.

    The canonical table is stored before it is cleaned: cleaning reads the older years more than
    once, by partition, and only the columns it needs each time. The full clean table is computed
    once and stored; the other three are read off it.
    """
    made = combine_sources(sources.years, sources.extracts, sources.fouled_by_year, sources.fouled_recent, full_repair)
    combined = store_canonical(made, folder)
    clean = clean_inspections(
        combined, lookups.corrections, lookups.craft_types, lookups.craft_categories, lookups.abbreviations
    )
    base = f"{folder.rstrip('/')}/{CLEAN_NAMES[0]}"
    write_table(clean.everything, base, partition_by=["Year"])
    stored = clean_views(spark.read.parquet(base))
    write_tables(dict(zip(CLEAN_NAMES[1:], stored[1:])), folder)
    return stored


def make_reports(
    spark: SparkSession, lookups: Lookups, layers: Layers, folder: str, year: int, df: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Report tables, stored and read back. Without a table the stored trimmed one is used."""
    df = table_or_read(df, lambda: spark.read.parquet(f"{folder}/{CLEAN_NAMES[1]}"))
    made = report_tables(df, layers.states, layers.stations, layers.regions, lookups.gazetteer, year)
    base = f"{folder.rstrip('/')}/figure_dat_all"
    write_table(made.everything, base, partition_by=["Year"])
    stored = spark.read.parquet(base)
    tables = {
        "figure_dat": with_destination_region(keep_year(stored, year), toggle=True),
        "figure_dat_hr": with_destination_region(strict_high_risk(stored), toggle=False),
        "figure_dat_mf": with_destination_region(stored.filter("MusselsFound_Ind"), toggle=False),
        "Inspections_by_source_centroid": made.by_source,
        "Inspections_Summarised_at_Station_level": made.by_station,
    }
    paths = write_tables(tables, folder)
    # The counts behind them are taken once, not once per layer.
    paths |= write_tables(label_layers(spark.read.parquet(paths["Inspections_by_source_centroid"])), folder)
    write_table(stored, f"{folder.rstrip('/')}/figure_dat_all_csv", "csv")
    return {"figure_dat_all": stored, **{n: spark.read.parquet(p) for n, p in paths.items()}}


def stored_waterbodies(
    spark: SparkSession, lakes: DataFrame, rivers: DataFrame, manmade: DataFrame, folder: str, refresh: bool = False
) -> DataFrame:
    """The layer of all named waterbodies, built once per folder."""
    path = f"{folder.rstrip('/')}/waterbodies"
    return read_or_build(spark, path, lambda: in_space_order(waterbody_layer(lakes, rivers, manmade)), refresh)


def locate_placenames(df: DataFrame, gazetteer: DataFrame, folder: str) -> DataFrame:
    """The gazetteer of the names that the records use, stored; names it lacks are stored as a list to ask for."""
    found, unresolved = resolve_placenames(placename_worklist(df), gazetteer)
    paths = write_tables({"placenames_located": found, "placenames_unresolved": unresolved}, folder)
    return df.sparkSession.read.parquet(paths["placenames_located"])


def make_polygon_summaries(
    spark: SparkSession,
    lookups: Lookups,
    layers: Layers,
    folder: str,
    year: int,
    rows: RowFilter | None = None,
    df: DataFrame | None = None,
) -> DataFrame:
    """All-years and report-year summaries on the polygons; returns the all-years one."""
    df = table_or_read(df, lambda: spark.read.parquet(f"{folder}/{CLEAN_NAMES[0]}"))
    listed = [spark.read.parquet(f"{folder}/{n}") for n in ("figure_dat_hr", "figure_dat_mf")]
    places = locate_placenames(df, lookups.gazetteer, folder)
    rows_used = rows or RowFilter()
    paths = []
    for scope in (None, year):
        summary = summarise_to_polygons(df, layers.waterbodies, places, *listed, year=scope, rows=rows)
        paths.append(f"{folder.rstrip('/')}/{rows_used.label(scope)}")
        # The order asks for the extent first: what it is taken of is not made twice.
        write_table(in_space_order(laid_down(summary_layer(summary, layers.waterbodies))), paths[-1])
    return spark.read.parquet(paths[0])


def run_all(
    spark: SparkSession,
    sources: Sources,
    lookups: Lookups,
    layers: Layers,
    folder: str,
    year: int,
    spatial: bool = True,
    full_repair: bool = False,
) -> DataFrame | None:
    """Combine and clean, report, and summarise to polygons, in this order."""
    prepare_inspections(spark, sources, lookups, folder, full_repair)
    make_reports(spark, lookups, layers, folder, year)
    return make_polygon_summaries(spark, lookups, layers, folder, year) if spatial else None
