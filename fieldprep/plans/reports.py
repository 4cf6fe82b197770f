"""Report plan: tables by source region, station and destination region."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.functions import clock, geometry, numeric, recode, text
from fieldprep.operators import aggregates as agg
from fieldprep.operators import joins, spatial, windows
from fieldprep.operators.columns import move_first
from fieldprep.operators.filters import keep_year
from fieldprep.plans import fixed_values as fixed
from fieldprep.plans.cleaning import DEST, DEST_CITY, SOURCE
from fieldprep.session import stored

COUNTER_ORDER = tuple(fixed.CRAFT_COUNTERS.values())
# Cell of the region grid in map units (metres).
REGION_CELL = 4096.0


class ReportTables(NamedTuple):
    this_year: DataFrame
    everything: DataFrame
    high_risk: DataFrame
    fouled: DataFrame
    by_source: DataFrame
    by_station: DataFrame
    labels: dict[str, DataFrame]


def add_effort(df: DataFrame) -> DataFrame:
    """Boats per inspection, shift hours, and a number per distinct shift."""
    counters = [F.col(c) for c in COUNTER_ORDER]
    df = df.withColumns(
        {
            "TotalBoats": numeric.total_at_least_one(*counters),
            "Shift_hours": clock.shift_hours(F.col("Start_Time"), F.col("End_Time")),
        }
    )
    return move_first(windows.dense_group_id(df, ["Start_Time", "End_Time"], "Shift_ID"), "Year", "Shift_ID")


def inspections_by_source(df: DataFrame, states: DataFrame, year: int) -> DataFrame:
    """Regions with the year's inspections, high-risk, fouled and hauled counts, at their centroids."""
    rows = keep_year(df, year).withColumnRenamed(SOURCE, "ABBR")
    counts = agg.conditional_counts(
        rows,
        ["ABBR"],
        {
            "TotalInsp": None,
            "HRInsp": F.col("High_Risk_AIS_Ind") & ~F.col("Clean_Drain_Dry_After_Inspection_Ind"),
            "MFInsp": F.col("MusselsFound_Ind"),
            "CHInsp": F.col("Commercially_Hauled_Ind"),
        },
        zero_as_null=True,
    )
    keys = ["NAME_0", "NAME_1", "HASC_1"]
    places = spatial.centroids(states, keys).withColumn("ABBR", text.strip_country_prefix(F.col("HASC_1")))
    return joins.attach_counts(places, counts, ["ABBR"])


def label_layers(by_source: DataFrame) -> dict[str, DataFrame]:
    """Regions without any inspection of a kind; one country is left out.

    Counts are attached per code, so every region of a code that has a count carries it:
    what an anti join of the codes would keep is exactly the regions whose count is NULL.
    """
    kinds = {"No_inspection": "TotalInsp", "No_HR_inspection": "HRInsp", "No_MF_inspection": "MFInsp", "No_CH_inspection": "CHInsp"}
    inside = by_source.filter(F.col("NAME_0") != fixed.LEFT_OUT_COUNTRY)
    return {
        f"{name}_states_labels": inside.filter(F.col(count).isNull()).drop(*kinds.values())
        for name, count in kinds.items()
    }


def inspections_by_station(df: DataFrame, stations: DataFrame) -> DataFrame:
    shown = stations.filter(F.col("map_label") != fixed.LEFT_OUT_STATION).withColumnRenamed("map_label", "Station")
    province = F.col("Province_Code")
    summary = agg.dimension_year_summary(
        shown,
        df,
        "Station",
        "Year",
        {"TotalInspections": None, "MusselFouled": F.col("MusselsFound_Ind"), "HighRisk": F.col("High_Risk_AIS_Ind")},
        F.when(province != fixed.UNKNOWN, province),
        "number_of_provs",
    )
    return move_first(summary, "Year")


def city_name(closest: Column, major: Column) -> Column:
    """Closest city unless missing or "Other", else the major city; cut at the first comma."""
    chosen = F.when(closest.isNotNull() & (closest != "Other"), closest).otherwise(major)
    return text.before_comma(F.coalesce(chosen, F.lit(fixed.UNKNOWN)))


def city_regions(df: DataFrame, gazetteer: DataFrame, regions: DataFrame) -> DataFrame:
    """Region of each city that stands in for a missing destination name.

    ``gazetteer`` gives lon/lat by name, ``regions`` polygons on the provincial grid.
    """
    cities = (
        df.filter(
            F.col(DEST).isNull()
            & (F.col("CityName") != fixed.UNKNOWN)
            & F.col("Destination_Major_City").contains(", British Columbia")
        )
        .select("CityName")
        .distinct()
        .withColumn("__name", text.plain_placename(F.col("CityName"), fold_accents=False))
    )
    known = gazetteer.select(F.col("names").alias("__name"), "lon", "lat").dropna()
    located = cities.join(known, "__name")
    located = spatial.project_points(located, geometry.PROVINCIAL_GRID, "lon", "lat")
    hits = spatial.locate_points(located, regions, ["REGION_G", "REGION_N"], REGION_CELL)
    return hits.select("CityName", F.col("REGION_G").alias("City_region_g"), F.col("REGION_N").alias("City_region_n"))


def destination_region(
    name: Column, city_region: Column, not_home: Column, storage: Column, unknown_toggle: Column | None = None
) -> Column:
    """First known of: name, region of the city, outside, and (if asked for) the unknown toggle."""
    outside = F.coalesce(recode.null_if_false(not_home), recode.null_if_false(storage))
    rules = [(name.isNotNull(), name), (city_region.isNotNull(), city_region), (outside, F.lit("Outside BC"))]
    if unknown_toggle is not None:
        rules.append((unknown_toggle, F.lit("Unknown (Toggle)")))
    return recode.fold_rules(rules, F.lit(fixed.UNKNOWN))


def with_destination_region(df: DataFrame, toggle: bool) -> DataFrame:
    not_home, storage = F.col("DestNotBC"), F.col("DryStorage")
    region = destination_region(
        F.col(DEST),
        F.col("City_region_n"),
        not_home,
        storage,
        F.col("Unknown_Destination_Waterbody_Ind") if toggle else None,
    )
    marked = df.withColumns({"DestRegion": region, "Dest_not_wb": F.coalesce(*map(recode.null_if_false, (not_home, storage)))})
    return marked.withColumns({c: recode.null_if_false(F.col(c)) for c in ("DestNotBC", "OceanBoat", "DryStorage")})


def strict_high_risk(df: DataFrame) -> DataFrame:
    """High risk, and not cleaned afterwards or from before cleaning was recorded."""
    return df.filter(F.col("High_Risk_AIS_Ind") & (~F.col("Clean_Drain_Dry_After_Inspection_Ind") | (F.col("Year") < 2020)))


def report_tables(
    df: DataFrame,
    states: DataFrame,
    stations: DataFrame,
    regions: DataFrame,
    gazetteer: DataFrame,
    year: int,
) -> ReportTables:
    """All report tables as branches of one prepared table."""
    flags = ("Clean_Drain_Dry_After_Inspection_Ind", "Unknown_Destination_Waterbody_Ind")
    df = df.withColumns({f: recode.flag_text_to_boolean(F.col(f).cast("string")) for f in flags})
    by_source = inspections_by_source(df, states, year)
    by_station = inspections_by_station(df, stations)
    named = add_effort(df).withColumn("CityName", city_name(F.col(DEST_CITY), F.col("Destination_Major_City")))
    # A city is one row; stored, so that what finds its region is done once and stands in no plan of the facts.
    cities = stored(city_regions(named, gazetteer, regions))
    everything = joins.null_safe_join(named, cities, ["CityName"])
    return ReportTables(
        this_year=with_destination_region(keep_year(everything, year), toggle=True),
        everything=everything,
        high_risk=with_destination_region(strict_high_risk(everything), toggle=False),
        fouled=with_destination_region(everything.filter(F.col("MusselsFound_Ind")), toggle=False),
        by_source=by_source,
        by_station=by_station,
        labels=label_layers(by_source),
    )
