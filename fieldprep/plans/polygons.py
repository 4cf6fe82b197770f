"""Polygon plan: inspections summed onto the waterbodies they are headed to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.functions import geometry, recode, text
from fieldprep.operators import filters, joins, spatial
from fieldprep.operators.aggregates import total
from fieldprep.operators.reshape import literal_rows, stack_slots, stacked_distinct, union_by_name
from fieldprep.plans import fixed_values as fixed
from fieldprep.session import stored
from fieldprep.sources.sinks import filter_label

KEY = ("Year", "Watercraft_Risk_Assessment_ID")
RISK_PREFIXES = ("LowRisk_", "HR_")


@dataclass(frozen=True)
class RowFilter:
    """Which inspections feed a summary: a field and its values, or a named preset."""

    field: str | None = None
    values: Sequence = ()
    preset: str | None = None

    def label(self, year: int | None) -> str:
        # The yearly table has no label of its own for the second preset.
        labels = {"WD_infected_areas": "WD_Infected_Areas"}
        if year is None:
            labels["BC_WD_infected_wbs"] = "BC_WD_Infected_Waterbodies"
        field = SOURCE_FIELD if self.preset == "WD_infected_areas" else self.field
        return filter_label(year, field, labels.get(self.preset))


SOURCE_FIELD = "Previous_Waterbody_1_Province_Or_State"


def apply_filter(df: DataFrame, rows: RowFilter | None) -> DataFrame:
    if rows is None:
        return df
    if rows.preset not in (None, "WD_infected_areas", "BC_WD_infected_wbs"):
        raise ValueError(f"unknown preset: {rows.preset}")
    field, values = rows.field, rows.values
    if rows.preset == "WD_infected_areas":
        field, values = SOURCE_FIELD, fixed.INFECTED_SOURCE_REGIONS
    if field is not None:
        df = filters.keep_values(df, field, values)
    if rows.preset == "BC_WD_infected_wbs":
        df = filters.name_preset(
            df,
            "Previous_Waterbody_1_Name",
            fixed.INFECTED_WATERS,
            fixed.AMBIGUOUS_WATER,
            "Previous_Waterbody_1_Closest_City",
            fixed.AMBIGUOUS_WATER_CITIES,
        )
    return df


def waterbody_layer(lakes: DataFrame, rivers: DataFrame, manmade: DataFrame) -> DataFrame:
    """Named parts of three layers with their type, and the two made-up boxes.

    Parts of one (watershed, name) stay separate rows: they are one feature by key, and no
    distance or containment depends on merging their outlines.
    """
    layers = {"Lake": lakes, "River": rivers, "Manmade": manmade}
    typed = [df.withColumn("WaterBodyType", F.lit(kind)) for kind, df in layers.items()]
    named = union_by_name(typed).filter(F.col("GNIS_NA").isNotNull())
    return named.unionByName(synthetic_boxes(lakes), allowMissingColumns=True)


def synthetic_boxes(like: DataFrame) -> DataFrame:
    """Two literal features, projected to the provincial grid."""
    kind = dict(like.dtypes)["WATERSH"]
    rows = [(0, name, geometry.box(*corners)) for name, corners in fixed.SYNTHETIC_BOXES.items()]
    boxes = literal_rows(like.sparkSession, f"WATERSH {kind}, GNIS_NA string", [r[:2] for r in rows])
    rings = recode.fold_rules([(F.col("GNIS_NA") == name, ring) for _, name, ring in rows[:-1]], rows[-1][2])
    return spatial.project_parts(boxes.withColumn("rings", rings), geometry.PROVINCIAL_GRID)


def placename_worklist(df: DataFrame) -> DataFrame:
    """Distinct placenames of the four city columns, with the key a gazetteer is asked for."""
    cities = [f"Destination_Waterbody_{i}_Closest_City" for i in (1, 2, 3)] + ["Destination_Major_City"]
    names = stacked_distinct(df, [c for c in cities if c in df.columns], "names").dropna()
    return names.withColumn("asked", text.plain_placename(F.col("names")))


def resolve_placenames(worklist: DataFrame, gazetteer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names with coordinates, and the names the gazetteer does not know."""
    known = gazetteer.select(F.col("names").alias("asked"), "lon", "lat").dropna()
    found = worklist.join(known, "asked").select("names", "lon", "lat")
    return found, joins.anti(worklist, known, ["asked"]).select("names")


def resolve_slips(worklist: DataFrame, gazetteer: DataFrame, most: int = 2) -> DataFrame:
    """Names with the coordinates of the closest gazetteer name: names, known_as, lon, lat, slips.

    ``slips`` is the number of letters put in, left out or replaced, up to ``most``; of equally close
    names the first in order is taken. Two names within that distance share a text that is left when
    up to ``most`` letters are taken out of each, so they meet on these texts; nothing else is compared.
    """
    known = gazetteer.select(F.col("names").alias("known_as"), "lon", "lat").dropna()
    asked = worklist.select("asked").dropna().distinct()
    left = asked.select("asked", F.explode(text.with_deletions(F.col("asked"), most)).alias("__left"))
    right = known.select("known_as", F.explode(text.with_deletions(F.col("known_as"), most)).alias("__left")).distinct()
    pairs = left.join(right, "__left").select("asked", "known_as").distinct()
    close = pairs.withColumn("slips", F.levenshtein("asked", "known_as", most)).filter(F.col("slips") >= 0)
    best = close.groupBy("asked").agg(F.min(F.struct("slips", "known_as")).alias("__best"))
    best = best.select("asked", F.col("__best.known_as").alias("known_as"), F.col("__best.slips").alias("slips"))
    return worklist.join(best, "asked").join(known, "known_as").select("names", "known_as", "lon", "lat", "slips")


def with_coordinates(df: DataFrame, gazetteer: DataFrame, city: str) -> DataFrame:
    """Rows whose city has coordinates."""
    known = gazetteer.select(F.col("names").alias("__city"), "lon", "lat").dropna()
    return joins.null_safe_join(df.filter(F.col(city).isNotNull()), known, [(city, "__city")], "inner")


def risk_keys(high_risk: DataFrame, fouled: DataFrame) -> DataFrame:
    """One row per listed inspection with both memberships, so that one join sets both flags."""
    as_keys = lambda df, hr, mf: df.select(*KEY, F.lit(hr).alias("__hr"), F.lit(mf).alias("__mf"))
    both = as_keys(high_risk, True, False).unionByName(as_keys(fouled, False, True))
    return both.groupBy(*KEY).agg(F.bool_or("__hr").alias("__hr"), F.bool_or("__mf").alias("__mf"))


def destinations(df: DataFrame) -> DataFrame:
    """One row per named destination of an inspection, ocean names unified."""
    part = lambda i, f: (
        F.col(f"Destination_Waterbody_{i}_{f}") if f"Destination_Waterbody_{i}_{f}" in df.columns else F.lit(None)
    ).cast("string")
    slots = [{"GNIS_NA": part(i, "Name"), "Closest_City": part(i, "Closest_City")} for i in (1, 2, 3)]
    # The second slot needs a name, the third a name and a city; unnamed first slots fall away below.
    rows = stack_slots(df, ["__hr", "__mf", *fixed.COUNTERS], slots, [(), ("GNIS_NA",), ("GNIS_NA", "Closest_City")])
    named = rows.filter(F.col("GNIS_NA").isNotNull() & (F.col("GNIS_NA") != "NA"))
    return named.withColumn("GNIS_NA", recode.recode_first_match(F.col("GNIS_NA"), [(fixed.OCEAN_PATTERN, fixed.OCEAN)]))


def count_columns() -> dict[str, Column]:
    """Everything that is counted per destination, in one aggregation.

    A craft class counts once per inspection however many craft there were, split by risk.
    """
    hr, mf = F.col("__hr"), F.col("__mf")
    risks = {"LowRisk_": ~hr & ~mf, "HR_": hr}
    split = {f"{p}{c}": F.count_if(cond & (F.col(c) > 0)) for p, cond in risks.items() for c in fixed.COUNTERS}
    return {
        "TotalInspections": F.count(F.lit(1)),
        **{c: total(F.col(c)) for c in fixed.COUNTERS},
        "NumberMusselFouled": F.count_if(mf),
        "highrisk_Counter": F.count_if(hr),
        **split,
    }


def summarise_to_polygons(
    df: DataFrame,
    parts: DataFrame,
    gazetteer: DataFrame,
    high_risk: DataFrame,
    fouled: DataFrame,
    year: int | None = None,
    rows: RowFilter | None = None,
) -> DataFrame:
    """Inspections per (watershed, name): all years, or one report year.

    The facts are flagged, stacked and aggregated to (name, city) before anything spatial
    happens; the spatial join then works on distinct places only. Place names are unique in
    the gazetteer (checked on the gazetteer alone).
    """
    joins.require_unique(gazetteer, "names")
    df = apply_filter(df, rows)
    if year is not None:
        df = filters.keep_year(df, year)
    counters = {c: text.to_number(F.col(c)) for c in fixed.COUNTERS}
    flagged = joins.null_safe_join(df.withColumns(counters), risk_keys(high_risk, fouled), list(KEY))
    flagged = flagged.withColumns({f: F.coalesce(f, F.lit(False)) for f in ("__hr", "__mf")})
    measures = count_columns()
    per_place = destinations(flagged).groupBy("GNIS_NA", "Closest_City").agg(*[c.alias(a) for a, c in measures.items()])
    located = with_coordinates(per_place, gazetteer, "Closest_City")
    # Stored: the spatial join reads them more than once, and its plan need not hold that of the facts.
    located = stored(spatial.project_points(located, geometry.PROVINCIAL_GRID, "lon", "lat"))
    matched = spatial.nearest_in_name(located, parts, "GNIS_NA", ["WATERSH", "GNIS_NA"])
    summed = matched.groupBy("WATERSH", "GNIS_NA").agg(*[total(F.col(m)).alias(m) for m in measures])
    motor = [f"HR_{c}" for c in fixed.COUNTERS if c != "Non_Motorized_Counter"]
    return summed.withColumns(
        {"HR_mot": sum((F.col(c) for c in motor[1:]), F.col(motor[0])), "HR_nonmot": F.col("HR_Non_Motorized_Counter")}
    )


def summary_layer(summary: DataFrame, parts: DataFrame) -> DataFrame:
    """The summary on the geometry: one row per part of every feature that has data."""
    return spatial.attach_geometry(summary, parts, ["WATERSH", "GNIS_NA"])
