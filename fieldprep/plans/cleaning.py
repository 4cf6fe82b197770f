"""Cleaning plan: names, classes, flags and the four outputs."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.functions import recode, text
from fieldprep.operators import joins
from fieldprep.operators.aggregates import class_parts, classify_multi_value, pool_parts
from fieldprep.operators.columns import apply_to_columns, select_once
from fieldprep.operators.filters import keep_era
from fieldprep.operators.reshape import append_rows, union_by_name
from fieldprep.plans import fixed_values as fixed

DESTINATIONS = tuple(f"Destination_Waterbody_{i}_Name" for i in (1, 2, 3))
DEST, DEST_CITY = "Destination_Waterbody_1_Name", "Destination_Waterbody_1_Closest_City"
DEST_PROVINCE = "Destination_Waterbody_1_Province_Or_State"
SOURCE = "Previous_Waterbody_1_Province_Or_State"
LAST_RECODED_YEAR = 2018


class CleanTables(NamedTuple):
    """All columns, the trimmed table, and the two subsets; lazy branches of one plan."""

    everything: DataFrame
    selected: DataFrame
    high_risk: DataFrame
    fouled: DataFrame


def with_missing_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def tidy_destination_names(df: DataFrame) -> DataFrame:
    """Title case, numbers set off, a trailing province dropped.

    The first name is in title case before the province is looked for; it needs a second pass only
    where something was removed.
    """
    bare = lambda c: text.remove_first(c, ", Bc")
    first = text.title_case(text.split_digits_from_letters(F.col(DEST)))
    df = df.withColumn(DEST, first)
    again = F.when(F.col(DEST).contains(", Bc"), text.title_case(bare(F.col(DEST)))).otherwise(F.col(DEST))
    df = df.withColumn(DEST, again)
    return apply_to_columns(df, lambda c: text.title_case(bare(c)), DESTINATIONS[1:])


def tidy_stations(df: DataFrame) -> DataFrame:
    titled = df.withColumn("Station", text.title_case(F.col("Station")))
    return titled.withColumn("Station", recode.recode_first_match(F.col("Station"), fixed.STATIONS))


def craft_lookup(types: DataFrame, categories: DataFrame) -> DataFrame:
    """Craft type → category over the craft kind, with the category of missing types appended."""
    kinds = categories.select(F.col("`watercraft type`").alias("BoatType"), F.col("`New Category`").alias("category"))
    both = joins.two_level_lookup(types, kinds, "WatercraftType", "BoatType", "category")
    return append_rows(both, "WatercraftType string, category string", [(fixed.UNKNOWN, fixed.UNKNOWN)])


def tidy(df: DataFrame) -> DataFrame:
    return tidy_stations(tidy_destination_names(df))


def classify_craft(df: DataFrame, types: DataFrame, categories: DataFrame) -> DataFrame:
    """Counters of the older years from their craft types; later years keep theirs, as numbers.

    Names are tidied on the way: twins among the older rows are those that agree after it.
    """
    old = keep_era(df, 2015, LAST_RECODED_YEAR)
    recent = keep_era(df, LAST_RECODED_YEAR + 1, None).drop("WatercraftType")
    recent = recent.withColumns({c: text.to_number(F.col(c)) for c in fixed.CRAFT_COUNTERS.values()})
    counted = classify_multi_value(
        old,
        "Watercraft_Risk_Assessment_ID",
        "WatercraftType",
        craft_lookup(types, categories),
        "WatercraftType",
        "category",
        CRAFT_CLASSES,
        prepare=tidy,
    )
    return union_by_name([tidy(recent), counted])


CRAFT_CLASSES = {**fixed.CRAFT_COUNTERS, fixed.UNKNOWN: fixed.UNKNOWN}


def craft_parts(df: DataFrame, year: int, types: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``classify_craft`` for the table of one year: its rows, and what it adds to the counts per id."""
    df = with_all_columns(df)
    if year > LAST_RECODED_YEAR:
        df = df.withColumns({c: text.to_number(F.col(c)) for c in fixed.CRAFT_COUNTERS.values()})
        return tidy(df.drop("WatercraftType")), None
    lookup = craft_lookup(types, categories)
    return class_parts(
        df, "Watercraft_Risk_Assessment_ID", "WatercraftType", lookup, "WatercraftType", "category", CRAFT_CLASSES, prepare=tidy
    )


def pool_craft(rows: DataFrame, adds: DataFrame) -> DataFrame:
    """The counters of tables that came one by one, as if they had come together."""
    return pool_parts(rows, adds, "Watercraft_Risk_Assessment_ID", CRAFT_CLASSES)


def settle_home_destinations(df: DataFrame, corrections: DataFrame) -> DataFrame:
    """Corrected names and a few cities settle the province; some cities also the name.

    A correction that is NULL puts NULL into the set of known names, so missing names count too.
    """
    known = corrections.select("Corrected_Name").filter(
        F.col("Corrected_Name").isNull() | (F.col("Corrected_Name") != fixed.NO_MATCH)
    )
    df = joins.flag_membership(df, known, [(DEST, "Corrected_Name")], "__known")
    city = F.col(DEST_CITY)
    return joins.override_by_membership(
        df,
        [
            (F.col("__known"), DEST_PROVINCE, fixed.HOME_PROVINCE),
            (recode.in_set(city, fixed.HOME_CITIES), DEST_PROVINCE, fixed.HOME_PROVINCE),
            (recode.in_set(city, fixed.OCEAN_CITIES), DEST, fixed.OCEAN),
        ],
    ).drop("__known")


def destination_flags(df: DataFrame) -> DataFrame:
    name = F.col(DEST)
    flags = {
        "DestNotBC": (F.col(DEST_PROVINCE) != fixed.HOME_PROVINCE) | (name == fixed.NO_MATCH),
        "DryStorage": (name == fixed.DRY_STORAGE) | (F.col("Destination_Dry_Storage_Ind") == "true"),
        "UnknownDest": F.col("Unknown_Destination_Waterbody_Ind") == "true",
        "OceanBoat": name.contains("Ocean"),
    }
    return df.withColumns({k: recode.holds(v) for k, v in flags.items()})


def flags_to_boolean(df: DataFrame) -> DataFrame:
    """Every column whose name ends in "Ind", whatever the case, unless it is boolean already."""
    kinds = dict(df.dtypes)
    listed = [c for c in df.columns if c.lower().endswith("ind") and kinds[c] != "boolean"]
    return apply_to_columns(df, recode.flag_text_to_boolean, listed)


def resolved_source(place: Column, major_city: Column, home: Column) -> Column:
    """Source place; if unknown, the major city, else the home province; of ``a, b, c`` the middle."""
    unknown = place.isNull() | (place == fixed.UNKNOWN)
    usable = major_city.isNotNull() & (major_city != "None")
    raw = F.when(unknown & usable, major_city).when(unknown, home).otherwise(place)
    return F.when(raw.rlike(",.*,"), text.between_commas(raw)).otherwise(raw)


def settle_source(df: DataFrame, abbreviations: DataFrame) -> DataFrame:
    raw = resolved_source(F.col(SOURCE), F.col("Previous_Major_City"), F.col("Province_Code"))
    df = joins.recode_by_lookup(df.withColumn(SOURCE, raw), SOURCE, abbreviations, "Province_or_State", "Abbrev")
    return df.withColumn(SOURCE, recode.recode_exact(F.col(SOURCE), fixed.SOURCE_CODES))


def clean_inspections(
    df: DataFrame,
    corrections: DataFrame,
    craft_types: DataFrame,
    craft_categories: DataFrame,
    abbreviations: DataFrame,
) -> CleanTables:
    """The cleaned table and its three views. Rule order matters: later rules read earlier results."""
    df = classify_craft(with_all_columns(df), craft_types, craft_categories)
    return clean_views(clean_classified(df, corrections, abbreviations))


def with_all_columns(df: DataFrame) -> DataFrame:
    df = with_missing_columns(
        df,
        *DESTINATIONS,
        *fixed.CRAFT_COUNTERS.values(),
        "Previous_Major_City",
        "Previous_Waterbody_2_Province_Or_State",
        "Previous_Waterbody_3_Province_Or_State",
    )
    return df.withColumn("High_Risk_AIS_Ind", recode.normalise_flag_text(F.col("High_Risk_AIS_Ind")))


def clean_classified(df: DataFrame, corrections: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """The rules after craft is classified; each looks at one record and at lookups."""
    fixes = corrections.select("Non_Matching_Name", "Corrected_Name")
    df = joins.correct_by_lookup(df, DESTINATIONS, fixes, "Non_Matching_Name", "Corrected_Name")
    earlier = [F.col(f"Previous_Waterbody_{i}_Province_Or_State") for i in (1, 2, 3)]
    df = df.withColumn("UnknownSourceBoat", recode.all_missing(F.col("Province_Code"), *earlier))
    df = destination_flags(settle_home_destinations(df, fixes))
    df = settle_source(flags_to_boolean(df), abbreviations)
    people = text.whole_number(F.col("Number_Of_People_In_Party"))
    return df.withColumn("Number_Of_People_In_Party", people)


def clean_views(df: DataFrame) -> CleanTables:
    return CleanTables(
        everything=df,
        selected=select_once(df, fixed.SELECTED_COLUMNS, missing_as_null=True),
        high_risk=df.filter(F.col("High_Risk_AIS_Ind")),
        fouled=df.filter(F.col("MusselsFound_Ind")),
    )
