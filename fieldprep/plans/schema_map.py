"""The canonical schema of the yearly tables, one entry per canonical column.

An entry says, per year, which rule makes the column from which raw columns. Rules are
plain column expressions; ``map_schema`` turns the entries of one year into one select.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.functions import recode, text
from fieldprep.operators.columns import project, require_columns
from fieldprep.plans.fixed_values import CANADIAN_CODES


@dataclass(frozen=True)
class Rule:
    """An expression over raw columns."""

    make: Callable[..., Column]
    columns: tuple[str, ...]
    settings: tuple = field(default=())

    def column(self) -> Column:
        return self.make(*[F.col(f"`{c}`") for c in self.columns], *self.settings)


SchemaMap = Mapping[str, Mapping[int, Rule]]


def map_schema(df: DataFrame, schema: SchemaMap, year: int) -> DataFrame:
    """A year's raw table in canonical columns; what no rule mentions is dropped."""
    rules = {name: by_year[year] for name, by_year in schema.items() if year in by_year}
    require_columns(df, {c for r in rules.values() for c in r.columns})
    return project(df, {"Year": F.lit(year), **{name: rule.column() for name, rule in rules.items()}})


# The kinds of rule.
def copy(col: Column) -> Column:
    return col


def is_yes(col: Column) -> Column:
    return recode.flag_text(col == "yes")


def is_value(col: Column, value: str) -> Column:
    return recode.flag_text(col == value)


def mentions(col: Column, pattern: str) -> Column:
    return recode.flag_text(col.rlike(pattern))


def any_mentions(*cols_and_pattern) -> Column:
    *cols, pattern = cols_and_pattern
    hit = F.lit(False)
    for c in cols:
        hit = hit | recode.holds(c.rlike(pattern))
    return recode.flag_text(hit)


def mentions_any(col: Column, *words: str) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | col.contains(w)
    return recode.flag_text(hit)


def is_given(col: Column) -> Column:
    return recode.flag_text(col.isNotNull())


def no_or_outcome(answer: Column, outcome: Column, word: str) -> Column:
    return recode.flag_text(recode.holds(answer == "no") | recode.holds(outcome.contains(word)))


def free_text(col: Column, other: Column) -> Column:
    return recode.other_to_text(col, other, always_text=True)


def country(col: Column) -> Column:
    return recode.class_of(col, CANADIAN_CODES, "CAN", "USA")


def city_or_rest(col: Column, other: Column) -> Column:
    return F.when(col != "Other", text.leading_word(col)).when(col == "Other", text.extract(other, r"\,.*"))


def day(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd")


def hour(col: Column) -> Column:
    return F.date_format(col, "HH")


def counter_of(kind: Column, amount: Column, label: str) -> Column:
    return recode.value_if(kind, label, amount)


def of(rule: Callable[..., Column], *columns: str, years: Iterable[int], settings: tuple = ()) -> dict[int, Rule]:
    return {y: Rule(rule, columns, settings) for y in years}


def by_year(rule: Callable[..., Column], columns: Mapping[int, str | tuple[str, ...]], settings: tuple = ()) -> dict[int, Rule]:
    return {y: Rule(rule, (c,) if isinstance(c, str) else c, settings) for y, c in columns.items()}


ALL = (2015, 2016, 2017, 2018, 2019)
OLD, NEW = (2016, 2017), (2018, 2019)
FOUND = {2018: "Dreissenid_Mussels_Found...54", 2019: "Dreissenid_Mussels_Found...62"}
PROVINCE = {
    2015: "Province_State_Previous_Waterbody",
    2016: "State_Province_of_Previous_Waterbody",
    2017: "State_Province_of_Previous_Waterbody",
    2018: "State_Province_for_Previous_Waterbody_1",
    2019: "State_Province_for_Previous_Waterbody_1",
}
KNOWS = "Previous_knowledge_of_AIS_or_Clean,_Drain,_Dry"
KNOWS_FROM = ("Source_of_AIS_Clean,_Drain,_Dry_Knowledge", "Other_source_of_AIS_knowledge")
KNOWS_FROM_NEW = ("Source_of_Previous_Knowledge_of_CDD_AIS", "Other_Source_of_CDD_AIS_knowledge")
OUTCOME = "Watercraft_Inspection_Outcome"
DESTINATION = {2015: "Destination_Waterbody_1", 2016: "Destination_waterbody_1", 2017: "Destination_waterbody_1"} | {
    y: "Destination_Waterbody_1" for y in NEW
}
PREVIOUS = {y: "Previous_waterbody_(1)" for y in OLD} | {y: "Previous_Waterbody_1" for y in NEW}
CRAFT = ("Single_watercraft_type", "Number_watercraft")


def _found(year_2015: str, year_2016: str) -> dict[int, Rule]:
    return (
        of(is_value, "Reason_for_High_Risk_Inspection2", years=[2015], settings=(year_2015,))
        | of(mentions, OUTCOME, years=[2016], settings=(year_2016,))
    )


_MUSSELS = (
    _found("Dreissenid Mussels Found", "Dreissenid Mussels Found")
    | of(mentions_any, OUTCOME, years=[2017], settings=("Dreissenid mussels and", "Dreissenid Mussels Only"))
    | by_year(is_yes, FOUND)
)

# Raw headers and marker texts of the yearly tables.
YEARLY_SCHEMA: SchemaMap = {
    "Watercraft_Risk_Assessment_ID": of(copy, "Inspection_ID", years=ALL),
    "Station": of(copy, "Station_Name", years=ALL),
    "Start_Time": of(copy, "Shift_Start_Time", years=(2015, 2016)) | of(copy, "shift_start", years=(2017, *NEW)),
    "End_Time": of(copy, "Shift_End_Time", years=ALL),
    "TimeOfInspection": of(copy, "TimeOfInspection", years=ALL),
    "Inspection_Date": of(day, "TimeOfInspection", years=[2015]) | of(day, "Shift_Date", years=(*OLD, *NEW)),
    "Inspection_Hour": of(hour, "TimeOfInspection", years=ALL),
    "Shift_Duration": by_year(
        copy,
        {2016: "Shift_Duration_(hrs)", 2017: "Shift_duration_(hrs)", 2018: "Shift_Duration_(Hrs)", 2019: "Shift_Duration_(hrs)"},
    ),
    "Total_BlowBys": of(copy, "Blow_By's_(Non-compliant)", years=[2015]),
    "Motorized_Blow_Bys_Counter": of(copy, "Blow_By's_(Motorized_Boats)", years=OLD)
    | by_year(copy, {2018: "Blow_By's_(motorized_boats)", 2019: "Blow_By_(Motorized_Boats)"}),
    "Non_Motorized_Blow_Bys_Counter": of(copy, "Blow_By's_(Non-Motorized)", years=OLD)
    | by_year(copy, {2018: "Blow_By's_(Non-motorized)", 2019: "Blow_By_(Non-Motorized_Boats)"}),
    "Province_Code": by_year(copy, PROVINCE),
    "Country_Code": by_year(country, PROVINCE),
    "Number_Of_People_In_Party": by_year(copy, {2015: "Number_of_People_Interacted_with"})
    | of(copy, "Number_of_people_in_party", years=OLD)
    | of(copy, "Total_People_Interacted_with", years=NEW),
    # Craft.
    "WatercraftType": by_year(
        recode.other_to_text,
        {
            2015: ("Watercraft_Type", "Other_Watercraft_Type"),
            2016: ("Watercraft_type", "Other_watercraft_type"),
            2017: ("Watercraft_type", "Other_watercraft_type"),
            2018: ("Watercraft_Type", "Other_Watercraft_Type"),
        },
    ),
    "Non_Motorized_Counter": of(counter_of, *CRAFT, years=[2019], settings=("Non-motorized / hand launched watercraft",)),
    "Simple_Counter": of(counter_of, *CRAFT, years=[2019], settings=("Simple watercraft",)),
    "Complex_Counter": of(counter_of, *CRAFT, years=[2019], settings=("Complex watercraft",)),
    "Very_Complex_Counter": of(counter_of, *CRAFT, years=[2019], settings=("Very complex watercraft",)),
    "Commercially_Hauled_Ind": of(is_yes, "Is_the_watercraft_equipment_commercially_hauled", years=OLD)
    | of(is_yes, "Is_the_Watercraft_Commercially_Hauled", years=NEW),
    # Earlier knowledge and inspections.
    "Previous_AIS_Knowledge_Ind": of(copy, "Previous_Knowledge_of_CDD_AIS", years=[2015])
    | of(recode.yes_no, KNOWS, years=OLD)
    | of(recode.yes_no, "Previous_knowledge_of_CDD_or_AIS", years=NEW),
    "Previous_AIS_Knowledge_Source": of(
        recode.other_to_text, "Source_of_Previous_Knowledge_AIS_CDD", "Other_Source_of_Knowledge", years=[2015]
    )
    | of(free_text, *KNOWS_FROM, years=OLD)
    | of(free_text, *KNOWS_FROM_NEW, years=NEW),
    "Previous_Inspection_Ind": of(copy, "Has_the_watercraft_been_previously_inspected", years=[2015])
    | of(recode.yes_no, "Previous_inspection", years=OLD)
    | of(recode.yes_no, "Was_the_watercraft_previously_inspected", years=NEW),
    "Previous_Inspection_Days_Count": of(copy, "Days_Since_Previous_Inspection", years=[2015])
    | of(copy, "Number_of_days_since_previous_inspection", years=OLD),
    "Previous_Inspection_Source_Name": of(copy, "Location_of_Previous_Inspection", years=(2015, *NEW))
    | of(copy, "Location_of_previous_inspection", years=OLD),
    "Previous_Inspection_Found_Dressenidae_Mussels": of(is_yes, "Dreissenid_Mussels_Found_on_Previous_Inspection", years=NEW),
    # Where the craft was.
    "Previous_Waterbody_1_Name": of(copy, "Previous_Waterbody_1", years=[2015])
    | of(recode.other_to_text, "Previous_waterbody_(1)", "Other_waterbody_1", years=OLD)
    | of(recode.other_to_text, "Previous_Waterbody_1", "Other_Previous_Waterbody_1", years=NEW),
    "Previous_Waterbody_1_Closest_City": of(
        city_or_rest,
        "City_State_Province_of_Previous_Waterbody_1",
        "Other_City_State_Province_of_Previous_waterbody_1",
        years=[2015],
    )
    | of(recode.other_to_text, "Closest_City_to_Previous_Waterbody_1", "Other_closest_city_to_waterbody_1", years=OLD)
    | of(recode.other_to_text, "Closest_City_to_Previous_Waterbody_1", "Other_Closest_City_Previous_Waterbody_1", years=NEW),
    "Previous_Waterbody_1_Province_Or_State": by_year(copy, PROVINCE),
    "Previous_Waterbody_1_Days_Out_Of_Water": of(copy, "Days_out_of_waterbody_1", years=[2015])
    | of(copy, "Number_of_days_out_of_waterbody_1", years=OLD)
    | of(copy, "Days_out_of_water_(previous_waterbody1)", years=NEW),
    "Previous_Waterbody_2_Name": of(copy, "Previous_Waterbody_2", years=[2015])
    | of(recode.other_to_text, "Previous_waterbody_(2)", "Other_waterbody_2", years=OLD)
    | of(recode.other_to_text, "Previous_Waterbody_2", "Other_Previous_Waterbody_2", years=NEW),
    "Previous_Waterbody_2_Closest_City": of(copy, "Closest_City_to_Previous_Waterbody_2", years=(*OLD, *NEW)),
    "Previous_Waterbody_2_Province_Or_State": of(copy, "State_Province_of_Previous_Waterbody_2", years=OLD)
    | of(copy, "State_Province_for_Previous_Waterbody_2", years=NEW),
    "Previous_Waterbody_2_Days_Out_Of_Water": of(copy, "Number_of_days_out_of_waterbody_2", years=OLD)
    | of(copy, "Day_out_of_water_(previous_waterbody_2)", years=NEW),
    "Previous_Dry_Storage_Ind": by_year(mentions, PREVIOUS, ("Dry Storage",)),
    "Unknown_Previous_Water_Body_Ind": by_year(mentions, PREVIOUS, ("Unknown",)),
    # Where the craft goes.
    "Destination_Waterbody_1_Name": of(copy, "Destination_Waterbody_1", years=[2015])
    | of(recode.other_to_text, "Destination_waterbody_1", "Other_destination_waterbody", years=OLD)
    | of(recode.other_to_text, "Destination_Waterbody_1", "Other_Destination_Waterbody_1", years=NEW),
    "Destination_Waterbody_1_Closest_City": of(text.without_province, "Closest_City_to_Destination_Waterbody", years=[2015])
    | of(copy, "Closest_City_to_Destination_Waterbody", years=(*OLD, *NEW)),
    "Destination_Waterbody_1_Province_Or_State": of(text.province_code, "Closest_City_to_Destination_Waterbody", years=[2015])
    | of(copy, "State_Province_of_Destination_Waterbody", years=(*OLD, *NEW)),
    "Destination_Dry_Storage_Ind": of(
        any_mentions, "Destination_Waterbody_1", "Other_Destination_Waterbody", years=[2015], settings=("Dry",)
    )
    | of(mentions, DESTINATION[2016], years=[2016], settings=("Dry Storage",))
    | by_year(mentions, {y: DESTINATION[y] for y in (2017, *NEW)}, ("Dry [s,S]torage",)),
    "Unknown_Destination_Waterbody_Ind": of(
        any_mentions, "Destination_Waterbody_1", "Other_Destination_Waterbody", years=[2015], settings=("Unknown",)
    )
    | by_year(mentions, {y: DESTINATION[y] for y in (*OLD, *NEW)}, ("Unknown",)),
    # What was found.
    "High_Risk_AIS_Ind": by_year(
        recode.yes_no,
        {
            2015: "Is_the_watercraft_high_risk_for_Dreissenid_mussels_AIS",
            2016: "Is_the_watercraft_equipment_high_risk_for_Dreissenid_Mussels_or_AIS",
            2017: "Is_the_watercraft_equipment_high_risk_for_Dreissenid_mussels_or_AIS",
            2018: "Is_the_watercraft_high_risk_for_AIS_Dreissenid_mussels",
            2019: "Is_the_watercraft_high_risk_for_AIS_Dreissenid_mussels",
        },
    ),
    "High_Risk_Area_Ind": by_year(
        mentions, {2016: "Reason_for_Inspection", 2017: "Reason_for_High_Risk_Inspection"}, ("contaminated",)
    ),
    "Adult_Dressenidae_Found_Ind": _MUSSELS,
    "Adult_Dreissenidae_Mussel_Found_Ind": _MUSSELS,
    "Standing_Water_Present_Ind": _found("Standing Water", "Standing Water")
    | of(mentions_any, OUTCOME, years=[2017], settings=("and standing water", "Standing Water"))
    | of(is_yes, "Standing_water_found", years=NEW),
    "Adult_Mussels_Location_Name": of(copy, "Location_of_mussels_or_standing_water_found", years=NEW),
    "Aquatic_Plants_Found_Ind": of(
        no_or_outcome,
        "Is_the_watercraft_free_of_any_aquatic_plants",
        OUTCOME,
        years=[2017],
        settings=("Aquatic vegetation found",),
    )
    | of(is_value, "Other_inspection_outcomes", years=[2018], settings=("Aquatic plants found",))
    | of(is_yes, "Aquatic_plants_found_on_inspection", years=[2019]),
    "Marine_Mussel_Found_Ind": of(is_value, "Other_inspection_outcomes", years=NEW, settings=("Marine mussels found",)),
    "Marine_Species_Found_Ind": of(is_yes, "Marine_species_found_on_inspection", years=[2019]),
    # What was done.
    "Decontamination_Performed_Ind": of(is_given, "Decontamination_Order_Reference_Number", years=[2016])
    | of(is_yes, "Was_a_decontamination_performed", years=[2017])
    | of(is_yes, "Decontamination_Performed", years=NEW),
    "Decontamination_Reference": of(copy, "Decontamination_Order_Reference_Number", years=[2016])
    | of(copy, "Record_of_Decontamination_Reference_Number", years=[2017])
    | of(copy, "Record_of_Decontamination_Number", years=NEW),
    "Decontamination_order_issued_Ind": of(mentions, "Actions_Taken", years=[2016], settings=("Decontamination Order Issued",))
    | of(is_yes, "Was_a_decontamination_order_issued", years=[2017])
    | of(is_yes, "Decontamination_Order_Issued", years=NEW),
    "Decontamination_order_number": of(copy, "Decontamination_Order_Reference_Number", years=[2017])
    | of(copy, "Decontamination_Order_number", years=NEW),
    "Quarantine_Period_Issued_Ind": of(mentions, "Actions_Taken", years=[2016], settings=("30 Day Quarantine Order Issued",))
    | of(is_yes, "Was_a_quarantine_period_issued", years=[2017])
    | of(is_yes, "Quarantine_period_issued_for_30_day_drying_time", years=NEW),
    "Seal_Issued_Ind": of(is_yes, "Did_you_seal_the_boat", years=[2017])
    | of(is_yes, "Was_a_seal_applied_to_the_watercraft", years=NEW),
    "Seal_Number": of(copy, "Tag_Seal_Number", years=OLD) | of(copy, "Seal_tag_number", years=NEW),
    "New_Passport_Issued_Ind": of(copy, "Was_a_passport_issued", years=[2017])
    | of(is_yes, "Was_an_AIS_passport_issued", years=NEW),
    "Passport_Holder_Ind": of(mentions, "Passport_number", years=[2017], settings=("[0-9]+",)),
    "Passport_Number": of(copy, "Passport_number", years=[2017]) | of(copy, "AIS_Passport_Number_Issued", years=NEW),
    "K9_Inspection_Ind": of(mentions, "Was_a_K9_inspection_performed", years=[2017], settings=("yes",))
    | of(mentions, "K9_Inspection", years=NEW, settings=("yes",)),
    "K9_On_Shift_Ind": by_year(copy, {2018: "K9_On_Shift", 2019: "K9_on_Shift"}),
}
