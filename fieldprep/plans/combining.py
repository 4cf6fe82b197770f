"""Read-side plan: time columns, canonical columns, fouled flags, one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.functions import clock, recode, text
from fieldprep.operators.columns import PROVINCE_HEADER, clean_column_names, snake_column_names
from fieldprep.operators.filters import drop_missing, first_source_rows
from fieldprep.operators.joins import flag_membership
from fieldprep.operators.reshape import union_by_name
from fieldprep.operators.shifts import repair_shift_full, repair_shift_simple
from fieldprep.plans.fixed_values import REGION_NAMES
from fieldprep.plans.schema_map import YEARLY_SCHEMA, SchemaMap, map_schema

ID = "Watercraft_Risk_Assessment_ID"
FOULED_FLAGS = ("Adult_Dressenidae_Found_Ind", "Adult_Dreissenidae_Mussel_Found_Ind")
RESIDENCE_HEADER = "State_Province_of_Boat_Residence"
# Years whose fouled flags come from a list; later ones share one list.
FIRST_LISTED_YEAR, LAST_TABLE_YEAR = 2016, 2019
# A full date marks records of the newer app, whose shift times are UTC.
NEW_TRANCHE = r"^[0-9\-]{10}"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def year_clock(df: DataFrame, year: int) -> DataFrame:
    """Typed time columns of one yearly table, by that year's habits."""
    return _typed_clock(df, year) if year <= 2016 else _serial_clock(df, year)


def _typed_clock(df: DataFrame, year: int) -> DataFrame:
    """2015 and 2016: times as text or serial; the best known of three is the inspection time."""
    seen = _c("Timestamp of inspection")
    taken = "Time of High Risk Inspection"
    if year == 2016:
        taken = f"Date + {taken}"
        seen = F.when(text.extract(seen, "^[0-9]{4}") != str(year), _c("Shift Start Time")).otherwise(seen)
    first_known = F.coalesce(_c(taken), seen, _c("Shift Start Time"))
    df = df.withColumn("__first", first_known)
    parse = lambda c: clock.parse_wall_clock(text.pad_clock(c))
    typed = {
        "TimeOfInspection": clock.serial_or_text(F.col("__first"), parse),
        "Shift Start Time": clock.parse_iso_clock(_c("Shift Start Time")),
        "Shift End Time": clock.parse_iso_clock(_c("Shift End Time")),
    }
    if year == 2016:
        typed["Shift Date"] = clock.serial_to_date(_c("Shift Date"))
    df = df.withColumns(typed).drop("__first")
    return df.filter(F.year("TimeOfInspection") == year) if year == 2016 else df


def _serial_clock(df: DataFrame, year: int) -> DataFrame:
    """2017 on: serial day, and the time of day in a column of its own."""
    raw_time = _c("Time of inspection" if year == 2017 else "Time of Inspection")
    seconds = (
        clock.seconds_of_clock_text(raw_time)
        if year == 2017
        else clock.seconds_of_day(clock.serial_to_timestamp(raw_time))
    )
    base = clock.serial_to_timestamp(F.coalesce(_c("Timestamp"), _c("Shift Start Time")))
    df = df.withColumns({"__base": base, "__seconds": seconds})
    at = F.when(F.col("__seconds").isNotNull(), clock.date_plus_clock(F.col("__base"), F.col("__seconds")))
    return df.withColumns(
        {
            "TimeOfInspection": at.otherwise(F.col("__base")),
            "shift_start": clock.serial_to_timestamp(_c("Shift Start Time")),
            "Shift End Time": clock.serial_to_timestamp(_c("Shift End Time")),
            "Shift Date": clock.serial_to_date(_c("Shift Date")),
        }
    ).drop("__base", "__seconds")


def abbreviate_regions(df: DataFrame, columns: Sequence[str] = (RESIDENCE_HEADER, PROVINCE_HEADER)) -> DataFrame:
    """Region names to codes, row by row, where the column exists."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: recode.recode_contains(F.col(c), REGION_NAMES) for c in present})


def canonical_year(raw: DataFrame, year: int, schema: SchemaMap = YEARLY_SCHEMA) -> DataFrame:
    """A raw yearly table in canonical columns; its inspection time is still a wall clock."""
    df = abbreviate_regions(clean_column_names(year_clock(raw, year)))
    return map_schema(df, schema, year)


def extract_shifts(df: DataFrame, full_repair: bool = False) -> DataFrame:
    """Shift times of the extracts as local wall clocks.

    The newer tranche is UTC and is read in Pacific time; the older one is repaired. Both
    rules run in one pass: the tranche is a column, not two scans.
    """
    new = recode.holds(_c("Inspection Time").rlike(NEW_TRANCHE))
    parse = lambda c: clock.parse_wall_clock(F.regexp_replace(_c(c), "T", "-"))
    df = df.withColumns({"__start": parse("Start Time"), "__end": parse("End Time"), "__seen": parse("raw_timestamp")})
    start, end = F.col("__start"), F.col("__end")
    df = df.withColumns({"__new": new, "__ps": clock.in_zone(start, clock.PACIFIC), "__pe": clock.in_zone(end, clock.PACIFIC)})
    if full_repair:
        old = repair_shift_full(
            df.filter(~F.col("__new")), "__start", "__end", "__seen", "Shift Start Comment", "Workflow ID"
        )
        df = old.unionByName(df.filter(F.col("__new")))
    else:
        # Computed for every row, used for the older tranche only.
        df = repair_shift_simple(df, "__start", "__end")
    pick = lambda fresh, repaired: F.when(F.col("__new"), F.col(fresh)).otherwise(F.col(repaired))
    return df.withColumns({"Start Time": pick("__ps", "__start"), "End Time": pick("__pe", "__end")}).drop(
        "__start", "__end", "__seen", "__new", "__ps", "__pe"
    )


def extract_clock(df: DataFrame) -> DataFrame:
    """Inspection time, date and HH:MM of the extracts.

    Newer records carry a full inspection time, older ones only HH:MM or nothing and take the
    raw timestamp. Both are Pacific wall clocks.
    """
    given = _c("Inspection Time") if "Inspection Time" in df.columns else F.lit(None).cast("string")
    new = recode.holds(given.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}"))
    seen = clock.parse_wall_clock(F.regexp_replace(F.col("raw_timestamp"), "T", "-"))
    df = df.withColumns({"__given": given, "__seen": seen, "new_tranche": new})
    given, seen, new = F.col("__given"), F.col("__seen"), F.col("new_tranche")
    local = F.when(new, clock.parse_wall_clock(given)).otherwise(seen)
    kept = {"Inspection Time": F.when(~new, given)} if "Inspection Time" in df.columns else {}
    return df.withColumns(
        {
            **kept,
            "TimeOfInspection": local,
            "Inspection Date": F.date_format(seen, "yyyy-MM-dd"),
            "Hour_Min_of_Insp": F.when(~new, F.coalesce(given, clock.hour_minute(seen))),
            "raw_timestamp": F.when(new, seen),
        }
    ).drop("__given", "__seen")


def canonical_extracts(raw: DataFrame, full_repair: bool = False) -> DataFrame:
    """The extracts with typed times and cleaned names; they carry canonical names already."""
    df = clean_column_names(extract_clock(extract_shifts(raw, full_repair)))
    return df.drop("new_tranche")


def fouled_keys(
    lists: Mapping[int, DataFrame], rows_per_list: Mapping[int, int] | None = None, position: str = "position"
) -> DataFrame:
    """One key column from the recent hand-kept lists, whatever their header style.

    ``rows_per_list`` says of which lists only so many leading rows are records; the others count
    whole. What follows the records in a list's file (notes, sums) is the caller's knowledge.
    """
    tables = []
    for year, df in lists.items():
        if year in (rows_per_list or {}):
            df = first_source_rows(df, rows_per_list[year], position)
        tidy = snake_column_names(df)
        tables.append(tidy.select(F.col(ID.lower()).cast("string").alias(ID)))
    return drop_missing(union_by_name(tables), ID)


def zoned_inspection_time(df: DataFrame, zone: str = clock.PACIFIC) -> DataFrame:
    """The wall clock of the inspection as an instant; clocks a DST gap skips become NULL."""
    return df.withColumn("TimeOfInspection", clock.to_instant(clock.force_zone(F.col("TimeOfInspection"), zone)))


def fouled_lists(by_year: Mapping[int, DataFrame], recent: DataFrame | None, key: str = "Inspection ID") -> DataFrame:
    """All hand-corrected lists as one key table: the list's year, 0 for the extracts', and the bare id."""
    yearly = [df.select(F.lit(y).alias("__list"), F.col(f"`{key}`").alias("__bare")) for y, df in by_year.items()]
    late = [] if recent is None else [recent.select(F.lit(0).alias("__list"), F.col(ID).alias("__bare"))]
    return union_by_name([*yearly, *late])


def align_fouled(df: DataFrame, lists: DataFrame) -> DataFrame:
    """Both fouled flags set by the corrected lists: one join for all years.

    Listed ids of the years 2016 to 2019 lack the year prefix; those of the extracts are whole.
    2015 keeps what its own columns say.
    """
    year = F.col("Year")
    listed = year.between(FIRST_LISTED_YEAR, LAST_TABLE_YEAR)
    prefixed = [(year == y, text.strip_year_prefix(F.col(ID), y)) for y in range(FIRST_LISTED_YEAR, LAST_TABLE_YEAR + 1)]
    keyed = df.withColumns(
        {"__list": F.when(listed, year).otherwise(0), "__bare": recode.fold_rules(prefixed, F.col(ID))}
    )
    flagged = flag_membership(keyed, lists, ["__list", "__bare"], "__fouled").drop("__list", "__bare")
    flags = {
        c: F.when(year < FIRST_LISTED_YEAR, F.col(c)).otherwise(recode.flag_text(F.col("__fouled"))) for c in FOULED_FLAGS
    }
    return flagged.withColumns(flags).drop("__fouled")


def combine_fouled_flags(df: DataFrame) -> DataFrame:
    either = recode.either_flag(*[F.col(c) for c in FOULED_FLAGS])
    return df.withColumn("MusselsFound_Ind", either).drop(*FOULED_FLAGS)


def combine_sources(
    years: Mapping[int, DataFrame],
    extracts: DataFrame,
    fouled_by_year: Mapping[int, DataFrame],
    fouled_recent: DataFrame,
    full_repair: bool = False,
) -> DataFrame:
    """All yearly tables and extracts as one canonical table. Narrow but for the one flag join.

    What is the same for every source (zone, flags) is done once, on the union.
    """
    tables = [canonical_extracts(extracts, full_repair)]
    tables += [canonical_year(years[y], y) for y in sorted(years, reverse=True)]
    df = zoned_inspection_time(union_by_name(tables))
    # Extracts alone lack what only yearly tables say.
    df = df.withColumns({c: F.lit(None).cast("string") for c in YEARLY_SCHEMA if c not in df.columns})
    return combine_fouled_flags(align_fouled(df, fouled_lists(fouled_by_year, fouled_recent)))


def combine_year(raw: DataFrame, year: int, fouled: DataFrame) -> DataFrame:
    """One yearly table as ``combine_sources`` has it; ``fouled`` is the list of the year."""
    df = zoned_inspection_time(canonical_year(raw, year))
    df = df.withColumns({c: F.lit(None).cast("string") for c in YEARLY_SCHEMA if c not in df.columns})
    return combine_fouled_flags(align_fouled(df, fouled_lists({year: fouled}, None)))
