from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from fieldprep.functions import clock, geometry
from fieldprep.operators.aggregates import classify_multi_value
from fieldprep.plans import cleaning, combining, polygons, reports
from fieldprep.plans import fixed_values as fixed
from fieldprep.plans.fixed_values import SELECTED_COLUMNS
from fieldprep.plans.schema_map import YEARLY_SCHEMA, map_schema
from fieldprep.plans.fixed_values import FOULED_LIST_ROWS
from fieldprep.workload.canonical import RULES

DAY = {2015: "42186", 2016: "42552", 2017: "42917", 2018: "43282", 2019: "43647"}


def test_schema_has_every_canonical_column():
    assert len(YEARLY_SCHEMA) + 1 == 63
    per_year = {y: 1 + sum(y in rules for rules in YEARLY_SCHEMA.values()) for y in DAY}
    assert per_year == {2015: 32, 2016: 46, 2017: 53, 2018: 54, 2019: 58}
    assert len(SELECTED_COLUMNS) == 54 == len(set(SELECTED_COLUMNS))


def raw_row(spark, year, values):
    columns = {c for rules in YEARLY_SCHEMA.values() if year in rules for c in rules[year].columns}
    cells = {c: None for c in columns if c not in ("Shift_Date", "TimeOfInspection")} | values
    schema = ", ".join(f"`{c}` string" for c in cells)
    df = spark.createDataFrame([tuple(cells.values())], schema)
    return df.withColumns({c: F.lit(v).cast(t) for c, v, t in (("Shift_Date", "2017-07-01", "date"), ("TimeOfInspection", "2017-07-01 09:30:00", "timestamp_ntz"))})


@pytest.mark.parametrize(
    "year, raw, expected",
    [
        (2015, {"Closest_City_to_Destination_Waterbody": "Vernon BC"}, {"Destination_Waterbody_1_Closest_City": "Vernon ", "Destination_Waterbody_1_Province_Or_State": "BC"}),
        (2015, {"City_State_Province_of_Previous_Waterbody_1": "Fernie BC"}, {"Previous_Waterbody_1_Closest_City": "Fernie"}),
        (2015, {"City_State_Province_of_Previous_Waterbody_1": "Other", "Other_City_State_Province_of_Previous_waterbody_1": "Elko, BC"}, {"Previous_Waterbody_1_Closest_City": ", BC"}),
        (2015, {"Other_Destination_Waterbody": "Dry dock"}, {"Destination_Dry_Storage_Ind": "true", "Unknown_Destination_Waterbody_Ind": "false"}),
        (2016, {"Decontamination_Order_Reference_Number": "7", "Actions_Taken": "30 Day Quarantine Order Issued"}, {"Decontamination_Performed_Ind": "true", "Quarantine_Period_Issued_Ind": "true", "Decontamination_order_issued_Ind": "false"}),
        (2016, {"Previous_waterbody_(1)": "Other", "Other_waterbody_1": "Lake X"}, {"Previous_Waterbody_1_Name": "Lake X", "Previous_Dry_Storage_Ind": "false"}),
        (2016, {"Source_of_AIS_Clean,_Drain,_Dry_Knowledge": "Web", "Other_source_of_AIS_knowledge": "friend"}, {"Previous_AIS_Knowledge_Source": "friend"}),
        (2017, {"Watercraft_Inspection_Outcome": "Dreissenid mussels and standing water"}, {"Adult_Dressenidae_Found_Ind": "true", "Standing_Water_Present_Ind": "true"}),
        (2017, {"Watercraft_Inspection_Outcome": "No Dreissenid"}, {"Adult_Dressenidae_Found_Ind": "false"}),
        (2017, {"Passport_number": "A1", "Is_the_watercraft_free_of_any_aquatic_plants": "no"}, {"Passport_Holder_Ind": "true", "Aquatic_Plants_Found_Ind": "true", "Inspection_Date": "2017-07-01", "Inspection_Hour": "09"}),
        (2018, {"Dreissenid_Mussels_Found...54": "yes", "Other_inspection_outcomes": "Marine mussels found"}, {"Adult_Dreissenidae_Mussel_Found_Ind": "true", "Marine_Mussel_Found_Ind": "true", "Aquatic_Plants_Found_Ind": "false"}),
        (2018, {"State_Province_for_Previous_Waterbody_1": "BC"}, {"Province_Code": "BC", "Country_Code": "CAN"}),
        (2019, {"State_Province_for_Previous_Waterbody_1": None}, {"Province_Code": None, "Country_Code": "USA"}),
        (2019, {"Single_watercraft_type": "Simple watercraft", "Number_watercraft": "3"}, {"Simple_Counter": "3", "Complex_Counter": "0"}),
        (2019, {"Destination_Waterbody_1": "Dry storage"}, {"Destination_Dry_Storage_Ind": "true"}),
    ],
)
def test_schema_rules(spark, year, raw, expected):
    row = map_schema(raw_row(spark, year, raw), YEARLY_SCHEMA, year).first().asDict()
    assert row["Year"] == year
    assert {k: row[k] for k in expected} == expected


def test_schema_needs_its_columns(spark):
    with pytest.raises(ValueError):
        map_schema(spark.range(1), YEARLY_SCHEMA, 2019)


def test_clock_2015_and_2016(spark):
    old = "`Time of High Risk Inspection` string, `Timestamp of inspection` string, `Shift Start Time` string, `Shift End Time` string"
    df = spark.createDataFrame(
        [("42186.3125", None, None, None), (None, "2015-07-01 5:30", None, None), (None, None, "2015-07-01 06:00:00", "2015-07-01 18:00:00")], old
    )
    assert [r.TimeOfInspection for r in combining.year_clock(df, 2015).collect()] == [datetime(2015, 7, 1, h, m) for h, m in ((7, 30), (5, 30), (6, 0))]
    new = old.replace("`Time of High", "`Date + Time of High") + ", `Shift Date` string"
    df = spark.createDataFrame(
        [
            (None, "2099-07-01 05:30:00", "2016-07-01 06:00:00", None, DAY[2016]),
            ("2014-07-01 05:30:00", None, None, None, DAY[2016]),
            (None, None, None, None, None),
        ],
        new,
    )
    done = combining.year_clock(df, 2016).collect()
    assert [(r.TimeOfInspection, r["Shift Date"]) for r in done] == [(datetime(2016, 7, 1, 6), date(2016, 7, 1))]


def test_clock_2017_on(spark):
    columns = "`Time of inspection` string, Timestamp string, `Shift Start Time` string, `Shift End Time` string, `Shift Date` string"
    d = DAY[2017]
    df = spark.createDataFrame([("00:20:00", f"{d}.5", d, d, d), (None, f"{d}.5", d, d, d), ("11:30:00", None, f"{d}.25", None, d)], columns)
    assert [r.TimeOfInspection for r in combining.year_clock(df, 2017).collect()] == [datetime(2017, 7, 2, 0, 20), datetime(2017, 7, 1, 12), datetime(2017, 7, 1, 11, 30)]
    d = DAY[2019]
    df = spark.createDataFrame([("0.3125", d, d, d, d)], columns.replace("inspection", "Inspection"))
    assert combining.year_clock(df, 2019).first().TimeOfInspection == datetime(2019, 7, 1, 7, 30)


def test_tranches(spark):
    df = spark.createDataFrame(
        [
            ("2021-07-01T20:00:00", "2021-07-01T04:00:00", "2021-07-01T21:10:00", "10:00"),
            ("2021-07-01T20:00:00", None, "2021-07-01T21:10:00", None),
            ("2025-05-01T15:00:00", "2025-05-01T23:00:00", "2025-05-01T17:00:00", "2025-05-01 10:00:00"),
        ],
        "`Start Time` string, `End Time` string, raw_timestamp string, `Inspection Time` string",
    )
    done = combining.canonical_extracts(df).collect()
    at = lambda d, h, m=0, y=2021, mo=7: datetime(y, mo, d, h, m)
    assert [(r.Start_Time, r.End_Time) for r in done] == [
        (at(2, 3), at(2, 11)),
        (at(2, 3), None),
        (at(1, 8, 0, 2025, 5), at(1, 16, 0, 2025, 5)),
    ]
    assert [r.TimeOfInspection for r in done] == [at(1, 21, 10), at(1, 21, 10), at(1, 10, 0, 2025, 5)]
    assert [(r.raw_timestamp, r.Hour_Min_of_Insp) for r in done] == [(None, "10:00"), (None, "21:10"), (at(1, 17, 0, 2025, 5), None)]
    zoned = combining.zoned_inspection_time(combining.canonical_extracts(df)).select(clock.utc_clock(F.col("TimeOfInspection"))).first()[0]
    assert zoned == at(2, 4, 10)


def test_fouled_lists(spark):
    recent = {
        2020: spark.createDataFrame([(15, "a"), (16, "b"), (17, "c")], "position int, `Watercraft Risk Assessment ID` string"),
        2024: spark.createDataFrame([(99, "d"), (1, None)], "position int, watercraftRiskAssessmentID string"),
    }
    keys = combining.fouled_keys(recent, FOULED_LIST_ROWS)
    assert rows(keys) == [("a",), ("b",), ("d",)]
    assert rows(combining.fouled_keys(recent)) == [("a",), ("b",), ("c",), ("d",)]
    df = spark.createDataFrame(
        [(2015, "1", "true", "false"), (2016, "2016-1", "true", "true"), (2016, "2016-2", "true", "true"), (2017, "2016-1", "false", "false"), (2020, "a", None, None), (2021, "1", None, None)],
        f"Year int, {combining.ID} string, {combining.FOULED_FLAGS[0]} string, {combining.FOULED_FLAGS[1]} string",
    )
    lists = combining.fouled_lists({y: spark.createDataFrame([("1",)], "`Inspection ID` string") for y in (2016, 2017, 2018, 2019)}, keys)
    done = combining.combine_fouled_flags(combining.align_fouled(df, lists))
    assert rows(done) == [(2015, "1", True), (2016, "2016-1", True), (2016, "2016-2", False), (2017, "2016-1", False), (2020, "a", True), (2021, "1", False)]


def test_destination_flag_truth_table(spark):
    df = spark.createDataFrame(
        [("BC", "Kalamalka Lake"), ("AB", "x"), (None, "x"), (None, "No Match"), ("BC", None), (None, None)],
        f"{cleaning.DEST_PROVINCE} string, {cleaning.DEST} string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("Destination_Dry_Storage_Ind", "Unknown_Destination_Waterbody_Ind")})
    assert [r.DestNotBC for r in cleaning.destination_flags(df).collect()] == [False, True, False, True, False, False]


def test_a_null_correction_makes_missing_names_known(spark):
    df = spark.createDataFrame([(None, "x", None), ("Lake", "Langley", "AB")], f"{cleaning.DEST} string, {cleaning.DEST_CITY} string, {cleaning.DEST_PROVINCE} string")
    fixes = lambda v: spark.createDataFrame([("a", v)], "Non_Matching_Name string, Corrected_Name string")
    province = lambda v: rows(cleaning.settle_home_destinations(df, fixes(v)), cleaning.DEST, cleaning.DEST_PROVINCE)
    assert province(None) == [("Pacific Ocean", "BC"), (None, "BC")]
    assert province("Right Lake") == [("Pacific Ocean", "BC"), (None, None)]


def test_destination_region_cascade(spark):
    cases = [
        ("Lake", "R", True, True, True, "Lake"),
        (None, "R", True, True, True, "R"),
        (None, None, False, True, True, "Outside BC"),
        (None, None, None, None, True, "Unknown (Toggle)"),
        (None, None, False, False, None, "Unknown"),
    ]
    df = spark.createDataFrame([c[:5] for c in cases], "n string, r string, b boolean, s boolean, t boolean")
    cols = [F.col(c) for c in "nrbs"]
    got = df.select(reports.destination_region(*cols, F.col("t")).alias("a"), reports.destination_region(*cols).alias("b")).collect()
    assert [r.a for r in got] == [c[5] for c in cases]
    assert [r.b for r in got][3] == "Unknown"


def test_stricter_high_risk(spark):
    df = spark.createDataFrame(
        [(1, True, False, 2021), (2, True, True, 2021), (3, True, None, 2021), (4, True, None, 2019), (5, False, False, 2019), (6, None, False, 2019)],
        "i int, High_Risk_AIS_Ind boolean, Clean_Drain_Dry_After_Inspection_Ind boolean, Year int",
    )
    assert rows(reports.strict_high_risk(df), "i") == [(1,), (4,)]


def test_every_canonical_column_is_compared():
    assert len(YEARLY_SCHEMA) + 1 == 63
    for year, rules in RULES.items():
        assert set(rules) == {name for name, by_year in YEARLY_SCHEMA.items() if year in by_year}


def facts_and_places(spark, folder):
    """Three inspections, a gazetteer of one town, and a square around it as a waterbody and as a region."""
    counters = {c: F.lit(1.0) for c in fixed.COUNTERS}
    flags = {c: F.lit(False) for c in ("High_Risk_AIS_Ind", "MusselsFound_Ind", "Commercially_Hauled_Ind", "Clean_Drain_Dry_After_Inspection_Ind", "Unknown_Destination_Waterbody_Ind", "DestNotBC", "DryStorage", "OceanBoat")}
    texts = {c: F.lit(None).cast("string") for c in (*fixed.SELECTED_COLUMNS, *[f"Destination_Waterbody_{i}_{f}" for i in (1, 2, 3) for f in ("Name", "Closest_City")])}
    made = spark.range(3).select(
        F.lit(2020).alias("Year"),
        *[v.alias(c) for c, v in (texts | counters | flags).items() if c not in ("Year", "Start_Time", "End_Time", cleaning.DEST, cleaning.DEST_CITY, "Destination_Major_City", combining.ID)],
        *[F.to_timestamp_ntz(F.lit("2020-07-01 06:00:00")).alias(c) for c in ("Start_Time", "End_Time")],
        F.col("id").cast("string").alias(combining.ID),
        F.when(F.col("id") < 2, "Long Lake").alias(cleaning.DEST),
        F.lit("Nelson").alias(cleaning.DEST_CITY),
        F.lit("Nelson, British Columbia, CAN").alias("Destination_Major_City"),
    )
    made.write.parquet(f"{folder}/facts")
    town = spark.createDataFrame([("Nelson", -117.25, 49.5)], "names string, lon double, lat double")
    x, y = geometry.PROVINCIAL_GRID.forward(F.col("lon"), F.col("lat"))
    square = town.select(geometry.box(x - 10, y - 10, x + 10, y + 10).alias("rings"))
    square.write.parquet(f"{folder}/layer")
    return spark.read.parquet(f"{folder}/facts"), town, spark.read.parquet(f"{folder}/layer")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_facts_are_summed_once_before_anything_spatial(spark, tmp_path):
    df, town, square = facts_and_places(spark, tmp_path)
    parts = square.select(F.lit(7).alias("WATERSH"), F.lit("Long Lake").alias("GNIS_NA"), "rings")
    done = polygons.summarise_to_polygons(df, parts, town, df.limit(0), df.limit(0))
    assert f"{tmp_path}/facts" not in plan_of(done) and f"{tmp_path}/layer" not in plan_of(done)
    assert rows(done, "WATERSH", "GNIS_NA", "TotalInspections", "NumberMusselFouled") == [(7, "Long Lake", 2, 0)]


def test_regions_of_cities_stand_in_no_plan_of_the_facts(spark, tmp_path):
    df, town, square = facts_and_places(spark, tmp_path)
    regions = square.select(F.lit("4").alias("REGION_G"), F.lit("Kootenay").alias("REGION_N"), "rings")
    states = square.select(F.lit("C").alias("NAME_0"), F.lit("P").alias("NAME_1"), F.lit("CA.BC").alias("HASC_1"), "rings")
    stations = spark.createDataFrame([("Golden",)], "map_label string")
    made = reports.report_tables(df, states, stations, regions, town, 2020)
    assert plan_of(made.everything).count(f"{tmp_path}/facts") == 1
    assert rows(made.everything, combining.ID, "City_region_n") == [(str(i), "Kootenay") for i in range(3)]
    assert rows(made.this_year, combining.ID, "DestRegion") == [("0", "Long Lake"), ("1", "Long Lake"), ("2", "Kootenay")]


def test_a_class_lookup_is_counted_once(spark, tmp_path):
    """What the slots of all branches read is the stored list of counts, not the lookup again and again."""
    spark.createDataFrame([("a", "A"), ("a", "B"), ("b", "B")], "t string, c string").write.parquet(f"{tmp_path}/lookup")
    lookup = spark.read.parquet(f"{tmp_path}/lookup")
    df = spark.createDataFrame([(1, "a,b"), (2, "b"), (2, "a"), (3, "x"), (4, None)], "id int, t string")
    done = classify_multi_value(df, "id", "t", lookup, "t", "c", {"A": "n_a", "B": "n_b"})
    assert f"{tmp_path}/lookup" not in plan_of(done)
    assert rows(done, "id", "n_a", "n_b") == [(1, 1.0, 3.0), (2, 0.0, 2.0), (2, 1.0, 2.0)]
