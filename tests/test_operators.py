from collections import Counter
from datetime import datetime

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldprep.operators import aggregates as agg
from fieldprep.operators import columns as cols
from fieldprep.operators import filters, joins, reshape, shifts, windows

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def test_column_names():
    assert cols.clean_name("Is it?/Blow By's #") == "Is_it_Blow_By's_"
    assert cols.clean_name("Destination Province/State") == cols.PROVINCE_HEADER
    assert cols.clean_name("Province_State_of_Destination_Waterbody") == cols.PROVINCE_HEADER
    assert [cols.snake_name(n) for n in ("watercraftRiskAssessmentID", "Watercraft Risk (ID)", "AIS2 found")] == [
        "watercraft_risk_assessment_id",
        "watercraft_risk_id",
        "ais_2_found",
    ]
    assert cols.repair_duplicate_names(["a", "b", "a", ""]) == ["a...1", "b", "a...3", "...4"]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "x", "y")], "id int, Flag_Ind string, other_IND string")
    assert cols.select_once(df, ["id", "Flag_Ind", "id"]).columns == ["id", "Flag_Ind"]
    with pytest.raises(ValueError):
        cols.select_once(df, ["absent"])
    assert cols.select_once(df, ["absent", "id"], missing_as_null=True).first() == (None, 1)
    assert cols.move_first(df, "other_IND").columns == ["other_IND", "id", "Flag_Ind"]
    assert cols.apply_to_columns(df, F.upper, suffix="ind").first() == (1, "X", "Y")
    assert cols.keep_columns_of(df, df.select("id")).columns == ["id"]


@QUICK
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=20))
def test_split_is_disjoint_and_complete(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    yes, no = filters.split_by(df, F.col("v") > 2)
    assert {r.i for r in yes.collect()} == {i for i, v in enumerate(values) if v is not None and v > 2}
    assert yes.count() + no.count() == len(values)


def test_row_filters(spark):
    df = spark.createDataFrame(
        [(1, "Elk River", "Fernie"), (2, "Elk River", None), (3, "Upper Elk River", "x"), (4, None, "Elko"), (5, "Elk River", "Hosmer")],
        "id int, name string, city string",
    )
    kept = filters.name_preset(df, "name", "(Goat River|Elk River)", "Elk River", "city", ["Fernie", "Elko"])
    assert rows(kept, "id") == [(1,), (3,)]
    years = spark.createDataFrame([(2014,), (2015,), (2018,), (2019,), (None,)], "Year int")
    assert rows(filters.keep_era(years, 2015, 2018)) == [(2015,), (2018,)]
    assert rows(filters.keep_era(years, 2019, None)) == [(2019,)]


def test_lookup_keeps_nulls_and_fans_out(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, name string")
    lookup = spark.createDataFrame([("a", "A"), ("b", "B1"), ("b", "B2"), (None, "none"), ("z", None)], "wrong string, fix string")
    done = joins.correct_by_lookup(df, ["name"], lookup, "wrong", "fix")
    assert rows(done, "id", "name") == [(1, "A"), (2, "B1"), (2, "B2"), (3, "none"), (4, "z")]
    with pytest.raises(ValueError):
        joins.correct_by_lookup(df, ["name"], lookup, "wrong", "fix", on_duplicates="error")


def test_membership_is_never_null(spark):
    df = spark.createDataFrame([(2020, "1"), (2020, None), (2021, "1")], "Year int, id string")
    keys = spark.createDataFrame([(2020, "1"), (2020, "1"), (2020, None)], "Year int, id string")
    flagged = joins.flag_membership(df, keys, ["Year", "id"], "hit")
    assert rows(flagged) == [(2020, "1", True), (2020, None, True), (2021, "1", False)]
    assert joins.semi(df, keys, ["Year", "id"]).count() == 2
    assert rows(joins.anti(df, keys, ["Year", "id"])) == [(2021, "1")]


def test_full_outer_merge_matches_joins(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, a int")
    b = spark.createDataFrame([("y", 5), (None, 6), ("w", 7)], "k string, b int")
    assert rows(joins.full_outer_merge([a, b], ["k"])) == [("w", None, 7), ("x", 1, None), ("y", 2, 5), (None, 3, 6)]


def test_groups_with_and_without_trouble(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 9), ("b", 1), ("c", None)], "g string, v int")
    assert {r.g for r in joins.keep_groups(df, ["g"], F.col("v") < 5).collect()} == {"a", "c"}
    assert rows(joins.keep_groups(df, ["g"], F.col("v") < 5, clean=False)) == [("b", 1), ("b", 9)]


CLASSES = {"Non-motorized": "nonmotor", "Complex": "complex", "Unknown": "unknown"}


def classify(spark, records, extra=()):
    lookup = [("Kayak", "Non-motorized"), (" Ski boat", "Complex"), ("Unknown", "Unknown"), *extra]
    return agg.classify_multi_value(
        spark.createDataFrame(records, "Year int, id string, types string"),
        "id",
        "types",
        spark.createDataFrame(lookup, "t string, c string"),
        "t",
        "c",
        CLASSES,
    )


def test_classify_contract(spark):
    done = classify(
        spark,
        [(2015, "1", "Kayak, Ski boat"), (2015, "2", "Kayak,Kayak,Kayak,Kayak"), (2015, "3", None), (2015, "4", "Zeppelin"), (2015, "5", "other")],
    )
    assert rows(done, "id", "nonmotor", "complex", "unknown") == [
        ("1", 1.0, 1.0, 0.0),
        ("2", 3.0, 0.0, 0.0),
        ("3", 0.0, 0.0, 1.0),
        ("5", 0.0, 0.0, 1.0),
    ]
    assert done.columns == ["Year", "id", "nonmotor", "complex", "unknown"]


def test_classify_pools_repeated_ids_and_collapses_twins(spark):
    done = classify(spark, [(2015, "7", "Kayak"), (2016, "7", "Kayak, Ski boat"), (2017, "8", "Kayak"), (2017, "8", "Kayak"), (2018, None, "Kayak")])
    assert rows(done, "Year", "id", "nonmotor", "complex") == [
        (2015, "7", 2.0, 0.0),
        (2016, "7", 2.0, 1.0),
        (2017, "8", 2.0, 0.0),
        (2018, None, 1.0, 0.0),
    ]


def test_tables_that_come_one_by_one_are_pooled_like_one(spark):
    """Any order, a table again in place of itself, twins within a table, rows that keep their own counters."""
    records = [(2015, "7", "Kayak"), (2016, "7", "Kayak, Ski boat"), (2017, "8", "Kayak"), (2017, "8", "Kayak"), (2018, None, "Kayak"), (2016, None, "other"), (2018, "9", "Zeppelin")]
    lookup = spark.createDataFrame([("Kayak", "Non-motorized"), (" Ski boat", "Complex"), ("Unknown", "Unknown")], "t string, c string")
    came = {}
    for year in (2018, 2016, 2015, 2017, 2016):
        df = spark.createDataFrame([r for r in records if r[0] == year], "Year int, id string, types string")
        came[year] = agg.class_parts(df, "id", "types", lookup, "t", "c", CLASSES)
    late = spark.createDataFrame([(2019, "7", 5.0)], "Year int, id string, nonmotor double")
    held = [part[0] for part in came.values()]
    both = held[0].unionByName(held[1]).unionByName(held[2]).unionByName(held[3]).unionByName(late, allowMissingColumns=True)
    adds = [part[1] for part in came.values()]
    done = agg.pool_parts(both, adds[0].unionByName(adds[1]).unionByName(adds[2]).unionByName(adds[3]), "id", CLASSES)
    shown = ("Year", "id", "nonmotor", "complex", "unknown")
    assert rows(done.filter("Year < 2019"), *shown) == rows(classify(spark, records), *shown)
    assert rows(done.filter("Year = 2019"), "nonmotor") == [(5.0,)]


def test_classify_lookup_duplicates_multiply(spark):
    done = classify(spark, [(2015, "1", "Raft,Kayak")], extra=[("Raft", "Complex"), ("Raft", "Complex")])
    assert rows(done, "nonmotor", "complex") == [(2.0, 2.0)]


def test_classify_null_type_in_lookup(spark):
    done = classify(spark, [(2015, "1", "Kayak")], extra=[(None, "Complex")])
    assert rows(done, "nonmotor", "complex") == [(1.0, 2.0)]


def test_station_year_contract(spark):
    facts = spark.createDataFrame(
        [("A", 2024, "BC", True), ("A", 2024, "AB", False), ("A", 2024, "Unknown", None), ("A", 2024, None, False), ("B", 2024, None, False)],
        "Station string, Year int, prov string, fouled boolean",
    )
    stations = spark.createDataFrame([("A",), ("B",), ("C",)], "Station string")
    prov = F.col("prov")
    done = agg.dimension_year_summary(
        stations, facts, "Station", "Year", {"n": None, "fouled": F.col("fouled")}, F.when(prov != "Unknown", prov), "provs"
    )
    assert rows(done, "Station", "Year", "n", "fouled", "provs") == [("A", 2024, 4, 1, 2), ("B", 2024, 1, 0, None), ("C", None, 0, 0, None)]


def test_sums_of_nothing_are_zero(spark):
    df = spark.createDataFrame([("a", None, True), ("a", None, None)], "k string, v double, f boolean")
    assert agg.group_totals(df, ["k"], ["v", "f"]).first() == ("a", 2, 0.0, 1)


@QUICK
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "x", "y"]), st.integers(0, 40)), max_size=60))
def test_numbering_matches_brute_force(spark, values):
    records = [(k, v, i) for i, (k, v) in enumerate(values)]
    df = spark.createDataFrame(records, "k string, v int, i int")
    order = [F.col("v"), F.col("i")]
    per_key, seen = {}, Counter()
    for k, v, i in sorted(records, key=lambda r: (r[1], r[2])):
        seen[k] += 1
        per_key[i] = seen[k]
    assert {r.i: r.n for r in windows.number_rows(df, order, ["k"], "n").collect()} == per_key
    whole = {i: n for n, (_, _, i) in enumerate(sorted(records, key=lambda r: (r[1], r[2])), 1)}
    assert {r.i: r.n for r in windows.number_rows(df, order, alias="n").collect()} == whole


def test_a_hot_key_is_numbered_across_partitions(spark):
    """A key with a third of all rows is spread over several partitions and still numbered 1, 2, …"""
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id"))
    done = windows.number_rows(df, [F.col("id")], ["k"], "n").cache()
    hot = done.filter("k = 0")
    assert hot.agg(F.count("*"), F.min("n"), F.max("n"), F.count_distinct("n")).first() == (10000, 1, 10000, 10000)
    assert hot.filter(F.col("n") != F.col("id") / 3 + 1).count() == 0
    assert done.filter("k <> 0 and n <> 1").count() == 0


def test_group_ids_number_distinct_keys_nulls_last(spark):
    df = spark.createDataFrame([(2, 1), (1, None), (2, 1), (None, 5), (1, 3)], "s int, e int")
    assert rows(windows.dense_group_id(df, ["s", "e"], "id")) == [(1, 3, 1), (1, None, 2), (2, 1, 3), (2, 1, 3), (None, 5, 4)]


def test_group_stats_on_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "k string, v int")
    done = windows.attach_group_stats(df, ["k"], {"n": F.count("*"), "top": F.max("v")})
    assert rows(done) == [("a", 1, 2, 3), ("a", 3, 2, 3), (None, 5, 1, 5)]


def test_batches(spark):
    done = windows.batch_ids(spark.range(250), [F.col("id")], 100)
    assert rows(done.groupBy("batch_id").count()) == [(1, 100), (2, 100), (3, 50)]


def test_reshaping(spark):
    df = spark.createDataFrame([(1, "a", None, "b", "x", None, None), (2, None, "c", None, None, "d", "y")], "id int, n1 string, c1 string, n2 string, c2 string, n3 string, c3 string")
    slots = [{"name": F.col(f"n{i}"), "city": F.col(f"c{i}")} for i in (1, 2, 3)]
    done = reshape.stack_slots(df, ["id"], slots, [(), ("name",), ("name", "city")], "slot")
    assert rows(done) == [(1, 1, "a", None), (1, 2, "b", "x"), (2, 1, None, "c"), (2, 3, "d", "y")]
    cells = spark.createDataFrame([("a,b,c,d",), ("a",), ("",), (None,)], "t string")
    assert rows(reshape.split_to_columns(cells, "t", ["x", "y", "z"])) == [("", None, None), ("a", "b", "c"), ("a", None, None), (None, None, None)]
    both = reshape.union_by_name([cells.limit(0).withColumn("q", F.lit(1)), cells])
    assert both.columns == ["t", "q"] and both.count() == 4
    assert reshape.append_rows(cells, "t string", [("new",)]).count() == 5


@QUICK
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=10))
def test_unpivot_then_pivot_returns_capped_counters(spark, values):
    df = spark.createDataFrame([(i, str(a), str(b)) for i, (a, b) in enumerate(values)], "i int, a string, b string")
    long = reshape.unpivot_capped(df, ["i"], ["a", "b"], "kind", "n")
    back = {r.i: (r.a, r.b) for r in agg.pivot_counts(long, ["i"], "kind", ["a", "b"]).collect()}
    assert back == {i: (int(a > 0), int(b > 0)) for i, (a, b) in enumerate(values) if a or b}


AT = lambda h, m=0, d=1: datetime(2021, 7, d, h, m)


def test_simple_shift_repair(spark):
    df = spark.createDataFrame([(AT(20), AT(4)), (AT(6), AT(14)), (AT(6), None)], "Start_Time timestamp_ntz, End_Time timestamp_ntz")
    assert rows(shifts.repair_shift_simple(df)) == [(AT(13), AT(21)), (AT(13), None), (AT(3, d=2), AT(11, d=2))]


SHIFT = "id int, Year int, Station string, Workflow_ID string, Shift_Start_Comment string, Start_Time timestamp_ntz, End_Time timestamp_ntz, raw_timestamp timestamp_ntz"


def repaired(spark, *records):
    df = spark.createDataFrame([(i, 2021, "S", *r) for i, r in enumerate(records)], SHIFT)
    return {r.id: (r.Start_Time, r.End_Time) for r in shifts.repair_shift_full(df).collect()}


def test_end_from_comment(spark):
    done = repaired(
        spark,
        ("w", "0600-18", AT(6), None, AT(7)),
        ("w", "0600-24", AT(6), None, AT(7)),
        ("w", "0600-00", AT(6), None, AT(7)),
        ("w", "all day", AT(6), None, AT(7)),
    )
    assert [done[i][1] for i in range(4)] == [AT(18), AT(0, d=2), AT(0, d=2), None]


def test_full_shift_repair(spark):
    done = repaired(
        spark,
        ("fine", None, AT(6), AT(14), AT(8, 20)),
        ("late", None, AT(6), AT(14), AT(8, 20)),
        ("late", None, AT(6), AT(14), AT(15)),
        ("back", None, AT(18), AT(6), AT(8, 20)),
        ("back", None, AT(18), AT(6), AT(15, 5)),
        ("even", None, AT(18), AT(6), AT(8)),
        ("even", None, AT(18), AT(6), AT(15)),
        ("late", None, None, AT(14), AT(9)),
    )
    assert done[0] == (AT(6), AT(14))
    assert done[1] == (AT(8), AT(17))
    assert done[2] == (AT(14), AT(23))
    assert done[3] == done[4] == (AT(8), AT(16))
    assert done[5] == done[6] == (AT(8), AT(15))
    assert 7 not in done


def test_missing_workflow_is_the_inspection_day(spark):
    done = repaired(spark, (None, None, AT(6), AT(14), AT(20)), (None, None, AT(6, d=2), AT(14, d=2), AT(8, d=2)))
    assert done[0] == (AT(19), AT(4, d=2)) and done[1] == (AT(6, d=2), AT(14, d=2))


def test_times_outside_the_shift_move_back(spark):
    df = spark.createDataFrame([(AT(5, 40), AT(6), AT(14)), (AT(20), AT(6), AT(14)), (AT(14, 30), AT(6), AT(14))], "t timestamp_ntz, s timestamp_ntz, e timestamp_ntz")
    assert [r.t for r in shifts.move_back_outside_shift(df, "t", "s", "e").collect()] == [AT(5, 40), AT(12), AT(14, 30)]


def test_full_outer_merge_refuses_what_it_cannot_merge(spark):
    a = spark.createDataFrame([(1, 5), (1, 6)], "k int, v int")
    b = spark.createDataFrame([(1, 7)], "k int, w int")
    with pytest.raises(Exception, match="not unique"):
        joins.full_outer_merge([a, b], ["k"]).collect()
    with pytest.raises(ValueError):
        joins.full_outer_merge([b, b], ["k"])
