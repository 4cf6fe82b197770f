"""The whole inspection plan on raw tables that Spark derives from orders and customers.

Every order becomes one raw inspection record in the shape of its year: text columns,
serial dates, misspelt names, list-based corrections. The SQL states what must come out,
directly from the orders.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldprep.functions import geometry as g
from fieldprep.operators.reshape import literal_rows, union_by_name
from fieldprep.plans.cleaning import clean_inspections, clean_views
from fieldprep.plans.combining import combine_sources, fouled_keys
from fieldprep.plans.fixed_values import FOULED_LIST_ROWS
from fieldprep.plans.options import run_from_options
from fieldprep.plans.polygons import RowFilter, summarise_to_polygons, synthetic_boxes
from fieldprep.plans.reports import inspections_by_source, inspections_by_station, report_tables
from fieldprep.plans.run import Lookups, Sources, store_canonical
from fieldprep.plans.schema_map import YEARLY_SCHEMA
from fieldprep.session import shared_folder, stored
from fieldprep.streaming.inspections import append_inspections
from fieldprep.streaming.yearly import arriving_years, read_years
from fieldprep.sources import readers
from fieldprep.sources.sinks import committed, read_or_build, write_table, write_tables
from fieldprep.workload.registry import ORACLES, query, table
from fieldprep.workload.storage import scratch

STAMP = "yyyy-MM-dd HH:mm:ss"


def _pick(by: str, *values) -> str:
    """SQL for one of the values, by remainder."""
    texts = ", ".join("CAST(NULL AS STRING)" if v is None else f"'{v}'" for v in values)
    return f"get(array({texts}), CAST({by} % {len(values)} AS INT))"


STATIONS = ("CUTTS (hwy 93)", "olsen creek", "Dry gulch", "penticton", "golden", "keremeos hwy 3")
HOMES = ("AB", "Wi", "Unknown", None, "Montana", "Mexico")
TOWNS = ("Vernon", "Langley", "Calgary", "Chemainus,", "Nelson")
GOALS = ("kalamalka lake", "100mile lake", "Dry Storage", "pacific ocean", "wrong lake", "lost lake", None)
DATE = "date_format(day, 'yyyy-MM-dd')"
SERIAL = "CAST(datediff(day, date'1899-12-30') AS STRING)"


def base(spark, d):
    """Order key, inspection year, day and the customer's nation."""
    orders = table(spark, d, "orders").selectExpr(
        "o_orderkey AS k",
        "o_custkey",
        "year(o_orderdate) + 20 AS y",
        "make_date(year(o_orderdate) + 20, month(o_orderdate), day(o_orderdate)) AS day",
    )
    people = table(spark, d, "customer").selectExpr("c_custkey AS o_custkey", "c_nationkey AS n")
    return orders.join(people, "o_custkey").drop("o_custkey")


def _common(y: int) -> dict[str, str]:
    """What all yearly tables say, under the cleaned header of that year, as SQL."""
    known = {name: rules[y].columns for name, rules in YEARLY_SCHEMA.items() if y in rules}
    city = _pick("n", *TOWNS)
    values = {
        "Watercraft_Risk_Assessment_ID": "CAST(k AS STRING)" if y == 2015 else f"concat('{y}-', k)",
        "Station": _pick("n", *STATIONS),
        "Province_Code": _pick("k", *HOMES),
        "Previous_Waterbody_2_Province_Or_State": "CASE WHEN k % 10 = 0 THEN 'AB' END",
        "High_Risk_AIS_Ind": _pick("k", "yes", "no", None),
        "Number_Of_People_In_Party": _pick("k", "2.34", "x", None, "5"),
        "Destination_Waterbody_1_Name": _pick("k", *GOALS, "Other"),
        "Destination_Waterbody_1_Closest_City": f"concat({city}, ' BC')" if y == 2015 else city,
        "Destination_Waterbody_1_Province_Or_State": _pick("n", "British Columbia", "Alberta", None),
    }
    if y == 2015:
        # The province is part of the city there; the city column must win.
        del values["Destination_Waterbody_1_Province_Or_State"]
    if y <= 2018:
        values["WatercraftType"] = _pick("k", "Kayak, Ski boat", "Kayak,Kayak,Kayak,Kayak", None, "Zeppelin", "Other")
    out = {known[name][0]: value for name, value in values.items() if name in known}
    if y >= 2016:
        out[known["Destination_Waterbody_1_Name"][1]] = "'okanagan lake, BC'"
    if y <= 2018:
        out[known["WatercraftType"][1]] = "'Canoe'"
    return out


def raw_year(rows, y: int):
    """All records of one year in that year's raw shape, every column text."""
    out = _common(y)
    if y <= 2016:
        taken = "Time of High Risk Inspection" if y == 2015 else "Date + Time of High Risk Inspection"
        # Some records of 2016 were stamped with a wrong year.
        short, seen = f"concat({DATE}, ' 9:05')", f"concat({DATE}, ' 10:15:00')"
        if y == 2016:
            short = f"CASE WHEN k % 7 = 0 THEN concat('2014', substr({short}, 5)) ELSE {short} END"
            seen = f"CASE WHEN k % 5 = 0 THEN concat('2099', substr({seen}, 5)) ELSE {seen} END"
        out[taken] = f"CASE WHEN k % 3 = 1 THEN concat({SERIAL}, '.375') WHEN k % 3 = 2 THEN {short} END"
        out["Timestamp of inspection"] = f"CASE WHEN k % 2 = 1 THEN {seen} END"
        out["Shift Start Time"] = f"concat({DATE}, ' 06:00:00')"
        out["Shift End Time"] = f"concat({DATE}, ' 18:00:00')"
        if y == 2015:
            out["Reason_for_High_Risk_Inspection2"] = "CASE WHEN k % 11 = 0 THEN 'Dreissenid Mussels Found' ELSE 'Standing Water' END"
    else:
        late, day = ("00:20:00", "11:30:00") if y == 2017 else ("0.0104166667", "0.375")
        time = f"CASE WHEN k % 4 = 1 THEN '{late}' WHEN k % 4 <> 0 THEN '{day}' END"
        out["Time of inspection" if y == 2017 else "Time of Inspection"] = time
        out["Timestamp"] = f"CASE WHEN k % 5 <> 0 THEN concat({SERIAL}, '.5') END"
        out["Shift Start Time"] = f"concat({SERIAL}, '.25')"
        out["Shift End Time"] = f"concat({SERIAL}, '.75')"
    out["Shift Date"] = SERIAL
    if y == 2019:
        out["Single_watercraft_type"] = _pick(
            "k", "Non-motorized / hand launched watercraft", "Simple watercraft", "Complex watercraft", "Very complex watercraft"
        )
        out["Number_watercraft"] = _pick("k", "1", "2", "0")
    made = {"TimeOfInspection", "shift_start", "Shift_Start_Time", "Shift_End_Time", "Shift_Date"}
    needed = {c for rules in YEARLY_SCHEMA.values() if y in rules for c in rules[y].columns}
    out |= {h: "CAST(NULL AS STRING)" for h in sorted(needed - set(out) - made)}
    # Some headers in their raw spelling: the cleaning step has to find them.
    spelling = {"Station_Name": "Station Name", "Inspection_ID": "Inspection ID#"}
    if y == 2016:
        spelling["State_Province_of_Destination_Waterbody"] = "Destination Province/State"
    return rows.filter(f"y = {y}").selectExpr(*[f"{sql} AS `{spelling.get(h, h)}`" for h, sql in out.items()])


def raw_extracts(rows):
    """The records of 2020 and later: canonical headers with blanks, two generations of time columns."""
    at = lambda late, early: f"concat({DATE}, 'T', CASE WHEN k % 2 = 1 THEN '{late}' ELSE '{early}' END)"
    columns = {
        "Watercraft Risk Assessment ID": "CAST(k AS STRING)",
        "Station": _pick("n", *STATIONS),
        "Start Time": at("15:00:00", "20:00:00"),
        "End Time": at("23:00:00", "04:00:00"),
        "raw_timestamp": at("17:00:00", "21:10:00"),
        "Inspection Time": f"CASE WHEN k % 2 = 1 THEN concat({DATE}, ' 10:00:00') WHEN k % 4 = 0 THEN '14:05' END",
        "Workflow ID": "CASE WHEN k % 3 <> 0 THEN concat('w', k % 50) END",
        "Shift Start Comment": "'0600-18'",
        "Province Code": _pick("k", *HOMES),
        "Previous Waterbody 1 Province Or State": f"CASE WHEN k % 6 < 3 THEN {_pick('k', *HOMES[:3])} END",
        "Previous Waterbody 2 Province Or State": "CASE WHEN k % 10 = 0 THEN 'AB' END",
        "Previous Waterbody 3 Province Or State": "CAST(NULL AS STRING)",
        "Previous Major City": _pick("k", "Spokane, Washington, USA", "None", None, "Montana"),
        "High Risk AIS Ind": _pick("k", "TRUE", "false", None),
        "Number Of People In Party": _pick("k", "2.34", "x", None, "5"),
        "Destination Waterbody 1 Name": _pick("k", *GOALS, "okanagan lake, BC"),
        "Destination Waterbody 1 Closest City": _pick("n", *TOWNS),
        "Destination Waterbody 1 Province Or State": _pick("n", "BC", "AB", None),
        "Destination Waterbody 2 Name": "CASE WHEN k % 5 = 0 THEN 'right lake' END",
        "Destination Waterbody 2 Closest City": "CASE WHEN k % 5 = 0 THEN 'Nelson' END",
        "Destination Major City": "CASE WHEN k % 3 = 0 THEN 'Kelowna, British Columbia, CAN' END",
        "Destination Dry Storage Ind": "CASE WHEN k % 8 = 2 THEN 'true' ELSE 'false' END",
        "Unknown Destination Waterbody Ind": "CASE WHEN k % 8 = 6 THEN 'TRUE' ELSE 'FALSE' END",
        "Clean Drain Dry After Inspection Ind": "CASE WHEN k % 7 = 0 THEN 'true' ELSE 'false' END",
        "Commercially Hauled Ind": "CASE WHEN k % 9 = 0 THEN 'true' ELSE 'false' END",
        "Non Motorized Counter": _pick("k", "1", "0"),
        "Simple Counter": _pick("k", "0", "2", "0"),
        "Complex Counter": "'0'",
        "Very Complex Counter": "'0'",
    }
    return rows.filter("y >= 2020").selectExpr("y AS Year", *[f"{sql} AS `{h}`" for h, sql in columns.items()])


def _recent_lists(late):
    """The lists of 2020 and of 2023."""
    listed = late.filter("k % 17 = 0").selectExpr("CAST(k AS STRING) AS `Watercraft Risk Assessment ID`")
    # The list of 2020 counts up to its sixteenth row only; here a row's number is its key.
    return late.selectExpr("k AS position", "CAST(k AS STRING) AS watercraftRiskAssessmentID"), listed


def sources(spark, d, rows=None) -> Sources:
    # Stored: six raw tables are made of it.
    rows = stored(base(spark, d)) if rows is None else rows
    years = {y: raw_year(rows, y) for y in (2015, 2016, 2017, 2018, 2019)}
    keys = table(spark, d, "orders").selectExpr("o_orderkey AS k", "year(o_orderdate) + 20 AS y")
    by_year = {
        y: keys.filter(f"y = {y} AND k % 13 = 0").selectExpr("CAST(k AS STRING) AS `Inspection ID`") for y in years if y >= 2016
    }
    late = keys.filter("y >= 2020")
    first, listed = _recent_lists(late)
    return Sources(years, raw_extracts(rows), by_year, fouled_keys({2020: first, 2023: listed}, FOULED_LIST_ROWS))


def lookups(spark) -> Lookups:
    rows = lambda schema, values: literal_rows(spark, schema, values)
    kinds = rows(
        "kind string, class string",
        [("kayak kind", "Non-motorized"), ("ski boat kind", "Complex"), ("canoe kind", "Simple"), ("unused", "Very complex")],
    )
    return Lookups(
        corrections=rows(
            "Non_Matching_Name string, Corrected_Name string",
            [("Wrong Lake", "Right Lake"), ("Lost Lake", "No Match"), ("Never Seen", "Right Lake")],
        ),
        craft_types=rows(
            "WatercraftType string, BoatType string",
            [("Kayak", "kayak kind"), (" Ski boat", "ski boat kind"), ("Canoe", "canoe kind")],
        ),
        craft_categories=kinds.withColumnsRenamed({"kind": "watercraft type", "class": "New Category"}),
        abbreviations=rows("Province_or_State string, Abbrev string", [("Montana", "MT"), ("Washington", "WA")]),
        gazetteer=rows(
            "names string, lon double, lat double",
            [("Vernon", -119.25, 50.25), ("Langley", -122.5, 49.0), ("Calgary", -114.0, 51.0), ("Nelson", -117.25, 49.5), ("Kelowna", -119.5, 49.875)],
        ),
    )


def _clean(spark, d):
    made, known = sources(spark, d), lookups(spark)
    combined = combine_sources(made.years, made.extracts, made.fouled_by_year, made.fouled_recent)
    combined = store_canonical(combined, scratch(spark))
    return clean_inspections(combined, known.corrections, known.craft_types, known.craft_categories, known.abbreviations)


def _stored(spark, d):
    """The cleaned tables as later stages meet them: stored once per application, partitioned by year."""
    tables = hashlib.sha1(str(d).encode()).hexdigest()[:12]
    path = f"{shared_folder(spark).rstrip('/')}/clean-{spark.sparkContext.applicationId}-{tables}"
    return clean_views(read_or_build(spark, path, lambda: _clean(spark, d).everything, partition_by=["Year"]))


# What must come out, stated on the orders themselves.
CLEAN_SQL = """
    b AS (SELECT o_orderkey AS k, year(o_orderdate) + 20 AS y,
                 make_date(year(o_orderdate) + 20, month(o_orderdate), day(o_orderdate)) AS day, c_nationkey AS n
          FROM orders JOIN customer ON o_custkey = c_custkey),
    t AS (SELECT *, y >= 2020 AND k % 2 = 1 AS fresh, y >= 2020 AS late,
                 CASE WHEN y IN (2015, 2016) THEN CASE
                          WHEN k % 3 = 1 THEN INTERVAL 540 MINUTE WHEN k % 3 = 2 THEN INTERVAL 545 MINUTE
                          WHEN k % 2 = 0 OR (y = 2016 AND k % 5 = 0) THEN INTERVAL 360 MINUTE ELSE INTERVAL 615 MINUTE END
                      WHEN y IN (2017, 2018, 2019) THEN CASE
                          WHEN k % 4 = 0 THEN CASE WHEN k % 5 = 0 THEN INTERVAL 360 MINUTE ELSE INTERVAL 720 MINUTE END
                          WHEN k % 4 = 1 THEN CASE WHEN y = 2017 THEN INTERVAL 1460 MINUTE ELSE INTERVAL 1455 MINUTE END
                          WHEN y = 2017 THEN INTERVAL 690 MINUTE ELSE INTERVAL 540 MINUTE END
                      WHEN k % 2 = 1 THEN INTERVAL 600 MINUTE ELSE INTERVAL 1270 MINUTE END AS taken
          FROM b
          WHERE NOT (y = 2016 AND k % 3 = 2 AND k % 7 = 0) AND NOT (y <= 2018 AND k % 5 = 3)),
    v AS (SELECT k, y, n, late,
                 CASE WHEN y BETWEEN 2016 AND 2019 THEN y || '-' || k ELSE CAST(k AS VARCHAR) END AS id,
                 (['Cutts (Hwy 93)', 'Olsen', 'Dry Gulch', 'Penticton Roving', 'Golden', 'Keremeos'])[CAST(n % 6 AS INTEGER) + 1] AS station,
                 CASE WHEN fresh THEN ((day + INTERVAL 15 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles'
                      WHEN late THEN day + INTERVAL 27 HOUR ELSE day + INTERVAL 6 HOUR END AS s,
                 CASE WHEN fresh THEN ((day + INTERVAL 23 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles'
                      WHEN late THEN day + INTERVAL 35 HOUR ELSE day + INTERVAL 18 HOUR END AS e,
                 ((day + taken) AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' AS taken_utc,
                 CASE WHEN y = 2015 THEN k % 11 = 0 WHEN late THEN k % 17 = 0 OR k <= 16 ELSE k % 13 = 0 END AS fouled,
                 k % 3 = 0 AS high_risk,
                 (['Kalamalka Lake', '100 Mile Lake', 'Dry Storage', 'Pacific Ocean', 'Right Lake', 'No Match', NULL,
                   CASE WHEN y = 2015 THEN 'Other' ELSE 'Okanagan Lake' END])[CAST(k % 8 AS INTEGER) + 1] AS corrected,
                 (['Vernon', 'Langley', 'Calgary', 'Chemainus,', 'Nelson'])[CAST(n % 5 AS INTEGER) + 1] AS town,
                 CASE WHEN y = 2015 THEN 'BC' ELSE (['BC', 'AB', NULL])[CAST(n % 3 AS INTEGER) + 1] END AS told,
                 (['AB', 'Wi', 'Unknown', NULL, 'Montana', 'Mexico'])[CAST(k % 6 AS INTEGER) + 1] AS home,
                 CASE WHEN late THEN (['Spokane, Washington, USA', 'None', NULL, 'Montana'])[CAST(k % 4 AS INTEGER) + 1] END AS major
          FROM t),
    w AS (SELECT *, CASE WHEN y = 2015 THEN town || ' ' ELSE town END AS city,
                 CASE WHEN late AND k % 6 >= 3 THEN NULL ELSE home END AS place FROM v),
    x AS (SELECT *, CASE WHEN city IN ('Langley', 'Chemainus,') THEN 'Pacific Ocean' ELSE corrected END AS dest,
                 CASE WHEN corrected = 'Right Lake' OR city IN ('Vernon', 'Langley', 'Chemainus,') THEN 'BC' ELSE told END AS province,
                 CASE WHEN place IS NOT NULL AND place <> 'Unknown' THEN place
                      WHEN major IS NOT NULL AND major <> 'None' THEN CASE WHEN major LIKE 'Spokane%' THEN 'Washington' ELSE major END
                      ELSE home END AS source_raw
          FROM w),
    clean AS (SELECT *,
                 coalesce(province <> 'BC' OR dest = 'No Match', false) AS not_bc,
                 coalesce(dest = 'Dry Storage' OR k % 8 = 2, false) AS storage,
                 coalesce(dest LIKE '%Ocean%', false) AS ocean,
                 home IS NULL AND place IS NULL AND (y = 2015 OR k % 10 <> 0) AS unknown_source,
                 CASE source_raw WHEN 'Montana' THEN 'MT' WHEN 'Washington' THEN 'WA' WHEN 'Wi' THEN 'WI' WHEN 'Mexico' THEN 'BN' ELSE source_raw END AS abbr,
                 CASE k % 4 WHEN 0 THEN 2 WHEN 3 THEN 5 END AS people,
                 CAST(CASE WHEN y <= 2018 THEN CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 0 END
                      WHEN y = 2019 THEN CASE WHEN k % 4 = 0 THEN (k + 1) % 3 ELSE 0 END ELSE (k + 1) % 2 END AS DOUBLE) AS non_motorized,
                 CAST(CASE WHEN y <= 2018 THEN CASE WHEN k % 5 = 4 THEN 1 ELSE 0 END
                      WHEN y = 2019 THEN CASE WHEN k % 4 = 1 THEN (k + 1) % 3 ELSE 0 END ELSE CASE WHEN k % 3 = 1 THEN 2 ELSE 0 END END AS DOUBLE) AS simple,
                 CAST(CASE WHEN y <= 2018 THEN CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END
                      WHEN y = 2019 THEN CASE WHEN k % 4 = 2 THEN (k + 1) % 3 ELSE 0 END ELSE 0 END AS DOUBLE) AS complex,
                 CAST(CASE WHEN y = 2019 AND k % 4 = 3 THEN (k + 1) % 3 ELSE 0 END AS DOUBLE) AS very_complex
          FROM x)
"""


@query(
    f"""
    WITH {CLEAN_SQL}
    SELECT y AS year, id, station, strftime(s, '%Y-%m-%d %H:%M:%S') AS s, strftime(e, '%Y-%m-%d %H:%M:%S') AS e,
           strftime(taken_utc, '%Y-%m-%d %H:%M:%S') AS taken_utc, fouled, high_risk, dest, city, province, not_bc, storage, ocean,
           unknown_source, abbr, people, non_motorized, simple, complex, very_complex
    FROM clean
    """
)
def combine_and_clean(spark, d):
    """Seven years in six shapes to one cleaned table."""
    return _clean_columns(_clean(spark, d).everything)


def _clean_columns(df):
    return df.select(
        F.col("Year").cast("bigint").alias("year"),
        F.col("Watercraft_Risk_Assessment_ID").alias("id"),
        F.col("Station").alias("station"),
        F.date_format("Start_Time", STAMP).alias("s"),
        F.date_format("End_Time", STAMP).alias("e"),
        F.date_format(_utc("TimeOfInspection"), STAMP).alias("taken_utc"),
        F.col("MusselsFound_Ind").alias("fouled"),
        F.col("High_Risk_AIS_Ind").alias("high_risk"),
        F.col("Destination_Waterbody_1_Name").alias("dest"),
        F.col("Destination_Waterbody_1_Closest_City").alias("city"),
        F.col("Destination_Waterbody_1_Province_Or_State").alias("province"),
        F.col("DestNotBC").alias("not_bc"),
        F.col("DryStorage").alias("storage"),
        F.col("OceanBoat").alias("ocean"),
        F.col("UnknownSourceBoat").alias("unknown_source"),
        F.col("Previous_Waterbody_1_Province_Or_State").alias("abbr"),
        F.col("Number_Of_People_In_Party").alias("people"),
        F.col("Non_Motorized_Counter").alias("non_motorized"),
        F.col("Simple_Counter").alias("simple"),
        F.col("Complex_Counter").alias("complex"),
        F.col("Very_Complex_Counter").alias("very_complex"),
    )


@query(ORACLES["combine_and_clean"].rstrip() + " WHERE late")
def stream_inspections(spark, d):
    """The extracts arriving in several files a year, cleaned and appended batch by batch, then all replayed."""
    folder, known = scratch(spark), lookups(spark)
    rows = base(spark, d)
    raw = raw_extracts(rows)
    # A file per year and task; no year passes through one task.
    raw.repartition(4).write.partitionBy("Year").parquet(f"{folder}/arrived")
    fouled = sources(spark, d, rows).fouled_recent
    for replay, files in (("first", 12), ("again", 12)):
        append_inspections(
            spark, f"{folder}/arrived", raw.schema, fouled, known, f"{folder}/table", f"{folder}/checkpoint-{replay}", "parquet", files_per_batch=files
        ).awaitTermination()
    return _clean_columns(spark.read.parquet(f"{folder}/table"))


@query(ORACLES["combine_and_clean"].rstrip() + " WHERE NOT late")
def stream_years(spark, d):
    """The yearly tables arriving out of order, published year by year and read as one table."""
    folder, made = scratch(spark), sources(spark, d)
    for year, raw in made.years.items():
        raw.write.parquet(f"{folder}/raw/{year}")
    for years in ((2018, 2015), (2019, 2017), (2016,)):
        notes = spark.createDataFrame([(y, f"{folder}/raw/{y}") for y in years], "year int, path string")
        notes.coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/arrivals")
    read = lambda year, path: spark.read.parquet(path)
    arriving_years(spark, f"{folder}/arrivals", read, made.fouled_by_year, lookups(spark), f"{folder}/years", f"{folder}/checkpoint", 2).awaitTermination()
    return _clean_columns(read_years(spark, f"{folder}/years"))


def _utc(column: str) -> Column:
    from fieldprep.functions.clock import utc_clock

    return utc_clock(F.col(column))


def states(spark, d):
    """A square per nation, coded as a region; two codes of them occur as sources."""
    k = F.col("n_nationkey")
    code = F.when(k == 3, "CA.AB").when(k == 4, "US.MT").when(k == 5, "MX.BN").when(k == 6, "US.WA").otherwise(
        F.concat(F.lit("US.X"), k.cast("string"))
    )
    country = F.when(k == 5, "Mexico").when(k == 3, "Canada").otherwise("United States")
    x, y = k * 2.0 - 140, F.lit(45.0)
    return table(spark, d, "nation").select(
        country.alias("NAME_0"), F.col("n_name").alias("NAME_1"), code.alias("HASC_1"), g.box(x, y, x + 2, y + 1).alias("rings")
    )


@query(
    f"""
    WITH {CLEAN_SQL},
    c AS (SELECT abbr, count(*) AS total, nullif(count(*) FILTER (WHERE high_risk AND k % 7 <> 0), 0) AS hr,
                 nullif(count(*) FILTER (WHERE fouled), 0) AS mf, nullif(count(*) FILTER (WHERE k % 9 = 0), 0) AS ch
          FROM clean WHERE y = 2020 GROUP BY abbr)
    SELECT n_name AS name, total, hr, mf, ch, n_nationkey * 2.0 - 139 AS x, 45.5 AS y
    FROM nation LEFT JOIN c ON abbr = CASE n_nationkey WHEN 3 THEN 'AB' WHEN 4 THEN 'MT' WHEN 5 THEN 'BN' WHEN 6 THEN 'WA' ELSE 'X' || n_nationkey END
    """
)
def report_by_source(spark, d):
    """A report year's inspections per source region, at the region's centroid."""
    df = _stored(spark, d).selected
    done = inspections_by_source(df, states(spark, d), 2020)
    return done.select(
        F.col("NAME_1").alias("name"),
        F.col("TotalInsp").alias("total"),
        F.col("HRInsp").alias("hr"),
        F.col("MFInsp").alias("mf"),
        F.col("CHInsp").alias("ch"),
        F.round("x", 6).alias("x"),
        F.round("y", 6).alias("y"),
    )


def stations(spark, d):
    """A station per supplier, most of them without records."""
    k = F.col("s_suppkey")
    label = F.when(k < 6, F.expr(_pick("s_suppkey", "Cutts (Hwy 93)", "Olsen", "Dry Gulch", "Penticton Roving", "Golden", "Nowhere"))).otherwise(
        F.concat(F.lit("Station "), k.cast("string"))
    )
    return table(spark, d, "supplier").select(label.alias("map_label"), (k * 1.0 - 120).alias("x"), F.lit(50.0).alias("y"))


@query(
    f"""
    WITH {CLEAN_SQL},
    g AS (SELECT station, y, count(*) AS total, count(*) FILTER (WHERE fouled) AS mf, count(*) FILTER (WHERE high_risk) AS hr,
                 nullif(count(DISTINCT home) FILTER (WHERE home <> 'Unknown'), 0) AS provs FROM clean GROUP BY ALL),
    s AS (SELECT CASE WHEN s_suppkey < 6 THEN (['Cutts (Hwy 93)', 'Olsen', 'Dry Gulch', 'Penticton Roving', 'Golden', 'Nowhere'])[CAST(s_suppkey AS INTEGER) + 1]
                      ELSE 'Station ' || s_suppkey END AS station FROM supplier)
    SELECT y AS year, station, coalesce(total, 0) AS total, coalesce(mf, 0) AS mf, coalesce(hr, 0) AS hr, provs
    FROM s LEFT JOIN g USING (station) WHERE station <> 'Penticton Roving'
    """
)
def report_by_station(spark, d):
    return _station_columns(inspections_by_station(_stored(spark, d).selected, stations(spark, d)))


def _station_columns(done):
    return done.select(
        F.col("Year").cast("bigint").alias("year"),
        F.col("Station").alias("station"),
        F.col("TotalInspections").alias("total"),
        F.col("MusselFouled").alias("mf"),
        F.col("HighRisk").alias("hr"),
        F.col("number_of_provs").alias("provs"),
    )


def regions(spark, d):
    """Two squares on the provincial grid around two of the cities, and far squares from the suppliers."""
    k = F.col("s_suppkey")
    x, y = F.lit(5_000_000.0) + (k % 1000) * 1000, F.floor(k / 1000) * 1000.0
    far = table(spark, d, "supplier").select(
        F.lit("far").alias("REGION_G"), F.concat(F.lit("Far "), k.cast("string")).alias("REGION_N"), g.box(x, y, x + 500, y + 500).alias("rings")
    )
    near = literal_rows(spark, "REGION_G string, REGION_N string, lon double, lat double", [("8", "Okanagan", -119.5, 49.875), ("4", "Kootenay", -117.25, 49.5)])
    px, py = g.PROVINCIAL_GRID.forward(F.col("lon"), F.col("lat"))
    near = near.withColumns({"px": px, "py": py})
    boxes = near.select(
        "REGION_G", "REGION_N", g.box(F.col("px") - 5000, F.col("py") - 5000, F.col("px") + 5000, F.col("py") + 5000).alias("rings")
    )
    return far.unionByName(boxes)


@query(
    f"""
    WITH {CLEAN_SQL},
    m AS (SELECT *, CASE WHEN late AND k % 3 = 0 THEN 'Kelowna' END AS big FROM clean),
    r AS (SELECT *, regexp_replace(city, ',.*', '') AS city_name FROM m),
    q AS (SELECT city_name, CASE city_name WHEN 'Nelson' THEN 'Kootenay' END AS region FROM r
          WHERE dest IS NULL AND big IS NOT NULL AND city_name = 'Nelson' GROUP BY ALL),
    z AS (SELECT r.*, q.region FROM r LEFT JOIN q USING (city_name)),
    o AS (SELECT y, k, 'year' AS part,
                 coalesce(dest, region, CASE WHEN not_bc OR storage THEN 'Outside BC' WHEN k % 8 = 6 THEN 'Unknown (Toggle)' ELSE 'Unknown' END) AS dest_region,
                 CASE WHEN non_motorized + simple + complex + very_complex = 0 THEN 1 ELSE non_motorized + simple + complex + very_complex END AS boats,
                 abs(epoch(e) - epoch(s)) / 3600 AS hours FROM z WHERE y = 2020
          UNION ALL
          SELECT y, k, 'high risk', coalesce(dest, region, CASE WHEN not_bc OR storage THEN 'Outside BC' ELSE 'Unknown' END),
                 CASE WHEN non_motorized + simple + complex + very_complex = 0 THEN 1 ELSE non_motorized + simple + complex + very_complex END,
                 abs(epoch(e) - epoch(s)) / 3600 FROM z WHERE high_risk AND (y < 2020 OR k % 7 <> 0)
          UNION ALL
          SELECT y, k, 'fouled', coalesce(dest, region, CASE WHEN not_bc OR storage THEN 'Outside BC' ELSE 'Unknown' END),
                 CASE WHEN non_motorized + simple + complex + very_complex = 0 THEN 1 ELSE non_motorized + simple + complex + very_complex END,
                 abs(epoch(e) - epoch(s)) / 3600 FROM z WHERE fouled)
    SELECT part, y AS year, dest_region, count(*) AS n, CAST(sum(boats) AS DOUBLE) AS boats, round(sum(hours), 3) AS hours FROM o GROUP BY ALL
    """
)
def report_destination_regions(spark, d):
    """The three report tables, counted per year and destination region."""
    df = _stored(spark, d).selected
    made = report_tables(df, states(spark, d), stations(spark, d), regions(spark, d), lookups(spark).gazetteer, 2020)
    parts = {"year": made.this_year, "high risk": made.high_risk, "fouled": made.fouled}
    columns = ["Year", "DestRegion", "TotalBoats", "Shift_hours"]
    rows = union_by_name([t.select(F.lit(p).alias("part"), *columns) for p, t in parts.items()])
    return rows.groupBy("part", F.col("Year").cast("bigint").alias("year"), F.col("DestRegion").alias("dest_region")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("TotalBoats").alias("boats"), F.round(F.sum("Shift_hours"), 3).alias("hours")
    )


def waterbodies(spark, d):
    """Lakes around the cities, one per supplier, three names in turn, and the two made-up boxes."""
    k = F.col("s_suppkey")
    towns = lookups(spark).gazetteer
    px, py = g.PROVINCIAL_GRID.forward(F.col("lon"), F.col("lat"))
    slots = towns.select("names", px.alias("px"), py.alias("py"))
    town = F.expr(_pick("s_suppkey", "Vernon", "Calgary", "Nelson", "Kelowna"))
    lakes = table(spark, d, "supplier").select(
        (k % 40).alias("WATERSH"),
        F.expr(_pick("s_suppkey", "Kalamalka Lake", "Right Lake", "Okanagan Lake")).alias("GNIS_NA"),
        town.alias("names"),
        (F.floor(k / 12) * 3000.0 + 1000).alias("away"),
    )
    x, y = F.col("px") + F.col("away"), F.col("py") + F.col("away")
    shaped = lakes.join(slots, "names").select("WATERSH", "GNIS_NA", g.box(x, y, x + 500, y + 500).alias("rings"))
    return shaped.unionByName(synthetic_boxes(shaped))


# Reference distances on boxes: brute force over all lakes of the name.
_POLYGON_SQL = """
    k0 AS (SELECT 6378137.0::DOUBLE AS a, 1 / 298.257222101::DOUBLE AS f), k1 AS (SELECT a, sqrt(f * (2 - f)) AS ec FROM k0),
    k2 AS (SELECT a, ec, 1 - ec * ec AS g, cos(radians(50)) ** 2 / (1 - (ec * sin(radians(50))) ** 2) AS m1,
                  cos(radians(58.5)) ** 2 / (1 - (ec * sin(radians(58.5))) ** 2) AS m2,
                  (1 - ec * ec) * (sin(radians(45)) / (1 - (ec * sin(radians(45))) ** 2) - ln((1 - ec * sin(radians(45))) / (1 + ec * sin(radians(45)))) / (2 * ec)) AS q0,
                  (1 - ec * ec) * (sin(radians(50)) / (1 - (ec * sin(radians(50))) ** 2) - ln((1 - ec * sin(radians(50))) / (1 + ec * sin(radians(50)))) / (2 * ec)) AS q1,
                  (1 - ec * ec) * (sin(radians(58.5)) / (1 - (ec * sin(radians(58.5))) ** 2) - ln((1 - ec * sin(radians(58.5))) / (1 + ec * sin(radians(58.5)))) / (2 * ec)) AS q2 FROM k1),
    k3 AS (SELECT *, (m1 - m2) / (q2 - q1) AS nn FROM k2),
    k4 AS (SELECT *, m1 + nn * q1 AS cc, a * sqrt(m1 + nn * q1 - nn * q0) / nn AS r0 FROM k3),
    towns(names, lon, lat) AS (VALUES ('Vernon', -119.25, 50.25), ('Langley', -122.5, 49.0), ('Calgary', -114.0, 51.0),
                                      ('Nelson', -117.25, 49.5), ('Kelowna', -119.5, 49.875), ('ocean1', -130.805, 48.767), ('ocean2', -129.090, 48.767),
                                      ('ocean3', -129.090, 49.9512), ('ocean4', -130.805, 49.9512)),
    tp AS (SELECT names, 1000000 + r * sin(th) AS px, r0 - r * cos(th) AS py FROM (
             SELECT names, r0, a * sqrt(cc - nn * g * (sin(radians(lat)) / (1 - (ec * sin(radians(lat))) ** 2)
                    - ln((1 - ec * sin(radians(lat))) / (1 + ec * sin(radians(lat)))) / (2 * ec))) / nn AS r, nn * radians(lon + 126) AS th FROM towns, k4)),
    lakes AS (SELECT s_suppkey % 40 AS watersh, (['Kalamalka Lake', 'Right Lake', 'Okanagan Lake'])[CAST(s_suppkey % 3 AS INTEGER) + 1] AS name,
                     px + (s_suppkey // 12) * 3000.0 + 1000 AS x0, py + (s_suppkey // 12) * 3000.0 + 1000 AS y0
              FROM supplier JOIN tp ON names = (['Vernon', 'Calgary', 'Nelson', 'Kelowna'])[CAST(s_suppkey % 4 AS INTEGER) + 1]),
    slots AS (SELECT y, k, high_risk AND (y < 2020 OR k % 7 <> 0) AS hr, fouled AS mf, non_motorized, simple, complex, very_complex, dest AS name, city FROM clean
              UNION ALL SELECT y, k, high_risk AND (y < 2020 OR k % 7 <> 0), fouled, non_motorized, simple, complex, very_complex, 'Right Lake', 'Nelson'
              FROM clean WHERE late AND k % 5 = 0),
    near AS (SELECT DISTINCT name, city, px, py FROM slots JOIN tp ON city = names WHERE name IS NOT NULL),
    dist AS (SELECT n.name, city, watersh, sqrt(greatest(x0 - px, 0, px - x0 - 500) ** 2 + greatest(y0 - py, 0, py - y0 - 500) ** 2) AS far
             FROM near n JOIN lakes l ON n.name = l.name),
    best AS (SELECT name, city, watersh, row_number() OVER (PARTITION BY name, city ORDER BY round(far, 6), watersh) AS place FROM dist),
    goal AS (SELECT name, city, watersh FROM best WHERE place = 1
             UNION ALL SELECT name, city, 0 FROM near WHERE name IN ('Pacific Ocean', 'Dry Storage'))
"""
_POLYGON_COUNTS = """
    SELECT watersh, name, count(*) AS total, count(*) FILTER (WHERE mf) AS fouled, count(*) FILTER (WHERE hr) AS high_risk,
           sum(non_motorized) AS non_motorized, sum(simple) AS simple,
           count(*) FILTER (WHERE NOT hr AND NOT mf AND simple > 0) AS low_simple,
           count(*) FILTER (WHERE hr AND non_motorized > 0) AS hr_nonmot,
           count(*) FILTER (WHERE hr AND simple > 0) + count(*) FILTER (WHERE hr AND complex > 0) + count(*) FILTER (WHERE hr AND very_complex > 0) AS hr_mot
    FROM slots JOIN goal USING (name, city)
"""


def _polygon_columns(df):
    return df.select(
        F.col("WATERSH").cast("bigint").alias("watersh"),
        F.col("GNIS_NA").alias("name"),
        F.col("TotalInspections").alias("total"),
        F.col("NumberMusselFouled").alias("fouled"),
        F.col("highrisk_Counter").alias("high_risk"),
        F.col("Non_Motorized_Counter").alias("non_motorized"),
        F.col("Simple_Counter").alias("simple"),
        F.col("LowRisk_Simple_Counter").alias("low_simple"),
        F.col("HR_nonmot").alias("hr_nonmot"),
        F.col("HR_mot").alias("hr_mot"),
    )


def _polygons(spark, d, year=None, rows=None):
    from fieldprep.plans.reports import strict_high_risk

    clean = _stored(spark, d)
    high_risk = strict_high_risk(clean.everything)
    return summarise_to_polygons(
        clean.everything, waterbodies(spark, d), lookups(spark).gazetteer, high_risk, clean.fouled, year, rows
    )


@query(f"WITH {CLEAN_SQL}, {_POLYGON_SQL} {_POLYGON_COUNTS} GROUP BY ALL")
def polygon_summary_all_years(spark, d):
    """Inspections per waterbody: the nearest of the name to the city that was given."""
    return _polygon_columns(_polygons(spark, d))


@query(f"WITH {CLEAN_SQL}, {_POLYGON_SQL} {_POLYGON_COUNTS} WHERE y = 2020 GROUP BY ALL")
def polygon_summary_report_year(spark, d):
    return _polygon_columns(_polygons(spark, d, year=2020))


@query(
    f"""
    WITH {CLEAN_SQL}
    SELECT 'AllYears_All_Columns' AS stored, count(*) AS n FROM clean
    UNION ALL SELECT 'AllYears_Selected_Columns', count(*) FROM clean
    UNION ALL SELECT 'AllYears_high_risk', count(*) FROM clean WHERE high_risk
    UNION ALL SELECT 'AllYears_mussel_fouled', count(*) FROM clean WHERE fouled
    UNION ALL SELECT 'figure_dat', count(*) FROM clean WHERE y = 2020
    UNION ALL SELECT 'figure_dat_all', count(*) FROM clean
    UNION ALL SELECT 'figure_dat_hr', count(*) FROM clean WHERE high_risk AND (y < 2020 OR k % 7 <> 0)
    UNION ALL SELECT 'figure_dat_mf', count(*) FROM clean WHERE fouled
    """
)
def run_everything(spark, d):
    """All three stages with stored tables between them; how many rows each stored table holds."""
    folder = _run(spark, d)
    names = [
        "AllYears_All_Columns",
        "AllYears_Selected_Columns",
        "AllYears_high_risk",
        "AllYears_mussel_fouled",
        "figure_dat",
        "figure_dat_all",
        "figure_dat_hr",
        "figure_dat_mf",
    ]
    counts = [
        spark.read.parquet(f"{folder}/{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("stored"), "n")
        for n in names
    ]
    return union_by_name(counts)


def _options(spark, d) -> str:
    """The options of a whole run, all its inputs stored below one folder; made once per application."""
    tables = hashlib.sha1(str(d).encode()).hexdigest()[:12]
    base = f"{shared_folder(spark).rstrip('/')}/run-{spark.sparkContext.applicationId}-{tables}"
    if not committed(spark, f"{base}/options"):
        made, known = sources(spark, d), lookups(spark)
        late = table(spark, d, "orders").selectExpr("o_orderkey AS k", "year(o_orderdate) + 20 AS y").filter("y >= 2020")
        first, listed = _recent_lists(late)
        write_tables({str(y): raw for y, raw in made.years.items()} | {"extracts": made.extracts}, f"{base}/raw")
        write_tables({str(y): df for y, df in made.fouled_by_year.items()} | {"2020": first, "2023": listed}, f"{base}/kept/fouled")
        write_tables(vars(known), f"{base}/kept")
        lakes = waterbodies(spark, d).filter(~F.col("GNIS_NA").isin("Pacific Ocean", "Dry Storage"))
        waters = {name: lakes.filter(F.col("WATERSH") % 3 == n) for n, name in enumerate(("lakes", "rivers", "manmade"))}
        write_tables({"states": states(spark, d), "stations": stations(spark, d), "regions": regions(spark, d)} | waters, f"{base}/layers")
        folders = {"base_dir": "raw", "operations_folder": "kept", "spatial_folder": "layers", "figure_folder": "figures", "figure_output_folder": "out"}
        row = spark.range(1).select(*[F.lit(f"{base}/{f}").alias(n) for n, f in folders.items()], F.lit("2020").alias("year"))
        write_table(row, f"{base}/options", "csv")
    return base


def _run(spark, d):
    """The folder of a whole run from its options, done once per application."""
    base = _options(spark, d)
    run_from_options(spark, f"{base}/options", fmt="parquet")
    return f"{base}/out"


@query(
    f"""
    WITH {CLEAN_SQL}, s(stage) AS (VALUES ('prepare'), ('reports'), ('polygons'))
    SELECT stage, false AS ran, (SELECT count(*) FROM clean) AS n FROM s
    """
)
def run_from_options_again(spark, d):
    """A whole run from an options table, then again without any change: no stage runs; how many rows are stored."""
    folder = _run(spark, d)
    ran = run_from_options(spark, f"{_options(spark, d)}/options", fmt="parquet")
    n = spark.read.parquet(f"{folder}/AllYears_All_Columns").count()
    return literal_rows(spark, "stage string, ran boolean, n bigint", [(stage, now, n) for stage, now in ran.items()])


@query(
    f"""
    WITH {CLEAN_SQL},
    c AS (SELECT abbr, count(*) AS total, nullif(count(*) FILTER (WHERE high_risk AND k % 7 <> 0), 0) AS hr,
                 nullif(count(*) FILTER (WHERE fouled), 0) AS mf, nullif(count(*) FILTER (WHERE k % 9 = 0), 0) AS ch
          FROM clean WHERE y = 2020 GROUP BY abbr),
    s AS (SELECT n_name AS name, n_nationkey, total, hr, mf, ch
          FROM nation LEFT JOIN c ON abbr = CASE n_nationkey WHEN 3 THEN 'AB' WHEN 4 THEN 'MT' WHEN 5 THEN 'BN' WHEN 6 THEN 'WA' ELSE 'X' || n_nationkey END
          WHERE n_nationkey <> 5)
    SELECT 'No_inspection' AS layer, name, n_nationkey * 2.0 - 139 AS x, 45.5 AS y FROM s WHERE total IS NULL
    UNION ALL SELECT 'No_HR_inspection', name, n_nationkey * 2.0 - 139, 45.5 FROM s WHERE hr IS NULL
    UNION ALL SELECT 'No_MF_inspection', name, n_nationkey * 2.0 - 139, 45.5 FROM s WHERE mf IS NULL
    UNION ALL SELECT 'No_CH_inspection', name, n_nationkey * 2.0 - 139, 45.5 FROM s WHERE ch IS NULL
    """
)
def stored_labels(spark, d):
    """The label layers as a whole run stored them: regions without any inspection of a kind."""
    folder = _run(spark, d)
    layers = ["No_inspection", "No_HR_inspection", "No_MF_inspection", "No_CH_inspection"]
    read = lambda n: spark.read.parquet(f"{folder}/{n}_states_labels")
    return union_by_name(
        [read(n).select(F.lit(n).alias("layer"), F.col("NAME_1").alias("name"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y")) for n in layers]
    )


@query(ORACLES["report_by_station"])
def stored_stations(spark, d):
    """The station table as a whole run stored it."""
    return _station_columns(spark.read.parquet(f"{_run(spark, d)}/Inspections_Summarised_at_Station_level"))


@query(
    f"""
    WITH {CLEAN_SQL}, {_POLYGON_SQL},
    p AS ({_POLYGON_COUNTS} GROUP BY ALL), r AS ({_POLYGON_COUNTS} WHERE y = 2020 GROUP BY ALL),
    parts AS (SELECT watersh, name FROM lakes UNION ALL VALUES (0, 'Pacific Ocean'), (0, 'Dry Storage'))
    SELECT 'all years' AS scope, watersh, name, total, fouled, high_risk, count(*) AS parts FROM p JOIN parts USING (watersh, name) GROUP BY ALL
    UNION ALL SELECT 'report year', watersh, name, total, fouled, high_risk, count(*) FROM r JOIN parts USING (watersh, name) GROUP BY ALL
    """
)
def stored_polygons(spark, d):
    """Both polygon layers as a whole run stored them, counted by feature; every part has its outline."""
    folder = _run(spark, d)

    def read(scope, year):
        layer = spark.read.parquet(f"{folder}/{RowFilter().label(year)}").filter("size(rings) > 0")
        keys = ["watersh", "name", "total", "fouled", "high_risk"]
        shown = layer.select(
            F.col("WATERSH").cast("bigint").alias("watersh"),
            F.col("GNIS_NA").alias("name"),
            F.col("TotalInspections").alias("total"),
            F.col("NumberMusselFouled").alias("fouled"),
            F.col("highrisk_Counter").alias("high_risk"),
        )
        return shown.groupBy(*keys).agg(F.count(F.lit(1)).alias("parts")).withColumn("scope", F.lit(scope))

    return read("all years", None).unionByName(read("report year", 2020))


@query(
    f"""
    WITH {CLEAN_SQL} SELECT DISTINCT city AS names FROM clean WHERE city NOT IN ('Vernon', 'Langley', 'Calgary', 'Nelson', 'Kelowna')
    UNION SELECT 'Kelowna, British Columbia, CAN' FROM clean WHERE late AND k % 3 = 0
    """
)
def stored_placenames(spark, d):
    """The names a whole run could not locate, stored as a list to ask for."""
    return spark.read.parquet(f"{_run(spark, d)}/placenames_unresolved")


@query(
    f"""
    WITH {CLEAN_SQL} SELECT CAST(y AS VARCHAR) AS year, id, station, CASE WHEN fouled THEN 'true' ELSE 'false' END AS fouled, dest FROM clean
    """
)
def stored_text(spark, d):
    """The report table that a whole run stored as delimited text, read back."""
    text = readers.read_lookup(spark, f"{_run(spark, d)}/figure_dat_all_csv")
    return text.select(
        F.col("Year").alias("year"),
        F.col("Watercraft_Risk_Assessment_ID").alias("id"),
        F.col("Station").alias("station"),
        F.col("MusselsFound_Ind").alias("fouled"),
        F.col("Destination_Waterbody_1_Name").alias("dest"),
    )
