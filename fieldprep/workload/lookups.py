"""Lookup joins, membership flags, key filters and row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldprep.operators import filters, joins
from fieldprep.operators.reshape import literal_rows
from fieldprep.workload.registry import query, table


def _corrections(spark, d):
    """Corrections made from the nations: some NULL, some names listed twice, one "No Match"."""
    nation, k = table(spark, d, "nation"), F.col("n_nationkey")
    fixed = nation.filter(k % 3 == 0).select(
        F.col("n_name").alias("wrong"),
        F.when(k == 9, None).when(k == 6, "No Match").otherwise(F.concat(F.lit("fixed "), "n_name")).alias("right"),
    )
    again = nation.filter(k == 12).select(F.col("n_name").alias("wrong"), F.lit("twice").alias("right"))
    return fixed.unionByName(again)


@query(
    """
    WITH lk AS (SELECT n_name AS wrong, CASE WHEN n_nationkey = 9 THEN NULL WHEN n_nationkey = 6 THEN 'No Match'
                                             ELSE 'fixed ' || n_name END AS fix FROM nation WHERE n_nationkey % 3 = 0
                UNION ALL SELECT n_name, 'twice' FROM nation WHERE n_nationkey = 12),
    c AS (SELECT c_custkey, 'NATION_' || c_nationkey AS d1, 'NATION_' || (c_custkey % 25) AS d2,
                 CASE WHEN c_custkey % 2 = 0 THEN 'NATION_' || (c_custkey % 7) END AS d3 FROM customer)
    SELECT c_custkey, coalesce(l1.fix, d1) AS d1, coalesce(l2.fix, d2) AS d2, coalesce(l3.fix, d3) AS d3
    FROM c LEFT JOIN lk l1 ON d1 IS NOT DISTINCT FROM l1.wrong
           LEFT JOIN lk l2 ON d2 IS NOT DISTINCT FROM l2.wrong
           LEFT JOIN lk l3 ON d3 IS NOT DISTINCT FROM l3.wrong
    """
)
def correct_by_lookup(spark, d):
    key = F.col("c_custkey")
    name = lambda k: F.concat(F.lit("NATION_"), k.cast("string"))
    df = table(spark, d, "customer").select(
        key,
        name(F.col("c_nationkey")).alias("d1"),
        name(key % 25).alias("d2"),
        F.when(key % 2 == 0, name(key % 7)).alias("d3"),
    )
    return joins.correct_by_lookup(df, ["d1", "d2", "d3"], _corrections(spark, d), "wrong", "right")


@query(
    """
    SELECT s_suppkey, coalesce(CASE WHEN n_regionkey = 1 THEN 'AM' WHEN n_regionkey = 3 THEN 'EU' END, n_name) AS place
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """
)
def abbrev_lookup(spark, d):
    nation = table(spark, d, "nation")
    region = F.col("n_regionkey")
    short = nation.filter(region.isin(1, 3)).select(
        "n_name", F.when(region == 1, "AM").otherwise("EU").alias("abbrev")
    )
    df = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    df = df.select("s_suppkey", F.col("n_name").alias("place"))
    return joins.recode_by_lookup(df, "place", short, "n_name", "abbrev")


@query(
    """
    SELECT w.p_partkey, c2.class FROM part w
    LEFT JOIN (SELECT DISTINCT p_type AS kind, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'simple'
                      WHEN p_type = 'LARGE' THEN 'complex' END AS class FROM part WHERE p_type <> 'PROMO'
               UNION ALL SELECT 'Unknown', 'Unknown') c2
      ON CASE WHEN w.p_type = 'PROMO' THEN 'Unknown' ELSE w.p_type END = c2.kind
    """
)
def lookup_two_level(spark, d):
    part = table(spark, d, "part")
    kind = F.col("p_type")
    first = part.filter(kind != "PROMO").select(kind.alias("kind"), F.concat(F.lit("t-"), kind).alias("type")).distinct()
    second = literal_rows(
        spark, "type string, class string", [("t-SMALL", "simple"), ("t-MEDIUM", "simple"), ("t-LARGE", "complex")]
    )
    default = literal_rows(spark, "kind string, class string", [("Unknown", "Unknown")])
    both = joins.two_level_lookup(first, second, "kind", "type", "class", default)
    df = part.select("p_partkey", F.when(kind == "PROMO", "Unknown").otherwise(kind).alias("kind"))
    return joins.null_safe_join(df, both, ["kind"]).select("p_partkey", "class")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           (CAST(year(l_shipdate) AS VARCHAR) || '-' || l_orderkey) IN (SELECT '1997-' || o_orderkey FROM orders WHERE o_orderstatus = 'F')
           OR CAST(l_orderkey AS VARCHAR) IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT') AS listed
    FROM lineitem
    """
)
def membership_flag(spark, d):
    """Ids with a year prefix against two hand lists: one after the prefix 1997 is stripped, one bare."""
    from fieldprep.functions.text import strip_year_prefix

    orders = table(spark, d, "orders")
    key = F.col("o_orderkey").cast("string")
    closed = orders.filter(F.col("o_orderstatus") == "F").select(key.alias("id"))
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT").select(key.alias("id"))
    df = table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.concat(F.year("l_shipdate").cast("string"), F.lit("-"), F.col("l_orderkey").cast("string")).alias("rec"),
    )
    df = joins.flag_expression_membership(df, strip_year_prefix(F.col("rec"), 1997), closed, "id", "in_closed")
    df = joins.flag_expression_membership(df, F.col("l_orderkey").cast("string"), urgent, "id", "in_urgent")
    return df.withColumn("listed", F.col("in_closed") | F.col("in_urgent")).drop("rec", "in_closed", "in_urgent")


@query(
    """
    SELECT o_orderkey,
           EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND year(l.l_shipdate) = year(o.o_orderdate)
                   AND l.l_returnflag = 'R') AS returned_same_year
    FROM orders o
    """
)
def composite_key_flag(spark, d):
    returned = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    keys = returned.select(F.year("l_shipdate").alias("Year"), F.col("l_orderkey").alias("id"))
    df = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("Year"))
    flagged = joins.flag_membership(df, keys, ["Year", ("o_orderkey", "id")], "returned_same_year")
    return flagged.select("o_orderkey", "returned_same_year")


@query(
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
    """
)
def semi_high_value(spark, d):
    high = table(spark, d, "orders").filter(F.col("o_totalprice") > 400000).select("o_custkey")
    return joins.semi(table(spark, d, "customer"), high, [("c_custkey", "o_custkey")]).select("c_custkey", "c_mktsegment")


@query(
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 300000)
      AND c_mktsegment <> 'BUILDING'
    """
)
def anti_no_activity(spark, d):
    orders = table(spark, d, "orders")
    high = orders.filter(F.col("o_totalprice") > 400000).select("o_custkey")
    pending = orders.filter((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000)).select("o_custkey")
    df = table(spark, d, "customer").filter(F.col("c_mktsegment") != "BUILDING")
    rest = joins.anti(joins.anti(df, high, [("c_custkey", "o_custkey")]), pending, [("c_custkey", "o_custkey")])
    return rest.select("c_custkey", "c_mktsegment")


@query(
    """
    WITH a AS (SELECT l_suppkey AS k, l_returnflag AS f, count(*) AS open_lines FROM lineitem WHERE l_linestatus = 'O' AND l_discount > 0.05 GROUP BY ALL),
    b AS (SELECT l_suppkey AS k, l_returnflag AS f, count(*) AS big_lines FROM lineitem WHERE l_quantity > 45 GROUP BY ALL),
    c AS (SELECT l_suppkey AS k, l_returnflag AS f, count(*) AS taxed_lines FROM lineitem WHERE l_tax > 0.07 GROUP BY ALL)
    SELECT k, f, open_lines, big_lines, taxed_lines FROM a FULL JOIN b USING (k, f) FULL JOIN c USING (k, f)
    """
)
def full_outer_counts(spark, d):
    lines = table(spark, d, "lineitem").withColumnsRenamed({"l_suppkey": "k", "l_returnflag": "f"})
    count = lambda cond, alias: lines.filter(cond).groupBy("k", "f").agg(F.count(F.lit(1)).alias(alias))
    tables = [
        count((F.col("l_linestatus") == "O") & (F.col("l_discount") > 0.05), "open_lines"),
        count(F.col("l_quantity") > 45, "big_lines"),
        count(F.col("l_tax") > 0.07, "taxed_lines"),
    ]
    return joins.full_outer_merge(tables, ["k", "f"])


_GAZETTEER_SQL = """
    (SELECT n_name AS names, -130.0 + n_nationkey AS lon, 48.0 + n_nationkey / 4.0 AS lat FROM nation WHERE n_regionkey <> 4)
"""


def gazetteer(spark, d):
    """Coordinates of nations; those of one region are unknown."""
    k = F.col("n_nationkey")
    return (
        table(spark, d, "nation")
        .filter(F.col("n_regionkey") != 4)
        .select(F.col("n_name").alias("names"), (k - 130.0).alias("lon"), (k / 4.0 + 48.0).alias("lat"))
    )


@query(
    f"""
    SELECT c_custkey, c_nationkey,
           CASE WHEN regexp_matches(c_mktsegment, 'BUILD') THEN 'Pacific Ocean' ELSE c_mktsegment END AS water, lon, lat
    FROM customer JOIN {_GAZETTEER_SQL} g ON 'NATION_' || c_nationkey = g.names
    """
)
def lookup_inner_coords(spark, d):
    from fieldprep.functions.recode import recode_first_match
    from fieldprep.plans.polygons import with_coordinates

    df = table(spark, d, "customer").select(
        "c_custkey",
        "c_nationkey",
        recode_first_match(F.col("c_mktsegment"), [("BUILD", "Pacific Ocean")]).alias("water"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("city"),
    )
    return with_coordinates(df, gazetteer(spark, d), "city").drop("city")


@query(
    """
    WITH g AS (SELECT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               GROUP BY l_orderkey HAVING count(*) FILTER (WHERE NOT (l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 900 DAY)) = 0)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM g)
    """
)
def keep_clean_groups(spark, d):
    rows, ok = _line_groups(spark, d)
    return joins.keep_groups(rows, ["l_orderkey"], ok, clean=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    """
    WITH g AS (SELECT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
               GROUP BY l_orderkey HAVING count(*) FILTER (WHERE NOT (l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 900 DAY)) > 0)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM g)
    """
)
def keep_dirty_groups(spark, d):
    rows, ok = _line_groups(spark, d)
    return joins.keep_groups(rows, ["l_orderkey"], ok, clean=False).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


def _line_groups(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows, F.col("l_shipdate").between(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 900 DAY"))


@query(
    """
    WITH c AS (SELECT c_custkey, (['WA', 'OR', 'CA', 'NV', 'ID', 'MT', 'WY', 'CO', 'UT', 'AZ', 'NM', 'NE', 'MI', 'OH', 'WV', 'VA',
                                   'NC', 'PA', 'NY', 'VT', 'NH', 'MA', 'RI', 'CT', 'NJ', 'DE', 'MC', 'DC', 'AB', 'BC', 'ON', 'QC'])[CAST(c_custkey % 32 AS INTEGER) + 1] AS province,
                      (['Goat River', 'Elk River', 'Upper Elk River', 'Kalamalka Lake', 'Duck Creek'])[CAST(c_nationkey % 5 AS INTEGER) + 1] AS water,
                      CASE c_custkey % 4 WHEN 0 THEN 'Fernie' WHEN 1 THEN 'Elko' WHEN 2 THEN 'Prince George' END AS city FROM customer)
    SELECT c_custkey, 'regions' AS preset FROM c WHERE province NOT IN ('BC', 'ON', 'QC')
    UNION ALL
    SELECT c_custkey, 'waters' FROM c WHERE regexp_matches(water, 'Goat River|Emerald Lake|Elk River|Boulder Creek|Duck Creek')
           AND NOT (water = 'Elk River' AND coalesce(city NOT IN ('Fernie', 'Elko'), true))
    UNION ALL
    SELECT c_custkey, 'segment' FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
    """
)
def preset_filter(spark, d):
    from fieldprep.plans.polygons import RowFilter, apply_filter

    key = F.col("c_custkey")
    of = lambda values, k: F.get(F.array(*[F.lit(v) for v in values]), k.cast("int"))
    waters = ("Goat River", "Elk River", "Upper Elk River", "Kalamalka Lake", "Duck Creek")
    provinces = "WA OR CA NV ID MT WY CO UT AZ NM NE MI OH WV VA NC PA NY VT NH MA RI CT NJ DE MC DC AB BC ON QC".split()
    df = table(spark, d, "customer").select(
        "c_custkey",
        "c_mktsegment",
        of(provinces, key % 32).alias("Previous_Waterbody_1_Province_Or_State"),
        of(waters, F.col("c_nationkey") % 5).alias("Previous_Waterbody_1_Name"),
        F.when(key % 4 == 0, "Fernie")
        .when(key % 4 == 1, "Elko")
        .when(key % 4 == 2, "Prince George")
        .alias("Previous_Waterbody_1_Closest_City"),
    )
    kept = {
        "regions": apply_filter(df, RowFilter(preset="WD_infected_areas")),
        "waters": apply_filter(df, RowFilter(preset="BC_WD_infected_wbs")),
        "segment": apply_filter(df, RowFilter(field="c_mktsegment", values=("BUILDING", "MACHINERY"))),
    }
    named = [k.select("c_custkey", F.lit(n).alias("preset")) for n, k in kept.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(
    """
    SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey < 16 AND s_name IS NOT NULL
    """
)
def first_n_source_rows(spark, d):
    """The first sixteen rows of a list that carries its row number: the operator is the limit."""
    position = F.col("s_suppkey") + 1
    listed = table(spark, d, "supplier").withColumn("position", position)
    return filters.drop_missing(filters.first_source_rows(listed, 16, "position"), "s_name").select("s_suppkey", "s_name")


@query(
    """
    SELECT year, 'report' AS rule, count(*) AS n FROM (SELECT year(o_orderdate) AS year FROM orders) WHERE year = 1998 GROUP BY ALL
    UNION ALL SELECT year(o_orderdate), 'urgent', count(*) FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL
    UNION ALL SELECT year(o_orderdate), 'strict', count(*) FROM orders
              WHERE o_orderpriority = '1-URGENT' AND (o_orderstatus <> 'F' OR year(o_orderdate) < 1997) GROUP BY ALL
    UNION ALL SELECT year(o_orderdate), 'old era', count(*) FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1998 GROUP BY ALL
    UNION ALL SELECT year(o_orderdate), 'new era', count(*) FROM orders WHERE year(o_orderdate) >= 1999 GROUP BY ALL
    UNION ALL SELECT year(o_orderdate), 'split yes', count(*) FROM orders WHERE regexp_matches(o_orderpriority, '^[0-9]-[HL]') GROUP BY ALL
    UNION ALL SELECT year(o_orderdate), 'split no', count(*) FROM orders WHERE NOT regexp_matches(o_orderpriority, '^[0-9]-[HL]') GROUP BY ALL
    """
)
def row_filters(spark, d):
    """What each filter operator keeps per year."""
    orders = table(spark, d, "orders").select(F.year("o_orderdate").cast("bigint").alias("year"), "o_orderpriority", "o_orderstatus")
    urgent = filters.keep_values(orders, "o_orderpriority", ["1-URGENT"])
    yes, no = filters.split_by(orders, F.col("o_orderpriority").rlike("^[0-9]-[HL]"))
    kept = {
        "report": filters.keep_year(orders, 1998, "year"),
        "urgent": urgent,
        "strict": urgent.filter((F.col("o_orderstatus") != "F") | (F.col("year") < 1997)),
        "old era": filters.keep_era(orders, 1995, 1998, "year"),
        "new era": filters.keep_era(orders, 1999, None, "year"),
        "split yes": yes,
        "split no": no,
    }
    tagged = [df.select("year", F.lit(rule).alias("rule")) for rule, df in kept.items()]
    return reduce(DataFrame.unionByName, tagged).groupBy("year", "rule").agg(F.count(F.lit(1)).alias("n"))
