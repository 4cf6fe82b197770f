"""Grouped counts, sums, group numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldprep.functions.recode import recode_exact
from fieldprep.operators import aggregates as agg
from fieldprep.operators import joins, windows
from fieldprep.operators.reshape import literal_rows, stacked_distinct, union_by_name
from fieldprep.workload.registry import ORACLES, query, table

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    """
    WITH e AS (SELECT user_id, value, CASE event_type WHEN 'click' THEN 'visit' WHEN 'view' THEN 'visit' ELSE event_type END AS activity
               FROM events),
    c AS (SELECT user_id, count(*) AS total,
                 nullif(count(*) FILTER (WHERE activity = 'error' AND value > 10), 0) AS high_risk,
                 nullif(count(*) FILTER (WHERE activity = 'purchase'), 0) AS fouled,
                 nullif(count(*) FILTER (WHERE activity = 'visit'), 0) AS hauled FROM e GROUP BY user_id)
    SELECT c_custkey, c_nationkey, total, high_risk, fouled, hauled FROM customer LEFT JOIN c ON c_custkey = user_id
    """
)
def conditional_counts_by_source(spark, d):
    """Recode, several filtered counts in one pass, and a dimension that keeps members without facts."""
    activity = recode_exact(F.col("event_type"), {"click": "visit", "view": "visit"})
    events = table(spark, d, "events").select("user_id", "value", activity.alias("activity"))
    is_a = lambda name: F.col("activity") == name
    counts = agg.conditional_counts(
        events,
        ["user_id"],
        {"total": None, "high_risk": is_a("error") & (F.col("value") > 10), "fouled": is_a("purchase"), "hauled": is_a("visit")},
        zero_as_null=True,
    )
    people = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return joins.attach_counts(people, counts, [("c_custkey", "user_id")])


@query(
    """
    WITH f AS (SELECT o_custkey % 30 AS station, year(o_orderdate) AS y, o_orderstatus, o_orderpriority AS p FROM orders),
    g AS (SELECT station, y, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS fouled,
                 count(*) FILTER (WHERE p = '1-URGENT') AS high_risk,
                 nullif(count(DISTINCT p) FILTER (WHERE p <> '4-NOT SPECIFIED'), 0) AS known FROM f
          WHERE station % 25 <> 3 OR station < 3 GROUP BY ALL)
    SELECT n_name AS station_name, y, coalesce(total, 0) AS total, coalesce(fouled, 0) AS fouled, coalesce(high_risk, 0) AS high_risk, known
    FROM nation LEFT JOIN g ON n_nationkey = station
    """
)
def dimension_year_summary(spark, d):
    orders = table(spark, d, "orders").select(
        (F.col("o_custkey") % 30).alias("station"), F.year("o_orderdate").cast("bigint").alias("y"), "o_orderstatus", "o_orderpriority"
    )
    station, priority = F.col("station"), F.col("o_orderpriority")
    facts = orders.filter((station % 25 != 3) | (station < 3))
    nations = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("station"), F.col("n_name").alias("station_name"))
    done = agg.dimension_year_summary(
        nations,
        facts,
        "station",
        "y",
        {"total": None, "fouled": F.col("o_orderstatus") == "F", "high_risk": priority == "1-URGENT"},
        F.when(priority != "4-NOT SPECIFIED", priority),
        "known",
    )
    return done.drop("station")


@query(
    """
    SELECT user_id, count(*) FILTER (WHERE event_type = 'click' AND value > 5) AS "LowRisk_click",
           count(*) FILTER (WHERE event_type = 'error' AND value > 5) AS "LowRisk_error",
           count(*) FILTER (WHERE event_type = 'purchase' AND value > 5) AS "LowRisk_purchase",
           count(*) FILTER (WHERE event_type = 'signup' AND value > 5) AS "LowRisk_signup",
           count(*) FILTER (WHERE event_type = 'view' AND value > 5) AS "LowRisk_view"
    FROM events GROUP BY user_id
    """
)
def pivot_counts_prefixed(spark, d):
    return agg.pivot_counts(
        table(spark, d, "events"), ["user_id"], "event_type", EVENT_TYPES, "LowRisk_", F.col("value") > 5
    )


@query(
    """
    WITH y AS (SELECT l_suppkey, l_partkey % 50 AS city, year(l_shipdate) AS y, count(*) AS n,
                      sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
                      count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
                      count(*) FILTER (WHERE l_tax > 0.04) AS taxed FROM lineitem GROUP BY ALL)
    SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS n, CAST(sum(quantity) AS DOUBLE) AS quantity,
           CAST(sum(returned) AS BIGINT) AS returned, CAST(sum(taxed) AS BIGINT) AS taxed,
           CAST(sum(returned) + sum(taxed) AS BIGINT) AS both_kinds
    FROM y GROUP BY l_suppkey
    """
)
def counters_resum(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_suppkey",
        (F.col("l_partkey") % 50).alias("city"),
        F.year("l_shipdate").alias("y"),
        F.col("l_quantity").cast("decimal(18,2)").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_tax") > 0.04).alias("taxed"),
    )
    measures = ["quantity", "returned", "taxed"]
    yearly = agg.group_totals(lines, ["l_suppkey", "city", "y"], measures)
    total = agg.resum(yearly, ["l_suppkey"], ["n", *measures])
    return total.withColumns(
        {"both_kinds": F.col("returned") + F.col("taxed"), "quantity": F.col("quantity").cast("double")}
    )


_CLASSES = {
    "Non-motorized": "non_motorized",
    "Simple": "simple",
    "Complex": "complex",
    "Very complex": "very_complex",
    "Unknown": "unknown",
}


def _typed_parts(spark, d):
    """Parts with a shared id and their types, and the lookup of the types' classes."""
    size, kind = F.col("p_size"), F.col("p_type")
    words = F.split("p_name", " ")
    types = F.concat_ws(",", kind, words[0], F.concat(F.lit(" "), words[1]), kind)
    df = table(spark, d, "part").select(
        "p_partkey",
        F.concat(F.col("p_brand"), F.lit("/"), (size % 5).cast("string")).alias("id"),
        F.when(size % 11 == 0, None).when(size % 11 == 1, "other").otherwise(types).alias("types"),
    )
    lookup = literal_rows(
        spark,
        "type string, class string",
        [
            ("SMALL", "Simple"),
            ("SMALL", "Non-motorized"),
            ("LARGE", "Complex"),
            ("PROMO", None),
            ("red", "Simple"),
            (" ring", "Very complex"),
            (" bolt", "Complex"),
            ("blue", "Simple"),
            ("Unknown", "Unknown"),
        ],
    )
    return df, lookup


@query(
    """
    WITH w AS (SELECT p_partkey, p_brand || '/' || p_size % 5 AS id,
                      CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 11 = 1 THEN 'other'
                           ELSE p_type || ',' || split_part(p_name, ' ', 1) || ', ' || split_part(p_name, ' ', 2) || ',' || p_type END AS types
               FROM part),
    s AS (SELECT p_partkey, id, CASE WHEN types IS NULL OR split_part(types, ',', 1) = 'other' THEN 'Unknown' ELSE split_part(types, ',', 1) END AS t1,
                 CASE WHEN contains(types, ',') THEN split_part(types, ',', 2) END AS t2,
                 CASE WHEN contains(types, ',') THEN split_part(types, ',', 3) END AS t3 FROM w),
    lk(type, class) AS (VALUES ('SMALL', 'Simple'), ('SMALL', 'Non-motorized'), ('LARGE', 'Complex'), ('PROMO', NULL), ('red', 'Simple'),
                               (' ring', 'Very complex'), (' bolt', 'Complex'), ('blue', 'Simple'), ('Unknown', 'Unknown')),
    j AS (SELECT p_partkey, id, t1, t2, t3, a.class AS c1, b.class AS c2, c.class AS c3 FROM s
          LEFT JOIN lk a ON t1 IS NOT DISTINCT FROM a.type LEFT JOIN lk b ON t2 IS NOT DISTINCT FROM b.type
          LEFT JOIN lk c ON t3 IS NOT DISTINCT FROM c.type),
    l AS (SELECT p_partkey, id, unnest([c1, c2, c3]) AS class FROM j),
    f AS (SELECT * FROM l WHERE class IS NOT NULL),
    n AS (SELECT id, class, count(*) AS pooled FROM f GROUP BY ALL),
    o AS (SELECT DISTINCT p_partkey, id, class FROM f)
    SELECT p_partkey, id,
           CAST(coalesce(max(pooled) FILTER (WHERE class = 'Non-motorized'), 0) AS DOUBLE) AS non_motorized,
           CAST(coalesce(max(pooled) FILTER (WHERE class = 'Simple'), 0) AS DOUBLE) AS simple,
           CAST(coalesce(max(pooled) FILTER (WHERE class = 'Complex'), 0) AS DOUBLE) AS complex,
           CAST(coalesce(max(pooled) FILTER (WHERE class = 'Very complex'), 0) AS DOUBLE) AS very_complex,
           CAST(coalesce(max(pooled) FILTER (WHERE class = 'Unknown'), 0) AS DOUBLE) AS unknown
    FROM o JOIN n USING (id, class) GROUP BY ALL
    """
)
def classify_multi_value(spark, d):
    df, lookup = _typed_parts(spark, d)
    return agg.classify_multi_value(df, "id", "types", lookup, "type", "class", _CLASSES)


@query(ORACLES["classify_multi_value"])
def classify_arriving(spark, d):
    """The same from four tables that came one by one and share ids: rows kept, sums per id added up."""
    df, lookup = _typed_parts(spark, d)
    came = [agg.class_parts(df.filter(F.col("p_partkey") % 4 == n), "id", "types", lookup, "type", "class", _CLASSES) for n in (2, 0, 3, 1)]
    rows, adds = (union_by_name([part[i] for part in came]) for i in (0, 1))
    return agg.pool_parts(rows, adds, "id", _CLASSES)


@query(
    """
    SELECT o_orderkey, DENSE_RANK() OVER (ORDER BY o_orderdate NULLS LAST, st NULLS LAST) AS group_id
    FROM (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 17 <> 0 THEN o_orderstatus END AS st FROM orders)
    """
)
def dense_group_id(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderstatus")).alias("st")
    )
    return windows.dense_group_id(orders, ["o_orderdate", "st"], "group_id").select("o_orderkey", "group_id")


@query(
    """
    SELECT o_orderkey, count(*) OVER w AS orders_of_customer, strftime(min(o_orderdate) OVER w, '%Y-%m-%d') AS first_day,
           strftime(max(o_orderdate) OVER w, '%Y-%m-%d') AS last_day, CAST(sum(o_orderkey % 7) OVER w AS BIGINT) AS key_sum
    FROM orders WINDOW w AS (PARTITION BY o_custkey)
    """
)
def group_count_to_rows(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    stats = {
        "orders_of_customer": F.count(F.lit(1)),
        "first_day": day(F.min("o_orderdate")),
        "last_day": day(F.max("o_orderdate")),
        "key_sum": F.sum(F.col("o_orderkey") % 7),
    }
    return windows.attach_group_stats(orders, ["o_custkey"], stats).drop("o_custkey", "o_orderdate")


@query(
    """
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) AS position FROM orders
    """
)
def row_number_in_group(spark, d):
    """Positions within three huge groups, numbered without putting a group into one task."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    numbered = windows.number_rows(orders, [F.col("o_orderdate"), F.col("o_orderkey")], ["o_orderstatus"], "position")
    return numbered.select("o_orderkey", "position")


@query(
    """
    WITH u AS (SELECT DISTINCT host FROM (SELECT regexp_extract(url, '//([^/]+)/', 1) AS host FROM pages
               UNION ALL SELECT 'http ' || regexp_extract(url, '//([^/]+)/', 1) || ' (page)' FROM pages))
    SELECT host, CAST(ceil(row_number() OVER (ORDER BY host) / 100.0) AS BIGINT) AS batch_id,
           replace(regexp_replace(host, ' \\(.*\\)', '', 'g'), ' ', '%20') AS asked
    FROM u
    """
)
def batch_ids(spark, d):
    """Distinct names of several columns as a work list in batches of a hundred."""
    from fieldprep.functions.text import query_placename

    host = F.regexp_extract("url", "//([^/]+)/", 1)
    pages = table(spark, d, "pages").select(
        host.alias("a"), F.concat(F.lit("http "), host, F.lit(" (page)")).alias("b")
    )
    names = stacked_distinct(pages, ["a", "b"], "host")
    return windows.batch_ids(names, [F.col("host")]).withColumn("asked", query_placename(F.col("host")))
