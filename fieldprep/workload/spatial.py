"""Projection, containment, nearest feature, dissolve.

Polygons come from the suppliers: a diamond with an off-centre diamond hole, one per cell
of a field that grows with the table. Points come from the customers, spread over the same
field, so a point meets about as many polygons at any scale. A third of the features carry
one name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldprep.functions import geometry as g
from fieldprep.operators import spatial as sp
from fieldprep.workload.registry import query, table


def _diamond(x: Column, y: Column, h: Column) -> Column:
    return g.ring_of((x - h, y), (x, y - h), (x + h, y), (x, y + h))


def features(spark, d):
    s = F.col("s_suppkey")
    x, y = (s % 1000) * 1000, F.floor(s / 1000) * 1000
    h = F.lit(300) + (s % 101) * 4
    name = F.when(s % 3 == 0, "Long Lake").otherwise(F.concat(F.lit("Lake "), (s % 7).cast("string")))
    return table(spark, d, "supplier").select(
        (s % 50).alias("watershed"),
        name.alias("name"),
        s.alias("s_suppkey"),
        F.array(_diamond(x, y, h), _diamond(x + h / 4, y, h / 4)).alias("rings"),
    )


def places(spark, d):
    c = F.col("c_custkey")
    cell = F.floor(c / 15)
    name = F.when(c % 3 == 0, "Long Lake").otherwise(F.concat(F.lit("Lake "), (c % 9).cast("string")))
    return table(spark, d, "customer").select(
        "c_custkey",
        name.alias("name"),
        ((cell % 1000) * 1000 + (c * 389) % 1000 - 500).cast("double").alias("x"),
        (F.floor(cell / 1000) * 1000 + (c * 617) % 1000 - 500).cast("double").alias("y"),
    )


_FEATURES = """
    f AS (SELECT s_suppkey, s_suppkey % 50 AS watershed, CASE WHEN s_suppkey % 3 = 0 THEN 'Long Lake' ELSE 'Lake ' || s_suppkey % 7 END AS name,
                 (s_suppkey % 1000) * 1000.0::DOUBLE AS fx, (s_suppkey // 1000) * 1000.0::DOUBLE AS fy,
                 (300 + s_suppkey % 101 * 4)::DOUBLE AS h FROM supplier),
    p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Long Lake' ELSE 'Lake ' || c_custkey % 9 END AS name,
                 (((c_custkey // 15) % 1000) * 1000 + (c_custkey * 389) % 1000 - 500)::DOUBLE AS x,
                 (((c_custkey // 15) // 1000) * 1000 + (c_custkey * 617) % 1000 - 500)::DOUBLE AS y FROM customer)
"""
_INSIDE = "(abs(x - fx) + abs(y - fy) <= h AND abs(x - fx - h / 4) + abs(y - fy) >= h / 4)"


@query(
    f"""
    WITH {_FEATURES}
    SELECT c_custkey, s_suppkey AS region FROM p LEFT JOIN f ON {_INSIDE}
    """
)
def point_in_polygon(spark, d):
    regions = features(spark, d).withColumnRenamed("s_suppkey", "region")
    return sp.locate_points(places(spark, d), regions, ["region"], cell=64.0).select("c_custkey", "region")


CORNERS_PER_PIECE = 4096


def coastline(spark, n: int):
    """A ring of n corners and two more, in pieces: as one value it would outgrow an executor."""
    corner = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    ragged = lambda i: corner(1000 + i * 7919 % 997, i)
    straight = lambda i: corner(F.lit(0), F.when(i == n, n - 1).otherwise(0))
    first = F.col("piece") * CORNERS_PER_PIECE
    places = F.sequence(first, F.least(first + (CORNERS_PER_PIECE - 1), F.lit(n + 1)))
    pieces = spark.range(-(-(n + 2) // CORNERS_PER_PIECE)).withColumnRenamed("id", "piece")
    corners = F.transform(places, lambda i: F.when(i < n, ragged(i)).otherwise(straight(i)))
    return pieces.select(F.lit("coast").alias("region"), F.lit(0).alias("part"), F.lit(0).alias("ring"), "piece", corners.alias("corners"))


@query(
    """
    WITH n AS (SELECT count(*) AS n FROM lineitem),
         p AS (SELECT o_orderkey, (o_orderkey * 7 % 2200 - 100)::DOUBLE AS x, (o_orderkey * 617 % (n + 10) - 5)::DOUBLE + (o_orderkey % 4) / 4.0::DOUBLE AS y, n FROM orders, n),
         k AS (SELECT *, floor(y)::BIGINT AS k FROM p),
         f AS (SELECT *, (1000 + k * 7919 % 997)::DOUBLE AS f0, (1000 + (k + 1) * 7919 % 997)::DOUBLE AS f1 FROM k)
    SELECT o_orderkey, CASE WHEN x >= 0 AND y >= 0 AND y <= n - 1 AND x <= f0 + (y - k) * (CASE WHEN y = k THEN 0 ELSE f1 - f0 END) THEN 'coast' END AS region FROM f
    """
)
def point_in_large_polygon(spark, d):
    """One polygon with a corner per line item, ragged on one side, and a point per order."""
    n = table(spark, d, "lineitem").count()
    coast = coastline(spark, n)
    o = F.col("o_orderkey")
    x, y = o * 7 % 2200 - 100, (o * 617 % (n + 10) - 5) + (o % 4) / 4
    points = table(spark, d, "orders").select("o_orderkey", x.cast("double").alias("x"), y.cast("double").alias("y"))
    return sp.locate_points(points, coast, ["region"], cell=64.0).select("o_orderkey", "region")


@query(
    f"""
    WITH {_FEATURES},
    e AS (SELECT s_suppkey, watershed, name, fx, fy, h, unnest([
            {{'ax': fx - h, 'ay': fy, 'bx': fx, 'by': fy - h}}, {{'ax': fx, 'ay': fy - h, 'bx': fx + h, 'by': fy}},
            {{'ax': fx + h, 'ay': fy, 'bx': fx, 'by': fy + h}}, {{'ax': fx, 'ay': fy + h, 'bx': fx - h, 'by': fy}},
            {{'ax': fx, 'ay': fy, 'bx': fx + h / 4, 'by': fy - h / 4}}, {{'ax': fx + h / 4, 'ay': fy - h / 4, 'bx': fx + h / 2, 'by': fy}},
            {{'ax': fx + h / 2, 'ay': fy, 'bx': fx + h / 4, 'by': fy + h / 4}}, {{'ax': fx + h / 4, 'ay': fy + h / 4, 'bx': fx, 'by': fy}}]) AS s FROM f),
    t AS (SELECT c_custkey, watershed, x, y, s, {_INSIDE} AS inside,
                 greatest(0, least(1, ((x - s.ax) * (s.bx - s.ax) + (y - s.ay) * (s.by - s.ay)) / ((s.bx - s.ax) ** 2 + (s.by - s.ay) ** 2))) AS u
          FROM p JOIN e USING (name)),
    m AS (SELECT c_custkey, watershed, CASE WHEN inside THEN 0 ELSE
                 sqrt((s.ax + u * (s.bx - s.ax) - x) ** 2 + (s.ay + u * (s.by - s.ay) - y) ** 2) END AS dist FROM t),
    r AS (SELECT c_custkey, watershed, round(dist, 6) AS distance,
                 row_number() OVER (PARTITION BY c_custkey ORDER BY round(dist, 9), watershed) AS k FROM m)
    SELECT c_custkey, watershed, distance FROM r WHERE k = 1
    """
)
def nearest_named_polygon(spark, d):
    found = sp.nearest_in_name(places(spark, d), features(spark, d), "name", ["watershed"])
    return found.select("c_custkey", "watershed", F.round("distance", 6).alias("distance"))


_MOMENTS = """
    m AS (SELECT *, 2 * h * h - h * h / 8 AS a, 2 * h * h * fx - h * h / 8 * (fx + h / 4) AS mx, (2 * h * h - h * h / 8) * fy AS my,
                 s_suppkey // 4 AS basin FROM f)
"""


@query(
    f"""
    WITH {_FEATURES}, {_MOMENTS}
    SELECT basin, count(*) AS parts, min(fx - h) AS x0, min(fy - h) AS y0, max(fx + h) AS x1, max(fy + h) AS y1,
           round(sum(a), 3) AS area
    FROM m GROUP BY basin
    """
)
def dissolve(spark, d):
    parts = features(spark, d).withColumn("basin", F.floor(F.col("s_suppkey") / 4))
    return sp.dissolve(parts, ["basin"]).drop("cx", "cy").withColumn("area", F.round("area", 3))


@query(
    f"""
    WITH {_FEATURES}, {_MOMENTS}
    SELECT basin, round(sum(mx) / sum(a), 3) AS x, round(sum(my) / sum(a), 3) AS y FROM m GROUP BY basin
    """
)
def centroids(spark, d):
    parts = features(spark, d).withColumn("basin", F.floor(F.col("s_suppkey") / 4))
    centre = sp.centroids(parts, ["basin"])
    return centre.withColumns({c: F.round(c, 3) for c in ("x", "y")})


_ALBERS = """
    k AS (SELECT 6378137.0::DOUBLE AS a, 1 / 298.257222101::DOUBLE AS f),
    e AS (SELECT a, sqrt(f * (2 - f)) AS e FROM k),
    q AS (SELECT *, (1 - e * e) AS g FROM e),
    c AS (SELECT a, e, g, cos(radians(50)) ** 2 / (1 - (e * sin(radians(50))) ** 2) AS m1,
                 cos(radians(58.5)) ** 2 / (1 - (e * sin(radians(58.5))) ** 2) AS m2,
                 g * (sin(radians(45)) / (1 - (e * sin(radians(45))) ** 2) - ln((1 - e * sin(radians(45))) / (1 + e * sin(radians(45)))) / (2 * e)) AS q0,
                 g * (sin(radians(50)) / (1 - (e * sin(radians(50))) ** 2) - ln((1 - e * sin(radians(50))) / (1 + e * sin(radians(50)))) / (2 * e)) AS q1,
                 g * (sin(radians(58.5)) / (1 - (e * sin(radians(58.5))) ** 2) - ln((1 - e * sin(radians(58.5))) / (1 + e * sin(radians(58.5)))) / (2 * e)) AS q2 FROM q),
    n AS (SELECT *, (m1 - m2) / (q2 - q1) AS n FROM c),
    z AS (SELECT *, m1 + n * q1 AS cc, a * sqrt(m1 + n * q1 - n * q0) / n AS r0 FROM n),
    b AS (SELECT c_custkey, -139 + (c_custkey % 2500) / 100.0::DOUBLE AS lon, 48 + (c_custkey % 1200) / 100.0::DOUBLE AS lat FROM customer),
    s AS (SELECT *, sin(radians(lat)) AS s FROM b, z),
    t AS (SELECT *, a * sqrt(cc - n * g * (s / (1 - (e * s) ** 2) - ln((1 - e * s) / (1 + e * s)) / (2 * e))) / n AS r, n * radians(lon + 126) AS th FROM s)
"""


@query(
    f"""
    WITH {_ALBERS}
    SELECT c_custkey, round(1000000 + r * sin(th), 3) AS x, round(r0 - r * cos(th), 3) AS y, round(lon, 6) AS lon, round(lat, 6) AS lat FROM t
    """
)
def project_albers(spark, d):
    """Degrees to the provincial grid and back."""
    c = F.col("c_custkey")
    points = table(spark, d, "customer").select(
        "c_custkey", ((c % 2500) / 100.0 - 139).alias("lon"), ((c % 1200) / 100.0 + 48).alias("lat")
    )
    moved = sp.project_points(points, g.PROVINCIAL_GRID, "lon", "lat")
    lon, lat = g.PROVINCIAL_GRID.inverse(F.col("x"), F.col("y"))
    return moved.select(
        "c_custkey", *[F.round(v, 3).alias(v) for v in ("x", "y")], F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat")
    )


@query(
    """
    WITH l AS (SELECT s_suppkey % 9 AS w, 'Lake ' || s_suppkey % 4 AS n, 'Lake' AS t FROM supplier WHERE s_suppkey % 10 <> 0
               UNION ALL SELECT c_custkey % 9, 'River ' || c_custkey % 4, 'River' FROM customer WHERE c_custkey % 10 <> 0
               UNION ALL SELECT p_partkey % 9, 'Pond ' || p_partkey % 4, 'Manmade' FROM part WHERE p_partkey % 10 <> 0
               UNION ALL SELECT 0, 'Pacific Ocean', NULL UNION ALL SELECT 0, 'Dry Storage', NULL)
    SELECT w AS "WATERSH", n AS "GNIS_NA", t AS "WaterBodyType", count(*) AS parts FROM l GROUP BY ALL
    """
)
def waterbody_layer(spark, d):
    """Three layers into one, nameless parts dropped, two literal boxes added."""
    from fieldprep.plans.polygons import waterbody_layer as build

    def layer(name: str, key: str, word: str):
        k = F.col(key)
        x, y = (k % 1000) * 10.0, F.floor(k / 1000) * 10.0
        return table(spark, d, name).select(
            (k % 9).alias("WATERSH"),
            F.when(k % 10 != 0, F.concat(F.lit(f"{word} "), (k % 4).cast("string"))).alias("GNIS_NA"),
            g.box(x, y, x + 5, y + 5).alias("rings"),
        )

    layers = build(layer("supplier", "s_suppkey", "Lake"), layer("customer", "c_custkey", "River"), layer("part", "p_partkey", "Pond"))
    return sp.dissolve(layers, ["WATERSH", "GNIS_NA", "WaterBodyType"]).select("WATERSH", "GNIS_NA", "WaterBodyType", "parts")


@query(
    """
    WITH c AS (SELECT 'NATION_' || c_nationkey AS a, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment || ' (old)' END AS b,
                      'Montréal ' || c_nationkey AS c FROM customer),
    w AS (SELECT DISTINCT unnest([a, b, c]) AS names FROM c),
    g AS (SELECT n_name AS asked, -130.0 + n_nationkey AS lon, 48.0 AS lat FROM nation WHERE n_regionkey <> 4
          UNION ALL SELECT 'BUILDING', -120.5, 50.0 UNION ALL SELECT 'Montreal 3', -73.5, 45.5),
    q AS (SELECT names, regexp_replace(replace(names, 'é', 'e'), ' \\(.*\\)', '', 'g') AS asked FROM w WHERE names IS NOT NULL)
    SELECT names, lon, lat FROM q LEFT JOIN g USING (asked)
    """
)
def placename_worklist(spark, d):
    """Distinct names of several columns, with coordinates where the gazetteer has them."""
    from fieldprep.operators.reshape import append_rows
    from fieldprep.plans.polygons import placename_worklist as worklist
    from fieldprep.plans.polygons import resolve_placenames

    nation, k = F.col("c_nationkey").cast("string"), F.col("n_nationkey")
    df = table(spark, d, "customer").select(
        F.concat(F.lit("NATION_"), nation).alias("Destination_Waterbody_1_Closest_City"),
        F.when(F.col("c_custkey") % 2 == 0, F.concat("c_mktsegment", F.lit(" (old)"))).alias("Destination_Waterbody_2_Closest_City"),
        F.concat(F.lit("Montréal "), nation).alias("Destination_Major_City"),
    )
    known = table(spark, d, "nation").filter(F.col("n_regionkey") != 4)
    known = known.select(F.col("n_name").alias("names"), (k - 130.0).alias("lon"), F.lit(48.0).alias("lat"))
    known = append_rows(known, "names string, lon double, lat double", [("BUILDING", -120.5, 50.0), ("Montreal 3", -73.5, 45.5)])
    found, unknown = resolve_placenames(worklist(df), known)
    return found.unionByName(unknown, allowMissingColumns=True)


@query(
    """
    WITH c AS (SELECT DISTINCT n_name AS n, c_custkey % (length(n_name) + 1) AS i, c_custkey % 4 AS kind FROM customer JOIN nation ON c_nationkey = n_nationkey),
    s AS (SELECT DISTINCT CASE kind WHEN 0 THEN n WHEN 1 THEN left(n, i::INT) || substr(n, i::INT + 2) WHEN 2 THEN left(n, i::INT) || 'x' || substr(n, i::INT + 1)
                                    ELSE 'Q' || left(n, i::INT) || 'z' || substr(n, i::INT + 3) END AS names FROM c),
    m AS (SELECT names, n_name AS known_as, levenshtein(names, n_name) AS slips, n_nationkey - 130.0 AS lon, row_number() OVER (PARTITION BY names ORDER BY levenshtein(names, n_name), n_name) AS k
          FROM s JOIN nation ON levenshtein(names, n_name) <= 2)
    SELECT names, known_as, lon, slips FROM m WHERE k = 1
    """
)
def placename_slips(spark, d):
    """Misspelt names of nations, met with the names they are one or two letters from."""
    from fieldprep.plans.polygons import resolve_slips

    nations = table(spark, d, "nation")
    people = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    i = (F.col("c_custkey") % (F.length("n_name") + 1)).cast("int")
    n, kind = F.col("n_name"), F.col("c_custkey") % 4
    upto, after = F.substring(n, F.lit(1), i), lambda k: F.substring(n, i + k, F.length(n))
    typed = (
        F.when(kind == 0, n)
        .when(kind == 1, F.concat(upto, after(2)))
        .when(kind == 2, F.concat(upto, F.lit("x"), after(1)))
        .otherwise(F.concat(F.lit("Q"), upto, F.lit("z"), after(3)))
    )
    names = people.select(typed.alias("names")).distinct().withColumn("asked", F.col("names"))
    gazetteer = nations.select(F.col("n_name").alias("names"), (F.col("n_nationkey") - 130.0).alias("lon"), F.lit(48.0).alias("lat"))
    return resolve_slips(names, gazetteer).select("names", "known_as", "lon", F.col("slips").cast("bigint").alias("slips"))


@query(
    f"""
    WITH {_FEATURES}
    SELECT s_suppkey, watershed, name, h FROM f WHERE fx - h <= 60000 AND fx + h >= 20250 AND fy - h <= 900 AND fy + h >= -200
    """
)
def layer_window(spark, d):
    """A layer stored in space order, then the parts of it that meet a window."""
    from fieldprep.sources.readers import read_parts
    from fieldprep.workload.storage import scratch

    path = f"{scratch(spark)}/layer"
    made = features(spark, d)
    sp.in_space_order(made).write.parquet(path)
    kinds = {n: t for n, t in made.dtypes if n != "rings"}
    found = read_parts(spark, path, kinds, window=(20250.0, -200.0, 60000.0, 900.0))
    wide = g.bounds(F.col("rings"))
    return found.select("s_suppkey", "watershed", "name", ((wide["x1"] - wide["x0"]) / 2).alias("h"))
