import math

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldprep.functions import geometry as g
from fieldprep.operators import spatial as sp

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = f"w int, name string, rings {g.RINGS_TYPE}"


def square(x, y, r=1.0):
    x, y, r = float(x), float(y), float(r)
    return [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r), (x - r, y - r)]


def parts_of(spark, features):
    return spark.createDataFrame(features, SCHEMA)


def inside(x, y, rings):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            cross = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if cross == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return True
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
    return odd


def far(x, y, rings):
    if inside(x, y, rings):
        return 0.0
    best = math.inf
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            dx, dy = x2 - x1, y2 - y1
            long = dx * dx + dy * dy
            t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / long)) if long else 0.0
            best = min(best, math.hypot(x1 + t * dx - x, y1 + t * dy - y))
    return best


def test_point_cases(spark):
    hole = [square(0, 0, 4), square(0, 0, 1)]
    df = spark.createDataFrame([(hole,)], f"rings {g.RINGS_TYPE}").withColumn("e", g.edges(F.col("rings")))
    ask = lambda x, y: df.select(g.covers(F.col("e"), F.lit(x), F.lit(y)), g.distance(F.col("e"), F.lit(x), F.lit(y))).first()
    assert tuple(ask(3.0, 0.0)) == (True, 0.0)
    assert tuple(ask(0.0, 0.0)) == (False, 1.0)
    assert tuple(ask(4.0, 0.0)) == (True, 0.0)
    assert tuple(ask(1.0, 0.0)) == (True, 0.0)
    assert tuple(ask(7.0, 8.0)) == (False, 5.0)


def test_open_and_degenerate_rings(spark):
    rings = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], []]
    df = spark.createDataFrame([(rings,)], f"rings {g.RINGS_TYPE}")
    e = g.edges(F.col("rings"))
    assert df.select(F.size(e), g.covers(e, F.lit(0.5), F.lit(2.0))).first() == (4, True)
    dot = spark.createDataFrame([([[(1.0, 1.0)]],)], f"rings {g.RINGS_TYPE}")
    assert dot.select(g.distance(g.edges(F.col("rings")), F.lit(4.0), F.lit(5.0))).first()[0] == 5.0


def test_projection(spark):
    x, y = g.PROVINCIAL_GRID.forward(F.col("lon"), F.col("lat"))
    df = spark.createDataFrame([(-126.0, 45.0), (-123.1, 49.2), (-139.0, 60.0)], "lon double, lat double")
    there = df.withColumns({"x": x, "y": y})
    assert there.first()["x"] == pytest.approx(1_000_000) and there.first()["y"] == pytest.approx(0, abs=1e-6)
    lon, lat = g.PROVINCIAL_GRID.inverse(F.col("x"), F.col("y"))
    for r in there.select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert (r.lon2, r.lat2) == (pytest.approx(r.lon, abs=1e-7), pytest.approx(r.lat, abs=1e-7))
    there_rings = spark.range(1).select(g.project_rings(g.box(-126, 45, -125, 46), g.PROVINCIAL_GRID).alias("r"))
    assert there_rings.select(F.col("r")[0][0]["x"]).first()[0] == pytest.approx(1_000_000)


def test_moments_ignore_ring_direction(spark):
    ring = square(10, 20, 2)
    df = parts_of(spark, [(1, "a", [ring, square(11, 20, 0.5)]), (2, "a", [ring[::-1], square(11, 20, 0.5)[::-1]])])
    done = sp.dissolve(df, ["w"]).collect()
    assert len({(r.area, r.cx, r.cy) for r in done}) == 1
    assert done[0].area == pytest.approx(15) and done[0].cx == pytest.approx((16 * 10 - 11) / 15)


shapes = st.lists(
    st.tuples(st.integers(0, 3), st.sampled_from("aab"), st.integers(-60, 60), st.integers(-60, 60), st.integers(1, 9)), min_size=1, max_size=8
)
dots = st.lists(st.tuples(st.sampled_from("abc"), st.integers(-80, 80), st.integers(-80, 80)), min_size=1, max_size=8)


@QUICK
@given(shapes, dots)
def test_containment_matches_brute_force(spark, features, points):
    made = [(w, n, [square(x, y, r)]) for w, n, x, y, r in features]
    numbered = [(i, x * 1.0, y * 1.0) for i, (_, x, y) in enumerate(points)]
    found = sp.locate_points(
        spark.createDataFrame(numbered, "i int, x double, y double"), parts_of(spark, made), ["w"], cell=4.0
    )
    got = sorted((r.i, -1 if r.w is None else r.w) for r in found.collect())
    want = []
    for i, x, y in numbered:
        hits = [w for w, _, rings in made if inside(x, y, rings)]
        want += [(i, w) for w in hits] or [(i, -1)]
    assert got == sorted(want)


@QUICK
@given(shapes, dots)
def test_nearest_matches_brute_force(spark, features, points):
    made = [(w, n, [square(x, y, r)]) for w, n, x, y, r in features]
    numbered = [(i, n, x * 1.0, y * 1.0) for i, (n, x, y) in enumerate(points)]
    df = spark.createDataFrame(numbered, "i int, name string, x double, y double")
    got = {r.i: (r.w, r.distance) for r in sp.nearest_in_name(df, parts_of(spark, made), "name", ["w"], sizes=(64, 16, 4)).collect()}
    want = {}
    for i, n, x, y in numbered:
        close = [(far(x, y, rings), w) for w, m, rings in made if m == n]
        if close:
            want[i] = min(close)
    assert set(got) == set(want)
    for i, (d, w) in want.items():
        assert got[i][1] == pytest.approx(d, abs=1e-9)
        ties = {v for e, v in ((far(numbered[i][2], numbered[i][3], r), v) for v, m, r in made if m == numbered[i][1]) if abs(e - d) < 1e-9}
        assert got[i][0] in ties


def test_nearest_meets_few_shapes_of_a_hot_name(spark):
    """Every feature carries one name; a point is measured against a few, not against all."""
    k = F.col("id")
    x, y = (k % 100) * 1000.0, F.floor(k / 100) * 1000.0
    parts = spark.range(10000).select((k % 50).cast("int").alias("w"), F.lit("Long Lake").alias("name"), g.box(x, y, x + 100, y + 100).alias("rings"))
    points = spark.range(300).select(F.lit("Long Lake").alias("name"), (k * 317.0 % 100000).alias("x"), (k * 739.0 % 100000).alias("y"))
    found = sp.nearest_in_name(points, parts, "name", ["w"])
    assert found.count() == 300
    assert found.agg(F.max("distance")).first()[0] < 1300


def test_layer_keeps_boxes_and_drops_the_nameless(spark):
    from fieldprep.plans.polygons import waterbody_layer

    layer = lambda name: spark.createDataFrame([(7, name, [square(0, 0)]), (8, None, [square(5, 5)])], f"WATERSH int, GNIS_NA string, rings {g.RINGS_TYPE}")
    done = waterbody_layer(layer("L"), layer("R"), layer("M"))
    assert rows(done, "WATERSH", "GNIS_NA", "WaterBodyType") == [
        (0, "Dry Storage", None),
        (0, "Pacific Ocean", None),
        (7, "L", "Lake"),
        (7, "M", "Manmade"),
        (7, "R", "River"),
    ]


def test_point_on_a_shared_edge_counts_once_per_feature(spark):
    square = lambda x: [[[x, 0.0], [x + 1, 0.0], [x + 1, 1.0], [x, 1.0], [x, 0.0]]]
    made = [("a", square(0.0)), ("a", square(1.0)), ("b", square(1.0)), ("wide", [[[-1e6, -1e6], [1e6, -1e6], [1e6, 1e6], [-1e6, 1e6], [-1e6, -1e6]]])]
    parts = spark.createDataFrame([(n, [[tuple(p) for p in ring] for ring in r]) for n, r in made], f"w string, rings {g.RINGS_TYPE}")
    points = spark.createDataFrame([(1, 1.0, 0.5), (2, 5e5, 5e5), (3, 3e6, 0.0)], "i int, x double, y double")
    found = sp.locate_points(points, parts, ["w"], 1.0)
    assert sorted((r.i, str(r.w)) for r in found.collect()) == [(1, "a"), (1, "b"), (1, "wide"), (2, "wide"), (3, "None")]


def test_parts_alike_are_counted_each_for_itself(spark):
    """Two equal parts must not cancel each other's crossings."""
    parts = parts_of(spark, [(1, "a", [square(0, 0, 2)]), (1, "a", [square(0, 0, 2)]), (2, "a", [square(0, 0, 3)])])
    points = spark.createDataFrame([(1, "a", 0.5, 0.5), (2, "a", 2.5, 0.0), (3, "a", None, 0.0)], "i int, name string, x double, y double")
    found = sp.locate_points(points, parts, ["w"], cell=1.0)
    assert sorted((r.i, str(r.w)) for r in found.collect()) == [(1, "1"), (1, "2"), (2, "2"), (3, "None")]
    near = sp.nearest_in_name(points, parts, "name", ["w"], sizes=(64, 8, 1))
    assert sorted((r.i, r.w, r.distance) for r in near.collect()) == [(1, 1, 0.0), (2, 2, 0.0)]


def test_edges_of_very_different_lengths(spark):
    """Long edges beside thousands of short ones, and points on level edges and corners."""
    ragged = [(10.0 + (i * 37 % 11) / 8, i / 64) for i in range(2000)]
    ring = [*ragged, (0.0, 1999 / 64), (0.0, 0.0)]
    parts = parts_of(spark, [(1, "a", [ring])])
    asked = [(i, (i * 53 % 97) / 8, (i * 31 % 2100) / 64 - 0.5) for i in range(300)] + [(900, 5.0, 0.0), (901, 5.0, 1999 / 64), (902, 0.0, 3.0), (903, -0.5, 0.0)]
    found = sp.locate_points(spark.createDataFrame(asked, "i int, x double, y double"), parts, ["w"], cell=1.0)
    assert {r.i for r in found.collect() if r.w} == {i for i, x, y in asked if inside(x, y, [ring])}


def test_a_large_polygon_meets_points_as_edges(spark):
    """100,000 points against one ring of 200,000 corners: nothing that is joined or shuffled is an array."""
    n = 200_000
    corner = lambda x, y: F.struct(F.lit(x).cast("double").alias("x"), F.lit(y).cast("double").alias("y"))
    ragged = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: corner(1000 + i * 7919 % 997, i))
    rings = F.array(F.concat(ragged, F.array(corner(0, n - 1), corner(0, 0))))
    parts = spark.range(1).select(F.lit(1).alias("w"), rings.alias("rings"))
    k = F.col("id")
    points = spark.range(100_000).select("id", (k * 7 % 2200 - 100).cast("double").alias("x"), (k * 617 % n).cast("double").alias("y"))
    found = sp.locate_points(points, parts, ["w"], cell=64.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rings" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    expected = sum(0 <= i * 7 % 2200 - 100 <= 1000 + (i * 617 % n) * 7919 % 997 and i * 617 % n <= n - 1 for i in range(100_000))
    assert found.filter("w = 1").count() == expected


def pieces_of(spark, features, size):
    """A layer of (w, rings) as pieces of so many corners."""
    cut = [
        (w, part, ring, i // size, corners[i : i + size])
        for part, (w, rings) in enumerate(features)
        for ring, corners in enumerate(rings)
        for i in range(0, len(corners), size)
    ]
    return spark.createDataFrame(cut, "w int, part int, ring int, piece int, corners array<struct<x:double,y:double>>")


def joined_rows(df):
    """Rows that each join made while a table was collected."""
    jvm, made, todo = df.sparkSession._jvm, [], []
    df.collect()
    todo.append(df._jdf.queryExecution().executedPlan())
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind.endswith("JoinExec"):
            made.append(node.metrics().apply("numOutputRows").value())
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            todo += list(jvm.scala.jdk.javaapi.CollectionConverters.asJava(node.children()))
    return made


def test_nearest_takes_few_cells_of_a_wide_field_along(spark):
    """40,000 features of one name in a field of many cells: no join makes a row per point and cell."""
    k = F.col("id")
    x, y = (k % 200) * 1000.0, F.floor(k / 200) * 1000.0
    parts = spark.range(40_000).select((k % 50).cast("int").alias("w"), F.lit("Long Lake").alias("name"), g.box(x, y, x + 100, y + 100).alias("rings"))
    points = spark.range(300).select("id", F.lit("Long Lake").alias("name"), (k * 617.0 % 200000).alias("x"), (k * 739.0 % 200000).alias("y"))
    found = sp.nearest_in_name(points, parts, "name", ["w"])
    made = joined_rows(found)
    assert made and max(made) < 300 * 30
    near = {r.id: r.distance for r in found.collect()}
    for i in range(300):
        dx, dy = (min(max(0, v % 1000 - 100), 1000 - v % 1000 if v < 199_000 else math.inf) for v in (i * 617 % 200000, i * 739 % 200000))
        assert near[i] == pytest.approx(math.hypot(dx, dy), abs=1e-6)


def test_nearest_where_the_closest_cell_has_no_close_edge(spark):
    """Cells that hold a place by their box while what they hold is far, beside others with a near edge."""
    spots = [(1, 2, 2), (2, 62, 62), (3, 2, 62), (4, 62, 2), (5, 66, 33), (6, -3, 40), (7, 130, 130), (8, 34, -2), (9, 1000, 1000), (9, -700, 30)]
    made = [(w, "a", [square(x, y, 0.5)]) for w, x, y in spots]
    asked = [(i, "a", i * 37 % 140 - 5.0, i * 61 % 140 - 5.25) for i in range(120)] + [(500, "a", 63.5, 33.0), (501, "a", 500.0, 500.0)]
    df = spark.createDataFrame(asked, "i int, name string, x double, y double")
    for sizes in ((64, 16, 4), (4096, 64, 1), (8,)):
        got = {r.i: (r.w, r.distance) for r in sp.nearest_in_name(df, parts_of(spark, made), "name", ["w"], sizes=sizes).collect()}
        for i, _, x, y in asked:
            d = min(far(x, y, rings) for _, _, rings in made)
            assert got[i][1] == pytest.approx(d, abs=1e-9)
            assert got[i][0] in {w for w, _, rings in made if far(x, y, rings) < d + 1e-9}


def test_nearest_in_an_empty_layer_or_of_no_points(spark):
    some, none = parts_of(spark, [(1, "a", [square(0, 0)])]), parts_of(spark, [])
    points = spark.createDataFrame([(1, "a", 0.0, 0.0), (2, None, 1.0, 1.0), (3, "a", None, 1.0)], "i int, name string, x double, y double")
    assert sp.nearest_in_name(points, none, "name", ["w"]).count() == 0
    assert sp.nearest_in_name(points.limit(0), some, "name", ["w"]).count() == 0
    assert rows(sp.nearest_in_name(points, some, "name", ["w"]), "i", "w", "distance") == [(1, 1, 0.0)]


def test_cell_sizes_in_between():
    assert sp._nested((2**21, 2**14, 2**7)) == [2**21, 2**18, 2**14, 2**11, 2**7]
    assert sp._nested((64, 16, 4)) == [64, 16, 4] and sp._nested((128,)) == [128]


def test_a_ring_in_pieces_is_the_ring(spark):
    ragged = [*[(10.0 + (i * 37 % 11) / 8, i / 8) for i in range(60)], (0.0, 59 / 8), (0.0, 0.0)]
    features = [(1, [ragged, square(3, 3)]), (2, [square(3, 3, 2)[:4]]), (2, [square(3, 3, 2)]), (None, [square(9, 9, 9), []])]
    asked = [(i, (i * 53 % 97) / 8, (i * 31 % 97) / 8) for i in range(200)] + [(900, 3.0, 3.0), (901, 4.0, 3.0), (902, 0.0, 0.0), (903, None, 1.0)]
    points = spark.createDataFrame(asked, "i int, x double, y double")
    whole = spark.createDataFrame(features, f"w int, rings {g.RINGS_TYPE}")
    want = rows(sp.locate_points(points, whole, ["w"], cell=2.0), "i", "w")
    assert {i for i, w in want if w == 1} == {i for i, x, y in asked if x is not None and inside(x, y, features[0][1])}
    for size in (1, 4, 5, 100):
        assert rows(sp.locate_points(points, pieces_of(spark, features, size), ["w"], cell=2.0), "i", "w") == want


@pytest.mark.parametrize("lost", ["piece = 1", "piece = 4", "piece = 0"])
def test_a_ring_with_a_piece_missing_or_twice_is_refused(spark, lost):
    pieces = pieces_of(spark, [(1, [[(float(i), float(i * i)) for i in range(10)]])], 2)
    points = spark.createDataFrame([(1, 1.0, 1.0)], "i int, x double, y double")
    with pytest.raises(Exception, match="pieces of a ring"):
        sp.locate_points(points, pieces.withColumn("piece", F.col("piece") + 1) if lost == "piece = 4" else pieces.filter(f"NOT {lost}"), ["w"], cell=2.0).count()
    with pytest.raises(Exception, match="pieces of a ring"):
        sp.locate_points(points, pieces.unionByName(pieces.filter(lost)), ["w"], cell=2.0).count()


@pytest.mark.parametrize("n", [1, 4094, 4095, 4096, 9000])
def test_the_coast_comes_in_pieces(spark, n):
    """No row holds more corners than a piece; together they are the ring."""
    from fieldprep.workload.spatial import CORNERS_PER_PIECE, coastline

    pieces = sorted(coastline(spark, n).collect(), key=lambda r: r.piece)
    assert [r.piece for r in pieces] == list(range(len(pieces))) and {(r.region, r.part, r.ring) for r in pieces} == {("coast", 0, 0)}
    assert all(0 < len(r.corners) <= CORNERS_PER_PIECE for r in pieces)
    ring = [(1000.0 + i * 7919 % 997, float(i)) for i in range(n)] + [(0.0, n - 1.0), (0.0, 0.0)]
    assert [tuple(c) for r in pieces for c in r.corners] == ring


def test_nearest_reads_a_layer_once_and_moves_no_rings(spark):
    k = F.col("id")
    parts = spark.range(2000).select((k % 50).cast("int").alias("w"), F.lit("Lake").alias("name"), g.box(k * 10.0, k * 0.0, k * 10.0 + 5, k * 0.0 + 5).alias("rings"))
    points = spark.range(50).select(F.lit("Lake").alias("name"), (k * 391.0).alias("x"), (k * 3.0).alias("y"))
    found = sp.nearest_in_name(points, parts, "name", ["w"])
    assert "rings" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 50


def test_slips_of_placenames(spark):
    from fieldprep.plans.polygons import resolve_slips

    known = spark.createDataFrame([("Vernon", 1.0, 2.0), ("Venon", 3.0, 4.0), ("Nelson", 5.0, 6.0), ("Élan", 7.0, 8.0), ("X", None, 1.0)], "names string, lon double, lat double")
    asked = ["Vernon", "Vrnon", "Velsn", "Nelso", "Nothing", "", "Elan", "Nleson", "X", None]
    worklist = spark.createDataFrame([(a, a) for a in asked], "names string, asked string")
    found = {r.names: (r.known_as, r.slips) for r in resolve_slips(worklist, known).collect()}
    assert found == {"Vernon": ("Vernon", 0), "Vrnon": ("Venon", 1), "Velsn": ("Nelson", 2), "Nelso": ("Nelson", 1), "Elan": ("Élan", 1), "Nleson": ("Nelson", 2)}


def test_hilbert_curve_visits_every_cell_and_steps_to_neighbours(spark):
    cells = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    order = sorted((r.d, r.x, r.y) for r in cells.select("x", "y", g.hilbert(F.col("x"), F.col("y"), 3).alias("d")).collect())
    assert [d for d, _, _ in order] == list(range(64))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(order, order[1:]))


def test_a_window_reads_a_fraction_of_the_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    from fieldprep.sources.readers import read_parts

    k = F.col("id")
    x, y = (k * 7919 % 1000) * 10.0, (k * 104729 % 997) * 10.0
    parts = spark.range(20_000).select("id", g.box(x, y, x + 4, y + 4).alias("rings"))
    path = str(tmp_path / "layer")
    sp.in_space_order(parts, partitions=32).write.parquet(path)
    window = (2000.0, 3000.0, 2500.0, 3400.0)
    met = total = 0
    for file in (tmp_path / "layer").glob("*.parquet"):
        about = pq.ParquetFile(file).metadata
        for i in range(about.num_row_groups):
            group = about.row_group(i)
            stats = {group.column(j).path_in_schema: group.column(j).statistics for j in range(group.num_columns)}
            total += 1
            met += stats["x0"].min <= window[2] and stats["x1"].max >= window[0] and stats["y0"].min <= window[3] and stats["y1"].max >= window[1]
    assert total == 32 and met <= 4
    found = read_parts(spark, path, {"id": "bigint"}, window=window)
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "LessThanOrEqual(x0,2500.0)" in plan and "GreaterThanOrEqual(y1,3000.0)" in plan
    ids = {i for i in range(20_000) if i * 7919 % 1000 * 10 <= 2500 and i * 7919 % 1000 * 10 + 4 >= 2000 and i * 104729 % 997 * 10 <= 3400 and i * 104729 % 997 * 10 + 4 >= 3000}
    assert {r.id for r in found.collect()} == ids
    assert sp.in_space_order(parts.limit(0)).count() == 0
