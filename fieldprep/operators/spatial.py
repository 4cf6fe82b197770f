"""Joins and summaries on planar geometry.

A spatial feature is a set of part rows (see ``functions.geometry``); grouping parts
into features never gathers them. Both spatial joins take a layer apart into its edges, once,
and are equi-joins on cells or bands from there: no ring meets a point, and neither a cross
join nor all pairs of a group is ever formed.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldprep.functions import geometry as g
from fieldprep.operators.joins import null_safe_join
from fieldprep.session import shared_folder, stored
from fieldprep.sources.sinks import write_table
from fieldprep.sources.versions import children

EDGE = ("x1", "y1", "x2", "y2")
#: Bands of edges are 4 ** -TOP_LEVEL to 4 ** TOP_LEVEL high; the levels of a part are the bits of one number.
TOP_LEVEL = 31


def edge_rows(parts: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """One narrow row per edge: the attributes, the number ``__id`` of its part, x1, y1, x2, y2, ``__level``.

    The layer is read once and its edges are stored, so that all readers agree on the numbers;
    two parts alike in everything keep numbers of their own. A layer without ``rings`` comes in
    pieces, see ``_piece_edges``.
    """
    if "rings" not in parts.columns:
        return stored(_piece_edges(parts, attributes))
    numbered = parts.select(*attributes, "rings").withColumn("__id", F.monotonically_increasing_id())
    apart = numbered.select(*attributes, "__id", g.edges(F.col("rings")).alias("__es"))
    return stored(_levelled(apart.withColumn("__step", _step(F.col("__es"), "y1")), attributes))


def _step(corners: Column, y: str) -> Column:
    """Twice the height of so many corners, shared among them: about that of an edge if they go up and down once."""
    ys = F.transform(corners, lambda c: c[y])
    return 2 * (F.array_max(ys) - F.array_min(ys)) / F.nullif(F.size(corners), F.lit(0))


def _levelled(rows: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """The edges ``__es`` of each row, with the level of the horizontal bands that they are filed in.

    Bands there are at least as high as the edge, and as ``__step``, so that edges which are almost
    level do not each bring a level of their own.
    """
    apart = rows.select(*attributes, "__id", "__step", F.explode("__es").alias("__e"))
    high = F.greatest(F.abs(F.col("__e.y2") - F.col("__e.y1")), F.col("__step"))
    level = F.when(high > 0, F.ceil(F.log2(high) / 2)).otherwise(0)
    level = F.greatest(F.lit(-TOP_LEVEL), F.least(F.lit(TOP_LEVEL), level)).cast("int")
    return apart.select(*attributes, "__id", *[f"__e.{c}" for c in EDGE], level.alias("__level"))


def _piece_edges(pieces: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """The edges of rings that are too long for one value.

    A row holds ``corners``, a run of corners of the ring ``ring`` of the part ``part``. Parts have
    numbers of their own; the pieces of a ring are numbered by ``piece`` from 0 without a gap, and
    the last one is followed by the first. No ring is put together: an edge that leaves a piece is
    made from the ends of two, and what is missing or comes twice is refused.
    """
    key = ["__id", "__ring"]
    own = pieces.select(*attributes, F.col("part").alias("__id"), F.col("ring").alias("__ring"), F.col("piece").alias("__piece"), "corners")
    own = own.filter(F.size("corners") > 0).withColumn("__step", _step(F.col("corners"), "y"))
    first, last = F.element_at("corners", 1), F.element_at("corners", -1)
    ends = stored(own.withColumns({"__first": first, "__last": last}).drop("corners"))
    size = ends.groupBy(*key).agg(F.max("__piece").alias("__top"), F.count(F.lit(1)).alias("__n"))
    sized = null_safe_join(ends, size.withColumnsRenamed({"__id": "__i", "__ring": "__r"}), [("__id", "__i"), ("__ring", "__r")])
    after = F.when(F.col("__piece") == F.col("__top"), 0).otherwise(F.col("__piece") + 1)
    following = ends.select(*key, F.col("__piece").alias("__next"), F.col("__first").alias("__to"))
    linked = sized.drop("__first").withColumn("__next", after).join(following, [*key, "__next"], "left")
    whole = F.col("__to").isNotNull() & (F.col("__n") == F.col("__top") + 1)
    wrong = F.raise_error(F.concat(F.lit("pieces of a ring are missing or come twice, ring "), F.coalesce(F.col("__ring").cast("string"), F.lit("NULL"))))
    edge = lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))
    links = linked.select(*attributes, "__id", "__step", F.array(F.when(whole, edge(F.col("__last"), F.col("__to"))).otherwise(wrong)).alias("__es"))
    chain = F.zip_with(F.slice("corners", F.lit(1), F.size("corners") - 1), F.slice("corners", F.lit(2), F.size("corners") - 1), edge)
    return _levelled(own.select(*attributes, "__id", "__step", chain.alias("__es")).unionByName(links), attributes)


def _box_of(edges: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """The box around the edges of each key, as ``__b``."""
    low = lambda a, b: F.min(F.least(a, b))
    high = lambda a, b: F.max(F.greatest(a, b))
    box = F.struct(
        low("x1", "x2").alias("x0"), low("y1", "y2").alias("y0"), high("x1", "x2").alias("x1"), high("y1", "y2").alias("y1")
    )
    return edges.groupBy(*keys).agg(box.alias("__b"), *more)


def _boxed(places: DataFrame, boxes: DataFrame, on: Sequence[str], cell: float) -> DataFrame:
    """Places (``on``, __x, __y) with the rows of ``boxes`` whose box holds them.

    A box is filed at the level whose cells are at least as large as it, so it occupies at most four
    cells there; cells double in size from level to level. A place looks into its one cell of each
    level that occurs; which these are is read off the boxes when the plan is made.
    """
    side = F.greatest(F.col("__b.x1") - F.col("__b.x0"), F.col("__b.y1") - F.col("__b.y0"))
    boxes = boxes.withColumn("__level", F.when(side <= cell, 0).otherwise(F.ceil(F.log2(side / cell))).cast("int"))
    # A handful: one number per doubling of the box size.
    occurring = sorted(r[0] for r in boxes.select("__level").distinct().collect() if r[0] is not None)
    size = lambda lv: F.lit(float(cell)) * F.pow(F.lit(2.0), lv)
    at = lambda v, lv: F.floor(v / size(lv))
    across = lambda a, b: F.explode(F.sequence(at(F.col(a), F.col("__level")), at(F.col(b), F.col("__level"))))
    filed = boxes.withColumn("__cx", across("__b.x0", "__b.x1")).withColumn("__cy", across("__b.y0", "__b.y1"))
    probes = places.withColumn("__level", F.explode(F.array(*map(F.lit, occurring)).cast("array<int>")))
    probes = probes.withColumns({"__cx": at(F.col("__x"), F.col("__level")), "__cy": at(F.col("__y"), F.col("__level"))})
    inside = F.col("__x").between(F.col("__b.x0"), F.col("__b.x1")) & F.col("__y").between(F.col("__b.y0"), F.col("__b.y1"))
    return probes.join(filed, [*on, "__level", "__cx", "__cy"]).filter(inside).drop("__level", "__cx", "__cy", "__b")


def _band(v: Column, level: Column) -> Column:
    return F.floor(v / F.pow(F.lit(4.0), level)).cast("bigint")


def _covering(
    places: DataFrame, edges: DataFrame, on: Sequence[str], carried: Sequence[str], cell: float
) -> DataFrame:
    """``on``, __x, __y and ``carried`` of every part that covers a place, its edges included.

    An edge is filed in the horizontal bands that it touches, at the level whose bands are at least
    as high as the edge: two bands at most. A place within the box of a part looks into its
    one band of each level that the part has, and what its ray crosses there is summed per place
    and part. A part of very many edges is so many rows, dealt by band.
    """
    one = F.expr(f"shiftleft(1L, __level + {TOP_LEVEL})")
    levels = F.expr(f"filter(sequence(-{TOP_LEVEL}, {TOP_LEVEL}), v -> getbit(__levels, v + {TOP_LEVEL}) = 1)")
    # Stored, so that few parts are known to be few and no place is moved to meet them.
    boxes = stored(_box_of(edges, ["__id", *on, *carried], F.bit_or(one).alias("__levels")).withColumn("__levels", levels))
    near = _boxed(places, boxes, on, cell)
    levelled = edges.select("__id", *EDGE, "__level")
    low, high = _band(F.least("y1", "y2"), F.col("__level")), _band(F.greatest("y1", "y2"), F.col("__level"))
    banded = levelled.withColumn("__band", F.explode(F.sequence(low, high)))
    probes = near.withColumn("__level", F.explode("__levels")).drop("__levels")
    probes = probes.withColumn("__band", _band(F.col("__y"), F.col("__level")))
    x, y, e = F.col("__x"), F.col("__y"), F.struct(*EDGE)
    # The ray goes towards greater x.
    meets = y.between(F.least("y1", "y2"), F.greatest("y1", "y2")) & (x <= F.greatest("x1", "x2"))
    met = probes.join(banded, ["__id", "__level", "__band"]).filter(meets)
    place = [*on, "__x", "__y", *carried]
    counted = met.groupBy("__id", *place).agg(F.sum(g.crosses(x, y, e)).alias("__n"), F.bool_or(g.on_edge(x, y, e)).alias("__on"))
    return counted.filter((F.col("__n") % 2 == 1) | F.col("__on")).select(*place)


def locate_points(
    points: DataFrame,
    parts: DataFrame,
    attributes: Sequence[str],
    cell: float,
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Left join of points to the features that cover them (edges included), one row per feature.

    ``cell`` is about the size of a small part. Equal points are looked up once. ``parts`` have ``rings``,
    or come in pieces (see ``_piece_edges``) where a ring may be too long for one row.
    """
    edges = edge_rows(parts, attributes)
    places = points.select(F.col(x).alias("__x"), F.col(y).alias("__y")).dropna().distinct()
    hits = _covering(places, edges, [], attributes, cell).distinct()
    return null_safe_join(points, hits, [(x, "__x"), (y, "__y")])


def _nested(sizes: Sequence[int], most: int = 4) -> list[int]:
    """Cell sizes as given, with others in between where a cell would hold more than 4 ** most next smaller ones."""
    out = [int(sizes[0])]
    for size in map(int, sizes[1:]):
        bits = (out[-1] // size).bit_length() - 1
        steps = max(1, math.ceil(bits / most))
        out += [size << (bits - bits * i // steps) for i in range(1, steps)] + [size]
    return out


def _edge_tree(filed: DataFrame, sizes: Sequence[int]) -> list[DataFrame]:
    """Per name and cell of each size the box of the edges filed there, coarse to fine; stored.

    A level is a table of its own, so that few cells are known to be few. Below the first, __px and __py are the cell above.
    """
    spark = filed.sparkSession
    bits = [(size // sizes[-1]).bit_length() - 1 for size in sizes]
    cells = filed.withColumn("__bits", F.explode(F.array(*map(F.lit, bits))))
    cells = cells.withColumns({c: F.expr(f"shiftright({c}, __bits)") for c in ("__cx", "__cy")})
    nodes = _box_of(cells, ["__bits", "__name", "__cx", "__cy"])
    path = f"{shared_folder(spark).rstrip('/')}/tree-{uuid.uuid4().hex[:12]}"
    write_table(nodes, path, partition_by=["__bits"])
    schema, made = nodes.drop("__bits").schema, set(children(spark, path))
    read = lambda b: spark.read.schema(schema).parquet(f"{path}/__bits={b}") if f"__bits={b}" in made else spark.createDataFrame([], schema)
    levels = [read(b) for b in bits]
    for i, (above, own) in enumerate(zip(bits, bits[1:]), 1):
        levels[i] = levels[i].withColumns({"__px": F.shiftright("__cx", above - own), "__py": F.shiftright("__cy", above - own)})
    return levels


def _below(found: DataFrame, level: DataFrame) -> DataFrame:
    """Places with the cells of a level; below the first those of the cells found for them, which become __px, __py."""
    if "__px" not in level.columns:
        return found.join(level, "__name")
    return found.withColumnsRenamed({"__cx": "__px", "__cy": "__py"}).join(level, ["__name", "__px", "__py"])


def _reach(places: DataFrame, levels: Sequence[DataFrame], edges: DataFrame) -> DataFrame:
    """Places with ``__reach``, within which there is an edge of their name, mostly the nearest one; stored.

    From each level a place takes on the one cell that is closest, of those that hold it the smallest.
    Cells are told apart while they are met, so a place is one row on all levels.
    """
    place, found = ["__name", "__x", "__y"], places.withColumn("__reach", F.lit(math.inf))
    for level in levels:
        met = _below(found, level)
        least, most = g.box_distance_bounds(F.col("__b"), F.col("__x"), F.col("__y"))
        met = met.withColumns({"__most": most, "__far": least + most / 1024})
        keys = place + [c for c in ("__px", "__py") if c in met.columns]
        one = [F.min_by(c, "__far").alias(c) for c in ("__cx", "__cy")]
        found = met.groupBy(*keys).agg(*one, F.min(F.least("__reach", "__most")).alias("__reach")).drop("__px", "__py")
    cell = ["__cx", "__cy"]
    far = g.edge_distance(F.col("__x"), F.col("__y"), F.struct(*EDGE))
    measured = found.join(edges, ["__name", *cell]).groupBy(*place, *cell).agg(F.min(F.least("__reach", far)).alias("__reach"))
    return stored(measured.drop(*cell))


def nearest_in_name(
    points: DataFrame,
    parts: DataFrame,
    name: str,
    feature: Sequence[str],
    x: str = "x",
    y: str = "y",
    distance: str = "distance",
    sizes: Sequence[int] = (2**21, 2**14, 2**7),
) -> DataFrame:
    """Nearest feature among those that carry the point's name; ties go to the lowest feature key.

    Points whose name no feature carries yield nothing. The edges of all parts are filed by their
    middle in nested cells (sizes in map units, each a power of two; others are put in between); every
    cell knows the box of what it holds. A first descent follows one cell per point down to edges;
    their distance is the reach of the point. A second one keeps every cell that comes within the reach,
    level by level, down to single edges, to which exact distances are taken. So a point is never one
    row for each cell of a layer. Points inside a feature of their name are 0
    away from it; these are found by crossings. The layer is read once; only edges, numbers and boxes move.
    Equal points are handled once.
    """
    place, cell = ["__name", "__x", "__y"], ["__name", "__cx", "__cy"]
    places = points.select(F.col(name).alias("__name"), F.col(x).alias("__x"), F.col(y).alias("__y")).dropna().distinct()
    shaped = [c for c in ("rings", "part", "ring", "piece", "corners") if c in parts.columns]
    named = parts.select(F.col(name).alias("__name"), F.struct(*feature).alias("__feature"), *shaped)
    edges = edge_rows(named, ["__name", "__feature"])
    middle = lambda a, b: F.floor((F.col(a) + F.col(b)) / 2 / sizes[-1])
    filed = edges.withColumns({"__cx": middle("x1", "x2"), "__cy": middle("y1", "y2")})
    levels = _edge_tree(filed, _nested(sizes))
    reached = _reach(places, levels, filed.select(*cell, *EDGE))
    within = F.col("__reach") * (1 + 1e-9) + 1e-9
    least, most = g.box_distance_bounds(F.col("__b"), F.col("__x"), F.col("__y"))
    found = reached
    for level in levels:
        found = _below(found, level).withColumns({"__least": least, "__most": most}).filter(F.col("__least") <= within)
        if level not in (levels[0], levels[-1]):
            # Where the first descent went astray; the window holds the few cells that a place still has to choose from.
            found = found.withColumn("__reach", F.least("__reach", F.min("__most").over(Window.partitionBy(*place))))
            found = found.filter(F.col("__least") <= within)
        found = found.select(*place, "__reach", "__cx", "__cy")
    far = g.edge_distance(F.col("__x"), F.col("__y"), F.struct(*EDGE))
    measured = found.join(filed.select(*cell, *EDGE, "__feature"), cell).withColumn("__d", far)
    measured = measured.filter(F.col("__d") <= within).select(*place, "__d", "__feature")
    inside = _covering(reached.drop("__reach"), edges, ["__name"], ["__feature"], float(sizes[-1]))
    measured = measured.unionByName(inside.withColumn("__d", F.lit(0.0)))
    best = measured.groupBy(*place).agg(F.min(F.struct("__d", "__feature")).alias("__best"))
    answer = best.select(
        *place, F.col("__best.__d").alias(distance), *[F.col(f"__best.__feature.{f}").alias(f) for f in feature if f != name]
    )
    return null_safe_join(points, answer, [(name, "__name"), (x, "__x"), (y, "__y")], "inner")


def dissolve(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per feature: number of parts, box, area and centroid. The parts stay rows."""
    m, b = F.col("__m"), F.col("__b")
    shaped = parts.select(*keys, g.part_moments(F.col("rings")).alias("__m"), g.bounds(F.col("rings")).alias("__b"))
    area = F.sum(m["a"])
    some = lambda v: F.when(area != 0, v / area)
    return shaped.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("parts"),
        F.min(b["x0"]).alias("x0"),
        F.min(b["y0"]).alias("y0"),
        F.max(b["x1"]).alias("x1"),
        F.max(b["y1"]).alias("y1"),
        area.alias("area"),
        some(F.sum(m["mx"])).alias("cx"),
        some(F.sum(m["my"])).alias("cy"),
    )


def centroids(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Area centroid of each feature (planar)."""
    return dissolve(parts, keys).select(*keys, F.col("cx").alias("x"), F.col("cy").alias("y"))


def attach_geometry(summary: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Feature rows back on their parts; features without a summary are dropped."""
    return null_safe_join(parts, summary, list(keys), "inner")


BOX = ("x0", "y0", "x1", "y1")


def in_space_order(parts: DataFrame, partitions: int | None = None) -> DataFrame:
    """Parts with the box of each beside its rings, in the order of a Hilbert curve through the layer.

    Rows that are near each other come together in files and row groups, so a reader that asks for
    a window (``within_window``) skips most of them by the statistics of the box columns. The curve
    spans the extent of the layer, which is read first, from the outlines alone.
    """
    boxes = parts.withColumn("__b", g.bounds(F.col("rings")))
    boxes = boxes.withColumns({c: F.col(f"__b.{c}") for c in BOX}).drop("__b")
    x0, y0, x1, y1 = boxes.agg(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).first()
    if x0 is None:
        return boxes
    side, top = max(x1 - x0, y1 - y0) or 1.0, (1 << g.HILBERT_BITS) - 1
    at = lambda a, b, low: F.floor(((F.col(a) + F.col(b)) / 2 - F.lit(low)) / F.lit(side) * F.lit(top))
    ordered = boxes.withColumn("__at", g.hilbert(at("x0", "x1", x0), at("y0", "y1", y0)))
    ranged = ordered.repartitionByRange(partitions, "__at") if partitions else ordered.repartitionByRange("__at")
    return ranged.sortWithinPartitions("__at").drop("__at")


def within_window(parts: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Parts stored with their boxes whose box meets a window; the conditions reach the scan."""
    return parts.filter((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))


def project_parts(parts: DataFrame, projection: g.Albers, inverse: bool = False) -> DataFrame:
    return parts.withColumn("rings", g.project_rings(F.col("rings"), projection, inverse))


def project_points(points: DataFrame, projection: g.Albers, lon: str, lat: str, x: str = "x", y: str = "y") -> DataFrame:
    px, py = projection.forward(F.col(lon), F.col(lat))
    return points.withColumns({x: px, y: py})
