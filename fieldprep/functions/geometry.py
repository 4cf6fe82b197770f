"""Planar geometry on ring arrays.

A polygon part is ``array<array<struct<x,y>>>``: the first ring is the outline, the
others are holes. Rings may be closed or open. Features with several parts are
several rows, so no group of parts ever has to be gathered into one value.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


@dataclass(frozen=True)
class Albers:
    """Equal-area conic projection (Snyder 1987, ellipsoidal form)."""

    lat0: float
    lon0: float
    lat1: float
    lat2: float
    false_x: float
    false_y: float
    a: float = 6378137.0
    flattening: float = 1 / 298.257222101

    @property
    def e2(self) -> float:
        return self.flattening * (2 - self.flattening)

    def _q(self, lat: float) -> float:
        e, s = math.sqrt(self.e2), math.sin(math.radians(lat))
        return (1 - self.e2) * (s / (1 - self.e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def _m2(self, lat: float) -> float:
        s = math.sin(math.radians(lat))
        return (1 - s * s) / (1 - self.e2 * s * s)

    @property
    def n(self) -> float:
        return (self._m2(self.lat1) - self._m2(self.lat2)) / (self._q(self.lat2) - self._q(self.lat1))

    @property
    def c(self) -> float:
        return self._m2(self.lat1) + self.n * self._q(self.lat1)

    @property
    def rho0(self) -> float:
        return self.a * math.sqrt(self.c - self.n * self._q(self.lat0)) / self.n

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Degrees to metres."""
        e, n = math.sqrt(self.e2), self.n
        s = F.sin(F.radians(lat))
        es = s * F.lit(e)
        q = (s / (1 - es * es) - F.log((1 - es) / (1 + es)) / F.lit(2 * e)) * F.lit(1 - self.e2)
        rho = F.sqrt(F.lit(self.c) - q * F.lit(n)) * F.lit(self.a / n)
        theta = F.radians(lon - F.lit(self.lon0)) * F.lit(n)
        return F.lit(self.false_x) + rho * F.sin(theta), F.lit(self.false_y + self.rho0) - rho * F.cos(theta)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Metres to degrees (authalic-latitude series)."""
        e, n, e2 = math.sqrt(self.e2), self.n, self.e2
        dx, dy = x - F.lit(self.false_x), F.lit(self.rho0 + self.false_y) - y
        rho2 = dx * dx + dy * dy
        q = (F.lit(self.c) - rho2 * F.lit(n * n / (self.a * self.a))) / F.lit(n)
        pole = 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))
        beta = F.asin(q / F.lit(pole))
        e4, e6 = e2**2, e2**3
        lat = (
            beta
            + F.sin(beta * 2) * F.lit(e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040)
            + F.sin(beta * 4) * F.lit(23 * e4 / 360 + 251 * e6 / 3780)
            + F.sin(beta * 6) * F.lit(761 * e6 / 45360)
        )
        lon = F.lit(self.lon0) + F.degrees(F.atan2(dx, dy) / F.lit(n))
        return lon, F.degrees(lat)


# The provincial equal-area grid, EPSG 3005 on GRS80.
PROVINCIAL_GRID = Albers(lat0=45.0, lon0=-126.0, lat1=50.0, lat2=58.5, false_x=1_000_000.0, false_y=0.0)


def ring_of(*corners: tuple[Column | float, Column | float]) -> Column:
    """A ring from corner coordinates."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.array(*[F.struct(as_col(x).cast("double").alias("x"), as_col(y).cast("double").alias("y")) for x, y in corners])


def box(x0, y0, x1, y1) -> Column:
    """Axis-parallel rectangle as a one-ring part."""
    return F.array(ring_of((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)))


def project_rings(rings: Column, projection: Albers, inverse: bool = False) -> Column:
    move = projection.inverse if inverse else projection.forward

    def moved(p: Column) -> Column:
        x, y = move(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, moved))


def edges(rings: Column) -> Column:
    """All edges of all rings; open rings are closed, empty ones skipped."""

    def ring_edges(ring: Column) -> Column:
        following = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        )

    return F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), ring_edges))


def bounds(rings: Column) -> Column:
    """struct(x0, y0, x1, y1) of the outline."""
    xs = lambda f: F.transform(rings[0], lambda p: p[f])
    return F.struct(
        F.array_min(xs("x")).alias("x0"),
        F.array_min(xs("y")).alias("y0"),
        F.array_max(xs("x")).alias("x1"),
        F.array_max(xs("y")).alias("y1"),
    )


def on_edge(x: Column, y: Column, e: Column) -> Column:
    """Whether a point lies on an edge, its ends included."""
    cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    return (
        (cross == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    )


def crosses(x: Column, y: Column, e: Column) -> Column:
    """1 where the ray from a point towards greater x crosses an edge, else 0."""
    spans = (e["y1"] > y) != (e["y2"] > y)
    # CASE keeps the division away from level edges.
    at = F.when(spans, e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"]))
    return F.when(x < at, 1).otherwise(0)


def covers(edge_array: Column, x: Column, y: Column) -> Column:
    """Point in polygon by the even-odd rule; a point on an edge counts as inside."""
    crossings = F.aggregate(edge_array, F.lit(0), lambda acc, e: acc + crosses(x, y, e))
    return (crossings % 2 == 1) | F.exists(edge_array, lambda e: on_edge(x, y, e))


def _edge_distance2(x: Column, y: Column, e: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    length2 = dx * dx + dy * dy
    along = F.when(length2 > 0, ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / length2).otherwise(F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex, ey = e["x1"] + t * dx - x, e["y1"] + t * dy - y
    return ex * ex + ey * ey


def edge_distance(x: Column, y: Column, e: Column) -> Column:
    return F.sqrt(_edge_distance2(x, y, e))


def distance(edge_array: Column, x: Column, y: Column) -> Column:
    """0 inside, else the distance to the closest edge."""
    closest = F.array_min(F.transform(edge_array, lambda e: _edge_distance2(x, y, e)))
    return F.when(covers(edge_array, x, y), F.lit(0.0)).otherwise(F.sqrt(closest))


def box_distance_bounds(b: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Least and greatest possible distance from a point to something inside a box."""
    dx = F.greatest(b["x0"] - x, F.lit(0.0), x - b["x1"])
    dy = F.greatest(b["y0"] - y, F.lit(0.0), y - b["y1"])
    fx = F.greatest(F.abs(x - b["x0"]), F.abs(x - b["x1"]))
    fy = F.greatest(F.abs(y - b["y0"]), F.abs(y - b["y1"]))
    return F.sqrt(dx * dx + dy * dy), F.sqrt(fx * fx + fy * fy)


def _add_moment(acc: Column, e: Column, ox: Column, oy: Column) -> Column:
    x1, y1, x2, y2 = e["x1"] - ox, e["y1"] - oy, e["x2"] - ox, e["y2"] - oy
    w = x1 * y2 - x2 * y1
    return F.struct(
        (acc["a"] + w).alias("a"), (acc["mx"] + (x1 + x2) * w).alias("mx"), (acc["my"] + (y1 + y2) * w).alias("my")
    )


def _nothing() -> Column:
    return F.struct(*[F.lit(0.0).alias(f) for f in ("a", "mx", "my")])


def part_moments(rings: Column) -> Column:
    """struct(a, mx, my): outline minus holes. Sums over parts give area and centroid.

    Ring directions do not matter. Coordinates are taken relative to a ring's first corner to
    keep the products small. Each step feeds the next once, so nothing is worked out twice.
    """

    def raw(ring: Column, i: Column) -> Column:
        ox, oy = ring[0]["x"], ring[0]["y"]
        summed = F.aggregate(edges(F.array(ring)), _nothing(), lambda acc, e: _add_moment(acc, e, ox, oy))
        return F.struct(summed.alias("s"), ox.alias("ox"), oy.alias("oy"), F.when(i == 0, 1.0).otherwise(-1.0).alias("hole"))

    def signed(t: Column) -> Column:
        turn = F.when(t["s"]["a"] < 0, F.lit(-1.0)).otherwise(F.lit(1.0)) * t["hole"]
        area = t["s"]["a"] * turn / 2
        return F.struct(
            area.alias("a"),
            (t["s"]["mx"] * turn / 6 + area * t["ox"]).alias("mx"),
            (t["s"]["my"] * turn / 6 + area * t["oy"]).alias("my"),
        )

    real = F.filter(rings, lambda r: F.size(r) > 0)
    plus = lambda acc, m: F.struct(*[(acc[f] + m[f]).alias(f) for f in ("a", "mx", "my")])
    return F.aggregate(F.transform(F.transform(real, raw), signed), _nothing(), plus)


HILBERT_BITS = 16


def hilbert(x: Column, y: Column, bits: int = HILBERT_BITS) -> Column:
    """The place along the Hilbert curve of a cell (x, y), two whole numbers of so many bits."""
    big = lambda v: F.lit(v).cast("bigint")
    start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), big(0).alias("d"))

    def step(acc: Column, s: Column) -> Column:
        right, up = acc["x"].bitwiseAND(s) > 0, acc["y"].bitwiseAND(s) > 0
        quarter = F.when(right & up, big(2)).when(right, big(3)).when(up, big(1)).otherwise(big(0))
        flip = lambda v: F.when(right, big((1 << bits) - 1) - v).otherwise(v)
        return F.struct(
            F.when(up, acc["x"]).otherwise(flip(acc["y"])).alias("x"),
            F.when(up, acc["y"]).otherwise(flip(acc["x"])).alias("y"),
            (acc["d"] + s * s * quarter).alias("d"),
        )

    sides = F.array(*[big(1 << b) for b in range(bits - 1, -1, -1)])
    return F.aggregate(sides, start, step, lambda acc: acc["d"])
