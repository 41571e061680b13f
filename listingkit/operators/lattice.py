"""Metric lattice clipped to area polygons, as a scanline over polygon edges.

No point x edge nested loop: each polygon edge emits the lattice rows it
crosses (``explode(sequence)``) with its crossing abscissa; per (polygon,
row) the crossings are ranked and paired into open spans; the spans of all
members on a row are united before any cell is made, so overlaps cost nothing.

A row is looked at just above (A: ylo <= y < yhi) and just below (B: ylo < y
<= yhi).  An end of a span carries, beside its abscissa, how it moves when the
row is left in that direction (the edge's slope, or minus it): ends are
ordered by both, so two members that share an edge - vertical or slanted -
join into one span, and two that only touch at a corner do not.  A point is
inside the union when it lies strictly inside a united span both above and
below: points on the union's border are out, points on edges that members
share are in, overlaps count once, hole borders are out.

Everything on a lattice row of a group - pairing, union, the meeting of above
and below - happens in one partition of it: one exchange, by (group, row).

Lattice per group: ``x_i = minx + i*dx`` for ``i < ceil((maxx + s - minx)/s)``
with ``dx = (minx + s) - minx`` (the arange rule), likewise for y; the group
bounds are those of all member vertices.  ``point_idx = i * ny + j`` keeps the
x-outer / y-inner order without a global row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from listingkit.functions import geo

COORD_DECIMALS = 5       # output degrees


def project_rings(areas: DataFrame, group_cols: list[str], decimals: int | None = None) -> DataFrame:
    """areas(polygons) -> one row per ring with projected vertices (x, y) in metres.

    Output: group cols, area_ord, poly_idx, ring_idx, ring (array<struct<x,y>>).
    ``decimals`` rounds the vertices, for results that must agree between
    engines to the last digit.
    """
    polys = areas.select(*group_cols, "area_ord",
                         F.posexplode("polygons").alias("poly_idx", "poly"))
    rings = polys.select(*group_cols, "area_ord", "poly_idx",
                         F.posexplode("poly").alias("ring_idx", "ring"))

    def to_xy(v: Column) -> Column:
        x, y = geo.project_forward(v["lon"], v["lat"])
        if decimals is not None:
            x, y = F.round(x, decimals), F.round(y, decimals)
        return F.struct(x.alias("x"), y.alias("y"))

    return rings.select(*group_cols, "area_ord", "poly_idx", "ring_idx",
                        F.transform("ring", to_xy).alias("ring"))


def group_bounds(rings: DataFrame, group_cols: list[str], spacing: float) -> DataFrame:
    """Bounds of each group's vertices and its lattice parameters (one row per group)."""
    b = rings.groupBy(*group_cols).agg(
        F.min(F.array_min(F.transform("ring", lambda v: v["x"]))).alias("minx"),
        F.max(F.array_max(F.transform("ring", lambda v: v["x"]))).alias("maxx"),
        F.min(F.array_min(F.transform("ring", lambda v: v["y"]))).alias("miny"),
        F.max(F.array_max(F.transform("ring", lambda v: v["y"]))).alias("maxy"))
    return lattice_params(b, group_cols, spacing)


def lattice_params(bounds: DataFrame, group_cols: list[str], spacing: float) -> DataFrame:
    """Add the arange-style lattice parameters to (minx, maxx, miny, maxy) bounds:
    ``n = ceil((max + s - min) / s)`` points per axis, step ``(min + s) - min``."""
    s = F.lit(float(spacing))
    return bounds.select(
        *group_cols, "minx", "maxx", "miny", "maxy",
        ((F.col("minx") + s) - F.col("minx")).alias("dx"),
        ((F.col("miny") + s) - F.col("miny")).alias("dy"),
        F.ceil((F.col("maxx") + s - F.col("minx")) / s).cast("bigint").alias("nx"),
        F.ceil((F.col("maxy") + s - F.col("miny")) / s).cast("bigint").alias("ny"))


def ring_edges(rings: DataFrame, group_cols: list[str]) -> DataFrame:
    """One row per non-horizontal ring edge (closing edge included)."""
    n = F.size("ring")
    edges = rings.select(
        *group_cols, "area_ord", "poly_idx",
        F.explode(F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.struct(F.col("ring")[i]["x"].alias("x1"), F.col("ring")[i]["y"].alias("y1"),
                               F.col("ring")[(i + 1) % n]["x"].alias("x2"),
                               F.col("ring")[(i + 1) % n]["y"].alias("y2")))).alias("e"))
    return edges.select(*group_cols, "area_ord", "poly_idx", "e.*").where(
        F.col("y1") != F.col("y2"))


PARAMS = ["minx", "dx", "nx", "miny", "dy", "ny"]


def row_crossings(edges: DataFrame, bounds: DataFrame, group_cols: list[str]) -> DataFrame:
    """(polygon, lattice row, side, crossing x, drift) for every edge/row crossing.

    An edge is taken from its lower end, whichever way its ring runs, so that
    an edge two members share gives both the same crossings.  ``drift`` is how
    the crossing moves as the row is left towards the ``side``.  The lattice
    parameters join here, once, and travel along as ``_box``."""
    up = F.col("y1") < F.col("y2")
    low, high = (F.when(up, F.struct(F.col(a[0]).alias("x"), F.col(a[1]).alias("y")))
                 .otherwise(F.struct(F.col(b[0]).alias("x"), F.col(b[1]).alias("y")))
                 for a, b in ((("x1", "y1"), ("x2", "y2")), (("x2", "y2"), ("x1", "y1"))))
    e = edges.select(*group_cols, "area_ord", "poly_idx", low.alias("_a"), high.alias("_b"))
    e = e.join(bounds.select(*group_cols, F.struct(*PARAMS).alias("_box")), group_cols)
    # one row of slack each side; the exact half-open tests below decide
    j_lo = F.greatest(F.floor((F.col("_a.y") - F.col("_box.miny")) / F.col("_box.dy")) - 1, F.lit(0))
    j_hi = F.least(F.ceil((F.col("_b.y") - F.col("_box.miny")) / F.col("_box.dy")) + 1, F.col("_box.ny") - 1)
    e = e.withColumns({"_jlo": j_lo.cast("bigint"), "_jhi": j_hi.cast("bigint")}).where(F.col("_jlo") <= F.col("_jhi"))
    rows = e.select("*", F.explode(F.sequence("_jlo", "_jhi")).alias("j"))
    rows = rows.withColumn("_y", F.col("_box.miny") + F.col("j") * F.col("_box.dy"))
    slope = (F.col("_b.x") - F.col("_a.x")) / (F.col("_b.y") - F.col("_a.y"))
    sides = F.filter(F.array(
        F.when((F.col("_a.y") <= F.col("_y")) & (F.col("_y") < F.col("_b.y")), F.struct(F.lit("A").alias("side"), slope.alias("drift"))),
        F.when((F.col("_a.y") < F.col("_y")) & (F.col("_y") <= F.col("_b.y")), F.struct(F.lit("B").alias("side"), (-slope).alias("drift")))),
        lambda c: c.isNotNull())
    cx = F.col("_a.x") + (F.col("_y") - F.col("_a.y")) * slope
    return rows.select(*group_cols, "area_ord", "poly_idx", "j", "_box", cx.alias("cx"),
                       F.explode(sides).alias("_s")).select("*", "_s.side", "_s.drift").drop("_s")


def inside_spans(crossings: DataFrame, group_cols: list[str]) -> DataFrame:
    """(group, _box, j, x_lo, x_hi): the open spans of every lattice row that lie
    strictly inside the union of the group's polygons; spans of a row are disjoint."""
    row = [*group_cols, "j"]
    end = F.struct("cx", "drift")
    # pairing: of a polygon's crossings on a row every odd one begins a span
    of_polygon = Window.partitionBy(*row, "side", "area_ord", "poly_idx").orderBy("cx", "drift")
    spans = (crossings.repartition(*row)
             .select(*row, "side", "_box", end.alias("lo"), F.lead(end).over(of_polygon).alias("hi"),
                     F.row_number().over(of_polygon).alias("_rank"))
             .where((F.col("_rank") % 2 == 1) & F.col("hi").isNotNull()))
    # union of members: a span begins an island if it starts beyond all before it
    of_side = Window.partitionBy(*row, "side").orderBy("lo", "hi")
    reach = F.max("hi").over(of_side.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("*", F.when(reach.isNull() | (F.col("lo") > reach), 1).otherwise(0).alias("_new"))
    spans = spans.select("*", F.sum("_new").over(of_side.rowsBetween(Window.unboundedPreceding, 0)).alias("_island"))
    islands = spans.groupBy(*row, "side", "_island").agg(
        F.min("lo.cx").alias("x_lo"), F.max("hi.cx").alias("x_hi"), F.any_value("_box").alias("_box"))
    # above and below: where both cover, the running number of open islands is 2
    ends = islands.select(*row, "_box", F.explode(F.array(
        F.struct(F.col("x_lo").alias("x"), F.lit(1).alias("step")),
        F.struct(F.col("x_hi").alias("x"), F.lit(-1).alias("step")))).alias("_e")).select(*row, "_box", "_e.x", "_e.step")
    along = Window.partitionBy(*row).orderBy("x", "step")
    ends = ends.select(*row, "_box", F.col("x").alias("x_lo"), F.lead("x").over(along).alias("x_hi"),
                       F.sum("step").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("_open"))
    return ends.where((F.col("_open") == 2) & (F.col("x_lo") < F.col("x_hi"))).select(*row, "_box", "x_lo", "x_hi")


def inside_points(crossings: DataFrame, group_cols: list[str]) -> DataFrame:
    """Lattice cells (group, _box, i, j) strictly inside the union of member
    polygons, each once: spans of a row are disjoint, so cells need no dedupe."""
    sp = inside_spans(crossings, group_cols)
    i_lo = F.greatest(F.floor((F.col("x_lo") - F.col("_box.minx")) / F.col("_box.dx")) - 1, F.lit(0))
    i_hi = F.least(F.ceil((F.col("x_hi") - F.col("_box.minx")) / F.col("_box.dx")) + 1, F.col("_box.nx") - 1)
    sp = sp.withColumns({"_ilo": i_lo.cast("bigint"), "_ihi": i_hi.cast("bigint")}).where(F.col("_ilo") <= F.col("_ihi"))
    cells = sp.select(*group_cols, "_box", "j", "x_lo", "x_hi", F.explode(F.sequence("_ilo", "_ihi")).alias("i"))
    x = F.col("_box.minx") + F.col("i") * F.col("_box.dx")
    return cells.where((F.col("x_lo") < x) & (x < F.col("x_hi"))).select(*group_cols, "_box", "i", "j")


def lattice_in_areas(areas: DataFrame, spacing: float, group_cols: list[str],
                     with_xy: bool = False, vertex_decimals: int | None = None) -> DataFrame:
    """Lattice points inside each group's union of polygons, in degrees.

    Output: group cols, point_idx, latitude, longitude (rounded to 5 decimals),
    plus x, y (metres) when ``with_xy``.
    """
    if spacing <= 0:
        raise ValueError("spacing must be positive")
    rings = project_rings(areas, group_cols, vertex_decimals)
    bounds = group_bounds(rings, group_cols, spacing)
    cells = inside_points(row_crossings(ring_edges(rings, group_cols), bounds, group_cols), group_cols)
    pts = cells.select(*group_cols, (F.col("i") * F.col("_box.ny") + F.col("j")).alias("point_idx"),
                       (F.col("_box.minx") + F.col("i") * F.col("_box.dx")).alias("x"),
                       (F.col("_box.miny") + F.col("j") * F.col("_box.dy")).alias("y"))
    pts = geo.with_inverse(pts, "x", "y", "_lon", "_lat")
    return pts.select(*group_cols, "point_idx",
                      F.round("_lat", COORD_DECIMALS).alias("latitude"),
                      F.round("_lon", COORD_DECIMALS).alias("longitude"),
                      *(["x", "y"] if with_xy else []))


def bare_lattice(bounds: DataFrame, group_cols: list[str]) -> DataFrame:
    """Every lattice cell of each group's bounding box (x outer, y inner).

    Columns are exploded first (nx rows per group), spread over the cluster,
    then each column explodes its ny rows, so no task expands a whole box.
    """
    cols = (bounds.select(*group_cols, "minx", "miny", "dx", "dy", "ny",
                          F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("nx") - 1))
                          .alias("i"))
            .repartition(*group_cols, "i"))
    cells = cols.select(*group_cols, "minx", "miny", "dx", "dy", "ny", "i",
                        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("ny") - 1))
                        .alias("j"))
    return cells.select(*group_cols, (F.col("i") * F.col("ny") + F.col("j")).alias("point_idx"),
                        (F.col("minx") + F.col("i") * F.col("dx")).alias("x"),
                        (F.col("miny") + F.col("j") * F.col("dy")).alias("y"))
