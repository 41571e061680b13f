"""Lattice, scanline containment and the projection pair."""

import random

import pytest
from pyspark.sql import functions as F

from listingkit.functions import geo
from listingkit.operators import lattice as L

# Ten consecutive lattice points of an 800 m grid (degrees, 5 decimals).
GRID_POINTS = [(-25.34371, -57.66687), (-25.3365, -57.66665), (-25.3293, -57.66643),
               (-25.32209, -57.66622), (-25.31488, -57.666), (-25.30768, -57.66578),
               (-25.30047, -57.66556), (-25.29326, -57.66535), (-25.28606, -57.66513),
               (-25.27885, -57.66491)]

RING_SCHEMA = "g int, area_ord int, poly_idx int, ring_idx int, ring array<struct<x:double,y:double>>"


def _rings(spark, polys):
    """polys: list of (area_ord, poly_idx, [ring0, ring1...]) with rings as [(x, y)]."""
    rows = []
    for ao, pi, rings in polys:
        for ri, ring in enumerate(rings):
            rows.append((0, ao, pi, ri, [{"x": float(x), "y": float(y)} for x, y in ring]))
    return spark.createDataFrame(rows, RING_SCHEMA)


def _inside(spark, polys, step=1.0):
    rings = _rings(spark, polys)
    b = L.group_bounds(rings, ["g"], step)
    cells = L.inside_points(L.row_crossings(L.ring_edges(rings, ["g"]), b, ["g"]), ["g"])
    mn = b.first()
    return {(mn.minx + r.i * mn.dx, mn.miny + r.j * mn.dy) for r in cells.collect()}


def rect(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]


def test_lattice_axis(spark):
    b = spark.createDataFrame([(0, 0.0, 10.0, 0.0, 9.0)], "g int, minx double, maxx double, "
                              "miny double, maxy double")
    p = L.lattice_params(b, ["g"], 3.0).first()
    assert (p.nx, p.ny) == (5, 4)          # 0,3,6,9,12 and 0,3,6,9
    cells = L.bare_lattice(L.lattice_params(b, ["g"], 3.0), ["g"]).collect()
    assert sorted({c.x for c in cells}) == [0, 3, 6, 9, 12]
    assert sorted({c.y for c in cells}) == [0, 3, 6, 9]


def test_rectangle_border_out(spark):
    got = _inside(spark, [(0, 0, [rect(0, 0, 4, 4)])])
    assert got == {(x, y) for x in (1, 2, 3) for y in (1, 2, 3)}


def test_hole(spark):
    got = _inside(spark, [(0, 0, [rect(0, 0, 6, 6), rect(2, 2, 4, 4)])])
    want = {(x, y) for x in range(1, 6) for y in range(1, 6)} - \
        {(x, y) for x in (2, 3, 4) for y in (2, 3, 4)}
    assert got == want


def test_l_shape_reflex_vertex_out(spark):
    got = _inside(spark, [(0, 0, [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]])])
    assert got == {(1, 1), (1, 2), (1, 3), (2, 1), (3, 1)}


def test_overlap_is_union(spark):
    got = _inside(spark, [(0, 0, [rect(0, 0, 4, 2)]), (1, 0, [rect(2, 0, 6, 2)])])
    assert got == {(x, 1) for x in range(1, 6)}


def test_shared_horizontal_edge_in(spark):
    got = _inside(spark, [(0, 0, [rect(0, 0, 4, 2)]), (1, 0, [rect(0, 2, 4, 4)])])
    assert got == {(x, y) for x in (1, 2, 3) for y in (1, 2, 3)}


def test_shared_vertical_edge_in(spark):
    got = _inside(spark, [(0, 0, [rect(0, 0, 2, 4)]), (1, 0, [rect(2, 0, 4, 4)])])
    assert got == {(x, y) for x in (1, 2, 3) for y in (1, 2, 3)}


def test_shared_edge_of_part_of_the_height(spark):
    # x=2 is shared from y=1 to y=3 only: above and below it is border
    got = _inside(spark, [(0, 0, [rect(0, 0, 2, 4)]), (1, 0, [rect(2, 1, 4, 3)])])
    assert got == {(1, 1), (1, 2), (1, 3), (2, 2), (3, 2)}


def test_shared_slanted_edge_in(spark):
    low, high = [(0, 0), (4, 0), (4, 4)], [(4, 4), (0, 4), (0, 0)]          # the square cut along x = y
    assert _inside(spark, [(0, 0, [low]), (1, 0, [high])]) == {(x, y) for x in (1, 2, 3) for y in (1, 2, 3)}


def test_corners_that_touch_stay_out(spark):
    diamond = lambda x: [(x, 2), (x + 2, 0), (x + 4, 2), (x + 2, 4)]        # noqa: E731
    got = _inside(spark, [(0, 0, [diamond(0)]), (1, 0, [diamond(4)])])
    assert (4, 2) not in got and {(2, 1), (1, 2), (3, 2), (5, 2), (6, 3)} <= got
    squares = _inside(spark, [(0, 0, [rect(0, 0, 2, 2)]), (1, 0, [rect(2, 2, 4, 4)])])
    assert squares == {(1, 1), (3, 3)}


def test_union_needs_no_exchange_of_cells(spark):
    rings = _rings(spark, [(0, 0, [rect(0, 0, 4, 4)]), (1, 0, [rect(2, 0, 6, 4)])])
    b = L.group_bounds(rings, ["g"], 1.0)
    cells = L.inside_points(L.row_crossings(L.ring_edges(rings, ["g"]), b, ["g"]), ["g"])
    plan = cells._jdf.queryExecution().executedPlan().toString()
    rows = [ln for ln in plan.splitlines() if "Exchange hashpartitioning" in ln and ", j#" in ln]
    assert len(rows) == 1 and "i#" not in rows[0]


def _probed(polys, p, step=1e-5):
    """Inside a union: the four points beside it, diagonally, are each in some
    member by plain even-odd parity (no rule for borders is needed)."""
    def parity(rings, x, y):
        n = 0
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                n += (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)
        return n % 2 == 1
    return all(any(parity(rings, p[0] + dx, p[1] + dy) for _, _, rings in polys) for dx in (-step, step) for dy in (-step, step))


@pytest.mark.parametrize("seed", range(6))
def test_union_equals_probes(spark, seed):
    """Members on a coarse grid, so that they share edges, corners and parts of them."""
    random.seed(seed)
    polys = []
    for k in range(7):
        x, y, w, h = random.randint(0, 6), random.randint(0, 6), random.randint(1, 4), random.randint(1, 4)
        ring = rect(x, y, x + w, y + h)
        if k % 3 == 1:
            ring = ring[:3]                                                # a triangle along the diagonal
        if k % 3 == 2 and k % 2:
            ring = ring[::-1]
        polys.append((k, 0, [ring] + ([rect(x + 1, y + 1, x + 2, y + 2)] if k % 3 == 0 and w > 2 and h > 2 else [])))
    got = _inside(spark, polys, 1.0)
    xs = [v[0] for _, _, rings in polys for r in rings for v in r]
    ys = [v[1] for _, _, rings in polys for r in rings for v in r]
    pts = {(float(x), float(y)) for x in range(min(xs), max(xs) + 2) for y in range(min(ys), max(ys) + 2)}
    assert got == {p for p in pts if _probed(polys, p)}


def _brute(poly_rings, pts):
    """Strict interior by parity under both half-open conventions (one polygon)."""
    def inside(px, py, conv):
        lt = eq = 0
        for ring in poly_rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if y1 == y2:
                    continue
                lo, hi = min(y1, y2), max(y1, y2)
                ok = (lo <= py < hi) if conv == "A" else (lo < py <= hi)
                if ok:
                    cx = x1 + (py - y1) * (x2 - x1) / (y2 - y1)
                    lt += cx < px
                    eq += cx == px
        return lt % 2 == 1 and eq == 0
    return {p for p in pts if inside(*p, "A") and inside(*p, "B")}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scanline_equals_brute_force(spark, seed):
    random.seed(seed)
    # star-shaped random polygon on integer coordinates
    import math
    n = random.randint(5, 11)
    ring = [(round(10 + random.uniform(3, 9) * math.cos(2 * math.pi * k / n)),
             round(10 + random.uniform(3, 9) * math.sin(2 * math.pi * k / n))) for k in range(n)]
    got = _inside(spark, [(0, 0, [ring])])
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    pts = {(float(x), float(y)) for x in range(min(xs), max(xs) + 2)
           for y in range(min(ys), max(ys) + 2)}
    assert got == _brute(ring and [ring], pts)


def test_projection_grid_spacing_and_round_trip(spark):
    df = spark.createDataFrame(GRID_POINTS, "latitude double, longitude double")
    x, y = geo.project_forward("longitude", "latitude")
    df = df.select("latitude", "longitude", x.alias("x"), y.alias("y"))
    rows = geo.with_inverse(df, "x", "y", "lon2", "lat2").orderBy("latitude").collect()
    xs = [r.x for r in rows]
    assert max(xs) - min(xs) < 1.0                       # one lattice column
    steps = [b.y - a.y for a, b in zip(rows, rows[1:])]
    assert all(799.0 < s < 801.0 for s in steps)         # 0.8 x 1000 m, 5-decimal rounding
    for r in rows:
        assert abs(r.lon2 - r.longitude) < 1e-9 and abs(r.lat2 - r.latitude) < 1e-9


def test_lattice_in_areas_degrees(spark):
    ring = [{"lon": lo, "lat": la} for lo, la in
            [(-57.70, -25.36), (-57.62, -25.36), (-57.62, -25.28), (-57.70, -25.28)]]
    areas = spark.createDataFrame([(0, "A", [[ring]])],
                                  "area_ord int, area_code string, "
                                  "polygons array<array<array<struct<lon:double,lat:double>>>>")
    pts = L.lattice_in_areas(areas, 800.0, ["area_code"]).collect()
    assert 60 < len(pts) < 130                           # ~8.9 km x 8.1 km at 800 m
    assert all(-25.36 < p.latitude < -25.28 and -57.70 < p.longitude < -57.62 for p in pts)
    assert len({p.point_idx for p in pts}) == len(pts)


def test_derived_areas_beyond_the_pole(spark, tmp_path):
    """Many suppliers lay areas out past -90 degrees: they are read whole, while
    boundary files with such corners still fail."""
    from listingkit.operators import areas as A
    from listingkit.sources import io
    from listingkit.sources import testdata as td
    keys = [1, 14_000, 15_000, 60_000]
    spark.createDataFrame([(k, k % 2) for k in keys], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(0, "A"), (1, "B")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    areas = td.landed_areas(spark, str(tmp_path))
    assert sorted(r.area_ord for r in areas.collect()) == keys
    assert A.area_listing(areas, "area_name", "area_code").count() == 2
    assert {r.area_code for r in L.lattice_in_areas(areas, 800.0, ["area_code"]).collect()} == {"PY00", "PY01"}
    areas.write.parquet(f"{tmp_path}/file")
    with pytest.raises(Exception, match="finite"):
        io.read_boundaries(spark, f"{tmp_path}/file").collect()
