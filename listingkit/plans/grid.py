"""Area pipelines: name repair (P1), lattice grid (P2), search jobs (P3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingkit import constants as K
from listingkit.operators import areas as A
from listingkit.operators import jobs as J
from listingkit.operators import lattice as L
from listingkit.operators import ordering as O
from listingkit.session import ensure_checkpoint_dir
from listingkit.sources import io


def clean_areas(areas: DataFrame, clean_names: Mapping[str, str] = K.CLEAN_NAMES,
                col: str | None = None, out_path: str | None = None) -> DataFrame:
    """Add ``cleaned_name`` to a boundary table; optionally persist it."""
    if out_path:                          # the write itself finds out whether there are rows
        cleaned = A.canonical_names(areas, clean_names, col)
        return io.write_table(cleaned, out_path, "overwrite", "parquet", non_empty=True)
    io.require(areas, what="boundary table")
    return A.canonical_names(areas, clean_names, col)


def build_grid(areas: DataFrame, key: str, by: str = "name",
               spacing: float = K.DEFAULT_RADIUS_M * K.LATTICE_SPACING_FACTOR,
               label: str | None = None, code: str = "area_code",
               vertex_decimals: int | None = None) -> tuple[DataFrame, str]:
    """Lattice points inside the union of the selected area rows.

    Returns ``(grid, city_name)``; grid columns ``point_idx, latitude, longitude``
    in x-outer / y-inner lattice order (``point_idx`` increasing).  The selected
    rows are written once; the label and the lattice are made from them.
    """
    label = label or A.label_column(areas.columns, "area_name")
    ensure_checkpoint_dir(areas.sparkSession)
    found = A.matching_areas(areas, key, by, label, code)
    selected = A.some_areas(found.withColumn("_grid", F.lit(0)).checkpoint(), key)
    city = A.first_label(selected, label)
    pts = L.lattice_in_areas(selected, spacing, ["_grid"], vertex_decimals=vertex_decimals)
    return pts.select("point_idx", "latitude", "longitude"), city


def grid_by_area(areas: DataFrame, spacing: float, group_col: str = "area_code",
                 vertex_decimals: int | None = None) -> DataFrame:
    """Lattice points for every area at once (one lattice per ``group_col`` value)."""
    return L.lattice_in_areas(areas, spacing, [group_col], vertex_decimals=vertex_decimals)


def make_jobs(grid: DataFrame, keywords: Sequence[str] = K.KEYWORDS,
              out_path: str | None = None, if_exists: str = "keep") -> DataFrame:
    """Validated grid x keywords; with ``out_path`` the job table is persisted
    (an existing table is kept and used unless ``if_exists='overwrite'``), and
    a grid without points is found out by that write, not by a look before it."""
    io.require(grid, ["latitude", "longitude"], non_empty=not out_path, what="grid")
    if "point_idx" not in grid.columns:
        grid = O.assign_ids(grid, ["longitude", "latitude"], "point_idx", start=0)
    jobs = J.generate_jobs(grid, keywords)
    if out_path:
        return io.write_table(jobs, out_path, if_exists=if_exists, fmt="parquet", non_empty=True)
    return jobs
