"""Fixed schemas for every table the pipelines read or write."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


VERTEX = _struct(("lon", D), ("lat", D))
RING = T.ArrayType(VERTEX)
POLYGON = T.ArrayType(RING)            # ring 0 = shell, others = holes
MULTIPOLYGON = T.ArrayType(POLYGON)

AREAS = _struct(("area_ord", I), ("area_code", S), ("area_name", S),
                ("polygons", MULTIPOLYGON))
NAME_MAP = _struct(("ord", I), ("raw_name", S), ("clean_name", S))
KEYWORDS = _struct(("kw_idx", I), ("keyword", S))
GRID = _struct(("point_idx", L), ("latitude", D), ("longitude", D))
JOBS = _struct(("job_idx", L), ("latitude", D), ("longitude", D), ("keyword", S))
FAILED_JOBS = _struct(("job_idx", L), ("latitude", D), ("longitude", D),
                      ("keyword", S), ("reason", S))
PAGES = _struct(("page_id", L), ("job_idx", L), ("html", S))

# Raw listing as extracted from a result card; (job_idx, page_id, pos) is the
# capture order that every later keep-first / id step relies on.
RAW_LISTINGS = _struct(
    ("job_idx", L), ("page_id", L), ("pos", L),
    ("latitude", D), ("longitude", D), ("keyword", S), ("name", S),
    ("link", S), ("rating", S), ("price", S), ("category", S), ("address", S),
    ("amenities", T.ArrayType(S)))

# Order of the processed listing columns (fixed values of the output format).
LISTING_COLUMNS = ["num_id", "prop_id", "latitude", "longitude", "keyword", "name",
                   "link", "num_rating", "rating", "price", "category", "address"]

LISTINGS = _struct(
    ("num_id", L), ("prop_id", S), ("latitude", D), ("longitude", D),
    ("keyword", S), ("name", S), ("link", S), ("num_rating", L), ("rating", D),
    ("price", S), ("category", S), ("address", S))
AMENITIES = _struct(("prop_id", S), ("amenity", S))

# Result CSV as written by a merge pass (amenities kept as a literal list text).
RESULTS_CSV = _struct(
    ("latitude", D), ("longitude", D), ("keyword", S), ("name", S), ("link", S),
    ("rating", S), ("price", S), ("category", S), ("address", S), ("amenities", S))
