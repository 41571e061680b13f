"""Listing field expressions (all Catalyst, no Python on the row path).

Each function takes and returns ``Column`` objects so callers compose them in
``select``/``withColumn``; whole-stage codegen keeps them in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listingkit import constants as K

ColumnOrName = Column | str

# Python's str.isspace() set, as a Java regex class: Java's \s lacks
# U+001C-U+001F, U+0085 and the Unicode space separators that Python strips.
PY_SPACE = ("[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029"
            "\\u202f\\u205f\\u3000]")

# --- fixed values: link and rating patterns ---------------------------------
LINK_COORDS_RE = "!3d([-0-9.]+)!4d([-0-9.]+)"
PLACE_ID_RE = "(ChIJ[^?]+)"
RATING_RE = "([0-9.]+)\\(([0-9]+)\\)"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c: ColumnOrName) -> Column:
    """``str.strip()``: trim Python whitespace at both ends (null stays null)."""
    return F.regexp_replace(_c(c), f"^{PY_SPACE}+|{PY_SPACE}+$", "")


def coerce_double(c: ColumnOrName) -> Column:
    """Numeric coercion where bad text becomes null (``errors='coerce'``)."""
    return _c(c).try_cast("double")


def link_coords(link: ColumnOrName) -> tuple[Column, Column]:
    """(lat, lon) from the first ``!3d<lat>!4d<lon>`` of a place link.

    No match or a non-number (``1.2.3``) gives null; callers skip such rows.
    """
    link = _c(link)
    found = F.regexp_extract(link, LINK_COORDS_RE, 0)     # one search gives both
    lat = F.substring_index(F.replace(found, F.lit("!3d"), F.lit("")), "!4d", 1).try_cast("double")
    lon = F.substring_index(found, "!4d", -1).try_cast("double")
    both = lat.isNotNull() & lon.isNotNull()
    return F.when(both, lat), F.when(both, lon)


def place_id(link: ColumnOrName) -> Column:
    """First ``ChIJ...`` run up to ``?`` or the end; null when absent."""
    return F.nullif(F.regexp_extract(_c(link), PLACE_ID_RE, 1), F.lit(""))


def rating_split(rating: ColumnOrName) -> tuple[Column, Column]:
    """``4.5(12)`` -> (rating double or null, num_rating bigint defaulting to 0)."""
    r = _c(rating)
    value = F.regexp_extract(r, RATING_RE, 1).try_cast("double")
    count = F.coalesce(F.regexp_extract(r, RATING_RE, 2).try_cast("bigint"),
                       F.lit(0).cast("bigint"))
    return value, count


def price_choice(label: ColumnOrName, spans: ColumnOrName) -> Column:
    """Icon aria-label if present, else the first span text starting with the
    currency symbol, else ''."""
    first_price = F.get(F.filter(_c(spans), lambda x: x.startswith(K.PRICE_SYMBOL)), 0)
    return F.coalesce(_c(label), first_price, F.lit(""))


def category_clean(c: ColumnOrName) -> Column:
    """Drop every digit run, strip the ends (inner double spaces stay)."""
    return F.coalesce(py_strip(F.regexp_replace(_c(c), "\\p{Nd}+", "")), F.lit(""))


def address_clean(spans: ColumnOrName) -> Column:
    """Last direct span minus its leading dots/space when >=2 spans, else ''."""
    s = _c(spans)
    return F.when(F.size(s) >= 2,
                  F.regexp_replace(F.element_at(s, -1), f"^(?:·|{PY_SPACE})+", "")
                  ).otherwise(F.lit(""))


def request_url(keyword: ColumnOrName, lat: ColumnOrName, lon: ColumnOrName,
                radius_m: int | Column, base: str = K.SEARCH_BASE_URL,
                suffix: str = K.SEARCH_URL_SUFFIX) -> Column:
    """Search URL for a job; keyword encoded like ``quote_plus``.

    Java's form encoder differs from ``quote_plus`` only on ``*`` (kept) and
    ``~`` (escaped), fixed up here.  Coordinates use Spark's shortest double
    text, equal to Python's for |x| >= 1e-3.
    """
    enc = F.replace(F.replace(F.url_encode(_c(keyword)), F.lit("*"), F.lit("%2A")),
                    F.lit("%7E"), F.lit("~"))
    rad = radius_m if isinstance(radius_m, Column) else F.lit(int(radius_m))
    return F.concat(F.lit(base), enc, F.lit("/@"), _c(lat).cast("string"), F.lit(","),
                    _c(lon).cast("string"), F.lit(","), rad.cast("string"),
                    F.lit("m"), F.lit(suffix))
