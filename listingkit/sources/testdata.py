"""Pipeline inputs derived from the driver's TPC-H-style tables.

The driver tables hold no coordinates, boundaries or result pages, so they
are derived with integer/string arithmetic that grows with the scale factor:

  customer            -> grid points (one lattice point per customer)
  orders + lineitem   -> first-pass captured result pages (an order's lines
                         are the result cards of one page; 'P' orders have an
                         empty page besides)
  events              -> retry-pass captured pages (one card per event)
  supplier + nation   -> area boundaries (one polygon per supplier, grouped
                         into areas by nation)
  part                -> amenity literals (CSV form)
  documents, pages    -> free text and raw web pages

Every derivation below is *portable SQL*: the same text runs in Spark SQL
and in DuckDB (``{table}`` placeholders are filled with view names), so the
oracle sees exactly the rows Spark builds.  Rules that keep it portable:
integer division as ``cast(floor(a / b) as bigint)``, string casts of
integers only (never of doubles), and doubles built by dividing an integer
by ``1000000.0``.
"""

from __future__ import annotations

import hashlib
import re
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingkit import constants as K
from listingkit.session import shuffles_removed
from listingkit.sources.io import read_boundaries
from listingkit.operators.layouts import LayoutSpec, Part, Pick, Rule

NBSP, ZWSP = " ", "​"

# --- derivation parameters (micro-degrees) ----------------------------------
GRID_COLS = 128                 # customers per lattice row
LAT0_U, LON0_U = 25_000_000, 57_000_000   # south / west, as positive magnitudes
DLAT_U, DLON_U = 7_200, 7_950   # ~800 m steps at 25 S
SPREAD_U = 12_000               # places lie within +-0.012 deg of their point
PLACES_PER_POINT = 64
CARDS_PER_PAGE = 8

#: Every POINT_NULL-th point has no latitude, the one after it NaN; every
#: PLACE_NOWHERE-th place has a link without coordinates, every PLACE_ACCENT-th
#: an accented letter in its link.
POINT_NULL, PLACE_NOWHERE, PLACE_ACCENT = 97, 29, 13

GRID_SQL = f"""
select c_custkey as point_idx,
  case when c_custkey % {POINT_NULL} = 0 then cast(null as double)
       when c_custkey % {POINT_NULL} = 1 then cast('NaN' as double) else
  cast(-({LAT0_U} + cast(floor(c_custkey / {GRID_COLS}) as bigint) * {DLAT_U}) as double)
    / 1000000.0 end as latitude,
  cast(-({LON0_U} + (c_custkey % {GRID_COLS}) * {DLON_U}) as double) / 1000000.0 as longitude
from {{customer}}
"""

# One row per result card.  va/vb/qty/f1/f2 are the per-card variant inputs.
PASS1_SPEC_SQL = f"""
select o.o_orderkey * 16 + cast(floor(l.r / {CARDS_PER_PAGE}) as bigint) as page_id,
  o.o_custkey * {len(K.KEYWORDS)} + o.o_orderkey % {len(K.KEYWORDS)} as job_idx,
  cast(l.r % {CARDS_PER_PAGE} as bigint) as pos,
  o.o_custkey as point_key,
  o.o_custkey * {PLACES_PER_POINT} + l.l_partkey % {PLACES_PER_POINT} as place_key,
  l.l_partkey as va, l.l_suppkey as vb, cast(l.l_linenumber as bigint) as vc,
  cast(l.l_quantity as bigint) as qty, l.l_returnflag as f1, l.l_linestatus as f2
from (select *, row_number() over (partition by l_orderkey
                                   order by l_linenumber, l_partkey, l_suppkey) - 1 as r
      from {{lineitem}}) l
join {{orders}} o on l.l_orderkey = o.o_orderkey
"""

# 'P' orders have one page more, which shows an empty result panel (no anchors).
PASS1_EMPTY_PAGES_SQL = f"""
select o_orderkey * 16 + 15 as page_id,
  o_custkey * {len(K.KEYWORDS)} + o_orderkey % {len(K.KEYWORDS)} as job_idx
from {{orders}} where o_orderstatus = 'P'
"""

RETRY_SPEC_SQL = f"""
select event_id as page_id,
  user_id * {len(K.KEYWORDS)} + event_id % {len(K.KEYWORDS)} as job_idx,
  cast(0 as bigint) as pos,
  user_id as point_key,
  user_id * {PLACES_PER_POINT} + event_id % {PLACES_PER_POINT} as place_key,
  event_id as va, event_id % 97 as vb, event_id % 7 + 1 as vc,
  cast(floor(value) as bigint) as qty, upper(substr(event_type, 1, 1)) as f1,
  upper(substr(event_type, 2, 1)) as f2
from {{events}}
"""

# Card fields from a spec: raw text as rendered into HTML plus the values a
# correct extraction must produce.  ``{spec}`` is one of the spec queries.
CARD_FIELDS_SQL = f"""
select page_id, job_idx, pos, place_key, plat_u, plon_u,
  case when place_key % {PLACE_NOWHERE} <> 0 then cast(-plat_u as double) / 1000000.0 end as latitude,
  case when place_key % {PLACE_NOWHERE} <> 0 then cast(-plon_u as double) / 1000000.0 end as longitude,
  concat('https://www.google.com/maps/place/P', cast(place_key as string),
    case when place_key % {PLACE_ACCENT} = 0 then '-Café' else '' end, '/data=!4m7!3m6',
    case when place_key % {PLACE_NOWHERE} = 0 then '' else concat('!8m2!3d-', cast(cast(floor(plat_u / 1000000) as bigint) as string), '.',
    lpad(cast(plat_u % 1000000 as string), 6, '0'),
    '!4d-', cast(cast(floor(plon_u / 1000000) as bigint) as string), '.',
    lpad(cast(plon_u % 1000000 as string), 6, '0')) end,
    '!16s%2Fg%2F', cast(place_key as string),
    case when place_key % 23 = 0 then ''
         else concat('!19sChIJ', lpad(cast(place_key as string), 10, '0')) end,
    '?authuser=0&hl=es-419') as link,
  case when place_key % 23 = 0 then null
       else concat('ChIJ', lpad(cast(place_key as string), 10, '0')) end as prop_id,
  concat('Lugar{NBSP}', cast(place_key as string), '{ZWSP}') as name_raw,
  concat('Lugar ', cast(place_key as string)) as name,
  concat('Lugar ', cast(place_key as string), case when place_key % 5 = 0 then ' > "Bar" & Café' else '' end)
    as label,
  case when va % 11 = 0 then 0 when va % 7 = 0 then 1 else 2 end as rating_kind,
  concat(cast(1 + vb % 5 as string), '.', cast(va % 10 as string), '(',
         cast(qty as string), ')') as rating_text,
  cast(concat(cast(1 + vb % 5 as string), '.', cast(va % 10 as string)) as double)
    as rating_value,
  vc % 3 as price_kind,
  concat('{K.PRICE_SYMBOL} ', cast(vb % 9 + 1 as string), '0.000') as price_text,
  concat('Tienda ', f1, cast(va % 100 as string)) as category_raw,
  concat('Tienda ', f1) as category,
  case when vc % 4 = 0 then 0 else 1 end as addr_kind,
  concat('Calle ', cast(vb as string)) as address_text,
  case when va % 3 = 0 then 0 else 1 end as amen_kind,
  concat('Wi-Fi ', f2) as amen1,
  concat('Entrega{NBSP}', f1) as amen2_raw,
  concat('Entrega ', f1) as amen2
from (
  select s.*,
    {LAT0_U} + cast(floor(point_key / {GRID_COLS}) as bigint) * {DLAT_U}
      + (place_key * 7919) % {2 * SPREAD_U + 1} - {SPREAD_U} as plat_u,
    {LON0_U} + (point_key % {GRID_COLS}) * {DLON_U}
      + (place_key * 104729) % {2 * SPREAD_U + 1} - {SPREAD_U} as plon_u
  from ({{spec}}) s
) t
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _view_name(sf_dir: str, name: str) -> str:
    tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]
    return f"lk_{name}_{tag}"


def portable_sql(spark: SparkSession, sf_dir: str, template: str, **subs: str) -> DataFrame:
    """Run a portable SQL template in Spark over the driver tables of ``sf_dir``."""
    text = template
    for key, val in subs.items():
        text = text.replace("{" + key + "}", val)
    names = set(re.findall(r"\{(\w+)\}", text))
    views = {}
    for n in names:
        v = _view_name(sf_dir, n)
        table(spark, sf_dir, n).createOrReplaceTempView(v)
        views[n] = v
    for n, v in views.items():
        text = text.replace("{" + n + "}", v)
    return spark.sql(text)


def duckdb_sql(template: str, **subs: str) -> str:
    """The same template with plain table names (DuckDB oracle form)."""
    text = template
    for key, val in subs.items():
        text = text.replace("{" + key + "}", val)
    return re.sub(r"\{(\w+)\}", r"\1", text)


# --- DataFrame accessors ----------------------------------------------------

def grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable_sql(spark, sf_dir, GRID_SQL)


def card_fields(spark: SparkSession, sf_dir: str, which: str = "pass1") -> DataFrame:
    spec = PASS1_SPEC_SQL if which == "pass1" else RETRY_SPEC_SQL
    return portable_sql(spark, sf_dir, CARD_FIELDS_SQL, spec=spec)


def _card_html(c: DataFrame) -> DataFrame:
    """Render one result card per row (layout loc1) with Spark string functions."""
    # references of all kinds, quoted and bare ``>``: what a browser writes or accepts
    amp = F.element_at(F.array(*map(F.lit, ("&amp;", "&#38;", "&#x26;"))), (F.col("pos") % 3 + 1).cast("int"))
    esc = lambda col: F.replace(F.replace(F.col(col), F.lit("&"), amp), F.lit("é"), F.lit("&eacute;"))
    rating_row = F.when(F.col("rating_kind") == 0, F.lit("")).otherwise(F.concat(
        F.lit('<div class="W4Efsd"><div class="AJB7ye"><span class="e4rVHe">'
              '<span role="img" class="ZkP5Je-icon"></span></span><span>'),
        F.when(F.col("rating_kind") == 2,
               F.concat(F.lit('<span class="ZkP5Je" role="img">'), F.col("rating_text"),
                        F.lit("</span>"))).otherwise(F.lit("<span>sin reseñas</span>")),
        F.lit("</span>"),
        F.when(F.col("price_kind") == 0,
               F.lit('<span><span aria-hidden="true">·</span>'
                     '<span role="img" aria-label="Moderado">₲₲</span></span>'))
         .when(F.col("price_kind") == 1,
               F.concat(F.lit('<span><span aria-hidden="true">·</span><span>'),
                        F.col("price_text"), F.lit("</span></span>")))
         .otherwise(F.lit("")),
        F.lit("</div></div>")))
    if_address = F.when(F.col("addr_kind") == 1, F.concat(
        F.lit('<span><span aria-hidden="true">·</span> '), F.col("address_text"),
        F.lit("</span>"))).otherwise(F.lit(""))
    detail_row = F.concat(
        F.lit('<div class="W4Efsd"><div class="W4Efsd"><span><span>'),
        F.col("category_raw"), F.lit("</span></span>"), if_address,
        F.lit('</div><div class="W4Efsd"><span>Abierto</span></div></div>'))
    amen_row = F.when(F.col("amen_kind") == 0, F.lit("")).otherwise(F.concat(
        F.lit('<div class="ktbgEf"><div role="img" aria-label="'), F.col("amen1"),
        F.lit('"></div><div role="img" aria-label="'), F.col("amen2_raw"),
        F.lit('"></div><div role="img" aria-label=" "></div><div role="img"></div></div>')))
    html = F.concat(
        F.lit('<div class="Nv2PK THOPZb CpccDe "><a class="hfpxzc" aria-label="'),
        F.replace(esc("label"), F.lit('"'), F.lit("&quot;")), F.lit('" href="'), esc("link"), F.lit('"></a><div class="bfdHYd">'
                                                             '<div class="qBF1Pd fontHeadlineSmall">'),
        F.col("name_raw"), F.lit("</div>"), rating_row, detail_row, amen_row,
        F.lit("</div></div>"))
    return c.select("page_id", "job_idx", "pos", html.alias("card_html"))


#: Markup of a second result layout: one list item a place, prices as icons'
#: titles, tags in a list of their own.  Its rules are data (``LayoutSpec``).
LIST_LAYOUT = LayoutSpec(
    name="list", anchor_class="res-link", card_classes=("res-item",), card_tag="li",
    parts=(Part("meta", (Pick("p", "res-meta", 0),)),),
    rules=(
        ("name", Rule("text", (Pick("h3", "res-name", 0),), compatible=True)),
        ("rating", Rule("text", (Pick("b", "res-score", 0),), part="meta", absent=None)),
        ("price_label", Rule("attr", (Pick("i", "res-price", 0, attrs=(("title", None),)),), part="meta", attr="title",
                             default=None, absent=None)),
        ("price_spans", Rule("texts", (Pick("i", "res-price"),), part="meta")),
        ("category_raw", Rule("text", (Pick("p", "res-about", 0), Pick("span", index=0, children=True)))),
        ("address_spans", Rule("texts", (Pick("p", "res-about", 0), Pick("span", children=True)))),
        ("amenities", Rule("attrs", (Pick("li", attrs=(("title", None),), within=("ul", "res-tags")),), attr="title", compatible=True)),
    ))


def _list_item_html(c: DataFrame) -> DataFrame:
    """Render one result per row in the list layout."""
    amp = lambda col: F.replace(F.replace(F.col(col), F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    meta = F.when(F.col("rating_kind") == 0, F.lit("")).otherwise(F.concat(
        F.lit("<p class='res-meta x'>"),
        F.when(F.col("rating_kind") == 2, F.concat(F.lit("<b class=res-score>"), F.col("rating_text"), F.lit("</b>"))).otherwise(F.lit("")),
        F.when(F.col("price_kind") == 0, F.lit('<i class="res-price" title="Moderado"></i>'))
         .when(F.col("price_kind") == 1, F.concat(F.lit('<i class="res-price">'), F.col("price_text"), F.lit("</i>"))).otherwise(F.lit("")),
        F.lit("</p>")))
    address = F.when(F.col("addr_kind") == 1, F.concat(F.lit("<span>· "), F.col("address_text"), F.lit("</span>"))).otherwise(F.lit(""))
    tags = F.when(F.col("amen_kind") == 0, F.lit("")).otherwise(F.concat(
        F.lit('<ul class="res-tags"><li title="'), F.col("amen1"), F.lit('"><li title="'), F.col("amen2_raw"),
        F.lit('"></li><li>more</li><li title=" "></li></ul>')))
    html = F.concat(
        F.lit('<li class="res-item"><a class="res-link" aria-label="'), amp("label"), F.lit('" href="'), amp("link"),
        F.lit('"></a><h3 class="res-name">'), F.col("name_raw"), F.lit("</h3>"), meta, F.lit('<p class="res-about"><span>'),
        F.col("category_raw"), F.lit("</span>"), address, F.lit("</p>"), tags, F.lit("</li>"))
    return c.select("page_id", "job_idx", F.concat(F.lit('<ol><li><a class="res-more" href="#">x</a></li>'), html, F.lit("</ol>")).alias("html"))


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retry pass' cards as pages in the list layout, landed once."""
    path = derived_path(spark, sf_dir, "pages-list", CARD_FIELDS_SQL + RETRY_SPEC_SQL)
    return land(lambda: _list_item_html(card_fields(spark, sf_dir, "retry")), spark, path)


def _panel(cards_html: Column) -> Column:
    return F.concat(F.lit('<div role="feed" aria-label="Resultados">'), cards_html,
                    F.lit("</div>"))


def result_pages(spark: SparkSession, sf_dir: str, which: str = "pass1") -> DataFrame:
    """Captured result pages ``(page_id, job_idx, html)``.

    A page holds at most ``CARDS_PER_PAGE`` cards by construction (pages are
    keyed by order and card block), so assembling it is a bounded group.
    """
    if which != "pass1":
        cards = _card_html(card_fields(spark, sf_dir, which))
        return cards.select("page_id", "job_idx",
                            _panel(F.col("card_html")).alias("html"))
    # the specs of a page meet, a few numbers a card; markup is made where they are
    parts = -(-table(spark, sf_dir, "lineitem").count() // CARDS_PER_PART) or 1
    specs = portable_sql(spark, sf_dir, PASS1_SPEC_SQL).repartition(parts, "page_id", "job_idx")
    view = _view_name(sf_dir, "pass1_specs")
    specs.createOrReplaceTempView(view)
    cards = _card_html(portable_sql(spark, sf_dir, CARD_FIELDS_SQL, spec=f"select * from {view}"))
    full = (cards.groupBy("page_id", "job_idx")
            .agg(F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("pos", "card_html"))),
                lambda s: s["card_html"]), "").alias("cards"))
            .select("page_id", "job_idx", _panel(F.col("cards")).alias("html")))
    empty = portable_sql(spark, sf_dir, PASS1_EMPTY_PAGES_SQL).select(
        "page_id", "job_idx",
        _panel(F.lit('<div class="m6QErb">No se encontraron resultados</div>')).alias("html"))
    return full.unionByName(empty)


def _code_fingerprint() -> str:
    """Hash of the library sources, so landed tables never outlive the code
    that produced them."""
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1]
    h = hashlib.sha1()
    for f in sorted(root.rglob("*.py")):
        h.update(f.read_bytes())
    return h.hexdigest()[:12]


_FINGERPRINT = _code_fingerprint()


def derived_path(spark: SparkSession, sf_dir: str, name: str, text: str = "") -> str:
    """Location of a derived table inside the shared checkpoint folder."""
    from listingkit.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tag = hashlib.sha1(f"{_FINGERPRINT}|{sf_dir.rstrip('/')}|{text}".encode()).hexdigest()[:16]
    return f"{base}/listingkit-derived/{name}-{tag}"


def _path_exists(spark: SparkSession, path: str) -> bool:
    """A landed table is complete once its ``_SUCCESS`` marker exists."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


#: Cards that a task renders, about: their markup fits its memory.
CARDS_PER_PART = 100_000

#: Rows of a landed file, at most.
ROWS_PER_FILE = 10_000


def land(df_fn, spark: SparkSession, path: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write ``df_fn()`` to ``path`` once and read it back.

    The table is written to a unique sibling folder and renamed into place, so
    a failed or concurrent writer never leaves a partial table at ``path``.
    Files hold a bounded number of rows, so later scans split at any size.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not _path_exists(spark, path):
        import uuid
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
        with shuffles_removed(spark):
            df_fn().write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd").parquet(tmp)
        src, dst = jvm.org.apache.hadoop.fs.Path(tmp), jvm.org.apache.hadoop.fs.Path(path)
        fs = dst.getFileSystem(conf)
        if not fs.rename(src, dst) and not _path_exists(spark, path):
            raise RuntimeError(f"could not land table at {path}")
    return spark.read.parquet(path)


def landed_pages(spark: SparkSession, sf_dir: str, which: str = "pass1") -> DataFrame:
    """Derived result pages landed once as a Parquet table (like captured pages
    arriving as an input table) and read back; later queries scan it."""
    spec = PASS1_SPEC_SQL if which == "pass1" else RETRY_SPEC_SQL
    path = derived_path(spark, sf_dir, f"pages-{which}", CARD_FIELDS_SQL + spec)
    return land(lambda: result_pages(spark, sf_dir, which), spark, path)


def amenity_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-form amenity lists (``['a', 'b', ' ']``) from ``part``."""
    return portable_sql(spark, sf_dir, AMENITY_LITERALS_SQL)


AMENITY_LITERALS_SQL = """
select p_partkey as row_id,
  concat('ChIJ', lpad(cast(p_partkey as string), 10, '0')) as prop_id,
  case when p_partkey % 5 = 0 then null
       when p_partkey % 5 = 1 then '[]'
       else concat('[''', p_name, ''', "', p_type, '''s", '' '', ''', p_brand, ''']') end
    as amenities
from {part}
"""


# --- CSV with rows that do not fit ------------------------------------------------
#: One line an order: job_idx, latitude, longitude, keyword.  Some have a field
#: too few or too many, a text where a number belongs, no keyword, or quoted
#: separators and quotes.
CSV_ROWS_SQL = """
select o_orderkey as job_idx, cast(-(25000000 + o_orderkey % 100000) as double) / 1000000.0 as latitude,
  cast(-(57000000 + o_custkey % 100000) as double) / 1000000.0 as longitude,
  case when o_orderkey % 31 = 0 then null when o_orderkey % 3 = 0 then 'Café, "Bar" y' else concat('Tienda ', cast(o_orderkey % 7 as string)) end as keyword,
  concat('-25.', lpad(cast(o_orderkey % 100000 as string), 6, '0')) as lat_text,
  concat('-57.', lpad(cast(o_custkey % 100000 as string), 6, '0')) as lon_text,
  case when o_orderkey % 17 = 0 then 'too few fields' when o_orderkey % 19 = 0 then 'too many fields'
       when o_orderkey % 23 = 0 then 'not a double: latitude' when o_orderkey % 29 = 0 then 'not a bigint: job_idx'
       when o_orderkey % 31 = 0 then 'no keyword' end as reason
from {orders}
"""
CSV_LINES_SQL = f"""
select *, case reason
    when 'too few fields' then concat(cast(job_idx as string), ',', lat_text)
    when 'too many fields' then concat(cast(job_idx as string), ',', lat_text, ',', lon_text, ',a,b')
    when 'not a double: latitude' then concat(cast(job_idx as string), ',"south, far",', lon_text, ',k')
    when 'not a bigint: job_idx' then concat('x', cast(job_idx as string), ',', lat_text, ',', lon_text, ',k')
    else concat(cast(job_idx as string), ',', lat_text, ',', lon_text, ',',
      case when keyword is null then '' when job_idx % 3 = 0 then '"Café, ""Bar"" y"' else keyword end) end as line
from ({CSV_ROWS_SQL}) r
"""


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """Folder of CSV files with these lines, landed once."""
    path = derived_path(spark, sf_dir, "messy-csv", CSV_LINES_SQL)
    if not _path_exists(spark, path):
        # lines are written as they are: one column, no quoting
        lines = portable_sql(spark, sf_dir, CSV_LINES_SQL).select(F.col("line").alias("job_idx,latitude,longitude,keyword"))
        lines.write.mode("overwrite").csv(path, header=True, sep="\x01", quote="\x00", escape="\x02", escapeQuotes=False)
    return path


# --- text of all kinds -------------------------------------------------------------
#: What is appended to every k-th document, and what the text rules make of it.
TEXT_TAILS = [(" \uff21\ufb01n", " Afin", " afin"), (" a\u00a0b", " a b", " a b"), (" x\u200by", " xy", " xy"),
              (" \u00bd", " 1\u20442", " 12"), (" \u0041\u0301\u00ad", " \u00c1", " a"), (" \u00ba\u2028z", " oz", " oz")]


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of all documents, with a tail that the text rules change."""
    tail = F.element_at(F.array(*[F.lit(t[0]) for t in TEXT_TAILS]), (F.col("doc_id") % len(TEXT_TAILS) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("text", tail).alias("text"))


#: Markup put before every k-th page: a quoted ``>``, anchors that are none.
PAGE_HEADS_SQL = """
select page_id, concat(case page_id % 3
    when 0 then '<a title="a > b" href=''q?x>y'' aria-label="1 > 0">z</a><A HREF=bare>w</A>'
    when 1 then '<!-- <a href="no"> --><textarea><a href="no"></textarea><script>"<a href=no>"</script>'
    else '' end, html) as html
from {pages}
"""


def headed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, html) of all pages, with such markup before them."""
    return portable_sql(spark, sf_dir, PAGE_HEADS_SQL)


# --- boundaries --------------------------------------------------------------
# Shape templates in half-units: (shape, poly_idx, ring_idx, v_idx, dx, dy).
# 0 hexagon, 1 concave L, 2 square with a square hole, 3 hexagon plus an
# overlapping rectangle (two member polygons of one row).
SHAPE_TEMPLATES = [
    (0, 0, 0, 0, 4, 0), (0, 0, 0, 1, 2, 4), (0, 0, 0, 2, -2, 4), (0, 0, 0, 3, -4, 0),
    (0, 0, 0, 4, -2, -4), (0, 0, 0, 5, 2, -4),
    (1, 0, 0, 0, -4, -4), (1, 0, 0, 1, 4, -4), (1, 0, 0, 2, 4, 0), (1, 0, 0, 3, 0, 0),
    (1, 0, 0, 4, 0, 4), (1, 0, 0, 5, -4, 4),
    (2, 0, 0, 0, -4, -4), (2, 0, 0, 1, 4, -4), (2, 0, 0, 2, 4, 4), (2, 0, 0, 3, -4, 4),
    (2, 0, 1, 0, -2, -2), (2, 0, 1, 1, 2, -2), (2, 0, 1, 2, 2, 2), (2, 0, 1, 3, -2, 2),
    (3, 0, 0, 0, 4, 0), (3, 0, 0, 1, 2, 4), (3, 0, 0, 2, -2, 4), (3, 0, 0, 3, -4, 0),
    (3, 0, 0, 4, -2, -4), (3, 0, 0, 5, 2, -4),
    (3, 1, 0, 0, 0, -2), (3, 1, 0, 1, 6, -2), (3, 1, 0, 2, 6, 2), (3, 1, 0, 3, 0, 2),
]

# --- fixed test values: area labels per nation key (mis-decoded, proper, other)
AREA_LABELS = list(K.CLEAN_NAMES.keys()) + list(K.CLEAN_NAMES.values()) + [
    "  Ñeembucú\t Sur ", "PARAGUARÍ"]

_VALUES = ", ".join(f"({a}, {b}, {c}, {d}, {e}, {f})" for a, b, c, d, e, f in SHAPE_TEMPLATES)
_LABEL_CASE = "case n.n_nationkey " + " ".join(
    "when {} then '{}'".format(i, lab.replace("'", "''")) for i, lab in enumerate(AREA_LABELS)
) + " else n.n_name end"

AREA_VERTICES_SQL = f"""
select s.s_suppkey as area_ord,
  concat('PY', lpad(cast(n.n_nationkey as string), 2, '0')) as area_code,
  {_LABEL_CASE} as area_name,
  t.poly_idx, t.ring_idx, t.v_idx,
  cast(-(55000000 + (s.s_suppkey % 32) * 150000
         + t.dx * (5000 + (s.s_suppkey % 4) * 1250)) as double) / 1000000.0 as lon,
  cast(-(22000000 + cast(floor(s.s_suppkey / 32) as bigint) * 150000
         + t.dy * (5000 + (s.s_suppkey % 4) * 1250)) as double) / 1000000.0 as lat
from {{supplier}} s
join {{nation}} n on s.s_nationkey = n.n_nationkey
join (values {_VALUES}) as t(shape, poly_idx, ring_idx, v_idx, dx, dy)
  on t.shape = case when s.s_suppkey % 5 = 0 then 3 else s.s_suppkey % 3 end
"""


def area_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable_sql(spark, sf_dir, AREA_VERTICES_SQL)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary table ``(area_ord, area_code, area_name, polygons)``.

    Assembled from vertex rows by three bounded groupings (vertices per ring,
    rings per polygon, polygons per row are fixed by the templates).
    """
    v = area_vertices(spark, sf_dir)
    rings = (v.groupBy("area_ord", "area_code", "area_name", "poly_idx", "ring_idx")
             .agg(F.array_sort(F.collect_list(F.struct("v_idx", "lon", "lat"))).alias("vs"))
             .select("area_ord", "area_code", "area_name", "poly_idx", "ring_idx",
                     F.transform("vs", lambda x: F.struct(x["lon"].alias("lon"),
                                                          x["lat"].alias("lat"))).alias("ring")))
    # every other boundary has closed rings, as boundary files write them
    closed = F.concat("ring", F.slice("ring", 1, 1))
    rings = rings.withColumn("ring", F.when(F.col("area_ord") % 2 == 0, closed).otherwise(F.col("ring")))
    polys = (rings.groupBy("area_ord", "area_code", "area_name", "poly_idx")
             .agg(F.array_sort(F.collect_list(F.struct("ring_idx", "ring"))).alias("rs"))
             .select("area_ord", "area_code", "area_name", "poly_idx",
                     F.transform("rs", lambda x: x["ring"]).alias("poly")))
    return (polys.groupBy("area_ord", "area_code", "area_name")
            .agg(F.array_sort(F.collect_list(F.struct("poly_idx", "poly"))).alias("ps"))
            .select(F.col("area_ord").cast("int").alias("area_ord"), "area_code", "area_name",
                    F.transform("ps", lambda x: x["poly"]).alias("polygons")))


def landed_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived boundary table landed once as Parquet (boundaries are an
    input file of the pipeline) and read as boundaries are.

    32 suppliers make a row of areas and every row lies south of the last, so
    from some 14,500 suppliers on rows lie beyond the pole: they are corners of
    the same plane, and checked for finite degrees only."""
    path = derived_path(spark, sf_dir, "areas", AREA_VERTICES_SQL)
    land(lambda: areas(spark, sf_dir), spark, path)
    return read_boundaries(spark, path, max_lat=sys.float_info.max)
