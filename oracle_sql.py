"""DuckDB oracle SQL for every registered query.

Inputs come from the same portable derivation SQL the Spark side runs
(``listingkit.sources.testdata``); each oracle then computes the expected
result *directly* from the derived rows - e.g. listings straight from the
card fields, never through HTML - so the Spark pipeline is checked end to
end.  Double constants are written as ``CAST('<repr>' AS DOUBLE)`` so both
engines use bit-identical literals.
"""

from __future__ import annotations

from listingkit import constants as K
from listingkit.functions import geo
from listingkit.sources import testdata as td

R = float(K.DEFAULT_RADIUS_M)
S = float(K.DEFAULT_RADIUS_M * K.LATTICE_SPACING_FACTOR)


def d(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


# ------------------------------------------------------------------ expression builders

def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
         f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"({d(2 * K.EARTH_RADIUS_M)} * atan2(sqrt({a}), sqrt(1 - {a})))"


def _merid(p: str) -> str:
    return (f"({d(geo.M1)} * {p} - {d(geo.M2)} * sin(2 * {p}) + {d(geo.M3)} * sin(4 * {p})"
            f" - {d(geo.M4)} * sin(6 * {p}))")


def _merid_prime(p: str) -> str:
    return (f"({d(geo.M1)} - {d(2 * geo.M2)} * cos(2 * {p}) + {d(4 * geo.M3)} * cos(4 * {p})"
            f" - {d(6 * geo.M4)} * cos(6 * {p}))")


def forward_x(lon: str, lat: str) -> str:
    phi, dl = f"radians({lat})", f"(radians({lon}) - {d(geo.LON0)})"
    n = f"({d(geo.A)} / sqrt(1 - {d(geo.E2)} * sin({phi}) * sin({phi})))"
    ncot = f"({n} / tan({phi}))"
    return (f"(case when {phi} = 0 then {d(geo.A)} * {dl} "
            f"else {ncot} * sin({dl} * sin({phi})) end + {d(geo.X0)})")


def forward_y(lon: str, lat: str) -> str:
    phi, dl = f"radians({lat})", f"(radians({lon}) - {d(geo.LON0)})"
    n = f"({d(geo.A)} / sqrt(1 - {d(geo.E2)} * sin({phi}) * sin({phi})))"
    ncot = f"({n} / tan({phi}))"
    return (f"(case when {phi} = 0 then {d(0.0)} "
            f"else {d(geo.A)} * {_merid(phi)} + {ncot} * (1 - cos({dl} * sin({phi}))) end"
            f" + {d(geo.Y0)})")


def inverse_sql(x: str, y: str) -> tuple[str, str]:
    """(lon_deg, lat_deg) expressions; Newton steps via list_reduce."""
    xx, yy = f"({x} - {d(geo.X0)})", f"({y} - {d(geo.Y0)})"
    a_ = f"({yy} / {d(geo.A)})"
    b_ = f"(({xx} * {xx}) / {d(geo.A * geo.A)} + {a_} * {a_})"
    p = "acc"
    c = f"(sqrt(1 - {d(geo.E2)} * sin({p}) * sin({p})) * tan({p}))"
    mn, mp = _merid(p), _merid_prime(p)
    num = f"({a_} * ({c} * {mn} + 1) - {mn} - ({mn} * {mn} + {b_}) * {c} / 2)"
    den = (f"({d(geo.E2)} * sin(2 * {p}) * ({mn} * {mn} + {b_} - 2 * {a_} * {mn}) / (4 * {c})"
           f" + ({a_} - {mn}) * ({c} * {mp} - 2 / sin(2 * {p})) - {mp})")
    phi = (f"list_reduce(range(1, {geo.NEWTON_STEPS + 1}), lambda acc, i: {p} - {num} / {den},"
           f" {a_})")
    c_fin = f"(sqrt(1 - {d(geo.E2)} * sin(phi) * sin(phi)) * tan(phi))"
    lam = (f"(case when {yy} = 0 then {xx} / {d(geo.A)} "
           f"else asin({xx} * {c_fin} / {d(geo.A)}) / sin(phi) end + {d(geo.LON0)})")
    lat = f"(case when {yy} = 0 then {d(0.0)} else degrees(phi) end)"
    return (f"degrees({lam})", lat, phi)


def nkey(c: str) -> str:
    return (f"trim(regexp_replace(lower(regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '',"
            f" 'g')), '\\s+', ' ', 'g'))")


#: Character references that occur in the driver's ``pages`` table.
PAGE_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", "\u00a0"),
                 ("&middot;", "\u00b7"), ("&copy;", "\u00a9"), ("&amp;", "&")]


def unescape(c: str) -> str:
    for ent, ch in PAGE_ENTITIES:
        c = f"replace({c}, '{ent}', '{ch}')"
    return c


def attr(tag: str, name: str) -> str:
    """Attribute value in any quoting ('' for an empty quoted value, null if absent)."""
    pat = "(?is)(?:^|[^\\w-])" + name + "\\s*=\\s*(\"[^\"]*\"|''[^'']*''|[^\\s>]+)"
    raw = f"regexp_extract({tag}, '{pat}', 1)"
    dq, sq = "'\"'", "''''"
    return (f"(case when {raw} = '' then null "
            f"when starts_with({raw}, {dq}) or starts_with({raw}, {sq}) "
            f"then substr({raw}, 2, length({raw}) - 2) else {raw} end)")


# ------------------------------------------------------------------ shared CTEs

KW_VALUES = ", ".join("({}, '{}')".format(i, k) for i, k in enumerate(K.KEYWORDS))
GRID = td.duckdb_sql(td.GRID_SQL)
CARDS = td.duckdb_sql(td.CARD_FIELDS_SQL, spec=td.PASS1_SPEC_SQL)
RCARDS = td.duckdb_sql(td.CARD_FIELDS_SQL, spec=td.RETRY_SPEC_SQL)
VERTS = td.duckdb_sql(td.AREA_VERTICES_SQL)
LIT = td.duckdb_sql(td.AMENITY_LITERALS_SQL)

BASE = f"""
grid as ({GRID}),
kw as (select * from (values {KW_VALUES}) as t(kw_idx, keyword)),
jobs as (select point_idx * {len(K.KEYWORDS)} + kw_idx as job_idx, latitude, longitude, keyword
         from grid, kw),
cards as ({CARDS})
"""

LISTING_COLS = """job_idx, page_id, pos, latitude, longitude, keyword, name, link, rating, price,
  category, address"""


def _listing_cte(name: str, cards: str, jobs: str) -> str:
    dist = haversine("j.latitude", "j.longitude", "c.latitude", "c.longitude")
    return f"""
{name} as (
  select c.job_idx, c.page_id, c.pos, c.latitude, c.longitude, j.keyword, c.name, c.link,
    case c.rating_kind when 2 then c.rating_text else '' end as rating,
    case c.price_kind when 0 then 'Moderado' when 1 then c.price_text else '' end as price,
    c.category,
    case c.addr_kind when 1 then c.address_text else '' end as address,
    case c.amen_kind when 1 then c.amen1 || '|' || c.amen2 || '|' else '' end as amenities,
    c.amen_kind, c.amen1, c.amen2
  from {cards} c join {jobs} j on c.job_idx = j.job_idx
  where c.rating_kind <> 0 and {dist} <= {d(R)}
)"""


LST = _listing_cte("lst", "cards", "jobs")
MRG = """
mrg as (select * from lst
        qualify row_number() over (partition by link order by job_idx, page_id, pos) = 1)"""
FAILED = """
failed as (select job_idx, latitude, longitude, keyword from jobs
           where job_idx not in (select distinct job_idx from cards))"""
RETRY = f"""
rcards as ({RCARDS}),
{FAILED.strip()},
{_listing_cte("rlst", "rcards", "failed").strip()}"""

RATING_RE = "([0-9.]+)\\(([0-9]+)\\)"


def _post_select(order: str, src: str) -> str:
    return f"""
select row_number() over (order by {order}) as num_id,
  nullif(regexp_extract(link, '(ChIJ[^?]+)', 1), '') as prop_id,
  latitude, longitude, keyword, name, link,
  coalesce(try_cast(regexp_extract(rating, '{RATING_RE}', 2) as bigint), 0) as num_rating,
  try_cast(regexp_extract(rating, '{RATING_RE}', 1) as double) as rating,
  price, category, address
from {src}"""


SORT_ORDER = "longitude asc nulls last, latitude asc nulls last, job_idx, page_id, pos"
RETRY_ORDER = "src, o1 asc nulls last, o2 asc nulls last, job_idx, page_id, pos"

POST = f"with {BASE}, {LST.strip()}, {MRG.strip()} {_post_select(SORT_ORDER, 'mrg')}"


# ------------------------------------------------------------------ geometry CTEs

def _verts_xy() -> str:
    return f"""
v as ({VERTS}),
vx as (select cast(area_ord as integer) as area_ord, area_code, area_name, poly_idx, ring_idx,
         v_idx, round({forward_x('lon', 'lat')}, 3) as x, round({forward_y('lon', 'lat')}, 3) as y
       from v)"""


def _bounds(group: str, src: str = "vx") -> str:
    return f"""
gb as (select {group}, min(x) as minx, max(x) as maxx, min(y) as miny, max(y) as maxy
       from {src} group by {group}),
gp as (select *, (minx + {d(S)}) - minx as dx, (miny + {d(S)}) - miny as dy,
         cast(ceil((maxx + {d(S)} - minx) / {d(S)}) as bigint) as nx,
         cast(ceil((maxy + {d(S)} - miny) / {d(S)}) as bigint) as ny
       from gb)"""


#: Metres between a lattice point and the points beside it that stand for it.
PROBE = 0.0001


def _inside(group: str, src: str = "vx") -> str:
    """Brute force and by a rule of its own: a point is inside the union if the
    four points beside it, diagonally, are each in some member, by plain
    even-odd parity against all of the member's edges."""
    crosses = " + ".join(
        f"sum(case when (e.y1 > c.y + {dy}) <> (e.y2 > c.y + {dy}) and "
        f"c.x + {dx} < e.x1 + (c.y + {dy} - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) then 1 else 0 end) % 2 * {bit}"
        for bit, (dx, dy) in zip((1, 2, 4, 8), [(d(a * PROBE), d(b * PROBE)) for a in (-1, 1) for b in (-1, 1)]))
    return f"""
rs as (select area_ord, poly_idx, ring_idx, count(*) as n from {src}
       group by area_ord, poly_idx, ring_idx),
ed as (select a.area_ord, a.poly_idx, a.x as x1, a.y as y1, b.x as x2, b.y as y2
       from {src} a join rs on a.area_ord = rs.area_ord and a.poly_idx = rs.poly_idx
                            and a.ring_idx = rs.ring_idx
       join {src} b on b.area_ord = a.area_ord and b.poly_idx = a.poly_idx
                    and b.ring_idx = a.ring_idx and b.v_idx = (a.v_idx + 1) % rs.n
       where a.y <> b.y),
pbox as (select {group}, area_ord, poly_idx, min(x) as pminx, max(x) as pmaxx,
           min(y) as pminy, max(y) as pmaxy
         from {src} group by all),
cand as (select p.{group}, p.area_ord, p.poly_idx, g.minx, g.miny, g.dx, g.dy, g.ny,
           unnest(range(greatest(cast(floor((p.pminx - g.minx) / g.dx) as bigint) - 1, 0),
                        least(cast(ceil((p.pmaxx - g.minx) / g.dx) as bigint) + 1, g.nx - 1) + 1)) as i,
           greatest(cast(floor((p.pminy - g.miny) / g.dy) as bigint) - 1, 0) as jlo,
           least(cast(ceil((p.pmaxy - g.miny) / g.dy) as bigint) + 1, g.ny - 1) as jhi
         from pbox p join gp g using ({group})),
cell0 as (select {group}, area_ord, poly_idx, i, unnest(range(jlo, jhi + 1)) as j,
           minx, miny, dx, dy, ny from cand),
cell as (select {group}, area_ord, poly_idx, i, j, minx + i * dx as x, miny + j * dy as y
         from cell0),
par as (select c.{group}, c.i, c.j, c.area_ord, c.poly_idx, {crosses} as bits
        from cell c join ed e on c.area_ord = e.area_ord and c.poly_idx = e.poly_idx
        group by all),
ins as (select {group}, i, j from par group by all having bit_or(cast(bits as integer)) = 15)"""


def _grid_points(group: str, where: str = "") -> str:
    lon, lat, phi = inverse_sql("x", "y")
    return f"""with {_verts_xy().strip()},
sel as (select * from vx {where}),
{_bounds(group, 'sel').strip()},
{_inside(group, 'sel').strip()},
pts as (select ins.{group.replace(', ', ', ins.')}, ins.i * g.ny + ins.j as point_idx,
          g.minx + ins.i * g.dx as x, g.miny + ins.j * g.dy as y
        from ins join gp g using ({group})),
ph as (select *, {phi} as phi from pts)
select {group}, point_idx, round({lat}, 5) as latitude, round({lon}, 5) as longitude from ph"""


# ------------------------------------------------------------------ the oracle

def _build() -> dict[str, str]:
    q: dict[str, str] = {}
    dist_cj = haversine("j.latitude", "j.longitude", "c.latitude", "c.longitude")

    q["coerce_numeric"] = f"""with cards as ({CARDS})
select page_id, pos,
  try_cast(regexp_extract(rating_text, '^[0-9.]*', 0) as double) as rating_num,
  try_cast(rating_text as double) as rating_bad
from cards"""

    q["link_coords"] = f"""with cards as ({CARDS})
select page_id, pos,
  try_cast(regexp_extract(link, '!3d([-0-9.]+)!4d([-0-9.]+)', 1) as double) as lat,
  try_cast(regexp_extract(link, '!3d([-0-9.]+)!4d([-0-9.]+)', 2) as double) as lon
from cards"""

    q["place_id"] = f"""with cards as ({CARDS})
select page_id, pos, nullif(regexp_extract(link, '(ChIJ[^?]+)', 1), '') as prop_id from cards"""

    q["rating_split"] = f"""with cards as ({CARDS}),
r as (select page_id, pos, case rating_kind when 2 then rating_text when 1 then '' end as r
      from cards)
select page_id, pos, try_cast(regexp_extract(r, '{RATING_RE}', 1) as double) as rating,
  coalesce(try_cast(regexp_extract(r, '{RATING_RE}', 2) as bigint), 0) as num_rating
from r"""

    q["price_choice"] = f"""with cards as ({CARDS})
select page_id, pos,
  case price_kind when 0 then 'Moderado' when 1 then price_text else '' end as price
from cards"""

    q["category_clean"] = f"""with cards as ({CARDS})
select page_id, pos, trim(regexp_replace(category_raw, '[0-9]+', '', 'g')) as category
from cards"""

    q["address_clean"] = f"""with cards as ({CARDS})
select page_id, pos, case addr_kind when 1 then address_text else '' end as address from cards"""

    q["haversine"] = f"""with {BASE}
select c.page_id, c.pos, round({dist_cj}, 3) as dist_m
from cards c join jobs j on c.job_idx = j.job_idx"""

    q["request_url"] = f"""with {BASE}
select job_idx,
  '{K.SEARCH_BASE_URL}' || replace(url_encode(keyword), '%20', '+') || '/@' ||
  cast(latitude as varchar) || ',' || cast(longitude as varchar) || ',' ||
  '{K.DEFAULT_RADIUS_M}' || 'm' || '{K.SEARCH_URL_SUFFIX}' as url
from jobs where not isnan(latitude)
union all select job_idx, null from jobs where latitude is null or isnan(latitude)"""

    def tailed(text: str, kind: int) -> str:
        """The text's own result and the one of its tail (fixed values of td.TEXT_TAILS)."""
        tail = " ".join(f"when {i} then '{t[kind]}'" for i, t in enumerate(td.TEXT_TAILS))
        return f"trim({text} || case doc_id % {len(td.TEXT_TAILS)} {tail} end)"

    q["normalize_key"] = f"select doc_id, {tailed(nkey('text'), 2)} as key from documents"
    q["clean_text"] = f"""select doc_id, {tailed("ltrim(regexp_replace(text, '[[:cntrl:]]', '', 'g'))", 1)} as cleaned from documents"""

    q["generate_jobs"] = f"with {BASE} select job_idx, latitude, longitude, keyword from jobs"

    q["balanced_chunks"] = f"""with {BASE}
select job_idx, cast(ntile({K.NUM_CHUNKS}) over (order by job_idx) - 1 as integer) as chunk
from jobs"""

    q["radius_filter"] = f"""with {BASE}
select c.job_idx, c.page_id, c.pos, round({dist_cj}, 3) as dist_m
from cards c join jobs j on c.job_idx = j.job_idx
where {dist_cj} <= {d(R)}"""

    q["failed_jobs"] = f"""with {BASE}, {FAILED.strip()}
select job_idx, latitude, longitude, keyword, 'no results' as reason from failed"""

    q["retry_jobs"] = f"""with {BASE}, {FAILED.strip()}
select job_idx, latitude, longitude, keyword from failed
where latitude is not null and longitude is not null
  and not isnan(latitude) and not isnan(longitude)"""

    q["job_summary"] = f"""with {BASE},
an as (select c.job_idx, c.rating_kind, case when not isnan(j.latitude) then {dist_cj} end as dist
       from cards c join jobs j on c.job_idx = j.job_idx)
select j.job_idx, j.keyword,
  count(a.job_idx) as anchors,
  count(a.job_idx) filter (where a.dist is null) as no_coords,
  count(a.job_idx) filter (where a.dist > {d(R)}) as outside_radius,
  count(a.job_idx) filter (where a.dist <= {d(R)}) as within_radius,
  count(a.job_idx) filter (where a.dist <= {d(R)} and a.rating_kind <> 0) as accepted,
  count(a.job_idx) filter (where a.dist <= {d(R)} and a.rating_kind = 0) as card_errors,
  count(a.job_idx) filter (where a.dist <= {d(R)} and a.rating_kind <> 0) = 0 as no_results,
  count(a.job_idx) = 0 as failed
from jobs j left join an a on a.job_idx = j.job_idx
group by j.job_idx, j.keyword"""

    # what holds no elements, then start tags whose quoted values may hold ``>``
    anchors_re = ("(?is)<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>"
                  "|<textarea\\b[^>]*>.*?</textarea\\s*>|<title\\b[^>]*>.*?</title\\s*>"
                  "|<a(?:\\s(?:[^>\"'']|\"[^\"]*\"|''[^'']*'')*)?>")
    q["page_anchors"] = f"""with p as ({td.duckdb_sql(td.PAGE_HEADS_SQL)}), t as (
  select page_id, list_filter(regexp_extract_all(html, '{anchors_re}', 0),
                              lambda x: lower(substr(x, 1, 2)) = '<a') as tags from p),
u as (select page_id, unnest(tags) as tag, generate_subscripts(tags, 1) - 1 as pos from t)
select page_id, cast(pos as bigint) as pos, {unescape(attr('tag', 'href'))} as href,
  {unescape(attr('tag', 'aria-label'))} as label
from u"""

    def title(tag: str) -> str:
        raw = f"regexp_extract(html, '(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>', 1)"
        joined = f"regexp_replace({raw}, '\\s*<[^>]*>\\s*', '', 'g')"
        return f"trim(regexp_replace(trim({unescape(joined)}), '[[:cntrl:]]', '', 'g'))"
    q["page_titles"] = (f"select page_id, {title('title')} as title, {title('h1')} as h1 "
                        f"from pages")

    q["extract_listings"] = f"with {BASE}, {LST.strip()} select {LISTING_COLS}, amenities from lst"
    q["dedupe_keep_first"] = (f"with {BASE}, {LST.strip()}, {MRG.strip()} "
                              f"select {LISTING_COLS}, amenities from mrg")
    q["merge_results"] = (f"with {BASE}, {LST.strip()}, {MRG.strip()} select {LISTING_COLS}, amenities, "
                          f"row_number() over (order by {SORT_ORDER}) as position from mrg")
    q["csv_roundtrip"] = f"""with {BASE}, {LST.strip()}, {MRG.strip()}
select latitude, longitude, keyword, name, link, nullif(rating, '') as rating, nullif(price, '') as price,
  nullif(category, '') as category, nullif(address, '') as address, amenities from mrg"""
    q["card_anchors"] = f"with cards as ({CARDS}) select page_id, pos, link as href, label from cards"
    q["run_totals"] = f"""with {BASE}, {LST.strip()}, {FAILED.strip()},
ch as (select job_idx, cast(ntile({K.NUM_CHUNKS}) over (order by job_idx) - 1 as integer) as chunk from jobs),
r as (select job_idx, count(*) as n from lst group by job_idx)
select ch.chunk, count(*) as jobs, cast(coalesce(sum(r.n), 0) as bigint) as rows,
  count(failed.job_idx) as failed
from ch left join r using (job_idx) left join failed using (job_idx) group by ch.chunk"""

    q["concat_results"] = f"""with {BASE}, {LST.strip()}, {RETRY.strip()}
select 0 as src, job_idx, page_id, pos, link, cast(null as varchar) as phone from lst
union all
select 1 as src, job_idx, page_id, pos, link, cast(null as varchar) as phone from rlst"""

    q["dedupe_stats"] = f"""with {BASE}, {LST.strip()}
select count(*) as rows_before,
  cast(count(distinct link) + coalesce(max(cast(link is null as integer)), 0) as bigint)
    as rows_after,
  cast(count(*) - count(distinct link) - coalesce(max(cast(link is null as integer)), 0)
       as bigint) as removed
from lst"""

    q["assign_ids"] = (f"with {BASE}, {LST.strip()}, {MRG.strip()} "
                       f"select row_number() over (order by {SORT_ORDER}) as num_id, link from mrg")

    q["postprocess"] = POST
    q["postprocess_idempotent"] = POST

    q["amenities_explode"] = f"""with {BASE}, {LST.strip()}, {MRG.strip()},
p as (select nullif(regexp_extract(link, '(ChIJ[^?]+)', 1), '') as prop_id, amen_kind, amen1, amen2
      from mrg)
select prop_id, amen1 as amenity from p where amen_kind = 1
union all
select prop_id, amen2 as amenity from p where amen_kind = 1"""

    q["amenities_parse"] = f"""with lit as ({LIT}), p as (select * from part)
select lit.row_id,
  cast(case when p.p_partkey % 5 in (0, 1) then 0 else 4 end as bigint) as n,
  case when p.p_partkey % 5 in (0, 1) then ''
       else p.p_name || '|' || p.p_type || '''s' || '| |' || p.p_brand end as joined
from lit join p on lit.row_id = p.p_partkey"""

    q["retry_merge"] = f"""with {BASE}, {LST.strip()}, {MRG.strip()}, {RETRY.strip()},
u as (select {LISTING_COLS}, 0 as src, longitude as o1, latitude as o2 from mrg
      union all
      select {LISTING_COLS}, 1 as src, cast(null as double) as o1, cast(null as double) as o2
      from rlst),
k as (select * from u
      qualify row_number() over (partition by link order by {RETRY_ORDER}) = 1)
{_post_select(RETRY_ORDER, 'k')}"""

    custom = _listing_cte("clst", "rcards", "jobs")
    q["custom_layout"] = f"""with {BASE}, rcards as ({RCARDS}), {custom.strip()}
select {LISTING_COLS.replace("category", "upper(category) as category").replace("pos,", "pos + 1 as pos,")}, amenities from clst"""

    q["sink_roundtrip"] = f"""with {BASE}, {LST.strip()}, {MRG.strip()},
post as ({_post_select(SORT_ORDER, 'mrg')}),
am as (select nullif(regexp_extract(link, '(ChIJ[^?]+)', 1), '') as prop_id, sum(case amen_kind when 1 then 2 else 0 end) as n
       from mrg group by 1)
select num_id, post.prop_id, link, cast(coalesce(am.n, 0) as bigint) as n_amenities, (select count(*) from mrg) as rows_written
from post left join am on post.prop_id = am.prop_id"""

    q["failure_sink"] = f"""with {BASE}, {FAILED.strip()}
select job_idx, keyword, (select count(*) from failed) as n_failed from failed"""

    lines = td.duckdb_sql(td.CSV_LINES_SQL)
    q["csv_quarantine"] = f"""with l as ({lines})
select job_idx, latitude, longitude, keyword, cast(null as varchar) as record, cast(null as varchar) as reason from l where reason is null
union all
select null, null, null, null, case reason when 'no keyword'
    then concat(job_idx, ',', cast(latitude as varchar), ',', cast(longitude as varchar), ',') else line end, reason from l where reason is not null"""

    # ---- areas
    areas_cte = f"with v as ({VERTS}), ar as (select distinct cast(area_ord as integer) as area_ord, area_code, area_name from v)"
    nm_values = ", ".join("({}, '{}', '{}')".format(i, a, b)
                          for i, (a, b) in enumerate(K.CLEAN_NAMES.items()))
    q["canonical_names"] = f"""{areas_cte},
nm as (select * from (values {nm_values}) as t(ord, raw_name, clean_name)),
nk as (select {nkey('raw_name')} as k, arg_max(clean_name, ord) as mapped from nm group by 1)
select ar.area_ord, ar.area_name,
  case when ar.area_name is null then null else coalesce(nk.mapped, ar.area_name) end
    as cleaned_name
from ar left join nk on {nkey('ar.area_name')} = nk.k"""

    q["cleaned_boundaries"] = f"""with c as ({q["canonical_names"]}),
n as (select cast(area_ord as integer) as area_ord, count(distinct poly_idx) as n_polygons, count(*) as n_corners
      from ({VERTS}) group by 1)
select c.area_ord, 'cleaned_name' as label_column, c.cleaned_name as label, n.n_polygons, n.n_corners
from c join n using (area_ord)"""

    sel_key = "asuncion"
    q["area_select"] = (f"{areas_cte} select area_ord, area_code, area_name from ar "
                        f"where {nkey('area_name')} = '{sel_key}'")
    q["area_listing"] = f"{areas_cte} select distinct area_name, area_code from ar"
    q["distinct_names"] = (f"{areas_cte} select distinct area_name from ar "
                           f"where area_name is not null")

    q["project_forward"] = (f"with {_verts_xy().strip()} "
                            f"select area_ord, poly_idx, ring_idx, v_idx, x, y from vx")

    lon, lat, phi = inverse_sql("x", "y")
    q["project_inverse"] = f"""with grid as ({GRID}),
g as (select point_idx, round({forward_x('longitude', 'latitude')}, 3) as x,
        round({forward_y('longitude', 'latitude')}, 3) as y from grid),
ph as (select *, {phi} as phi from g)
select point_idx, round({lat}, 7) as lat, round({lon}, 7) as lon from ph"""

    q["area_bounds"] = (f"with {_verts_xy().strip()}, {_bounds('area_code').strip()} "
                        f"select area_code, minx, maxx, miny, maxy, nx, ny from gp")

    q["lattice"] = f"""with {_verts_xy().strip()}, {_bounds('area_ord').strip()},
ci as (select area_ord, minx, miny, dx, dy, ny, unnest(range(0, nx)) as i from gp),
cj as (select *, unnest(range(0, ny)) as j from ci)
select area_ord, i * ny + j as point_idx, round(minx + i * dx, 3) as x,
  round(miny + j * dy, 3) as y
from cj"""

    q["point_in_polygon"] = f"""with {_verts_xy().strip()}, {_bounds('area_ord').strip()},
{_inside('area_ord').strip()},
ci as (select area_ord, ny, unnest(range(0, nx)) as i from gp),
cj as (select *, unnest(range(0, ny)) as j from ci)
select cj.area_ord, cj.i * cj.ny + cj.j as point_idx, (ins.i is not null) as inside
from cj left join ins on ins.area_ord = cj.area_ord and ins.i = cj.i and ins.j = cj.j"""

    q["lattice_in_area"] = _grid_points("area_code")
    q["build_grid"] = (_grid_points("area_code", f"where {nkey('area_name')} = '{sel_key}'")
                       .replace("select area_code, point_idx, round(",
                                "select (select arg_min(area_name, area_ord) from sel) as city, point_idx, round("))
    q["grid_jobs"] = f"""with g as ({q["build_grid"]}), kw as (select * from (values {KW_VALUES}) as t(kw_idx, keyword))
select point_idx * {len(K.KEYWORDS)} + kw_idx as job_idx, latitude, longitude, keyword from g, kw"""
    return q


ORACLE_SQL = _build()
