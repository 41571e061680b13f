"""Result-page extraction on hand-written pages (layout loc1)."""

import random
import re

from pyspark.sql import functions as F

from listingkit.operators import jobs as J
from listingkit.operators import pages as PG
from listingkit.operators.layouts import LayoutSpec, Part, Pick, Rule, register_layout
from listingkit.plans import listings as P


def card(name="Lugar 1", lat="-25.3000000", lon="-57.6000000", pid="ChIJabc", wrapper="Nv2PK CpccDe",
         rating_block=True, rating_span=True, price="label", address=True, amenities=True,
         label=True):
    href = f"https://www.google.com/maps/place/x/data=!3d{lat}!4d{lon}!19s{pid}?hl=es&amp;x=1"
    aria = f' aria-label="{name}"' if label else ""
    r = ""
    if rating_block:
        rs = '<span class="ZkP5Je" role="img">4,5(12)</span>' if rating_span else "<span>-</span>"
        pr = {"label": '<span><span>·</span><span role="img" aria-label="Moderado">₲₲</span></span>',
              "text": "<span><span>·</span><span>₲ 50.000</span></span>", None: ""}[price]
        r = f'<div class="W4Efsd"><div class="AJB7ye"><span><span role="img"></span></span>' \
            f"<span>{rs}</span>{pr}</div></div>"
    addr = "<span><span>·</span> Av. Mcal. López 123</span>" if address else ""
    detail = (f'<div class="W4Efsd"><div class="W4Efsd"><span><span>Farmacia 24</span></span>'
              f'{addr}</div><div class="W4Efsd"><span>Abierto</span></div></div>')
    am = ('<div class="ktbgEf"><div role="img" aria-label="Wi-Fi\xa0gratis"></div>'
          '<div role="img" aria-label=" "></div><div role="img"></div></div>') if amenities else ""
    return (f'<div class="{wrapper}"><a class="hfpxzc"{aria} href="{href}"></a>'
            f'<div class="qBF1Pd">{name}​</div>{r}{detail}{am}</div>')


def panel(*cards, extra=""):
    return f'<html><body><!-- <a class="hfpxzc" aria-label="x" href="c"> -->' \
           f'<script>var a = "<a class=hfpxzc>";</script><div role="feed">{extra}{"".join(cards)}' \
           f"</div></body></html>"


def test_full_card_fields():
    rows = PG.page_rows(1, 7, panel(card()))
    assert len(rows) == 1
    r = rows[0]
    assert r["has_card"] and r["has_rating"]
    assert r["name"] == "Lugar 1\u200b" and r["rating"]      # unseen characters go later == "4,5(12)"
    assert r["price_label"] == "Moderado"
    assert r["category_raw"] == "Farmacia 24"
    assert r["address_spans"] == ["Farmacia 24", "·Av. Mcal. López 123"]
    assert r["amenities"] == ["Wi-Fi gratis", " "]
    assert r["href"].endswith("?hl=es&x=1")


def test_card_variants():
    doc = panel(card(name="A", wrapper="CpccDe"), card(name="B", wrapper="section-result"),
                card(name="C", wrapper="other"), card(name="D", label=False),
                card(name="E", rating_block=False), card(name="F", rating_span=False),
                card(name="G", price="text", address=False, amenities=False))
    rows = {r["pos"]: r for r in PG.page_rows(1, 7, doc)}
    # D has no aria-label: not a result anchor, but it still counts as an <a>
    assert sorted(rows) == [0, 1, 2, 4, 5, 6]
    assert rows[0]["has_card"] and rows[1]["has_card"]
    assert not rows[2]["has_card"]                       # no wrapper -> skipped
    assert not rows[4]["has_rating"]                     # no rating block -> dropped
    assert rows[5]["has_rating"] and rows[5]["rating"] == ""
    assert rows[6]["price_spans"] == ["·", "₲ 50.000"] and rows[6]["address_spans"] == [
        "Farmacia 24"] and rows[6]["amenities"] == []


def test_nested_same_class_blocks():
    inner = ('<div class="Nv2PK"><a class="hfpxzc" aria-label="N" href="u!3d-25.1!4d-57.1">'
             '</a><div class="W4Efsd"><div class="W4Efsd"><div class="AJB7ye"><span>x</span>'
             '<span><span class="ZkP5Je">3.0(1)</span></span></div></div></div>'
             '<div class="W4Efsd"><div class="W4Efsd"><span><span>Tienda</span></span></div>'
             '</div></div>')
    rows = PG.page_rows(1, 1, panel(inner))
    # blocks = all div.W4Efsd in document order; block 0's first AJB7ye wins
    assert rows[0]["rating"] == "3.0(1)"
    # block 1 is the nested one inside block 0 (no nested W4Efsd of its own)
    assert rows[0]["category_raw"] == ""


def test_catalyst_anchors_agree_with_tree(spark):
    doc = panel(card(name="A"), card(name="D", label=False), card(name="E"),
                extra='<a href="/help">help</a>')
    pages = spark.createDataFrame([(1, 7, doc), (2, 8, panel())],
                                  "page_id long, job_idx long, html string")
    cat = {(r.page_id, r.pos, r.href) for r in PG.result_anchors(pages).collect()}
    tree = {(r["page_id"], r["pos"], r["href"]) for r in PG.page_rows(1, 7, doc)}
    assert cat == tree and len(cat) == 2


def test_page_titles_get_text(spark):
    doc = "<html><head><title> A &amp; <b>B</b> c </title></head><body><h1>x <i>y</i></h1>"
    t = PG.page_titles(spark.createDataFrame([(1, doc)], "page_id long, html string")).first()
    assert (t.title, t.h1) == ("A &Bc", "xy")


def test_extract_listings_end_to_end(spark):
    jobs = spark.createDataFrame([(0, -25.3, -57.6, "Farmacia"), (1, -25.3, -57.6, "Hotel"),
                                  (2, -25.3, -57.6, "Mercado")],
                                 "job_idx long, latitude double, longitude double, keyword string")
    far = card(name="Far", lat="-25.5000000", lon="-57.9000000")
    pages = spark.createDataFrame(
        [(10, 0, panel(card(name="Near"), card(name="E", rating_block=False))),
         (11, 1, panel(far)), (12, 2, panel())],
        "page_id long, job_idx long, html string")
    ext = P.extract_listings(pages, jobs, 1000.0)
    lst = ext.listings.collect()
    assert [r.name for r in lst] == ["Near"]
    r = lst[0]
    assert (r.job_idx, r.page_id, r.pos, r.latitude, r.longitude, r.keyword, r.price, r.category,
            r.address) == (0, 10, 0, -25.3, -57.6, "Farmacia", "Moderado", "Farmacia",
                           "Av. Mcal. López 123")
    # job 1: anchors all outside -> not failed; job 2: no anchors -> failed
    assert [f.job_idx for f in ext.failed.collect()] == [2]
    summ = {s.job_idx: s for s in ext.summary().collect()}
    assert (summ[1].anchors, summ[1].outside_radius, summ[1].failed) == (1, 1, False)
    assert summ[2].failed and (summ[0].accepted, summ[0].card_errors) == (1, 1)
    kept = P.extract_listings(pages, jobs, 1000.0, missing_rating="null").listings
    assert sorted(r.name for r in kept.collect()) == ["E", "Near"]
    assert kept.where(F.col("name") == "E").first().rating is None
    ext.discard()


def test_ordinary_html_loses_no_listing(spark):
    """Markup that is legal, or that browsers accept, keeps its listing."""
    plain = card(name="X")
    hard = {
        "plain": plain,
        "gt in a label": plain.replace('aria-label="X"', 'aria-label="Bar > Grill"', 1),
        "numeric reference": plain.replace("&amp;", "&#38;", 1),
        "named reference": plain.replace("place/x", "place/caf&eacute;", 1),
        "no semicolon": plain.replace("&amp;x=1", "&copy=1", 1),
        "anchor in a textarea": "<textarea><a href=x></textarea>" + plain,
        "no space between attributes": plain.replace('" href=', '"href=', 1),
        "single quotes": plain.replace('aria-label="X"', "aria-label='X > Y'", 1),
        "anchor in noscript": "<noscript><a href=x>y</a></noscript>" + plain,
        "unclosed comment at the end": plain + "<!-- <a",
    }
    jobs = spark.createDataFrame([(0, -25.3, -57.6, "k")], "job_idx long, latitude double, longitude double, keyword string")
    pages = spark.createDataFrame([(i, 0, panel(h)) for i, h in enumerate(hard.values())], "page_id long, job_idx long, html string")
    ext = P.extract_listings(pages, jobs, 1000.0)
    rows = {r.page_id: r for r in ext.listings.collect()}
    assert sorted(rows) == list(range(len(hard)))
    links = {n: rows[i].link for i, n in enumerate(hard)}
    assert links["numeric reference"] == links["plain"] and "caf\u00e9" in links["named reference"]
    assert "\u00a9=1" in links["no semicolon"]
    scan = {(r.page_id, r.pos, r.href) for r in PG.result_anchors(pages).collect()}
    assert scan == {(r.page_id, r.pos, r.link) for r in rows.values()}
    assert ext.summary().first().accepted == len(hard)
    assert all(PG.page_rows(1, 1, panel(h)) for h in hard.values())
    assert not any(PG.page_rows(1, 1, doc) for doc in (None, "", panel(), panel("<a class=hfpxzc>"), "<!--" + plain + "-->"))


def test_pages_are_parsed_once(spark):
    """Listings, failures and summaries read the written table: no plan of theirs
    parses, and failures and summaries read two columns."""
    jobs = spark.range(3).selectExpr("id job_idx", "-25.3d latitude", "-57.6d longitude", "'k' keyword")
    pages = spark.createDataFrame([(1, 0, panel(card()))], "page_id long, job_idx long, html string")
    ext = P.extract_listings(pages, jobs)
    for df in (ext.listings, ext.failed, ext.summary()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" not in plan and "html" not in plan
    assert "PartitionFilters: [isnotnull(kind" in ext.listings._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<job_idx:bigint>" in ext.summary()._jdf.queryExecution().executedPlan().toString()
    assert ext.listings.count() == 1 and {r.job_idx for r in ext.failed.collect()} == {1, 2}
    ext.discard()


LIST = LayoutSpec(
    "mine", "go", ("hit",), card_tag="li", parts=(Part("meta", (Pick("p", "m", 0),)),),
    rules=(("name", Rule("text", (Pick("h3", index=0),))), ("rating", Rule("text", (Pick("b", index=0),), part="meta", absent=None)),
           ("amenities", Rule("attrs", (Pick("i", attrs=(("title", None),)),), attr="title"))))
LIST_PAGE = ("<ul><li class='hit'><a class=go aria-label=x href='u!3d-25.3!4d-57.6'></a><h3>Uno</h3><p class=m><b>4.0(2)</b></p>"
             "<i title='w'></i><i></i></li><li class=hit><a class=go aria-label=y href='v!3d-25.3!4d-57.6'></a><h3>Dos</h3></li></ul>")


def test_layout_made_at_run_time_works_in_workers(spark):
    jobs = spark.createDataFrame([(0, -25.3, -57.6, "k")], "job_idx long, latitude double, longitude double, keyword string")
    pages = spark.createDataFrame([(1, 0, LIST_PAGE)], "page_id long, job_idx long, html string")
    for layout in (LIST, register_layout(LIST).name):
        ext = P.extract_listings(pages, jobs, layout=layout, clean={"name": F.upper})
        row = ext.listings.first()
        assert (row.name, row.rating, row.amenities, row.price, row.address) == ("UNO", "4.0(2)", ["w"], "", "")
        assert ext.summary().first().card_errors == 1
    import pytest
    with pytest.raises(ValueError):
        P.extract_listings(pages, jobs, clean={"nothing": F.upper})


def test_layouts_that_make_no_sense_are_refused():
    import pytest
    ok = dict(name="l", anchor_class="a", card_classes=("c",))
    for bad in (dict(rules=(("colour", Rule("text")),)), dict(rules=(("name", Rule("texts")),)), dict(rules=(("name", Rule("attr")),)),
                dict(rules=(("name", Rule("text", part="p")),)), dict(rules=(), parts=(Part("a", (), base="b"), Part("b", ())))):
        with pytest.raises(ValueError):
            LayoutSpec(**ok, **bad)


def test_extraction_moves_no_html(spark):
    """One scan of the pages; no exchange or broadcast below which HTML is output."""
    jobs = spark.range(3).selectExpr("id job_idx", "0d latitude", "0d longitude", "'k' keyword")
    pages = spark.createDataFrame([(1, 0, panel(card()))], "page_id long, job_idx long, html string")
    rows = J.anchors_with_distance(PG.parse_result_pages(pages), jobs)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    above = plan[:plan.index("MapInArrow")]
    assert "html" not in above


def test_broken_card_is_counted(monkeypatch):
    monkeypatch.setattr(LayoutSpec, "extract", lambda self, card, compatible: {}["no"])
    rows = PG.page_rows(1, 1, panel(card()))
    assert rows[0]["card_error"] and not rows[0]["has_card"]


def test_unknown_layout_raises(spark):
    import pytest
    with pytest.raises(ValueError):
        PG.page_rows(1, 1, panel(card()), layout="loc9")


def test_repeated_markup_gives_the_rows_of_the_plain_way():
    """Pages read by looking their markup up have the rows of the plain way; pages
    of the same markup are looked up, whatever their texts hold."""
    from listingkit.operators.cardplans import VALUES
    plans = PG.card_plans()

    def check(doc):
        got = plans.page(doc)
        want = [(r["pos"], [r.get(c) for c in VALUES]) for r in PG.page_rows(1, 1, doc)]
        assert got is None or got == want, doc
        return got

    texts = ["X", "  X ", " ", "a > b", "it's \"q\"", "caf&eacute; &amp; Ａﬁ", " ", "1 = 2", "x=\"y\"", "&lt;a href=\"z\"&gt;"]
    for name in texts:
        assert check(panel(card(name=name), card(name="Y" + name), "<a href='q'>z</a>", card(name=name, rating_block=False))) is not None
    seen = len(plans.plans)
    assert seen < 20 and check(panel(card(name="other"), card(name="Yother"), "<a href='q'>z</a>", card(name="n", rating_block=False)))
    assert len(plans.plans) <= seen + 1
    plain = card(name="X")
    odd = [plain.replace('aria-label="X"', 'aria-label="Bar > Grill <a href=1>"', 1), plain.replace('aria-label="X"', "aria-label='X > Y'", 1),
           "<script>" + plain + "</script>" + plain, "<!--" + plain + "-->" + plain, plain.replace("<div", '<div title="a > b"', 2),
           plain.replace("</div>", "", 1), plain + "</div></div></span>" + plain, "a < b" + plain, plain[:-30], plain[:200],
           "<span>" + plain + plain + "</span>", plain.replace("</div>", plain + "</div>", 1), plain.replace("<a ", '<a title="', 1),
           '<a class="hfpxzc" aria-label="l" href="h">t</a>' + plain, "<textarea>" + plain + "</textarea>", plain.replace('class="', 'CLASS="x ')]
    for doc in odd:
        for page in (panel(doc), panel(plain, doc), panel(doc, plain), doc + doc):
            check(page)
    rng = random.Random(5)
    for _ in range(3000):                          # cut, doubled and swapped pieces of markup
        bits = re.split("(?=<)", panel(card(name=rng.choice(texts)), plain))
        for _ in range(rng.randint(1, 4)):
            i, j = rng.randrange(len(bits)), rng.randrange(len(bits))
            bits[i] = rng.choice(["", "<!-- " + bits[j], bits[i] + "-->", bits[j], bits[i] + bits[j], bits[i][:rng.randint(0, len(bits[i]))], bits[i].replace('"', "'", 1), bits[i].replace(">", "", 1)])
        check("".join(bits))


def test_page_markup_is_made_after_the_shuffle(spark):
    """The cards of a page meet as numbers: no exchange moves markup."""
    from listingkit.sources import testdata as td
    plan = td.result_pages(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("REPARTITION_BY_NUM")]
    assert "collect_list" in above and "hashpartitioning" not in above[above.index("collect_list"):].split("Exchange")[0]
    assert above.count("Exchange") == 1 and td.result_pages(spark, "/root/testdata/sf0.001").count() > 0
