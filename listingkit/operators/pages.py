"""Result-page operators: anchors, titles and card extraction.

``page_anchors`` and ``page_titles`` are Catalyst (regex over the HTML column;
only values that hold a character reference are decoded in Python).  Card
extraction needs the element tree (nearest card ancestor, direct children,
nested same-class blocks), which no Spark function offers, so it runs as
``mapInArrow`` in one pass over the pages: a small tokenizer builds each page's
tree, decides which anchors exist, and emits one small row of *raw* fields per
result anchor.  Everything downstream (link coordinates, radius test, text,
price, category and address rules) is Catalyst again; page HTML never moves.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingkit import constants as K
from listingkit.functions.fields import PY_SPACE, py_strip
from listingkit.functions.text import compatible
from listingkit.operators.cardplans import VALUES, CardPlans
from listingkit.operators.layouts import LayoutSpec, layout_spec

# ---------------------------------------------------------------- Catalyst J3/J7

def _attr(tag_text, name: str):
    """Value of attribute ``name`` in a start tag (any quoting), null if absent."""
    pat = f"(?is)(?<![\\w-]){re.escape(name)}\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>]+)"
    raw = F.regexp_extract(tag_text, pat, 1)
    quoted = raw.startswith('"') | raw.startswith("'")
    return F.when(raw == "", F.lit(None)).when(
        quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)


@F.pandas_udf(T.StringType())
def _decode(s: pd.Series) -> pd.Series:
    return s.map(htmllib.unescape, na_action="ignore")


def unescape(c):
    """Character references (named and numeric) decoded; values without ``&`` are
    not handed to Python."""
    return F.coalesce(_decode(F.when(c.contains("&"), c)), c)


def _class_test(tag, css_class: str):
    """``tag`` (a start tag's text) has ``css_class`` among its class tokens."""
    tok = re.escape(css_class)
    pat = (f"(?is)(?<![\\w-])class\\s*=\\s*(?:\"[^\"]*(?<![^\\s\"]){tok}(?![^\\s\"])"
           f"|'[^']*(?<![^\\s']){tok}(?![^\\s'])|{tok}(?=[\\s>/]))")
    return F.lower(tag).contains(css_class.lower()) & tag.rlike(pat)


def _attr_test(tag, name: str):
    return tag.rlike(f"(?i)(?<![\\w-]){re.escape(name)}(?:\\s*=|[\\s/>])")


# Comments and the bodies of script, style, textarea and title hold no elements
# (the tree builder skips them too).  One regex pass matches them *and* the
# anchor start tags, so an ``<a`` inside them is consumed by that match; the
# anchor items are then kept.  A ``>`` inside a quoted attribute is no tag end.
CONTENT_ANCHORS_RE = ("(?is)<!--.*?-->|<(script|style|textarea|title)\\b[^>]*>.*?</\\1\\s*>"
                      "|<a(?:\\s(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)?>")


def anchor_tags(html):
    """Anchor start tags of a page in document order, outside comments/scripts."""
    items = F.regexp_extract_all(html, F.lit(CONTENT_ANCHORS_RE), F.lit(0))
    return F.filter(items, lambda t: F.lower(F.substring(t, 1, 2)) == "<a")


def page_anchors(pages: DataFrame, css_class: str | None = None,
                 require_attr: str | None = None, id_col: str = "page_id",
                 extra_cols: list[str] | None = None) -> DataFrame:
    """``<a ...>`` start tags in document order -> (id, pos, href, label).

    ``pos`` is the tag's ordinal among *all* anchors of the page (the element
    tree numbers them the same way), so narrowing to ``a.<css_class>[<attr>]``
    is a plain row filter: no array lambdas, no window to renumber.
    """
    extra = list(extra_cols or [])
    df = pages.select(id_col, *extra, F.posexplode(anchor_tags(F.col("html")))
                      .alias("pos", "_start"))
    if css_class:
        df = df.where(_class_test(F.col("_start"), css_class))
    if require_attr:
        df = df.where(_attr_test(F.col("_start"), require_attr))
    return df.select(
        id_col, *extra, F.col("pos").cast("bigint").alias("pos"),
        unescape(_attr(F.col("_start"), "href")).alias("href"),
        unescape(_attr(F.col("_start"), "aria-label")).alias("label"))


def page_titles(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """``<title>`` and first ``<h1>`` text like ``get_text(strip=True)``: text
    pieces stripped and joined with no separator, entities decoded."""
    def inner(tag):
        raw = F.regexp_extract(F.col("html"), f"(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}\\s*>", 1)
        joined = F.regexp_replace(raw, f"{PY_SPACE}*<[^>]*>{PY_SPACE}*", "")
        return py_strip(unescape(joined))
    return pages.select(id_col, inner("title").alias("title"), inner("h1").alias("h1"))


# ---------------------------------------------------------------- element tree

_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
         "source", "track", "wbr"}
def _unescape(text: str) -> str:
    return htmllib.unescape(text) if "&" in text else text


class Node:
    """Element of a parsed page.  All elements of a page live in one pre-order
    list; ``idx``/``end`` delimit a node's descendants in it, so descendant
    queries are list slices rather than tree walks."""

    __slots__ = ("tag", "attrs", "classes", "children", "parent", "idx", "end", "doc")

    def __init__(self, tag: str, attrs: dict, classes: frozenset, parent: Node | None, idx: int, doc: list):
        self.tag = tag
        self.attrs = attrs
        self.classes = classes
        self.children: list = []          # Node or str
        self.parent = parent
        self.idx = idx
        self.end = idx + 1
        self.doc = doc

    # -- traversal
    def iter(self) -> list[Node]:
        """Descendants in document order (excluding self)."""
        return self.doc[self.idx + 1:self.end]

    def child_elements(self) -> list[Node]:
        return [n for n in self.children if isinstance(n, Node)]

    def ancestor(self, tag: str, cls: str | None = None) -> Node | None:
        p = self.parent
        while p is not None:
            if p.tag == tag and (cls is None or cls in p.classes):
                return p
            p = p.parent
        return None

    def text(self) -> str:
        """Text pieces stripped and joined with no separator (get_text(strip=True))."""
        out = []
        stack = list(reversed(self.children))
        while stack:
            n = stack.pop()
            if isinstance(n, Node):
                if n.tag not in ("script", "style"):
                    stack.extend(reversed(n.children))
            else:
                s = n.strip()
                if s:
                    out.append(s)
        return "".join(out)


_ALL_TOKENS = re.compile(
    r"([^<]+)|<!--.*?-->|<![^>]*>|<\?[^>]*>"
    r"|</\s*([a-zA-Z][\w:-]*)\s*>"
    r"|<([a-zA-Z][\w:-]*)((?:[^>\"'/]++|/(?!>)|\"[^\"]*+\"|'[^']*+')*+)(/?)>"
    r"|(<)", re.S)
_RAW_BODY = re.compile(r"(?is)(<(script|style|textarea|title)\b[^>]*>)(.*?)(</\2\s*>)")


def _raw_body(m: re.Match) -> str:
    tag = m.group(2).lower()
    if tag in ("script", "style"):
        return m.group(1) + m.group(4)            # bodies hold no elements and no text
    return m.group(1) + m.group(3).replace("<", "&lt;") + m.group(4)


_HAS_RAW = re.compile(r"(?i)<(?:script|style|title|textarea)\b")


def _markup(doc: str) -> str:
    """The page with the bodies that hold no elements taken out or escaped."""
    return _RAW_BODY.sub(_raw_body, doc) if _HAS_RAW.search(doc) else doc


def _bare(doc: str) -> str:
    """``_markup`` with its comments emptied."""
    doc = _markup(doc)
    if "<!--" not in doc:
        return doc
    return _ALL_TOKENS.sub(lambda m: "<!>" if m.group().startswith("<!--") else m.group(), doc)


@lru_cache(maxsize=8192)
def _attributes(raw: str) -> tuple[dict[str, str], frozenset]:
    """(attributes, classes) of a start tag, decoded; the first of a name counts.

    Cards of a page repeat the same few tags, so most are looked up; nobody
    changes what is returned."""
    attrs: dict[str, str] = {}
    for name, *values in (m.groups() for m in _ATTR.finditer(raw)):
        value = next((v for v in values if v is not None), "")
        attrs.setdefault(name.lower(), _unescape(value))
    return attrs, frozenset(attrs.get("class", "").split())


def parse_html(doc: str) -> Node:
    """Tolerant tree builder: unmatched end tags are ignored, open ones closed at EOF.

    One C-level ``findall`` tokenizes the page; whitespace-only text is dropped,
    as ``get_text(strip=True)`` never uses it.
    """
    return _build(_markup(doc))[0]


def _build(doc: str) -> tuple[Node, Node, bool]:
    """(root, innermost element open at the end, whether a ``<`` began no tag)."""
    strays = False
    nodes: list[Node] = []
    root = Node("#root", {}, frozenset(), None, -1, nodes)
    cur = root
    kids = root.children
    for text, end_tag, start_tag, raw_attrs, selfclose, stray in _ALL_TOKENS.findall(doc):
        if text:
            if not text.isspace():
                kids.append(_unescape(text) if "&" in text else text)
        elif start_tag:
            tag = start_tag.lower()
            attrs, classes = _attributes(raw_attrs)
            node = Node(tag, attrs, classes, cur, len(nodes), nodes)
            nodes.append(node)
            kids.append(node)
            if tag not in _VOID and not selfclose:
                cur = node
                kids = node.children
        elif end_tag:
            tag = end_tag.lower()
            p = cur
            while p is not None and p.tag != tag:
                p = p.parent
            if p is not None and p is not root:
                q = cur                     # close p and everything still open inside it
                while q is not p:
                    q.end = len(nodes)
                    q = q.parent
                p.end = len(nodes)
                cur = p.parent
                kids = cur.children
        elif stray:
            strays = True
            kids.append("<")
    last = cur
    while cur is not None and cur is not root:
        cur.end = len(nodes)
        cur = cur.parent
    root.end = len(nodes)
    return root, last, strays


# ---------------------------------------------------------------- card extraction

CARD_FIELDS = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("job_idx", T.LongType()),
    T.StructField("pos", T.LongType()), T.StructField("href", T.StringType()),
    T.StructField("has_card", T.BooleanType()),
    T.StructField("has_rating", T.BooleanType()),
    T.StructField("card_error", T.BooleanType()),
    T.StructField("name", T.StringType()), T.StructField("rating", T.StringType()),
    T.StructField("price_label", T.StringType()),
    T.StructField("price_spans", T.ArrayType(T.StringType())),
    T.StructField("category_raw", T.StringType()),
    T.StructField("address_spans", T.ArrayType(T.StringType())),
    T.StructField("amenities", T.ArrayType(T.StringType())),
])


def page_rows(page_id: int, job_idx: int, doc: str | None, layout: str | LayoutSpec = "loc1") -> list[dict]:
    """One dict per result anchor (``a.<anchor class>[aria-label]``) of a page.

    ``pos`` is the anchor's ordinal among all ``<a>`` elements of the page.  A
    card whose fields cannot be read loses them, not its row: ``card_error``
    marks it, so that summaries can count it."""
    spec = layout_spec(layout)
    if not doc:
        return []
    anchors = [n for n in parse_html(doc).iter() if n.tag == "a"]
    return [dict(page_id=page_id, job_idx=job_idx, **row) for row in _anchor_rows(anchors, spec, compatible)]


def _anchor_rows(anchors: list[Node], spec: LayoutSpec, fold: Callable[[str], str]) -> list[dict]:
    """One dict per result anchor among the anchors; ``fold`` brings text to NFKC."""
    rows = []
    for pos, a in enumerate(anchors):
        if spec.anchor_class not in a.classes or "aria-label" not in a.attrs:
            continue
        card = spec.card_of(a)
        row = dict(pos=pos, href=a.attrs.get("href", ""), has_card=card is not None, has_rating=False, card_error=False)
        if card is not None:
            try:
                row.update(spec.extract(card, fold))
            except (KeyError, IndexError, AttributeError, ValueError, TypeError):
                row.update(has_card=False, card_error=True)
        rows.append(row)
    return rows


def card_plans(layout: str | LayoutSpec = "loc1") -> CardPlans:
    """Reads pages of a layout like ``page_rows``, repeated markup by looking it up."""
    return CardPlans(layout_spec(layout), _bare, _build, htmllib.unescape, _anchor_rows)


OUT_BATCH_ROWS = 2048


def parse_result_pages(pages: DataFrame, layout: str | LayoutSpec = "loc1") -> DataFrame:
    """Pages ``(page_id, job_idx, html)`` -> one raw row per result anchor.

    The layout's rules travel inside the tasks.  Pages that do not hold its
    anchor class at all never leave the JVM."""
    from pyspark.sql.pandas.types import to_arrow_schema
    spec = layout_spec(layout)                     # an unknown name fails here, on the driver
    schema = to_arrow_schema(CARD_FIELDS)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = card_plans(spec)
        for b in batches:
            out: list[tuple] = []
            for pid, jid, doc in zip(*(c.to_pylist() for c in b.columns)):
                rows = plans.page(doc)
                if rows is None:
                    out.extend((pid, jid, r["pos"], *map(r.get, VALUES)) for r in page_rows(pid, jid, doc, spec))
                else:
                    out.extend((pid, jid, pos, *values) for pos, values in rows)
                if len(out) >= OUT_BATCH_ROWS:     # bound worker memory on huge pages
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

    held = pages.where(F.col("html").contains(spec.anchor_class)).select("page_id", "job_idx", "html")
    return held.mapInArrow(run, CARD_FIELDS)


def result_anchors(pages: DataFrame, anchor_class: str = K.ANCHOR_CLASS) -> DataFrame:
    """Result anchors ``a.<class>[aria-label]`` of captured pages, by the scan
    inside the JVM: (page_id, job_idx, pos, href, label)."""
    a = page_anchors(pages.select("page_id", "job_idx", "html"), anchor_class, "aria-label",
                     extra_cols=["job_idx"])
    return a.select("page_id", "job_idx", "pos", F.coalesce("href", F.lit("")).alias("href"), "label")
