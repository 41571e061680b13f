"""Result-page layouts as data.

A ``LayoutSpec`` says where the fields of a result card stand: which anchors
are results, which ancestors are cards, and for every field a path of picks
from the card (or from a named part of it) to elements, and what is taken from
them.  A spec is a plain value: it is looked up or handed in on the driver and
travels inside the task, so layouts made at run time work in every worker.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from listingkit import constants as K

#: What a field of a card may be, and its value where nothing is found.
TEXT_FIELDS = ("name", "rating", "price_label", "category_raw")
LIST_FIELDS = ("price_spans", "address_spans", "amenities")
TAKES = ("text", "texts", "attr", "attrs")


@dataclass(frozen=True)
class Pick:
    """From elements to their matching descendants (or ``children``) in document
    order, or to the ``index``-th of them.

    ``attrs`` holds (name, value) pairs, the value None for any; ``within`` is a
    (tag, class or None) that one of the element's ancestors must have."""
    tag: str
    css_class: str | None = None
    index: int | None = None
    children: bool = False
    attrs: tuple[tuple[str, str | None], ...] = ()
    within: tuple[str, str | None] | None = None

    def matches(self, node) -> bool:
        return (node.tag == self.tag and (self.css_class is None or self.css_class in node.classes)
                and all(a in node.attrs if v is None else node.attrs.get(a) == v for a, v in self.attrs)
                and (self.within is None or node.ancestor(*self.within) is not None))

    def run(self, nodes: list) -> list:
        out = []
        for node in nodes:
            for n in node.child_elements() if self.children else node.iter():
                if self.matches(n):
                    out.append(n)
                    if self.index is not None and len(out) > self.index:
                        return out[self.index:]
        return out if self.index is None else out[self.index:self.index + 1]


@dataclass(frozen=True)
class Rule:
    """What a field takes from the elements its path ends at.

    ``text`` and ``attr`` take the first, ``texts`` and ``attrs`` all.
    ``default`` stands where the path finds nothing, ``absent`` where the part
    it starts from is missing.  ``compatible`` brings text to NFKC."""
    take: str
    path: tuple[Pick, ...] = ()
    part: str | None = None
    attr: str | None = None
    default: str | None = ""
    absent: str | None = ""
    compatible: bool = False


@dataclass(frozen=True)
class Part:
    """A named element of the card; ``base`` is the part it is looked for in."""
    name: str
    path: tuple[Pick, ...]
    base: str | None = None


@dataclass(frozen=True)
class LayoutSpec:
    """``rules``: (field, rule) pairs over TEXT_FIELDS and LIST_FIELDS; fields
    without a rule are empty.  A card has a rating block if the part (or, without
    one, the element) of its ``rating`` rule is there."""
    name: str
    anchor_class: str
    card_classes: tuple[str, ...]
    rules: tuple[tuple[str, Rule], ...]
    parts: tuple[Part, ...] = ()
    card_tag: str = "div"

    def __post_init__(self):
        known = {p.name for p in self.parts}
        seen: set[str | None] = {None}
        for part in self.parts:
            if part.base not in seen:
                raise ValueError(f"layout {self.name!r}: part {part.name!r} starts from {part.base!r}, which comes later or not at all")
            seen.add(part.name)
        for field, rule in self.rules:
            if field not in (*TEXT_FIELDS, *LIST_FIELDS):
                raise ValueError(f"layout {self.name!r} has no field {field!r}; fields: {(*TEXT_FIELDS, *LIST_FIELDS)}")
            plural = rule.take in ("texts", "attrs")
            if rule.take not in TAKES or plural != (field in LIST_FIELDS) or (rule.take[:4] == "attr") != bool(rule.attr):
                raise ValueError(f"layout {self.name!r}: rule of {field!r} takes {rule.take!r} of {rule.attr!r}")
            if rule.part is not None and rule.part not in known:
                raise ValueError(f"layout {self.name!r}: rule of {field!r} starts from unknown part {rule.part!r}")

    def card_of(self, anchor):
        """Nearest ancestor of the first card class that has one."""
        for css_class in self.card_classes:
            card = anchor.ancestor(self.card_tag, css_class)
            if card is not None:
                return card
        return None

    def extract(self, card, compatible: Callable[[str], str]) -> dict:
        """Raw fields of one card."""
        parts = {None: [card]}
        for p in self.parts:
            parts[p.name] = _follow(parts[p.base], p.path)[:1]
        row = {**dict.fromkeys(TEXT_FIELDS, ""), "price_label": None, **{f: [] for f in LIST_FIELDS}, "has_rating": False}
        for field, rule in self.rules:
            start = parts[rule.part]
            found = _follow(start, rule.path)
            if field == "rating":
                row["has_rating"] = bool(found if rule.part is None else start)
            if rule.take in ("texts", "attrs"):
                values = ([n.text() for n in found] if rule.take == "texts" else
                          [n.attrs[rule.attr] for n in found if rule.attr in n.attrs])
                row[field] = [compatible(v) for v in values] if rule.compatible else values
            elif not start:
                row[field] = rule.absent
            elif not found or (rule.take == "attr" and rule.attr not in found[0].attrs):
                row[field] = rule.default
            else:
                value = found[0].text() if rule.take == "text" else found[0].attrs[rule.attr]
                row[field] = compatible(value) if rule.compatible else value
        return row


def _follow(nodes: list, path: tuple[Pick, ...]) -> list:
    for pick in path:
        nodes = pick.run(nodes)
    return nodes


_BLOCK = K.BLOCK_CLASS
_ICON = (("role", "img"), ("aria-label", None))

LOC1 = LayoutSpec(
    name="loc1", anchor_class=K.ANCHOR_CLASS, card_classes=tuple(K.CARD_CLASSES),
    parts=(
        Part("row", (Pick("div", _BLOCK, 0), Pick("div", K.RATING_ROW_CLASS, 0))),
        Part("value", (Pick("span", index=1, children=True),), base="row"),
        Part("cost", (Pick("span", index=2, children=True),), base="row"),
        Part("detail", (Pick("div", _BLOCK, 1), Pick("div", _BLOCK, 0))),
    ),
    rules=(
        ("name", Rule("text", (Pick("div", K.NAME_CLASS, 0),), compatible=True)),
        ("rating", Rule("text", (Pick("span", K.RATING_CLASS, 0),), part="value", absent=None, compatible=True)),
        ("price_label", Rule("attr", (Pick("span", index=0, attrs=_ICON),), part="cost", attr="aria-label",
                             default=None, absent=None)),
        ("price_spans", Rule("texts", (Pick("span"),), part="cost")),
        ("category_raw", Rule("text", (Pick("span", index=0, within=("span", None)),), part="detail")),
        ("address_spans", Rule("texts", (Pick("span", children=True),), part="detail")),
        ("amenities", Rule("attrs", (Pick("div", attrs=_ICON, within=("div", K.AMENITY_ROW_CLASS)),),
                           attr="aria-label", compatible=True)),
    ))

#: Layouts by name, on the driver.
LAYOUTS: dict[str, LayoutSpec] = {LOC1.name: LOC1}


def register_layout(spec: LayoutSpec) -> LayoutSpec:
    """Makes a layout known by its name."""
    LAYOUTS[spec.name] = spec
    return spec


def layout_spec(layout: str | LayoutSpec) -> LayoutSpec:
    """The spec itself, or the registered one of that name."""
    if isinstance(layout, LayoutSpec):
        return layout
    try:
        return LAYOUTS[layout]
    except KeyError:
        raise ValueError(f"unknown page layout {layout!r}; known: {sorted(LAYOUTS)}") from None
