"""Card extraction by the markup of a card: pages that repeat the same markup
with other texts are read by looking the markup up.

A page is cut where cards begin.  A piece is split into its markup and its
values (texts between tags, attribute values in double quotes).  The first piece
of a markup is parsed as a tree, with a marker for every value; the rows it
gives say which value goes where, and every later piece of that markup takes its
values from there.  The elements that are open where a piece begins belong to
its key.

No value changes what the tree is: each marker must come back as a whole text
or a whole attribute value, so that the tokenizer is inside that text or value
whatever it holds.  Where this does not show - a marker is lost or stands inside
something else, a tag is cut, a card is still open where the next one begins -
the page is left to the plain way.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from listingkit.functions.text import compatible
from listingkit.operators.layouts import LayoutSpec

#: Markups kept, at most, in a task.
KEPT = 8192
_OPEN, _CLOSE = "", ""
_MARK = re.compile(f"{_OPEN}(\\d+){_CLOSE}")
#: Columns of a row that the card gives, with ``href``.
VALUES = ("href", "has_card", "has_rating", "card_error", "name", "rating", "price_label", "price_spans",
          "category_raw", "address_spans", "amenities")

Getter = Callable[[list], object]


def _constant(value) -> Getter:
    return lambda values: value


def _reader(value, plain, is_text: bool, folded: bool, decode: Callable[[str], str]) -> Getter:
    """How a value of the marked card is made from the values of another one."""
    if isinstance(value, list):
        each = [_reader(v, p, is_text, folded, decode) for v, p in zip(value, plain)]
        return lambda values: [f(values) for f in each]
    if not isinstance(value, str) or not _MARK.search(value):
        return _constant(plain)
    bits = _MARK.split(value)                      # constants and value numbers in turn
    at = [int(b) for b in bits[1::2]]
    fixed = bits[::2]

    def one(text: str) -> str:
        text = decode(text) if "&" in text else text
        return text.strip() if is_text else text

    if len(at) == 1 and not any(fixed):            # the usual case: one whole value
        k = at[0]

        def read_one(values: list) -> str:
            text = values[k]
            if "&" in text:
                text = decode(text)
            if is_text:
                text = text.strip()
            return compatible(text) if folded and not text.isascii() else text
        return read_one

    def read(values: list) -> str:
        out = "".join([fixed[0], *(one(values[k]) + f for k, f in zip(at, fixed[1:]))])
        return compatible(out) if folded else out
    return read


class CardPlans:
    """Rows of pages of one layout; ``bare`` takes comments and bodies without
    elements out of a page, ``build`` makes (root, innermost open element, whether
    there were stray signs) of what is left, ``rows`` is the plain way: the rows
    of (anchors in order, layout, what brings text to NFKC)."""

    def __init__(self, spec: LayoutSpec, bare: Callable[[str], str], build, decode: Callable[[str], str], rows):
        self.spec, self.bare, self.build, self.decode, self.rows = spec, bare, build, decode, rows
        self.plans: dict = {}
        picks = [p for holder in (*spec.parts, *(r for _, r in spec.rules)) for p in holder.path]
        tested = {"class", *(a.lower() for p in picks for a, v in p.attrs if v is not None)}
        kept = "".join(f"(?<!(?i:{re.escape(a)})=\")" for a in sorted(tested))
        self.values = re.compile(f"(>|=\")((?<=>)[^<]+|(?<=\"){kept}[^\"]*)")
        rule = dict(spec.rules)
        self.kinds = {f: (rule[f].take in ("text", "texts"), rule[f].compatible) for f in rule}

    def page(self, doc: str) -> list[tuple[int, list]] | None:
        """(pos, VALUES) of every result anchor, or None: to be read the plain way."""
        doc = self.bare(doc)
        starts = next(filter(None, (self._starts(doc, c) for c in self.spec.card_classes)), [])
        cuts = [0, *(s for s in starts if s), len(doc)]
        out, pos, stack = [], 0, ()
        for k in range(len(cuts) - 1):
            bits = self.values.split(doc[cuts[k]:cuts[k + 1]])
            values = bits[2::3]
            del bits[2::3]
            key = (stack, tuple(bits))
            plan = self.plans.get(key)
            if plan is None:
                if len(self.plans) >= KEPT:
                    self.plans.clear()
                plan = self.plans[key] = self._plan(stack, bits)
            anchors, rows, stack, card_open = plan
            if anchors < 0 or (card_open and k < len(cuts) - 2):
                return None
            for place, readers in rows:
                out.append((pos + place, [f(values) for f in readers]))
            pos += anchors
        return out

    def _starts(self, doc: str, css_class: str) -> list[int]:
        """Where tags with the class begin: pieces may begin at any tag."""
        tag, out, at = f"<{self.spec.card_tag}", [], doc.find(css_class)
        while at >= 0:
            start = doc.rfind("<", 0, at)
            if start >= 0 and doc.startswith(tag, start) and (not out or start > out[-1]):
                out.append(start)
            at = doc.find(css_class, at + 1)
        return out

    def _plan(self, stack: tuple, bits: list[str]) -> tuple:
        """(anchors, rows as (place, readers), open elements after, a card is open)."""
        no = (-1, [], (), False)
        markup = "".join(bits)
        if _OPEN in markup or _CLOSE in markup:
            return no
        n = len(bits) // 2
        marked = "".join([bits[0], *(f"{bits[2 * i + 1]}{_OPEN}{i}{_CLOSE}{bits[2 * i + 2]}" for i in range(n))])
        before = "".join(f'<{tag} class="{css}">' for tag, css in stack)
        root, last, stray = self.build(before + marked)
        if stray:
            return no
        nodes = root.iter()
        whole = {t for e in (root, *nodes) for t in e.children if isinstance(t, str)}
        whole |= {v for e in nodes for v in e.attrs.values()}
        if not all(f"{_OPEN}{i}{_CLOSE}" in whole for i in range(n)):
            return no
        anchors = [e for e in nodes[len(stack):] if e.tag == "a"]
        rows = []
        for marked_row, plain in zip(self.rows(anchors, self.spec, str), self.rows(anchors, self.spec, compatible)):
            readers = [_reader(marked_row.get(c), plain.get(c), *self.kinds.get(c, (False, False)), self.decode) for c in VALUES]
            rows.append((plain["pos"], readers))
        after, card_open = [], False
        while last is not root:
            css = last.attrs.get("class", "")
            if _MARK.search(css) or '"' in css or "&" in css:
                return no
            after.append((last.tag, css))
            card_open |= last.tag == self.spec.card_tag and not last.classes.isdisjoint(self.spec.card_classes)
            last = last.parent
        return len(anchors), rows, tuple(reversed(after)), card_open
