"""Operator 9: main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block of the page, in one linear pass of a tokenizer with HTML's states: a quote
counts only where a value starts, a tag, comment or raw element that never ends takes the rest of the page, and an end tag
finds its element by name. A line's weight is its number of characters outside of links. The weights are summed over sliding
windows of lines; text surges where a sum reaches a threshold, and dives where the sum falls to zero. Lines between a surge
and its dive that aren't furniture are the text, those that are wholly links too.

* Furniture weighs nothing and is never text. Menus, footers, asides, scripts, what is hidden and the like are told by element
  or role; page headers, forms and what a class or id names as a whole ("sidebar", "ad-box") are furniture unless they
  hold most of the page's text; names of reader comments unless nothing else is there. What a heading calls comments ("12
  Comments") is furniture from that heading on.
* A name of which only one word tells furniture ("related-work") makes a line outside of a marked part weigh a quarter.
* An article or main part is a mark, not a switch: its links weigh too, and a surge there takes less. Windows end at its
  borders, and what stands outside is text where its largest window sum is OUTSIDE of the page's largest.

Nothing else is dropped, and no length is bounded. Each page is handled by itself: no shuffle, and a hot host or copied page
has no effect.

Results in special cases: null or empty html, and pages of furniture alone, give the empty text; markup that never closes
ends with its parent; furniture without an end tag ends where an article or main part starts; text without markup is one line;
very long pages and malformed markup take time in proportion to their length; equal pages give equal texts; columns named
text or n_chars are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels

WINDOW = 3
#: A surge takes this share of the page's largest window sum, or SURGE characters if that is less.
SURGE_SHARE, SURGE = 0.2, 80
#: What stands outside of the marked parts takes this share of the page's largest window sum.
OUTSIDE = 0.5
#: Share of the page's text from which on a name doesn't make furniture: of other names, and of reader comments.
MOST, MOST_COMMENTS = 0.5, 0.9
#: Weight of a line in an element of whose name one word tells furniture.
SUSPECT = 0.25
# A value is quoted only right after "="; of a quote without its partner there is no other, so the scan stays linear.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++|))*+)>""")
ATTRIBUTE = re.compile(r"""([^\s/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|(?!["'])\S++|))?""")
COMMENT_END = re.compile(r"--!?>")
SPLIT = re.compile(r"[\s_\-:.]+|(?<=[a-z])(?=[A-Z])")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: HTML elements by what they are.
RAW = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in "script style noscript textarea iframe title xmp noembed noframes".split()}
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACELESS = frozenset("img wbr input area base link meta param source track".split())
FURNITURE = frozenset("nav footer aside button head menu dialog template svg math select".split())
BY_SHARE = frozenset("form header".split())
MAIN = frozenset("article main".split())
WHOLE = frozenset("html body main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that end when one of the same kind starts beside them; a paragraph ends at any block.
BESIDE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Words of a class or id that tell furniture, and words before them that take this back.
COMMENT_WORDS = frozenset("comment comments commentlist disqus reply replies respond kommentare commentaires comentarios".split())
FURNITURE_WORDS = COMMENT_WORDS | frozenset("ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar sidebars menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar social share sharing related recommended widget widgets login signup search header".split())
#: Words that make a whole name of furniture with one of those; other words make a topic of it.
BOX_WORDS = frozenset("area bar block bottom box btn button buttons container content entry form global group holder icons inner item items left links list main module outer page panel post posts primary right secondary section site slot top unit wrap wrapper".split())
TAKES_BACK = frozenset("no has with without".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar".split())
#: What headings call reader comments, without numbers and signs.
COMMENT_TITLES = frozenset("comments|comment|reader comments|readers comments|user comments|leave a comment|leave a reply|post a comment|add a comment|join the discussion|kommentare|kommentar|leserkommentare|kommentar schreiben|commentaires|commentaire|laisser un commentaire|comentarios|comentario|deja un comentario|deja una respuesta".split("|"))


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("", text, ""), ("<", name, attributes) and ("/", name, "") of a page, in order."""
    at, size = 0, len(html)
    while at < size:
        low = html.find("<", at)
        if low < 0:
            low = size
        if low > at:
            yield "", html[at:low], ""
        if low == size:
            return
        after = html[low + 1 : low + 2]
        if after.isascii() and after.isalpha() or after == "/" and html[low + 2 : low + 3].isascii() and html[low + 2 : low + 3].isalpha():
            m = TAG.match(html, low)
            if not m:  # a tag that never ends
                return
            at, name = m.end(), m[2].lower()
            if m[1]:
                yield "/", name, ""
                continue
            yield "<", name, m[3]
            if name in RAW:
                end = RAW[name].search(html, at)
                if not end:
                    return
                at = end.start()
        elif html.startswith("<!--", low):
            if html.startswith((">", "->"), low + 4):
                at = html.index(">", low) + 1
                continue
            end = COMMENT_END.search(html, low + 4)
            if not end:
                return
            at = end.end()
        elif after in ("!", "?", "/") and after:
            at = html.find(">", low) + 1
            if not at:
                return
        else:
            yield "", "<", ""
            at = low + 1


@dataclass(slots=True)
class Element:
    name: str
    parent: int
    first: int  #: its first line
    kind: int = 0  #: see kind_of
    last: int = -1  #: the line after its last one
    closed: bool = False  #: whether it has an end tag
    plain: int = 0


#: What a name or element says: nothing, partly furniture, furniture unless it holds most of the text, comments, furniture.
PLAIN, SUSPECTED, NAMED, COMMENTS, SURE = range(5)


def kind_of(name: str, attributes: str, inside: bool) -> int:
    """inside: whether an article or main part is open."""
    kind = SURE if name in FURNITURE else NAMED if name == "form" or name == "header" and not inside else PLAIN
    if not attributes or kind == SURE:
        return kind
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and UNSEEN.search(value):
            return SURE
        if key == "role" and value.lower() in FURNITURE_ROLES:
            return SURE
        if key in ("class", "id") and name not in WHOLE and not (key == "id" and (name in HEADINGS or name == "p")):
            for one in unescape(value).split():
                words = {w.lower() for w in SPLIT.split(one) if w}
                told = words & FURNITURE_WORDS
                if not told or words & TAKES_BACK or told == {"header"} and inside:
                    continue
                if words & COMMENT_WORDS:
                    kind = max(kind, COMMENTS if words <= FURNITURE_WORDS | BOX_WORDS or key == "class" else SUSPECTED)
                elif name not in MAIN:
                    kind = max(kind, NAMED if words <= FURNITURE_WORDS | BOX_WORDS else SUSPECTED)
    return kind


class Page:
    """Lines of a page and the elements that hold them; an element's lines are successive."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.plain: list[int] = []  # characters outside of links
        self.owner: list[int] = []
        self.elements = [Element("", -1, 0)]
        self._parts: list[str] = []
        self._linked = self._link = self._inside = 0
        self._open = [0]
        self._by_name: dict[str, list[int]] = {}  # places in _open
        self._told: dict[str, int] = {}  # inline furniture that is open
        for kind, what, attributes in tokens(html):
            if not kind:
                self._parts.append(what)
                if self._link:
                    self._linked += len(what)
            elif kind == "<":
                self._start(what, attributes)
            else:
                self._end(what)
        self._line()
        self._close(1)
        self.elements[0].last = len(self.texts)

    def _line(self) -> None:
        if self._parts:
            text = " ".join(unescape("".join(self._parts)).split())
            if text:
                self.texts.append(text)
                self.plain.append(max(0, len(text) - self._linked))
                self.owner.append(self._open[-1])
            self._parts.clear()
        self._linked = 0

    def _close(self, place: int) -> None:
        """Ends the open elements from this place on."""
        for k in self._open[place:]:
            e = self.elements[k]
            e.last = len(self.texts)
            self._by_name[e.name].pop()
            self._inside -= e.name in MAIN
            if e.name in INLINE:
                self._told[e.name] -= 1
        del self._open[place:]

    def _push(self, name: str, kind: int) -> None:
        self._by_name.setdefault(name, []).append(len(self._open))
        self._open.append(len(self.elements))
        self.elements.append(Element(name, self._open[-2], len(self.texts), kind))
        self._inside += name in MAIN

    def _start(self, name: str, attributes: str) -> None:
        if name in VOID:
            if name not in SPACELESS:
                self._line()
            return
        if name in INLINE:
            if name == "a":
                self._link = 1
            kind = kind_of(name, attributes, self._inside > 0) if attributes else PLAIN
            if kind >= NAMED or self._told.get(name):  # nested ones are counted, so that the right end tag ends it
                self._line()
                self._push(name, kind)
                self._told[name] = self._told.get(name, 0) + 1
            return
        self._line()
        self._link = 0
        top = self.elements[self._open[-1]].name
        if top == "p":
            self._close(len(self._open) - 1)
            top = self.elements[self._open[-1]].name
        while top in BESIDE.get(name, ()):
            self._close(len(self._open) - 1)
            top = self.elements[self._open[-1]].name
        if name == "body":
            self._close(1)
        self._push(name, kind_of(name, attributes, self._inside > 0))

    def _end(self, name: str) -> None:
        if name == "a":
            self._link = 0
        if name in INLINE and not self._told.get(name):
            return
        self._line()
        places = self._by_name.get(name)
        if not places or name in VOID:
            return
        self.elements[self._open[places[-1]]].closed = True
        self._close(places[-1])

    def furniture(self) -> tuple[list[bool], list[bool], list[bool]]:
        """Of each line whether it is furniture, stands in a marked part, and is suspected to be furniture."""
        elements, n = self.elements, len(self.texts)
        sums = [0, *accumulate(self.plain)]
        held = lambda e: sums[e.last] - sums[e.first]
        mains = [k for k, e in enumerate(elements) if e.name in MAIN and e.kind < NAMED]
        bad, inside, suspect = ([0] * (n + 1) for _ in range(3))

        def cover(steps: list[int], low: int, high: int) -> None:
            if low < high:
                steps[low] += 1
                steps[high] -= 1

        starts = [elements[k].first for k in mains]
        main_at = 0
        sure = [0] * (n + 1)
        for k, e in enumerate(elements):  # in page order, so the next main part is found by one walk
            while main_at < len(mains) and mains[main_at] <= k:
                main_at += 1
            if e.kind == SURE:
                cut = not e.closed and main_at < len(mains) and starts[main_at] < e.last
                cover(sure, e.first, starts[main_at] if cut else e.last)
        gone = list(accumulate(sure[:n]))
        left = [0, *accumulate(0 if g else p for g, p in zip(gone, self.plain))]
        total = left[n]
        for e in elements[1:]:
            if e.kind in (NAMED, COMMENTS):
                if left[e.last] - left[e.first] <= (MOST if e.kind == NAMED else MOST_COMMENTS) * total or not total:
                    cover(bad, e.first, e.last)
            elif e.kind == SUSPECTED:
                cover(suspect, e.first, e.last)
            if e.name in HEADINGS and e.name != "h1" and e.last == e.first + 1 and is_comment_title(self.texts[e.first]):
                self._under_heading(e, lambda low, high: cover(bad, low, high))
        for k in mains:
            cover(inside, elements[k].first, elements[k].last)
        bad = [a > 0 or b > 0 for a, b in zip(accumulate(bad[:n]), gone)]
        inside = [x > 0 and not b for x, b in zip(accumulate(inside[:n]), bad)]
        return bad, inside, [x > 0 for x in accumulate(suspect[:n])]

    def _under_heading(self, heading: Element, cover) -> None:
        """Lines from a heading to the end of what holds it, or to the next heading that ranks as high."""
        parent = self.elements[heading.parent]
        end = parent.last
        for at in range(heading.first + 1, parent.last):
            e = self.elements[self.owner[at]]
            if e.name in HEADINGS and e.name <= heading.name:
                end = at
                break
        cover(heading.first, end)


def is_comment_title(text: str) -> bool:
    return len(text) < 60 and " ".join(re.sub(r"[\W\d_]+", " ", text).casefold().split()) in COMMENT_TITLES


def main_text(html: str | None, window: int = WINDOW) -> str:
    page = Page(html or "")
    bad, inside, suspect = page.furniture()
    marked = any(inside)
    weights = [0 if b else len(t) if i else p * (SUSPECT if s else 1) for t, p, b, i, s in zip(page.texts, page.plain, bad, inside, suspect)]
    # Furniture goes with what stands around it, so it doesn't end a part.
    runs: list[tuple[int, int]] = []
    side = None
    for at, w in enumerate(weights):
        if not runs or marked and w and side is not None and inside[at] != side:
            runs.append((at, at + 1))
        else:
            runs[-1] = (runs[-1][0], at + 1)
        if w:
            side = inside[at]
    sums: list[float] = []
    for low, high in runs:
        total = [0, *accumulate(weights[low:high])]
        sums += [total[min(i + window, high - low)] - total[i] for i in range(high - low)]
    largest = max(sums, default=0)
    surge = min(SURGE, SURGE_SHARE * largest)
    out = []
    for low, high in runs:
        if marked and not any(inside[low:high]) and max(sums[low:high]) < OUTSIDE * largest:
            continue
        within = False
        for at in range(low, high):
            if not within:
                within = weights[at] > 0 and sums[at] + surge * inside[at] >= surge
            elif sums[at] == 0:
                within = False
            if within and not bad[at]:
                out.append(page.texts[at])
    return " ".join(out)


def extract(pages: DataFrame, html: str = "html", window: int = WINDOW) -> DataFrame:
    """Adds text and n_chars (its code points) of each page; html goes, columns with these names are replaced."""
    kept = [c for c in pages.columns if c not in ("text", "n_chars", html)]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.rebatched(batches, html):
            texts = [main_text(h, window) for h in batch[html].to_pylist()]
            columns = [batch[c] for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*kept, "text", "n_chars"])

    rows = pages.select(*kept, html)
    return rows.mapInArrow(extracted, kernels.added(pages.select(*kept), "text string", "n_chars long"))
