"""Main text of HTML pages by tree scoring.

A page is cut into tags and text once, and its element tree is built with the
implied end tags of HTML. Menus, page headers, footers, sidebars, forms, scripts
and styles go by their tags and roles, and so does what is hidden. Every other
paragraph gives points to its ancestors, for its length and its commas, less its
share of link text: all of them to its container, half to the next one, and a
third of what each further one gets to the one above it. The container with the
most points, less its own share of link text, is the article (or the ``article``
or ``main`` element that it stands in); siblings that have a fifth of its points,
or are headings before it or paragraphs like its own, are kept with it.

Boxes whose class or id names an advert, notice, menu, share bar, comment list
and the like and nothing else ("ad-box", not "notice-of-research") are suspect.
Their paragraphs count a fifth, so that the rest of a page wins against them,
and a suspect box inside the article goes unless it holds most of its text.
Headings and paragraphs are never suspect but for the names of adverts and
notices themselves. Outside ``article`` and ``main`` elements lists of short
links are menus and go; nothing else is dropped or cut. Every step takes time in
proportion to the page, however deep its elements are nested.

Blocks are the runs of text between block-level tags; in each, character
references are decoded and white space becomes one blank; blocks are joined in
page order by a line feed.

Defined results: a null or empty page, or one without text, gives an empty
text; repeated rows give the same text; a page in which nothing scores gives
all its text that is not dropped; unclosed or stray tags never fail; an empty
table gives no rows; columns named text or n_chars are replaced, others kept.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import table

# Elements of HTML by their kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = frozenset("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption caption address summary".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("nav aside footer form button select input textarea script style template noscript iframe object embed svg canvas audio video dialog menu title head fieldset datalist".split())
WHOLE = frozenset("html body article main".split())
#: Start tags that end an open element of these names, up to the nearest of the barriers.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"), "thead": ("tr", "td", "th"),
}
BARRIER = frozenset("html body table ul ol dl select article section div main td th".split())

# Words in class or id that name what isn't the article, those that do so for a paragraph too, and words
# that only say what kind of box it is. Roles that say so by themselves.
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer foot colophon sidebar aside rail widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social follow related recommended recommendations comment comments commentlist respond reply replies disqus discussion pagination pager toolbar copyright disclaimer skip search complementary contentinfo dialog".split()
)
STRONG = frozenset("ad ads adv advert adverts advertisement advertising adsense sponsored promo cookie cookies consent gdpr newsletter copyright".split())
KIND = frozenset(
    "area bar block body bottom box button buttons card cards col column container content form group inner item items left link links list main module outer page panel post posts articles reader row right section site slot stories text title top unit user users wrap wrapper thread policy message icons media".split()
)
ROLES = frozenset("navigation banner contentinfo search complementary dialog alertdialog alert form menu menubar toolbar".split())
NEGATED = frozenset("has with no without is non not".split())
#: A suspect paragraph's share of points, and how much of the article's text a suspect box must hold to stay.
SUSPECT, MOST = 0.2, 0.5
#: A list is a menu if its text is links for the larger part, in so many blocks of so few characters.
MENU_LINKS, MENU_BLOCKS, MENU_CHARS = 0.75, 3, 30

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.DOTALL)
_NAMES = re.compile(r"\b(class|id|role|hidden|aria-hidden|style|itemprop)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _named(part: str, names: frozenset[str]) -> bool:
    """Whether a class or id names one of ``names`` and besides only the kind of box."""
    words = [w.lower() for w in _WORD.findall(part)]
    return any(w in names for w in words) and all(w in NAMED or w in KIND for w in words) and not (set(words) & NEGATED)


def _attributes(tag: str, text: str) -> tuple[bool, bool, bool]:
    """Whether an element's attributes say that it goes, that it is suspect, that it holds the main text."""
    gone = suspect = main = False
    names = STRONG if tag in PARAGRAPH else NAMED
    for name, value in _NAMES.findall(text):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "").lower()):
            gone = True
        elif name == "role":
            gone, main = gone or value.lower() in ROLES, main or value.lower() == "main"
        elif name == "itemprop":
            main = main or value == "articleBody"
        elif name in ("class", "id") and tag not in WHOLE:
            suspect = suspect or any(_named(part, names) for part in value.split())
    return gone, suspect, main


class Page:
    """The element tree of a page, and its text in blocks. A parent's number is below its children's."""

    def __init__(self, source: str):
        self.tag, self.parent, self.dropped, self.suspect, self.main = ["#root"], [0], [False], [False], [False]
        #: (innermost block element, text, length of link text) of each block.
        self.blocks: list[tuple[int, str, int]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        tag, dropped = self.tag, self.dropped
        # Open elements, each with the innermost block element at it.
        stack, open_tags, at, last = [(0, 0)], defaultdict(int), 0, source.rfind(">")
        texts: list[str] = []
        linked: list[str] = []

        def flush() -> None:
            if texts:
                owner = stack[-1][1]
                text = "".join(texts)
                text = " ".join((html.unescape(text) if "&" in text else text).split())
                if text and not dropped[owner]:
                    link = "".join(linked)
                    self.blocks.append((owner, text, len(" ".join((html.unescape(link) if "&" in link else link).split()))))
                texts.clear()
                linked.clear()

        def close(i: int) -> None:
            for n, _ in stack[i:]:
                open_tags[tag[n]] -= 1
            del stack[i:]

        def say(text: str) -> None:
            if text and not dropped[stack[-1][0]]:
                texts.append(text)
                if open_tags["a"] > 0:
                    linked.append(text)

        while at <= last and (m := _TAG.search(source, at)):
            say(source[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                if open_tags[name] > 0:
                    i = len(stack) - 1
                    block = False
                    while tag[stack[i][0]] != name:
                        block = block or tag[stack[i][0]] in BLOCK
                        i -= 1
                    if block or name in BLOCK:
                        flush()
                    close(i)
                elif name == "p":
                    flush()
                continue
            attributes = m[3] or m[6] or ""
            if name in BLOCK:
                flush()
                if open_tags["p"] > 0:
                    i = len(stack) - 1
                    while tag[stack[i][0]] != "p":
                        i -= 1
                    close(i)
            for old in CLOSES.get(name, ()):
                i = len(stack) - 1
                while open_tags[old] > 0 and tag[stack[i][0]] != old and tag[stack[i][0]] not in BARRIER:
                    i -= 1
                if open_tags[old] > 0 and tag[stack[i][0]] == old:
                    close(i)
            if name == "br":
                say(" ")
            if name in VOID:
                continue
            up, owner = stack[-1]
            me = len(tag)
            gone, suspect, main = _attributes(name, attributes) if attributes else (False, False, False)
            header = name == "header" and not (open_tags["article"] or open_tags["main"])
            tag.append(name)
            self.parent.append(up)
            dropped.append(dropped[up] or gone or header or name in DROPPED)
            self.suspect.append(suspect)
            self.main.append(main or name in ("article", "main"))
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)
            elif not attributes.rstrip().endswith("/") or name in BLOCK:
                stack.append((me, me if name in BLOCK else owner))
                open_tags[name] += 1
        say(source[at:])
        flush()

    def _box(self, n: int) -> int:
        """The container of a block element's text."""
        return self.parent[n] if self.tag[n] in PARAGRAPH else n

    def _raised(self, values: list) -> list:
        """Sums of each element's value and those of all below it."""
        for n in range(len(values) - 1, 0, -1):
            values[self.parent[n]] += values[n]
        return values

    def _lowered(self, own: list[bool]) -> list[bool]:
        """Whether an element or one above it has the mark."""
        for n in range(1, len(own)):
            own[n] = own[n] or own[self.parent[n]]
        return own

    def text(self) -> str:
        size = len(self.tag)
        below = self._lowered(list(self.suspect))
        own, links, direct = [0] * size, [0] * size, [0.0] * size
        for n, text, link in self.blocks:
            own[n] += len(text)
            links[n] += link
            worth = (min(len(text) / 25, 1) + text.count(",") + min(len(text) / 100, 3)) * (1 - min(link / len(text), 1))
            direct[self._box(n)] += worth * (SUSPECT if below[n] else 1)
        chars, links = self._raised(own), self._raised(links)
        passed = [0.0] * size
        for n in range(size - 1, 0, -1):
            passed[self.parent[n]] += direct[n] / 2 + passed[n] / 3
        density = [a / max(b, 1) for a, b in zip(links, chars, strict=True)]
        value = [(a + b) * (1 - min(d, 1)) for a, b, d in zip(direct, passed, density, strict=True)]
        best = max(range(size), key=lambda n: (value[n], -n))
        if value[best] <= 0:
            return "\n".join(t for _, t, _ in self.blocks)
        up = best
        while up and not self.main[up]:
            up = self.parent[up]
        best = up or best
        inside = [n == best or (n and best and self.parent[n] == self.parent[best] and self._beside(n, best, value, density, chars)) for n in range(size)]
        kept = list(inside)
        inside = self._lowered(inside)
        gone = [s and inside[n] and not kept[n] and chars[n] <= MOST * chars[best] for n, s in enumerate(self.suspect)]
        gone = self._lowered(gone)
        menus = set() if self.main[best] else self._menus(density, kept)
        return "\n".join(t for n, t, _ in self.blocks if inside[n] and not gone[n] and self._box(n) not in menus)

    def _menus(self, density: list[float], kept: list[bool]) -> set[int]:
        """Containers of short links only."""
        short: dict[int, list[int]] = defaultdict(list)
        for n, text, _ in self.blocks:
            short[self._box(n)].append(len(text))
        return {n for n, sizes in short.items() if not kept[n] and density[n] > MENU_LINKS and len(sizes) >= MENU_BLOCKS and sum(sizes) <= MENU_CHARS * len(sizes)}

    def _beside(self, n: int, best: int, value: list[float], density: list[float], chars: list[int]) -> bool:
        """Whether a sibling of the best container belongs to the article."""
        if self.dropped[n] or self.suspect[n] or not chars[n] or density[n] >= 0.25:
            return False
        if value[n] >= max(10.0, 0.2 * value[best]):
            return True
        if self.main[best]:
            return False
        return (self.tag[n] in HEADING and n < best) or (self.tag[n] in PARAGRAPH and chars[n] > 80)


def main_text(source: str | None) -> str:
    """The main text of one page."""
    return Page(source).text() if source else ""


def _extract(html_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = 256  # pages held as text at a time
            for i in range(0, len(b), step):
                own = b.slice(i, step)
                texts = [main_text(x) for x in own.column(html_at).to_pylist()]
                keep = [k for k in range(own.num_columns) if k != html_at]
                yield pa.RecordBatch.from_arrays([*(own.column(k) for k in keep), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*(own.schema.names[k] for k in keep), "text", "n_chars"])

    return run


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with text and n_chars (code points) in place of html."""
    columns = [c for c in pages.columns if c not in ("text", "n_chars")]
    pages = pages.select(*columns)
    fields = [f for f in pages.schema.fields if f.name != "html"]
    return pages.mapInArrow(_extract(columns.index("html")), T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
