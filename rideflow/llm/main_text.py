"""Main text of web pages as a maximum-scoring run of words and tags.

A page is a row of items: pieces of text and tags. Each word of a piece adds a weight that is positive where articles have their words, each
tag adds a negative one, and the run of items with the largest sum is the core of the content; one pass over the items finds it. The weights are
log odds, counted over labelled pages, of lying inside the content or outside; what those pages do not show keeps a prior. The element
that holds the run is the content, so that lists and short blocks at its edges stay; pieces in it whose surroundings are never content (menus,
adverts, comments, forms and the like) are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 2000

# Element names of the HTML standard by their role, and words that sites use in class, id and role for page furniture.
HIDDEN = "script style noscript template title textarea select option svg math iframe object canvas audio video head button datalist".split()
FURNITURE = "nav aside footer form menu dialog fieldset".split()
BLOCK = ("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
         "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul").split()
CONTAINER = "article body center html main section div td".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
NAMES = ("ad ads adsbox advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline-share comment comments consent cookie "
         "cookies copyright dialog disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter notice notification overlay "
         "pager pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup "
         "skip social sponsor sponsored sponsors subscribe subscription teaser toc toolbar widget").split()
# Words that say where or what kind of thing a named part is ("related-posts", "sidebar-left").
BESIDE = ("area articles bar block bottom box button buttons column container content entries group holder icons inner item items left link links list module "
          "outer page panel post posts right section site stories story top wrap wrapper").split()
PHRASING = ("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label map mark meter nobr output picture progress q rp rt ruby s samp "
            "slot small span strike strong sub sup time tt u var").split()
# Elements whose content is text up to their own end tag, and what may stand in a head.
RAW = "script style textarea title noscript iframe noembed noframes xmp".split()
IN_HEAD = "base basefont bgsound link meta title noscript noframes style script template".split()
_HIDDEN, _FURNITURE, _BLOCK, _CONTAINER, _VOID, _NAMES = map(frozenset, (HIDDEN, FURNITURE, BLOCK, CONTAINER, VOID, NAMES))
_NAMES_BESIDE, _RAW, _IN_HEAD = frozenset(NAMES + BESIDE), frozenset(RAW), frozenset(IN_HEAD)
_KNOWN = frozenset(HIDDEN + FURNITURE + BLOCK + CONTAINER + VOID + PHRASING + RAW + IN_HEAD)

# An attribute: a quote opens a value only right behind the equals sign, and only if it is closed somewhere; elsewhere it is a character like others.
_VALUE = r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))"""
_TAG = re.compile(rf"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+{_VALUE}?+)*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_CUT_TAG = re.compile(rf"</?[a-zA-Z][^\s/>]*+(?:[\s/]++|[^\s/>=]++{_VALUE})*+\Z")
_START = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|[!?]|/)")
_OTHER = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^>]*+>", re.S)
_END_NAME = re.compile(r"</([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)

# Zones: "core" is inside article or main, "furniture" as above, "plain" the rest; forms of a piece within a zone.
PRIOR = {("core", "text"): 2.0, ("core", "link"): 0.5, ("core", "list"): 1.0, ("plain", "text"): 1.0, ("plain", "link"): -1.0, ("plain", "list"): -0.3,
         ("furniture", "text"): -2.0, ("furniture", "link"): -2.0, ("furniture", "list"): -2.0}
TAG_PRIOR, TAG_LEAST, LIMIT, PRIOR_COUNT = -0.5, -0.1, 3.0, 20.0


@dataclass(slots=True)
class Element:
    """An element of a page and what it inherits: elements are told by their places in the list of all of them, -1 is none."""

    name: str
    parent: int
    firm: bool  # furniture by its tag or hidden, or inside of such
    named: int  # the innermost element around, itself included, that has a name of furniture
    core: int  # the outermost article around, itself included; if none, the outermost main element
    start: int = 0  # its items, from its start tag on
    end: int = 0


_NOWHERE = Element("", -1, False, -1, -1)


def _marks(attributes: str) -> tuple[bool, bool, bool]:
    """Whether an element with these attributes is hidden, has a name of furniture, and is called header.

    A name is a whole class, id, role or label, or one put together of such names and words for places and kinds ("cookie-banner", "related-posts", but
    not "has-comments").
    """
    hidden, names = False, set()
    for found in _ATTRIBUTE.finditer(attributes):
        attribute, value = found[1].lower(), (found[2] or found[3] or found[4] or "").strip().lower()
        if attribute == "hidden":
            hidden |= value != "false"
        elif attribute == "aria-hidden":
            hidden |= value == "true"
        elif attribute == "style":
            hidden |= bool(_NO_DISPLAY.search(value))
        elif attribute in ("class", "id", "role"):
            names.update(value.split())
        elif attribute == "aria-label":
            names.add(value)
    return hidden, any(n in _NAMES or _is_furniture(re.split(r"[^a-z0-9]+", n)) for n in names), "header" in names


def _is_furniture(words: list[str]) -> bool:
    return _NAMES_BESIDE.issuperset(words) and not _NAMES.isdisjoint(words)


def _holder(parts: list) -> str | None:
    """The name that labels a page's content: article if there is exactly one, else main if there is exactly one."""
    return next((n for n in ("article", "main") if sum(p[0] == "tag" and p[1] == n and p[2] == "open" for p in parts) == 1), None)


def items(page: str) -> list[tuple[str, str, tuple[str, str] | str]]:
    """("text", piece, (zone, form)) and ("tag", name, "open" or "close") in page order; hidden elements and comments are left out.

    An end tag closes the innermost open element of its name, and with it whatever was left open inside; one without a
    start is only a tag. List items and paragraphs also end where the next one begins. An article, a main element, and the
    element with most of the page's words of positive weight (of those in its article or main, if that is one) are no furniture by a name alone.
    """
    return _parse(page)[0]


def _tags(page: str, ends: dict[str, int]) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" or "", name, attributes) of the tags of a page in order, comments and the like with an empty name. `ends`: the last end tag by name.

    Names that HTML does not know are tags if they are made as its own ones are (with a hyphen or a colon) or are closed somewhere; else "<" is
    a character of the text. Nothing is looked for in raw text elements, which end with their own end tag; a script or style without one goes on
    to the end of the page, another one is as if it had not begun. A page is read once: where a quote swallows all ends of tags, quotes no longer count."""
    at, last, pattern = 0, page.rfind(">"), _TAG
    while start := _START.search(page, at):
        at, name = start.end() if start[2] is None else start.start() + 1, (start[2] or "").lower()
        if not name:
            if (start[0] != "</" or start.start() < last) and (other := _OTHER.match(page, start.start())):
                at = other.end()
                yield start.start(), at, "", "", ""
            continue
        if not (start[1] or name in _KNOWN or "-" in name or ":" in name or name in ends):
            continue
        if start.start() > last:
            if _CUT_TAG.match(page, start.start()):
                yield start.start(), len(page), "", "", ""
                return
            continue
        found = pattern.match(page, start.start())
        if not found:
            pattern = _LOOSE_TAG
            found = pattern.match(page, start.start())
        at = found.end()
        if not found[1] and name in _RAW:
            if ends.get(name, -1) >= at:
                yield start.start(), at, "", name, found[3]
                at = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at).start()
                continue
            if name not in ("script", "style"):
                yield start.start(), at, "", "", ""
                continue
            at = len(page)
        yield start.start(), at, found[1], name, found[3]


def _parse(page: str) -> tuple[list, list[int], list[Element]]:
    """The items, the element each of them is in (-1: none), and the elements."""
    parts: list = []
    owners: list[int] = []
    elements: list[Element] = []
    stack: list[int] = []
    counts: Counter[str] = Counter()
    inner: Counter[str] = Counter()  # what is open inside of the hidden element
    skip, depth, raw = "", 0, False
    at = 0
    # a hidden element that is never closed hides nothing
    ends = {found[1].lower(): found.start() for found in _END_NAME.finditer(page)}

    def pop(name: str, end: int) -> None:
        while stack:
            top = elements[stack.pop()]
            top.end = end
            counts[top.name] -= 1
            if top.name == name:
                return

    def add(kind: str, value: str, more: str = "") -> None:
        if kind == "text":
            more = "link" if counts["a"] else "list" if counts["li"] or counts["dd"] or counts["dt"] else "text"
        parts.append((kind, value, more))
        owners.append(stack[-1] if stack else -1)

    for start, end, slash, name, attributes in _tags(page, ends):
        between = page[at:start]
        if skip == "head" and not slash and name and name not in _IN_HEAD or skip == "head" and between.strip() and not raw:
            skip = ""  # a head ends with what cannot be in it
        if not skip and between:
            add("text", between)
        at, raw = end, False
        if not name:
            if not skip and page.startswith("<![CDATA[", start):
                add("text", page[start + 9:end].removesuffix("]]>"))
            continue
        if skip:
            raw = not slash and name in _RAW
            if not slash:
                if name != skip:
                    inner[name] += 1
                elif name not in ("select", "button"):  # these do not nest: the second one ends the first
                    depth += 1
                continue
            if name == skip:
                depth -= 1
                skip = skip if depth else ""
                continue
            if inner[name] or not counts[name] and not (skip == "head" and name in ("body", "html")):
                inner[name] -= inner[name] > 0
                continue
            skip = ""  # the end of an element around it
        if slash:
            add("tag", name, "close")
            if counts[name]:
                pop(name, len(parts))
            continue
        if name in _HIDDEN:
            if name == "head" or name in _RAW or ends.get(name, -1) >= at:
                skip, depth, raw = name, 1, name in _RAW
                inner.clear()
            continue
        add("tag", name, "open")
        if name in _VOID or attributes.rstrip().endswith("/") and name not in _BLOCK:
            continue
        if name in ("li", "dd", "dt", "p") and counts[name] and elements[stack[-1]].name in (name, "b", "i", "em", "strong", "span", "p"):
            pop(name, len(parts) - 1)
        hidden, named, header = _marks(attributes) if attributes else (False, False, False)
        up = elements[stack[-1]] if stack else _NOWHERE
        firm = name not in ("body", "html") and (name in _FURNITURE or hidden or name == "header" and up.core < 0)
        named = name not in ("body", "html", "article", "main") and (named or header and up.core < 0)
        core = not firm and (name == "article" and (up.core < 0 or elements[up.core].name == "main") or name == "main" and up.core < 0)
        elements.append(Element(name, stack[-1] if stack else -1, up.firm or firm, len(elements) if named else up.named,
                                len(elements) if core else up.core, len(parts) - 1))
        stack.append(len(elements) - 1)
        counts[name] += 1
    if at < len(page) and (not skip or skip == "head" and not raw):
        add("text", page[at:])
    for i in stack:
        elements[i].end = len(parts)
    return _with_zones(parts, owners, elements), owners, elements


def _with_zones(parts: list, owners: list[int], elements: list[Element]) -> list:
    """`parts` with the zone of every text beside its form."""
    around = [elements[o] if o >= 0 else _NOWHERE for o in owners]
    zones = ["core" if e.core >= 0 else "plain" for e in around]
    loose: Counter[int] = Counter()
    if any(e.named >= 0 for e in around):
        words = [len(v.split()) * max(0.0, PRIOR[zone, more]) if kind == "text" and not e.firm else 0.0
                 for (kind, v, more), e, zone in zip(parts, around, zones, strict=True)]
        inside = [w if zone == "core" else 0.0 for w, zone in zip(words, zones, strict=True)]
        if _holder(parts) and any(inside):
            words = inside
        for e, n in zip(around, words, strict=True):
            while n and e.named >= 0:
                loose[e.named] += n
                up = elements[e.named].parent
                e = elements[up] if up >= 0 else _NOWHERE
        half = sum(words) / 2
        loose = Counter({i: n for i, n in loose.items() if n > half})

    def furniture(e: Element) -> bool:
        while e.named >= 0:
            if e.named not in loose:
                return True
            up = elements[e.named].parent
            e = elements[up] if up >= 0 else _NOWHERE
        return False

    return [(kind, v, ("furniture" if e.firm or e.named >= 0 and furniture(e) else zone, more) if kind == "text" else more)
            for (kind, v, more), e, zone in zip(parts, around, zones, strict=True)]


def learn_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_train: int = MAX_TRAIN) -> dict:
    """Weights of kinds of text (by word) and of tag names, from pages labelled by their own markup.

    A page is labelled if it has exactly one article (or, without any, one main element): what is inside and not furniture is content. At most
    `max_train` of the pages, by a hash of their ids, are counted, in the tasks; one row for each kind and name comes to the driver.
    """
    chosen = pages.select(F.col(id_col).alias("page_id")).where("page_id IS NOT NULL").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(max_train)
    some = pages.select(F.col(id_col).alias("page_id"), F.col(html_col).cast("string").alias("html")).join(F.broadcast(chosen), "page_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside: Counter[str] = Counter()
            outside: Counter[str] = Counter()
            for page in batch.column(0).to_pylist():
                parts = items(page or "")
                holder = _holder(parts)
                within = False
                for kind, value, more in parts if holder else ():
                    if (kind, value) == ("tag", holder):
                        within = more == "open"
                        outside["tag " + value] += 1
                    elif kind == "tag":
                        (inside if within else outside)["tag " + (value if value in _BLOCK or value in ("a", "b", "i", "em", "strong", "span", "img") else "other")] += 1
                    else:
                        (inside if within and more[0] != "furniture" else outside)[f"text {more[0]} {more[1]}"] += len(value.split())
            names = sorted({*inside, *outside})
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inside[n] for n in names], pa.int64()),
                                              pa.array([outside[n] for n in names], pa.int64())], names=["name", "inside", "outside"])

    rows = some.select("html").mapInArrow(count, "name string, inside long, outside long")
    sums = rows.groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    total_in = sum(r.inside for r in sums if r.name.startswith("tag")) or 1
    total_out = sum(r.outside for r in sums if r.name.startswith("tag")) or 1
    weights: dict = {"text": dict(PRIOR), "tag": {}}
    for r in sums:
        kind, _, rest = r.name.partition(" ")
        if kind == "tag":
            odds = math.log((r.inside + 1) / (total_in + 1)) - math.log((r.outside + 1) / (total_out + 1))
            weights["tag"][rest] = max(-LIMIT, min(TAG_LEAST, odds))
        else:
            key = tuple(rest.split(" "))
            seen = r.inside + r.outside
            odds = max(-LIMIT, min(LIMIT, math.log((r.inside + 1) / (r.outside + 1))))
            weights["text"][key] = (odds * seen + PRIOR[key] * PRIOR_COUNT) / (seen + PRIOR_COUNT)
    return weights


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the first run with the largest sum; empty if no score is positive."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, found = run, (start, i + 1)
    return found


def _enclosing(parts: list, owners: list[int], elements: list[Element], start: int, end: int) -> tuple[int, int]:
    """The items of the element that holds the run: the article, or else main element, of its text; where it has several or
    none, the smallest container of all its text, the page if there is none."""
    texts = [i for i in range(start, end) if parts[i][0] == "text" and parts[i][2][0] != "furniture" and parts[i][1].strip()]
    texts = [i for i in texts if parts[i][2][0] == "core"] or texts
    inside = {owners[i] for i in texts}
    holders = {elements[o].core if o >= 0 else -1 for o in inside}
    common = holders.pop() if len(holders) == 1 else -1
    if common < 0:
        paths = []
        for o in inside:
            path = []
            while o >= 0:
                path.append(o)
                o = elements[o].parent
            paths.append(path[::-1])
        for level in zip(*paths):
            if len(set(level)) > 1:
                break
            if elements[level[0]].name in _CONTAINER:
                common = level[0]
    return (elements[common].start, elements[common].end) if common >= 0 else (0, len(parts))


def main_text(page: str | None, weights: dict) -> str:
    """The content's blocks, one a line. Around the run, blocks outside of article and main with most of their words in links are left out."""
    parts, owners, elements = _parse(page or "")
    texts, tags = weights["text"], weights["tag"]
    scores = [len(value.split()) * texts[more] if kind == "text" else tags.get(value, TAG_PRIOR) for kind, value, more in parts]
    start, end = best_run(scores)
    if start == end:
        return ""
    edge = [kind == "tag" and value in _BLOCK for kind, value, _ in parts]
    while start and not edge[start - 1]:  # whole blocks
        start -= 1
    while end < len(parts) and not edge[end]:
        end += 1
    low, high = _enclosing(parts, owners, elements, start, end)
    lines, block, linked = [], [], 0
    for i in range(min(low, start), max(high, end) + 1):
        if i == max(high, end) or edge[i]:
            line = " ".join("".join(block).split())
            # a block lies in the run or outside as a whole
            if line and (start <= i - 1 < end or linked <= 0):
                lines.append(line)
            block, linked = [], 0
        elif parts[i][0] == "text" and parts[i][2][0] != "furniture":
            zone, form = parts[i][2]
            block.append(html.unescape(parts[i][1]))
            linked += 0 if zone == "core" else len(parts[i][1].split()) * (1 if form == "link" else -1)
    return "\n".join(lines)


def extract_main_text(pages: DataFrame, weights: dict, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text of every row of `pages`, from the whole html.

    A null or empty page, or one without content, gives an empty text. Character references are decoded; white space within a block is one blank,
    blocks are lines. Unclosed and misplaced tags are allowed. Repeated rows get equal results; other columns are ignored.
    """

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), weights) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
            .mapInArrow(convert, "page_id long, url string, text string"))
