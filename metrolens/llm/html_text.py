"""Main text of web pages with site templates removed.

Every page is parsed into its element tree. Each element's subtree (tag, class,
text and child subtrees) is hashed, Spark counts on how many different pages of
a host a subtree stands, and subtrees that recur on many of them are deleted as
parts of the site's template, with all they hold. Counts are folded in the scan
tasks, so a host of any size is spread, and copies of one page count once. A
subtree inside an article must recur in many different articles, and what is the
larger part of an article is never taken for a template. Only the text that is
left inside the article is returned.

Some parts are no article on any page: navigation, headers, footers, asides,
forms, scripts, styles, and elements whose class, id or role says so, by whole names or known compounds; in an
article, everyday words as ids or on text blocks are left to the counts. A page's
article is its ``main`` element if that holds the longest ``article``, else that
``article`` with its siblings, else its longest ``main``; where more of the page's own text lies
outside, it is the body. Own text is in no other part and no template. Plain text blocks of an ``article`` or ``main`` are its own words and are
never taken for a template, however often other pages quote them.

A null html is an empty page and gives an empty text. Unclosed elements end
where their parent does; a tag or comment cut off at the end is dropped. An
unclosed script, style or textarea reaches to the end; of other raw elements
that are never closed (an svg, say) only the tag is dropped.
Repeated rows are pages of their own with the same text.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metrolens.llm.common import fresh, lean, materialize, slices, table, with_fields

LEAST_PAGES = 8  # a template's subtree stands on at least so many different pages of a host
MOST_PAGES = 0.3  # or, on a small host or if it is a lone piece of text, on at least this share of them
FEWEST_PAGES = 3  # and on at least so many

# Elements by their part in a page.
NEVER_TEXT = frozenset(
    "head script style noscript template nav footer aside form button select textarea iframe svg dialog menu object"
    " canvas audio video".split()
)
RAW = "script|style|noscript|template|textarea|title|iframe|svg"
ENDLESS = frozenset("script style textarea".split())  # unclosed, they reach to the page's end; of others only the tag goes
NESTED = frozenset("svg template".split())  # raw elements that may hold their own kind
BLOCKS = frozenset(
    "html body main article section div header h1 h2 h3 h4 h5 h6 p ul ol li dl dt dd table caption thead tbody tfoot tr"
    " td th blockquote pre figure figcaption address details summary fieldset center hr hgroup search".split()
)
TEXT_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th blockquote pre figcaption caption".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
# Pieces that pages may share by chance, as a heading or a table row of one word: they need the share.
LONE = TEXT_BLOCKS | frozenset("tr thead tbody tfoot address summary hgroup center".split())
ROOTS = frozenset("html body main article".split())
# An open element of the key ends where one of these begins.
ENDED_BY = {
    "p": frozenset(
        "p div ul ol dl table section article main header footer nav aside form h1 h2 h3 h4 h5 h6 blockquote pre figure"
        " hr address details fieldset".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "tr": frozenset(["tr"]),
}
# Class and id names of parts that are no article, alone or in compounds with each other and the words below.
OTHER_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo banner cookie cookies consent gdpr"
    " notice alert popup modal newsletter subscribe signup paywall comment comments disqus sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs toolbar footer share sharing social related recommended pagination pager login"
    " masthead skip".split()
)
BEFORE = frozenset(
    "main site page top bottom left right primary secondary global mobile sticky post article entry blog google dfp gpt"
    " inline header content text".split()
)
AFTER = frozenset(
    "bar box block container wrapper wrap list item items section area widget panel form link links button buttons btn"
    " icon icons slot unit left right top bottom inner outer posts post articles stories reads overlay to content".split()
)
# Everyday words: inside an article, as an id or on a text block, they are a part's name only if the host's counts say so.
DOUBTFUL = frozenset(
    "notice alert related recommended social share sharing menu login banner promo comment comments cookie cookies"
    " consent subscribe signup sponsor sponsored popup modal navigation footer pager skip".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER_ROLES = frozenset(
    "navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form".split()
)

TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)"
    r"|<[!?/][^>]*>"
    r"|<[!?/][^>]*\Z",
    re.S | re.I,
)
REST_OF_TAG = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW.split("|")}
NESTED_TAG = {
    t: re.compile(
        r"<!--.*?-->|<(script|style)(?=[\s/>])[^>]*>.*?</\1(?=[\s/>])[^>]*>"
        rf"|<(?P<end>/?){t}(?=[\s/>])",
        re.S | re.I,
    )
    for t in NESTED
}
ATTRIBUTE = re.compile(r"([a-z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"  # of a URL, for Spark


class Element:
    __slots__ = ("tag", "parent", "other", "parts", "hash", "inside", "doubt", "text", "linked")

    def __init__(self, tag: str, parent: int, other: bool, head: bytes, inside: bool):
        self.tag, self.parent, self.other = tag, parent, other
        self.parts = [head]
        self.hash = 0
        self.inside = inside  # of an article or main element
        self.doubt = False  # its name may be another part's
        self.text = 0
        self.linked = 0


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(raw)}


def other_part(tag: str, given: dict[str, str], inside: bool) -> bool:
    """Whether an element is by its own name no part of an article."""
    if tag in NEVER_TEXT:
        return True
    if tag in ROOTS:
        return False
    if tag == "header" and not inside:
        return True
    if "hidden" in given or given.get("aria-hidden") == "true":
        return True
    if "display:none" in given.get("style", "").replace(" ", "").lower():
        return True
    if given.get("role", "").lower() in OTHER_ROLES:
        return True
    return any(named and not unsure for named, unsure in part_names(tag, given, inside))


def part_names(tag: str, given: dict[str, str], inside: bool) -> Iterator[tuple[bool, bool]]:
    """For each class and id: whether it is the name of another part, and whether that is in doubt."""
    names = [(name, False) for name in given.get("class", "").lower().split()]
    if tag not in HEADINGS and not (inside and tag in TEXT_BLOCKS):  # ids of texts are made of their words
        names += [(name, True) for name in given.get("id", "").lower().split()]
    for name, is_id in names:
        words = [w for w in re.split("[_-]+", name) if w]
        first = next((i for i, w in enumerate(words) if w in OTHER_PARTS), None)
        if first is None:
            continue
        named = all(
            w in OTHER_PARTS or w.isdigit() or w in (BEFORE if i < first else AFTER) for i, w in enumerate(words)
        )
        yield named, inside and (is_id or tag in TEXT_BLOCKS) and len(words) == 1 and name in DOUBTFUL


class TagEnds:
    """Where tags end: at the first ``>`` outside quotes.

    A quote that is never closed would have every tag before it look through the
    rest of the page. After the first such tag the ends of all are worked out at
    once, from the last quote or ``>`` to the first: what follows a quoted value
    is known by then.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.marks: list[int] | None = None  # quotes and ``>``
        self.ends: list[int] = []  # end of a tag that meets the mark outside quotes, -1: none

    def of(self, at: int) -> int:
        """End of the tag whose name ends at ``at``, -1 if it has none."""
        if at > self.last:
            return -1
        if self.marks is None:
            found = REST_OF_TAG.match(self.page, at)
            if found:
                return found.end()
            self.work_out()
        k = bisect_left(self.marks, at)
        return self.ends[k] if k < len(self.marks) else -1

    def work_out(self) -> None:
        page = self.page
        self.marks = [m.start() for m in re.finditer("[>\"']", page)]
        self.ends = [-1] * (len(self.marks) + 1)
        later: dict[str, int] = {}  # number of the next mark of the kind
        for k in range(len(self.marks) - 1, -1, -1):
            kind = page[self.marks[k]]
            if kind == ">":
                self.ends[k] = self.marks[k] + 1
            elif kind in later:
                self.ends[k] = self.ends[later[kind] + 1]
            later[kind] = k

    def any(self, at: int) -> int:
        """End at the first ``>`` from ``at`` on, in quotes or not; -1 if there is none."""
        return self.page.find(">", at) + 1 or -1 if at <= self.last else -1


class RawEnds:
    """Where the raw elements of a page end; each kind is looked for in one pass."""

    def __init__(self, page: str, tags: TagEnds):
        self.page, self.tags = page, tags
        self.none_after: dict[str, int] = {}  # no end tag of the kind from there on
        self.nested: dict[str, dict[int, int]] = {}

    def of(self, tag: str, start: int, inner: int) -> int:
        """End of the element whose tag is from ``start`` to ``inner``."""
        if tag == "svg" and self.page[inner - 2] == "/":
            return inner
        if tag in NESTED:
            if tag not in self.nested:
                self.nested[tag] = self.pairs(tag)
            return self.nested[tag].get(start, inner)
        if inner < self.none_after.get(tag, len(self.page)):
            found = RAW_END[tag].search(self.page, inner)
            if found:
                return found.end()
            self.none_after[tag] = inner
        return len(self.page) if tag in ENDLESS else inner

    def pairs(self, tag: str) -> dict[int, int]:
        ends, open_at = {}, []
        at = 0
        while found := NESTED_TAG[tag].search(self.page, at):
            at = found.end()
            if found["end"] is None:
                continue
            inner = self.tags.of(at)
            inner = inner if inner >= 0 else self.tags.any(at)
            if inner < 0:
                break
            at = inner
            if tag == "svg" and not found["end"] and self.page[inner - 2] == "/":
                continue
            if not found["end"]:
                open_at.append(found.start())
            elif open_at:
                ends[open_at.pop()] = inner
        return ends


def parse(page: str) -> tuple[list[Element], list[tuple[int, str]]]:
    """Elements (block elements and other parts; inline ones are transparent)
    in page order and the page's text blocks with the element each is in."""
    import xxhash

    elements: list[Element] = [Element("html", -1, False, b"html", False)]
    blocks: list[tuple[int, str]] = []
    open_at = [0]
    open_tags: Counter = Counter()  # of the open elements but the first
    held: list[str] = []
    links = 0
    linked = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            held.clear()
            if text:
                at = open_at[-1]
                blocks.append((at, text))
                elements[at].parts.append(text.encode("utf-8", "surrogatepass"))
                elements[at].text += len(text)
                elements[at].linked += min(linked, len(text))
        linked = 0

    def close() -> None:
        flush()
        done = elements[open_at.pop()]
        open_tags[done.tag] -= 1
        done.hash = xxhash.xxh64_intdigest(b"\x00".join(done.parts)) - (1 << 63)
        done.parts = []
        if open_at:
            elements[open_at[-1]].parts.append(done.hash.to_bytes(8, "little", signed=True))

    def opened(tag: str, raw: str) -> None:
        given = attributes(raw) if raw and not raw.isspace() else {}
        parent = open_at[-1]
        inside = elements[parent].inside or tag in ("article", "main") or given.get("role") == "main"
        name = "main" if given.get("role") == "main" and tag not in ROOTS else tag
        head = f"{tag} {given.get('class', '')}".encode("utf-8", "surrogatepass")
        elements.append(Element(name, parent, other_part(tag, given, inside), head, inside))
        elements[-1].doubt = any(unsure for _, unsure in part_names(tag, given, inside))
        open_at.append(len(elements) - 1)
        open_tags[name] += 1

    at = 0
    tags = TagEnds(page)
    ends = RawEnds(page, tags)
    while found := TAG.search(page, at):
        if found.start() > at:
            piece = page[at : found.start()]
            held.append(piece)
            if links:
                linked += len(piece.strip())
        at = found.end()
        tag = found["tag"]
        if tag is None:  # comments, raw elements and declarations hold no text
            if found["raw"]:
                inner = tags.of(at)
                inner = inner if inner >= 0 else tags.any(at)
                at = ends.of(found["raw"].lower(), found.start(), inner) if inner >= 0 else len(page)
            continue
        inner = tags.of(at)
        if inner < 0:
            if tags.any(at) < 0:  # the page is cut off within the tag
                at = len(page)
            else:  # a quote is not closed: no tag, but a text with this sign
                held.append("<")
                linked += 1 if links else 0
                at = found.start() + 1
            continue
        attr, at = page[at : inner - 1], inner
        tag = tag.lower()
        if found["end"]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS or tag in NEVER_TEXT:
                if open_tags[tag] or (tag == "div" and open_tags["main"]):
                    while elements[open_at[-1]].tag not in (tag, "main" if tag == "div" else tag):
                        close()
                    close()
                else:
                    flush()
            continue
        if tag == "a":
            links += 1
        elif tag == "br":
            held.append(" ")
        elif tag == "hr":
            flush()
        elif tag in ("html", "body") and open_tags[tag]:
            flush()
        elif tag in BLOCKS or tag in NEVER_TEXT:
            flush()
            while len(open_at) > 1 and tag in ENDED_BY.get(elements[open_at[-1]].tag, ()):
                close()
            if tag not in VOID and not attr.endswith("/"):
                opened(tag, attr)
    if at < len(page):
        held.append(page[at:])
    while open_at:
        close()
    return elements, blocks


def deletable(elements: list[Element]) -> list[int]:
    """Elements that may be deleted as template: no roots, and no plain text of
    an article unless its name is in doubt."""
    return [
        i
        for i, e in enumerate(elements)
        if e.tag not in ROOTS and (e.doubt or not (e.inside and e.tag in TEXT_BLOCKS))
    ]


def articles(elements: list[Element]) -> list[int]:
    """For each element the outermost article or main element it is in, -1 outside."""
    tops: list[int] = []
    for i, e in enumerate(elements):
        up = tops[e.parent] if e.parent >= 0 else -1
        tops.append(up if up >= 0 else i if e.inside else -1)
    return tops


def own_text(elements: list[Element], gone: list[bool]) -> list[int]:
    """Characters below each element that are in no other part of it."""
    own = [e.text for e in elements]
    for i in range(len(elements) - 1, 0, -1):  # parents come first
        if not gone[i]:
            own[elements[i].parent] += own[i]
    return own


def templates_of(elements: list[Element], template: set[int]) -> set[int]:
    """The elements that go as ``template`` subtrees. Those of an article stay if
    they are the larger part of its own text: then they are the article."""
    found = {i for i in deletable(elements) if elements[i].hash in template}
    tops = articles(elements)
    if not any(tops[i] >= 0 for i in found):
        return found
    whole = own_text(elements, [e.other or (i in found and tops[i] < 0) for i, e in enumerate(elements)])
    cut = own_text(elements, [e.other or i in found for i, e in enumerate(elements)])
    return {i for i in found if tops[i] < 0 or 2 * cut[tops[i]] >= whole[tops[i]]}


def menu(e: Element) -> bool:
    """Whether it is an entry of a menu that no element names."""
    return e.tag == "li" and e.text > 0 and e.linked >= e.text


def main_text(page: str | None, template: Iterable[int] = ()) -> str:
    """The article's blocks without other parts and the given ``template`` subtrees."""
    elements, blocks = parse(page or "")
    template = set(template)
    deleted = templates_of(elements, template) if template else set()
    gone = [e.other or i in deleted for i, e in enumerate(elements)]
    own = own_text(elements, gone)
    # entries of unnamed menus count for all but the page
    menus = [e.text if menu(e) else 0 for e in elements]
    for i in range(len(elements) - 1, 0, -1):
        if not gone[i]:
            menus[elements[i].parent] += menus[i]
    own[0] -= menus[0]
    hidden: list[bool] = []  # in another part, such as an article in the comments
    for e in elements:
        hidden.append(e.parent >= 0 and (hidden[e.parent] or gone[e.parent]))

    def longest(tag: str, shown: bool) -> int:
        found = [i for i, e in enumerate(elements) if e.tag == tag and own[i] and not (shown and hidden[i])]
        return max(found, key=lambda i: (own[i], -i), default=0)

    def roots(shown: bool) -> set[int]:
        article, body = longest("article", shown), longest("main", shown)
        up = article
        while up > 0 and elements[up].tag != "main":
            up = elements[up].parent
        if up > 0:
            found = {up}  # a page's main part holds it
        elif article:
            beside = elements[article].parent
            found = {
                i
                for i, e in enumerate(elements)
                if e.tag == "article" and e.parent == beside and own[i] and not (shown and hidden[i])
            }
            if body and own[body] > sum(own[i] for i in found):
                found = {body}
        else:
            found = {body}
        # Where most of the page's own text lies outside, no element marks its article.
        return {0} if shown and own[0] > 2 * sum(own[i] for i in found) else found

    def words(roots: set[int]) -> list[str]:
        within: list[bool] = []  # of a root, with no other part between
        for i, e in enumerate(elements):
            within.append(i in roots or (not gone[i] and e.parent >= 0 and within[e.parent]))
        return [text for at, text in blocks if within[at] and not (0 in roots and menu(elements[at]))]

    # A page whose every article stands in a part named like a sidebar is still no empty page.
    found = words(roots(True)) or words(roots(False))
    return "\n\n".join(found)


SIDES = ("outer", "inner")


def sides(elements: list[Element]) -> tuple[int, dict[str, tuple[list[int], int, int]]]:
    """The page's article as a number, and its different subtrees outside and
    inside of it: the deletable ones first (their number comes last), and of
    these the lone pieces last (from the second value on)."""
    tops = articles(elements)
    heads = [elements[i].hash for i, top in enumerate(tops) if top == i]
    may = set(deletable(elements))
    out, seen = {}, set()
    for side, inside in zip(SIDES, (False, True)):
        own = [i for i, top in enumerate(tops) if (top >= 0) == inside and elements[i].hash not in seen]
        found = dict.fromkeys(elements[i].hash for i in own if i in may and elements[i].tag not in LONE)
        whole = len(found)
        found.update(dict.fromkeys(elements[i].hash for i in own if i in may))
        free = len(found)
        found.update(dict.fromkeys(elements[i].hash for i in own))
        out[side] = (list(found), whole, free)
        seen = set(found)
    return hash(tuple(heads)), out


def subtrees(pages: DataFrame) -> DataFrame:
    """``host``, ``page``, ``article`` of ``pages`` (``host``, ``page``, ``html``) and, for
    either of :data:`SIDES`, the subtrees and the two numbers of :func:`sides`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [sides(parse(text or "")[0]) for text in batch.column(2).to_pylist()]
            columns = [*batch.columns[:2], pa.array([article for article, _ in found], pa.int64())]
            for side in SIDES:
                columns.append(pa.array([of[side][0] for _, of in found], pa.list_(pa.int64())))
                columns += [pa.array([of[side][k] for _, of in found], pa.int32()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["host", "page", "article", *[f"{side}{part}" for side in SIDES for part in ("", "_whole", "_free")]]
    schema = "host long, page long, article long, " + ", ".join(
        f"{side} array<long>, {side}_whole int, {side}_free int" for side in SIDES
    )
    return pages.select("host", "page", "html").mapInArrow(lean(run), schema)


def templates(pages: DataFrame, share: float = MOST_PAGES, least: int = LEAST_PAGES) -> DataFrame:
    """``(host, page, template)``: for each page that has any, its deletable
    subtrees that stand on many different pages of its host; those inside of an
    article, in many different articles.

    ``least`` pages are many on a host of any size; fewer are if they are the
    ``share`` of a small one. Lone pieces of text, and pages without a host,
    always need the share.
    """
    few = min(FEWEST_PAGES, least)
    seen = materialize(subtrees(pages).dropDuplicates(["host", "page"]), "html-subtrees")
    # Pages that share an article, as its print version does, share all its parts: one of them counts.
    speakers = seen.groupBy("host", "article").agg(F.min("page").alias("page")).select("host", "page")
    inner = seen.select("host", "page", "inner").filter(F.size("inner") > 0).join(speakers, ["host", "page"], "left_semi")
    standing = seen.select("host", F.explode("outer").alias("subtree")).unionByName(
        inner.select("host", F.explode("inner").alias("subtree"))
    )
    totals = seen.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    shared = F.col("n") >= F.col("pages") * share
    recurring = (
        standing.groupBy("host", "subtree")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= few)
        .join(totals, "host")
        .filter(shared | ((F.col("n") >= least) & (F.col("host") != F.xxhash64(F.lit("")))))
        .select("host", "subtree", shared.alias("shared"))
    )
    may = lambda side: F.transform(
        F.slice(side, F.lit(1), F.col(f"{side}_free")),
        lambda h, at: F.struct(h.alias("subtree"), (at >= F.col(f"{side}_whole")).alias("lone")),
    )
    listed = seen.select("host", "page", F.explode(F.concat(*map(may, SIDES))).alias("s"))
    return (
        listed.select("host", "page", "s.subtree", "s.lone")
        .join(recurring, ["host", "subtree"])
        .filter(F.col("shared") | ~F.col("lone"))
        .groupBy("host", "page")
        .agg(F.collect_set("subtree").alias("template"))  # at most a page's own elements
    )


def extract_text(
    pages: DataFrame,
    html_col: str = "html",
    url_col: str = "url",
    share: float = MOST_PAGES,
    least: int = LEAST_PAGES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` columns (all but the html by default) with ``text`` and ``n_chars``."""
    keep = [c for c in pages.columns if c != html_col] if keep is None else keep
    text, n_chars = fresh(pages.select(*[F.col(f"`{c}`") for c in keep]), "text", "n_chars")
    named = pages.select(
        *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)],
        F.xxhash64(
            F.lower(F.regexp_extract(F.trim(F.coalesce(F.col(f"`{url_col}`"), F.lit(""))), HOST, 1))
        ).alias("host"),
        F.xxhash64(F.coalesce(F.col(f"`{html_col}`"), F.lit(""))).alias("page"),
        F.col(f"`{html_col}`").alias("html"),
    )
    marked = named.join(templates(named, share, least), ["host", "page"], "left")
    kept = [f"__k{i}" for i in range(len(keep))]
    schema = with_fields(named.select(*kept).schema, [("t", T.StringType()), ("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(p, t or ()) for p, t in zip(*(c.to_pylist() for c in batch.columns[-2:]))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=schema.names,
            )

    done = marked.select(*kept, "html", "template").mapInArrow(lean(run), schema)
    named_back = [F.col(k).alias(c) for k, c in zip(kept, keep)]
    return done.select(*named_back, F.col("t").alias(text), F.col("n").alias(n_chars))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
