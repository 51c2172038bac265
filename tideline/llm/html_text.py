"""Main text of web pages by two passes of rules over text blocks.

The markup is read once into blocks (stretches of text between block-level tags),
each with its length, the share of its characters inside links, the share of stop
words among its words, and where it stands.

* First pass, block by block: good if long, with few links and enough stop words;
  bad if in markup for menus, headers, footers, sidebars, notices, adverts, forms
  or comments, outside the page's ``article`` or ``main`` where it has one, or
  full of links; otherwise, and always if short, undecided.
* Second pass: an undecided block takes the label of its nearest decided
  neighbour; a step into another section counts as ``SECTION_STEP`` blocks more,
  and blocks outside ``article`` or ``main`` say nothing about those inside.
  Between equally near ones the earlier wins. Without any good block, or without
  a decided neighbour, nothing speaks against an undecided one, and it is good.

The stop-word rule rests where a page has hardly any of the known stop words, as
in other languages. Character references are decoded, white space within a block
becomes one space, blocks are joined in order by an empty line. Null and empty
pages, and pages with no good block, give an empty text.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tideline.llm import tokens

SHORT, LINKS, STOPS, STOPS_KNOWN, SECTION_STEP = 70, 0.4, 0.1, 0.04, 3

#: Words and names the rules look for.
STOP_WORDS = frozenset(
    "the of and to in a is that it for was on are as with be at by this from or an have not which but "
    "der die das und in zu den von mit ist des sich dem nicht ein eine als auch auf für im es an werden aus "
    "le la les de des et à en un une du est que qui dans pour pas au sur par il plus se ce ne avec son "
    "el los las del y en que por con una su para es al lo como más pero sus le ya o este sí porque "
    "il di che e per non si gli una sono da o os do da em um para com não uma het een van op te dat".split()
)
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav noscript ol option p pre search section select summary table tbody tfoot thead tr ul template".split()
)
RAW_TAGS = frozenset("script style title textarea iframe xmp noembed noframes".split())
BAD_TAGS = frozenset(
    "nav aside form footer menu dialog button select option noscript template svg math canvas object audio "
    "video head search fieldset datalist label input".split()
)
#: Blocks of text; the other block-level elements are sections.
LEAF_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre address figcaption legend caption summary tr hgroup".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices notification alert menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar sidenav rail footer masthead topbar toolbar social share sharing related recommended "
    "recommendations popular trending newsletter subscribe subscription signup login search searchbox widget "
    "popup modal overlay comment comments commentlist reply replies respond disqus pagination pager copyright "
    "legal disclaimer skip contentinfo complementary teaser outbrain taboola".split()
)
#: Beginnings and ends of names written as one word, such as commentlist or topnav.
BAD_PARTS = re.compile(
    r"(?:cookie|comment|advert|sidebar|sidebox|sponsor|breadcrumb|newsletter|subscri|masthead|ad(?:box|slot|unit|wrap))"
    r".*|.*(?:nav|menu|sidebar|comments|banner|footer)"
)
#: Parts that cannot hold these, so that one still open was not closed.
UNCLOSED = {"body": frozenset(["head"]), "article": frozenset(["head", "nav", "header"])}
#: A name after one of these tells about the layout.
NEGATORS = frozenset("has with no without".split())
#: Bad only outside article and main.
OUTER_NAMES = frozenset(["header", "site-header", "page-header"])

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(
    r"(?:^|\s)(?:hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I
)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")


class Block:
    __slots__ = ("text", "links", "bad", "inner", "section")

    def __init__(self, text: str, links: float, bad: bool, inner: bool, section: int):
        self.text, self.links, self.bad, self.inner, self.section = text, links, bad, inner, section


def _is_bad(tag: str, attributes: str, inner: bool) -> bool:
    if tag in BAD_TAGS or (tag == "header" and not inner):
        return True
    if not attributes or tag in ("html", "body", "main", "article"):
        # a page's or an article's own classes tell about all of it; comments may be articles
        return tag == "article" and bool(attributes) and "comment" in attributes.lower()
    for match in _NAMED.finditer(attributes):
        value = match[2] or match[3] or match[4] or ""
        before = ""
        for part in map(str.lower, _NAME.findall(value)):
            if before not in NEGATORS and (part in BAD_NAMES or BAD_PARTS.fullmatch(part)):
                return True
            before = part
        if not inner and any(name.lower() in OUTER_NAMES for name in value.split()):
            return True
    return _HIDDEN.search(attributes) is not None


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    # open elements: tag, whether article or main, whether block-level, and the era in which it was bad
    stack: list[tuple[str, bool, bool, int | None]] = []
    # of the open elements: each tag, bad ones of this era by tag, bad block-level and other ones
    tags: Counter = Counter()
    bad: Counter = Counter()
    bad_levels = bad_inline = inner = anchors = opened = era = 0
    sections = [0]

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, min(1.0, linked / len(text)), bad_levels > 0, inner > 0, sections[-1]))
        parts.clear()
        linked = 0

    def pop():
        nonlocal bad_levels, bad_inline, inner
        tag, was_inner, level, bad_era = stack.pop()
        tags[tag] -= 1
        if bad_era == era:
            bad[tag] -= 1
            bad_levels -= level
            bad_inline -= not level
        inner -= was_inner
        if level and tag not in LEAF_TAGS:
            sections.pop()

    def write(text: str):
        nonlocal linked
        if bad_inline:
            return
        parts.append(text)
        if anchors:
            linked += len(" ".join(text.split()))

    at = 0
    while True:
        match = _MARKUP.search(page, at)
        if match is None:
            write(page[at:])
            break
        if match.start() > at:
            write(page[at : match.start()])
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        level = tag in BLOCK_TAGS
        if level:
            flush()
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        if tag == "a":
            anchors = 0 if closing else 1
        if closing:
            while tags[tag]:
                last = stack[-1][0]
                pop()
                if last == tag:
                    break
            continue
        if level:
            # a paragraph, and bad text within it, ends where the next block begins
            while stack and (stack[-1][0] == "p" or not stack[-1][2]):
                pop()
            anchors = 0
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at = end.start() if end else len(page)
            continue
        if tag in VOID_TAGS or attributes.endswith("/"):
            continue
        wrong = _is_bad(tag, attributes, inner > 0)
        if level or wrong:
            main = tag in ("article", "main")
            held = bad_levels + bad_inline
            if held and (tag == "main" or (tag in UNCLOSED and sum(bad[t] for t in UNCLOSED[tag]) == held)):
                # what holds the main part was named for its layout, or was never closed: a new era
                bad.clear()
                bad_levels = bad_inline = 0
                era += 1
            stack.append((tag, main, level, era if wrong else None))
            tags[tag] += 1
            if wrong:
                bad[tag] += 1
                bad_levels += level
                bad_inline += not level
            inner += main
            if level and tag not in LEAF_TAGS:
                opened += 1
                sections.append(opened)
    flush()
    return out


def label(found: list[Block]) -> list[bool]:
    """Which blocks are main text."""
    has_inner = any(b.inner and not b.bad for b in found)
    words = [_WORD.findall(b.text.lower()) for b in found]
    stops = [sum(w in STOP_WORDS for w in ws) for ws in words]
    plain = [i for i, b in enumerate(found) if not b.bad and (b.inner or not has_inner)]
    known = sum(stops[i] for i in plain) >= STOPS_KNOWN * sum(len(words[i]) for i in plain)
    first: list[bool | None] = []
    for b, ws, s in zip(found, words, stops, strict=True):
        if b.bad or (has_inner and not b.inner) or b.links > LINKS or "©" in b.text[:SHORT]:
            first.append(False)
        elif len(b.text) >= SHORT and (not known or s >= STOPS * len(ws)):
            first.append(True)
        else:
            first.append(None)
    if True not in first:
        return [decided is None for decided in first]
    n = len(found)
    # distance to, and label of, the nearest decided block on either side within the article
    near: list[list[tuple[int, bool] | None]] = []
    for order in (range(n), range(n - 1, -1, -1)):
        side: list[tuple[int, bool] | None] = [None] * n
        last = before = None
        for i in order:
            if before is not None and found[before].inner != found[i].inner:
                last = None
            elif last is not None:
                last = (last[0] + (1 if found[i].section == found[before].section else 1 + SECTION_STEP), last[1])
            side[i] = last
            if first[i] is not None:
                last = (0, first[i])
            before = i
        near.append(side)
    out = []
    for i, decided in enumerate(first):
        if decided is None:
            sides = [s[i] for s in near if s[i] is not None]
            decided = min(sides, key=lambda x: x[0])[1] if sides else True
        out.append(decided)
    return out


def extract(page: str | None) -> str:
    found = blocks(page or "")
    return "\n\n".join(b.text for b, good in zip(found, label(found), strict=True) if good)


def main_text(pages: DataFrame, *, source: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text in column ``name``, in place of one so named."""
    kept = pages.drop(name) if name != source else pages
    schema = T.StructType([*kept.schema.fields, T.StructField(name, T.StringType())])

    def run(batches):
        for batch in tokens.small(batches):
            texts = [extract(p) for p in batch[source].to_pylist()]
            yield batch.append_column(name, pa.array(texts, pa.string()))

    return kept.mapInArrow(run, schema)
