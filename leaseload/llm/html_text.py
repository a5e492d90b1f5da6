"""Main text of web pages by two passes over blocks.

A page is cut into blocks at block tags. Pass one looks at each block alone: blocks in
navigation, headers, footers, asides, forms, adverts, notices and comments are bad, as
are blocks that are mostly links; long blocks with many stop words are good, long ones
with few are bad; the rest is undecided. Where a page marks its article, only blocks
inside it can be good, and stop words decide nothing against them. Pass two gives an
undecided block the label of its nearest decided neighbours within the same region;
a heading takes that of the next one. If both sides are equally near and differ, it is
bad, unless the page marks an article.

The page is read by states, one place after the other, attribute values as the rules of the
markup read them, so broken tags cost no more than whole ones. A class or an id speaks
against a part only if all its words name such parts or say nothing, and a page of which
names leave nothing is read without them. Where there are no stop words for a script,
long blocks with few links are good.

Scripts, styles and markup comments are no text. Character references are decoded,
white space inside a block becomes one space, blocks are joined by one space. Null or
empty html gives an empty text; a page cut off in the middle is read as far as it goes.
Repeated pages are extracted each; other columns, also one named ``text``, are not looked
at. An empty table gives no row.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaseload.llm.common import text_or_empty

# Fixed word lists: frequent words of four languages, for the share of them in a block.
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from has have he in is it its not of on or she that the their this to was were
    which will with you
    aber als auch auf aus bei das dem den der des die ein eine einen er es für im in ist mit nicht oder sich sie
    sind und von war wie zu zum
    au aux avec ce dans de des du elle en est et il la le les leur mais ne nous ou par pas plus pour que qui se
    son sont sur un une
    al como con de del el ella en es esta este la las lo los más no o para pero por que se su sus un una y
    """.split()
)
LONG_CHARS = 70
STOP_SHARE = 0.3
FEW_STOP_SHARE = 0.1
MAX_LINK_SHARE = 0.5
MAX_LINK_SHARE_IN_ARTICLE = 0.9

# What these hold is no markup; it ends at their own closing tag only.
RAW_TAGS = {"script", "style", "noscript", "textarea", "title", "iframe"}
# Drawings and formulas; a block inside one ends it.
FOREIGN_TAGS = {"svg", "math"}
BAD_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head", "template", "object", "select", *FOREIGN_TAGS}
ARTICLE_TAGS = {"article", "main"}
BLOCK_TAGS = set(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary
    table tbody td tfoot th thead title tr ul""".split()
)
# Block tags that a following block ends, when they were left open.
LOOSE_TAGS = {"p", "li", "dt", "dd", "option", "h1", "h2", "h3", "h4", "h5", "h6"}
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
# Fixed words: a class or id names something beside the main text if all its words are of
# these two kinds, one of the first at least.
BAD_WORDS = set(
    """ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist
    cookie cookies consent disqus footer login masthead menu nav navbar navigation newsletter notice notices alert alerts
    pagination popup modal promo promos promotion related replies respond share sharing sidebar signup skip social sponsor
    sponsored sponsors subscribe subscription toolbar widget widgets""".split()
)
PLAIN_WORDS = set(
    """area articles bar block body bottom box button buttons center column container content feed float footer form global
    grid group header holder icons inner item items layout left link links list main message outer overlay page panel
    policy posts primary reader region right row secondary section site slot strip sub tags text the title to top user
    unit view wrap wrapper zone""".split()
)
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu"}

TAG_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
# One attribute: a name up to white space, a slash, the tag's end or an equals sign, then a
# value in quotes (to the same quote, whatever stands between) or up to white space.
ATTRIBUTE = re.compile(r"""[\s/]*(?P<name>=?[^\s/>=]*)(?:\s*=\s*(?:"(?P<double>[^"]*)(?P<end>"?)|'(?P<single>[^']*)(?P<stop>'?)|(?P<bare>[^\s>]*)))?""")
COMMENT_END = re.compile(r"--!?>")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    link_chars: int
    # Beside the main text: 2 by its tag, role or style, 1 by a name only, 0 not.
    bad: int
    article: int
    heading: bool


def named_bad(value: str) -> bool:
    """Whether a class or an id names something beside the main text."""
    for token in value.lower().split():
        words = [w for w in re.split(r"[-_0-9x]*[-_0-9]+|[-_]", token) if w]
        if words and any(w in BAD_WORDS for w in words) and all(w in BAD_WORDS or w in PLAIN_WORDS for w in words):
            return True
    return False


def marked_bad(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """Whether an opening tag begins a part that is not the page's main text: 2 surely, 1 by its name."""
    if tag in BAD_TAGS or (tag == "header" and not in_article):
        return 2
    if not attributes:
        return 0
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return 2
    if attributes.get("role", "").lower() in BAD_ROLES or HIDDEN_STYLE.search(attributes.get("style", "")):
        return 2
    if tag in ("html", "body", "article", "main"):
        return 0
    return int(any(named_bad(attributes[name]) for name in ("class", "id") if name in attributes))


def tag_at(page: str, at: int) -> tuple[str, dict[str, str], bool, int] | None:
    """(name, attributes, closes itself, place behind it) of the tag whose ``<`` is before
    ``at``; null where no tag begins. A tag that the page ends in has the name ``""``."""
    named = TAG_NAME.match(page, at)
    if not named:
        return None
    attributes: dict[str, str] = {}
    at = named.end()
    while True:
        found = ATTRIBUTE.match(page, at)
        if found["name"]:
            # The first of equal names counts; a quote that is never closed runs to the page's end.
            value = next((v for v in (found["double"], found["single"], found["bare"]) if v is not None), "")
            attributes.setdefault(found["name"].lower(), html.unescape(value))
        slash = page.endswith("/", at, found.end()) if found["bare"] is None else False
        if found.end() >= len(page):
            return "", {}, False, len(page)
        if page[found.end()] == ">":
            return named[0].lower(), attributes, slash, found.end() + 1
        # An equals sign or slash without anything to it is passed over.
        at = found.end() if found.end() > at else at + 1


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in order, each with what pass one needs."""
    blocks: list[Block] = []
    parts: list[str] = []
    open_tags: list[tuple[str, int, int]] = []
    names: Counter[str] = Counter()
    link_depth = link_chars = articles = 0
    heading = False
    at = 0
    lowered = page.lower()

    def state() -> tuple[int, int]:
        return (open_tags[-1][1], open_tags[-1][2]) if open_tags else (0, 0)

    def pop() -> str:
        name = open_tags.pop()[0]
        names[name] -= 1
        return name

    def add(piece: str) -> None:
        nonlocal link_chars
        if piece:
            piece = html.unescape(piece)
            parts.append(piece)
            if link_depth:
                link_chars += len("".join(piece.split()))

    def flush() -> None:
        nonlocal parts, link_chars
        text = " ".join("".join(parts).split())
        if text:
            bad, article = state()
            blocks.append(Block(text, link_chars, bad, article, heading))
        parts, link_chars = [], 0

    while True:
        sign = page.find("<", at)
        if sign < 0:
            add(page[at:])
            flush()
            return blocks
        add(page[at:sign])
        if page.startswith(("<!", "<?"), sign):
            comment = COMMENT_END.search(page, sign + 2) if page.startswith("<!--", sign) else None
            at = comment.end() if comment else page.find(">", sign) + 1
            if not comment and (at == 0 or page.startswith("<!--", sign)):
                at = len(page)
            continue
        read = tag_at(page, sign + 1)
        if read is None:
            add("<")
            at = sign + 1
            continue
        tag, attributes, closed, at = read
        if not tag:
            continue
        closing = tag.startswith("/")
        tag = tag.lstrip("/")
        if tag in RAW_TAGS and not closing:
            if not closed:
                end = lowered.find(f"</{tag}", at)
                behind = page.find(">", end) + 1 if end >= 0 else 0
                at = behind or len(page)
            if tag in BLOCK_TAGS:
                flush()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            link_depth = 0 if closing else 1
        block = tag in BLOCK_TAGS
        if block:
            flush()
            heading = not closing and tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        if closing:
            if names[tag]:
                if not block:
                    flush()
                while pop() != tag:
                    pass
            continue
        if block and any(names[f] for f in FOREIGN_TAGS):
            while pop() not in FOREIGN_TAGS:
                pass
        if block and open_tags and open_tags[-1][0] in LOOSE_TAGS and tag not in ("ul", "ol", "dl"):
            pop()
        if tag in VOID_TAGS or closed:
            continue
        bad, article = state()
        bad_here = marked_bad(tag, attributes, article > 0)
        if tag in ARTICLE_TAGS and not article:
            articles += 1
            article = articles
        watched = names[tag] > 0 if not block else False
        if (block and tag not in LOOSE_TAGS) or bad_here or watched:
            if not block:
                flush()
            open_tags.append((tag, max(bad, bad_here), article))
            names[tag] += 1


def first_pass(block: Block, has_article: bool) -> bool | None:
    """Good, bad, or None for undecided."""
    chars = len(block.text) - block.text.count(" ")
    links = block.link_chars / max(1, chars)
    if block.bad or (has_article and not block.article):
        return False
    if links > (MAX_LINK_SHARE_IN_ARTICLE if block.article else MAX_LINK_SHARE):
        return False
    if len(block.text) < LONG_CHARS or block.heading:
        return None
    words = block.text.lower().split()
    share = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / len(words)
    if share >= STOP_SHARE:
        return True
    # Scripts for which there are no stop words: a long block with few links is text.
    letters = sum(c.isalpha() for c in block.text)
    if letters and sum("a" <= c <= "ɏ" for c in block.text.lower()) < letters / 2:
        return True
    return False if share < FEW_STOP_SHARE and not block.article else None


def second_pass(blocks: list[Block], first: list[bool | None], has_article: bool) -> list[bool]:
    """Undecided blocks take the label of the nearest decided block of their region."""
    n = len(blocks)
    before: list[tuple[int, bool] | None] = [None] * n
    after: list[tuple[int, bool] | None] = [None] * n
    for side, order in ((before, range(n)), (after, range(n - 1, -1, -1))):
        near, region = None, None
        for i in order:
            if blocks[i].bad:
                continue
            if blocks[i].article != region:
                near, region = None, blocks[i].article
            if first[i] is not None and not (has_article and not first[i]):
                near = (i, first[i])
            side[i] = near
    labels = []
    for i, label in enumerate(first):
        if label is None:
            left, right = before[i], after[i]
            if blocks[i].heading and right:
                left = None
            gaps = [(abs(i - j), good) for j, good in (x for x in (left, right) if x)]
            nearest = {good for gap, good in gaps if gap == min(g for g, _ in gaps)}
            label = has_article if len(nearest) != 1 else nearest.pop()
        labels.append(label)
    return labels


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    text = _chosen(blocks)
    if not text and any(b.bad == 1 for b in blocks):
        # A name alone does not condemn all there is to read on a page.
        text = _chosen([replace(b, bad=b.bad if b.bad > 1 else 0) for b in blocks])
    return text


def _chosen(blocks: list[Block]) -> str:
    has_article = any(b.article and not b.bad for b in blocks)
    first = [first_pass(b, has_article) for b in blocks]
    labels = second_pass(blocks, first, has_article)
    return " ".join(b.text for b, good in zip(blocks, labels) if good)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    import pandas as pd

    def over(texts: pd.Series) -> pd.Series:
        return pd.Series([main_text(t) for t in texts], dtype=object)

    over.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return pages.select("page_id", "url", F.pandas_udf(over, "string")(text_or_empty("html")).alias("text"))
