"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags, and only there: what is dropped inside a paragraph leaves no gap. What
stands inside elements that never hold an article's text (scripts, menus, footers, forms and the like, by tag, role, or
a class or id word such as ``sidebar``) is no candidate. A class, a role or a form is only a hint, as pages
name their layout so (``has-sidebar``, ``header-fixed``, one form around everything): an element that holds most of the page's
text, and its heading or article mark if there is one, is a wrapper and not a part. Headers are dropped, also
an article's own, with the title in it. Where the page marks what is its
article, only marked blocks are returned, unless these hold less good text than the others:
then the mark (of teaser cards, say) is no guide, and all blocks are judged without it.

First pass, each block by itself: share of letters inside links, length, share
of stop words. Many links or a copyright mark make it bad; long with stop words
good; the rest is ambiguous: short, or nearly good. Stop words are known for some languages only: on a
page where no block is rich in them, length and links alone decide. Second pass: a nearly good block is good
unless all its nearest decided neighbours are bad. A short one then takes the label of the nearest
decided block, the good one on a tie; if a page has none decided, it is good. The mark is in an ambiguous block's
favour: inside a marked article it is bad only between two bad ones, lack of stop words makes a block
ambiguous and not bad (lists, code, names), and a heading is good.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tiermart.llm.common import arrow_map, strings

# HTML element names.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead title tr ul caption".split())
DROPPED_TAGS = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video nav footer header aside form "
    "button select textarea menu dialog map applet".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose start tag ends an open paragraph (HTML parsing rules).
ENDS_P = BLOCK_TAGS - {"body", "head", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup",
                       "legend", "title"}
# An open element of the key's kind ends where one of these starts (implied end tags).
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}}
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar toolbar dialog alert alertdialog".split())
# Words of a class or id that name what is not the article.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent copyright disclaimer discussion disqus footer gdpr header login masthead menu menus modal nav "
    "navbar navigation newsletter notice notices notification pagination pager paywall popup promo promoted promotion "
    "related replies respond responses search share sharing sidebar sidebars signup skip social sponsor sponsored "
    "subscribe subscription tags toolbar topbar widget widgets".split())
ARTICLE_TAGS = frozenset({"article", "main"})
# Of these, words that are also part of other names (market-share, related-work): they count if the rest of the name is
# of words that name parts of pages.
WEAK_WORDS = frozenset("share sharing related search notice notices tags promo promotion promoted discussion responses respond "
                       "replies skip disclaimer copyright subscription notification social banner".split())
COMPANIONS = frozenset(
    "area article articles bar block blocks body bottom box btn button buttons card cards column container content cta desktop "
    "entry fixed float form global grid group heading icon icons inline inner item items js layout left line link links list "
    "main mobile more news outer page panel post posts primary reading right row secondary section site slot sticky stories "
    "story text title to top topics unit wrap wrapper".split())
# A name that begins so says what a layout has or has not.
LAYOUT_WORDS = frozenset("has no with without is not hide show".split())
# Such words on an article element itself name one that is not the page's own.
DROPPED_ARTICLES = frozenset("ad advert advertisement comment comments promo promoted related replies reply sponsored "
                             "teaser".split())

# Most frequent function words by language; a caller may pass others.
FUNCTION_WORDS = {
    "en": "a about all also an and are as at be but by can for from had has have he her his if in is it its not of on one or "
          "our she that the their them there they this to was we were which who will with would you",
    "de": "als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat im in ist "
          "mit nach nicht noch oder sein sich sie sind und vom von vor war wie zu zum zur über",
    "fr": "au aux avec ce ces cette dans de des du elle en est et il ils la le les leur mais ne on ou par pas plus pour que "
          "qui sa se ses son sont sur un une vous",
    "es": "al como con de del desde el en era es esta este fue ha la las le les lo los más no o para pero por que se ser sin "
          "sobre su sus también un una y ya",
    "it": "al alla anche che con da dal dei del della delle di e gli ha il in la le lo ma nel nella non per più si sono su un "
          "una è",
    "pt": "ao aos as até com como da das de do dos e ela ele em entre essa esta foi mais mas na nas no nos não o os para pela "
          "pelo por que se sem ser seu sua são também um uma à é",
    "nl": "aan als bij dan dat de deze die dit door een en er haar heeft het hij hun ik in is maar met naar niet nog of om ook "
          "op over te tot uit van voor was wat werd worden zijn",
    "pl": "ale był była były co dla do i ich jak jako jego jej jest już na nie o od oraz po pod przez przy się są tak tego ten "
          "to tym w z za ze że",
    "sv": "att av de den det efter eller en ett från för ha han har hon i inte kan men med när och om på sig som till var vi "
          "är över",
    "ru": "а бы был была были в во все для до его ее еще же за и из или их к как когда которые который мы на не но о он она они "
          "от по при с со так также только то у что чтобы это",
}
STOP_WORDS = frozenset(w for words in FUNCTION_WORDS.values() for w in words.split())

# A class or id word that begins so names no article either.
DROPPED_PREFIXES = ("comment", "sidebar", "cookie", "advert", "newsletter", "sponsor", "navbar", "breadcrumb", "adsby")

LINK_SHARE = 0.4
SHORT = 60
LONG = 180
STOP_LOW = 0.08
STOP_HIGH = 0.22
SOFT, HARD = 1, 2  # how an element is dropped: unless it is a wrapper, or in any case
WRAPPER = 0.5  # share of the page's text in an element with its heading or article mark
WRAPPER_UNMARKED = 0.8  # and where the page has neither
GOOD, BAD, SHORT_BLOCK, NEAR_GOOD = "good", "bad", "short", "near"

# As browsers read tags: a quote opens a value only after "=", elsewhere it is a character as any. One that is never closed is too.
_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]*)|[^>=])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.S)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")  # also the parts of camelCase
_WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    in_article: bool
    heading: bool = False
    label: str = field(default="")


def _names_part(name: str) -> bool:
    """Does a class or id name a part of the page that is not the article?"""
    words = [w.lower() for w in _NAME.findall(name)]
    if not words or words[0] in LAYOUT_WORDS and len(words) > 1:
        return False
    if any(w.startswith(DROPPED_PREFIXES) or w in DROPPED_WORDS and w not in WEAK_WORDS for w in words):
        return True
    return not WEAK_WORDS.isdisjoint(words) and all(len(w) < 3 or w in COMPANIONS or w in DROPPED_WORDS for w in words)


def _dropped(tag: str, attributes: str) -> int:
    """0: a candidate; SOFT: dropped, if it is no wrapper; HARD: dropped."""
    if tag in DROPPED_TAGS:
        return SOFT if tag == "form" else HARD
    if not attributes or tag in ("html", "body"):
        return 0
    found = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape("".join(values))
        if name == "hidden":
            return HARD
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return HARD
        if name == "role" and value.strip().lower() in DROPPED_ROLES:
            found = SOFT
        if name in ("class", "id"):
            if tag in ARTICLE_TAGS:
                if not DROPPED_ARTICLES.isdisjoint(w.lower() for w in _NAME.findall(value)):
                    return HARD
            elif any(map(_names_part, value.split())):
                found = SOFT
    return HARD if re.search(r"(?:^|[\s/])hidden(?:[\s/]|$)", _ATTRIBUTE.sub(" ", attributes), re.I) else found


def blocks(html: str) -> list[Block]:
    """Candidate blocks of a page in page order; unclosed and badly nested tags are repaired as browsers do."""
    out: list[tuple[Block, tuple[int, ...]]] = []  # with the softly dropped elements that it stands in
    parts: list[tuple[str, bool, tuple[int, ...]]] = []
    stack: list[tuple[str, int]] = []  # open elements, and whether they are dropped
    marks: list[tuple[int, ...]] = []  # of each heading of first order and article mark: where it stands
    inside: tuple[int, ...] = ()
    hard = linked = article = elements = 0
    heading = False

    def flush() -> None:
        if parts:
            base = min((s for _, _, s in parts), key=len)  # what is dropped inside a block's line is not its text
            text = " ".join(unescape("".join(t for t, _, s in parts if s == base)).split())
            if text:
                links = " ".join(unescape("".join(t for t, a, s in parts if a and s == base)).split())
                out.append((Block(text, len(links), article > 0, heading), base))
            parts.clear()

    def close(to: int) -> None:
        nonlocal hard, linked, article, inside
        while len(stack) > to:
            name, drop = stack.pop()
            hard -= drop == HARD
            if drop == SOFT:
                inside = inside[:-1]
            linked -= name == "a"
            article -= name in ARTICLE_TAGS

    def depth_of(names: set[str] | frozenset[str], stop: frozenset[str]) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return i
            if stack[i][0] in stop:
                break
        return -1

    scope = frozenset({"table", "td", "th", "html", "body", "article", "main", "section", "div", "nav", "aside", "footer",
                       "header", "form", "ul", "ol", "blockquote"})
    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        begin = m.start() if m else size
        if begin > at and not hard:
            parts.append((html[at:begin], linked > 0, inside))
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            i = depth_of({tag}, frozenset())
            if tag in BLOCK_TAGS and not hard:
                flush()
                heading = False
            if i >= 0:
                close(i)
            continue
        if tag in BLOCK_TAGS:
            if not hard:
                flush()
                heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            if tag in ENDS_P:
                i = depth_of({"p"}, scope)
                if i >= 0:
                    close(i)
            if tag in IMPLIED:
                i = depth_of(IMPLIED[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
                if i >= 0:
                    close(i)
        elif tag == "br" and not hard:
            parts.append((" ", linked > 0, inside))
        drop = _dropped(tag, m.group(3))
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(html, at)
            if tag not in DROPPED_TAGS and not hard and not drop and tag != "title":
                parts.append((html[at:end.start()], linked > 0, inside))
            at = end.end()
            continue
        if tag in VOID_TAGS:
            continue
        if not hard and drop != HARD and (tag == "h1" or tag in ARTICLE_TAGS):
            marks.append(inside)
        stack.append((tag, drop))
        hard += drop == HARD
        if drop == SOFT:
            inside = (*inside, elements)
            elements += 1
        linked += tag == "a"
        article += tag in ARTICLE_TAGS
    flush()
    if not elements:
        return [b for b, _ in out]
    wrappers = _wrappers(out, marks)
    return [b for b, where in out if wrappers.issuperset(where)]


def _wrappers(found: list[tuple[Block, tuple[int, ...]]], marks: list[tuple[int, ...]]) -> set[int]:
    """Softly dropped elements that hold most of the page's text, and all of its headings of first order and article marks."""
    total, held = 0, dict.fromkeys((e for _, where in found for e in where), 0)
    for b, where in found:
        total += len(b.text) - b.linked
        for e in where:
            held[e] += len(b.text) - b.linked
    wrappers: set[int] = set()
    for e in sorted(held):  # outer elements first: a mark inside another dropped part is none
        open_marks = [m for m in marks if wrappers.issuperset(x for x in m if e not in m or x < e)]
        need = WRAPPER if open_marks else WRAPPER_UNMARKED
        if total and held[e] >= need * total and all(e in m for m in open_marks):
            wrappers.add(e)
    return wrappers


def _stop_share(text: str, stop_words: frozenset[str]) -> float:
    words = _WORDS.findall(text.lower())
    return sum(w in stop_words for w in words) / len(words) if words else 0.0


def _linked(b: Block) -> bool:
    return b.linked / len(b.text) > LINK_SHARE


def classify(found: list[Block], stop_words: frozenset[str] = STOP_WORDS) -> list[Block]:
    """Both passes; sets every block's label to good or bad and returns the good ones."""
    shares = [_stop_share(b.text, stop_words) for b in found]
    # Else the page is in a language that the stop words do not cover, and they say nothing of its blocks.
    known = any(share >= STOP_HIGH for b, share in zip(found, shares) if len(b.text) >= SHORT and not _linked(b))
    for b, stops in zip(found, shares):
        if _linked(b) or "©" in b.text and len(b.text) < LONG:
            b.label = BAD
        elif b.in_article and b.heading:
            b.label = GOOD
        elif len(b.text) < SHORT:
            b.label = SHORT_BLOCK
        elif stops >= STOP_HIGH or not known:
            b.label = GOOD if len(b.text) >= LONG else NEAR_GOOD
        elif stops >= STOP_LOW or b.in_article:
            b.label = NEAR_GOOD
        else:
            b.label = BAD
    for ambiguous in (NEAR_GOOD, SHORT_BLOCK):
        decided = [i for i, b in enumerate(found) if b.label in (GOOD, BAD)]
        labels = {i: found[i].label for i in decided}
        k = 0
        for i, b in enumerate(found):
            while k < len(decided) and decided[k] <= i:
                k += 1
            if b.label != ambiguous:
                continue
            near = [j for j in (decided[k - 1] if k else None, decided[k] if k < len(decided) else None) if j is not None]
            if ambiguous == NEAR_GOOD or b.in_article:
                b.label = BAD if len(near) > b.in_article and all(labels[j] == BAD for j in near) else GOOD
            else:
                least = min((abs(i - j) for j in near), default=0)
                b.label = GOOD if not near or any(labels[j] == GOOD for j in near if abs(i - j) == least) else BAD
    return [b for b in found if b.label == GOOD]


def main_text(html: str | None, stop_words: frozenset[str] = STOP_WORDS) -> str:
    """Text of the good blocks, one a line; empty if there is none."""
    if not html:
        return ""
    found = blocks(html)
    good = classify(found, stop_words)
    if any(b.in_article for b in found):
        marked = sum(len(b.text) for b in good if b.in_article)
        others = sum(len(b.text) for b in good if not b.in_article and len(b.text) >= SHORT)
        if marked >= others:
            good = [b for b in good if b.in_article]
        else:
            for b in found:
                b.in_article = False
            good = classify(found, stop_words)
    return "\n".join(b.text for b in good)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
            stop_words: frozenset[str] = STOP_WORDS) -> DataFrame:
    """(key, url, text, n_chars) for every page.

    A null or empty page, and one without a good block, has an empty text. Truncated
    markup is read as far as it goes. Repeated rows each get a row; no rows give none.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        text = [main_text(h, stop_words) for h in strings(batch.column(2))]
        return {key: batch.column(0), url: batch.column(1), "text": text, "n_chars": [len(t) for t in text]}

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (key, url)}
    return arrow_map(pages.select(key, url, html), rows,
                     f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long")
