"""Main text of web pages by line-block distribution.

Markup is stripped into blocks in page order (block-level tags end a block, ``br`` is white space); a block is a line.
Its weight is its text length without the text of links (those of headings count); an element whose tag, role or class names a menu, page header,
footer, sidebar, notice, advert, form or reader comment gives its blocks no weight, and where the page marks its article
(``article``, else ``main``, or ``main`` if its articles hold less than half of its text) blocks outside weigh nothing and those inside
``MARK`` code points more each, which lets every such block surge by itself.  Weights are summed over a sliding window of ``WINDOW`` lines.  Text surges at the first line with weight whose window's sum is over
``SURGE``; it dives after the last line whose window's sum is over zero for that line's own weight, so a short closing paragraph
behind an advert stays.  The lines with weight between the two points are the main text.  As an article keeps all its own blocks, the
points can only cut pages that mark none.  A page that never surges keeps all its lines with weight, unless they are a single code point together.

Character references are decoded, white space in a block becomes one space, blocks join by a newline.  Null or
empty html, or a page without such text, gives an empty text.  Comments, scripts and styles are skipped as
browsers do; an unclosed one runs to the end, and so does a tag that is never closed.  The work is linear in the page's
length.  Rows are independent, so repeated rows give repeated results; null ids and urls stay; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import itertools
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW, SURGE, MARK = 3, 86, 87

# fixed values: elements by role
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead title tr ul".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED_TAGS = frozenset("head nav menu header footer aside form dialog button select template svg canvas audio video object noscript".split())
RAW_TAGS = frozenset("script style textarea title iframe noembed noframes xmp".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
# words of a class or id that name a part beside the article, and words that only say where or how large it is
SKIPPED_WORDS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertisements banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notification outbrain overlay pagination popup promo"
    " promoted promotion related replies reply share sharing sidebar signup social sponsor sponsored subscribe subscription taboola toolbar widget widgets".split()
)
PLACE_WORDS = frozenset("area bar block bottom box btn button buttons container content footer global icons inner left links list main messages outer page panel primary posts right secondary section site slot sticky stories top unit wrap wrapper".split())
COMMENT_WORDS = frozenset("comment comments disqus reply replies".split())

_COMMENT_END = re.compile(r"--!?>")
#: A tag whose quotes pair up, and any run up to the next angle bracket.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW_TAGS}
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_SPLIT_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _named_beside(value: str) -> bool:
    """Whether one of the names says a part beside the article: "cookie-notice" does, "share-price" does not."""
    for name in value.split():
        words = _WORDS.findall(_SPLIT_CASE.sub(" ", name).lower())
        if any(w in SKIPPED_WORDS for w in words):
            beside = [w in SKIPPED_WORDS for w in words]
            if all(x or w in PLACE_WORDS or w.isdigit() for x, w in zip(beside, words)):
                return True
    return False


def _unwanted(tag: str, attributes: str, in_article: bool) -> str:
    """'tag', 'word' or 'comment' if the element is no part of an article, else ''."""
    if tag in SKIPPED_TAGS and not (tag == "header" and in_article):
        return "tag"
    if attributes and tag not in ("html", "body", "main"):
        for name, value in _ATTRIBUTE.findall(attributes):
            value = value.strip("\"'")
            if name.lower() == "role":
                if set(value.lower().split()) & SKIPPED_ROLES:
                    return "word"
            elif _named_beside(value):
                return "comment" if set(_WORDS.findall(value.lower())) & COMMENT_WORDS else "word"
    return ""


def tags(page: str):
    """(text before, tag or '', closing, attributes) in order; each character is looked at a fixed number of times."""
    at, end, last = 0, len(page), page.rfind(">")
    pattern = _TAG
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            yield page[at:], "", False, ""
            return
        after = page[lt + 1 : lt + 4]
        if after.startswith("!--"):
            stop = _COMMENT_END.search(page, lt + 4)
            yield page[at:lt], "", False, ""
            at = stop.end() if stop else end
        elif after[:1] in ("!", "?"):
            stop = page.find(">", lt)
            yield page[at:lt], "", False, ""
            at = stop + 1 if stop >= 0 else end
        elif after[:1].isascii() and after[:1].isalpha() or after[:1] == "/" and after[1:2].isascii() and after[1:2].isalpha():
            m = None
            if lt < last:
                m = pattern.match(page, lt)
                if not m and pattern is _TAG:
                    # quotes that never pair up: from here on tags end at the next bracket, as the search may not be repeated
                    pattern = _LOOSE_TAG
                    m = pattern.match(page, lt)
            if not m:
                yield page[at:lt], "", False, ""
                return
            tag = m[2].lower()
            yield page[at:lt], tag, bool(m[1]), m[3]
            at = m.end()
            if not m[1] and tag in RAW_TAGS:
                stop = _RAW_END[tag].search(page, at)
                at = stop.end() if stop else end
        else:
            yield page[at : lt + 1], "", False, ""
            at = lt + 1


def blocks(page: str) -> list[tuple[str, int, bool, bool, bool]]:
    """(text, code points of links, skipped, in article, in main) of each non-empty block."""
    out: list = []
    parts: list[str] = []
    links: list[str] = []
    skip_tag = skip_why = ""
    skip_depth = article = main = anchor = heading = 0
    state = (False, False, False)

    def close():
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((text, len(" ".join(_html.unescape(" ".join(links)).split())), *state))
        links.clear()

    for text, tag, closing, attributes in tags(page):
        if text:
            parts.append(text)
            if anchor and not heading:
                links.append(text)
        if not tag:
            continue
        if not closing and tag in RAW_TAGS:
            if tag == "title":
                close()
            continue
        if tag == "a":
            anchor = 0 if closing else 1
        elif tag in HEADING_TAGS:
            heading = 0 if closing else 1
        if tag in BLOCK_TAGS:
            close()
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        if tag in VOID_TAGS or attributes.endswith("/") and not closing and tag not in BLOCK_TAGS:
            continue
        if not closing:
            why = _unwanted(tag, attributes, article > 0)
            if skip_depth:
                # a plain article in a wrongly named wrapper, or after an unclosed element, is an article
                if tag in ("main", "article") and not why and skip_why != "comment" or tag == "body" and skip_tag == "head":
                    close()
                    skip_depth = 0
                elif tag == skip_tag:
                    skip_depth += 1
            elif why:
                close()
                skip_tag, skip_why, skip_depth = tag, why, 1
            if not skip_depth:
                article += tag == "article"
                main += tag == "main"
        else:
            if skip_depth:
                if tag == skip_tag:
                    skip_depth -= 1
                    if not skip_depth:
                        close()
                elif tag in ("body", "html"):
                    skip_depth = 0
            else:
                article -= tag == "article" and article > 0
                main -= tag == "main" and main > 0
        now = (skip_depth > 0, article > 0, main > 0)
        if now != state:
            close()
            state = now
    close()
    return out


def weights_of(rows: list[tuple[str, int, bool, bool, bool]]) -> list[int]:
    """Weight of each block."""
    inside = {k: sum(len(r[0]) for r in rows if r[k] and not r[2]) for k in (3, 4)}
    # articles that hold less than half of what main does are teasers beside its own text
    marked = 3 if inside[3] and 2 * inside[3] >= inside[4] else 4 if inside[4] else None
    if marked:
        return [len(r[0]) + MARK if r[marked] and not r[2] else 0 for r in rows]
    return [0 if r[2] else max(0, len(r[0]) - r[1]) for r in rows]


def surge_and_dive(weights: list[int], window: int = WINDOW, surge: int = SURGE) -> tuple[int, int]:
    """The lines [first, last) between the surge and the dive of the sums over ``window`` lines; (0, 0) if none has weight."""
    upto = [0, *itertools.accumulate(weights)]
    sums = [upto[min(i + window, len(weights))] - upto[i] for i in range(len(weights))]
    last = next((i + 1 for i in range(len(weights) - 1, -1, -1) if sums[i] > 0 and weights[i]), 0)
    return next((i for i in range(last) if weights[i] and sums[i] > surge), 0), last


def main_text(page: str | None) -> str:
    if not page:
        return ""
    rows = blocks(page)
    weights = weights_of(rows)
    if sum(weights) < 2:
        return ""
    first, last = surge_and_dive(weights)
    return "\n".join(rows[i][0] for i in range(first, last) if weights[i])


def _extract(batches):
    for b in batches:
        texts = [main_text(x) for x in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    common.ship(pages.sparkSession)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))


QUERIES = {"op7_main_text": op7_main_text}
ORACLES: dict[str, str] = {}
