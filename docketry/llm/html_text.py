"""Main text of web pages by two-pass block rules (operator 13).

A page is cut into blocks at its block-level tags. The first pass calls a block good or bad
by where it stands (navigation, footers, forms, adverts, comments), its link density, its
length and its density of stop words, or leaves a short one undecided. In the second pass
undecided blocks take the label of their nearest decided neighbours. Where a page marks its
article, only that part is judged, and its blocks are good unless something speaks against them.

Parsing forgives: tags need no ends, unclosed comments and scripts reach to the end of the
page, an end tag closes all that is open inside its element, and without such an element
does nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Characters from which a block counts as long, stop-word shares of a good and of a doubtful block, link share of a bad one.
LONG, STOP_HIGH, STOP_LOW, LINKS = 70, 0.30, 0.12, 0.5
#: A page with fewer stop words a character is in a language without a list: length alone counts.
STOP_KNOWN = 0.004
#: So many link blocks in a row are a menu, wherever they stand.
MENU = 3

# Frequent function words.
STOP_WORDS = frozenset(
    "a about all also an and are as at be been but by can could for from had has have he her his how if in into is it its more most no not of on one only or other our out said she so some than that the their them then there these they this to up us was we were what when which who will with would you your "
    "aber als am auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer er es für hat ich ihr im ist ja kann man mit nach nicht noch nur oder sch sein sich sie sind so über um und uns vom von vor war was wenn werden wie wir zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et ils je la le les leur lui mais ne nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con del el ella entre era es esta este fue ha hay la las lo los más me mi muy ni no nos o para pero por porque que se ser si sin sobre su sus también una uno y ya yo".split()
)

# Elements of HTML.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
#: Their content is no text of the page; the first group is raw text, in which only the own end tag counts.
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
UNSEEN = frozenset("audio button canvas datalist head map object optgroup option progress select svg template video".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
KNOWN = BLOCK | RAW | UNSEEN | VOID | {"a"}
ASIDE = frozenset("aside dialog footer menu nav search".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Parts of class names and ids that tell what is not the article.
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert aside banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright disqus dropdown footer gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription teaser teasers toc toolbar widget widgets".split()
)
#: First parts that say an element only has such things or lacks them, and last parts that say it is the content all the same.
ONLY_HAS, STILL_CONTENT = frozenset("has hide is no non with without".split()), frozenset("article content main".split())
#: Headings under which readers write.
COMMENT_HEADS = frozenset("comment comments discussion responses replies kommentar kommentare commentaire commentaires comentario comentarios".split())
CONTENT_NAMES = frozenset("article articlebody content entry main post story".split())

#: What can hold articles that are not the page's.
ASIDE_OF_ARTICLES = frozenset("aside div footer li ol section td ul".split())
_NOTHING = ("", False, 0, False, False, False)
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+|=)*+)>""")
_ATTRIBUTE = re.compile(r"""(?:^|[\s/])(class|id|role|hidden|aria-hidden|style|itemprop)(?=[\s/=>]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_LETTERS = re.compile("[a-zà-öø-ÿœ]+")  # those of the languages of STOP_WORDS


@dataclass
class Block:
    """Text between two block-level tags and where it stands."""

    region: int  #: 2 in an article, 1 in the main part, 0 elsewhere
    aside: bool
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: str = ""  #: good, bad or undecided


def _named(names: str) -> tuple[bool, bool]:
    """(aside, content) by the class names and the id of an element."""
    aside = content = False
    for name in names.split():
        parts = [p.lower() for p in _PART.findall(name)]
        if not parts or parts[0] in ONLY_HAS:
            continue
        if parts[-1] in STILL_CONTENT or len(parts) == 1 and parts[0] in CONTENT_NAMES or "".join(parts) == "articlebody":
            content = True
        elif not ASIDE_NAMES.isdisjoint(parts):
            aside = True
    return aside, content and not aside


def _attributes(text: str) -> tuple[bool, bool]:
    """(aside, content) by the attributes of a tag."""
    aside = content = False
    for name, *values in _ATTRIBUTE.findall(text):
        name, value = name.lower(), unescape("".join(values))
        if name in ("class", "id", "itemprop"):
            a, c = _named(value)
            aside, content = aside or a, content or c
        elif name == "role":
            aside, content = aside or value.strip().lower() in ASIDE_ROLES, content or value.strip().lower() in ("main", "article")
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            aside = True
    return aside, content


def blocks(html: str, release: bool = False) -> list[Block]:
    """The blocks of a page that hold text, in page order, without labels.

    An article or main part ends what of navigation, forms and headers is still open around
    it; with release, everything that is.
    """
    out: list[Block] = []
    open_: list[tuple[str, bool, int, bool, bool, bool]] = []  # (tag, aside, region, unseen, header, aside by itself)
    links = 0
    now: Block | None = None

    def text(raw: str):
        nonlocal now
        if not raw or open_ and open_[-1][3]:
            return
        if "&" in raw:
            raw = unescape(raw)
        if now is None:
            if raw.isspace():
                return
            _, aside, region, _, header, _ = open_[-1] if open_ else _NOTHING
            heading = any(o[0] in HEADINGS for o in open_)
            now = Block(region, aside or header and not (heading and region), heading)
        now.parts.append(raw)
        if links:
            now.linked += len("".join(raw.split()))

    def close():
        nonlocal now
        if now is not None:
            now.text = " ".join("".join(now.parts).split())
            now.parts = []
            if now.text:
                out.append(now)
            now = None

    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            text(html[at:])
            break
        if lt > at:
            text(html[at:lt])
        follows = html[lt + 1 : lt + 2]
        if follows in ("!", "?") or follows == "/" and not html[lt + 2 : lt + 3].isalpha():
            if html.startswith("<!--", lt):
                if html.startswith(("<!-->", "<!--->"), lt):
                    end = html.find(">", lt) + 1
                else:
                    end = html.find("-->", lt + 4) + 3
                    end = end if end > 2 else n
            elif html[lt : lt + 9].upper() == "<![CDATA[":
                end = html.find("]]>", lt) + 3
                end = end if end > 2 else n
            else:
                end = html.find(">", lt) + 1 or n
            at = end
            continue
        tag = _TAG.match(html, lt)
        if not tag:
            if follows.isascii() and follows.isalpha() or follows == "/":
                if html.find(">", lt) < 0:
                    break  # the page ends inside a tag
            text("<")
            at = lt + 1
            continue
        at = tag.end()
        ends, name, attributes = tag.groups()
        name = name.lower()
        if not attributes and name not in KNOWN and not (ends and any(o[0] == name for o in open_)):
            continue
        if name == "br":
            text(" ")
            continue
        if name == "a":
            links = 0 if ends else 1
            continue
        if ends:
            if name in BLOCK:
                close()
                links = 0 if name not in ("li", "p") and name not in HEADINGS else links
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    if open_[k][1] or open_[k][3]:
                        close()
                    del open_[k:]
                    break
            continue
        if name in RAW:
            if name in BLOCK:
                close()
            shut = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = shut.end() if shut else n
            continue
        if name in VOID:
            if name == "hr":
                close()
            continue
        block = name in BLOCK
        if block:
            close()
        if name in HEADINGS or name == "p":  # they cannot hold one another
            while open_ and (open_[-1][0] in HEADINGS or open_[-1][0] == "p"):
                open_.pop()
        _, aside, region, unseen, header, _ = open_[-1] if open_ else _NOTHING
        if unseen and name not in ("body", "article", "main"):
            open_.append((name, aside, region, True, header, False))
            continue
        hinted, content = _attributes(attributes) if attributes.strip(" \t\r\n/") else (False, False)
        if name in ("article", "main", "body"):
            if name != "body" and not region:
                stays = ASIDE_OF_ARTICLES if name == "article" else ("aside", "footer")
                aside, header = not release and any(o[5] and o[0] in stays for o in open_), False
            hinted = hinted and name == "article" and not content
            unseen = False
        own = name in ASIDE or name == "form"
        if not block and not hinted and name not in UNSEEN and not content:
            continue  # inline, nothing to remember
        if hinted and not block:
            close()
        if name == "article" or content and block and region == 1:
            region = 2 if name == "article" else region
        elif name == "main" or content and block:
            region = max(region, 1)
        if name == "header" and (not region or "header" not in attributes):
            header, hinted = True, hinted and "header" not in attributes.lower()
        elif hinted and re.search(r"header|masthead", attributes, re.I) and region:
            header, hinted = True, False
        open_.append((name, aside or own or hinted, region, unseen or name in UNSEEN, header, own or hinted))
    close()
    return out


def label(page: list[Block]) -> list[Block]:
    """Both passes: every block becomes good or bad."""
    top = max((b.region for b in page if not b.aside), default=0)
    counts = []
    for b in page:
        found = _LETTERS.findall(b.text.lower())
        counts.append((len(found), sum(map(STOP_WORDS.__contains__, found))))
    known = sum(c[1] for c, b in zip(counts, page, strict=True) if not b.aside) >= STOP_KNOWN * sum(len(b.text) for b in page if not b.aside)
    below = False  # under a heading that opens the readers' comments
    for b, (n, stop) in zip(page, counts, strict=True):
        if b.heading:
            said = _LETTERS.findall(b.text.lower())
            below = len(said) <= 3 and not COMMENT_HEADS.isdisjoint(said) and b.text.lower() != page[0].text.lower()
        size, share = len(b.text), stop / n if n else 0.0
        linked = b.linked > LINKS * max(len(b.text.replace(" ", "")), 1)
        if b.aside or b.region < top or below:
            b.label = "bad"
        elif linked:
            b.label = "links"
        elif top:
            b.label = "good" if size >= LONG else "undecided"
        elif "©" in b.text and size < 3 * LONG:
            b.label = "bad"
        elif size >= LONG and (not known or share >= STOP_HIGH or share >= STOP_LOW and size >= 3 * LONG):
            b.label = "good"
        elif size >= LONG and share < STOP_LOW:
            b.label = "bad"
        else:
            b.label = "undecided"
    mine = [b for b in page if not (b.aside or b.region < top)]
    run = 0
    for k in range(len(mine) + 1):
        if k < len(mine) and mine[k].label == "links":
            run += 1
            continue
        for b in mine[k - run : k]:
            b.label = "bad" if run >= MENU or not top else "undecided"
        run = 0
    decided = [k for k, b in enumerate(mine) if b.label != "undecided"]
    here = 0
    labels = []
    for k, b in enumerate(mine):
        while here < len(decided) and decided[here] < k:
            here += 1
        if b.label != "undecided":
            labels.append(b.label)
            continue
        after = decided[here] if here < len(decided) else None
        before = decided[here - 1] if here else None
        sides = {mine[x].label for x in (before, after) if x is not None}
        if top:  # the edges of an article are good
            labels.append("bad" if sides == {"bad"} and before is not None and after is not None else "good")
        elif len(sides) == 1 and before is not None and after is not None:
            labels.append(sides.pop())
        elif b.heading and after is not None and mine[after].label == "good":
            labels.append("good")
        else:  # sides differ, or one is the edge of the page, which is bad
            to_before, to_after = k - (before if before is not None else -1), (after if after is not None else len(mine)) - k
            near = mine[before].label if before is not None and to_before < to_after else mine[after].label if after is not None and to_after < to_before else "bad"
            labels.append(near)
    for b, found in zip(mine, labels, strict=True):
        b.label = found
    return page


def main_text(html: str | None) -> str:
    for release in (False, True):
        text = " ".join(b.text for b in label(blocks(html or "", release)) if b.label == "good")
        if text:
            break
    return text


def _extract(batches):
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]  # one page at a time
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of pages (page_id, url, html): page_id, url, text, n_chars (code points of text).

    Null and empty html, and pages without main text, have an empty text. White space
    (Unicode's, so also no-break spaces) inside a block becomes one space. Repeated rows
    give a row each; null page_id and url stay. Other columns are not read. A page is
    handled whole in one task, whatever its length; nothing is shuffled.
    """
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def judged_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, at, text, label) of every block: what extracted() takes and leaves, and why it can be audited."""

    def run(batches):
        for batch in batches:
            for page_id, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = html.as_py() or ""
                found = label(blocks(page))
                if all(b.label == "bad" for b in found):
                    found = label(blocks(page, release=True))
                yield pa.RecordBatch.from_arrays([pa.array([page_id] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()), pa.array([b.text for b in found], pa.string()), pa.array([b.label for b in found], pa.string())], ["page_id", "at", "text", "label"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, at int, text string, label string")


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
