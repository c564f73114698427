"""The main text of web pages, by scores on the tree of the page.

A page is read into a tree with the end tags that HTML lets authors leave out. Furniture goes first:
elements that are never text, and those whose role, class or id calls them a menu, header, footer, sidebar,
notice, advert, form or reader comment. Each paragraph left passes points for its length and commas to the
elements around it, fewer the farther they are; an element's points are discounted by the share of its
text that is links. The element with most points is the article's, or the `article` element it is in;
siblings that read like parts of the article are kept with it. Pages do not depend on each other, so this
runs in Arrow batches without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# The kinds of HTML elements.
INLINE = frozenset((
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr").split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
NO_TEXT = RAW | frozenset((
    "aside audio button canvas datalist dialog footer form head header menu nav noscript object select svg template video").split())
PARAGRAPHS = frozenset("address blockquote caption dd dt figcaption li p pre summary td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_P = HEADINGS | frozenset((
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form header hgroup hr li "
    "main menu nav ol p pre search section summary table ul").split())
# What a start tag ends where it is still open, and the elements that this does not look beyond.
ENDED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"}),
}
CELLS = {"td", "th", "caption", "table"}

# Words of a class, an id or a role that name what is not the article.
FURNITURE = frozenset((
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline comment commentlist comments "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus footer form gdpr header hidden "
    "legal login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "paywall popular popup promo promoted promotion recommended related replies reply respond responses search share sharing sidebar "
    "signup skip social sponsor sponsored subscribe subscription tags teaser toast toolbar topbar trending widget widgets").split())
# After these words, another says what the page has, not what the element is.
ABOUT = frozenset("has is js no not with without".split())

TAG = re.compile(r"""<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)(?:["'][^>]*+)?(?:>|\Z)""", re.S)
NAMED = re.compile(r"""(?:^|[\s/"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
COMMAS = re.compile("[,،、，]")
BONUS = {"article": 25.0, "main": 10.0, "blockquote": -3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "td": 3.0, "pre": 3.0}
REACH = 6  # ancestors that a paragraph's points reach
SIBLING_SHARE = 0.2
MENU_LINKS, MENU_DENSITY = 3, 0.8


class Element:
    __slots__ = ("tag", "parent", "around", "parts", "named", "score", "chars", "linked", "links", "holds")

    def __init__(self, tag: str, parent: Element | None, named: bool = False):
        self.tag, self.parent, self.named = tag, parent, named
        # The nearest element around it that is not inline.
        self.around = parent if parent is None or parent.tag not in INLINE else parent.around
        self.parts: list[Element | str] = []
        self.score, self.chars, self.linked, self.links, self.holds = 0.0, 0, 0, 0, set()

    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0


def furniture(attributes: str) -> bool:
    """Whether the attributes call the element something that is not the article."""
    for name, *values in NAMED.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id", "role"):
            for one in value.split():
                words = [w.lower() for w in WORD.findall(one)]
                if not ABOUT.intersection(words) and FURNITURE.intersection(words):
                    return True
    return False


def tree(html: str) -> list[Element]:
    """The elements of a page in page order, the root first."""
    root = Element("html", None)
    found, stack, open_now = [root], [root], Counter()
    at = 0

    def text(upto: int) -> None:
        if upto > at:
            stack[-1].parts.append(unescape(html[at:upto]))

    def end(tags: set[str], beyond: set[str]) -> None:
        """Ends the innermost open element of these, unless one of `beyond` is met first."""
        if not any(open_now[t] for t in tags):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in tags:
                for gone in stack[k:]:
                    open_now[gone.tag] -= 1
                del stack[k:]
                return
            if stack[k].tag in beyond:
                return

    while match := TAG.search(html, at):
        text(match.start())
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag or tag in ("html", "body"):
            continue
        if match[1]:
            if tag not in VOID:
                if not open_now[tag]:
                    continue
                if tag in INLINE:  # an inline end tag does not end the blocks inside it
                    k = len(stack) - 1
                    while stack[k].tag != tag and stack[k].tag in INLINE:
                        k -= 1
                    if stack[k].tag == tag:
                        end({tag}, set())
                else:
                    end({tag}, set() if tag in CELLS or tag in ("tr", "tbody", "thead", "tfoot") else {"td", "th", "caption"} - {tag})
            continue
        if tag in ENDS_P:
            end({"p"}, CELLS | {"button", "object"})
            if tag in HEADINGS and stack[-1].tag in HEADINGS:
                end({stack[-1].tag}, set())
        if tag in ENDED:
            end(*ENDED[tag])
        new = Element(tag, stack[-1], furniture(match[3]))
        found.append(new)
        stack[-1].parts.append(new)
        if tag in RAW:
            closed = RAW_END[tag].search(html, at)
            at = closed.start() if closed else len(html)
        if tag not in VOID:
            stack.append(new)
            open_now[tag] += 1
    text(len(html))
    return found


def prune(found: list[Element]) -> list[Element]:
    """Without furniture, and without lists that are menus; text, links and what is inside are summed up."""
    for e in reversed(found):
        for part in e.parts:
            if isinstance(part, str):
                e.chars += len("".join(part.split()))
            else:
                e.chars, e.linked, e.links = e.chars + part.chars, e.linked + part.linked, e.links + part.links
                e.holds |= part.holds
        if e.tag in ("article", "main", "h1"):
            e.holds = e.holds | {e.tag}
        if e.tag == "a":
            e.linked, e.links = e.chars, e.links + 1
        inner = e.holds - {e.tag}
        if e.tag in ("br", "hr"):
            continue
        gone = e.parent is not None and (
            e.tag in NO_TEXT and not (e.tag == "form" and inner)
            or e.named and not inner & {"article", "main"}
            or e.tag in ("ul", "ol", "dl", "table", "div", "section") and e.links >= MENU_LINKS and e.density() >= MENU_DENSITY and not inner)
        if gone:
            e.chars = e.linked = e.links = 0
            e.holds, e.parts, e.tag = set(), [], "gone"
    left, kept = {id(found[0])}, [found[0]]
    for e in found[1:]:
        if e.tag != "gone" and id(e.parent) in left and e.parent.tag != "gone":
            left.add(id(e))
            kept.append(e)
    return kept


def inline_text(e: Element) -> str:
    """What an element says outside of blocks inside it."""
    out, todo = [], list(reversed(e.parts))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.tag in INLINE:
            todo.extend(reversed(part.parts))
        else:
            out.append(" ")
    return " ".join("".join(out).split())


def score(kept: list[Element]) -> None:
    for e in kept:
        if e.tag in INLINE or e.tag in HEADINGS or e.tag == "gone":
            continue
        text = inline_text(e)
        if not text:
            continue
        points = 1 + len(COMMAS.findall(text)) + len(text) / 100
        up = e.around if e.tag in PARAGRAPHS and e.around is not None else e
        for level in range(1, REACH + 1):
            if up is not None:
                up.score += points / level
                up = up.around
    for e in kept:
        if e.score:
            e.score = (e.score + BONUS.get(e.tag, 0.0)) * (1 - e.density())


def chosen(kept: list[Element]) -> list[Element]:
    """The best container and the siblings that go with it, in page order."""
    scored = [e for e in kept if e.score > 0]
    if not scored:
        return [kept[0]]
    best = max(scored, key=lambda e: e.score)
    up = best
    while up is not None:
        if up.tag == "article":
            best = up
            break
        up = up.parent
    if best.parent is None:
        return [best]
    out, heading = [], []
    for e in best.parent.parts:
        if e is best:
            out += heading + [e]
        if isinstance(e, str) or e is best or e.tag == "gone":
            continue
        whole = e.score >= SIBLING_SHARE * best.score and e.density() < 0.5 and e.tag not in INLINE
        if best.tag != "article" and not whole and e.tag in PARAGRAPHS | {"ul", "ol", "dl", "table", "figure"}:
            text = inline_text(e)
            whole = e.density() < 0.25 and (e.chars > 80 or text.endswith((".", "!", "?", "…", "。")))
        if e.tag in HEADINGS and not out:
            heading.append(e)
        elif whole:
            out += heading + [e]
            heading = []
    return out


def blocks(roots: list[Element]) -> Iterator[str]:
    """The texts of the blocks, in page order, their white space made single."""
    run: list[str] = []
    todo: list[Element | str | None] = [x for e in reversed(roots) for x in (None, e, None)]
    while todo:
        part = todo.pop()
        if part is None:
            if run:
                if text := " ".join("".join(run).split()):
                    yield text
                run.clear()
        elif isinstance(part, str):
            run.append(part)
        elif part.tag == "br":
            run.append(" ")
        elif part.tag in INLINE:
            todo.extend(reversed(part.parts))
        else:
            todo += [None, *reversed(part.parts), None]


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by spaces; empty where the page has none."""
    if not html:
        return ""
    kept = prune(tree(html))
    score(kept)
    return " ".join(blocks(chosen(kept)))


@pandas_udf(T.StringType())
def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pages.map(main_text, na_action=None).astype(object)


def extract(df: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """The rows of `df` with the page's main text as a further column, in place of one so named.

    Null, empty and text-free pages have an empty text. The whole page is read and the whole article returned,
    however long; repeated rows each get theirs, and of elements with equal points the first is taken. White space
    within a block becomes one space. All other columns stay as they are. An empty table stays empty.
    """
    return df.withColumn(name, extracted(F.col(f"`{html_col}`")))


def extraction_report(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text and n_chars (code points of the text) of each row."""
    done = extract(df.select(F.col(id_col), F.col(url_col), F.col(html_col).alias("html")), "html")
    return done.select(id_col, url_col, "text", F.length("text").cast("long").alias("n_chars"))
