"""The main text of web pages by tag-path ratios.

A page is cut into text blocks, each with the path of block elements from the
root. Text length and punctuation are added up over the blocks of a path and
divided by their number; the two ratios are fused on a log scale, smoothed along
the page, and paths above a share of the page's best are content, with what
stands between two of their blocks in one container, and the lists, headings and
paragraphs beside them there. What an
element says about itself enters as a factor of its paths: none for navigation,
notices, adverts, forms and the like, a higher one inside an article. Words in
class, id or role, and forms, exclude nothing that is or has an article or main:
wrappers of whole pages carry such words too. Only where they name comments or
related pages, and there is an article besides, do the articles in them go. Nor
do they exclude what has most of the page's unlinked text, unless that stands
beside an article or main; there the ratios decide. Inside an article a name
counts only if it says nothing else: ``share-row`` does, ``share-price`` does not.

A null html is empty and gives an empty text; so does a page without text of its
own. Broken markup is read as browsers do: elements left open end with their
parent, an open comment or script reaches to the end. Every row gives a row,
repeated ones too. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import pieces

# Element names of HTML.
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea noscript template iframe svg object select button canvas audio video".split())
_NO_CONTENT = frozenset("head title nav footer aside dialog menu search".split())
_ARTICLE = frozenset(("article", "main"))
# An element of these names ends when another of its list begins, unless a new list or table was begun in it.
_LISTS = ((("li",), ("ul", "ol", "menu")), (("dt", "dd"), ("dl",)), (("td", "th"), ("tr", "table")), (("tr",), ("table", "tbody", "thead", "tfoot")))
_SIBLINGS = {name: (names, frozenset(names), frozenset(around)) for names, around in _LISTS for name in names}
# Elements that are parts of the container around them.
_PARTS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup section li ul ol dl dt dd tr td th tbody thead tfoot pre blockquote figure figcaption hr".split())
# Words in class, id or role that name what surrounds an article.
_AROUND_WORDS = (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert "
    "popup modal overlay newsletter subscribe subscription sidebar complementary menu nav navbar navigation breadcrumb breadcrumbs "
    "footer contentinfo masthead topbar comment comments commentlist disqus reply replies respond related recommended share sharing "
    "social widget toolbar pagination pager login signup search skip"
).split()
_AROUND = re.compile(rf"(?<![a-z])(?:{'|'.join(_AROUND_WORDS)})(?![a-z])")
# Words beside them that say nothing of the content.
_NEUTRAL = frozenset(
    "area bar block bottom box button buttons card cards container form group header icons inner item items left link links list "
    "outer posts right row section slot top unit wrap wrapper".split()
)
# Names that begin so are of what readers wrote, or of other pages.
_SECONDARY = re.compile(r"(?:^|\s)(?:comments?|commentlist|disqus|repl(?:y|ies)|respond|related|recommended)(?![a-z])(?!-(?:open|closed|enabled|on|off)\b)")
_HEADER = re.compile(r"(?<![a-z])header(?![a-z])")
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")

ARTICLE_FACTOR = 4.0
THRESHOLD = 0.3
_SMOOTHING = (0.25, 0.5, 0.25)


@dataclass
class Block:
    path: int  # number of its path of block elements
    element: int
    inline: bool  # whether only the border of an inline element parts it from the block before
    containers: tuple[int, ...] = ()  # numbers of the elements it is a part of
    factor: float = 1.0
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class Element:
    """What an element that may change the factor says about itself."""

    above: int
    name: str
    gone: bool = False  # it has no content in any case
    around: bool = False  # its names are of what surrounds an article
    only_around: bool = False  # and say nothing else
    secondary: bool = False  # they are of comments or related pages
    header: bool = False
    unlinked: int = 0
    article: bool = False  # it is or has one
    inner: int = 0  # unlinked text of its outermost articles


def _element(name: str, attributes: str, above: int) -> Element | None:
    """The element, if it may change the factor of the paths through it."""
    out = Element(above, name, gone=name in _NO_CONTENT, around=name == "form", header=name == "header")
    if attributes:
        names = " ".join(m.strip("\"'") for m in _NAMED.findall(attributes)).lower()
        if names and name not in ("html", "body"):
            out.around |= bool(_AROUND.search(names))
            out.only_around = out.around and _says_only(names)
            out.secondary = bool(_SECONDARY.search(names))
            out.header |= bool(_HEADER.search(names))
        out.gone |= bool(_HIDDEN.search(attributes))
    return out if out.gone or out.around or out.header or name in _ARTICLE else None


def _says_only(names: str) -> bool:
    """Whether some name is made of nothing but words of what surrounds an article, and neutral ones."""
    for name in names.split():
        words = [w for w in re.split("[^a-z]+", name) if w]
        if any(w in _AROUND_WORDS for w in words) and all(w in _AROUND_WORDS or w in _NEUTRAL for w in words):
            return True
    return False


def _factors(elements: list[Element], page: list[Block]) -> list[float]:
    """Each element's factor for the paths through it: 0 once anything above has none."""
    for block in page:
        elements[block.element].unlinked += max(0, len(block.text) - block.linked)
    for e in elements[:0:-1]:  # elements come before what they have
        if not e.gone:
            above = elements[e.above]
            above.unlinked += e.unlinked
            above.article |= e.article or e.name in _ARTICLE
            above.inner += e.unlinked if e.name in _ARTICLE else e.inner
    # The articles with text of their own, and how many of them each element is in.
    live = [e.name in _ARTICLE and e.unlinked > 0 for e in elements]
    inside, lost = [0], [False]
    for e, own in zip(elements[1:], live[1:], strict=True):
        lost.append(lost[e.above] or e.gone)
        inside.append(inside[e.above] + (own and not lost[-1]))
    n_articles = sum(own and not off for own, off in zip(live, lost, strict=True))
    in_articles = elements[0].inner
    out = [1.0]
    for i, e in enumerate(elements[1:], 1):
        above = out[e.above]
        if not above or e.gone or (e.name == "header" and above < ARTICLE_FACTOR):
            out.append(0.0)
            continue
        # The text of articles that is not in this element; of one around it, more than a heading.
        beside = in_articles - (e.unlinked if inside[e.above] else e.inner if e.name not in _ARTICLE else e.unlinked)
        if e.secondary and (e.article or e.name in _ARTICLE) and beside > (0.05 * e.unlinked if inside[e.above] else 0):
            out.append(0.0)
        elif e.secondary and e.article and not inside[e.above] and 4 * (elements[0].unlinked - e.unlinked) > e.unlinked:
            out.append(0.0)  # the page has its text elsewhere, in no article
        elif e.name in _ARTICLE:
            out.append(ARTICLE_FACTOR)
        else:
            named = e.only_around if above == ARTICLE_FACTOR and e.name != "form" else e.around
            named |= e.header and above < ARTICLE_FACTOR
            most = 2 * e.unlinked > elements[0].unlinked and inside[i] == n_articles
            out.append(0.0 if named and not e.article and not most else above)
    return out


def _raw_end(html: str, lower: str, name: str, at: int) -> int:
    """Where an element without text of its own ends, from behind its start tag."""
    end = lower.find(f"</{name}", at)
    if end < 0:
        return len(html)
    close = html.find(">", end)
    return len(html) if close < 0 else close + 1


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in order; a block has the text between two borders of block elements."""
    lower = html.lower() if len(html.lower()) == len(html) else html
    stack: list[tuple[str, int, int, tuple[int, ...]]] = []
    paths: dict[tuple[int, str], int] = {}
    numbers = count(1)
    elements = [Element(0, "")]
    open_: Counter[str] = Counter()
    out: list[Block] = []
    now: Block | None = None
    inline = False

    def add(text: str) -> None:
        nonlocal now
        if now is None:
            if not inline and not text.strip():
                return
            _, path, element, containers = stack[-1] if stack else ("", 0, 0, (0,))
            out.append(now := Block(path, element, inline, containers))
        now.parts.append(text)
        if open_["a"]:
            now.linked += len(text)

    def border(name: str) -> None:
        nonlocal now, inline
        inline = name not in _BLOCK and (inline or now is not None)
        now = None

    def leave(name: str) -> None:
        while stack:
            top = stack.pop()
            open_[top[0]] -= 1
            if top[0] in _BLOCK or top[2] != (stack[-1][2] if stack else 0):
                border(top[0])
            if top[0] == name:
                return

    at, size = 0, len(html)
    while at < size:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        if start > at:
            add(html[at:start])
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            at = size if end < 0 else end + 1
            continue
        tag = _TAG.match(html, start)
        if tag is None:
            after = html[start + 1 : start + 3].lstrip("/")[:1]
            end = html.find(">", start) if after.isalpha() else -1
            if end < 0:  # a sign of its own
                add("<")
                at = start + 1
            else:
                at = end + 1
            continue
        at = tag.end()
        name, attributes = tag[1].lower(), tag[2]
        if html[start + 1] == "/":
            if name == "br" or name == "p" and not open_["p"]:
                add(" ")
            elif open_[name]:
                leave(name)
            continue
        if name in _RAW and not attributes.endswith("/"):
            at = _raw_end(html, lower, name, at)
            continue
        if name == "br":
            add(" ")
            continue
        if name in _VOID:
            if name == "hr":
                border(name)
            continue
        if name in _BLOCK:
            border(name)
            if open_["p"]:
                leave("p")
            if name in _SIBLINGS:
                ordered, siblings, around = _SIBLINGS[name]
                if any(open_[sibling] for sibling in ordered):
                    nearest = next(e[0] for e in reversed(stack) if e[0] in siblings or e[0] in around)
                    if nearest in siblings:
                        leave(nearest)
        elif attributes.endswith("/"):
            continue
        _, path, at_element, containers = stack[-1] if stack else ("", 0, 0, (0,))
        if found := _element(name, attributes, at_element):
            at_element = len(elements)
            elements.append(found)
            if name not in _BLOCK:
                border(name)
        if name in _PARTS:
            containers = containers[:1]
        elif name in _BLOCK:  # its own text may be one part among others of the element around it
            containers = (next(numbers), containers[0])
        if name in _BLOCK:
            path = paths.setdefault((path, name), len(paths) + 1)
        stack.append((name, path, at_element, containers))
        open_[name] += 1
    for block in out:
        block.text = _plain(block.parts)
    factor = _factors(elements, out)
    joined: list[Block] = []
    for block in out:
        block.factor = factor[block.element]
        if block.inline and joined and joined[-1].factor == block.factor and joined[-1].path == block.path:
            joined[-1].parts += block.parts
            joined[-1].linked += block.linked
            joined[-1].text = _plain(joined[-1].parts)
        else:
            joined.append(block)
    return [block for block in joined if block.text]


def _plain(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


def scores(page: list[Block]) -> list[float]:
    """The smoothed and fused ratio of each block's path; 0 for what an element excludes."""
    length, signs, number = Counter(), Counter(), Counter()
    for b in page:
        key = (b.path, b.factor)
        length[key] += max(0, len(b.text) - b.linked)
        signs[key] += len(_PUNCTUATION.findall(b.text))
        number[key] += 1
    fused = [
        b.factor * math.log1p(length[key] / number[key]) * (1 + math.log1p(signs[key] / number[key]))
        for b in page
        for key in [(b.path, b.factor)]
    ]
    out = []
    for i, b in enumerate(page):
        if not b.factor or (not length[(b.path, b.factor)] and b.factor < ARTICLE_FACTOR):
            out.append(0.0)
            continue
        # Only neighbours that may be content themselves count.
        near = [(w, fused[j]) for w, j in zip(_SMOOTHING, (i - 1, i, i + 1), strict=True) if 0 <= j < len(page) and page[j].factor == b.factor]
        out.append(max(fused[i], sum(w * x for w, x in near) / sum(w for w, _ in near)))
    return out


def main_text(html: str, threshold: float = THRESHOLD) -> str:
    """The content blocks, one a line."""
    page = blocks(html)
    score = scores(page)
    least = threshold * max(score, default=0.0)
    content = [s > 0 and s >= least for s in score]
    # So does what stands between content in one container.
    last = {c: i for i, b in enumerate(page) if content[i] for c in b.containers}
    until = -1
    for i, b in enumerate(page):
        if content[i]:
            until = max(until, *(last[c] for c in b.containers))
        elif i < until and b.factor:
            content[i] = True
    # And the parts beside content in the container they are directly in, unless they are links.
    holding = {b.containers[0] for b, c in zip(page, content, strict=True) if c}
    for i, b in enumerate(page):
        if b.factor and len(b.containers) == 1 and b.containers[0] in holding and 2 * b.linked < len(b.text):
            content[i] = True
    # What stands between or beside content in one article belongs to it, however short; what is excluded parts nothing.
    inner = [i for i, b in enumerate(page) if b.factor]
    for order in (inner, inner[::-1]):
        for j, i in zip(order, order[1:]):
            content[i] |= content[j] and page[i].factor == page[j].factor == ARTICLE_FACTOR
    return "\n".join(b.text for b, c in zip(page, content, strict=True) if c)


def extract(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2):
            texts = [main_text(h or "", threshold) for h in batch.column(2).to_pylist()]
            yield pa.record_batch(
                {
                    "page_id": batch.column(0),
                    "url": batch.column(1),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    return pages.selectExpr("CAST(page_id AS LONG) page_id", "url", "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )
