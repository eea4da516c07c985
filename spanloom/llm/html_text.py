"""Main text of web pages by tag-path ratios.

A page is read into text blocks, each with the path of block tags from the root. Per path, text length,
punctuation and link text are added up and divided by the path's blocks; the two ratios are smoothed over neighbouring blocks in
page order, fused, and weighed by what the path's names say (navigation, notices, adverts, comments, ...). Paths above a share of the
text-weighted mean are content. The element that holds the content is the article, and its blocks are the text, so that a short
paragraph or heading inside it is not lost. Tags such as nav, hidden elements and whole names (class, id or role is just the word) exclude what they hold;
a word that is a part of a name only lowers the score of its path. Where the content's holder is the whole body, paths of mostly link text
(<a href>, until its block ends) are left out too, but no headings.

Pages are independent, so nothing is shuffled, and the time for a page grows in proportion to its length at any depth of nesting. Defined cases: a null, empty or contentless page has an empty
text; repeated pages give repeated rows; further columns are ignored. Unclosed and misnested tags are read as browsers do
in the common cases (a block tag ends an open paragraph; end tags close what is open inside them; stray ones are skipped).
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from math import exp

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches

#: Fixed HTML names.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MATHML = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd semantics".split())
INLINE |= MATHML
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("dialog form head iframe input menu nav aside footer noframes noscript optgroup option template textarea title".split())
#: Elements inside a line of text whose content goes, without ending the line.
SKIPPED_INLINE = frozenset("annotation annotation-xml audio button canvas datalist meter object progress select svg video".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template")
ENDS_PARAGRAPH = frozenset("address article aside blockquote body center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: What a start tag closes, if open, up to the named container.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Words in class, id and role that name something other than an article.
NOT_CONTENT = frozenset(
    "ad ads adv advert adverts advertisement advertising alert aside author-bio banner billboard breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer form gdpr header hidden hero-ad login masthead menu menubar modal nav navbar navigation navigation-menu newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended related replies reply respond rss search share sharing sidebar signup skip social sponsor sponsored subscribe tags teaser teasers toolbar topbar widget widgets complementary contentinfo dialog".split()
)

#: Whole names of more than one word.
NOT_CONTENT |= {f"{a}{sep}{b}" for a, bs in (("cookie", "notice banner bar consent"), ("related", "posts articles"), ("share", "buttons bar"), ("social", "share links"), ("comment", "list form"), ("site", "header footer"), ("page", "header footer"), ("nav", "menu bar")) for b in bs.split() for sep in "-_"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_NAME = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|itemprop|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
_EITHER = {t: re.compile(rf"<(/?){t}(?=[\s/>])([^>]*)>", re.I) for t in SKIPPED_INLINE}
CELLS = ("td", "th", "table")
_NEXT_A = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")

SMOOTH = [exp(-k * k / 2) for k in range(-2, 3)]
SHARE, LINKED = 0.3, 0.6
#: A link whose end is further away than this ends with its block.
LINK_CHARS = 10_000
LOWERED = 0.1  # of the score, where a part of a name is in NOT_CONTENT


class _Node:
    """An open element. `number` counts elements in page order, so a parent's is smaller; equal root-to-node tag paths share a `path`."""

    __slots__ = ("tag", "number", "parent", "path", "out", "semantic", "weak")

    def __init__(self, tag: str, rest: str, parent: _Node | None, number: int, paths: dict[tuple[int, str], int]):
        names: list[str] = []
        hidden = False
        semantic = tag in ("article", "main")
        for name, value in _NAME.findall(rest) if rest else ():
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role"):
                names += value.split()
                semantic |= value.lower() == "main"
            elif name == "itemprop":
                semantic |= value == "articleBody"
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "").lower()
            else:
                hidden |= name == "hidden" or value.lower() == "true"
        self.tag, self.number, self.parent = tag, number, parent
        key = f"{tag}.{'.'.join(names)}" if names else tag
        self.path = paths.setdefault((parent.path if parent else 0, key), len(paths) + 1)
        out = hidden or tag in SKIPPED or (tag == "header" and not (parent and parent.semantic))
        weak = False
        if tag not in ("html", "body", "main"):
            out |= any(n.lower() in NOT_CONTENT for n in names)
            weak = tag != "article" and any(w.lower() in NOT_CONTENT for n in names for w in _PART.findall(n))
        self.weak = weak or bool(parent and parent.weak)
        self.semantic = (semantic and not out) or bool(parent and parent.semantic and tag == "header")
        self.out = out or bool(parent and parent.out)


class Block:
    __slots__ = ("node", "text", "links", "path", "out", "weak")

    def __init__(self, node: _Node | None, text: str, links: int):
        self.node, self.text, self.links = node, text, links
        self.path = node.path if node else 0
        self.out = bool(node and node.out)
        self.weak = bool(node and node.weak)


class _Open:
    """The stack of open elements, with the places of each tag."""

    def __init__(self):
        self.nodes: list[_Node] = []
        self.every: list[_Node] = []
        self.paths: dict[tuple[int, str], int] = {}
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, rest: str) -> None:
        node = _Node(tag, rest, self.nodes[-1] if self.nodes else None, len(self.every), self.paths)
        self.every.append(node)
        self.places.setdefault(tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, index: int) -> None:
        for node in self.nodes[index:]:
            self.places[node.tag].pop()
        del self.nodes[index:]

    def last(self, *tags: str) -> int:
        """The highest place of any of the tags, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def first_above(self, place: int, tags) -> int:
        """The lowest place above `place` of any of the tags, or -1."""
        found = [own[k] for t in tags if (own := self.places.get(t)) and (k := bisect_right(own, place)) < len(own)]
        return min(found, default=-1)


def _inline_end(page: str, tag: str, at: int, open_ended: set[str]) -> int:
    """Where an element inside a line ends; right here if it has no end tag."""
    if tag in open_ended:
        return at
    depth = 1
    for m in _EITHER[tag].finditer(page, at):
        depth += -1 if m[1] else 0 if m[2].rstrip().endswith("/") else 1
        if not depth:
            return m.end()
    open_ended.add(tag)
    return at


def blocks(page: str) -> tuple[list[Block], list[_Node]]:
    """The page's text blocks in order, white space already single, and all its block elements."""
    found: list[Block] = []
    stack = _Open()
    nodes = stack.nodes
    parts: list[str] = []
    linked: list[str] = []
    open_ended: set[str] = set()
    in_link, link_depth = 0, 0  # 1: in a link; 2: in one without an end, which its block ends. The stack's size where it began
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal in_link
        if in_link == 2:
            in_link = 0
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(nodes[-1] if nodes else None, text, len(" ".join("".join(linked).split()))))
            parts.clear()
            linked.clear()

    def close(index: int) -> None:
        nonlocal in_link
        flush()
        if index < link_depth:
            in_link = 0
        stack.cut(index)

    while at < n:
        m = _TOKEN.match(page, at)
        if m is None:  # a tag that never ends
            parts.append(html.unescape(page[at:]))
            break
        at = m.end()
        if (text := m["text"]) is not None:
            text = html.unescape(text)
            parts.append(text)
            if in_link:
                linked.append(text)
            continue
        if m["tag"] is None:
            continue
        tag, rest = m["tag"].lower(), m["rest"] or ""
        if m["end"]:
            if tag == "a":
                in_link = 0
            if tag in INLINE or tag in SKIPPED_INLINE:
                continue
            if tag == "br":
                parts.append(" ")
                continue
            place = stack.last(tag)
            if place >= 0 and not (tag in ("p", "div", "li") and stack.last(*CELLS) > place):
                close(place)
            continue
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else n
            continue
        if tag in SKIPPED_INLINE:
            if not rest.rstrip().endswith("/"):
                at = _inline_end(page, tag, at, open_ended)
            continue
        if tag in INLINE:
            if tag == "a":
                in_link, link_depth = 0, len(nodes)
                if _HREF.search(rest):
                    in_link = 1 if _link_ends(page, at) else 2
            continue
        if tag in VOID:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                if nodes and nodes[-1].tag == "p":
                    close(len(nodes) - 1)
                flush()
            continue
        if tag in ("html", "body") and stack.last(tag) >= 0:
            continue
        flush()
        if tag in ENDS_PARAGRAPH:
            place = stack.last("p")
            if place > stack.last(*CELLS):
                close(place)
            if tag in HEADINGS and nodes and nodes[-1].tag in HEADINGS:
                close(len(nodes) - 1)
        if tag in CLOSES:
            closed, until = CLOSES[tag]
            bound = stack.last(*until)
            place = stack.first_above(bound, closed) if tag == "tr" else stack.last(*closed)
            if place > bound:
                close(place)
        if tag == "body" and nodes and nodes[-1].tag == "head":
            close(len(nodes) - 1)
        stack.push(tag, rest)
    flush()
    return found, stack.every


def _link_ends(page: str, at: int) -> bool:
    """Whether the next tag of a link is its end."""
    end = _NEXT_A.search(page, at, at + LINK_CHARS)
    return bool(end and end[1])


def path_scores(found: list[Block]) -> tuple[list[float], dict[int, list[float]]]:
    """Each block's fused score, and per path: blocks, text length, punctuation, link text."""
    paths: dict[int, list[float]] = {}
    for b in found:
        p = paths.setdefault(b.path, [0, 0, 0, 0])
        p[0] += 1
        p[1] += len(b.text)
        p[2] += len(_PUNCTUATION.findall(b.text))
        p[3] += b.links
    text = [paths[b.path][1] / paths[b.path][0] for b in found]
    marks = [paths[b.path][2] / paths[b.path][0] for b in found]

    def smooth(x: list[float]) -> list[float]:
        out = []
        for i in range(len(x)):
            near = [(w, x[i + k]) for k, w in zip(range(-2, 3), SMOOTH, strict=True) if 0 <= i + k < len(x) and not found[i + k].out]
            out.append(sum(w * v for w, v in near) / sum(w for w, _ in near) if near else 0.0)
        return out

    fair = sum(len(b.text) for b in found if not b.out)
    lowered = sum(len(b.text) for b in found if not b.out and b.weak)
    low = LOWERED if 2 * lowered < fair else 1.0  # names that most of the text has say nothing
    fused = []
    for b, t, p in zip(found, smooth(text), smooth(marks), strict=True):
        length, links = paths[b.path][1], paths[b.path][3]
        fused.append(0.0 if b.out else t * (1 + p) * (1 - min(1.0, links / length)) * (low if b.weak else 1.0))
    return fused, paths


def main_text(page: str | None) -> str:
    found, nodes = blocks(page or "")
    if not found:
        return ""
    scores, paths = path_scores(found)
    weight = sum(len(b.text) for b, s in zip(found, scores, strict=True) if s > 0)
    if not weight:
        return ""
    mean = sum(s * len(b.text) for b, s in zip(found, scores, strict=True)) / weight
    content = {b.path for b, s in zip(found, scores, strict=True) if s >= SHARE * mean and s > 0}
    held = [0] * len(nodes)  # content text below each element
    depth = [0] * len(nodes)
    total = 0
    for b, s in zip(found, scores, strict=True):
        if s >= SHARE * mean and s > 0:
            total += len(b.text)
            if b.node:
                held[b.node.number] += len(b.text)
    for node in reversed(nodes):
        if node.parent:
            held[node.parent.number] += held[node.number]
    for node in nodes:
        depth[node.number] = depth[node.parent.number] + 1 if node.parent else 0
    named = [x for x in nodes if x.semantic and x.tag != "header" and held[x.number] and 2 * held[x.number] >= total]
    if named:
        most = max(held[x.number] for x in named)
        holder = max((x for x in named if held[x.number] >= 0.95 * most), key=lambda x: (depth[x.number], -x.number))
    else:
        holder = max((x for x in nodes if held[x.number] == total), key=lambda x: depth[x.number], default=None)
    inside = [False] * len(nodes)
    for node in nodes:
        inside[node.number] = node is holder or bool(node.parent and inside[node.parent.number])
    article = holder is not None and holder.tag not in ("html", "body")
    out = []
    for b in found:
        heading = bool(b.node) and b.node.tag in HEADINGS
        if b.out or (holder is not None and not (b.node and inside[b.node.number])):
            continue
        if article or heading or b.path in content or paths[b.path][3] <= LINKED * paths[b.path][1]:
            out.append(b.text)
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text and its length in code points."""
    bound_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")
