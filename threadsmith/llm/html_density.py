"""Main text of an HTML page by composite text density.

Every DOM node gets a density: its characters per tag, weakened by the share of characters and
tags that belong to links.  The node whose children have the largest density sum heads the main
text; menus, adverts, comments and the like can neither head nor join it.  If the head lies in an
``article`` or ``main``, that whole subtree is the main text; otherwise it is the head's subtree and
every other subtree beside the path from it to ``body``, however short, without blocks made mostly of links and those
with many links that stay below the path's least density, the threshold.  A class, id or role makes a node noise only
if all its words name such a part and the node does not wrap the page's body text.  The text is returned in page
order, one line a block."""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadsmith.llm.common import map_batches, text_or_empty

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
p pre section summary table tbody td tfoot th thead title tr ul""".split())
#: elements that are never part of an article
NOISE_TAGS = frozenset("""script style noscript template head title nav header footer aside form button select textarea
input iframe object svg canvas menu dialog audio video""".split())
#: elements whose text no reader sees; they have no density
UNSEEN = frozenset("script style noscript template head title svg".split())
#: what an open head holds; anything else ends it
HEAD_CONTENT = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: words of class, id and role that mark the same parts when they are built of div and section
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner
sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments commentlist
respond disqus cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe
subscription signup login share sharing social related recommended recommendations widget toolbar pager pagination
skip search complementary contentinfo""".split())
#: blocks that hold others; within what is kept, those made mostly of links are menus
GROUPS = frozenset("center div dl fieldset figure menu ol section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: what an open p (or the like) ends at
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}
#: those that name a part by its content; wrappers of whole pages rather carry the others (no-sidebar, has-banner)
PART_WORDS = frozenset("""comment comments commentlist respond disqus cookie cookies consent gdpr newsletter subscribe
subscription signup login popup modal overlay related recommended recommendations sponsored""".split())
#: words that may stand beside a noise word in one name (site-header, left_nav); any other makes it a name of its own
PLACE_WORDS = frozenset("""site page main global content wrap wrapper container box block area section inner outer top bottom
left right bar list links link buttons button icons panel region module holder row col column primary secondary tertiary
mobile desktop sticky fixed form js post posts article blog item items title text message thread body meta group""".split())
_WORDS = re.compile(r"[a-z]+")


def is_noise(tag: str, attrs: list) -> bool:
    if tag in NOISE_TAGS:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return any(name == "hidden" or (name == "aria-hidden" and value == "true") for name, value in attrs)


def noise_words(attrs: list) -> set[str]:
    """Noise words of the names in class, id and role that consist of such words and of ``PLACE_WORDS``."""
    words: set[str] = set()
    for name, value in attrs:
        if name in ("class", "id", "role") and value:
            for token in value.lower().split():
                parts = set(_WORDS.findall(token))
                if parts <= NOISE_WORDS | PLACE_WORDS:
                    words |= parts & NOISE_WORDS
    return words


class Dom(HTMLParser):
    """Flat DOM: ``tag``/``parent``/``noise`` by node number (parents come first), the noise ``words`` of nodes
    that have any, and the texts and block edges in page order as (node, text or None)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.noise = ["#root"], [-1], [False]
        self.words: dict[int, set[str]] = {}
        self.items: list[tuple[int, str | None]] = []
        self.open = [0]
        self.count: dict[str, int] = {}
        self.has_body = False

    def _pop(self) -> None:
        node = self.open.pop()
        self.count[self.tag[node]] -= 1
        if self.tag[node] in BLOCKS:
            self.items.append((node, None))

    def _close_up_to(self, names: set[str], scope: set[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in names:
                while len(self.open) > depth:
                    self._pop()
                return
            if tag in scope:
                return

    def _close_head(self, tag: str) -> None:
        """End an omitted </head> before a tag (or text, the empty tag) that no head holds; body ends whatever is
        open in or before it."""
        if tag == "body" and not self.has_body:
            self.has_body = True
            while len(self.open) > 1 and self.tag[self.open[-1]] != "html":
                self._pop()
        elif self.count.get("head") and self.tag[self.open[-1]] == "head" and tag not in HEAD_CONTENT:
            self._pop()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...``: a bogus comment up to the next ``>``, whatever it holds; -1 if there is none."""
        return self.rawdata.find(">", i + 3) + 1 or -1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._close_head(tag)
        if tag in CLOSES and any(self.count.get(t) for t in CLOSES[tag]):
            self._close_up_to(CLOSES[tag], SCOPES[tag])
        if tag in BLOCKS and self.count.get("p"):
            self._close_up_to({"p"}, {"td", "th", "button", "object"})
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self.open[-1])
        own_header = tag == "header" and self.count.get("article")  # an article's own has its title
        self.noise.append(self.noise[self.open[-1]] or (is_noise(tag, attrs) and not own_header))
        if not self.noise[node] and tag not in HEADINGS and (words := noise_words(attrs)):
            self.words[node] = words
        if tag in BLOCKS:
            self.items.append((node, None))
        elif tag == "br":
            self.items.append((node, " "))
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.count.get(tag):
            while True:
                last = self.tag[self.open[-1]]
                self._pop()
                if last == tag:
                    break

    def handle_data(self, data: str) -> None:
        if self.count.get("head") and data.strip():
            self._close_head("")
        self.items.append((self.open[-1], data))


def mark_worded(dom: Dom) -> None:
    """Mark the nodes whose words name noise, with all below them, unless they wrap the page's body text.

    A wrapper holds ``main``; or the article of most text, and more text than is unmarked beside it; or more than
    half of the body's text, with an ``h1`` or ten times the unmarked text.  Text is counted without links and
    without untitled parts of ``PART_WORDS``; such a part wraps only pages that have no ``h1`` and hardly any other text."""
    n = len(dom.tag)
    marked = [i in dom.words and dom.tag[i] not in ("html", "body", "article", "main") for i in range(n)]
    if not any(marked):
        return
    link, own, last = [False] * n, [0] * n, list(range(n))
    for i in range(1, n):
        link[i] = link[dom.parent[i]] or dom.tag[i] == "a"
    for node, text in dom.items:
        if text and not link[node] and not dom.noise[node]:
            own[node] += len("".join(text.split()))
    chars, plain, core, titled = own[:], own[:], own[:], [tag == "h1" for tag in dom.tag]
    part = [marked[i] and not PART_WORDS.isdisjoint(dom.words[i]) for i in range(n)]
    for i in range(n - 1, 0, -1):
        up = dom.parent[i]
        last[up] = max(last[up], last[i])
        titled[up] |= titled[i] and not dom.noise[i]
        if titled[i] or not part[i]:
            chars[up] += chars[i]
        if not marked[i]:
            plain[up] += plain[i]
            if dom.tag[i] not in ("article", "main"):
                core[up] += core[i]
    articles = [i for i in range(n) if dom.tag[i] == "article" and not dom.noise[i]
                and PART_WORDS.isdisjoint(dom.words.get(i, ()))]
    article = max(articles, key=lambda i: (core[i], -i), default=-1)
    mains = [i for i in range(n) if dom.tag[i] == "main" and not dom.noise[i]]
    body = next((i for i in range(n) if dom.tag[i] == "body"), 0)
    seen = plain[body]
    for i in range(body + 1, last[body] + 1):
        if dom.noise[dom.parent[i]]:
            dom.noise[i] = True
        elif marked[i] and not dom.noise[i]:
            if part[i] and not titled[i]:
                wraps = not titled[body] and chars[body] * 10 < chars[i]
            else:
                wraps = chars[i] * 2 > chars[body] and (titled[i] or seen * 10 < chars[i])
            if wraps or any(i < k <= last[i] for k in mains) or (i < article <= last[i] and chars[i] > seen):
                seen += plain[i]
            else:
                dom.noise[i] = True


def densities(dom: Dom) -> tuple[list[float], list[float], list[bool], list[bool], int]:
    """Composite density, density sum, whether most text is links and whether much of it is by node, and the body (or
    root) node.

    Blocks are judged without the groups of links inside them, inline nodes with the text and inline nodes around
    them."""
    n = len(dom.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    link, dead = [False] * n, [False] * n
    for i in range(1, n):
        dead[i] = dead[dom.parent[i]] or dom.tag[i] in UNSEEN
        link[i] = link[dom.parent[i]] or dom.tag[i] == "a"
    for node, text in dom.items:
        if text and not dead[node]:
            size = len("".join(text.split()))
            chars[node] += size
            if link[node]:
                link_chars[node] += size
    run, link_run, rest, link_rest, linked, many = chars[:], link_chars[:], chars[:], link_chars[:], [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        if dead[i]:
            continue
        up = dom.parent[i]
        linked[i] = link_rest[i] * 2 > rest[i] and dom.tag[i] not in HEADINGS
        many[i] = link_rest[i] * 5 > rest[i] and dom.tag[i] in GROUPS
        if not linked[i] or dom.tag[i] not in GROUPS:
            rest[up] += rest[i]
            link_rest[up] += link_rest[i]
        if dom.tag[i] not in BLOCKS:
            run[up] += chars[i]
            link_run[up] += link_chars[i]
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + 1
        link_tags[up] += link_tags[i] + (dom.tag[i] == "a")
    for i in range(1, n):
        if dom.tag[i] not in BLOCKS:
            linked[i] = link_run[dom.parent[i]] * 2 > run[dom.parent[i]]
    body = next((i for i in range(n) if dom.tag[i] == "body"), 0)
    body_link_share = link_chars[body] / max(chars[body], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        if not chars[i]:
            continue
        plain = max(chars[i] - link_chars[i], 1)
        base = math.log(chars[i] / plain * link_chars[i] + body_link_share * chars[i] + math.e)
        inner = chars[i] / max(link_chars[i], 1) * max(tags[i], 1) / max(link_tags[i], 1)
        density[i] = chars[i] / max(tags[i], 1) * math.log(max(inner, 1.0)) / base
        if i and not dom.noise[i]:
            total[dom.parent[i]] += density[i]
    return density, total, linked, many, body


def main_nodes(dom: Dom) -> list[bool]:
    """For every node, whether its text belongs to the main text."""
    n = len(dom.tag)
    density, total, linked, many, body = densities(dom)
    score = [t if t else d for t, d in zip(total, density)]
    inside = [False] * n
    for i in range(n):
        inside[i] = i == body or (i > body and inside[dom.parent[i]])
    chosen = max((i for i in range(n) if inside[i] and not dom.noise[i]), key=lambda i: (score[i], -i), default=body)
    head, path, i = None, {body}, chosen
    while i != body:
        path.add(i)
        if head is None and dom.tag[i] in ("article", "main"):
            head = i
        i = dom.parent[i]
    article = head is not None
    head = head if article else chosen
    threshold = min(density[i] for i in path)
    keep, whole = [False] * n, [False] * n
    for i in range(n):
        if not inside[i] or dom.noise[i]:
            continue
        above = i != body
        whole[i] = i == head or (above and whole[dom.parent[i]])
        if whole[i] or i in path:
            keep[i] = whole[i] or not article
        elif not article and keep[dom.parent[i]]:
            judged = dom.parent[i] in path or dom.tag[i] in GROUPS
            keep[i] = not (judged and (linked[i] or (many[i] and density[i] < threshold)))
    return keep


def main_text(html: str | None) -> str:
    """Main text of a page; the empty text if there is none."""
    if not html:
        return ""
    dom = Dom()
    dom.feed(html)
    dom.close()
    mark_worded(dom)
    keep = main_nodes(dom)
    lines, line = [], []
    for node, text in dom.items:
        if text is None:
            lines.append(" ".join("".join(line).split()))
            line = []
        elif keep[node]:
            line.append(text)
    lines.append(" ".join("".join(line).split()))
    return "\n".join(x for x in lines if x)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``pages`` -> (id, url, text, n_chars), one row a page.

    A null or empty page, or one without text, gives the empty text.  Ids and urls are carried
    as they are (null, repeated); other columns of any name are ignored.  Pages are independent:
    one Arrow map, no shuffle."""
    id_type = dict(pages.dtypes)[id_col]
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        text_or_empty(html_col).alias("html"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    out = map_batches(rows, run, f"page_id {id_type}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_col, "url": url_col}) if (id_col, url_col) != ("page_id", "url") else out
