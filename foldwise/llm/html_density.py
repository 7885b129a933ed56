"""Main text of web pages by composite text density.

For every element of the page's tree: C characters and T tags below it, and of those LC characters and
LT tags in links. Its density is C / T times the logarithm of (C / LC) * (T / LT), to a base that grows
with the share of link text in the element and in the whole body; text in links thus hardly counts. The
element with the greatest sum of its children's densities holds the main text. The least density
on the path from it up to the body is the threshold: blocks beside that path that reach it belong to the
text too, and what stays below is left out.

Before that, elements that never hold an article's text go, by their tag or role. Forms, and elements with a listed word in
their class or id, go as well, unless they are wrappers: outside ``article`` and ``main``, they hold such an element with text;
or they hold most of the text outside links of the ``article`` or ``main`` around them, or of the page if no other such element
would stay. Wrappers' descendants are judged by themselves. Where nothing would be left, the words don't count. An ``article`` or ``main`` element around the chosen element is taken whole.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import map_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("aside audio button canvas datalist dialog embed fieldset footer head iframe input link menu meta nav noscript object "
                    "script select style svg template textarea title video".split())
WHOLE = frozenset(("article", "main"))
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright "
    "disqus disclaimer footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination "
    "popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored "
    "sponsors subscribe subscription tagcloud toolbar topbar widget widgets".split())
#: Of these, words of parts that may be longer than the text and hold ``article`` elements; such parts are no wrappers.
PART_WORDS = frozenset("comment comments consent cookie cookies disqus gdpr replies reply respond".split())
#: A class that starts so says what is there, or isn't, and not what the element is.
_STATE = re.compile(r"^(?:has|no|with|without)[-_]")
SOFT, PART, HARD = 1, 2, 3
#: An open element of the second set ends when one of the first starts.
ENDS = ((frozenset("address article aside blockquote center details div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li "
                   "main nav ol p pre section table td th tr ul".split()), frozenset(("p",))),
        (frozenset(("li",)), frozenset(("li",))), (frozenset(("dt", "dd")), frozenset(("dt", "dd"))), (frozenset(("option",)), frozenset(("option",))),
        (frozenset(("tr",)), frozenset(("tr", "td", "th"))), (frozenset(("td", "th")), frozenset(("td", "th"))))
#: Elements that an implied end never reaches across.
SCOPES = frozenset("article aside body button div main ol section table ul".split())
_WORDS = re.compile(r"[a-z]+")


def _unwanted(tag: str, attrs: dict, inside_whole: bool) -> int:
    """0, or ``HARD``: goes; ``SOFT``: goes unless it is a wrapper; ``PART``: goes unless nothing else is left."""
    if tag in ("html", "body") or tag in WHOLE:
        return 0
    if tag in DROPPED or tag == "header" and not inside_whole:
        return HARD
    if attrs.get("role") in DROPPED_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return HARD
    if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
        return HARD
    named = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
    words = {w for name in named.split() if not _STATE.match(name) for w in _WORDS.findall(name)}
    if not words.isdisjoint(PART_WORDS):
        return PART
    if tag == "form" or attrs.get("role") == "form" or not words.isdisjoint(DROPPED_WORDS) or "header" in words and not inside_whole:
        return SOFT
    return 0


class _Tree(HTMLParser):
    """Elements in page order: tag, parent, last descendant; runs of text with their element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.whole, self.open, self.runs = ["#root"], [-1], [False], [0], []
        self.skipped, self.counts, self.doubtful = 0, {}, {}

    def handle_starttag(self, tag, attrs):
        for starts, ends in ENDS:
            if tag in starts:
                for at in range(len(self.open) - 1, 0, -1):
                    name = self.tags[self.open[at]]
                    if name in ends:
                        self._close(at)
                        break
                    if name in SCOPES:
                        break
        if tag == "body" and self.skipped and self.tags[self.skipped] == "head":
            self._close(self.open.index(self.skipped))
        parent = self.open[-1]
        whole = self.whole[parent] or tag in WHOLE
        self.tags.append(tag)
        self.parents.append(parent)
        self.whole.append(whole)
        if not self.skipped and tag not in VOID:
            unwanted = _unwanted(tag, dict(attrs), whole)
            if unwanted == HARD:
                self.skipped = len(self.tags) - 1
            elif unwanted:
                self.doubtful[len(self.tags) - 1] = unwanted
        if tag in VOID:
            if not self.skipped:
                self.runs.append((len(self.tags) - 1, " "))
            return
        self.open.append(len(self.tags) - 1)
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style", "svg", "iframe", "textarea", "title"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.counts.get(tag):
            at = next(k for k in range(len(self.open) - 1, 0, -1) if self.tags[self.open[k]] == tag)
            self._close(at)

    def _close(self, at: int) -> None:
        for node in self.open[at:]:
            self.counts[self.tags[node]] -= 1
            if node == self.skipped:
                self.skipped = 0
        del self.open[at:]

    def handle_data(self, data):
        if not self.skipped:
            self.runs.append((self.open[-1], data))


def _dropped(tree: _Tree) -> list[bool]:
    """The elements that go with a doubtful one that is no wrapper."""
    n = len(tree.tags)
    text, whole_below, scope = [0] * n, [False] * n, [0] * n
    in_link, in_doubt = [False] * n, [False] * n
    for k in range(1, n):
        up = tree.parents[k]
        in_link[k] = tree.tags[k] == "a" or in_link[up]
        in_doubt[k] = k in tree.doubtful or in_doubt[up]
        scope[k] = up if tree.tags[up] in WHOLE else scope[up]
    for node, run in tree.runs:
        text[node] += 0 if in_link[node] else sum(map(len, run.split()))
    for k in range(n - 1, 0, -1):
        up = tree.parents[k]
        text[up] += text[k]
        whole_below[up] = whole_below[up] or whole_below[k] or tree.tags[k] in WHOLE and text[k] > 0
    other = any(tree.tags[k] in WHOLE and text[k] and not in_doubt[k] for k in range(n))
    gone = [False] * n
    for k in range(1, n):
        gone[k] = gone[tree.parents[k]]
        if k in tree.doubtful and not gone[k]:
            wrapper = 2 * text[k] > text[scope[k]] and (scope[k] > 0 or not other) or not scope[k] and whole_below[k]
            gone[k] = tree.doubtful[k] == PART or not wrapper
    return gone


def _choose(tree: _Tree) -> set[int]:
    """The elements whose subtrees make the main text."""
    n = len(tree.tags)
    chars, link_chars, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = tree.tags[k] == "a" or in_link[tree.parents[k]]
    for node, text in tree.runs:
        size = sum(map(len, text.split()))
        chars[node] += size
        link_chars[node] += size * in_link[node]
    for k in range(n - 1, 0, -1):  # children come after their parents
        up = tree.parents[k]
        chars[up] += chars[k]
        link_chars[up] += link_chars[k]
        tags[up] += tags[k] + 1
        link_tags[up] += link_tags[k] + in_link[k]
    ratio = link_chars[0] / max(1, chars[0])

    def density(k: int) -> float:
        c, t, lc, lt = chars[k], max(1, tags[k]), link_chars[k], link_tags[k]
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * lc + ratio * c + math.e)
        return c / t * max(0.0, math.log(max(1.0, c / max(1, lc) * t / max(1, lt))) / max(math.log(max(base, 1.0)), 1.0)) if c > 1 else float(c)

    dense = [density(k) for k in range(n)]
    total = [0.0] * n
    for k in range(1, n):
        if tree.tags[k] not in INLINE:
            up = tree.parents[k]
            while tree.tags[up] in INLINE:  # a block in an unclosed inline element
                up = tree.parents[up]
            total[up] += dense[k]
    body = next((k for k in range(n) if tree.tags[k] == "body"), 0)
    best = max(range(n), key=lambda k: (total[k], -k))
    if not total[best]:
        return {body if chars[body] else 0}
    path = [best]
    while path[-1] > 0 and path[-1] != body:
        path.append(tree.parents[path[-1]])
    whole = [k for k in path if tree.tags[k] in WHOLE]
    if whole:
        return {whole[-1]}
    threshold = min(dense[k] for k in path)
    on_path = set(path)
    beside = {k for k in range(1, n) if tree.parents[k] in on_path and tree.parents[k] != best and k not in on_path
              and tree.tags[k] not in INLINE and chars[k] and dense[k] >= threshold}
    return {best, *beside}


def main_text(html: str | None) -> str:
    """The main text of a page: its blocks in page order, each with single spaces, with an empty line
    between. Null and empty pages, and pages without text, give the empty string."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    if tree.doubtful:
        gone = _dropped(tree)
        left = [r for r in tree.runs if not gone[r[0]]]
        if any(text.strip() for _, text in left):
            tree.runs = left
    chosen = _choose(tree)
    n = len(tree.tags)
    inside, block = [False] * n, [0] * n
    for k in range(n):
        up = tree.parents[k]
        inside[k] = k in chosen or up >= 0 and inside[up]
        block[k] = k if tree.tags[k] not in INLINE and tree.tags[k] != "hr" else block[up]
    blocks, last = [], None
    for node, text in tree.runs:
        if inside[node]:
            here = block[node]
            # text of an outer block that goes on after an inner one is a block of its own
            if here != last:
                blocks.append([])
                last = here
            blocks[-1].append(text)
        else:
            last = None
    return "\n\n".join(filter(None, (" ".join("".join(b).split()) for b in blocks)))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html). Null and empty
    pages give an empty text; repeated rows stay; an empty table gives an empty result."""

    def run(batch: pa.RecordBatch) -> dict:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())}

    return map_batches(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html"),
                       "page_id long, url string, text string, n_chars long", run)
