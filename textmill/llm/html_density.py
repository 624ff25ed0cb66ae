"""Main text of web pages by composite text density (``op4_html_text``).

For every node of a page's tree: C characters and T tags below it, LC characters and LT tags in links. Its composite
density is ``C/T * log(1 + C/LC * T/LT)`` to the base ``ln(C/notLC * LC + LCbody/Cbody * C + e)``: many characters for each tag
and few of them in links. A node's density sum adds its children's densities. The node with the largest
sum is the main subtree; the smallest density on its path up to the body is the threshold by which other
nodes count as content too, each by the subtree with the largest sum below it.

Menus, site headers, footers, asides, forms, hidden parts, adverts, notices and reader comments are left out before anything is counted, by
tag, role or class. Ids of headings, spans, sections and paragraphs (slugs of titles) mean nothing, and of their classes only marks of adverts, comments, consent and the
like do. Inside an article only clear marks (adverts, comments, hidden parts) leave out a part at once; other marked containers are judged by
their share of links and their density. Other blocks inside a chosen subtree are all kept, however short. Of equally dense subtrees the first in the page
counts; repeated rows give repeated results. Character references are decoded, white
space inside a block becomes one space, blocks are joined by an empty line.

Each row is handled alone (no shuffle), in time linear in its length. Null and empty pages and pages without
text give an empty string. Broken markup is read as far as it goes. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import kit

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
REST = re.compile(r"""(?>=\s*"[^"]*"|=\s*'[^']*'|[^>=]++|=)*+>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/>]))""", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript iframe template textarea title xmp noembed noframes".split())
LEFT_OUT = frozenset("head nav aside footer form button select option fieldset dialog menu svg canvas object audio video map datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key ends an open element of these names.
ENDS = {n: ("p",) for n in BLOCKS} | {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p")}
ENDS |= {"td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody", "p")}
FENCES = frozenset(["table", "ul", "ol", "dl", "article", "section", "div", "td", "blockquote", "body"])  # an implied end stops at these
#: Words of a class or id that mark what is no part of an article.
MARKS = frozenset(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promoted promotion sidebar cookie cookies consent gdpr notice notices alert "
    "newsletter subscribe subscription paywall share sharing social related recommended comment comments commentlist disqus reply replies respond menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead popup modal overlay widget pagination pager login signup register search toolbar skip hidden copyright legal "
    "disclaimer tags".split()
)
KEPT_NAMES = frozenset(["html", "body", "main", "article", "h1"])
COMMENT_MARKS = frozenset(["comment", "comments", "reply", "respond", "hidden", "ad", "advert", "sponsored", "related", "promo"])
#: Marks that no article text has, inside an article too.
CLEAR_MARKS = (COMMENT_MARKS | frozenset("commentlist disqus ads advertisement advertising adsense".split())) - {"related", "promo", "reply", "respond"}
#: Marks by which a single heading, paragraph or the like is no article text, outside an article.
TEXT_MARKS = CLEAR_MARKS | frozenset("cookie cookies consent gdpr newsletter subscribe subscription paywall breadcrumb breadcrumbs pagination copyright skip sponsor promo".split())
CONTAINERS = frozenset("div ul ol dl table section figure center".split())
UNMARKED_IDS = frozenset("h1 h2 h3 h4 h5 h6 span section p a b i em strong li dt dd td th blockquote pre code".split())


def words_in(value: str) -> list[str]:
    return re.split(r"[^a-z0-9]+", value)


def is_doubtful(name: str, attributes: str) -> bool:
    """Whether a container inside an article carries a mark that link share and density have to confirm."""
    if name not in CONTAINERS:
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key == "class" or (key == "id" and name not in UNMARKED_IDS):
            if not MARKS.isdisjoint(words_in(value.strip("\"'").lower())):
                return True
    return False


def is_left_out(name: str, attributes: str, in_article: bool) -> bool:
    """Whether a start tag opens a part that is no article text."""
    if name in LEFT_OUT or (name == "header" and not in_article):
        return True
    if not attributes:
        return False
    marks = COMMENT_MARKS if name in KEPT_NAMES else MARKS
    if in_article and name not in KEPT_NAMES:
        marks = COMMENT_MARKS if name == "header" else CLEAR_MARKS
    elif name in UNMARKED_IDS and name not in CONTAINERS:
        marks = TEXT_MARKS
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style":
            if "display:none" in value.replace(" ", "") or "visibility:hidden" in value.replace(" ", ""):
                return True
        elif key == "role":
            if value in ROLES:
                return True
        elif key == "id" and name in UNMARKED_IDS:  # mostly a slug of a title
            if name == "section" and value in ("comments", "respond", "disqus_thread"):  # the usual ids of comment parts, whole
                return True
        elif name not in ("html", "body") and not marks.isdisjoint(words_in(value)):
            return True
    return False


class Page:
    """Tree of a page as parallel lists (node 0 is the root), and its text runs in page order."""

    def __init__(self, html: str) -> None:
        self.parent, self.name, self.out, self.link, self.doubtful = [-1], ["#"], [False], [False], [False]
        self.runs: list[tuple[int, str]] = []  # node and text; node -1: a block ends or begins
        self.stack, self.open, self.articles = [0], Counter(), 0
        self.body = 0
        self.read(html)

    def add_text(self, text: str) -> None:
        if text:
            self.runs.append((self.stack[-1], unescape(text) if "&" in text else text))

    def close_top(self) -> None:
        node = self.stack.pop()
        name = self.name[node]
        self.open[name] -= 1
        self.articles -= name in ("article", "main")
        if name in BLOCKS:
            self.runs.append((-1, ""))

    def close(self, name: str) -> None:
        if self.open[name] > 0:
            while self.name[self.stack[-1]] != name:
                self.close_top()
            self.close_top()

    def imply_ends(self, name: str) -> None:
        ends = ENDS.get(name, ())
        if not any(self.open[n] > 0 for n in ends):
            return
        last = None
        for depth in range(len(self.stack) - 1, 0, -1):
            at = self.name[self.stack[depth]]
            if at in ends:
                last = depth
            elif at in FENCES:
                break
        if last is not None:
            while len(self.stack) > last:
                self.close_top()

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.imply_ends(name)
            self.runs.append((-1, ""))
        elif name == "br":
            self.runs.append((self.stack[-1], " "))
        top = self.stack[-1]
        node = len(self.parent)
        self.parent.append(top)
        self.name.append(name)
        self.out.append(self.out[top] or is_left_out(name, attributes, self.articles > 0))
        self.link.append(self.link[top] or name == "a")
        self.doubtful.append(self.articles > 0 and bool(attributes) and is_doubtful(name, attributes))
        if name == "body" and not self.body:
            self.body = node
        if name in VOID or attributes.endswith("/") and name not in BLOCKS:
            return
        self.stack.append(node)
        self.open[name] += 1
        self.articles += name in ("article", "main")

    def read(self, html: str) -> None:
        at, size, lowered = 0, len(html), None
        while at < size:
            sign = html.find("<", at)
            if sign < 0:
                self.add_text(html[at:])
                break
            found = NAME.match(html, sign + 1)
            if found:
                rest = REST.match(html, found.end())
                if not rest:  # cut off inside a tag
                    self.add_text(html[at:sign])
                    break
                self.add_text(html[at:sign])
                name, attributes = found.group().lower(), rest.group()[:-1].strip()
                at = rest.end()
                if name in UNREAD:
                    lowered = lowered if lowered is not None else html.lower()
                    if len(lowered) != size:  # a letter that changes its length
                        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in html)
                    end = lowered.find(f"</{name}", at)
                    stop = html.find(">", end) if end >= 0 else -1
                    at = stop + 1 if stop >= 0 else size
                else:
                    self.start(name, attributes)
                continue
            self.add_text(html[at:sign])
            if html.startswith("<!--", sign):
                end = html.find("-->", sign + 4)
                at = end + 3 if end >= 0 else size
            elif html.startswith("</", sign) and NAME.match(html, sign + 2):
                end = html.find(">", sign)
                if end >= 0:
                    self.close(NAME.match(html, sign + 2).group().lower())
                at = end + 1 if end >= 0 else size
            elif html.startswith(("<!", "<?", "</"), sign):
                end = html.find(">", sign)
                at = end + 1 if end >= 0 else size
            else:
                self.add_text("<")
                at = sign + 1

    def measured(self) -> tuple[list[int], list[int], list[float], list[float]]:
        """Of each node: characters and linked characters below it, composite density, and the sum of its children's densities."""
        count = len(self.parent)
        chars, linked, tags, link_tags = [0] * count, [0] * count, [0] * count, [0] * count
        for node, text in self.runs:
            if node >= 0 and not self.out[node]:
                n = len("".join(text.split()))
                chars[node] += n
                linked[node] += n * self.link[node]
        for node in range(count - 1, 0, -1):
            if not self.out[node]:
                up = self.parent[node]
                chars[up] += chars[node]
                linked[up] += linked[node]
                tags[up] += tags[node] + 1
                link_tags[up] += link_tags[node] + (self.name[node] == "a")
        share = linked[self.body] / max(chars[self.body], 1)
        density, total = [0.0] * count, [0.0] * count
        inner = [False] * count
        for node in range(count):
            c, lc, t, lt = chars[node], linked[node], max(tags[node], 1), max(link_tags[node], 1)
            if c and not self.out[node]:
                base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
                density[node] = c / t * math.log(1 + c / max(lc, 1) * t / lt) / math.log(max(base, 1.001))  # without any link the base is the same everywhere
        for node in range(count - 1, 0, -1):
            total[self.parent[node]] += density[node]
            inner[self.parent[node]] = True
        return chars, linked, density, [s if i else d for s, i, d in zip(total, inner, density)]

    def chosen(self) -> list[bool]:
        """For each node, whether it lies in a chosen subtree."""
        count = len(self.parent)
        chars, linked, density, total = self.measured()
        best, top = list(range(count)), total[:]  # of each subtree
        for node in range(count - 1, 0, -1):
            if top[node] > top[self.parent[node]] or (top[node] == top[self.parent[node]] and total[node] == top[node] and best[self.parent[node]] != self.parent[node]):
                best[self.parent[node]], top[self.parent[node]] = best[node], top[node]
        main = best[self.body]
        threshold, node = density[main], main
        article = None
        while node != self.body and node > 0:
            article = node if self.name[node] in ("article", "main") else article
            node = self.parent[node]
            threshold = min(threshold, density[node])
        picked = [False] * count
        picked[main] = density[main] > 0
        if article is not None:  # on the path, so at least as dense as the threshold
            picked[article] = True
        for node in range(self.body + 1, count):
            if density[node] >= threshold > 0 and not self.out[node]:
                picked[best[node]] = True
        dropped, path = [False] * count, {main}
        for node in range(main, 0, -1):
            if node in path:
                path.add(self.parent[node])
        for node in range(1, count):
            judged = self.doubtful[node] and node not in path and (2 * linked[node] > chars[node] or density[node] < threshold)
            dropped[node] = judged or dropped[self.parent[node]]
            picked[node] = (picked[node] or (picked[self.parent[node]] and self.parent[node] >= 0)) and not dropped[node]
        return picked

    def text(self) -> str:
        picked, blocks, current = self.chosen(), [], []
        for node, text in [*self.runs, (-1, "")]:
            if node >= 0:
                if picked[node] and not self.out[node]:
                    current.append(text)
            elif current:
                block = " ".join("".join(current).split())
                if block:
                    blocks.append(block)
                current = []
        return "\n\n".join(blocks)


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row with page_id, url and html."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in kit.slices(batch, "html"):
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(rows, "page_id long, url string, text string, n_chars long")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(kit.tables(spark, sf_dir, "pages"))


QUERIES = {"op4_html_text": op4_html_text}
ORACLE_SQL: dict[str, str] = {}
