"""Main text of web pages by template deduction with equivalence classes.

The tokens of a page are its block tags and its pieces of text, each told apart by the
path of elements around it.  Tokens with the same number of occurrences on every page
of a host form an equivalence class; classes that are frequent and large enough, whose
tokens keep one order on every page and which lie in one and the same gap of the class
around them are valid and nest into the host's template.  What a page has in the gaps
of the template is its own content.  Gaps in elements made for menus, headers, footers,
side columns, notices, adverts, forms, comments, scripts and styles are not text; if
the page marks its article, only gaps in there are.  Copies of one page tell nothing
about what differs between pages, so they count as one page of their host.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .rows import map_slices
from .urls import host_of

SUPPORT = 0.5        # share of a host's pages that a template token must be on
LEAST_PAGES = 8      # pages of a host before anything is called a template
LEAST_TOKENS = 3     # of a class
MASK = (1 << 62) - 1

INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark
    q ruby rt rp s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg object select".split())
OTHER = frozenset("nav header footer aside form head title button dialog menu menuitem fieldset".split()) | RAW
MAIN = frozenset(["article", "main"])
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",), "body": ("head",)}
HOLDS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
         "th": ("tr", "table"), "option": ("select",), "body": ()}
# Class, id and role names of something other than the article, whole or after a hyphen
# or underscore (``site-header``).  A name that also says has, no or with tells what the
# element holds or lacks.
SIDE = frozenset("""ad ads advert advertisement adverts aside banner breadcrumb breadcrumbs comment comments consent
    cookie cookies disqus footer header masthead menu modal nav navbar navigation notice notices popup promo
    related reply replies share sharing sidebar social sponsor sponsored subscribe toolbar widget adsbygoogle""".split())
# Words behind such a name that only say what kind of box it is (``comments-list``, ``ad-container``).
BOXES = frozenset("area block box buttons container form inner item items links list section slot thread unit wrap wrapper".split())
FLAGS = frozenset("has have no non not with without hide hidden show".split())
NEVER = frozenset(["html", "body", "main"])      # hold the article, whatever their class says
TAG = re.compile(r"<(?:!--|([!?])|(/?)([a-zA-Z][^\s/>]*))")
# The rest of a tag: a > in a quoted value does not end it.
REST = re.compile(r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+>""")
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[^a-z]+")
CAPITAL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
FORM = re.compile("<form", re.I)
FRAME = re.compile(r"<(/?form|article|main|h1)\b", re.I)


class Node:
    __slots__ = ("tag", "path", "side", "main", "article")

    def __init__(self, tag: str, path: int, side: bool, main: bool, article: bool):
        self.tag, self.path, self.side, self.main, self.article = tag, path, side, main, article


def names_side(name: str) -> bool:
    """Does a class, id or role name say that its element is not text?"""
    parts = re.split(r"[-_]+", CAPITAL.sub("-", name).strip("-_").lower())
    while len(parts) > 1 and parts[-1] in BOXES:
        parts.pop()
    return parts[-1] in SIDE and FLAGS.isdisjoint(parts[:-1])


def wrapping_forms(page: str) -> set[int]:
    """Where forms begin that hold an article, main or first heading: they wrap the page."""
    found, open_ = set(), []
    for m in FRAME.finditer(page):
        name = m[1].lower()
        if name == "form":
            open_.append(m.start())
        elif name == "/form":
            if open_:
                open_.pop()
        else:
            found.update(open_)
            open_.clear()
    return found


def mix(a: int, b: int) -> int:
    return ((a ^ (a >> 29)) * 0x9E3779B97F4A7C15 + b) & MASK


def events(page: str | None) -> Iterator[tuple[str, int, Node, str]]:
    """(kind, token, node, text) in page order; kinds: ``<`` and ``>`` block tags, ``t`` text, ``b`` blank.

    One pass over the page.  Elements may be left open: a block tag ends an open
    paragraph, list items and cells end each other, and everything ends with the page.
    An inline element made for an advert or the like hides its text without ending a block.
    """
    page = page or ""
    root = Node("", 1, False, False, False)
    stack = [root]
    opened: Counter[str] = Counter()
    wraps = wrapping_forms(page) if FORM.search(page) else frozenset()
    at, size = 0, len(page)

    def text(a: int, b: int) -> Iterator[tuple[str, int, Node, str]]:
        if a < b:
            node = stack[-1]
            piece = html.unescape(page[a:b])
            yield "t", mix(node.path, zlib.crc32(piece.strip().encode("utf-8", "surrogatepass"))), node, piece

    def close(upto: int) -> Iterator[tuple[str, int, Node, str]]:
        while len(stack) > upto:
            node = stack.pop()
            opened[node.tag] -= 1
            if node.tag not in INLINE:
                yield ">", mix(node.path, 62), node, ""

    def push(node: Node) -> None:
        stack.append(node)
        opened[node.tag] += 1

    while True:
        found = TAG.search(page, at)
        if not found:
            break
        yield from text(at, found.start())
        name = (found[3] or "").lower()
        if not name:
            mark = "-->" if not found[1] else ">"
            end = page.find(mark, found.end())
            at = size if end < 0 else end + len(mark)
            continue
        end = page.find(">", found.end())
        if end >= 0 and (page.count('"', found.end(), end) % 2 or page.count("'", found.end(), end) % 2):
            rest = REST.match(page, found.end())        # a quote is open at the first >
            end = rest.end() - 1 if rest else end
        attributes, at = (page[found.end():], size) if end < 0 else (page[found.end():end], end + 1)
        if name in INLINE and not found[2]:
            if name in ("br", "img"):
                yield "b", 0, stack[-1], " "
            elif name not in VOID and "=" in attributes and ATTRIBUTE.search(attributes):
                above = stack[-1]
                if any(names_side(n) for m in ATTRIBUTE.finditer(attributes) for n in (m[2] or m[3] or m[4] or "").split()):
                    push(Node(name, mix(above.path, 61), True, above.main, above.article))
                elif opened[name]:
                    push(Node(name, above.path, above.side, above.main, above.article))
            elif opened[name]:          # one inside an advert: its end is not the advert's
                above = stack[-1]
                push(Node(name, above.path, above.side, above.main, above.article))
            continue
        if found[2]:
            if not opened[name]:
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    yield from close(depth)
                    break
                if stack[depth].tag in MAIN and name in ("p", "div", "li", "ul", "ol"):
                    break           # a stray end tag does not end the article
            continue
        top = len(stack) - 1
        while stack[top].tag in INLINE:
            top -= 1
        if stack[top].tag == "p" or stack[top].tag in ("h1", "h2", "h3", "h4", "h5", "h6") and name[:1] == "h":
            yield from close(top)
        if name in HOLDS and any(opened[t] for t in CLOSES[name]):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in HOLDS[name]:
                    break
                if stack[depth].tag in CLOSES[name]:
                    yield from close(depth)
                    break
        value = " ".join(m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes))
        names = WORDS.split(value.lower())
        above = stack[-1]
        # An article is side only in another one, as a comment on it may be.
        named = name not in NEVER and (name != "article" or above.article) and any(map(names_side, value.split()))
        kind = " ".join([name, *sorted(n for n in set(names) if n)])
        node = Node(name, mix(above.path, zlib.crc32(kind.encode("utf-8", "surrogatepass"))),
                    above.side or name in OTHER and found.start() not in wraps or named, above.main or name in MAIN,
                    above.article or name == "article")
        yield "<", mix(node.path, 60), node, ""
        if name in VOID or attributes.endswith("/") and name not in RAW:
            yield ">", mix(node.path, 62), node, ""
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = size if not end else end.start()
            push(node)
        else:
            push(node)
    yield from text(at, size)
    yield from close(1)


def tokens(page: str | None) -> Iterator[int]:
    """Template tokens in order: block tags and pieces of text with a visible character."""
    for kind, token, _, text in events(page):
        if kind in "<>" or kind == "t" and not text.isspace():
            yield token


def _hosted(pages: DataFrame, key: str, url: str, body: str) -> DataFrame:
    return pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(body).alias("html"),
                        host_of(F.col(url)).alias("host"))


def _once(pages: DataFrame) -> DataFrame:
    """``host`` and ``html``, equal pages of a host once.  Only pages that repeat are brought together."""
    rows = pages.select("host", F.xxhash64("html").alias("page"), "html")
    again = cut_lineage(rows.groupBy("host", "page").count().where("count > 1").select("host", "page"))
    if again.isEmpty():
        return rows
    return rows.join(again, ["host", "page"], "left_anti").select(*rows.columns).union(
        rows.join(again, ["host", "page"], "left_semi").select(*rows.columns).dropDuplicates(["host", "page"]))


def _occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, n, mark): on how many pages, and a fingerprint of the occurrence vector.

    The fingerprint is the sum of a hash of (page, count), the same for two tokens only
    if their vectors agree; sums combine before the exchange.  ``pages`` are distinct.
    """
    def make() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            out: dict = {"host": [], "token": [], "mark": []}
            for host, page_id, page in zip(part["host"], part["page"], part["html"]):
                for token, n in Counter(tokens(page)).items():
                    out["host"].append(host)
                    out["token"].append(token)
                    out["mark"].append(mix(mix(page_id & MASK, n), 7))
            return out
        return work

    return map_slices(pages, make, "host STRING, token BIGINT, mark BIGINT", 64).groupBy("host", "token").agg(
        F.count("*").alias("n"), F.sum(F.col("mark").cast("decimal(38,0)")).alias("mark"))


def _classes(pages: DataFrame, support: float, least_pages: int) -> DataFrame:
    """(host, classes): the token sets that share a vector and are frequent and large enough."""
    # Pages are counted without being parsed.
    sizes = pages.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    # Tokens of fewer pages than any template needs, most of all, go before they are brought together.
    often = _occurrences(pages).where(F.col("n") >= support * least_pages)
    return often.join(sizes, "host").where(F.col("n") >= support * F.col("pages")) \
        .groupBy("host", "mark").agg(F.sort_array(F.collect_list("token")).alias("tokens"), F.max("n").alias("n")) \
        .where(F.size("tokens") >= LEAST_TOKENS) \
        .groupBy("host").agg(F.array_sort(F.collect_list(F.struct(
            (-F.col("n")).alias("rare"), (-F.size("tokens")).alias("small"), "tokens"))).alias("classes"))


def placed(classes: list[list[int]], page: str | None) -> list[tuple[list[int], int] | None]:
    """Of every class on a page: its order and the gap of the first class that it lies in (-1: itself).

    None: not on this page.  An empty order: the tokens do not repeat in one order, or
    lie in several gaps.
    """
    of = {t: c for c, own in enumerate(classes) for t in own}
    seen: list[list[int]] = [[] for _ in classes]
    gaps: list[set[int]] = [set() for _ in classes]
    gap = 0
    for token in tokens(page):
        c = of.get(token)
        if c is None:
            continue
        if c == 0:
            gap += 1
        seen[c].append(token)
        gaps[c].add(gap)
    out: list[tuple[list[int], int] | None] = []
    for c, run in enumerate(seen):
        size = len(classes[c])
        fits = len(run) % size == 0 and all(run[i] == run[i % size] for i in range(len(run))) \
            and len(set(run[:size])) == size and (c == 0 or len(gaps[c]) == 1)
        out.append(None if not run else (run[:size], -1 if c == 0 else min(gaps[c])) if fits else ([], 0))
    return out


def templates(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
              support: float = SUPPORT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(host, template): the valid classes of a host, each (tokens in order, gap), outermost first.

    Hosts with fewer than ``least_pages`` pages have none.
    """
    hosted = _hosted(pages, key, url, body)
    classes = cut_lineage(_classes(_once(hosted), support, least_pages))

    def make() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            out: dict = {"host": [], "class": [], "order": [], "gap": []}
            for host, found, page in zip(part["host"], part["classes"], part["html"]):
                for c, place in enumerate(placed([f["tokens"] for f in found], page)):
                    if place is not None:
                        for name, value in zip(out, (host, c, place[0], place[1])):
                            out[name].append(value)
            return out
        return work

    # The written classes have a known size: Spark broadcasts them or joins by host.
    seen = map_slices(hosted.select("host", "html").join(classes, "host"), make,
                      "host STRING, class INT, order ARRAY<BIGINT>, gap INT", 64)
    valid = seen.groupBy("host", "class").agg(
        F.min("order").alias("order"), F.max("order").alias("other"), F.min("gap").alias("gap"), F.max("gap").alias("top")) \
        .where((F.col("order") == F.col("other")) & (F.size("order") > 0) & (F.col("gap") == F.col("top")))
    return valid.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("class", "gap", "order"))).alias("template"))


def main_text(page: str | None, template: set[int]) -> str:
    """Text in the gaps of the template, block by block.

    Blocks of other elements and template text are left out; with an article (or main)
    element also everything outside of it.
    """
    rows = list(events(page))
    marked = any(node.main and not node.side for kind, _, node, _ in rows if kind == "<")
    blocks: list[list[str]] = [[]]
    for kind, token, node, text in rows:
        if kind in "<>":
            if blocks[-1]:
                blocks.append([])
        elif not node.side and (node.main or not marked) and (kind == "b" or token not in template):
            blocks[-1].append(text)
    done = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(b for b in done if b)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
            support: float = SUPPORT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per input row: ``key``, ``url``, ``text`` and ``n_chars`` (code points).

    Character references are decoded once, white space in a block is one space, blocks
    are joined by an empty line.  A null or empty page, or one without text, gives an
    empty text.  Null urls share the empty host.  Repeated rows are extracted each.
    """
    found = cut_lineage(templates(pages, key, url, body, support, least_pages))
    hosted = _hosted(pages, key, url, body)
    kind = hosted.schema["key"].dataType.simpleString()

    def make() -> Callable[[dict], dict]:
        def work(part: dict) -> dict:
            texts = [main_text(page, {t for c in (own or []) for t in c["order"]})
                     for page, own in zip(part["html"], part["template"])]
            return {"key": part["key"], "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]}
        return work

    rows = map_slices(hosted.join(found, "host", "left").select("key", "url", "html", "template"), make,
                      f"key {kind}, url STRING, text STRING, n_chars BIGINT", 64)
    return rows.select(F.col("key").alias(key), "url", "text", "n_chars")
