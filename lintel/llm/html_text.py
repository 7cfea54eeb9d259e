"""Main text of web pages through site style trees.

Pages of one host are merged into a tree of style paths (tags with their classes
and ids).  A node's importance is the entropy, over the pages that have it, of its
presentation (the children it shows) and of its content, each relative to the
greatest possible; nodes that look and read alike on all pages are boilerplate.
Nodes of low importance are removed from every page of the host, with whatever
tags or names that mean navigation, notices or adverts, inline elements included.
Inside an article a name must say so as a whole; where it only hints at it, the
node's importance decides, against a higher bar.  Plain paragraphs and headings of an
article are never removed for repeating.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lintel.llm.common import checkpointed, fresh
from lintel.llm.url_lists import host_of

EVIDENCE = 4.0          # a node counts as important on so many pages beside those it was seen on
LOW = 0.35              # nodes below this importance are removed
BROADCAST = 32 << 20     # bytes of removed paths that are sent to every task; longer lists meet their pages in a join
SALTS = 32
NAMED_LOW = 0.7         # and below this one where a name hints at boilerplate
TEASER = 4, 400         # an article with this factor less text than the paragraphs beside it, and these have so many characters, is not the whole story
CONTENT_WEIGHT = 0.8    # weight of content against presentation

HIDDEN = {"script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "title", "math", "canvas", "audio", "video"}
VOID = {"br", "img", "hr", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
NOISE_TAGS = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset", "label"}
NOISE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "comments", "consent", "contentinfo", "cookie", "cookies",
    "dialog", "disclaimer", "discussion", "disqus", "footer", "form", "gdpr", "header", "hidden", "legal", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notification", "overlay", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended", "related", "replies", "reply", "responses", "search", "share", "sharing", "sidebar",
    "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "tags", "teaser", "toc", "toolbar", "widget", "widgets",
}
# Parts of names that say where or how something stands, not what it is.
PLACES = {
    "area", "articles", "bar", "block", "bottom", "box", "btn", "button", "buttons", "col", "container", "content", "count", "cta", "entry", "float", "form", "group", "heading", "icon", "icons", "inline",
    "inner", "item", "items", "label", "left", "link", "links", "list", "main", "message", "module", "outer", "page", "panel", "post", "posts", "primary", "region", "right", "row", "secondary", "section", "site",
    "slot", "small", "tools", "top", "unit", "wide", "wrap", "wrapper", "x",
}
TEXT_TAGS = {"p", "li", "blockquote", "td", "dd", "dt", "figcaption", "pre", "em", "strong", "b", "i", "q", "cite", "code"}
MAIN_TAGS = {"article", "main"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
ENDS_P = BLOCKS - {"html", "head", "body", "option", "summary", "caption", "tbody", "tfoot", "thead", "tr", "legend"}
SELF_ENDING = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:-->|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*|[^>]*)>|<(?=/?[a-zA-Z])[^<]*\Z", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    __slots__ = ("tag", "path", "noise", "main", "plain", "hint", "number")

    def __init__(self, tag: str, path: int, noise: bool, main: bool, plain: bool, hint: bool, number: int) -> None:
        self.tag, self.path, self.noise, self.main, self.plain, self.hint, self.number = tag, path, noise, main, plain, hint, number


_STYLES: dict[tuple, tuple[int, bool, bool, bool, bool]] = {}


def _says_noise(tag: str, names: list[set[str]]) -> bool:
    """Whether one of the names, as a whole, means boilerplate; elements of running text need all their names to."""
    whole = [bool(n & NOISE_NAMES) and n <= NOISE_NAMES | PLACES for n in names if n]
    return bool(whole) and (all(whole) if tag in TEXT_TAGS else any(whole))


def _style(above: Element | None, tag: str, attributes: str) -> tuple[int, bool, bool, bool, bool]:
    """Path, noise, main, plain and hint of an element; the few styles of a site recur, so they are kept in a bounded table."""
    key = (above and (above.path, above.noise, above.main, above.plain), tag, attributes)
    if (found := _STYLES.get(key)) is not None:
        return found
    names: list[set[str]] = []
    styled = ""
    for a in _ATTRIBUTE.finditer(attributes or ""):
        value = a[2] or a[3] or a[4] or ""
        styled += f"{a[1].lower()}={value};"
        names += [set(_NAME.findall(_CAMEL.sub(" ", one).lower())) for one in value.split()]
    inside = above is not None and above.main
    heading = len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
    page = tag in ("html", "body")
    path = xxhash.xxh3_64_intdigest(f"{above.path if above else 0}>{tag}[{re.sub('[0-9]+', '0', styled)}]") >> 1
    main = inside or tag in MAIN_TAGS or (not page and "role=main;" in styled)
    hint = not page and not heading and any(n & NOISE_NAMES for n in names)
    named = hint and (not inside or _says_noise(tag, names))
    noise = (above is not None and above.noise) or (tag in NOISE_TAGS and not (tag == "header" and inside)) or named
    # Plain: the page, the article itself, and unnamed elements in it.
    plain = page or (tag in MAIN_TAGS and not inside) or (main and not styled and (above is None or above.plain or not inside))
    if len(_STYLES) > 20_000:
        _STYLES.clear()
    _STYLES[key] = path, noise, main, plain, hint
    return _STYLES[key]


def parse(page: str) -> tuple[list[tuple[str, list[Element]]], list[list[int]]]:
    """Text blocks in page order, each with its open elements, and the child paths of every element.  Text inside noise, inline or not, is left out.

    Unclosed and stray tags are taken as browsers do: a block start ends an open
    paragraph, a list item ends the one before, an end tag closes what it left open.
    """
    stack: list[Element] = []
    blocks: list[tuple[str, list[Element]]] = []
    children: list[list[int]] = []
    text: list[str] = []
    outer = list(stack)

    def flush() -> None:
        if text:
            whole = "".join(text)
            found = " ".join((entities.unescape(whole) if "&" in whole else whole).split())
            if found:
                blocks.append((found, outer))
            text.clear()

    at, end, low = 0, len(page), None
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            if not (stack and stack[-1].noise):
                text.append(page[at:])
            break
        if m.start() > at and not (stack and stack[-1].noise):
            text.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                text.append(" ")
            if any(e.tag == tag for e in stack):
                if tag in BLOCKS:
                    flush()
                elif tag in ("td", "th"):
                    text.append(" ")
                while stack.pop().tag != tag:
                    pass
                outer = list(stack)
            elif tag in BLOCKS:
                flush()
            continue
        if tag in HIDDEN:
            low = low or page.lower()
            close = low.find(f"</{tag}", at) if len(low) == end else page.find(f"</{tag}", at)
            if close < 0:
                if not m[3].endswith("/"):
                    at = end
                continue
            at = page.find(">", close)
            at = end if at < 0 else at + 1
            continue
        if tag in VOID:
            if tag in ("br", "wbr", "img", "input"):
                text.append(" " if tag != "wbr" else "")
            elif tag == "hr":
                flush()
            continue
        if tag in BLOCKS:
            flush()
        elif tag in ("td", "th"):
            text.append(" ")
        if tag in ENDS_P and any(e.tag == "p" for e in stack):
            while stack.pop().tag != "p":
                pass
        if tag in SELF_ENDING:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag in SELF_ENDING[tag]:
                    break
                if stack[k].tag == tag or (tag in ("dt", "dd") and stack[k].tag in ("dt", "dd")) or (tag in ("td", "th") and stack[k].tag in ("td", "th")):
                    del stack[k:]
                    break
        above = stack[-1] if stack else None
        path, noise, main, plain, hint = _style(above, tag, m[3])
        e = Element(tag, path, noise, main, plain, hint, len(children))
        children.append([])
        if above:
            children[above.number].append(path)
        stack.append(e)
        if tag in BLOCKS:
            outer = list(stack)
    flush()
    return blocks, children


def _header_line(elements: list[Element]) -> bool:
    """Inside an article's own header only headings are text."""
    inside = False
    for e in elements:
        inside = inside or e.tag == "header" and e.main
    return inside and elements[-1].tag not in ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup")


def main_text(page: str | None, low: set[int]) -> str:
    """The page's main text without the branches whose paths are in ``low``; a negative number removes the path only where its name hints at boilerplate."""
    if not page:
        return ""
    inside, beside, story = [], [], 0
    for at, (text, elements) in enumerate(parse(page)[0]):
        if any(not e.plain and (e.path in low or e.hint and -e.path in low) for e in elements) or _header_line(elements):
            continue
        if elements and elements[-1].main:
            inside.append((at, text))
        else:
            beside.append((at, text))
            story += len(text) if elements and elements[-1].tag == "p" else 0
    factor, least = TEASER
    if not inside or story >= least and story >= factor * sum(len(t) for _, t in inside):
        inside = sorted(inside + beside)
    return "\n".join(t for _, t in inside)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: how often it shows a node (host, path) with some presentation and some content; ``lead`` is 1 in one row of each page and path.  Equal pages give equal rows."""
    for b in batches:
        counts: dict[tuple[str, int, int, int, int], int] = {}
        leads: list[int] = []
        done: set[tuple[str, int]] = set()
        for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            if not page:
                continue
            name = xxhash.xxh3_64_intdigest(page.encode("utf-8", "surrogatepass")) - 2**63
            if (host, name) in done:
                continue
            done.add((host, name))
            blocks, children = parse(page)
            text: dict[int, list[str]] = {}
            known: dict[int, Element] = {}
            for t, elements in blocks:
                for e in elements:
                    if not e.plain:
                        text.setdefault(e.number, []).append(t)
                        known[e.number] = e
            paths: set[int] = set()
            for number, parts in text.items():
                kids = children[number]
                path = known[number].path
                look = xxhash.xxh3_64_intdigest(repr([k for i, k in enumerate(kids) if not i or kids[i - 1] != k])) >> 1
                k = (host, name, path, look, xxhash.xxh3_64_intdigest("\n".join(parts)) >> 1)
                if k not in counts:
                    leads.append(int(path not in paths))
                    paths.add(path)
                counts[k] = counts.get(k, 0) + 1
        cols = list(zip(*counts, strict=True)) or [(), (), (), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]], pa.array(list(counts.values()), pa.int64()), pa.array(leads, pa.int64())],
                                         ["host", "page", "path", "look", "content", "n", "lead"])


def style_tree(pages: DataFrame, evidence: float = EVIDENCE, content_weight: float = CONTENT_WEIGHT) -> DataFrame:
    """``(host, path, seen, importance)`` of every node of the hosts' style trees, from ``(host, html)`` rows.

    Equal pages of a host count once.  With ``seen`` showings of a node, of which n_i
    show variant i, the entropy is log(seen) - sum(n_i log n_i) / seen; divided by
    log(seen) it lies in 0 to 1.  What few pages say is drawn towards 1: the importance
    is the mean over the pages that show the node and ``evidence`` more of importance 1.
    """
    nodes = pages.mapInArrow(_nodes, "host string, page long, path long, look long, content long, n long, lead long").dropDuplicates(["host", "page", "path", "look", "content"])
    both = nodes.select("host", "path", "n", "lead", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("look").alias("v")), F.struct(F.lit(1).alias("k"), F.col("content").alias("v")))).alias("x"))
    variants = both.groupBy("host", "path", "x.k", "x.v").agg(F.sum("n").alias("n"), F.sum("lead").alias("lead"))
    weight = F.when(F.col("k") == 1, content_weight).otherwise(1 - content_weight)
    sums = variants.groupBy("host", "path").agg(
        F.sum(F.when(F.col("k") == 1, F.col("n"))).alias("seen"), F.sum(F.when(F.col("k") == 1, F.col("lead"))).alias("on"),
        F.sum(weight * F.col("n") * F.log(F.col("n").cast("double"))).alias("s"))
    entropy = 1 - F.col("s") / F.col("seen") / F.log(F.col("seen").cast("double"))
    return sums.where("seen > 1").select("host", "path", "seen", ((F.col("on") * entropy + evidence) / (F.col("on") + evidence)).alias("importance"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", low: float = LOW, evidence: float = EVIDENCE) -> tuple[DataFrame, str]:
    """``pages`` plus a column with the main text; returns the frame and the column's name.

    Null, empty or text-free pages give the empty string.  Pages without a host
    share one tree.  Repeated pages of a host give equal texts and count once in its
    tree, so copies change no text.  No page is cut, whatever its length.
    """
    host, bad, name = fresh("host", pages), fresh("low", pages), fresh("main_text", pages)
    tree = style_tree(pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")), evidence)
    signed = F.when(F.col("importance") < low, F.col("path")).otherwise(-F.col("path"))
    poor = tree.where(F.col("importance") < max(low, NAMED_LOW if low > 0 else low)).groupBy(F.col("host").alias(f"{host}_of")).agg(F.collect_set(signed).alias(bad))
    poor = checkpointed(poor)
    listed = poor.agg(F.coalesce(F.sum(F.size(bad) * 8 + F.octet_length(f"{host}_of") + 32), F.lit(0))).first()[0]
    rows = pages.withColumn(host, host_of(F.col(url)))
    if listed <= BROADCAST:
        met = rows.join(F.broadcast(poor), F.col(host) == F.col(f"{host}_of"), "left").drop(f"{host}_of", host)
    else:  # pages of one host are dealt over several tasks, its list goes to each
        salt = fresh("salt", pages)
        rows = rows.withColumn(salt, F.pmod(F.xxhash64(html), F.lit(SALTS)))
        poor = poor.withColumn(f"{salt}_of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        met = rows.join(poor, (F.col(host) == F.col(f"{host}_of")) & (F.col(salt) == F.col(f"{salt}_of")), "left").drop(f"{host}_of", host, salt, f"{salt}_of")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(bad)
            texts = [main_text(p, set(x or ())) for p, x in zip(b.column(html).to_pylist(), b.column(at).to_pylist(), strict=True)]
            keep = [i for i in range(b.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], pa.array(texts, pa.string())], [*[b.schema.names[i] for i in keep], name])

    from pyspark.sql.types import StringType, StructField, StructType
    return met.mapInArrow(run, StructType([*pages.schema.fields, StructField(name, StringType())])), name
