"""Main text of web pages by union-free regular expressions of their hosts.

Pages of one host come from a few templates.  A wrapper is a regular expression
without unions over tags and text slots that all pages of a host match: an element holds
a sequence of elements, text slots (``#``) and groups, and each of these may be optional
(``?``), repeated (``+``) or both (``*``).

1.  One map turns every page into an expression of its own: repeated neighbours are
    folded into repeated groups, texts into slots.  Equal expressions of a host are
    counted once, before they are shuffled.
2.  A host's expressions are aligned one after the other.  What only one side has
    becomes optional; a sequence that the other side repeats becomes a repeated group.
    The expressions of a host are dealt to ``DEAL`` tasks, whose wrappers are aligned at last.
3.  Every page is matched with its host's wrapper; each block of text gets its slot.
4.  Slots are judged over all pages of the host: text that is the same on all pages
    belongs to the template, and slots that hold links only to menus.

Elements that are named as menus, headers, footers, sidebars, notices, adverts, forms or
comments by tag, role, class or id never hold main text.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, ship, small_batches, text_or_empty, written

#: Tasks among which the expressions of a host are dealt first.
DEAL = 64
#: Longest group that is looked for when repeats are folded.
LONGEST_GROUP = 8
#: Elements nested deeper than this count as part of the one at this depth.
DEPTH = 100
#: Cells of the alignment table; longer sequences are aligned by longest common stretches.
CELLS = 250_000
#: Different pages of a host on which a text has to be the same to be of the template.
TEMPLATE_PAGES = 8
#: Share of a slot's characters that stand in links, from which it is a menu.
MENU_LINKS = 0.8

# HTML element names by their role, and words that name page furniture.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rp rt s"
    " samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "script style textarea title xmp iframe noembed noframes head noscript template svg math canvas object audio"
    " video map select button datalist".split())
FURNITURE_TAGS = frozenset("nav header footer aside form dialog menu search fieldset".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion"
    " banner nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside header masthead"
    " topbar footer bottombar cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social related recommended comment comments disqus reply replies"
    " respond form search searchbox widget widgets pagination pager toolbar skip".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}}
HOLDERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
           "option": {"select"}}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]{0,4096}"|'[^']{0,4096}')*+)>"""
    r"""|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Element:
    """An element of a page; ``children`` are elements and ``(text, characters in links)``."""

    __slots__ = ("tag", "label", "furniture", "children")

    def __init__(self, tag: str, label: str, furniture: bool):
        self.tag, self.label, self.furniture, self.children = tag, label, furniture, []


def element(tag: str, attributes: str) -> Element:
    """An element with its label: tag, class and id without what looks made by a machine."""
    names, furniture = [], tag in FURNITURE_TAGS
    if attributes.strip():
        found = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "")
                 for m in ATTRIBUTE.finditer(attributes)}
        names = [w for k in ("class", "id") for w in found.get(k, "").split() if not re.search(r"\d", w)]
        if tag not in ("html", "body", "main", "article"):
            words = {w.lower() for n in found.get("class", "").split() + found.get("id", "").split()
                     for w in NAME_WORD.findall(n)}
            furniture = (furniture or not words.isdisjoint(FURNITURE_WORDS) or "hidden" in found
                         or found.get("role", "").lower() in FURNITURE_ROLES
                         or found.get("aria-hidden", "").lower() == "true")
    return Element(tag, ".".join([tag, *names]), furniture)


def page_tree(page: str) -> Element:
    """The elements and blocks of text of a page; inline markup and hidden elements are left out."""
    root = Element("", "", False)
    stack, pieces, linked, links, at = [root], [], 0, 0, 0
    size = len(page)

    def close_block() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                stack[-1].children.append((text, min(linked, len(text))))
            pieces, linked = [], 0

    while at < size:
        m = TOKEN.search(page, at)
        end = m.start() if m else size
        if end > at:
            pieces.append(page[at:end])
            if links:
                linked += end - at
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = (m[1] if m[2] else m[4]) == "/", (m[3] if m[2] else m[6])
        if tag in HIDDEN and not closing:
            if not attributes.endswith("/"):
                at = after_hidden(page, at, tag)
            pieces.append(" ")
        elif tag == "br":
            pieces.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif closing:
            if tag in INLINE and stack[-1].tag != tag:
                continue
            close_block()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                del stack[depth:]
        else:
            new = element(tag, attributes)
            if tag in INLINE and not new.furniture:
                continue
            close_block()
            if tag in VOID or tag in HIDDEN:
                continue
            if tag not in INLINE:
                if stack[-1].tag == "p":
                    stack.pop()
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in HOLDERS.get(tag, ()):
                        break
                    if stack[i].tag in CLOSED_BY.get(tag, ()):
                        del stack[i:]
                        break
            if len(stack) < DEPTH and not attributes.endswith("/"):
                stack[-1].children.append(new)
                stack.append(new)
    close_block()
    return root


def after_hidden(page: str, at: int, tag: str) -> int:
    """Where a hidden element ends; the page's end if it is not closed."""
    if tag in RAW:
        found = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(page, at)
        return found.end() if found else len(page)
    depth = 1
    for m in re.compile(f"<(/?){tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).finditer(page, at):
        depth += -1 if m[1] else not m[0].endswith("/>")
        if not depth:
            return m.end()
    # not closed: the body follows a head without an end
    body = re.compile(r"<body[\s>]", re.I).search(page, at) if tag == "head" else None
    return body.start() if body else len(page)


# ------------------------------------------------------------------ expressions
# An expression is ``[label, quantifier, parts]``; slots have the label "#", groups
# one that starts with "(".
def joined(a: str, b: str, repeated: bool = False) -> str:
    """The quantifier that allows for both."""
    optional = "?" in a + b or "*" in a + b
    repeated = repeated or "+" in a + b or "*" in a + b
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def expression(node: Element) -> list:
    """A page's own expression."""
    parts = [expression(c) if isinstance(c, Element) else ["#", "", []] for c in node.children]
    return [node.label, "", folded(parts)]


def folded(parts: list) -> list:
    """The sequence with repeated neighbours as repeated groups, shortest groups first."""
    for size in range(1, LONGEST_GROUP + 1):
        if len(parts) < 2 * size:
            break
        labels = [p[0] for p in parts]
        out, i = [], 0
        while i < len(parts):
            times = 1
            while labels[i:i + size] == labels[i + times * size:i + (times + 1) * size]:
                times += 1
            if times == 1 or i + times * size > len(parts):
                out.append(parts[i])
                i += 1
                continue
            first = parts[i:i + size]
            for t in range(1, times):
                again = parts[i + t * size:i + (t + 1) * size]
                first = [merged(a, b) for a, b in zip(first, again, strict=True)]
            if size == 1:
                [one] = first
                out.append([one[0], joined(one[1], one[1], True), one[2]])
            else:
                out.append(group(first, "+"))
            i += times * size
        parts = out
    return parts


def group(parts: list, quantifier: str) -> list:
    return ["(" + " ".join(p[0] for p in parts) + ")", quantifier, parts]


def merged(a: list, b: list) -> list:
    """An expression for whatever one of two with the same label allows."""
    if a == b:
        return a
    return [a[0], joined(a[1], b[1]), aligned(a[2], b[2])]


def grouped_like(parts: list, other: list) -> list:
    """Sequences that are a repeated group on the other side become one here."""
    for label, _, inner in other:
        if not label.startswith("(") or any(p[0] == label for p in parts):
            continue
        labels, size, out, i = [p[0] for p in inner], len(inner), [], 0
        while i < len(parts):
            if [p[0] for p in parts[i:i + size]] == labels:
                out.append(group(parts[i:i + size], ""))
                i += size
            else:
                out.append(parts[i])
                i += 1
        parts = out
    return parts


def aligned(xs: list, ys: list) -> list:
    """One sequence of parts for two; what only one has becomes optional."""
    xs, ys = grouped_like(xs, ys), grouped_like(ys, xs)
    out, i, j = [], 0, 0
    for a, b in [*common(tuple(x[0] for x in xs), tuple(y[0] for y in ys)), (len(xs), len(ys))]:
        out += [[p[0], joined(p[1], "?"), p[2]] for p in (*xs[i:a], *ys[j:b])]
        if a < len(xs):
            out.append(merged(xs[a], ys[b]))
        i, j = a + 1, b + 1
    return folded(out)


def common(a: tuple, b: tuple) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    head = [(i, i) for i in range(start)]
    x, y = a[start:], b[start:]
    if len(x) * len(y) > CELLS:
        from difflib import SequenceMatcher

        blocks = SequenceMatcher(None, x, y, autojunk=False).get_matching_blocks()
        return head + [(start + m.a + k, start + m.b + k) for m in blocks for k in range(m.size)]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            head.append((start + i, start + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return head


def written_out(wrapper: list) -> str:
    """The wrapper as a regular expression over tags and ``#``."""
    label, quantifier, parts = wrapper
    inner = "".join(map(written_out, parts))
    if label == "#":
        return "#" + quantifier
    if label.startswith("("):
        return f"({inner}){quantifier}"
    body = f"<{label}>{inner}</{label.split('.')[0]}>" if label else inner
    return f"({body}){quantifier}" if quantifier else body


# ----------------------------------------------------------------------- matching
def places_in(parts: list, path: str) -> list[tuple[str, list]]:
    """The parts with their paths; groups are opened."""
    out = []
    for i, part in enumerate(parts):
        here = f"{path}.{i}"
        out += places_in(part[2], here) if part[0].startswith("(") else [(here, part)]
    return out


def matched(children: list, parts: list, path: str) -> Iterator[tuple[str | None, list]]:
    """(path, parts) in the wrapper of each child; (None, []) where it has no such label.

    Runs along the sequence, and back to the start of a repeated group where needed.
    """
    places = places_in(parts, path)
    at: dict[str, list[int]] = {}
    for i, (_, part) in enumerate(places):
        at.setdefault(part[0], []).append(i)
    here = 0
    for child in children:
        found = at.get(child.label if isinstance(child, Element) else "#")
        if not found:
            yield None, []
            continue
        here = next((i for i in found if i >= here), found[0])
        yield places[here][0], places[here][1][2]


def holds(node: Element, tags: tuple[str, ...]) -> bool:
    return any(isinstance(c, Element) and (c.tag in tags or holds(c, tags)) for c in node.children)


def content_roots(root: Element) -> tuple[list[Element], bool]:
    """(elements that hold the main text, are they named so): articles, or else main
    elements, or else the whole page."""
    for tag in ("article", "main"):
        found: list[Element] = []
        todo = [root]
        while todo:
            node = todo.pop()
            if node.tag == tag:
                found.append(node)
            elif not node.furniture or holds(node, (tag,)):
                todo += [c for c in node.children if isinstance(c, Element)]
        if found:
            return found, True
    return [root], False


def text_blocks(page: str, wrapper: list) -> list[tuple[str, str, int]]:
    """(slot, text, characters in links) of the blocks that may be main text, in page order.

    The slot is the path in the wrapper, empty where the wrapper has none; with a ``!``
    in front where links do not tell a menu, inside an article or main element.
    """
    tree = page_tree(page)
    roots, named = content_roots(tree)
    chosen = set(map(id, roots))
    out: list[tuple[str, str, int]] = []

    def walk(node: Element, parts: list, path: str, inside: bool) -> None:
        inside = inside or id(node) in chosen
        for child, (place, inner) in zip(node.children, matched(node.children, parts, path), strict=True):
            if isinstance(child, Element):
                if not child.furniture or not inside and holds_any(child):
                    walk(child, inner, place or "?", inside)
            elif inside:
                slot = place if place and "?" not in place else ""
                out.append((("!" if named else "") + slot if slot else "", *child))

    def holds_any(node: Element) -> bool:
        return named and (id(node) in chosen or any(
            isinstance(c, Element) and holds_any(c) for c in node.children))
    walk(tree, wrapper[2], "", False)
    return out


# ------------------------------------------------------------------------ the job
def host_of(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def aligned_by(rows: DataFrame, *keys: str) -> DataFrame:
    """``host, wrapper``: the expressions of each key, aligned one after the other.

    They come in the order of their text, so the wrapper does not depend on how rows are dealt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, wrapper = None, []
        for batch in batches:
            out = []
            for *key, text in zip(*(batch.column(c).to_pylist() for c in (*keys, "wrapper")), strict=True):
                if key != current:
                    if current is not None:
                        out.append((current[0], json.dumps(wrapper)))
                    current, wrapper = key, json.loads(text)
                else:
                    wrapper = merged(wrapper, json.loads(text))
            if out:
                yield pa.RecordBatch.from_pydict({"host": [h for h, _ in out], "wrapper": [w for _, w in out]})
        if current is not None:
            yield pa.RecordBatch.from_pydict({"host": [current[0]], "wrapper": [json.dumps(wrapper)]})
    return (rows.select(*keys, "wrapper").repartition(*keys).sortWithinPartitions(*keys, "wrapper")
            .mapInArrow(run, "host string, wrapper string"))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (JSON) of all hosts of ``pages`` (host, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([json.dumps(expression(page_tree(p)))
                                                 for p in batch.column("html").to_pylist()], pa.string())],
                ["host", "wrapper"])
    own = pages.select("host", "html").mapInArrow(run, "host string, wrapper string").distinct()
    dealt = own.withColumn("deal", F.pmod(F.xxhash64("wrapper"), F.lit(DEAL)))
    return aligned_by(aligned_by(dealt, "host", "deal"), "host")


def wrapper_expressions(pages: DataFrame) -> DataFrame:
    """``host, expression``: the wrapper of every host, written as a regular expression."""
    small_batches(pages.sparkSession)
    base = columns_of(pages, "url", "html").select(host_of("url").alias("host"), text_or_empty("html").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([written_out(json.loads(w)) for w in
                                                 batch.column("wrapper").to_pylist()], pa.string())],
                ["host", "expression"])
    return host_wrappers(base).mapInArrow(run, "host string, expression string")


BLOCKS = "array<struct<slot:string,text:string,linked:long>>"


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    The main text of ``html``: blocks in page order, joined by line ends, white space
    inside a block as one blank, character references decoded.  Of a page with ``article``
    elements only these count, else of one with ``main`` elements these, else the whole page;
    always without elements that are hidden or named as page furniture.  Text that is the same
    on all pages of a host that have its slot, at least ``TEMPLATE_PAGES`` different ones, is the template's and
    left out (unless the host has no other text); so are, outside articles and main
    elements, slots that hold links nearly alone.

    Null and empty pages give an empty text with 0 characters; pages without a host
    belong together.  Pages are read whole, however long; elements nested more than
    ``DEPTH`` deep count as part of the one at that depth, with all their text.  Repeated rows and null ids give a row
    each; an empty table gives none; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    base = columns_of(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), "url", host_of("url").alias("host"), text_or_empty("html").alias("html"))
    wrappers = written(host_wrappers(base))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("slot", pa.string()), ("text", pa.string()), ("linked", pa.int64())]))
        known: dict[str, list] = {}
        for batch in batches:
            rows, marks = [], []
            for host, page, text in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "wrapper")),
                                        strict=True):
                if host not in known:
                    if len(known) >= 100:
                        known.clear()
                    known[host] = json.loads(text)
                own = text_blocks(page, known[host])
                rows.append([{"slot": s, "text": t, "linked": n} for s, t, n in own])
                marks.append(zlib.crc32("\n".join(t for _, t, _ in own).encode("utf-8")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(marks, pa.int64()),
                 pa.array(rows, kind)], ["page_id", "url", "host", "page", "blocks"])
    found = written(base.join(wrappers, "host").select("page_id", "url", "host", "html", "wrapper").mapInArrow(
        run, f"page_id long, url string, host string, page long, blocks {BLOCKS}"))
    judged = (found.select("host", "page", F.explode("blocks").alias("b")).select(
        "host", "page", "b.slot", F.xxhash64("b.text").alias("mark"), F.length("b.text").alias("chars"), "b.linked")
        .groupBy("host", "slot").agg(
            (F.min("mark") == F.max("mark")).alias("same"), F.approx_count_distinct("page").alias("pages"),
            F.sum("chars").alias("chars"), F.sum("linked").alias("linked")))
    named = F.col("slot").startswith("!")
    kind = (F.when(F.col("slot") == "", "text")
            .when(~named & (F.col("linked") >= MENU_LINKS * F.col("chars")), "menu")
            .when(F.col("same") & (F.col("pages") >= TEMPLATE_PAGES), "template").otherwise("text"))
    sets = judged.withColumn("kind", kind).groupBy("host").agg(
        F.collect_set(F.when(F.col("kind") == "menu", F.col("slot"))).alias("menus"),
        F.collect_set(F.when(F.col("kind") == "template", F.col("slot"))).alias("templates"),
        F.count_if(F.col("kind") == "text").alias("texts"))
    gone = F.when(F.col("texts") > 0, F.concat("menus", "templates")).otherwise(F.col("menus"))
    drops = written(sets.select("host", gone.alias("gone")).where(F.size("gone") > 0))
    kept = F.filter("blocks", lambda b: F.col("gone").isNull() | ~F.array_contains("gone", b["slot"]))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    out = found.join(drops, "host", "left").select("page_id", "url", text.alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


ship(__name__)
