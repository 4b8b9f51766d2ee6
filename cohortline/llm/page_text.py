"""Main text of web pages by the tokens that the pages of a host share.

A page is read as tokens: tags with the path of blocks they are in, and blocks of
text with theirs. For each host and token the pages, the times and a fingerprint
of the occurrence vector (the times on every page) are added up, a partial
aggregate however many pages a host has.

Tokens that occur exactly once on a page, on most pages of the host that hold any,
are the root class. Its tokens count on a page as far as they come in the common
order; what lies between two of them is a slot. Tokens with equal vectors and more
times (items of a menu) form the other classes. Each page is then held against
them: a class is ordered where its tokens come in turns, and nested where each
turn lies in one slot of the root or of another class, the same one every time. A
class that is both on most of its pages is valid, if the class it lies in is.

Template text outside the article is dropped, slots in menus, headers, footers,
adverts, forms, comments and the like are dropped by the tags, roles and names of
the blocks around them, and what the remaining slots hold is the text: of the
article where there is one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm.common import BROADCAST_BYTES, table
from cohortline.plans.durable import freeze

# Text on every page of a host is template only where the host has so many pages.
LEAST_PAGES = 8

# HTML element names, ARIA roles and customary block names.
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "textarea", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details",
    "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "head", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "ol",
    "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
          "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
SIDE_TAGS = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "search", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}
SIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disclaimer",
    "discussion", "disqus", "footer", "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notices", "notification", "overlay", "pager", "pagination", "popup", "promo", "promotion",
    "recommended", "related", "replies", "reply", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets",
}
# Words that may stand beside a side name in one class or id.
NEUTRAL = {"area", "bar", "block", "box", "container", "inner", "item", "list", "outer", "section", "slot", "wrap", "wrapper"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


def _is_side(name: str) -> bool:
    """Whether a whole class or id names a side matter, as ``ad`` and ``cookie-notice`` do and ``no-sidebar`` does not."""
    parts = set(_SPLIT.split(name)) - {""}
    return not parts.isdisjoint(SIDE_NAMES) and parts <= SIDE_NAMES | NEUTRAL


class Block:
    """An open element: its place in the path, and whether it holds the article or a side matter.

    ``doubted`` is an article whose own name or wrapper has a side name.
    """

    __slots__ = ("tag", "path", "fixed", "named", "side", "article", "doubted")

    def __init__(self, tag: str, attributes: str, parent: Block | None) -> None:
        label, classes, ids, role = tag, [], [], ""
        for name, *values in _NAMES.findall(attributes) if attributes else ():
            value = "".join(values).lower()
            if name.lower() == "role":
                role = value.strip()
            else:
                (ids if name.lower() == "id" else classes).extend(value.split())
                label += f".{value}"
        self.tag = tag
        self.path = f"{parent.path}/{label}" if parent else label
        inside = parent is not None and parent.article
        self.article = inside or tag in ("article", "main") or role in ("main", "article")
        self.fixed = (
            (parent is not None and parent.fixed)
            or tag in SIDE_TAGS
            or role in SIDE_ROLES
            or (tag == "header" and not inside)
            or bool(attributes and _HIDDEN.search(attributes))
        )
        # Inside the article an id is an anchor, and a heading is its text.
        names = classes if inside else classes + ids
        if tag in ("html", "body") or (inside and tag in HEADINGS):
            names = []
        named = (parent is not None and parent.named) or any(map(_is_side, names))
        begins = self.article and not inside
        self.doubted = (inside and parent.doubted) or (begins and named)
        self.named = named and not begins
        self.side = self.fixed or self.named


def tokens(page: str) -> Iterator[tuple[str, Block | None, str]]:
    """``(token, block, text)`` in page order; text is empty for tags."""
    root = Block("", "", None)
    stack, held, at = [root], [], 0

    def text() -> Iterator[tuple[str, Block, str]]:
        if held:
            said = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if said:
                yield f"{stack[-1].path} {said}", stack[-1], said

    while at < len(page):
        found = _TOKEN.search(page, at)
        if not found:
            held.append(page[at:])
            break
        if found.start() > at:
            held.append(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:
            continue
        closing, attributes = found[1] or found[4], found[3] or found[6] or ""
        if tag in RAW:
            if not closing:
                end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag == "br":
            held.append(" ")
        if tag not in BLOCKS:
            continue
        yield from text()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    yield f"/{stack[i].path}", stack[i], ""
                    del stack[i:]
                    break
            continue
        # An open paragraph, item or cell ends where another begins.
        ends = CLOSES.get(tag, {"p"})
        while len(stack) > 1 and stack[-1].tag in ends:
            stack.pop()
        stack.append(Block(tag, attributes, stack[-1]))
        yield stack[-1].path, stack[-1], ""
    yield from text()


def _key(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "replace")) - (1 << 63)


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(host.alias("host"), "page_id", "url", "html")


def vectors(pages: DataFrame) -> DataFrame:
    """``host, token, n, place, times, high, low``: pages, sum of first places, times and vector of each token.

    ``high`` and ``low`` are sums over the pages of a hash of the page and the times on it.
    """

    def occurrences(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held: dict[tuple[str, int], list[int]] = {}
            for host, page in zip(part["host"], part["html"], strict=True):
                host, page = host.as_py(), page.as_py() or ""
                order: dict[int, int] = {}
                counts: Counter[int] = Counter()
                for place, (token, block, said) in enumerate(tokens(page)):
                    # Text of the article is never template, even where all pages share it.
                    if said and block.article:
                        continue
                    key = _key(token)
                    counts[key] += 1
                    order.setdefault(key, place)
                # Token 0 stands for the page, if it holds anything.
                if counts:
                    counts[0] = 1
                seed = xxhash.xxh64_intdigest(page.encode("utf-8", "replace"))
                marks = {c: xxhash.xxh64_intdigest(c.to_bytes(8, "little"), seed) for c in set(counts.values())}
                for key, count in counts.items():
                    one = held.setdefault((host, key), [0, 0, 0, 0, 0])
                    one[0] += 1
                    one[1] += order.get(key, -1)
                    one[2] += count
                    one[3] += marks[count] >> 32
                    one[4] += marks[count] & 0xFFFFFFFF
            if held:
                columns = [[h for h, _ in held], [k for _, k in held], *zip(*held.values(), strict=True)]
                types = [pa.string(), *[pa.int64()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["host", "token", "n", "place", "times", "high", "low"]
    rows = pages.select("host", "html").mapInArrow(
        occurrences, "host string, token long, n long, place long, times long, high long, low long"
    )
    return freeze(rows.groupBy("host", "token").agg(*[F.sum(n).alias(n) for n in names[2:]]))


def equal_classes(pages: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """``host, template, classes``: the root class of every host and those of equal vectors, in the common order.

    All lists of a host together are bounded by twice the mean number of tokens of its pages.
    """
    found = vectors(pages)
    root = found.filter("token = 0").select("host", F.col("n").alias("pages"))
    roots = root.filter(F.col("pages") >= least)
    # An odd page or two, cut short or built in another way, do not undo the template.
    shared = found.filter(f"token <> 0 and n >= {least}").join(roots, "host").filter("2 * n > pages")
    placed = shared.withColumn("place", F.col("place") / F.col("n"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("place", "token"))), lambda t: t["token"])
    once = placed.filter("times = n").groupBy("host").agg(in_order.alias("template"))
    # A class of one token says nothing about an order.
    equal = placed.filter("times > n").groupBy("host", "n", "times", "high", "low").agg(in_order.alias("tokens"))
    others = equal.filter("size(tokens) > 1").groupBy("host").agg(F.sort_array(F.collect_list("tokens")).alias("classes"))
    none = F.array()
    return once.join(others, "host", "full").select(
        "host",
        F.coalesce("template", none.cast("array<long>")).alias("template"),
        F.coalesce("classes", none.cast("array<array<long>>")).alias("classes"),
    )


def templates(pages: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """``host, template``: the root class of every host, in the common order."""
    return equal_classes(pages, least).select("host", "template")


class Template:
    """The classes of a host. ``nested`` has, for each class, the class and slot it lies in, or null if invalid.

    Class -1 is the root. Without ``nested`` all classes are followed wherever they lie.
    """

    def __init__(
        self,
        root: list[int] | None = None,
        classes: list[list[int]] | None = None,
        nested: list[tuple[int, int] | None] | None = None,
    ) -> None:
        self.rank = {key: i for i, key in enumerate(root or ())}
        self.sizes = [len(c) for c in classes or ()]
        self.places = nested
        self.members = {
            key: (c, i) for c, some in enumerate(classes or ()) if self.valid(c) for i, key in enumerate(some)
        }

    def valid(self, c: int) -> bool:
        """Whether a class and all that it lies in are valid."""
        seen: set[int] = set()
        while self.places is not None and c >= 0:
            if c in seen or self.places[c] is None:
                return False
            seen.add(c)
            c = self.places[c][0]
        return True


class Walk:
    """One page held against a template, token by token.

    ``inside`` has the places where turns of a class began, ``bad`` the classes
    that came out of order or overlap another.
    """

    def __init__(self, template: Template) -> None:
        self.template, self.slot = template, -1
        # Classes whose turn is not over, from the outside, and the token that each waits for.
        self.open: list[list[int]] = []
        self.inside: dict[int, set[tuple[int, int]]] = {}
        self.bad: set[int] = set()

    def step(self, key: int) -> bool:
        """Whether the next token belongs to the template."""
        rank = self.template.rank.get(key)
        if rank is not None and rank > self.slot:
            # The next token of the root: a slot ends, another begins.
            self.end()
            self.slot = rank
            return True
        found = self.template.members.get(key)
        if found is None:
            return False
        c, i = found
        level = next((k for k, (other, _) in enumerate(self.open) if other == c), None)
        if i == 0:
            place = tuple(self.open[-1]) if self.open else (-1, self.slot)
            if level is not None:
                self.bad.add(c)
                return False
            if self.template.places is not None and self.template.places[c] != place:
                return False
            self.inside.setdefault(c, set()).add(place)
            self.open.append([c, 1])
            return True
        if level is None or self.open[level][1] != i:
            self.bad.add(c)
            return False
        # What began inside and is not over overlaps.
        self.end(level + 1)
        self.open[level][1] += 1
        if self.open[level][1] == self.template.sizes[c]:
            del self.open[level:]
        return True

    def end(self, level: int = 0) -> None:
        """Close what is open from a level on."""
        self.bad.update(c for c, _ in self.open[level:])
        del self.open[level:]


def nested_classes(hosted: DataFrame, found: DataFrame) -> DataFrame:
    """``host, nested``: for each class of ``found`` the class and slot it lies in, or null where it is not valid."""

    def walk(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            held: Counter[tuple[str, int, int, int]] = Counter()
            known: dict[str, Template] = {}
            for i, host in enumerate(part["host"].to_pylist()):
                if host not in known:
                    known[host] = Template(part["template"][i].as_py(), part["classes"][i].as_py())
                page = Walk(known[host])
                for token, block, said in tokens(part["html"][i].as_py() or ""):
                    if not (said and block.article):
                        page.step(_key(token))
                page.end()
                for c in page.bad | set(page.inside):
                    one = page.inside.get(c, ())
                    held[host, c, *(next(iter(one)) if c not in page.bad and len(one) == 1 else (-2, -1))] += 1
            if held:
                columns = [*zip(*held, strict=True), list(held.values())]
                types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["host", "class", "parent", "slot", "n"]
    joined = with_host(hosted.select("host", "html"), found.filter("size(classes) > 0"), "inner")
    seen = joined.mapInArrow(walk, "host string, class int, parent int, slot int, n long")
    places = seen.groupBy("host", "class", "parent", "slot").agg(F.sum("n").alias("n"))
    best = places.groupBy("host", "class").agg(F.max(F.struct("n", "parent", "slot")).alias("best"), F.sum("n").alias("pages"))
    valid = best.filter("2 * best.n > pages and best.parent > -2")
    by_class = F.map_from_entries(F.collect_list(F.struct("class", F.struct("best.parent", "best.slot"))))
    listed = valid.groupBy("host").agg(by_class.alias("places"))
    return found.join(listed, "host", "left").select(
        "host", "template", "classes",
        F.transform("classes", lambda _, i: F.try_element_at("places", i)).alias("nested"),
    )


def with_host(hosted: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``hosted`` with the lists of its hosts."""
    lists = F.coalesce(F.size("template"), F.lit(0)) + F.coalesce(F.size(F.flatten("classes")), F.lit(0))
    size = found.agg(F.coalesce(F.sum(lists * 16 + F.length("host") * 4 + 64), F.lit(0))).first()[0]
    # Beyond the bound adaptive execution splits hosts with many pages.
    return hosted.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", how)


def page_text(page: str | None, template: Template | None = None) -> str:
    """The main text of a page, given the template of its host."""
    walk = Walk(template or Template())
    slots: list[tuple[Block, str]] = []
    article, sure = False, False
    for token, block, said in tokens(page or ""):
        # Text of the article is never template, even where all pages share it.
        if not (said and block.article) and walk.step(_key(token)):
            continue
        if said and not block.side:
            slots.append((block, said))
            article = article or block.article
            sure = sure or (block.article and not block.doubted)
    # Teasers and comments are articles too: those under a side name count only where there is no other.
    kept = [said for block, said in slots if (block.article or not article) and not (sure and block.doubted)]
    return " ".join(kept)


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id, url, text``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are ignored.
    Null and empty pages have empty text; pages without a host share one. Hosts
    of fewer than ``LEAST_PAGES`` pages have no template, so only tags, roles and
    names decide. Repeated rows give repeated results.
    """
    hosted = _with_host(pages)
    found = freeze(equal_classes(hosted))
    joined = with_host(hosted, freeze(nested_classes(hosted, found)), "left")

    def extract(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            known: dict[str, Template] = {}
            said = []
            for i, host in enumerate(part["host"].to_pylist()):
                if host not in known:
                    places = part["nested"][i].as_py() or []
                    nested = [p and (p["parent"], p["slot"]) for p in places]
                    known[host] = Template(part["template"][i].as_py(), part["classes"][i].as_py(), nested)
                said.append(page_text(part["html"][i].as_py(), known[host]))
            yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(said, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("host", "page_id", "url", "html", "template", "classes", "nested").mapInArrow(
        extract, f"page_id {kind}, url string, text string"
    )


def op1_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
