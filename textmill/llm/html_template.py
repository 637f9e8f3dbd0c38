"""Main text of web pages by template deduction from equivalence classes of tokens.

Tokens are tags and whole text pieces, told apart by their path of open elements. For every host, a token's
occurrence vector (how often it stands in each page) is summed up by a hash that partial aggregates can add up;
tokens with equal vectors form a class. A class nests in the class around its outermost element; members that
lie elsewhere have another role and are left out. Valid classes, nested by path, are the host's template. The class that occurs
once in every page is its root: its elements are the fixed containers, the text of other
tokens fills the slots between them. Of each container the host's pages give the amount of slot text, with and
without links. The main region is the root's article or main element, or else the whole page; containers
that hold mostly links are menus. A second pass takes the
slots of that region from every page, without menus outside articles, without fixed text and without parts that say what they
are by element or class name. Inside articles fixed text goes only with a container that holds nothing else in any page
of the host; a paragraph that all articles share stays among their own. Hosts with fewer than
``FIXED_PAGES`` different pages are too small to tell fixed text.

Null and empty html gives an empty text. A page alone on its host, and one with a null url, is read with its
own template. Hosts may be of any size: gathered by host are sums, and what occurs once in every page. Rows are read each on
its own, repeated ids too; equal pages of a host count once when fixed text is sought. An empty table gives an empty result. Other columns than id, url and html are not read.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import words
from textmill.session import stored

#: Fewest different pages of a host for which a text piece in all pages counts as fixed, share of fixed text beyond
#: which the pages are near copies and none of it counts, and least share of links in a menu.
FIXED_PAGES, COPIES, MENU = 4, 0.5, 0.7
CHUNK = 4 << 20
SALTS = 16

# Elements by role, and words in class names of parts that are no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe object canvas math head textarea select".split())
#: Of these, elements whose content is no markup: without a closing tag they run to the end of the page.
PLAIN = frozenset("script style textarea iframe".split())
#: Elements that a tag ending in "/>" leaves empty.
FOREIGN = frozenset(("svg", "math"))
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split())
CONTAINERS = frozenset("html body main article section div table tbody tr td center".split())
SKIPPED = frozenset("nav footer aside form button dialog menu fieldset".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ARTICLES = ("article", "main")
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar aside "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer cookie cookies consent notice gdpr popup "
    "modal overlay newsletter subscribe signup comment comments commentlist respond replies reactions disqus share sharing social related "
    "recommended widget toolbar topbar masthead alert adbox adslot".split()
)
#: With these, a name made of words in NOISE still says nothing but that.
PART = frozenset("box slot block area section wrapper wrap container inner outer list bar link links button buttons icon icons posts articles stories items form content top bottom left right col column panel post article entry site page blog".split())
#: Wrappers that hold whole pages on some sites, and elements that say what they are.
WRAPPERS = frozenset(("form", "fieldset"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Fixed text in these names what the page's own text beside it is.
LABELS = HEADINGS | frozenset("th td dt caption figcaption summary".split())
#: Share of the page's text, links aside, with which an element is the page, and with which a named notice is.
MOST, NEARLY_ALL = 0.5, 0.9
#: Least share of the text in articles for which a page without region is read from its articles alone.
ARTICLE_TEXT = 0.25
SITE_HEADER = frozenset("header site page top main global".split())
_SCOPES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PARTS = re.compile(r"[a-z]+")


def _closings(html: str, name: str) -> dict[int, int]:
    """Ends of the ``name`` elements that have a closing tag, by where they begin; nested ones are told apart."""
    tag = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?){re.escape(name)}(?=[\s/>])([^>]*)>", re.IGNORECASE | re.DOTALL)
    found: dict[int, int] = {}
    begun: list[int] = []
    for m in tag.finditer(html):
        if m[1]:
            if begun:
                found[begun.pop()] = m.end()
        elif m[1] is not None and not (name in FOREIGN and m[2].endswith("/")):
            begun.append(m.start())
    return found


def pieces(html: str):
    """``(kind, path, text, noise)`` of a page in order: elements that open, line breaks, ends of blocks, text.

    ``path`` is a tuple of open elements, each with its class words; ``noise`` says that the
    place lies in a part which is no article text.
    """
    elements: list[list] = [[-1, "", 0, False, 0, "", 0]]  # the page
    found = list(_parts(html, elements))
    noise = _noise(elements)
    for kind, path, text, at in found:
        yield kind, path, text, noise[at]


def _own_noise(name: str, named: list[str], whole: bool, in_article: bool) -> int:
    """What an element says of itself: 0 nothing, 1 a wrapper or one word of several, 2 a part that is no article text.

    ``whole``: one of its names has no other words than those of notices.
    """
    if name in ("html", "body", *ARTICLES):
        return 0
    if name in SKIPPED:
        return 1 if name in WRAPPERS else 2
    if in_article:
        return 2 if whole and name not in HEADINGS else 0
    if name == "header" or "header" in named and SITE_HEADER.issuperset(named):
        return 2
    return 2 if whole else int(not NOISE.isdisjoint(named))


def _noise(elements: list[list]) -> list[bool]:
    """By element, whether it is no article text, from its names, those around it and its share of the page's text.

    A wrapper, or a part with one telling word among others, is article text if it holds an article or most of the
    page's text. A named part is if it holds an article with most of the text, or a main heading and nearly all text.
    Main elements, and articles with most of the text or with an h1, are text inside any other part.
    """
    for e in reversed(elements):  # from the innermost elements outwards
        if e[1] in ARTICLES:
            e[6] = max(e[6], e[4])
        if e[0] >= 0:
            outer = elements[e[0]]
            outer[4] += e[4]
            outer[5] = min(outer[5] or e[5], e[5] or outer[5])
            outer[6] = max(outer[6], e[6])
    whole = elements[0][4]
    noise: list[bool] = []
    for parent, name, own, _, text, headed, article in elements:
        most = text > MOST * whole
        if own == 1:
            own = not (most or article)
        elif own == 2:
            own = not (article > MOST * whole or name not in SKIPPED and headed and text >= NEARLY_ALL * whole)
        inherited = parent >= 0 and noise[parent] and not (name == "main" or name == "article" and (most or headed == "h1"))
        noise.append(bool(own) or inherited)
    return noise


def _parts(html: str, elements: list[list]):
    """``(kind, path, text, element)`` of a page in order; lists its elements.

    Of an element: its parent, name, what it says of itself, whether it lies in an article, then the text without
    links in it, its first main heading (h1, or else h2), and the text of the largest article in it.
    """
    stack: list[tuple[str, str, int]] = []  # name, name with classes, element
    path: tuple[str, ...] = ()
    at, size = 0, len(html)
    closings: dict[str, dict[int, int]] = {}

    def place() -> int:
        return stack[-1][2] if stack else 0

    def close(keep: int) -> bool:
        nonlocal path
        block = any(name not in INLINE for name, _, _ in stack[keep:])
        del stack[keep:]
        path = path[:keep]
        return block

    while at < size:
        found = _TAG.search(html, at)
        end = found.start() if found else size
        if end > at:
            text = references.unescape(html[at:end])
            if not any(name == "a" for name, _, _ in stack):
                elements[place()][4] += len(text.strip())
            yield "text", path, text, place()
        if not found:
            break
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        if found[1] or found[4]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if close(k):
                        yield "end", path, "", place()
                    break
                if stack[k][0] in ("article", "body") and name in INLINE:
                    break
            continue
        if name == "br":
            yield "break", path, " ", place()
            continue
        if name in RAW:
            if name in PLAIN:
                over = re.compile(f"</{name}\\b[^>]*>", re.IGNORECASE).search(html, at)
                at = over.end() if over else size
            elif not (name in FOREIGN and (found[3] or found[6] or "").endswith("/")):
                if name not in closings:
                    closings[name] = _closings(html, name)
                at = max(at, closings[name].get(found.start(), at))
            yield "end", path, "", place()
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        if name in _SCOPES:
            same, stops = _SCOPES[name]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in stops:
                    break
                if stack[k][0] in same:
                    close(k)
                    break
        if name in VOID:
            if name not in INLINE:
                yield "end", path, "", place()
            continue
        tokens = [(m[1] or m[2] or m[3] or "").lower().split() for m in _NAMES.finditer(found[3] or found[6] or "")]
        split = [_PARTS.findall(t) for names in tokens for t in names]
        named = sorted({w for t in split for w in t})
        whole = any(t and not NOISE.isdisjoint(t) and all(w in NOISE or w in PART for w in t) for t in split)
        parent = place()
        in_article = elements[parent][3] or elements[parent][1] in ARTICLES
        label = ".".join([name, *named])
        elements.append([parent, name, _own_noise(name, named, whole, in_article), in_article, 0, name if name in ("h1", "h2") else "", 0])
        stack.append((name, label, len(elements) - 1))
        path = (*path, label)
        yield "open", path, name, place()


def _tokens(html: str) -> dict[tuple, list]:
    """``[count, slot text, link text]`` of each token: ``(path, "")`` of an element, ``(path, text)`` of a text piece."""
    out: dict[tuple, list] = {}
    for kind, path, text, noise in pieces(html):
        if kind == "open":
            out.setdefault((path, ""), [0, 0, 0])[0] += 1
        elif kind == "text":
            text = " ".join(text.split())
            if not text:
                continue
            own = out.setdefault((path, text), [0, 0, 0])
            own[0] += 1
            if not noise:
                own[1] += len(text)
                link = any(p == "a" or p.startswith("a.") for p in path)
                for k in range(1, len(path) + 1):
                    if path[k - 1].split(".")[0] in CONTAINERS or path[k - 1].split(".")[0] in ("ul", "ol", "dl"):
                        held = out.setdefault((path[:k], ""), [0, 0, 0])
                        held[1] += len(text)
                        held[2] += len(text) * link
    return out


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def hosts(pages: DataFrame) -> DataFrame:
    """Pages with ``host``: that of the url, without port; without a url the page is a host of its own."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    own = F.concat(F.lit("#"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    return pages.select("page_id", "url", "html", F.when(F.coalesce(host, F.lit("")) == "", own).otherwise(host).alias("host"))


_TOKENS = "host string, token long, parent long, path string, vector long, pages long, total long, text long, links long"


def _token_rows(batches):
    for batch in batches:
        names = batch.schema.names
        column = batch.column(names.index("html"))
        for a, b in words.slices(words.byte_sizes(column), CHUNK):
            part = batch.slice(a, b - a)
            sums: dict[tuple, list] = {}
            for host, page, url, html in zip(*(part.column(names.index(c)).to_pylist() for c in ("host", "page_id", "url", "html"))):
                page_hash = _hash(str(page), url or "")
                for (path, text), (count, chars, links) in _tokens(html or "").items():
                    if not count:
                        continue
                    own = "/".join(path)
                    row = sums.setdefault((host, own, text if len(text) < 64 else _hash(text)), [own, text, 0, 0, 0, 0, 0])
                    row[2] = (row[2] + xxhash.xxh3_64_intdigest(count.to_bytes(8, "little"), seed=page_hash)) & 0xFFFFFFFFFFFFFFFF
                    row[3] += 1
                    row[4] += count
                    row[5] += chars
                    row[6] += links
            rows = [
                (host, _signed(_hash(own, text)), _signed(_hash(own.rpartition("/")[0] if not text else own, "")), "" if text else own, _signed(v), n, t, c, k)
                for (host, _, _), (own, text, v, n, t, c, k) in sums.items()
            ]
            columns = list(zip(*rows)) or [()] * 9
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in _TOKENS.split(", ")])


def tokens_of(pages: DataFrame) -> DataFrame:
    """Each host's tokens with their vector's hash, pages, total, text and link text."""
    made = pages.mapInArrow(_token_rows, _TOKENS)
    half = lambda c: F.sum(c.bitwiseAND(F.lit((1 << 31) - 1)))
    vector = F.xxhash64(half(F.col("vector")), half(F.shiftrightunsigned("vector", 32)))  # halves add up without overflow
    return made.groupBy("host", "token").agg(
        F.first("parent").alias("parent"), F.max("path").alias("path"), vector.alias("vector"),
        *[F.sum(c).alias(c) for c in ("pages", "total", "text", "links")],
    )


def valid_classes(tokens: DataFrame) -> DataFrame:
    """Tokens of classes that nest, with ``class`` (equal vectors) and ``members``.

    A class lies in the class around its outermost element. A member whose outer token lies in its own
    class or in that one stays; any other, such as fixed text in one of several links, has another role.
    """
    classed = tokens.withColumn("class", F.xxhash64("vector", "pages", "total"))
    outer = classed.select("host", F.col("token").alias("parent"), F.col("class").alias("outer"))
    nested = classed.join(outer, ["host", "parent"], "left")
    inside = F.coalesce(F.col("outer") == F.col("class"), F.lit(False))
    depth = F.when(F.col("path") != "", F.size(F.split("path", "/"))).otherwise(1 << 20)
    placed = nested.withColumn("around", F.when(~inside, F.coalesce("outer", F.lit(0))))
    top = F.min(F.when(F.col("around").isNotNull(), F.struct(depth.alias("depth"), "around")))
    kinds = placed.groupBy("host", "class").agg(top["around"].alias("top"))
    valid = placed.join(kinds, ["host", "class"]).filter(F.coalesce(F.col("around") == F.col("top"), F.lit(True)))
    members = valid.groupBy("host", "class").agg(F.count("*").alias("members"))
    return valid.drop("outer", "around", "top").join(members, ["host", "class"])


def templates(pages: DataFrame) -> DataFrame:
    """One row per host: ``region`` (path of the main region), ``menus`` (paths), ``fixed`` and ``notices`` (text tokens), and
    ``parts``: the containers inside articles that stand once in every page, with the text of all pages in them.

    All of these occur once in every page, so none is longer than a page.
    """
    # copies of a page say nothing about what is fixed
    copies = pages.groupBy("host", F.xxhash64("html").alias("copy")).agg(F.count("*").alias("n"))
    count = copies.groupBy("host").agg(F.sum("n").alias("host_pages"), F.count("*").alias("distinct_pages"))
    tokens = stored(tokens_of(pages), "tokens").join(count, "host")
    valid = stored(valid_classes(tokens), "classes")
    root = valid.filter((F.col("pages") == F.col("host_pages")) & (F.col("total") == F.col("pages")))
    last = F.element_at(F.split(F.element_at(F.split("path", "/"), -1), r"\."), 1)
    depth = F.size(F.split("path", "/"))
    rank = F.struct((-depth).alias("depth"), F.col("text"), F.col("path"))
    # without such an element all slots belong to the text, wherever they lie
    region = root.filter(last.isin(*ARTICLES) & (F.col("text") > 0)).groupBy("host").agg(F.max(rank)["path"].alias("region"))
    listed = root.filter((F.col("path") != "") & last.isin("ul", "ol", "dl", "div", "table", "section") & (F.col("text") > 0) & (F.col("links") >= MENU * F.col("text")))
    menus = listed.groupBy("host").agg(F.collect_set("path").alias("menus"))
    within = F.exists(F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1), lambda p: F.split(p, r"\.")[0].isin(*ARTICLES))
    held = root.filter((F.col("path") != "") & ~last.isin(*ARTICLES) & (F.col("text") > 0) & within)
    parts = held.groupBy("host").agg(F.collect_list(F.struct("path", "text")).alias("parts"), F.max("host_pages").alias("host_pages"))
    # inside articles a fixed piece often stands in one of many like elements, which is no valid place in the template
    once = (F.col("pages") == F.col("host_pages")) & (F.col("total") == F.col("pages"))
    placed = valid.filter(F.col("path") == "").select("host", "token", F.lit(True).alias("valid"))
    same = tokens.filter((F.col("path") == "") & once & (F.col("distinct_pages") >= FIXED_PAGES)).join(placed, ["host", "token"], "left")
    # where most text is the same the pages are copies with small changes
    every = tokens.groupBy("host").agg(F.max(F.when(F.col("path") != "", F.col("text"))).alias("every"))
    alike = same.groupBy("host").agg(
        F.collect_set(F.when(F.col("valid"), F.col("token"))).alias("fixed"), F.collect_set("token").alias("notices"), F.sum("text").alias("alike")
    )
    fixed = alike.join(every, "host").filter(F.col("alike") <= COPIES * F.col("every")).select("host", "fixed", "notices")
    return count.select("host").join(region, "host", "left").join(menus, "host", "left").join(fixed, "host", "left").join(parts, "host", "left")


def _in_article(path: tuple[str, ...]) -> bool:
    return any(p.split(".")[0] in ARTICLES for p in path)


def _own_parts(found: list, notices: set[int], parts: dict[str, int], host_pages: int) -> set[str]:
    """The page's containers inside articles that hold nothing but notices, in this page and in every other of the host.

    A container with more text in some page has more in all than this page's times their number.
    """
    chars: dict[str, list[int]] = {}
    for kind, path, text, noise in found:
        piece = " ".join(text.split()) if kind == "text" and not noise else ""
        if piece:
            known = _signed(_hash("/".join(path), piece)) in notices
            for k in range(2, len(path) + 1):
                own = "/".join(path[:k])
                if own in parts:
                    held = chars.setdefault(own, [0, 0])
                    held[0] += len(piece)
                    held[1] += len(piece) * known
    return {p for p, (every, known) in chars.items() if every == known and every * host_pages == parts[p]}


def main_text(html: str, region: str | None, menus: set[str], fixed: set[int], notices: set[int] = frozenset(), parts: dict[str, int] | None = None, host_pages: int = 0) -> str:
    """The blocks of the region's slots, joined by line feeds.

    Inside articles a block goes if all its text is in ``notices`` and it lies in a container of ``parts`` that holds nothing
    else in any page; a repeated block among the article's own stays, and so do headings and labels of cells.
    """
    found = list(pieces(html))
    sizes = [(len(text.strip()), _in_article(path)) for kind, path, text, noise in found if kind == "text" and not noise]
    whole, inner = sum(n for n, _ in sizes), sum(n for n, within in sizes if within)
    apart = _own_parts(found, notices, parts or {}, host_pages) if notices and parts else set()
    # a page that holds nothing but fixed text keeps it
    passes = [(where, known) for where in dict.fromkeys((region, None)) for known in ((True, False) if fixed or notices else (True,))]
    for where, known in passes:
        blocks: list[str] = []
        line: list[str] = []
        own = [False]  # whether the line has text of the page's own

        def flush() -> None:
            text = " ".join("".join(line).split())
            if text and own[0]:
                blocks.append(text)
            line.clear()
            own[0] = False

        inside = tuple(where.split("/")) if where else ()
        article = _in_article(inside)
        if not where:
            article = inner > 0 and inner >= ARTICLE_TEXT * whole
        for kind, path, text, noise in found:
            if kind == "open" and text not in INLINE or kind == "end":
                flush()
            elif kind in ("text", "break"):
                if noise or path[: len(inside)] != inside:
                    continue
                if not where and article and not _in_article(path):
                    continue
                if menus and not article and any("/".join(path[:k]) in menus for k in range(len(inside) + 1, len(path) + 1)):
                    continue
                piece = " ".join(text.split())
                if known and piece and (notices if article else fixed) and kind == "text":
                    token = _signed(_hash("/".join(path), piece))
                    if not article and token in fixed:
                        continue
                    gone = article and token in notices and any("/".join(path[:k]) in apart for k in range(2, len(path) + 1))
                    own[0] = own[0] or not gone or not LABELS.isdisjoint(p.split(".")[0] for p in path)
                else:
                    own[0] = own[0] or bool(piece)
                line.append(text)
        flush()
        if blocks:
            return "\n".join(blocks)
    return ""


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    placed = hosts(pages)
    found = stored(templates(placed), "templates")
    # a host may hold a third of all pages: they are dealt to several tasks
    salts = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = placed.withColumn("_salt", F.pmod(F.xxhash64("html", "page_id"), F.lit(SALTS)).cast("int"))
    joined = dealt.join(salts, ["host", "_salt"], "left").select("page_id", "url", "html", "region", "menus", "fixed", "notices", "parts", "host_pages")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            for a, b in words.slices(words.byte_sizes(batch.column(names.index("html"))), CHUNK):
                part = batch.slice(a, b - a)
                rows = zip(*(part.column(names.index(c)).to_pylist() for c in ("html", "region", "menus", "fixed", "notices", "parts", "host_pages")))
                texts = [main_text(h or "", r, set(m or ()), set(f or ()), set(n or ()), {x["path"]: x["text"] for x in p or ()}, k or 0) for h, r, m, f, n, p, k in rows]
                size = np.array([len(t) for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays([part.column(names.index("page_id")), part.column(names.index("url")), pa.array(texts, pa.string()), pa.array(size)], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
