"""Main text of web pages by equivalence classes of template tokens.

1. Each page is read once into its container tokens (elements with class and id,
   told apart by their path) with the number of occurrences and the text in them.
2. Per host, a token's occurrence vector over the pages is folded into two 64-bit
   words (xor of a hash of page and count), so tokens with one vector share a key
   whatever the number of pages. Tokens of equal vectors form an equivalence
   class. Classes are valid when enough pages have them and their tokens hang, but
   for those inside the class, below one other class: valid classes nest into the
   host's template.
3. Text is deduced the same way: every block of text, together with the path it
   stands in, is a token with an occurrence vector over the host's distinct pages
   (pages of equal text count once). Blocks on nearly all pages whose container is
   part of the template form the classes of template text: notices, adverts,
   subscription lines, whatever they are called and wherever they stand.
4. Of the template's slots the main one is an ``article``, else ``main``, else a
   container named as content, else the innermost token that holds most of the
   host's unlinked text.
5. Each page is read again with its host's template, and what remains of the main
   slot without the template's text is extracted; elements and names that say what
   they are (menus, adverts, forms and the like) are cut as well.

Only token sums are shuffled, never a page; a hot host's pages are combined
before the shuffle.
"""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchscore.session import cut_lineage

from .url_filter import parts

#: Share of a host's pages that a template token occurs on at least.
SUPPORT = 0.5
#: Share of the enclosing slot's text that an inner slot must hold to be the main one.
MAIN_SHARE = 0.7
#: Share of a host's distinct pages that a block of template text stands on at least,
#: and the least number of them: fewer pages do not tell a template from a coincidence.
TEXT_SUPPORT, TEXT_PAGES = 0.8, 5
#: Share of a page's main slot that may be template text. A page with more is a copy of
#: the others, or a template with hardly anything in it, and keeps its text.
TEMPLATE_SHARE = 0.5
#: Hosts and tokens of template text up to which templates are broadcast; beyond it the join shuffles.
BROADCAST_HOSTS = 200_000
#: Pages whose results are held at once in a Python worker.
SLICE_PAGES = 200

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>?", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PART = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe object svg math canvas select video audio noembed noframes xmp".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
            "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
CONTAINER = set("html body div section article main table td center aside nav header footer form ul ol dl figure".split())
SECTIONS = set("body article main section nav header footer aside".split())
CUT = set("nav aside footer form menu dialog search head button label fieldset".split())
CLOSED_BY = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
# Words in classes, ids and roles of what is not the article, and of what is.
CUT_WORDS = set("ad ads advert adverts advertisement advertising adslot banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
                "sidebar aside widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login signin "
                "comment comments reply replies respond discussion disqus share sharing social related recommended recommendations footer copyright masthead toolbar "
                "pagination pager search searchbox form complementary contentinfo".split())
# What a name's other words may be when its first word says what it is.
BOX_WORDS = set("area bar block body box buttons container content feed form group inner item items link links list outer panel region row section slot thread unit wrap wrapper".split())
CONTENT_WORDS = set("article articlebody content post entry story main maincontent".split())


def _says_cut(name: str) -> bool:
    """Whether a class, id or role names what is cut: as a whole, by its last word ("cookie-notice",
    not "notice-period"), or by its first one if the others only say that it is a box of it."""
    words = [w.lower() for w in NAME_PART.findall(CAMEL.sub(" ", name))]
    return bool(words) and ("".join(words) in CUT_WORDS or words[-1] in CUT_WORDS or words[0] in CUT_WORDS and CUT_WORDS | BOX_WORDS >= set(words))


def text_token(path: int, block: str) -> int:
    """Signed 64-bit name of a block of text in a container."""
    h = xxhash.xxh64_intdigest(f"{path}|{block}".encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


class _Reader:
    """Reads pages; keeps hashes of paths it has met, which are few."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.names: dict[str, tuple[str, bool, int]] = {}

    def _look(self, name: str, attributes: str) -> tuple[str, bool, int]:
        """(token, cut, kind) of an element: kind 3 article, 2 main, 1 named content, 0 other."""
        key = name + "\0" + attributes
        if (known := self.names.get(key)) is not None:
            return known
        words, hidden, label, named = set(), False, [name], False
        for m in ATTRIBUTE.finditer(attributes):
            what, value = m[1].lower(), (m[2] or "").strip("\"'")
            if what == "hidden" or what == "aria-hidden":
                hidden |= what == "hidden" or value.lower() == "true"
                continue
            parts = [w.lower() for w in NAME_PART.findall(CAMEL.sub(" ", value))]
            words.update(parts)
            words.add("".join(parts))
            named |= any(_says_cut(n) for n in value.split())
            label.append(what[0] + "=" + re.sub(r"\d+", "0", value))
        cut = name in CUT or hidden or (named and name not in ("html", "body", "article", "main"))
        kind = 3 if name == "article" else 2 if name == "main" or "main" in words else 1 if words & CONTENT_WORDS else 0
        found = " ".join(label), cut, kind
        if len(self.names) < 10_000:  # a memory of look-ups, not a limit
            self.names[key] = found
        return found

    def _path(self, parent: int, token: str) -> int:
        key = parent, token
        if key not in self.paths:
            h = xxhash.xxh64_intdigest(f"{parent}/{token}".encode("utf-8", "surrogatepass"))
            if len(self.paths) >= 100_000:
                self.paths.clear()
            self.paths[key] = h - (1 << 64) if h >> 63 else h
        return self.paths[key]

    def blocks(self, page: str):
        """(text, containers, cut, linked characters) of each block in page order, and the
        containers opened: lists of (path, parent path, kind, cut)."""
        stack: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]  # name, path, cut, place in containers
        containers: list[tuple[int, int, int, bool]] = [(0, 0, 0, False)]
        open_names: dict[str, int] = {}
        out, text, links = [], [], 0
        in_link, at, end = False, 0, len(page)

        def add(piece: str):
            nonlocal links
            name, _, cut, _ = stack[-1]
            if cut and name not in BLOCK:
                return  # an advert or label inside a line leaves the line whole
            text.append(piece)
            if in_link:
                links += len(piece.strip())

        def flush():
            nonlocal links
            if text:
                block = " ".join("".join(text).split())
                if block:
                    _, _, cut, place = stack[-1]
                    out.append((block, place, cut, links))
                text.clear()
            links = 0

        def pop_to(depth: int):
            while len(stack) > depth:
                open_names[stack.pop()[0]] -= 1

        while at < end:
            m = TAG.search(page, at)
            piece = page[at:m.start() if m else end]
            if piece:
                add(entities.unescape(piece) if "&" in piece else piece)
            if not m:
                break
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    add(m[0][9:].removesuffix("]]>"))
                continue
            closing, name = m[1], m[2].lower()
            if closing:
                if name in BLOCK:
                    flush()
                elif name == "br":
                    text.append(" ")
                if name == "a":
                    in_link = False
                if open_names.get(name):
                    depth = len(stack) - 1
                    while stack[depth][0] != name:
                        depth -= 1
                    # the end of an inline element does not end blocks opened inside it
                    if name in BLOCK or not any(s[0] in BLOCK for s in stack[depth + 1:]):
                        pop_to(depth)
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at) if not m[0].endswith("/>") else None
                if close:
                    at = close.start()
                elif name in ("script", "style", "textarea", "title") and not m[0].endswith("/>"):
                    break
                continue
            if name == "br":
                text.append(" ")
                continue
            if name == "a":
                in_link = True
            if name in BLOCK:
                flush()
                if open_names.get("head") and name != "html":
                    depth = next(i for i, s in enumerate(stack) if s[0] == "head")
                    pop_to(depth)
                while name in SECTIONS and stack[-1][0] not in BLOCK and len(stack) > 1:
                    pop_to(len(stack) - 1)  # an inline element left open ends with the section
                if open_names.get("p"):  # a block ends an open paragraph
                    depth = len(stack) - 1
                    while stack[depth][0] != "p" and stack[depth][0] not in CONTAINER:
                        depth -= 1
                    if stack[depth][0] == "p":
                        pop_to(depth)
                if name in CLOSED_BY and open_names.get(name):
                    depth = len(stack) - 1
                    while stack[depth][0] != name and stack[depth][0] not in CLOSED_BY[name] and depth:
                        depth -= 1
                    if stack[depth][0] == name:
                        pop_to(depth)
            if name in VOID or m[0].endswith("/>") and name not in BLOCK:
                continue
            token, cut, kind = self._look(name, m[3]) if m[3].strip() or name in CUT or name in CONTAINER else (name, False, 0)
            if name not in BLOCK and not cut:
                continue  # inline elements leave no trace
            _, path, above, place = stack[-1]
            if name == "header":  # the page's header, not that of its article
                cut = cut or not any(containers[s[3]][2] >= 2 for s in stack)
            if name in CONTAINER:
                path = self._path(path, token)
                containers.append((path, place, kind, above or cut))
                place = len(containers) - 1
            stack.append((name, path, above or cut, place))
            open_names[name] = open_names.get(name, 0) + 1
        flush()
        return out, containers

    def summary(self, page: str | None) -> list[tuple[int, int, int, int, int, int]]:
        """(path, parent path, occurrences, characters, linked characters, kind) of each
        container path of the page outside what is cut; text counts for all it stands in."""
        out, containers = self.blocks(page or "")
        chars, linked = [0] * len(containers), [0] * len(containers)
        for text, place, cut, links in out:
            if not cut:
                chars[place] += len(text)
                linked[place] += min(links, len(text))
        rows: dict[int, list[int]] = {}
        for i in range(len(containers) - 1, -1, -1):
            path, above, kind, cut = containers[i]
            if i:
                chars[above] += chars[i]
                linked[above] += linked[i]
            if not cut:
                row = rows.setdefault(path, [containers[above][0], 0, 0, 0, kind])
                row[1] += 1
                row[2] += chars[i]
                row[3] += linked[i]
        return [(path, *row) for path, row in rows.items()]

    def texts(self, page: str | None) -> tuple[int, list[tuple[int, int]]]:
        """(name of the page's whole text, distinct (token, container path) of its blocks) outside what is cut."""
        out, containers = self.blocks(page or "")
        kept = [(text, containers[place][0]) for text, place, cut, _ in out if not cut]
        return text_token(0, "\n".join(t for t, _ in kept)), list({(text_token(path, text), path) for text, path in kept})

    def text(self, page: str | None, main: int | None, template=frozenset()) -> str:
        """The page's blocks in its main slot, joined by line feeds, without those whose
        token is in ``template`` (but for a page that is mostly template). ``main`` is the
        host's main slot; a page without it is taken by itself."""
        if not page:
            return ""
        out, containers = self.blocks(page)
        if main is None or not any(c[0] == main and not c[3] for c in containers):
            main = main_slot(self.summary(page))
        inside = [False] * len(containers)
        for i, (path, above, _, _) in enumerate(containers):
            inside[i] = path == main or (i > 0 and inside[above])
        blocks = [(text, bool(template) and text_token(containers[place][0], text) in template) for text, place, cut, _ in out if inside[place] and not cut]
        if sum(len(t) for t, known in blocks if known) > TEMPLATE_SHARE * sum(len(t) for t, _ in blocks):
            return "\n".join(t for t, _ in blocks)
        return "\n".join(t for t, known in blocks if not known)


def main_slot(tokens: list[tuple[int, int, int, int, int, int]]) -> int:
    """Path of the main slot among (path, parent, occurrences, characters, linked, kind).

    The kind that says most (article, main, named content) with text outside links;
    of that kind the path with most text. Without any: down from the root as long as
    one inner slot holds MAIN_SHARE of the unlinked text."""
    free = {t[0]: t[3] - t[4] for t in tokens}
    for kind in (3, 2, 1):
        named = [t[0] for t in tokens if t[5] == kind and free[t[0]] > 0]
        if named:
            return max(named, key=lambda p: (free[p], -p))
    at = 0
    while True:
        inner = [t[0] for t in tokens if t[1] == at and t[0] != at and free[t[0]] > 0 and free[t[0]] >= MAIN_SHARE * free.get(at, 0)]
        if not inner:
            return at
        at = max(inner, key=lambda p: (free[p], -p))


def in_slices(*columns: pd.Series) -> Iterator[tuple[pd.Series, ...]]:
    """A batch in pieces of ``SLICE_PAGES`` rows: results of a page are many small objects,
    so a whole batch of them takes far more memory than its pages."""
    for at in range(0, len(columns[0]), SLICE_PAGES):
        yield tuple(c.iloc[at:at + SLICE_PAGES] for c in columns)


TOKENS = "array<struct<path:bigint,parent:bigint,n:int,chars:bigint,links:bigint,kind:int>>"


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, template): each host's main slot and tokens of template text, from pages (host, html)."""
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = _Reader()
        for (htmls,) in (piece for batch in batches for piece in in_slices(batch)):
            yield pd.Series([[dict(zip(("path", "parent", "n", "chars", "links", "kind"), t)) for t in reader.summary(h)] for h in htmls], dtype=object)

    seen = pages.select("host", F.xxhash64("html").alias("page"), F.explode(F.pandas_udf(read, TOKENS)("html")).alias("t"))
    vector = lambda salt: F.bit_xor(F.xxhash64(F.lit(salt), "page", "t.n"))
    tokens = seen.groupBy("host", "t.path").agg(
        F.min("t.parent").alias("parent"), F.count("*").alias("pages"), F.sum("t.n").alias("n"), F.sum("t.chars").alias("chars"),
        F.sum("t.links").alias("links"), F.max("t.kind").alias("kind"), F.struct(vector(1).alias("a"), vector(2).alias("b"), F.count("*").alias("pages")).alias("vector"))
    tokens = cut_lineage(tokens)
    # pages of a host: its root token is on every one
    totals = tokens.where("path = 0").select(F.col("host").alias("h"), F.col("pages").alias("total"))
    above = tokens.select(F.col("host").alias("up_host"), F.col("path").alias("up"), F.col("vector").alias("up_vector"))
    rows = tokens.join(totals, F.col("host").eqNullSafe(F.col("h"))).where(F.col("pages") >= SUPPORT * F.col("total"))
    rows = rows.join(above, F.col("host").eqNullSafe(F.col("up_host")) & (F.col("parent") == F.col("up")))
    # a class is valid when its tokens hang inside it or below one other class
    outer = F.when(F.col("up_vector") != F.col("vector"), F.col("up_vector"))
    classes = rows.groupBy(F.col("host").alias("c_host"), F.col("vector").alias("c_vector")).agg(F.count_distinct(outer).alias("outer"))
    valid = rows.join(classes.where("outer <= 1"), F.col("host").eqNullSafe(F.col("c_host")) & (F.col("vector") == F.col("c_vector")))
    slots = valid.groupBy("host").agg(F.collect_list(F.struct("path", "parent", F.col("n").cast("int").alias("n"), "chars", "links", "kind")).alias("tokens"))

    @F.pandas_udf("bigint")
    def chosen(hosts: pd.Series) -> pd.Series:
        return pd.Series([main_slot([(t["path"], t["parent"], t["n"], t["chars"], t["links"], t["kind"]) for t in ts]) for ts in hosts], dtype="int64")

    found = slots.select("host", chosen("tokens").alias("main"))
    texts = template_texts(pages, rows.select("host", "path")).withColumnRenamed("host", "t_host")
    return found.join(texts, F.col("host").eqNullSafe(F.col("t_host")), "left").select("host", "main", "template")


def template_texts(pages: DataFrame, containers: DataFrame) -> DataFrame:
    """(host, template): per host the tokens of blocks that are template text, from pages (host, html).

    ``containers`` (host, path) are the container tokens with support: a block that
    hangs in no part of the template is content. On average a host's template holds at most
    1 / TEXT_SUPPORT times the blocks of a page."""
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = _Reader()
        for (htmls,) in (piece for batch in batches for piece in in_slices(batch)):
            both = [reader.texts(h) for h in htmls]
            mark = {"token": None, "path": 0}  # counts the host's pages
            yield pd.DataFrame({"page": [p for p, _ in both], "texts": [[mark] + [{"token": t, "path": c} for t, c in ts] for _, ts in both]})

    found = F.pandas_udf(read, "page bigint, texts array<struct<token:bigint,path:bigint>>")("html")
    seen = pages.select(F.xxhash64("host").alias("h"), found.alias("f"))
    # pages of equal text are one page
    seen = seen.select("h", "f.page", F.explode("f.texts").alias("t")).select("h", "page", "t.token", "t.path").distinct()
    vector = lambda salt: F.bit_xor(F.xxhash64(F.lit(salt), "page"))
    tokens = seen.groupBy("h", "token", "path").agg(F.count("*").alias("pages"), F.struct(vector(1).alias("a"), vector(2).alias("b")).alias("vector"))
    tokens = cut_lineage(tokens.where(F.col("pages") >= TEXT_PAGES))
    totals = tokens.where("token is null").select(F.col("h").alias("of"), F.col("pages").alias("total"))
    often = tokens.where("token is not null").join(totals, F.col("h") == F.col("of")).where(F.col("pages") >= TEXT_SUPPORT * F.col("total"))
    # a class of blocks is template if it has the support and all of it hangs in the template's containers
    hung = often.join(containers.select("host", F.col("path").alias("c"), F.xxhash64("host").alias("c_h")), (F.col("h") == F.col("c_h")) & (F.col("path") == F.col("c")), "left")
    classes = hung.groupBy("h", F.col("vector").alias("v")).agg(F.count_if(F.col("c").isNull()).alias("loose")).where("loose = 0").select(F.col("h").alias("v_h"), "v")
    hung = hung.join(classes, (F.col("h") == F.col("v_h")) & (F.col("vector") == F.col("v")))
    return hung.groupBy("host").agg(F.array_sort(F.collect_list("token")).alias("template"))


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    Text that stands on nearly all pages of a host of ``TEXT_PAGES`` distinct pages or
    more is template, also inside the article. Null and empty pages have an empty text; pages of a null or malformed url form
    one host; a page that its host's template does not fit is taken by itself.
    Repeated rows stay; markup may be broken or cut off anywhere; an empty table
    gives an empty one; further columns are not read."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), parts(F.col(url))[0].alias("host"))
    found = cut_lineage(templates(rows.select("host", "html")))
    found = found.select(F.col("host").alias("of"), "main", "template")
    hosts, tokens = found.agg(F.count("*"), F.coalesce(F.sum(F.size("template")), F.lit(0))).first()
    rows = rows.join(F.broadcast(found) if hosts + tokens <= BROADCAST_HOSTS else found, F.col("host") == F.col("of"), "left")

    def read(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        reader = _Reader()
        for htmls, mains, known in (piece for batch in batches for piece in in_slices(*batch)):
            yield pd.Series([reader.text(h, None if pd.isna(m) else int(m), frozenset(() if t is None else t))
                             for h, m, t in zip(htmls, mains.astype("Int64"), known)], dtype=object)

    text = F.pandas_udf(read, "string")("html", F.col("main"), F.col("template"))
    return rows.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
