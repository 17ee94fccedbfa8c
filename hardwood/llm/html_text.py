"""Main text of web pages by a site style tree.

Method: every page is parsed to its tree of elements. Pages of one host are merged: an element's node is its host and path of
tags and classes. Per node, Spark counts over the host's pages the presentation styles (the row of
child elements) and the contents (the text of the branch) it takes. The entropy of either, to the base of the number of
pages, is its importance: 0 if all pages agree, as with a site's notices and menus, 1 if no two do. Nodes whose importance
(content and presentation, weighted) is below ``LOW`` on ``ENOUGH`` pages or more are cut from each page with all that is
below them. Copies of an article must not make it look like furniture, so pages with the same text count as one page of their
host, and so do near copies. What tells near copies is how many of the host's texts hold a passage, counted in Spark: passages on
most of them are the site's and say nothing; of the rest, a near copy has nearly all on other pages too and goes by the smallest of
these. A page with nearly nothing besides what most pages hold counts as a copy of the others.

Elements that by their tag, role or class are no article (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles, comments) go without being counted. A class or id says so if all its parts do, positions and wrappers aside
(cookie-notice, sidebar-left); one that only has such a part (content-sidebar-wrap, social-science) is evidence: its branch goes
if most of its text is links, or if its importance is below ``HINTED``. No name cuts a branch that holds an article or, unless an
article is marked elsewhere, most of the page's text. Where a page marks its article (article, main, role=main), only that is read,
unless a block that isn't marked is longer than each that is.

Each page yields one small row per path; the texts themselves are not shuffled unless cut branches are too many to broadcast.

Defined results: a null or empty html gives an empty text; a page without a host has no style tree and is extracted by its
elements alone; repeated rows are each returned; unclosed, truncated and stray tags are taken as far as they go; an empty table
gives an empty table; other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import batch_pass, staged

LOW, HINTED, ENOUGH, CONTENT_WEIGHT = 0.2, 0.8, 10, 0.9
#: A near copy has at least NEAR of its text on other pages; a page has text of its own if what most pages of the host hold leaves OWN of it.
NEAR, OWN = 0.8, 0.1

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)[^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)", re.I)
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Sought in the page itself: lower-casing a page can change its length.
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I | re.A) for tag in RAW}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre "
    "search section table ul".split()
)
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
NO_ARTICLE = frozenset(
    "head script style noscript template nav aside footer form button select option textarea input iframe object svg canvas dialog menu title xmp noembed noframes".split()
)
NO_ARTICLE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu modal nav "
    "navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget widgets alert".split()
)
#: Parts of names that say where an element is or what wraps it.
PLACES = frozenset("area bar block bottom box container left links list main page primary right secondary section site slot top unit wrap wrapper".split())
#: Elements whose text belongs to the block around them.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd blockquote pre table tbody thead tfoot tr td th caption figure figcaption details summary hr center address".split())
OWN_HEADER = frozenset("article post entry story content".split())
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())


class Page:
    """Elements of a page in order: parent, name (tag and classes), path; and its texts with the element each lies in."""

    def __init__(self, html: str):
        self.parent, self.tag, self.name, self.path, self.main = [-1], [""], [""], [""], [False]
        #: Cut whatever it holds; named as no article; with a part of a name that is; an article by tag or role.
        self.plain, self.named, self.hinted, self.article = [False], [False], [False], [False]
        #: (element, text); a text of None parts blocks.
        self.texts: list[tuple[int, str | None]] = []
        self._read(html)
        self._judge()

    def _open(self, tag: str, attributes: str, above: int) -> int:
        names, role, hidden = [], "", False
        if attributes:
            for key, a, b, c in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), (a or b or c).lower()
                if key in ("class", "id"):
                    names += value.split()
                elif key == "role":
                    role = value.strip()
                else:
                    hidden |= key == "hidden" or value == "true"
        in_main, named, hinted = self.main[above], tag == "form", False
        if names:
            split = [{part for part in re.split(r"[_-]+", n) if part} for n in names]
            known = NO_ARTICLE_NAMES
            if in_main or any(parts & OWN_HEADER for parts in split):
                known = known - {"header"}
            hinted = any(parts & known for parts in split)
            named |= hinted and any(parts & known and parts <= known | PLACES for parts in split)
        article = tag in ("article", "main") or role in ("main", "article")
        name = tag + "".join("." + re.sub(r"\d+", "0", n) for n in sorted(set(names)))
        self.parent.append(above)
        self.tag.append(tag)
        self.name.append(name)
        self.path.append(f"{self.path[above]}>{name}")
        self.plain.append((tag in NO_ARTICLE and tag != "form") or hidden or role in NO_ARTICLE_ROLES or (tag == "header" and not in_main))
        self.named.append(named and tag not in ("html", "body", "article", "main"))
        self.hinted.append(hinted and tag not in ("html", "body"))
        self.article.append(article)
        self.main.append(in_main or article)
        return len(self.tag) - 1

    def _judge(self) -> None:
        """Which elements are cut, and which of those kept are hinted."""
        n = len(self.tag)
        gone = [False] * n
        for k in range(1, n):
            gone[k] = self.plain[k] or gone[self.parent[k]]
        size, linked = self._sizes(gone)
        holds = [False] * n
        for k in range(n - 1, 0, -1):
            # Comments and teasers are often articles by tag.
            holds[k] = holds[k] or (self.article[k] and not self.hinted[k] and not gone[k] and size[k] > 0)
            if holds[k]:
                holds[self.parent[k]] = True
        self.cut = gone
        for k in range(1, n):
            above = self.cut[self.parent[k]]
            safe = holds[k] or (2 * size[k] > size[0] and not holds[0])
            self.hinted[k] = self.hinted[k] and not safe and not self.article[k]
            self.cut[k] = above or self.plain[k] or (self.named[k] and not safe) or (self.hinted[k] and 2 * linked[k] > size[k])

    def _sizes(self, gone: list[bool]) -> tuple[list[int], list[int]]:
        """Characters of text below each element, and how many of them lie in links."""
        size, linked = [0] * len(gone), [0] * len(gone)
        for element, text in self.texts:
            if text is not None and not gone[element]:
                size[element] += len("".join(text.split()))
        for k in range(len(gone) - 1, 0, -1):
            if self.tag[k] == "a":
                linked[k] = size[k]
            size[self.parent[k]] += size[k]
            linked[self.parent[k]] += linked[k]
        return size, linked

    def _marked(self, gone: list[bool]) -> bool:
        """Whether only marked text is to be read: some is, and no block without a mark is longer than the longest that has one."""
        marked = [self.main[k] and not gone[k] for k in range(len(gone))]
        if not any(marked):
            return False
        size, _ = self._sizes(gone)
        outside = [(k, text) for k, (element, text) in enumerate(self.texts) if text is not None and not gone[element] and not self.main[element] and not text.isspace()]
        if not outside:
            return True
        most = max(size[k] for k in range(1, len(gone)) if marked[k])
        around = [False] * len(gone)
        for k in range(len(gone) - 1, 0, -1):
            around[self.parent[k]] |= around[k] or marked[k]
        # A branch without a mark is one block; so is what lies in an element around marked ones without a block of its own.
        blocks = [0] * len(gone)
        for at, text in outside:
            place = self.texts[at][0]
            while place and (self.tag[place] in INLINE or self.tag[place] in PARAGRAPHS):
                place = self.parent[place]
            while place and not around[place] and not around[self.parent[place]]:
                place = self.parent[place]
            blocks[place] += len("".join(text.split()))
        return max(blocks) <= most

    def _read(self, html: str) -> None:
        at, here = 0, 0
        while True:
            found = TOKEN.search(html, at)
            text = html[at : found.start()] if found else html[at:]
            if text:
                self.texts.append((here, unescape(text) if "&" in text else text))
            if not found:
                return
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            if found[1] or found[4]:
                place = here
                while place and self.tag[place] != tag:
                    place = self.parent[place]
                if place:
                    if tag not in INLINE:
                        self.texts.append((here, None))
                    here = self.parent[place]
                elif tag not in INLINE:
                    self.texts.append((here, None))
                continue
            if tag not in INLINE:
                self.texts.append((here, None))
                here = self._implied(tag, here)
            element = self._open(tag, found[3] or "", here)
            if tag in RAW:
                close = RAW_END[tag].search(html, at)
                if not close:
                    return
                end = html.find(">", close.end())
                at = len(html) if end < 0 else end + 1
            elif tag not in VOID and not (found[3] or "").endswith("/"):
                here = element

    def _implied(self, tag: str, here: int) -> int:
        """Where an element opens after the ends of elements that it implies."""
        place, ends = here, SIBLINGS.get(tag, ())
        close_p = tag in CLOSES_P
        while place:
            own = self.tag[place]
            if own in ends or (close_p and own == "p"):
                return self.parent[place]
            if own not in INLINE:
                break
            place = self.parent[place]
        return here

    def blocks(self, low: frozenset[int] = frozenset(), keys: dict[str, int] | None = None) -> str:
        """The main text, without the branches whose path's key is in ``low``."""
        gone = list(self.cut)
        if low and keys:
            for k in range(1, len(gone)):
                gone[k] = gone[k] or gone[self.parent[k]] or keys.get(self.path[k]) in low
        marked = self._marked(gone)
        parts, block = [], []
        for element, text in self.texts:
            if text is None:
                parts.append("".join(block))
                block = []
            elif not gone[element] and (self.main[element] or not marked):
                block.append(text)
        parts.append("".join(block))
        return " ".join(" ".join(p.split()) for p in parts if p and not p.isspace())


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def node_keys(page: Page, host: str) -> dict[str, int]:
    """The key of each path: a signed 64-bit hash of host and path."""
    from xxhash import xxh64_intdigest

    return {path: (xxh64_intdigest(f"{host}\n{path}") ^ (1 << 63)) - (1 << 63) for path in set(page.path[1:])}


def branches(html: str | None, url: str | None) -> tuple[list[tuple[int, int, int, int, int, int]], list[tuple[int, int, int, int]]]:
    """(host, page, node, style, content, hinted) for each path of a page that holds text and (host, page, passage, size) for each passage, as hashes."""
    from xxhash import xxh64, xxh64_intdigest

    host = host_of(url)
    if not html or not host:
        return [], []
    page = Page(html)
    contents: dict[str, object] = {}
    passages: dict[int, int] = {}
    whole = xxh64(f"{host}\n")
    for element, text in page.texts:
        if text is None or text.isspace() or page.cut[element]:
            continue
        data = " ".join(text.split()).encode()
        passage = xxh64_intdigest(data)
        passages[passage] = passages.get(passage, 0) + len(data)
        whole.update(data + b"\n")
        paths, place = set(), element
        while place:
            paths.add(page.path[place])
            place = page.parent[place]
        for path in paths:
            contents.setdefault(path, xxh64()).update(data + b"\n")
    styles: dict[str, list[str]] = {}
    sure = {page.path[k] for k in range(1, len(page.tag)) if not page.hinted[k] and not page.cut[k]}
    for k in range(1, len(page.tag)):
        children = styles.setdefault(page.path[page.parent[k]], [])
        if not children or children[-1] != page.name[k]:
            children.append(page.name[k])

    def signed(value: int) -> int:
        return (value ^ (1 << 63)) - (1 << 63)

    keys, place = node_keys(page, host), (signed(xxh64_intdigest(host)), signed(whole.intdigest()))
    return (
        [(*place, keys[path], signed(xxh64_intdigest(">".join(styles.get(path, [])))), signed(content.intdigest()), int(path not in sure))
         for path, content in contents.items()],
        [(*place, signed(passage), size) for passage, size in passages.items()],
    )


def style_rows(pages: DataFrame) -> DataFrame:
    """page_key, host and page (its whole text, as a hash), with node, style, content and hinted of every branch that is not cut by its name, or passage and size of every passage."""
    columns = ["page_key", "host", "page", "node", "style", "content", "hinted", "passage", "size"]

    def make():
        def step(batch: pa.RecordBatch):
            rows = []
            for key, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                nodes, passages = branches(html, url)
                rows += [(key, *node, None, None) for node in nodes]
                rows += [(key, host, page, None, None, None, None, *passage) for host, page, *passage in passages]
            values = zip(*rows) if rows else [[]] * len(columns)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in values], columns)

        return step

    return batch_pass(pages.select("page_key", "url", "html"), ", ".join(f"{c} long" for c in columns), make)


def near_copies(rows: DataFrame) -> DataFrame:
    """page and same_page of the pages that count as copies of others; each text of a host is counted once."""
    held = staged(rows.filter("size is not null").groupBy("host", "page", "passage").agg(F.max("size").alias("size")), "passages")
    texts = staged(held.groupBy("host", "page").agg(F.sum("size").alias("whole")), "site_texts")
    on = held.groupBy("host", "passage").agg(F.count("*").alias("n")).filter("n > 1")
    shared = staged(
        on.join(texts.groupBy("host").agg(F.count("*").alias("n_pages")), "host").select("host", "passage", (2 * F.col("n") > F.col("n_pages")).alias("common")),
        "shared_passages",
    )
    sums = held.join(shared, ["host", "passage"]).groupBy("host", "page").agg(
        F.sum(F.when(F.col("common"), F.col("size")).otherwise(0)).alias("common"),
        F.sum(F.when(~F.col("common"), F.col("size")).otherwise(0)).alias("met"),
        F.min(F.when(~F.col("common"), F.col("passage"))).alias("least"),
    )
    rest = F.col("whole") - F.col("common")
    same = F.when(rest < OWN * F.col("whole"), F.col("host")).when(F.col("met") >= NEAR * rest, F.xxhash64("host", "least"))
    return texts.join(sums, ["host", "page"]).select("page", same.alias("same_page")).dropna()


def importance(rows: DataFrame) -> DataFrame:
    """node, pages, importance and hinted (on all its pages). All groupings fold before the shuffle; a host's pages never meet in one task."""

    def folded(found: DataFrame) -> DataFrame:
        return found.groupBy("node", "page").agg(F.min("style").alias("style"), F.min("content").alias("content"), F.min("hinted").alias("hinted"))

    copies = staged(near_copies(rows), "near_copies")
    texts = folded(rows.filter("node is not null")).join(copies, "page", "left")
    pages = staged(folded(texts.withColumn("page", F.coalesce("same_page", "page"))), "site_pages")

    def agreement(kind: str) -> DataFrame:
        counts = pages.groupBy("node", kind).agg(F.count("*").alias("n"))
        return counts.groupBy("node").agg(F.sum("n").alias(f"{kind}_pages"), F.sum(F.col("n") * F.log("n")).alias(f"{kind}_log"))

    hinted = pages.groupBy("node").agg((F.min("hinted") == 1).alias("hinted"))
    joined = agreement("content").join(agreement("style"), "node").join(hinted, "node").withColumnRenamed("content_pages", "pages")
    whole = F.col("pages") * F.log("pages")

    def entropy(kind: str):
        # -sum p log p to the base of the pages, where p is a share of the pages.
        return F.when(F.col("pages") > 1, 1 - F.col(f"{kind}_log") / whole).otherwise(F.lit(1.0))

    value = CONTENT_WEIGHT * entropy("content") + (1 - CONTENT_WEIGHT) * entropy("style")
    return joined.select("node", "pages", value.alias("importance"), "hinted")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    keyed = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("page_key"))
    rows = staged(style_rows(keyed), "styles")
    low = staged(importance(rows).filter((F.col("pages") >= ENOUGH) & (F.col("importance") < F.when(F.col("hinted"), HINTED).otherwise(LOW))).select("node"), "low_nodes")
    cuts = staged(rows.join(low, "node", "left_semi").groupBy("page_key").agg(F.collect_set("node").alias("low")), "cuts")
    joined = keyed.join(cuts, "page_key", "left")

    def make():
        def step(batch: pa.RecordBatch):
            texts = []
            for url, html, low in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                page = Page(html or "")
                texts.append(page.blocks(frozenset(low), node_keys(page, host_of(url))) if low else page.blocks())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

        return step

    return batch_pass(joined.select("page_id", "url", "html", "low"), "page_id long, url string, text string, n_chars long", make)
