"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of styles: a style node is a chain
of elements with their classes, and it knows how many pages have it, how often
each order of children follows it (presentation), and how often its text is the
same on several pages (content). Presentation counts for as much as its entropy
over the pages, content for as much as its texts differ from page to page. A
branch whose composite importance stays low is furniture of the site, and it is
cut from every page of the host.

Elements whose role is plain from the markup (menus, footers, forms, adverts,
scripts, ...) are cut on every page, also on hosts of one page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import map_batches, written

#: Pages that must have a style node before its importance is trusted.
LEAST_PAGES = 8
#: A branch below this importance is cut; weight of what lies below a node.
IMPORTANCE = 0.25
DAMP = 0.9
#: A cut that would leave a page without text is not made, nor one that would take
#: more than this share of an article or main element.
MOST_CUT = 0.5
#: The same for pages whose text is not in such elements.
MOST_CUT_BODY = 0.8
#: Marks a headline outside of article and main elements.
HEADLINE = 0.5
#: Pages that are the same in this share of their text, longest blocks first, are copies.
COPIED = 0.9

# Element names of HTML by how they are laid out.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre search section summary table "
    "tbody td template tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: What a start tag closes: its own kind, up to the nearest of the second set.
CLOSES = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tbody": ("thead tbody tfoot tr td th", "table"),
    "tfoot": ("thead tbody tfoot tr td th", "table"), "option": ("option", "select datalist"), "body": ("head", "html"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
#: Elements that are never main text.
CUT = frozenset(
    "aside audio button canvas datalist dialog embed footer head iframe input label map menu nav noembed noframes noscript object "
    "script search select style svg template textarea title video".split())
CUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
#: Words of class names and ids that say the same.
CUT_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising adslot sponsor sponsored sponsors promo promos promotion banner banners cookie "
    "cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay newsletter subscribe subscription "
    "signup sidebar aside rail menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar toolbar comment comments "
    "discussion feedback disqus reply replies respond share sharing social related recommended recommendations widget widgets pagination pager login search "
    "copyright skip hidden disclaimer outbrain taboola".split())
#: Of these, the words of what readers wrote: it may well be longer than the main text.
READERS = frozenset("comment comments disqus".split())
#: First words that deny a name or make it a state or a subject, last words that do.
NOT_HEADS = frozenset("no not non has have is with without category tag topic format".split())
NOT_TAILS = frozenset("open opened closed on off enabled disabled layout page wrapper container".split())
#: Names that say it of whole classes or ids, outside of articles.
CUT_HEADS = frozenset("header site-header page-header main-header global-header top-header".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


def digest(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


class Element:
    """An open element: its style path and where it lies."""

    __slots__ = ("tag", "path", "above", "cut", "inside", "named", "children")

    def __init__(self, tag: str, path: int, above: tuple[int, ...], cut: bool, inside: float, named: tuple[int, ...] = ()) -> None:
        self.tag, self.path, self.above, self.cut, self.inside, self.named = tag, path, above, cut, inside, named
        self.children: list[str] = []


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def says_cut(tag: str, attrs: dict[str, str], inside: float) -> bool:
    """Whether the markup itself says that an element is no main text."""
    if tag in CUT:
        return True
    if tag == "header" and not inside:
        return True
    if tag in ("html", "body"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    if attrs.get("role", "").lower() in CUT_ROLES:
        return True
    return False


def named_cut(tag: str, attrs: dict[str, str], inside: float) -> str:
    """The class name or id that says, by its first or last word, that an element is no
    main text; a form says it by its tag. Empty if none does."""
    if tag in ("html", "body", "main"):
        return ""
    for name in (attrs.get("class", "") + " " + attrs.get("id", "")).lower().split():
        words = WORD.findall(name)
        if not inside and name in CUT_HEADS:
            return name
        if words and words[0] not in NOT_HEADS and words[-1] not in NOT_TAILS and not CUT_WORDS.isdisjoint((words[0], words[-1])):
            return name
    return "form" if tag == "form" else ""


class Page:
    """Blocks of text of one page, and its style nodes."""

    def __init__(self, source: str) -> None:
        #: (text, path, paths above, 2 inside an article, 1 inside main, HEADLINE, else 0)
        self.blocks: list[tuple[str, int, tuple[int, ...], float]] = []
        #: path -> (paths above, orders of children)
        self.nodes: dict[int, tuple[tuple[int, ...], list[str]]] = {}
        #: For each block and each closed element, the branches above it whose names say they are no main text.
        self.named: list[tuple[int, ...]] = []
        self.closed: list[tuple[int, tuple[int, ...], str, tuple[int, ...]]] = []
        self.branches: list[str] = []  # the names of these branches
        self.stack = [Element("", 0, (), False, 0)]
        #: Pieces of the block's text, each with the named branches above it.
        self.text: list[tuple[str, tuple[int, ...]]] = []
        at, n = 0, len(source)
        for m in TOKEN.finditer(source):
            if m.start() < at:  # inside a raw element
                continue
            if m.start() > at:
                self.data(source[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self.end(tag)
                continue
            raw = m[3] if m[2] else m[6]
            self.start(tag, raw)
            if tag in RAW and not raw.endswith("/"):
                close = re.compile(f"</{tag}\\b[^>]*>?", re.I).search(source, at)
                at = close.end() if close else n
                self.end(tag)
        if at < n:
            self.data(source[at:])
        self.pop_to(1)
        self.flush()
        self.settle()

    def settle(self) -> None:
        """Cut the branches whose names say so.

        Where an article or main element stands outside of them all go. Elsewhere
        names are no proof: what readers wrote goes if other text is left, and of the
        other names those go that together hold no more than MOST_CUT of that text;
        names with much text are the first to stay, with all their branches.
        """
        blocks = list(zip(self.blocks, self.named, strict=True))
        if any(b[3] >= 1 and not named for b, named in blocks):
            cut = set(range(len(self.branches)))
        else:
            readers = {i for i, name in enumerate(self.branches) if not READERS.isdisjoint(WORD.findall(name))}
            rest = [(len(b[0]), named) for b, named in blocks if readers.isdisjoint(named)]
            if not rest:
                readers, rest = set(), [(len(b[0]), named) for b, named in blocks]
            size = sum(n for n, _ in rest)
            held: dict[str, int] = {}
            for n, named in rest:
                for name in {self.branches[i] for i in named}:
                    held[name] = held.get(name, 0) + n
            stay: set[str] = set()
            order = sorted(held, key=lambda name: (-held[name], name))
            # The larger names stay until the others hold little enough (those within them go too).
            low, high = 0, len(order)
            while low < high:
                at = (low + high) // 2
                stay = set(order[:at])
                gone = sum(n for n, named in rest if any(self.branches[i] not in stay for i in named))
                low, high = (low, at) if gone <= MOST_CUT * size else (at + 1, high)
            stay = set(order[:low])
            cut = {i for i, name in enumerate(self.branches) if i in readers or name not in stay}
        self.blocks = [b for b, named in blocks if cut.isdisjoint(named)]
        for path, above, order, named in self.closed:
            if cut.isdisjoint(named):
                self.nodes.setdefault(path, (above, []))[1].append(order)

    def data(self, s: str) -> None:
        if not self.stack[-1].cut:
            self.text.append((html.unescape(s) if "&" in s else s, self.stack[-1].named))

    def flush(self) -> None:
        if self.text:
            words = "".join(t for t, _ in self.text).split()
            above = [named for t, named in self.text if t.strip()]
            self.text = []
            if words:
                top = self.stack[-1]
                self.blocks.append((" ".join(words), top.path, top.above, top.inside))
                # An inline branch holds the block if it holds all of its text.
                self.named.append(tuple(i for i in above[0] if all(i in named for named in above[1:])))

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            if self.stack[-1].tag in BLOCKS:
                self.flush()
            e = self.stack.pop()
            if e.tag in BLOCKS and not e.cut:
                self.closed.append((e.path, e.above, ",".join(e.children), e.named))

    def start(self, tag: str, raw: str) -> None:
        if tag == "br":
            self.text.append((" ", ()))
            return
        block = tag in BLOCKS
        if block:
            self.flush()
            # A block closes an open paragraph; list items and cells close their kind.
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == "p":
                    self.pop_to(k)
                    break
                if self.stack[k].tag in BLOCKS:
                    break
        if tag in CLOSES:
            kinds, bounds = CLOSES[tag]
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in bounds:
                    break
                if self.stack[k].tag in kinds:
                    self.pop_to(k)
        if tag in VOID:
            return
        up = self.stack[-1]
        attrs = attributes(raw) if raw.strip(" /\n\t") else {}
        inside = max(up.inside, 2 if tag == "article" else 1 if tag == "main" or attrs.get("role") == "main" else HEADLINE if tag == "h1" else 0)
        cut = up.cut or says_cut(tag, attrs, up.inside)
        named = up.named
        if not cut and (name := named_cut(tag, attrs, up.inside)):
            named = (*named, len(self.branches))
            self.branches.append(name)
        if block:
            style = DIGITS.sub("#", f"{tag}.{attrs.get('class', '')}#{attrs.get('id', '')}")
            if not up.children or up.children[-1] != tag:
                up.children.append(tag)
            self.stack.append(Element(tag, digest(f"{up.path}>{style}"), (*up.above, up.path), cut, inside, named))
        else:
            self.stack.append(Element(tag, up.path, up.above, cut, inside, named))
            self.stack[-1].children = up.children

    def end(self, tag: str) -> None:
        block = tag in BLOCKS
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                self.pop_to(k)
                return
            if not block and self.stack[k].tag in BLOCKS:
                return

    def content(self) -> int:
        """Hash of the page's text without numbers and without its shortest blocks."""
        size, held, out = sum(len(b[0]) for b in self.blocks), 0, []
        for text in sorted((b[0] for b in self.blocks), key=lambda x: (-len(x), x)):
            if held >= COPIED * size:
                break
            held += len(text)
            out.append(DIGITS.sub("#", text))
        return digest("\n".join(sorted(out)))

    def main_text(self, cut: frozenset[int]) -> str:
        """The blocks that the style tree leaves; those of articles and main elements
        alone where they hold most of that text."""
        def size(blocks: list) -> int:
            return sum(len(b[0]) for b in blocks)

        left = [b for b in self.blocks if b[1] not in cut and cut.isdisjoint(b[2])] or self.blocks
        # A headline belongs to the article that follows it.
        first = next((i for i, b in enumerate(self.blocks) if b[3] >= 1), 0)
        own = {id(b) for i, b in enumerate(self.blocks) if b[3] >= 1 or b[3] and i < first}
        told = [b for b in left if id(b) in own]
        if size(told) > MOST_CUT * size(left):
            whole, left = [b for b in self.blocks if id(b) in own], told
            most = MOST_CUT
        else:
            whole, most = self.blocks, MOST_CUT_BODY
        blocks = left if size(whole) - size(left) <= most * size(whole) else whole
        return "\n\n".join(b[0] for b in blocks)


def style_nodes(pages: DataFrame) -> DataFrame:
    """One row per page and style node: ``host, path, above, variant, content, page``.

    ``variant``: hash of the orders of children; ``content``: hash of the text
    directly in the node, null if it has none; ``page``: hash of the page's content.
    """

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                page = Page(source)
                whole = page.content()
                texts: dict[int, list[str]] = {}
                for text, path, _, _ in page.blocks:
                    texts.setdefault(path, []).append(text)
                for path, (above, orders) in page.nodes.items():
                    own = texts.get(path)
                    out.append((host, path, list(above), digest("|".join(dict.fromkeys(orders))), digest("\n".join(own)) if own else None, whole))
            kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64()]
            cols = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["host", "path", "above", "variant", "content", "page"])

    return map_batches(pages.select("host", "html"), nodes, "host string, path long, above array<long>, variant long, content long, page long")


def unimportant(nodes: DataFrame, least_pages: int = LEAST_PAGES, importance: float = IMPORTANCE) -> DataFrame:
    """``host, cut``: the style nodes of a host whose branches are furniture.

    Every step is a partially aggregated count or sum, so a host with very many
    pages is reduced in the map tasks.
    """
    # Copies of a page count once: a text on many copies is no furniture.
    nodes = nodes.groupBy("host", "path", "above", "page").agg(F.min("variant").alias("variant"), F.min("content").alias("content"))
    # Presentation: entropy of the orders of children, to the base of the pages.
    variants = nodes.groupBy("host", "path", "variant").agg(F.count("*").alias("k"), F.first("above").alias("above"))
    shown = variants.groupBy("host", "path").agg(
        F.sum("k").alias("m"), F.sum(F.col("k") * F.log("k")).alias("klogk"), F.count("*").alias("styles"), F.first("above").alias("above"))
    shown = shown.where(F.col("m") >= least_pages).withColumn("shown", (F.log("m") - F.col("klogk") / F.col("m")) / F.log("m"))
    # Content: a text on k of the m pages has the entropy log k to the base m.
    texts = nodes.where("content IS NOT NULL").groupBy("host", "path", "content").agg(F.count("*").alias("k"))
    told = texts.groupBy("host", "path").agg(
        F.sum("k").alias("with_text"), F.sum(F.col("k") * F.log("k")).alias("same")).where(F.col("with_text") > 1)
    told = told.withColumn("told", 1 - F.col("same") / F.col("with_text") / F.log("with_text"))
    leaves = shown.join(told, ["host", "path"]).select(
        "host", F.explode(F.array_append("above", F.col("path"))).alias("path"), "told", F.col("with_text").alias("weight"))
    below = leaves.groupBy("host", "path").agg(
        (F.sum(F.col("told") * F.col("weight")) / F.sum("weight")).alias("told"), F.max("told").alias("most"))
    damp = F.pow(F.lit(DAMP), F.col("styles"))
    scored = shown.join(below, ["host", "path"]).withColumn("worth", (1 - damp) * F.col("shown") + damp * F.col("told"))
    low = scored.where((F.col("worth") < importance) & (F.col("most") < importance) & (F.col("path") != 0))
    return low.groupBy("host").agg(F.collect_set("path").alias("cut"))


def main_texts(
    pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html",
    least_pages: int = LEAST_PAGES, importance: float = IMPORTANCE,
) -> DataFrame:
    """``key, url, text, n_chars``: the main text of every whole page.

    Blocks in page order joined by two newlines, white space inside a block as
    one space, character references decoded. A null page has an empty text; a
    null or odd URL counts as a host of its own kind; repeated rows and null keys
    are kept; an empty table gives an empty result; other columns are not read.

    A host's cut list has one entry per furniture style node, of which templates
    have few; the join by host can be split where one host has very many pages.
    """
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("html"),
        F.coalesce(F.regexp_extract(F.lower(F.col(url).cast("string")), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit("")).alias("host"))
    nodes = written(style_nodes(rows), "style-nodes")
    cuts = written(unimportant(nodes, least_pages, importance), "style-cuts")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [Page(h).main_text(frozenset(c or ())) for h, c in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["key", "url", "text", "n_chars"])

    told = rows.join(cuts, "host", "left").select("key", "url", "html", "cut")
    return map_batches(told, extract, "key long, url string, text string, n_chars long").withColumnRenamed("key", key)
