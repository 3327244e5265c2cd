"""Main text of web pages by a site style tree.

The pages of one host share a template. Their DOMs are merged: nodes with the same path of element
names, classes and ids are one node of the style tree. It counts in how many different pages a
node has which sequence of children (presentation) and which text blocks (content). What varies from page to page
is important, what repeats is not: the importance of a node is the entropy of its
presentations, and one minus the logarithm to base m of the pages that share a text block, averaged over
the blocks below it; m is the number of pages that have the node. A host with few pages leans on the
tree of all hosts. Branches of low importance are removed from each page.

Names are the tree's prior, as a single page has no entropy: ``article`` and ``main`` hold the main text,
and elements whose tag, role, class or id names a menu, header, footer, sidebar, notice, advert,
form or comments are of importance 0 unless they hold the article. Where a page has an article, what lies
outside is of importance 0, too.

Scale. Features are counted by (host, path, feature) with partial aggregates, so a host that holds a third of
all pages is no single task; only importances are grouped per host. Pages meet their host's list of
low branches, which is short, by a join that Spark may broadcast or split. Pages are parsed one at a time.

Defined cases. A null or empty html gives an empty text; a null url or one without ``://`` belongs to the
host "". Pages whose article (else whole text) is the same count once in the tree, so that copies are
not taken for a template. Unclosed and stray tags are read as browsers do, as far as text is concerned.
Repeated pages are rows of their own. An empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tributary.llm.common import arrow_rows, text_batches
from tributary.storage import write_and_read

LOW = 0.4  # branches of less importance go
WIDER = 8.0  # weight of the tree of all hosts, in pages
GAMMA = 0.9  # as the number of presentations grows, they count more and contents less

TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|/[^a-zA-Z][^>]*(?:>|\Z)"
    r"|([a-zA-Z][^\s/>]*)((?>[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*)(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|[\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAMING = re.compile(r"class|id|role", re.I)
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in ("script", "style", "title", "textarea", "noscript", "iframe", "noframes", "noembed", "xmp")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends open elements of these names, up to the first element of the second list.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
KEEPS_P = frozenset("button caption html object table td th".split())  # a paragraph outside of these stays open
MAIN_TAGS = frozenset(("article", "main"))
NOISE_TAGS = frozenset("nav footer aside form button select dialog menu search head script style title textarea noscript iframe noframes noembed template object".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adslot banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer form gdpr header login masthead "
    "menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion related replies reply respond share sharing sidebar signup "
    "skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
HEADER_WORDS = frozenset(("header", "masthead", "banner"))
NOT_ALONE = frozenset("has with no without wrapper container layout".split())  # "has-sidebar" is no sidebar


@lru_cache(maxsize=20_000)
def named(tag: str, attributes: str) -> tuple[str, int]:
    """(label of an element in the tree, 0 plain, 1 noise, 2 noise outside an article, 3 main)."""
    found = {a.lower(): (x or y or z).lower() for a, x, y, z in ATTRIBUTE.findall(attributes)} if attributes else {}
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    label = ".".join([tag, *sorted(re.sub(r"\d+", "", n) for n in names)])
    words = set()
    for n in names:
        parts = [p for p in re.split(r"[^a-z]+", n) if p]
        if parts and not NOT_ALONE & set(parts):
            words |= {parts[0], parts[-1]}
    words &= NOISE_WORDS
    if tag in NOISE_TAGS or found.get("role") in NOISE_ROLES or words - HEADER_WORDS:
        return label, 1
    if tag == "header" or words:
        return label, 2
    return label, 3 if tag in MAIN_TAGS or found.get("role") == "main" else 0


class Node:
    __slots__ = ("parent", "tag", "label", "path", "noise", "main", "holds", "inside", "children", "block")

    def __init__(self, parent: Node | None, tag: str, label: str, kind: int, block: bool):
        self.parent, self.tag, self.label, self.block, self.children = parent, tag, label, block, []
        self.inside = bool(parent and (parent.inside or parent.main))  # an article
        self.noise = kind == 1 or kind == 2 and not self.inside
        self.main = kind == 3 and not (parent and parent.lost())
        self.holds = False
        self.path = (xxhash.xxh64_intdigest(label.encode(), parent.path & 0xFFFFFFFFFFFFFFFF) - (1 << 63)) if parent else 0
        if parent and block:
            parent.children.append(label)

    def lost(self) -> bool:
        """Within comments and the like an article is no main text."""
        node = self
        while node is not None:
            if node.noise and node.tag not in ("nav", "header"):
                return True
            node = node.parent
        return False


class Page:
    """Text blocks of a page with the innermost element of each piece."""

    def __init__(self, source: str):
        self.blocks: list[list[tuple[str, Node]]] = []
        self.root = node = Node(None, "", "", 0, True)
        self.nodes = [node]
        self.pieces: list[tuple[str, Node]] = []
        self.standing: dict[str, int] = {}  # open elements by tag: deep pages are not searched in vain
        self.at, end, size = node, 0, len(source)
        while end < size:
            begin = source.find("<", end)
            if begin < 0:
                self.text(source[end:])
                break
            if begin > end:
                self.text(source[end:begin])
            m = TAG.match(source, begin)
            if m is None:
                self.text("<")
                end = begin + 1
                continue
            end = m.end()
            if m[2]:
                tag = m[2].lower()
                if tag in RAW:
                    close = RAW[tag].search(source, end)
                    end = close.start() if close else size
                    self.block_ends(tag in ("textarea", "iframe"))
                elif tag == "br":
                    self.text(" ")
                else:
                    self.open(tag, m[3])
            elif m[1]:
                self.close(m[1].lower())
        self.block_ends(True)

    def text(self, piece: str) -> None:
        self.pieces.append((unescape(piece) if "&" in piece else piece, self.at))

    def block_ends(self, ends: bool) -> None:
        if ends and self.pieces:
            self.blocks.append(self.pieces)
            self.pieces = []

    def back_to(self, node: Node) -> None:
        while self.at is not node:
            self.standing[self.at.tag] -= 1
            self.at = self.at.parent

    def up_to(self, names, stop) -> None:
        """Close elements up to the topmost one of ``names`` below the first of ``stop``."""
        if not any(self.standing.get(n) for n in names):
            return
        node, last = self.at, None
        while node.parent and node.tag not in stop:
            if node.tag in names:
                last = node
            node = node.parent
        if last:
            self.back_to(last.parent)

    def open(self, tag: str, attributes: str) -> None:
        block = tag in BLOCK
        if block:
            self.block_ends(True)
            if tag in ENDS:
                self.up_to(*ENDS[tag])
            if tag not in ("option", "optgroup", "legend", "summary"):
                self.up_to({"p"}, KEEPS_P)
        if tag in VOID:
            return
        label, kind = named(tag, attributes if NAMING.search(attributes) else "")
        node = Node(self.at, tag, label, kind, block)
        self.at = node
        self.standing[tag] = self.standing.get(tag, 0) + 1
        self.nodes.append(node)
        if node.main:
            above = node.parent
            while above and not above.holds:
                above.holds = True
                above = above.parent

    def close(self, tag: str) -> None:
        block = tag in BLOCK
        if block:
            self.block_ends(True)
        if tag in VOID:
            self.text(" ")
            return
        if not self.standing.get(tag):
            return
        node = self.at
        while node.parent and node.tag != tag:
            if node.block and not block:
                return  # a stray end of an inline element closes no block
            node = node.parent
        if node.parent:
            self.back_to(node.parent)

    def main_blocks(self, low: frozenset = frozenset()) -> list[str]:
        """Texts of the blocks that are left, in order."""
        verdicts: dict[int, bool] = {}

        def keeps(node: Node) -> bool:
            found = verdicts.get(id(node))
            if found is None:
                here = not (node.noise or node.path in low and node.tag not in ("html", "body") and not node.main) or node.holds
                found = verdicts[id(node)] = here and (node.parent is None or keeps(node.parent))
            return found

        for node in self.nodes:  # parents first, so that no recursion is deep
            keeps(node)
        kept = [" ".join("".join(x for x, n in pieces if keeps(n)).split()) for pieces in self.blocks]
        inside = [" ".join("".join(x for x, n in pieces if keeps(n) and (n.main or n.inside)).split()) for pieces in self.blocks]
        return [x for x in (inside if any(inside) else kept) if x]


def signed64(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


FEATURES = pa.schema([("host", pa.string()), ("page", pa.int64()), ("path", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("chain", pa.list_(pa.int64()))])
STYLE, CONTENT, CHAIN = range(3)


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: the presentation of each path, the text blocks at each path, and once per batch the paths above."""
    for batch in batches:
        rows: list[tuple] = []
        chains: set = set()
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source)
            digest = signed64("\n".join(page.main_blocks()))
            styles: dict[int, set[str]] = {}
            for node in page.nodes[1:]:
                if node.block:
                    runs = [c for c, before in zip(node.children, [None, *node.children]) if c != before]
                    styles.setdefault(node.path, set()).add(" ".join(runs))
                    if (host, node.path) not in chains:
                        chains.add((host, node.path))
                        chain, above = [], node
                        while above.parent:
                            if above.block:
                                chain.append(above.path)
                            above = above.parent
                        rows.append((host, 0, node.path, CHAIN, 0, chain))
            rows += [(host, digest, path, STYLE, signed64("|".join(sorted(s))), None) for path, s in styles.items()]
            seen = set()
            for pieces in page.blocks:
                text = " ".join("".join(x for x, _ in pieces).split())
                if text:
                    node = pieces[0][1]
                    while not node.block:
                        node = node.parent
                    seen.add((node.path, signed64(text)))
            rows += [(host, digest, path, CONTENT, feature, None) for path, feature in seen]
            if len(rows) > 20_000:
                yield arrow_rows(FEATURES, **dict(zip(FEATURES.names, zip(*rows))))
                rows.clear()
        if rows:
            yield arrow_rows(FEATURES, **dict(zip(FEATURES.names, zip(*rows))))


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^.*?://([^/?#]*)", 1), F.lit("")))


def importance(pages: DataFrame) -> DataFrame:
    """host, path, importance of every node of the hosts' style trees; pages: host, html."""
    raw = pages.mapInArrow(features, "host string, page long, path long, kind int, feature long, chain array<long>")
    raw = write_and_read(raw, "style-features")
    chains = raw.filter(F.col("kind") == CHAIN).groupBy("host", "path").agg(F.max("chain").alias("chain"))
    counted = raw.filter(F.col("kind") != CHAIN).select("host", "page", "path", "kind", "feature").distinct().groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n"))
    counted = write_and_read(counted, "style-counts")

    def nodes(rows: DataFrame, by: list[str]) -> DataFrame:
        style, content = F.col("kind") == STYLE, F.col("kind") == CONTENT
        m, log = F.sum(F.when(style, F.col("n"))), F.log(F.col("n").cast("double"))
        sums = rows.groupBy(*by).agg(
            m.alias("m"), F.sum(F.when(style, F.col("n") * log)).alias("s"), F.sum(style.cast("int")).alias("l"),
            F.sum(F.when(content, log)).alias("c"), F.sum(content.cast("int")).alias("k"),
        )
        many = F.col("m") > 1
        base = F.log(F.col("m").cast("double"))
        look = F.when(many, (base - F.col("s") / F.col("m")) / base).otherwise(1.0)
        text = F.when(many & (F.col("k") > 0), 1 - F.col("c") / F.col("k") / base).otherwise(1.0)
        return sums.select(*by, "m", "l", "k", look.alias("look"), text.alias("text"))

    own = nodes(counted, ["host", "path"])
    wide = nodes(counted.groupBy("path", "kind", "feature").agg(F.sum("n").alias("n")), ["path"]).select("path", F.col("look").alias("wide_look"), F.col("text").alias("wide_text"))
    mixed = lambda c: (F.col("m") * F.col(c) + WIDER * F.col(f"wide_{c}")) / (F.col("m") + WIDER)
    both = own.join(wide, "path").select("host", "path", "l", "k", mixed("look").alias("look"), mixed("text").alias("text"))
    both = both.join(chains, ["host", "path"])
    below = both.select("host", F.explode("chain").alias("path"), "k", (F.col("k") * F.col("text")).alias("t")).groupBy("host", "path").agg(F.sum("k").alias("blocks"), F.sum("t").alias("t"))
    weight = F.pow(F.lit(GAMMA), "l")
    content = F.when(F.col("blocks") > 0, F.col("t") / F.col("blocks")).otherwise(F.col("look"))
    return both.select("host", "path", "l", "look").join(below, ["host", "path"]).select("host", "path", ((1 - weight) * F.col("look") + weight * content).alias("importance"))


TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [" ".join(Page(source).main_blocks(frozenset(low or ()))) for source, low in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(found, pa.string()), pa.array(np.array([len(x) for x in found], np.int64))], schema=TEXTS
        )


def extract(pages: DataFrame, low: float = LOW) -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page."""
    text_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host_of(F.col("url")).alias("host"))
    branches = importance(rows.select("host", "html")).filter(F.col("importance") < low)
    per_host = write_and_read(branches.groupBy("host").agg(F.collect_list("path").alias("low")), "style-low")
    return rows.join(per_host, "host", "left").select("page_id", "url", "html", "low").mapInArrow(texts, "page_id long, url string, text string, n_chars long")
