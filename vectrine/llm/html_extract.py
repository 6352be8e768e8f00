"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged: elements with the same path of styles (tag,
class, role) are one node. Two entropies over the host's pages say how much a node
matters. Presentation: how varied its children's styles are. Content: how few pages
share the texts below it; a text on every page carries nothing. Branches of low
importance are removed from each page.

Elements with a meaning of their own need no statistics: text in ``article`` or
``main`` is content, text in ``nav``, ``footer``, ``form`` and the like, or under a
class such as ``ad`` or ``comments``, is not. A host with few pages is judged by
these alone, and a page that would lose all its text to the statistics (a host of
copies) keeps it.

Pages are parsed once, by a tolerant tokenizer, and written as blocks. The tree's
counts are Spark aggregations of (host, path, style) and (host, path, text hash), so
a host with a third of all pages is pre-aggregated in every task; what goes back to
the pages is each host's list of weak branches.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import over_batches, written

# Weight of the content against the presentation of the parent.
CONTENT_WEIGHT = 0.9
LEAST_IMPORTANCE = 0.2
# Fewer pages of a path say nothing about a template.
LEAST_PAGES = 8
# Weak paths of all hosts that may go to all tasks: 8 MB.
BROADCAST_PATHS = 1_000_000
HOST_SALTS = 64

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^'">]++)*+)(?:>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is not text of the page.
SKIPPED = frozenset("script style title textarea noscript template iframe svg math select object head".split())
RAW = frozenset("script style title textarea noscript template iframe".split())
NOISE_TAGS = frozenset("nav footer aside form button menu dialog label fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY_BLOCK = frozenset(["p"])
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("article main section div body html table ul ol dl td th li blockquote nav footer aside header form".split())
NOISE_NAMES = frozenset(
    "ad ads advert advertisement advertisements advertising adverts alert alertdialog banner breadcrumb breadcrumbs comment commentlist comments "
    "complementary consent contentinfo cookie cookies disclaimer disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promotion related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe subscription toolbar widget".split()
)
# Noise only outside the main text, where they open a page rather than an article.
OUTER_NAMES = frozenset("header masthead".split())
NAME = re.compile(r"[a-z0-9]+")
CONTENT, OPEN, NOISE = 1, 0, -1


def _hash(parent: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"), parent & 0xFFFFFFFFFFFFFFFF)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class Node:
    """An open element: its style path, whether its text is content, noise or neither, and the place of its block on the stack."""

    __slots__ = ("block", "children", "kind", "main", "path", "tag")

    def __init__(self, tag: str, path: int, kind: int, main: bool, block: int):
        self.tag, self.path, self.kind, self.main, self.block, self.children = tag, path, kind, main, block, []


class Page:
    """One parsed page: its text blocks in order, and the styles of its elements."""

    def __init__(self, source: str | None):
        self.blocks: list[tuple[int, int, int, str]] = []  # path, parent's path, kind, text
        self.styles: dict[int, list[int]] = {}
        self.stack = [Node("", 0, OPEN, False, 0)]
        self.open: dict[str, int] = {}  # how many elements of a tag are on the stack
        self.buffer: list[str] = []
        self._read(source or "")

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            m = TAG.search(source, at)
            stop = m.start() if m else end
            if stop > at:
                self.buffer.append(html.unescape(source[at:stop]))
            if not m:
                break
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            if m[1] or m[4]:
                self._close(tag)
                continue
            self._open(tag, m[3] or m[6] or "")
            if tag in RAW:
                shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(source, at)
                at = shut.start() if shut else end
        self._flush()
        for node in self.stack:
            self._finish(node)

    def _flush(self) -> None:
        text = " ".join("".join(self.buffer).split())
        self.buffer = []
        if text:
            # What lies in noise is noise, so the innermost element says it for all around it.
            i, inner = self.stack[-1].block, self.stack[-1].kind
            node = self.stack[i]
            self.blocks.append((node.path, self.stack[max(i - 1, 0)].path, NOISE if inner == NOISE else node.kind, text))

    def _finish(self, node: Node) -> None:
        if node.tag and node.tag not in INLINE:
            self.styles.setdefault(node.path, node.children)

    def _pop_to(self, i: int) -> None:
        while len(self.stack) > i:
            node = self.stack.pop()
            self.open[node.tag] -= 1
            self._finish(node)

    def _open(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self._flush()
            if tag != "br":
                self._imply_ends(tag)
        if tag in VOID:
            return
        above = self.stack[-1]
        names = sorted({w for m in ATTRIBUTE.finditer(attributes) for w in NAME.findall((m[2] or m[3] or m[4] or "").lower())}) if attributes.strip() else []
        role = self._kind(tag, names, above)
        path = above.path if tag in INLINE else _hash(above.path, " ".join([tag, *names]))
        if tag not in INLINE:
            self.stack[above.block].children.append(path)
        block = above.block if tag in INLINE else len(self.stack)
        self.stack.append(Node(tag, path, role, above.main or tag in CONTENT_TAGS, block))
        self.open[tag] = self.open.get(tag, 0) + 1

    def _kind(self, tag: str, names: list[str], above: Node) -> int:
        if above.kind == NOISE or tag in SKIPPED or tag in NOISE_TAGS:
            return NOISE
        if tag not in ("body", "html") and NOISE_NAMES.intersection(names):
            return NOISE
        if not above.main and (tag == "header" or (tag not in CONTENT_TAGS and OUTER_NAMES.intersection(names))):
            return NOISE
        return CONTENT if tag in CONTENT_TAGS else above.kind

    def _imply_ends(self, tag: str) -> None:
        """A block ends an open paragraph; list items, cells and terms end the one before."""
        ends = CLOSED_BY_BLOCK | SIBLINGS.get(tag, frozenset())
        i = self.stack[-1].block
        while i:
            if self.stack[i].tag in ends:
                self._pop_to(i)
                return
            if self.stack[i].tag in SCOPES:
                return
            i = self.stack[i - 1].block

    def _close(self, tag: str) -> None:
        if tag in VOID and tag != "br":
            return
        if tag not in INLINE:
            self._flush()
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._pop_to(i)
                return
            if tag in INLINE and self.stack[i].tag not in INLINE:
                return

    def candidates(self) -> list[tuple[int, int, str]]:
        """(path, parent's path, text) of the content; of what is not noise where no content is marked."""
        marked = [b for b in self.blocks if b[2] == CONTENT]
        return [(p, q, t) for p, q, k, t in marked or self.blocks if k != NOISE]


BLOCKS = "array<struct<path:long,parent:long,text:string>>"
PAIRS = "array<struct<path:long,value:long>>"


def _pairs(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"path": _signed(a), "value": _signed(b)} for a, b in row] for row in rows], pa.list_(pa.struct([("path", pa.int64()), ("value", pa.int64())])))


def _parse(batch: pa.RecordBatch) -> pa.RecordBatch:
    pages = [Page(source) for source in batch.column(2).to_pylist()]
    found = [p.candidates() for p in pages]
    kind = pa.list_(pa.struct([("path", pa.int64()), ("parent", pa.int64()), ("text", pa.string())]))
    blocks = pa.array([[{"path": _signed(a), "parent": _signed(b), "text": t} for a, b, t in row] for row in found], kind)
    texts = _pairs([sorted({(a, _hash(0, t)) for a, _, t in row}) for row in found])
    styles = _pairs([[(path, _hash(0, ",".join(map(str, kids)))) for path, kids in p.styles.items()] for p in pages])
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blocks, texts, styles], names=["page", "url", "blocks", "texts", "styles"])


def host_of(url: Column) -> Column:
    """The lower-case host; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _spread(counts: DataFrame) -> DataFrame:
    """Per (host, path): how many (``n``) and the sum of c ln c over the values' counts."""
    values = counts.groupBy("host", "path", "value").agg(F.count("*").alias("c"))
    return values.groupBy("host", "path").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log(F.col("c"))).alias("s"))


def importance(parsed: DataFrame) -> DataFrame:
    """``host, path, pages, importance`` of every path that holds text.

    Over ``pages`` pages, a text on c of them has the entropy ln c / ln pages, and the
    content's importance is one less their mean. The presentation's importance is the
    entropy of the parent's child styles over the same logarithm.
    """
    pages = F.col("pages").cast("double")
    styles = _spread(parsed.select("host", F.explode("styles").alias("x")).select("host", "x.path", "x.value"))
    texts = _spread(parsed.select("host", F.explode("texts").alias("x")).select("host", "x.path", "x.value"))
    shown = styles.select("host", F.col("path").alias("parent"), F.when(F.col("n") > 1, (F.log("n") - F.col("s") / F.col("n")) / F.log("n")).otherwise(1.0).alias("presentation"))
    above = parsed.select("host", F.explode("blocks").alias("b")).select("host", "b.path", "b.parent").groupBy("host", "path").agg(F.min("parent").alias("parent"))
    nodes = texts.join(styles.select("host", "path", F.col("n").alias("pages")), ["host", "path"]).join(above, ["host", "path"]).join(shown, ["host", "parent"], "left")
    content = F.when(pages > 1, 1 - F.col("s") / (F.col("n") * F.log(pages))).otherwise(1.0)
    return nodes.select("host", "path", "pages", (CONTENT_WEIGHT * content + (1 - CONTENT_WEIGHT) * F.coalesce("presentation", F.lit(1.0))).alias("importance"))


def _beside_hosts(pages: DataFrame, per_host: DataFrame, paths: int) -> DataFrame:
    """Pages with their host's weak paths.

    Up to ``BROADCAST_PATHS`` paths (8 bytes each) go to all tasks and the pages stay
    where they are. Beyond that both are shuffled, each host dealt to ``HOST_SALTS``
    groups, so that no host's pages meet in one task.
    """
    if paths <= BROADCAST_PATHS:
        return pages.join(F.broadcast(per_host), "host", "left")
    dealt = pages.withColumn("salt", F.pmod(F.xxhash64("page", "url"), F.lit(HOST_SALTS)))
    lists = per_host.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(HOST_SALTS - 1).cast("long"))))
    return dealt.join(lists, ["host", "salt"], "left").drop("salt")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per row of ``pages``: key, url, text, n_chars.

    A null or empty page has an empty text. Pages without a host share the empty one.
    Null keys and repeated rows are rows like any other; further columns are ignored,
    whatever their names; an empty table gives no rows.
    """
    slim = pages.select(F.col(f"`{key}`").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{source}`").cast("string").alias("source"))
    kind = slim.schema["page"].dataType.simpleString()
    parsed = slim.mapInArrow(over_batches(_parse), f"page {kind}, url string, blocks {BLOCKS}, texts {PAIRS}, styles {PAIRS}")
    parsed = written(parsed.withColumn("host", host_of(F.col("url"))))
    weak = written(importance(parsed).filter((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LEAST_IMPORTANCE)).select("host", "path"))
    per_host = weak.groupBy("host").agg(F.collect_set("path").alias("weak"))
    joined = _beside_hosts(parsed.select("page", "url", "host", "blocks"), per_host, weak.count())
    strong = F.when(F.col("weak").isNull(), F.col("blocks")).otherwise(F.filter("blocks", lambda b: ~F.array_contains(F.col("weak"), b["path"])))
    kept = joined.withColumn("strong", strong).withColumn("kept", F.when(F.size("strong") > 0, F.col("strong")).otherwise(F.col("blocks")))
    text = F.array_join(F.transform("kept", lambda b: b["text"]), "\n")
    return kept.select(F.col("page").alias(key), F.col("url").alias(url), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
