"""Records and links out of a table of HTML pages.

Pages arrive as rows (page id, url, html); parsing runs per row inside
``mapInPandas`` with the standard-library ``html.parser``, so the work is
spread over the partitions of the pages table.  A small selector helper
supports what listing pages need: ``tag``, ``.class``, ``tag.class`` and
descendant chains (``"h3 a"``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanthorn.functions.text import resolve_url

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}


@dataclass
class Node:
    tag: str
    attrs: dict
    parent: "Node | None" = None
    children: list = field(default_factory=list)  # Node or str

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def strings(self):
        """Text below the node in order; an explicit stack, as pages may nest deeply."""
        stack = [iter(self.children)]
        while stack:
            ch = next(stack[-1], None)
            if ch is None:
                stack.pop()
            elif isinstance(ch, str):
                yield ch
            elif ch.tag not in ("script", "style"):
                stack.append(iter(ch.children))

    def text(self, strip: bool = True) -> str:
        if strip:
            return "".join(s.strip() for s in self.strings())
        return "".join(self.strings())

    def stripped_strings(self) -> list[str]:
        return [s.strip() for s in self.strings() if s.strip()]

    def descendants(self):
        stack = [iter(self.children)]
        while stack:
            ch = next(stack[-1], None)
            if ch is None:
                stack.pop()
            elif isinstance(ch, Node):
                yield ch
                stack.append(iter(ch.children))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {})
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in _VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v or "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def _simple_match(node: Node, simple: str) -> bool:
    parts = simple.split(".")
    tag, classes = parts[0], parts[1:]
    if tag and node.tag != tag:
        return False
    have = node.classes
    return all(c in have for c in classes)


def select(root: Node, selector: str) -> list[Node]:
    """Descendant-combinator selector over simple ``tag.class`` steps."""
    steps = selector.split()
    current = [root]
    for step in steps:
        found, seen = [], set()
        for base in current:
            for d in base.descendants():
                if id(d) not in seen and _simple_match(d, step):
                    seen.add(id(d))
                    found.append(d)
        current = found
    return current


def select_one(root: Node, selector: str) -> Node | None:
    hits = select(root, selector)
    return hits[0] if hits else None


@dataclass(frozen=True)
class FieldSpec:
    """One output field: a selector inside the record and what to read.

    ``how``: ``text`` (stripped text), ``joined`` (stripped strings joined
    by one space), ``attr:<name>``, ``first_class_except:<name>`` or
    ``count`` (number of matches, never null).
    """
    name: str
    selector: str
    how: str = "text"


def _read(record: Node, spec: FieldSpec):
    if spec.how == "count":
        return len(select(record, spec.selector)) if spec.selector else 1
    node = record if not spec.selector else select_one(record, spec.selector)
    if node is None:
        return None
    if spec.how == "text":
        return node.text()
    if spec.how == "joined":
        return " ".join(node.stripped_strings())
    if spec.how.startswith("attr:"):
        return node.attrs.get(spec.how[5:])
    if spec.how.startswith("first_class_except:"):
        skip = spec.how.split(":", 1)[1]
        return next((c for c in node.classes if c != skip), None)
    raise ValueError(spec.how)


def extract_records(pages: DataFrame, key: str, html: str, record_selector: str,
                    fields: Sequence[FieldSpec], keep: Sequence[str] = ()) -> DataFrame:
    """One row per element matching ``record_selector`` in every page.

    A missing field gives null and never drops the record.  ``keep``
    columns of the page (e.g. its category) are carried to each record.
    """
    src = pages.select(key, *keep, html)
    schema = T.StructType(
        [src.schema[key], *[src.schema[k] for k in keep], T.StructField("position", T.IntegerType())]
        + [T.StructField(f.name, T.IntegerType() if f.how == "count" else T.StringType()) for f in fields])
    fields = list(fields)
    keep = list(keep)

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                d = rec._asdict()
                root = parse(d[html])
                for pos, node in enumerate(select(root, record_selector) if record_selector else [root]):
                    rows.append([d[key], *[d[k] for k in keep], pos, *[_read(node, f) for f in fields]])
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    return src.mapInPandas(run, schema)


def extract_links(pages: DataFrame, key: str, url: str, html: str, selector: str = "a") -> DataFrame:
    """Every ``href`` under ``selector``: (page, position, text, href, resolved url)."""
    src = pages.select(key, url, html)
    schema = T.StructType([src.schema[key], src.schema[url], T.StructField("position", T.IntegerType()),
                           T.StructField("text", T.StringType()), T.StructField("href", T.StringType())])

    def run(batches):
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                d = rec._asdict()
                anchors = [a for a in select(parse(d[html]), selector) if "href" in a.attrs]
                for pos, a in enumerate(anchors):
                    rows.append([d[key], d[url], pos, a.text(), a.attrs["href"]])
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields])

    links = src.mapInPandas(run, schema)
    return links.withColumn("resolved", resolve_url(F.col(url), F.col("href")))


def follow_links(edges: DataFrame, starts: DataFrame, src: str, dst: str, max_hops: int | None = None) -> DataFrame:
    """Pages reachable from each start by following ``src -> dst`` edges.

    Output (start, node, hop), a node at its smallest hop.  Where every page has one successor at most (pagination) the
    chains are walked by pointer doubling (``chains_by_doubling``), so the joins grow with the logarithm
    of the longest chain; pages with several successors are walked hop by hop.
    """
    e = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("dst IS NOT NULL").distinct().checkpoint(eager=True)
    first = starts.select(F.col(src).alias("start")).distinct()
    if e.groupBy("src").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return chains_by_doubling(e, first, max_hops)
    return _by_hops(e, first, max_hops)


def chains_by_doubling(edges: DataFrame, starts: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(start, node, hop) along ``edges`` (src, dst), one successor per page at most.

    Round j holds every page's 2^j-th successor and, of each start, the first 2^j pages; joining the two gives the next
    2^j pages, and joining the pointers with themselves the pointers of the next round.  A start whose chain runs into a cycle
    meets pages again; those are dropped, and the rounds end when no start meets a new one.  Each round
    is written with ``checkpoint()`` to the shared folder.
    """
    reached = starts.select("start", F.col("start").alias("node"), F.lit(0).cast("bigint").alias("hop")).checkpoint(eager=True)
    pointers, span, parts = edges, 1, [reached]
    while max_hops is None or span <= max_hops:
        whole = reduce(DataFrame.unionByName, parts)
        new = whole.join(pointers, F.col("node") == F.col("src")).select(
            "start", F.col("dst").alias("node"), (F.col("hop") + span).alias("hop"))
        if max_hops is not None:
            new = new.where(F.col("hop") <= max_hops)
        new = new.groupBy("start", "node").agg(F.min("hop").alias("hop"))
        new = new.join(whole.select("start", "node"), ["start", "node"], "left_anti").checkpoint(eager=True)
        if new.isEmpty():
            break
        parts.append(new)
        ahead = pointers.select(F.col("src").alias("mid"), F.col("dst").alias("far"))
        pointers = pointers.join(ahead, F.col("dst") == F.col("mid")).select("src", F.col("far").alias("dst")).checkpoint(eager=True)
        span *= 2
    return reduce(DataFrame.unionByName, parts)


def _by_hops(e: DataFrame, starts: DataFrame, max_hops: int | None) -> DataFrame:
    """One join of the frontier with the edges per hop; a visited set (anti join) ends cycles.

    Every hop's frontier is written with ``checkpoint()`` to the shared folder, so the emptiness test and the
    next hop read that instead of recomputing earlier hops, and a lost executor costs one hop, not the whole chain.
    """
    frontier = starts.select("start", F.col("start").alias("node"), F.lit(0).cast("bigint").alias("hop")).checkpoint(eager=True)
    parts, hop = [frontier], 0
    while max_hops is None or hop < max_hops:
        hop += 1
        seen = reduce(DataFrame.unionByName, parts).select("start", "node")
        frontier = (frontier.join(e, F.col("node") == F.col("src"))
                    .select("start", F.col("dst").alias("node"), F.lit(hop).cast("bigint").alias("hop"))
                    .join(seen, ["start", "node"], "left_anti").dropDuplicates(["start", "node"]).checkpoint(eager=True))
        if frontier.isEmpty():
            break
        parts.append(frontier)
    return reduce(DataFrame.unionByName, parts)


def required_nonempty(df: DataFrame, what: str) -> DataFrame:
    """Raise when a frame that must have rows (e.g. the category list) is empty."""
    if df.limit(1).count() == 0:
        raise RuntimeError(f"No {what} were found.")
    return df


__all__ = ["FieldSpec", "extract_records", "extract_links", "follow_links", "parse", "select",
           "select_one", "required_nonempty"]
