"""Markup as tables: nodes, anchors, text, ids and links of HTML documents.

Markup isn't well-formed, so one Arrow function per batch parses it with the standard library; all that
follows is relational.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

#: Elements without content, and elements that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NODE = "node_id int, parent_id int, pos int, depth int, tag string, attrs map<string,string>, text string, tail string"


class _Tree(HTMLParser):
    """Flat nodes in document order with the text before the first child and after the element."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[int] = []
        self.counts: dict[int, int] = {}
        self.last: int | None = None  # the element that was closed last at this level

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "p" and self.open and self.nodes[self.open[-1]]["tag"] == "p":
            self.handle_endtag("p")
        parent = self.open[-1] if self.open else -1
        pos = self.counts[parent] = self.counts.get(parent, -1) + 1
        self.nodes.append({"node_id": len(self.nodes), "parent_id": parent, "pos": pos, "depth": len(self.open), "tag": tag, "attrs": [(k, v or "") for k, v in dict(attrs).items()], "text": None, "tail": None})
        if tag in VOID:
            self.last = len(self.nodes) - 1
        else:
            self.open.append(len(self.nodes) - 1)
            self.last = None

    def handle_endtag(self, tag: str) -> None:
        if any(self.nodes[i]["tag"] == tag for i in self.open):
            while self.open:
                i = self.open.pop()
                if self.nodes[i]["tag"] == tag:
                    self.last = i
                    return

    def handle_data(self, data: str) -> None:
        at, key = (self.last, "tail") if self.last is not None else (self.open[-1] if self.open else None, "text")
        if at is not None:
            self.nodes[at][key] = (self.nodes[at][key] or "") + data


def parse(markup: str | None) -> list[dict]:
    tree = _Tree()
    tree.feed(markup or "")
    tree.close()
    return tree.nodes


def html_nodes(pages: DataFrame, key: str, markup: str = "html") -> DataFrame:
    """One row per element; null and empty markup has none, broken markup as the parser repairs it."""
    kind = StructType([*pages.select(key).schema.fields, *StructType.fromDDL(NODE).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [parse(h.as_py()) for h in b.column(1)]
            at = pa.array([i for i, nodes in enumerate(each) for _ in nodes], pa.int64())
            flat = [n for nodes in each for n in nodes]
            ints = [pa.array([n[c] for n in flat], pa.int32()) for c in ("node_id", "parent_id", "pos", "depth")]
            rest = [pa.array([n["tag"] for n in flat], pa.string()), pa.array([n["attrs"] for n in flat], pa.map_(pa.string(), pa.string())), *(pa.array([n[c] for n in flat], pa.string()) for c in ("text", "tail"))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), *ints, *rest], names=kind.names)

    return pages.select(key, markup).mapInArrow(run, kind)


def tag_frequency(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("tag").agg(F.count("*").alias("n"))


def top_classes(nodes: DataFrame, key: str, most: int = 10) -> DataFrame:
    """The most common classes of each document, ties by name."""
    counts = nodes.where(F.element_at("attrs", "class").isNotNull()).groupBy(key, F.element_at("attrs", "class").alias("class")).agg(F.count("*").alias("n"))
    order = Window.partitionBy(key).orderBy(F.desc("n"), "class")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def anchors(nodes: DataFrame, key: str) -> DataFrame:
    """(key, node_id, href, text) of links."""
    return nodes.where((F.col("tag") == "a") & F.element_at("attrs", "href").isNotNull()).select(key, "node_id", F.element_at("attrs", "href").alias("href"), "text")


def absolute(pairs: DataFrame, base: str, href: str, out: str = "url") -> DataFrame:
    """Links against the address of their page."""
    kind = StructType([*pairs.schema.fields, *StructType.fromDDL(f"{out} string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls = [None if u is None or h is None else urljoin(u, h) for u, h in zip(b.column(base).to_pylist(), b.column(href).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(urls, pa.string())], names=[*b.schema.names, out])

    return pairs.mapInArrow(run, kind)


def dialect(nodes: DataFrame, key: str) -> DataFrame:
    """Which kind of document a page is, by the first rule that holds over counts of classes and styles."""
    cls, styled = F.coalesce(F.element_at("attrs", "class"), F.lit("")), F.element_at("attrs", "style").isNotNull()
    has = lambda c: F.bool_or(cls == c)
    p = F.count_if(F.col("tag") == "p")
    s = F.count_if((F.col("tag") == "p") & styled)
    top = top_classes(nodes, key).where(F.col("class").isin("Normal", "num")).groupBy(key).agg((F.count("*") == 2).alias("__proposal"))
    facts = nodes.groupBy(key).agg(has("alert").alias("alert"), F.bool_or(F.element_at("attrs", "id") == "txt_te").alias("txt_te"), has("ti-art").alias("ti_art"), has("title-article-norm").alias("norm"), p.alias("p"), s.alias("s"))
    facts = facts.join(top, key, "left")
    ratio = F.when(F.col("p") + F.col("s") > 0, 1 - 2 * (F.col("p") - F.col("s")) / (F.col("p") + F.col("s")))
    rule = (
        F.when(F.col("alert"), "not_found").when(F.col("txt_te"), "old_original").when(F.col("ti_art"), "modern_original").when(F.col("norm"), "modern_consolidated")
        .when(F.col("__proposal"), "proposal").when(ratio > 0.9, "old_consolidated").otherwise("unsupported")
    )
    return facts.select(key, rule.alias("dialect"))


def unique_ids(rows: DataFrame, doc: str, node: str, order: str) -> DataFrame:
    """Ids that repeat in a document get --k from the second on."""
    k = F.row_number().over(Window.partitionBy(doc, node).orderBy(order))
    return rows.withColumn(node, F.when(k > 1, F.concat(F.col(node), F.lit("--"), k - 1)).otherwise(F.col(node)))


def dangling(links: DataFrame, ids: DataFrame, doc: str, target: str, node: str) -> DataFrame:
    """Links within a document to ids that it doesn't have."""
    return links.join(ids.select(F.col(doc), F.col(node).alias(target)).distinct(), [doc, target], "left_anti")


def id_of(parts: Column) -> Column:
    """An item's id of the labels above it, without their decoration."""
    return F.array_join(F.transform(parts, lambda x: F.btrim(x, F.lit("().  "))), "-")
