"""XML texts as node tables. Mixed content keeps its order, which Spark's own XML reader doesn't."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..arrow import batched, taken
from ..plans.edition import NODES, Node, rows_of


def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def _made(element: ET.Element) -> Node:
    kept = lambda s: s if s and s.strip() else ""
    return Node(_local(element.tag), {_local(k): v for k, v in element.attrib.items()}, kept(element.text), kept(element.tail))


def parse(xml: str, under: str = "body") -> Node:
    """The first element of that name, or the whole text. Names lose their namespaces, blank texts and comments go.

    Elements may nest to any depth.
    """
    found = ET.fromstring(xml)
    found = next((e for e in found.iter() if isinstance(e.tag, str) and _local(e.tag) == under), found)
    root = _made(found)
    root.tail = ""
    stack = [(found, root)]
    while stack:
        element, node = stack.pop()
        for child in element:
            if isinstance(child.tag, str):
                node.inner.append(_made(child))
                stack.append((child, node.inner[-1]))
    return root


def nodes(texts: DataFrame, under: str = "body") -> DataFrame:
    """(doc_id, xml) -> node rows. A text that isn't XML has none; `malformed` lists these."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for r in taken(batches):
            try:
                root = parse(r.xml or "", under)
            except ET.ParseError:
                continue
            yield from rows_of(str(r.doc_id), root)

    return texts.select("doc_id", "xml").mapInArrow(lambda batches: batched(rows(batches), NODES), NODES)


def malformed(texts: DataFrame) -> DataFrame:
    """Issues (doc_id, rule, severity, detail) of texts that aren't XML."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, xml in zip(b["doc_id"], b["xml"], strict=True):
                try:
                    ET.fromstring(xml or "")
                except ET.ParseError as e:
                    rows.append((str(doc), "not-xml", "error", str(e)))
            yield pd.DataFrame(rows, columns=["doc_id", "rule", "severity", "detail"])

    return texts.select("doc_id", "xml").mapInPandas(run, "doc_id string, rule string, severity string, detail string")


def halves(xml: Column) -> list[Column]:
    """header and body of whole documents, as they are written; null where there is none."""
    part = lambda name: F.nullif(F.regexp_extract(xml, rf"(?s)<{name}\b.*</{name}>|<{name}\b[^>]*/>", 0), F.lit(""))
    return [part("teiHeader").alias("header"), part("body").alias("body")]
