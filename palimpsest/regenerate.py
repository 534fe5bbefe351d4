"""Runs over a library's folders: markup and metadata to XML and HTML, XML back to markup, and metadata by itself.

A library lies under one folder: `txt/*.txt` with companions in `txt/chaya/*.txt`, `metadata/*.md`, `xml/stem=<id>/`, and
made from these `html/`, `plain/`, `facts/` and `metadata.json/`. Each run is one Spark plan over all documents.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sinks
from .functions import markdown
from .operators import header, lines, metadata
from .plans import edition
from .session import session
from .sources import texts, xml


def companions(spark: SparkSession, folder: str, config: DataFrame | None) -> DataFrame | None:
    """Companion lists of the documents that are set to have one and do."""
    if not texts.exists(spark, f"{folder}/chaya"):
        return None
    found = texts.companions(texts.read_texts(spark, f"{folder}/chaya"))
    return found if config is None or "split_glosses" not in config.columns else found.join(config.where("split_glosses").select("doc_id"), "doc_id", "left_semi")


def to_xml(spark: SparkSession, root: str, config: DataFrame | None = None, template: str | None = None, licences: dict[str, str] | None = None, mark: str = "") -> None:
    """txt and metadata to XML. A document that has one half alone keeps the other half of the XML that is there."""
    made = edition.rendered(texts.read_lines(spark, f"{root}/txt"), config, companions(spark, f"{root}/txt", config))
    bodies = made.select("doc_id", F.col("xml").alias("body"))
    headers = None
    if template and texts.exists(spark, f"{root}/metadata"):
        found = header.metadata(header.fields(texts.read_lines(spark, f"{root}/metadata", "*.md")))
        headers = header.build(found, template, licences or {}, mark)
    empty = spark.createDataFrame([], "doc_id string, header string, body string")
    old = sinks.read_documents(spark, f"{root}/xml").select("doc_id", *xml.halves(F.col("text"))) if texts.exists(spark, f"{root}/xml") else empty
    whole = header.replaced(old, headers, bodies).withColumn("xml", sinks.tei(F.col("header"), F.col("body")))
    sinks.write_documents(whole.select("doc_id", "xml").checkpoint(), f"{root}/xml", "xml")


def _nodes(spark: SparkSession, root: str) -> DataFrame:
    return xml.nodes(sinks.read_documents(spark, f"{root}/xml").withColumnRenamed("text", "xml"))


def to_txt(spark: SparkSession, root: str, config: DataFrame | None = None) -> None:
    """XML back to markup, with companion lists."""
    sinks.write_with_companions(edition.rendered_nodes(_nodes(spark, root), config), f"{root}/txt-made")


def to_html(spark: SparkSession, root: str, config: DataFrame | None = None, standalone: bool = False) -> None:
    """Both projections of every document, and the facts beside them; what has no source any more goes."""
    if texts.exists(spark, f"{root}/metadata"):
        shown = markdown.entries(metadata.sections(texts.read_lines(spark, f"{root}/metadata", "*.md")))
        config = shown if config is None else config.join(shown, "doc_id", "full")
    made = edition.rendered_nodes(_nodes(spark, root), config).checkpoint()
    if standalone:
        frame = F.lit(edition.standalone_frame())
        made = made.withColumn("html", F.replace(F.replace(frame, F.lit("{{ title }}"), F.col("doc_id")), F.lit("{{ content_html | safe }}"), F.col("html")))
    for name, column in (("html", "html"), ("plain", "plain"), ("facts", "facts")):
        sinks.write_documents(made, f"{root}/{name}", column)
        sinks.delete_stale(spark, f"{root}/{name}", made)


def to_metadata(spark: SparkSession, root: str, version: str, allowed: list[str] | None = None) -> None:
    """One JSON object of all records, and the HTML of each."""
    found = metadata.sections(texts.read_lines(spark, f"{root}/metadata", "*.md"))
    header.consolidated(metadata.records(found), version).select(F.col("json").alias("value")).write.mode("overwrite").text(f"{root}/metadata.json")
    pages = markdown.sections_html(found, allowed)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "html"))), lambda x: x["html"]), "\n")
    sinks.write_documents(pages.groupBy("doc_id").agg(joined.alias("html")), f"{root}/metadata-html", "html")


def numbered(spark: SparkSession, source: str, out: str) -> None:
    """Page and line numbers put into bare location marks of every text."""
    filled = lines.with_page_lines(texts.read_lines(spark, source))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "filled"))), lambda x: x["filled"]), "\n")
    sinks.write_documents(filled.groupBy("doc_id").agg(text.alias("text")), out, "text")


def everything(spark: SparkSession, root: str, mode: str = "xml", version: str = "0", config: DataFrame | None = None, **header_parts) -> None:
    """Metadata, then XML from markup or markup from XML, then HTML."""
    if texts.exists(spark, f"{root}/metadata"):
        to_metadata(spark, root, version)
    if mode == "xml":
        to_xml(spark, root, config, **header_parts)
    else:
        to_txt(spark, root, config)
    to_html(spark, root, config)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("what", choices=["all", "xml", "txt", "html", "metadata", "numbers"])
    parser.add_argument("root", help="the library's folder")
    parser.add_argument("--config", help="Parquet table of settings by doc_id")
    parser.add_argument("--back", action="store_true", help="with all: XML to markup instead of markup to XML")
    parser.add_argument("--standalone", action="store_true", help="with html: whole pages")
    parser.add_argument("--data-version", default="0")
    given = parser.parse_args(arguments)
    spark = session()
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", f"{given.root}/.checkpoints"))
    config = spark.read.parquet(given.config) if given.config else None
    if given.what == "all":
        everything(spark, given.root, "txt" if given.back else "xml", given.data_version, config)
    elif given.what == "xml":
        to_xml(spark, given.root, config)
    elif given.what == "txt":
        to_txt(spark, given.root, config)
    elif given.what == "html":
        to_html(spark, given.root, config, given.standalone)
    elif given.what == "metadata":
        to_metadata(spark, given.root, given.data_version)
    else:
        numbered(spark, f"{given.root}/txt", f"{given.root}/txt-numbered")


if __name__ == "__main__":
    main()
