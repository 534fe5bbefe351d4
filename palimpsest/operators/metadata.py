"""Markdown metadata as sections, typed values, links, dates and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import file_type, strip
from .lines import in_order, island, so_far


def sections(doc_lines: DataFrame) -> DataFrame:
    """(doc_id, ord, field, kind, value, items) of `# ` sections of ordered lines.

    Blank lines at a section's edges go. If all that is left are bullets, the section is a list, else one string.
    Text before the first heading belongs to no section.
    """
    w = in_order()
    heading = F.regexp_extract("line", "^# (.+)$", 1)
    marked = doc_lines.withColumn("_head", F.when(F.col("line").rlike("^# .+"), strip(heading))).withColumn("ord", island(F.col("_head").isNotNull(), w)).where("ord > 0")
    body = F.transform(F.sort_array(F.collect_list(F.when(F.col("_head").isNull(), F.struct("line_no", "line")))), lambda x: x["line"])
    found = marked.groupBy("doc_id", "ord").agg(F.max("_head").alias("field"), body.alias("_body"))
    text = F.regexp_replace(F.array_join("_body", "\n"), r"^\n+|\n+$", "")
    found = found.withColumn("_text", text)  # columns of their own, which are worked out once and not again for each line
    found = found.withColumn("_parts", F.when(F.col("_text") != "", F.split("_text", "\n")).otherwise(F.array().cast("array<string>")))
    parts = F.col("_parts")
    bullets = (F.size(parts) > 0) & F.forall(parts, lambda x: x.rlike(r"^[-*]\s+"))
    listed = F.when(bullets, F.transform(parts, lambda x: F.regexp_replace(x, r"^[-*]\s+", "")))
    return found.select("doc_id", "ord", "field", F.when(bullets, "list").otherwise("text").alias("kind"), F.when(~bullets, strip(F.array_join(parts, " "))).alias("value"), listed.alias("items"))


def records(found: DataFrame) -> DataFrame:
    """(doc_id, fields): a map of each document's sections; of equal headings the last one counts. A page offset is always there."""
    value = F.struct("value", "items")
    last = found.groupBy("doc_id", "field").agg(F.max_by(value, "ord").alias("v"))
    default = F.map_from_arrays(F.array(F.lit("PDF Page Offset")), F.array(F.struct(F.lit(None).cast("string").alias("value"), F.array(F.lit("1 → 1")).alias("items"))))
    fields = F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "v"))))
    made = last.groupBy("doc_id").agg(fields.alias("fields"))
    return made.withColumn("fields", F.when(F.map_contains_key("fields", "PDF Page Offset"), F.col("fields")).otherwise(F.map_concat("fields", default)))


def parse_link(item: Column) -> Column:
    """{text, url, description, filetype} of `[text](url): description`, or null."""
    pattern = r"(?s)^[^\[\]()]*\[([^\[\]()]*)\][^()]*\(([^()]*)\)(.*)$"
    url = F.regexp_extract(item, pattern, 2)
    placed = F.when(url.startswith("miscellaneous/"), F.concat(F.lit("/static/data/"), url)).when(url.startswith("/miscellaneous/"), F.concat(F.lit("/static/data"), url)).otherwise(url)
    description = strip(F.regexp_replace(strip(F.regexp_extract(item, pattern, 3)), "^:", ""))
    made = F.struct(F.regexp_extract(item, pattern, 1).alias("text"), placed.alias("url"), description.alias("description"), file_type(placed).alias("filetype"))
    return F.when(item.rlike(pattern), made)


def page_offsets(items: Column) -> Column:
    """Pairs (book, pdf) of `a → b` or `a,b` items; items that aren't pairs of numbers drop out, and (1, 1) stands for none."""
    pair = lambda x: F.transform(F.split(x, F.when(x.contains("→"), "→").otherwise(",")), lambda p: F.try_to_number(strip(p), F.lit("999999999")).cast("int"))
    made = F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), pair), lambda p: (F.size(p) == 2) & F.forall(p, lambda v: v.isNotNull()))
    return F.when(F.size(made) > 0, F.transform(made, lambda p: F.struct(p[0].alias("book"), p[1].alias("pdf")))).otherwise(F.array(F.struct(F.lit(1).alias("book"), F.lit(1).alias("pdf"))))


def as_of(pages: DataFrame, steps: DataFrame, by: list[str], at: str, step_at: str, value: str) -> DataFrame:
    """Each page with the value of the latest step at or before it, by one sort of both instead of a range join."""
    left = pages.withColumn("_step", F.lit(None).cast(steps.schema[value].dataType)).withColumn("_kind", F.lit(1)).withColumn("_at", F.col(at))
    right = steps.select(*by, F.col(step_at).alias("_at"), F.struct(step_at, value).alias("_s"))
    left = left.drop("_step").withColumn("_s", F.lit(None).cast(right.schema["_s"].dataType))
    both = left.unionByName(right.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    w = so_far(Window.partitionBy(*by).orderBy("_at", "_kind"))
    filled = both.withColumn("_found", F.last("_s", ignorenulls=True).over(w)).where("_kind = 1")
    return filled.select(*pages.columns, F.col(f"_found.{step_at}").alias(f"step_{step_at}"), F.col(f"_found.{value}").alias(value))


def latest(*dates: Column) -> Column:
    """The latest of some dates, nulls left out."""
    return F.greatest(*dates)


def years(text: Column) -> tuple[Column, Column]:
    """First and last four-digit number of a text, or nulls."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"\b(\d{4})\b"), F.lit(1)), lambda x: x.cast("int"))
    return F.array_min(found), F.array_max(found)


def stale(outputs: DataFrame, sources: DataFrame, on: str = "stem") -> DataFrame:
    """Outputs whose source is gone."""
    return outputs.join(sources.select(on), on, "left_anti")


def with_config(docs: DataFrame, config: DataFrame, on: str, defaults: dict) -> DataFrame:
    """docs with a configuration row each; where there is none, defaults. Spark broadcasts the table if it is small."""
    return docs.join(config, on, "left").na.fill(defaults)


def lower_lookup(left: DataFrame, right: DataFrame, left_on: str, right_on: str, value: str) -> DataFrame:
    """Case-insensitive lookup; of several matches the least value."""
    first = right.groupBy(F.lower(right_on).alias("_key")).agg(F.min(value).alias(value))
    return left.join(first, F.lower(left_on) == F.col("_key"), "left").drop("_key")
