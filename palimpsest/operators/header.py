"""Header fields from metadata: placeholders, dates, changes, licences."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lines import in_order, island


def fill(template: Column, values: dict[str, Column]) -> Column:
    """{{KEY}} replaced by its value; what has none goes."""
    for key, value in values.items():
        template = F.replace(template, F.lit("{{" + key + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return F.regexp_replace(template, r"\{\{[A-Z_0-9]+\}\}", "")


def repeated(items: Column, template: str, placeholder: str) -> Column:
    """The template once for each item, nothing for none."""
    return F.array_join(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.replace(F.lit(template), F.lit(placeholder), x)), "")


def dated(*dates: Column) -> Column:
    """{iso, year, long} of the latest of some ISO dates; values that aren't dates don't count."""
    parsed = [F.coalesce(F.try_to_timestamp(d), F.lit(None).cast("timestamp")).cast("date") for d in dates]
    last = parsed[0] if len(parsed) == 1 else F.greatest(*parsed)
    return F.struct(F.date_format(last, "yyyy-MM-dd").alias("iso"), F.year(last).alias("year"), F.date_format(last, "MMMM dd, yyyy").alias("long"))


def change(item: Column, mark: str) -> Column:
    """{when, who, what, ours} of `(when) who: what`; ours says whether what names the mark."""
    pattern = r"(?s)^\(([^)]*)\)\s*([^:]*):\s*(.*)$"
    what = F.regexp_extract(item, pattern, 3)
    return F.when(item.rlike(pattern), F.struct(F.regexp_extract(item, pattern, 1).alias("when"), F.trim(F.regexp_extract(item, pattern, 2)).alias("who"), what.alias("what"), F.contains(what, F.lit(mark)).alias("ours")))


def licensed(docs: DataFrame, licences: DataFrame, on: str = "licence") -> DataFrame:
    """docs with their licence's text; an unknown licence fails the job."""
    joined = docs.join(licences.withColumn("_known", F.lit(True)), on, "left")
    known = F.when(F.col("_known"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unknown licence: "), F.coalesce(F.col(on), F.lit("none")))).cast("boolean"))
    return joined.where(known).drop("_known")


def assemble(headers: DataFrame, bodies: DataFrame) -> DataFrame:
    """(doc_id, xml) of headers and bodies; either may be missing, in whatever order they were made."""
    joined = headers.join(bodies, "doc_id", "full")
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    return joined.select("doc_id", F.concat(F.lit("<TEI>"), empty("header"), F.lit("<text>"), empty("body"), F.lit("</text></TEI>")).alias("xml"))


def replaced(existing: DataFrame, headers: DataFrame | None = None, bodies: DataFrame | None = None) -> DataFrame:
    """(doc_id, header, body) of existing documents with one half or both made anew; what isn't made anew stays."""
    out = existing
    for made, name in ((headers, "header"), (bodies, "body")):
        if made is not None:
            new = made.select("doc_id", F.col(name).alias(f"new_{name}"))
            out = out.join(new, "doc_id", "full").withColumn(name, F.coalesce(f"new_{name}", name)).drop(f"new_{name}")
    return out.select("doc_id", "header", "body")


def xml_escape(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def fields(doc_lines: DataFrame) -> DataFrame:
    """(doc_id, ord, field, kind, value, items, pairs) of `# ` sections as a header reads them.

    Lines are stripped and blank ones don't count. If all begin with a dash and none has a colon, they are a list; if any
    has a colon, `key: value` pairs, where a key's last value stands at its first place; else a text of lines.
    """
    w = in_order()
    line = F.regexp_replace(F.col("line"), r"(?U)^\s+|\s+$", "")
    marked = doc_lines.select("doc_id", "line_no", line.alias("line")).where("line <> ''")
    marked = marked.withColumn("head", F.col("line").startswith("# ")).withColumn("ord", island(F.col("head"), w)).where("ord > 0")
    items = F.transform(F.array_sort(F.collect_list(F.when(~F.col("head"), F.struct("line_no", "line")))), lambda x: x["line"])
    found = marked.groupBy("doc_id", "ord").agg(F.max(F.when(F.col("head"), F.trim(F.substring("line", 3, 1 << 30)))).alias("field"), items.alias("lines"))
    without_dash = lambda x: F.when(x.startswith("- "), F.substring(x, 3, 1 << 30)).otherwise(x)
    listed = (F.size("lines") > 0) & F.forall("lines", lambda x: x.startswith("- ") & ~x.contains(":"))
    paired = ~listed & F.exists("lines", lambda x: x.contains(":"))
    split = F.transform(F.filter("lines", lambda x: x.contains(":")), lambda x: F.struct(F.trim(F.substring_index(without_dash(x), ":", 1)).alias("key"), F.trim(F.regexp_replace(without_dash(x), "^[^:]*:", "")).alias("value")))
    keys = F.array_distinct(F.transform(split, lambda e: e["key"]))
    pairs = F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(split, lambda e: e["key"] == k), -1)["value"].alias("value")))
    kind = F.when(listed, "list").when(paired, "pairs").otherwise("text")
    return found.select(
        "doc_id", "ord", "field", kind.alias("kind"), F.when(~listed & ~paired, F.array_join("lines", "\n")).alias("value"), F.when(listed, F.transform("lines", lambda x: F.trim(F.substring(x, 3, 1 << 30)))).alias("items"), F.when(paired, pairs).alias("pairs")
    )


def metadata(found: DataFrame) -> DataFrame:
    """(doc_id, meta): each document's fields by name, the last of equal ones."""
    value = F.struct("kind", "value", "items", "pairs")
    last = found.groupBy("doc_id", "field").agg(F.max_by(value, "ord").alias("v"), F.min("ord").alias("at"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("at", "field", "v"))), lambda e: F.struct(e["field"], e["v"]))
    return last.groupBy("doc_id").agg(F.map_from_entries(entries).alias("meta"))


class Template:
    """A header template, cut where parts repeat or are exchanged. Comments go.

    Parts are the first `author`, the first `respStmt`, what `availability` holds, the publication `date`, the first
    `change`, and the paragraph whose id is that of the textual units.
    """

    PARTS = {
        "author": r"<author\b[^>]*>.*?</author>",
        "respStmt": r"<respStmt\b[^>]*>.*?</respStmt>",
        "availability": r"(?<=>)[^<]*(?:<(?!/availability).*?)?(?=</availability>)",
        "change": r"<change\b[^>]*>.*?</change>",
        "units": r"<p\b[^>]*id=\"intermediate-textual-units\"[^>]*>.*?</p>",
    }

    def __init__(self, xml: str):
        ET.fromstring(xml)
        self.xml = re.sub(r"(?s)<!--.*?-->", "", re.sub(r"^\s*<\?xml[^>]*\?>\s*", "", xml))
        self.slots: list[str] = []
        for name, pattern in self.PARTS.items():
            start = self.xml.find("<availability") if name == "availability" else 0
            found = re.compile("(?s)" + pattern).search(self.xml, self.xml.find(">", start) if start > 0 else 0)
            if found and start >= 0:
                self.xml = self.xml[: found.start()] + f"{{{{{{{name}}}}}}}" + self.xml[found.end() :]
                self.slots.append(name)
                if name == "units":
                    self.units = found[0]


def _named(name: str):
    return lambda e: e["key"] == name


def build(docs: DataFrame, template: str, licences: dict[str, str], mark: str, holder: str = "", units: str | None = None) -> DataFrame:
    """(doc_id, header) from (doc_id, meta): the template with each document's metadata. Built-in functions only.

    licences has the text of each licence by its name in the field `<mark> License`; a missing or unknown one fails the
    job. A change whose description names the mark is tagged as the mark's contributor's; the years of these changes
    are the publication's span. units replaces the paragraph on textual units for `Prose with verse`.
    """
    cut = Template(template)
    meta = lambda name: F.try_element_at(F.col("meta"), F.lit(name))
    text = lambda name: meta(name)["value"]
    listed = lambda *names: F.coalesce(*[F.when(meta(n)["kind"] == "text", F.filter(F.array(meta(n)["value"]), lambda x: x != "")).otherwise(meta(n)["items"]) for n in names], F.array().cast("array<string>"))
    each = lambda items, made: F.array_join(F.transform(items, lambda x: made(xml_escape(x))), "")
    entries = F.coalesce(meta("Digitization Notes")["pairs"], F.array().cast("array<struct<key:string,value:string>>"))
    tag = f"#{mark.lower()}-contributor"
    when = lambda e: F.regexp_extract(F.trim(e["key"]), r"^\((.*?)\)\s*(.*)", 1)
    who = lambda e: F.when(F.trim(e["key"]).rlike(r"^\(.*?\)"), F.trim(F.regexp_extract(F.trim(e["key"]), r"^\((.*?)\)\s*(.*)", 2))).otherwise(F.trim(e["key"]))
    attr = lambda name, v: F.when(v != "", F.concat(F.lit(f' {name}="'), xml_escape(v), F.lit('"'))).otherwise("")
    ours = lambda e: e["value"].contains(mark)
    change = lambda e: F.concat(F.lit("<change"), attr("when", F.trim(when(e))), attr("who", who(e)), F.when(ours(e), F.lit(f' ana="{tag}"')).otherwise(""), F.lit(">"), xml_escape(e["value"]), F.lit("</change>"))
    years = F.flatten(F.transform(F.filter(entries, ours), lambda e: F.transform(F.regexp_extract_all(when(e), F.lit(r"\b(\d{4})\b"), F.lit(1)), lambda y: y.cast("int"))))
    last = dated(text("Text Last Updated"), text("Metadata Last Updated"))
    year = F.coalesce(last["year"].cast("string"), F.year(F.current_date()).cast("string"))
    name = F.trim(F.coalesce(text(f"{mark} License"), F.lit("")))
    licence = F.lit(None).cast("string")
    for known, body in licences.items():
        licence = F.when(name == known, F.lit(body)).otherwise(licence)
    licence = F.coalesce(licence, F.raise_error(F.concat(F.lit("missing or unknown licence: "), name)).cast("string"))
    slots = {
        "author": each(listed("Authors", "Author"), lambda x: F.concat(F.lit("<author>"), x, F.lit("</author>"))),
        "respStmt": each(listed("Contributors"), lambda x: F.concat(F.lit("<respStmt><persName>"), x, F.lit("</persName><resp>Contribution to the digital edition.</resp></respStmt>"))),
        "availability": F.replace(F.replace(licence, F.lit("{{COPYRIGHT_YEAR}}"), year), F.lit("{{RIGHTS_HOLDER}}"), F.lit(holder)),
        "change": F.array_join(F.transform(entries, change), ""),
        "units": F.when(F.contains(F.coalesce(text("Text Type"), F.lit("")), F.lit("Prose with verse")), F.lit(units if units is not None else getattr(cut, "units", ""))).otherwise(F.lit(getattr(cut, "units", ""))),
    }
    out = F.lit(cut.xml)
    for slot in cut.slots:
        out = F.replace(out, F.lit("{{{" + slot + "}}}"), slots[slot])
    single = F.filter(F.map_entries("meta"), lambda e: e["value"]["kind"] == "text")
    key = lambda k: F.concat(F.lit("{{"), F.upper(F.replace(k, F.lit(" "), F.lit("_"))), F.lit("}}"))
    out = F.aggregate(single, out, lambda t, e: F.replace(t, key(e["key"]), xml_escape(F.coalesce(e["value"]["value"], F.lit("")))))
    edition = F.coalesce(meta("Edition")["pairs"], F.array().cast("array<struct<key:string,value:string>>"))
    out = F.aggregate(edition, out, lambda t, e: F.replace(t, key(F.concat(F.lit("EDITION "), e["key"])), xml_escape(e["value"])))
    for own, placeholder in (("Series", "SERIES_TITLE"), ("Series Part", "SERIES_PART"), ("Note", "IMPRINT_NOTE")):
        value = F.get(F.transform(F.filter(edition, _named(own)), lambda e: e["value"]), 0)
        out = F.when(value.isNotNull(), F.replace(out, F.lit("{{" + placeholder + "}}"), xml_escape(value))).otherwise(out)
    for placeholder, value in (("COPYRIGHT_YEAR", last["year"].cast("string")), ("PUB_DATE_ISO", last["iso"]), ("PUB_DATE_HUMAN", last["long"])):
        out = F.replace(out, F.lit("{{" + placeholder + "}}"), F.coalesce(value, F.lit("")))
    span = F.concat(F.lit(' from="'), F.array_min(years).cast("string"), F.lit('" to="'), F.array_max(years).cast("string"), F.lit('"'))
    out = F.when(F.size(years) > 0, F.regexp_replace(out, r"(?s)(<publicationStmt\b.*?<date\b[^>]*)>", F.concat(F.lit("$1"), span, F.lit(">")))).otherwise(out)
    made = docs.select("doc_id", F.regexp_replace(out, r"\{\{[A-Z_0-9]+\}\}", "").alias("xml"))
    return made.select("doc_id", F.regexp_extract("xml", r"(?s)<teiHeader\b.*</teiHeader>", 0).alias("header"))


def consolidated(records: DataFrame, version: str) -> DataFrame:
    """One JSON object of all records by document, with the version. Records are one row a document, small by nature."""
    made = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("doc_id").cast("string"), F.to_json("fields")))))
    return records.agg(F.to_json(F.struct(made.alias("records"), F.lit(version).alias("version"))).alias("json"))


def file_size(value: Column) -> Column:
    """A file's size as a number; what isn't one fails the job."""
    return value.cast("double")
