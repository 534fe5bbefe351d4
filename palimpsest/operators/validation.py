"""Rules over texts and node tables, each a relation of issues (doc_id, rule, severity, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rule, pattern of a bracket pair, brackets that may not stand inside, severity, and whether an empty one is an error
NESTING = [
    ("R1", r"(?s)\[(.*?)\]", r"[{}<>]", "error"),
    ("R2", r"(?s)\{(.*?)\}", r"[\[\]<>]", "error"),
    ("R3", r"(?s)<(.*?)>", r"[\[\]{}]", "error"),
]
ROUND = ("R4", r"(?s)\((.*?)\)", r"[()\[\]{}<>]", "warning")


def _issue(rule: str, severity: str):
    return lambda detail: F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), detail.alias("detail"))


def _matches(pattern: str):
    return lambda x: x.rlike(pattern)


def _inside(pattern: str, source: Column) -> Column:
    return F.regexp_extract_all(source, F.lit(pattern), F.lit(1))


def bracket_issues(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """R1-R4 forbidden nesting, R5-R6 no [..] or {..} at all, R7-R8 empty ones; one row an issue. One scan, no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = []
    for rule, pattern, bad, severity in [*NESTING, ROUND]:
        source = F.regexp_replace(text, r"\(\([^)]+\)\)", "") if rule == "R4" else text
        found.append(F.transform(F.filter(_inside(pattern, source), _matches(bad)), _issue(rule, severity)))
    squares, curlies = _inside(NESTING[0][1], text), _inside(NESTING[1][1], text)
    for rule, all_of in (("R5", squares), ("R6", curlies)):
        found.append(F.transform(F.when(F.size(all_of) == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>")), _issue(rule, "error")))
    for rule, all_of in (("R7", squares), ("R8", curlies)):
        found.append(F.transform(F.filter(all_of, _matches(r"(?U)^\s*$")), _issue(rule, "error")))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(F.concat(*found)).alias("i")).select("doc_id", "i.*")


def verdicts(issues: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, errors, warnings, valid) for every document."""
    n = issues.groupBy("doc_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    joined = docs.select(F.col(id_col).alias("doc_id")).join(n, "doc_id", "left").na.fill(0, ["errors", "warnings"])
    return joined.withColumn("valid", F.col("errors") == 0)


#: rule, tag, and the ancestor it may not have (a direct parent where so marked)
FORBIDDEN_ANCESTORS = [("p-in-p", "p", "p"), ("p-in-l", "p", "l"), ("l-in-l", "l", "l"), ("lg-in-l", "lg", "l"), ("div-in-l", "div", "l"), ("div-in-p", "div", "p")]
CLOSED_VALUES = {("l", "part"): ["F", "I"], ("pb", "type"): ["folio", "hyphen"], ("lb", "type"): ["hyphen", "space", "unclear"]}


def node_issues(nodes: DataFrame) -> DataFrame:
    """Structure rules over a node table: forbidden ancestors, verse groups without l, lg or gap, closed attribute values, subtype without type,
    when beside other dates, target beside cRef.

    A descendant is told by the nodes' intervals (seq, end_seq) within its document, in one join on the document.
    """
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(t).alias("tag"), F.lit(a).alias("above")) for r, t, a in FORBIDDEN_ANCESTORS])
    listed = nodes.select(F.explode(rules).alias("r"), "doc_id", "seq", "tag").where("tag = r.tag").select("doc_id", "seq", "r.rule", "r.above")
    above = nodes.where(F.col("tag").isin("p", "l")).select(F.col("doc_id").alias("_doc"), F.col("seq").alias("_seq"), "end_seq", F.col("tag").alias("_tag"))
    inside = listed.join(above, (F.col("doc_id") == F.col("_doc")) & (F.col("above") == F.col("_tag")) & (F.col("seq") > F.col("_seq")) & (F.col("seq") <= F.col("end_seq")), "left_semi").select("doc_id", "seq", "rule")
    filling = nodes.where(F.col("tag").isin("lg", "l", "gap")).select(F.col("doc_id").alias("_doc"), F.col("seq").alias("_seq"))
    filled = (F.col("doc_id") == F.col("_doc")) & (F.col("_seq") > F.col("seq")) & (F.col("_seq") <= F.col("end_seq"))
    empty = nodes.where("tag = 'lg'").join(filling, filled, "left_anti").select("doc_id", "seq", F.lit("lg-empty").alias("rule"))
    closed = reduce(lambda x, y: x | y, [(F.col("tag") == t) & F.col("attrs")[a].isNotNull() & ~F.col("attrs")[a].isin(v) for (t, a), v in CLOSED_VALUES.items()])
    values = nodes.where(closed).select("doc_id", "seq", F.lit("closed-value").alias("rule"))
    subtype = nodes.where(F.col("attrs")["subtype"].isNotNull() & F.col("attrs")["type"].isNull()).select("doc_id", "seq", F.lit("subtype-needs-type").alias("rule"))
    dated = nodes.where(F.col("attrs")["when"].isNotNull() & (F.col("attrs")["from"].isNotNull() | F.col("attrs")["to"].isNotNull() | F.col("attrs")["notBefore"].isNotNull() | F.col("attrs")["notAfter"].isNotNull()))
    dates = dated.select("doc_id", "seq", F.lit("when-alone").alias("rule"))
    both = F.col("tag").isin("ptr", "ref") & F.col("attrs")["target"].isNotNull() & F.col("attrs")["cRef"].isNotNull()
    targets = nodes.where(both).select("doc_id", "seq", F.lit("target-or-cref").alias("rule"))
    return reduce(DataFrame.unionByName, [inside, empty, values, subtype, dates, targets])


#: Which elements may stand directly in which; elements without a row here may hold anything.
ALLOWED_CHILDREN = {
    "body": ["div", "p", "lg", "sp", "head", "pb", "lb", "milestone", "stage", "l", "ab"],
    "div": ["div", "p", "lg", "sp", "head", "pb", "lb", "milestone", "stage", "l", "ab", "note"],
    "lg": ["lg", "l", "head", "back", "pb", "lb", "milestone", "gap", "stage", "note"],
    "l": ["choice", "del", "supplied", "unclear", "pb", "lb", "caesura", "milestone", "stage", "seg", "note", "gap"],
    "p": ["choice", "del", "supplied", "unclear", "pb", "lb", "milestone", "stage", "seg", "note", "gap", "list", "ref", "lg"],
    "sp": ["speaker", "p", "lg", "l", "stage", "pb", "lb", "milestone", "ab"],
    "choice": ["sic", "corr", "orig", "reg", "unclear"],
    "speaker": [],
}


def content_issues(nodes: DataFrame) -> DataFrame:
    """(doc_id, seq, child, parent) of nodes that may not stand directly in their parent: one join of nodes with their parents."""
    allowed = F.map_from_arrays(F.array(*map(F.lit, ALLOWED_CHILDREN)), F.array(*[F.array(*map(F.lit, v)).cast("array<string>") for v in ALLOWED_CHILDREN.values()]))
    parents = nodes.where(F.col("tag").isin(*ALLOWED_CHILDREN)).select(F.col("doc_id").alias("_doc"), F.col("seq").alias("_seq"), F.col("tag").alias("parent"))
    joined = nodes.join(parents, (F.col("doc_id") == F.col("_doc")) & (F.col("parent_seq") == F.col("_seq")))
    return joined.where(~F.array_contains(F.element_at(allowed, F.col("parent")), F.col("tag"))).select("doc_id", "seq", F.col("tag").alias("child"), "parent")


def link_lint(first: Column) -> Column:
    """What is wrong with the first of an edition's links, or null. "No ..." says that there is none."""
    return (
        F.when(first.isNull() | (first == "") | first.startswith("No "), F.lit(None).cast("string"))
        .when(~first.startswith("["), "not a link")
        .when(~first.contains("]("), "link without target")
    )
