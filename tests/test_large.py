"""Steps whose work must follow the input: what is read, sent and worked out once."""

import pytest
from pyspark.sql import functions as F

from palimpsest import arrow, catalogue
from palimpsest.operators import lines as ordered
from palimpsest.operators import metadata
from palimpsest.plans import edition

SF = "/root/testdata/sf0.001"


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sections_work_out_their_text_once(spark):
    lines = [("# A", "\n".join(["", "- x"] * 3)), ("# B", "one\n\n- two"), ("# C", "\n")]
    text = "\n".join(f"{h}\n{b}" for h, b in lines)
    found = metadata.sections(ordered.lines(spark.createDataFrame([("d", text)], "doc_id string, text string")))
    assert planned(found).count("array_join(") == 2  # the text, and the value of its lines
    assert [(r.field, r.kind, r.value, r["items"]) for r in found.orderBy("ord").collect()] == [("A", "text", "- x  - x  - x", None), ("B", "text", "one  - two", None), ("C", "text", "", None)]


def test_many_documents_leave_in_one_batch():
    made = list(arrow.batched(((str(i), i, {"k": "v"}, ["x"]) for i in range(10_001)), "a string, b int, c map<string,string>, d array<string>"))
    assert [b.num_rows for b in made] == [10_000, 1] and made[1].to_pylist() == [{"a": "10000", "b": 10_000, "c": [("k", "v")], "d": ["x"]}]
    assert [b.num_rows for b in arrow.batched([("x" * arrow.BATCH_CHARS,)] * 3, "a string")] == [1, 1, 1]
    assert [r.a for r in arrow.taken(made)] == [str(i) for i in range(10_001)]


@pytest.mark.parametrize("form", ["xml", "reading", "markup", "glosses", "html", "facts", "plain"])
def test_one_form_alone(spark, form):
    rows = [(str(d), i, x) for d in range(3) for i, x in enumerate(["{a}", "[1,1]", "p ≤a≥«b» q", f"\tv ˹s{d}˼ ||"])]
    lines = spark.createDataFrame(rows, "doc_id string, line_no bigint, line string")
    alone, whole = edition.rendered(lines, forms=[form]), edition.rendered(lines)
    assert alone.columns == ["doc_id", form]
    assert sorted(map(str, alone.collect())) == sorted(map(str, whole.select("doc_id", form).collect()))
    again = edition.rendered_nodes(edition.build(lines), forms=[form])
    assert sorted(map(str, again.collect())) == sorted(map(str, edition.rendered_nodes(edition.build(lines)).select("doc_id", form).collect()))


@pytest.mark.parametrize("name", ["q_edition_xml", "q_edition_nodes"])
def test_editions_are_dealt_out_before_they_are_lines(spark, name):
    plan = executed(catalogue.QUERIES[name](spark, SF))
    assert "BroadcastHashJoin" not in plan and plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 3


def test_descendants_fold_once(spark):
    found = catalogue.QUERIES["q_node_descendants"](spark, SF)
    assert planned(found).count("MapIn") == 1 and "BroadcastHashJoin" not in executed(found)


def test_corrections_read_nodes_once(spark):
    node = lambda seq, end, parent, tag, text="", n=None: ("d", seq, parent, end, 0, tag, {"n": n} if n else {}, text, "")
    rows = [node(0, 15, None, "body"), node(1, 10, 0, "lg", n="1"), node(2, 4, 1, "lg", n="2"), node(3, 3, 2, "del", "a"), node(4, 4, 2, "supplied", "b"), node(5, 7, 1, "choice"), node(6, 6, 5, "sic", "c"), node(7, 7, 5, "corr", "e")]
    rows += [node(8, 8, 1, "choice"), node(9, 10, 1, "p"), node(10, 10, 9, "del", "f"), node(11, 11, 0, "del", "g"), node(12, 15, 0, "choice"), node(13, 13, 12, "sic", "h"), node(14, 14, 12, "corr", "i"), node(15, 15, 12, "corr", "j")]
    nodes = spark.createDataFrame(rows, edition.NODES).repartition(3)
    found = edition.corrections(nodes)
    assert planned(found).count("Repartition") == 1
    due = {(3, "a", "", "2"), (4, "", "b", "2"), (5, "c", "e", "1"), (8, None, None, "1"), (10, "f", "", "1"), (11, "g", "", None), (12, "h", "i", None), (12, "h", "j", None)}
    assert sorted(map(str, due)) == sorted(str((r.seq, r.sic, r.corr, r.n)) for r in found.collect())


def test_trees_of_rows_in_any_order(spark):
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(["{a}", "[1,1]", "x ≤a≥«b» y", "\tz ||"])], "doc_id string, line_no bigint, line string")
    nodes = edition.build(lines)
    made = edition.rendered_nodes(nodes.orderBy(F.desc("seq")), forms=["xml"])
    assert "array_sort" not in planned(made)  # rows are put in order where they are made a tree
    assert made.first().xml == edition.rendered(lines, forms=["xml"]).first().xml
