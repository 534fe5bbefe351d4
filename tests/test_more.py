import pytest
from pyspark.sql import functions as F

from palimpsest.functions import markdown
from palimpsest.functions.translit import hk_to_iast
from palimpsest.operators import header, metadata, validation
from palimpsest.plans import edition
from palimpsest.sources import xml
from palimpsest.streaming import ngrams as stream


def test_xml_round_trip(spark):
    text = '<TEI xmlns="urn:x"><teiHeader/><text><body><div n="1"><p n="1,1">a <pb n="2"/>b<lb/> c &amp; d</p></div></body></text></TEI>'
    nodes = xml.nodes(spark.createDataFrame([("d", text), ("bad", "<x"), ("none", None)], "doc_id string, xml string"))
    assert {r.doc_id: r.xml for r in edition.rendered_nodes(nodes).collect()} == {"d": '<body><div n="1"><p n="1,1">a <pb n="2"/>b<lb/> c &amp; d</p></div></body>'}


def test_node_rules(spark):
    text = "<body><p>x<p>y</p></p><l>z<l/></l><lg/><lg><l part='Q'/></lg><seg subtype='a'/><date when='1' from='2'/></body>"
    issues = validation.node_issues(xml.nodes(spark.createDataFrame([("d", text)], "doc_id string, xml string")))
    assert sorted(r.rule for r in issues.collect()) == ["closed-value", "l-in-l", "lg-empty", "p-in-p", "subtype-needs-type", "when-alone"]


def test_markdown():
    assert markdown.render("# A b\n\none *two*\nthree\n\n- x\n- [y](miscellaneous/z)") == '<h1>A b</h1>\n<p>one <em>two</em>\nthree</p>\n<ul><li>x</li><li><a href="/static/data/miscellaneous/z">y</a></li></ul>'
    assert markdown.render("a | b\n--|--\n1 | <2>") == "<table><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>1</td><td>&lt;2&gt;</td></tr></tbody></table>"
    assert markdown.render("```\n# no\n```") == "<pre><code># no</code></pre>" and markdown.render("") == ""


def test_header(spark):
    df = spark.createDataFrame([("2020-01-02", "2021-03-04", "(2020) Ann: built it"), ("x", None, "nothing")], "a string, b string, c string")
    rows = df.select(header.dated(F.col("a"), F.col("b")).alias("d"), header.change(F.col("c"), "built").alias("c")).collect()
    assert tuple(rows[0].d) == ("2021-03-04", 2021, "March 04, 2021") and tuple(rows[1].d) == (None, None, None)
    assert tuple(rows[0].c) == ("2020", "Ann", "built it", True) and rows[1].c is None
    parts = spark.createDataFrame([(["x", "y"],), (None,)], "v array<string>").select(header.repeated(F.col("v"), "<a>@</a>", "@").alias("r"))
    assert [r.r for r in parts.collect()] == ["<a>x</a><a>y</a>", ""]
    licences = spark.createDataFrame([("by", "text")], "licence string, body string")
    docs = spark.createDataFrame([("d", "by")], "doc_id string, licence string")
    assert header.licensed(docs, licences).first().body == "text"
    with pytest.raises(Exception, match="unknown licence"):
        header.licensed(docs.withColumn("licence", F.lit("odd")), licences).collect()
    one = lambda d, c, v: spark.createDataFrame([(d, v)], f"doc_id string, {c} string")
    assert {r.xml for r in header.assemble(one("a", "header", "<h/>"), one("a", "body", "<b/>")).collect()} == {"<TEI><h/><text><b/></text></TEI>"}


def test_romanization(spark):
    assert spark.range(1).select(hk_to_iast(F.lit("kRSNa lRR zAstra MH"))).first()[0] == "kṛṣṇa ḹ śāstra ṃḥ"


def test_consolidated(spark):
    lines = spark.createDataFrame([("d", i, x) for i, x in enumerate(["# A", "one"])], "doc_id string, line_no bigint, line string")
    made = header.consolidated(metadata.records(metadata.sections(lines)), "9").first().json
    assert '"version":"9"' in made and "one" in made


def test_stream(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "out")
    frame = lambda *t: spark.createDataFrame([(x,) for x in t], "text string")
    read = lambda: spark.readStream.schema("text string").parquet(source)
    frame("abab", "ab").write.parquet(source)
    stream.count_stream(read(), folder, str(tmp_path / "c")).awaitTermination()
    assert {tuple(r) for r in stream.current(spark, folder).collect()} == {("ab", 3), ("ba", 1)}
    frame("ba", None).write.mode("append").parquet(source)
    stream.count_stream(read(), folder, str(tmp_path / "c")).awaitTermination()
    assert {tuple(r) for r in stream.current(spark, folder).collect()} == {("ab", 3), ("ba", 2)}
    assert stream.current(spark, str(tmp_path / "none")).count() == 0


def test_verse_groups_without_lines_and_double_targets(spark):
    text = "<body><lg><head>x</head></lg><lg><lg><gap/></lg></lg><ref target='a' cRef='b'/><ptr target='a' cRef='b'/><ref target='a'/><ptr cRef='b'/></body>"
    issues = validation.node_issues(xml.nodes(spark.createDataFrame([("d", text)], "doc_id string, xml string")))
    assert sorted(r.rule for r in issues.collect()) == ["lg-empty", "target-or-cref", "target-or-cref"]


def test_residuals_of_a_null_group(spark):
    from palimpsest.operators import ngrams

    docs = spark.createDataFrame([("aaaaa", None), ("ab", "x")], "text string, lang string")
    found = ngrams.residuals(ngrams.counts(docs, 1, "text", "lang"), spark.createDataFrame([("a", 3), ("b", 1)], "gram string, cnt bigint"), "lang")
    assert {(r.lang, r.gram): r.observed for r in found.collect()} == {(None, "a"): 5, (None, "b"): 0, ("x", "a"): 1, ("x", "b"): 1}


def test_malformed_xml_is_an_issue(spark):
    texts = spark.createDataFrame([("good", "<a/>"), ("bad", "<a"), ("none", None)], "doc_id string, xml string")
    assert sorted((r.doc_id, r.rule) for r in xml.malformed(texts).collect()) == [("bad", "not-xml"), ("none", "not-xml")]


def test_library_runs(spark, tmp_path):
    """Markup to XML and HTML, and back."""
    from palimpsest import regenerate, sinks

    root = tmp_path / "lib"
    (root / "txt" / "chaya").mkdir(parents=True)
    (root / "metadata").mkdir()
    (root / "txt" / "one.txt").write_text("{A}\n[1,1]\n\nann — ˹foo˼ bar\n", encoding="utf-8")
    (root / "txt" / "chaya" / "one.txt").write_text("gloss\n", encoding="utf-8")
    (root / "txt" / "two.txt").write_text("{B}\n[2,1]\nplain words\n", encoding="utf-8")
    (root / "metadata" / "one.md").write_text("# Title\nOne\n# L License\nby\n", encoding="utf-8")
    config = spark.createDataFrame([("one", True, True)], "doc_id string, drama boolean, split_glosses boolean")
    spark.sparkContext.setCheckpointDir(str(tmp_path / "checkpoints"))
    template = "<TEI><teiHeader><title>{{TITLE}}</title><availability>x</availability></teiHeader></TEI>"
    regenerate.everything(spark, str(root), "xml", "7", config, template=template, licences={"by": "<p/>"}, mark="L")
    made = {r.doc_id: r.text for r in sinks.read_documents(spark, f"{root}/xml").collect()}
    assert "<title>One</title>" in made["one"] and "gloss</seg>" in made["one"] and "plain words" in made["two"]
    assert {r.doc_id for r in sinks.read_documents(spark, f"{root}/html").collect()} == {"one", "two"}
    regenerate.everything(spark, str(root), "txt", "7", config)
    back = {r.doc_id: r.text for r in sinks.read_documents(spark, f"{root}/txt-made").collect()}
    assert "˹foo˼ bar" in back["one"] and "plain words" in back["two"]
    assert {r.doc_id: r.text for r in sinks.read_documents(spark, f"{root}/txt-made-companions").collect()} == {"one": "gloss"}


def test_versions_and_comparison(spark, tmp_path):
    from palimpsest import sinks

    assert sinks.versioned('__v__ = "1"', "__v__", "2") == '__v__ = "2"' and sinks.versioned('__v__ = "1"', "__v__", "1") is None
    rows = spark.createDataFrame([("f", "s", "m", 1, 0, "left"), ("g", "s", "m", 1, 1, "both")], "svrl_file string, status string, message string, left_count int, right_count int, side string")
    sinks.write_comparison(rows, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c" / "both"), header=True).first().svrl_file == "g"
