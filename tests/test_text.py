import random
import re

from pyspark.sql import functions as F

from palimpsest.functions import text
from palimpsest.operators import diffing, metadata
from palimpsest.sources import reports, texts


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v"))).first()[0]


def test_scalars(spark):
    assert one(spark, "12,3", text.xml_id) == "p12_l3"
    assert one(spark, " 1.2 ab ", text.xml_id) == "v1_2_ab"
    assert one(spark, "aā🙂", text.code_points) == "0x61,0x101,0x1f642"
    assert one(spark, "((go)) (a (b) c)x«y»¿z¿", text.plain_content) == "go xyz"
    assert one(spark, "(" * 9 + "x" + ")" * 9 + "k", text.remove_removables) == "k"
    assert one(spark, "ab-\ncd", text.join_hyphens) == "abcd"
    assert one(spark, "a🙂b", lambda c: text.ngrams(c, 2)) == ["a🙂", "🙂b"]
    assert one(spark, "", lambda c: text.ngrams(c, 1)) == []
    assert one(spark, "http://x/Y.PDF", text.file_type) == ".pdf"
    assert one(spark, " error:  “a”  \\\\S+ ", text.report_message) == '"a" \\S+'


def test_metadata(spark):
    assert one(spark, "see [t](miscellaneous/a.pdf): d", metadata.parse_link).asDict() == {"text": "t", "url": "/static/data/miscellaneous/a.pdf", "description": "d", "filetype": ".pdf"}
    assert one(spark, "none", metadata.parse_link) is None
    pairs = spark.createDataFrame([(["3 → 9", "4,x", "5,11"],), (None,)], "v array<string>").select(metadata.page_offsets(F.col("v")).alias("o")).collect()
    assert [[tuple(p) for p in r.o] for r in pairs] == [[(3, 9), (5, 11)], [(1, 1)]]
    lines = [("d", i, x) for i, x in enumerate("intro\n# A\n\none\ntwo\n\n# B\n- x\n- y\n# A\nlast".split("\n"))]
    found = metadata.records(metadata.sections(spark.createDataFrame(lines, "doc_id string, line_no bigint, line string"))).first().fields
    assert found["A"].value == "last" and found["B"]["items"] == ["x", "y"] and found["PDF Page Offset"]["items"] == ["1 → 1"]


def test_reports(spark):
    xml = '<s:o xmlns:s="http://purl.oclc.org/dsdl/svrl"><s:failed-assert><s:text> bad </s:text></s:failed-assert><s:failed-assert><s:text/></s:failed-assert></s:o>'
    found = reports.schematron_failures(spark.createDataFrame([("a.svrl.xml", xml)], "file string, xml string"))
    assert [(r.svrl_file, r.status, r.message) for r in found.collect()] == [("a.svrl.xml", "SCH FAIL", "bad")]
    log = reports.grammar_log(spark.createDataFrame([("/x/a.xml:3:4: error: bad",), ("noise",)], "value string"))
    assert [(r.svrl_file, r.line, r.message) for r in log.collect()] == [("a.svrl.xml", "3", "error: bad")]
    block = "Engine name: Jing\nMain validation file: /q/a.xml\nDescription: bad: worse\nStart location: 3:9\n\nnothing"
    edit = reports.editor_log(spark.createDataFrame([(block,)], "value string"))
    assert [(r.svrl_file, r.status, r.line, r.message) for r in edit.collect()] == [("a.xml.svrl.xml", "RNG FAIL", "3", "bad: worse")]
    sides = {(r.message, r.left_count, r.right_count, r.side) for r in diffing.compare(log, edit).collect()}
    assert sides == {("bad", 1, 0, "left"), ("bad: worse", 0, 1, "right")}


def test_readers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("﻿one\r\ntwo", encoding="utf-8")
    assert [tuple(r) for r in texts.read_lines(spark, str(tmp_path)).orderBy("line_no").collect()] == [("a", 0, "one"), ("a", 1, "two")]
    table = texts.ngram_table(spark.createDataFrame([('{"1": {"a": 3}, "2": {"ab": 2}}',)], "text string"))
    assert {tuple(r) for r in table.collect()} == {(1, "a", 3), (2, "ab", 2)}
    assert {tuple(r) for r in texts.ngram_table(texts.ngram_json(table)).collect()} == {(1, "a", 3), (2, "ab", 2)}
    entries = texts.companions(spark.createDataFrame([("d", "x\ny\n\n \n\nz")], "doc_id string, text string"))
    assert [tuple(r) for r in entries.orderBy("idx").collect()] == [("d", 0, "x\ny"), ("d", 1, "z")]


def joined_by_loops(content):
    """The reference's rules, each repeated until it finds nothing."""
    rules = [(r"-\n(<\d+>)\n\t", r"\1"), (r"([^\n/\|\]\)>}-])\n\t", r"\1"), (r"-\n\t", ""), (r"-\n(<\d+>)\n([^\n])", r"\1\2"), (r"(\n[^\t\n-]+)\n([^\n\t])", r"\1 \2"), (r"-\n", ""), (r"([^\n ])(<\d+> )", r"\1 \2")]
    for pattern, replacement in rules:
        while re.search(pattern, content):
            content = re.sub(pattern, replacement, content)
    return content


def test_hyphens_to_the_fix_point(spark):
    rng = random.Random(5)
    parts = ["-\n", "\n\t", "<7>", "<12> ", "\n", "\t", "-", " ", "]", "a", "b c", "🙂", "x\ny\nz", "-\n<3>\n", "-\n<3>\n\t"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["\n".join(f"line {i}" for i in range(n)) for n in (1, 2, 3, 5, 8, 400)]
    texts += ["-\n" * k + "<1>" + "\n\t" * m + "x" for k in (1, 3, 70) for m in (1, 3, 70)] + ["-" * k + "\n" * m for k in (1, 90) for m in (2, 90)] + ["a" + "<1>" * 80 + " ", "-\n" * 50 + "-\n\t" + "\t" * 60 + "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").repartition(4)
    got = {r.i: r.t for r in df.select("i", text.join_hyphens(F.col("v")).alias("t")).collect()}
    wrong = [(t, got[i], joined_by_loops(t)) for i, t in enumerate(texts) if got[i] != joined_by_loops(t)]
    assert not wrong, (len(wrong), wrong[0])
    assert one(spark, None, text.join_hyphens) is None


def test_brackets_nested_deeper_than_64(spark):
    assert one(spark, "a" + "(" * 150 + "x" + ")" * 150 + "b", text.remove_removables) == "ab"
    assert one(spark, "a" + "{" * 150 + "x" + "}" * 150 + "b", text.plain_content) == "ab"


def test_ngrams_of_code_points(spark):
    value = "a\n🙂éb"
    df = spark.createDataFrame([(value,), ("",), ("x",)], "t string")
    for n in (1, 2, 3):
        got = [r[0] for r in df.select(text.ngrams(F.col("t"), n)).collect()]
        assert got == [[t[i : i + n] for i in range(len(t) - n + 1)] for t in (value, "", "x")]
