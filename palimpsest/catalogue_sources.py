"""Queries that go through files and the texts of reports, of size of `nation` or `benchmark`, so that each reader and writer runs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import sinks
from .catalogue import GRAMS, HEADED, documents
from .functions import grammar, markdown
from .functions import text as texts_of
from .operators import header, metadata, ngrams
from .operators import lines as ordered
from .registry import query
from .session import scratch, table
from .sources import reports, texts, xml

BODY = "'one ' || n_name || chr(10) || chr(10) || chr(9) || 'two' || chr(10) || n_regionkey"


def nations(spark, sf_dir, **columns):
    rows = table(spark, sf_dir, "nation")
    return rows.select(F.col("n_nationkey").cast("string").alias("doc_id"), *[F.expr(e).alias(n) for n, e in columns.items()])


@query(f"SELECT cast(n_nationkey AS varchar) AS doc_id, unnest(range(4)) AS line_no, unnest(string_split({BODY}, chr(10))) AS line FROM nation")
def q_text_files(spark, sf_dir):
    """Documents written as files and read back as ordered lines."""
    folder = scratch(spark, "texts")
    sinks.write_documents(nations(spark, sf_dir, text=BODY), folder, "text")
    return ordered.lines(sinks.read_documents(spark, folder))


@query("SELECT cast(n_nationkey AS varchar) AS doc_id, unnest([0, 1, 2]) AS idx, unnest(['a ' || n_name, 'b' || chr(10) || 'c', 'd']) AS entry FROM nation")
def q_companion_list(spark, sf_dir):
    entries = "'  a ' || n_name || chr(10) || chr(10) || 'b' || chr(10) || 'c' || chr(10) || chr(10) || '  ' || chr(10) || chr(10) || chr(9) || 'd' || chr(10)"
    return texts.companions(nations(spark, sf_dir, text=entries))


XML = "CASE WHEN n_nationkey % 5 = 0 THEN '<TEI><body>' || n_name ELSE '<TEI xmlns=\"urn:x\"><!-- no --><text><body n=\"' || n_regionkey || '\"> <p>a <pb n=\"1\"/>b' || n_name || '</p> </body></text></TEI>' END"


@query("SELECT cast(n_nationkey AS varchar) AS doc_id, seq, parent_seq, tag, CASE tag WHEN 'body' THEN cast(n_regionkey AS varchar) WHEN 'pb' THEN '1' END AS n, text, CASE tag WHEN 'pb' THEN 'b' || n_name ELSE '' END AS tail FROM nation CROSS JOIN (VALUES (0, NULL, 'body', ''), (1, 0, 'p', 'a '), (2, 1, 'pb', '')) v(seq, parent_seq, tag, text) WHERE n_nationkey % 5 <> 0")
def q_xml_nodes(spark, sf_dir):
    return xml.nodes(nations(spark, sf_dir, xml=XML)).select("doc_id", "seq", "parent_seq", "tag", F.try_element_at("attrs", F.lit("n")).alias("n"), "text", "tail")


@query("SELECT cast(n_nationkey AS varchar) AS doc_id, 'not-xml' AS rule, 'error' AS severity FROM nation WHERE n_nationkey % 5 = 0")
def q_malformed_xml(spark, sf_dir):
    return xml.malformed(nations(spark, sf_dir, xml=XML)).select("doc_id", "rule", "severity")


@query(f"SELECT 1 AS n, gram, count(*) AS cnt FROM ({GRAMS(1, source='benchmark')}) GROUP BY gram UNION ALL SELECT 2, gram, count(*) FROM ({GRAMS(2, source='benchmark')}) GROUP BY gram")
def q_ngram_file(spark, sf_dir):
    """A table of n-grams as a JSON file and back; a file that isn't there has none."""
    bench = table(spark, sf_dir, "benchmark")
    both = [ngrams.counts(bench, n).select(F.lit(n).alias("n"), "gram", "cnt") for n in (1, 2)]
    path = scratch(spark, "ngrams")
    texts.ngram_json(both[0].unionByName(both[1])).write.text(path)
    return texts.read_ngrams(spark, path).unionByName(texts.read_ngrams(spark, path + "-none"))


@query(f"SELECT gram, cnt FROM (SELECT gram, count(*) AS cnt FROM ({GRAMS(1)}) GROUP BY gram) ORDER BY cnt DESC, gram")
def q_ngrams_by_count(spark, sf_dir):
    return ngrams.counts(documents(spark, sf_dir), 1).orderBy(F.desc("cnt"), "gram")


@query(f"SELECT gram || chr(9) || points || chr(9) || cnt AS value FROM (SELECT gram, array_to_string(list_transform(string_split(gram, ''), lambda c: '0x' || lower(to_hex(unicode(c)))), ',') AS points, count(*) AS cnt FROM ({GRAMS(2)}) GROUP BY gram) d WHERE NOT EXISTS (SELECT 1 FROM ({GRAMS(2, source='benchmark')}) b WHERE b.gram = d.gram)")
def q_unfamiliar_report(spark, sf_dir):
    """Unfamiliar n-grams with their code points, as the lines of a report."""
    return sinks.tab_separated(ngrams.unfamiliar(ngrams.counts(documents(spark, sf_dir), 2), ngrams.counts(table(spark, sf_dir, "benchmark"), 2)))


@query("SELECT n_nationkey, array_to_string(list_transform(string_split(n_name || 'é', ''), lambda c: '0x' || lower(to_hex(unicode(c)))), ',') AS points FROM nation")
def q_code_points(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", texts_of.code_points(F.concat("n_name", F.lit("é"))).alias("points"))


# ---- reports

ASSERT = "'<svrl:schematron-output xmlns:svrl=\"urn:s\"><svrl:failed-assert><svrl:text> first ' || n_name || ' </svrl:text></svrl:failed-assert><svrl:failed-assert><svrl:text>second</svrl:text></svrl:failed-assert><svrl:failed-assert><svrl:text> </svrl:text></svrl:failed-assert></svrl:schematron-output>'"


@query("SELECT n_nationkey || '.svrl.xml' AS svrl_file, 'SCH FAIL' AS status, unnest(['first ' || n_name, 'second']) AS message FROM nation")
def q_schematron_report(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select(F.expr("n_nationkey || '.svrl.xml'").alias("file"), F.expr(ASSERT).alias("xml"))
    return reports.schematron_failures(rows).select("svrl_file", "status", "message")


@query("SELECT n_name || '.svrl.xml' AS svrl_file, 'RNG FAIL' AS status, cast(n_nationkey AS varchar) AS line, 'error: bad ' || n_regionkey AS message FROM nation WHERE n_nationkey % 3 > 0")
def q_grammar_log(spark, sf_dir):
    line = "CASE WHEN n_nationkey % 3 = 0 THEN 'note: nothing' ELSE '/a/b/' || n_name || '.xml:' || n_nationkey || ':7: error: bad ' || n_regionkey END"
    return reports.grammar_log(table(spark, sf_dir, "nation").select(F.expr(line).alias("value"))).select("svrl_file", "status", "line", "message")


LOG = "'Engine name: Jing' || chr(10) || 'Main validation file: /x/' || n_name || '.xml' || chr(10) || 'Start location: ' || n_nationkey || ':3' || chr(10) || 'Description: one: two' || chr(10) || chr(10) || 'Severity: warning' || chr(10) || 'System ID: /y/' || n_name || '.xml' || chr(10) || 'Description: three'"


@query("SELECT n_name || '.xml.svrl.xml' AS svrl_file, unnest(['RNG FAIL', 'WARNING']) AS status, unnest([cast(n_nationkey AS varchar), '']) AS line, unnest(['one: two', 'three']) AS message FROM nation")
def q_editor_log(spark, sf_dir):
    return reports.editor_log(table(spark, sf_dir, "nation").select(F.expr(LOG).alias("value"))).select("svrl_file", "status", "line", "message")


@query("SELECT n_name || '.svrl.xml' AS svrl_file, 'SCH FAIL' AS status, 'said \"x, y\" ' || n_nationkey AS message FROM nation")
def q_report_file(spark, sf_dir):
    """A report written as CSV and read back."""
    made = {"svrl_file": "n_name || '.svrl.xml'", "status": "'SCH FAIL'", "line": "''", "test": "''", "role": "''", "message": "'said \"x, y\" ' || n_nationkey"}
    path = scratch(spark, "report")
    reports.write_report(table(spark, sf_dir, "nation").select(*[F.expr(e).alias(n) for n, e in made.items()]), path)
    return reports.read_report(spark, path).select("svrl_file", "status", "message")


@query("SELECT n_regionkey || '.1' AS data_version, n_name AS bundle_version FROM nation")
def q_versions(spark, sf_dir):
    line = "'__data_version__ = \"' || n_regionkey || '.1\"' || chr(10) || '__bundle_version__=\"' || n_name || '\"'"
    return texts.versions(nations(spark, sf_dir, text=line))


# ---- metadata

TYPED = "'# Title' || chr(10) || n_name || chr(10) || 'more' || chr(10) || '# Authors ' || chr(10) || '- Ann' || chr(10) || chr(10) || '- Bob' || chr(10) || '# Notes' || chr(10) || '- (2019) Cy: ours' || chr(10) || '- Dee: b: c' || chr(10) || '- (2019) Cy: later' || chr(10) || '# Empty'"


@query("SELECT cast(n_nationkey AS varchar) AS doc_id, ord, field, kind, CASE field WHEN 'Title' THEN n_name || chr(10) || 'more' WHEN 'Empty' THEN '' END AS value, items, pairs FROM nation CROSS JOIN (VALUES (1, 'Title', 'text', NULL, NULL), (2, 'Authors', 'list', 'Ann|Bob', NULL), (3, 'Notes', 'pairs', NULL, '(2019) Cy=later|Dee=b: c'), (4, 'Empty', 'text', NULL, NULL)) v(ord, field, kind, items, pairs)")
def q_header_fields(spark, sf_dir):
    found = header.fields(ordered.lines(nations(spark, sf_dir, text=TYPED)))
    pairs = F.array_join(F.transform("pairs", lambda p: F.concat(p["key"], F.lit("="), p["value"])), "|")
    return found.select("doc_id", F.col("ord").cast("int").alias("ord"), "field", "kind", "value", F.array_join("items", "|").alias("items"), pairs.alias("pairs"))


TEMPLATE = """<?xml version="1.0"?>
<TEI><teiHeader><titleStmt><title>{{TITLE}}</title><!-- repeat --><author>{{AUTHOR_1}}</author><respStmt><persName>{{RESP}}</persName></respStmt></titleStmt><publicationStmt><availability status="x">
{{LICENSE}}</availability><date when="{{PUB_DATE_ISO}}">{{PUB_DATE_HUMAN}}</date></publicationStmt><bibl>{{EDITION_TITLE}}, {{SERIES_TITLE}}</bibl><p id="intermediate-textual-units">{{UNITS}}.</p><revisionDesc><change when="{{CHANGE_DATE_1}}">{{CHANGE_DESC_1}}</change></revisionDesc></teiHeader></TEI>"""
META = "'# Title' || chr(10) || n_name || ' & co' || chr(10) || '# Author' || chr(10) || 'Ann' || chr(10) || '# Contributors' || chr(10) || '- Bob' || chr(10) || '- Cy' || chr(10) || '# LIB License' || chr(10) || 'by' || chr(10) || '# Text Last Updated' || chr(10) || '2020-03-01' || chr(10) || '# Metadata Last Updated' || chr(10) || '2021-04-05' || chr(10) || '# Edition' || chr(10) || '- Title: Old' || chr(10) || '- Series: S' || n_regionkey || chr(10) || '# Digitization Notes' || chr(10) || '- (2016 to 2018) Bob: typed for LIB' || chr(10) || '- Dee: scanned' || chr(10) || '# Text Type' || chr(10) || 'Prose with verse'"


@query("""SELECT cast(n_nationkey AS varchar) AS doc_id, '<teiHeader><titleStmt><title>' || n_name || ' &amp; co</title><author>Ann</author><respStmt><persName>Bob</persName><resp>Contribution to the digital edition.</resp></respStmt><respStmt><persName>Cy</persName><resp>Contribution to the digital edition.</resp></respStmt></titleStmt><publicationStmt><availability status="x"><p>2021 Us</p></availability><date when="2021-04-05" from="2016" to="2018">April 05, 2021</date></publicationStmt><bibl>Old, S' || n_regionkey || '</bibl><p>both</p><revisionDesc><change when="2016 to 2018" who="Bob" ana="#lib-contributor">typed for LIB</change><change who="Dee">scanned</change></revisionDesc></teiHeader>' AS header FROM nation""")
def q_header_build(spark, sf_dir):
    found = header.metadata(header.fields(ordered.lines(nations(spark, sf_dir, text=META))))
    return header.build(found, TEMPLATE, {"by": "<p>{{COPYRIGHT_YEAR}} {{RIGHTS_HOLDER}}</p>", "zero": "<p/>"}, "LIB", "Us", "<p>both</p>")


@query("""SELECT coalesce(h.id, b.id, o.id) AS doc_id, coalesce(h.header, o.header) AS header, coalesce(b.body, o.body) AS body
 FROM (SELECT cast(n_nationkey AS varchar) AS id, 'H' || n_name AS header FROM nation WHERE n_nationkey % 2 = 0) h
 FULL JOIN (SELECT cast(n_nationkey AS varchar) AS id, 'B' || n_name AS body FROM nation WHERE n_nationkey % 3 = 0) b ON h.id = b.id
 FULL JOIN (SELECT cast(n_nationkey AS varchar) AS id, 'old h' AS header, 'old b' AS body FROM nation WHERE n_nationkey % 5 < 3) o ON coalesce(h.id, b.id) = o.id""")
def q_replaced_halves(spark, sf_dir):
    """Documents with one half made anew keep the other."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_nationkey").cast("string").alias("doc_id"), "n_name")
    headers = rows.where("n_nationkey % 2 = 0").select("doc_id", F.concat(F.lit("H"), "n_name").alias("header"))
    bodies = rows.where("n_nationkey % 3 = 0").select("doc_id", F.concat(F.lit("B"), "n_name").alias("body"))
    old = rows.where("n_nationkey % 5 < 3").select("doc_id", F.lit("old h").alias("header"), F.lit("old b").alias("body"))
    return header.replaced(old, headers, bodies)


TWICE = "'# A' || chr(10) || 'first' || chr(10) || '# A' || chr(10) || n_name || CASE WHEN n_nationkey % 2 = 0 THEN chr(10) || '# PDF Page Offset' || chr(10) || '- 3 → ' || n_nationkey || chr(10) || '- x, y' ELSE '' END"


@query("SELECT cast(n_nationkey AS varchar) AS doc_id, unnest(['A', 'PDF Page Offset']) AS field, unnest([n_name, NULL]) AS value, unnest([NULL, CASE WHEN n_nationkey % 2 = 0 THEN '3 → ' || n_nationkey || '|x, y' ELSE '1 → 1' END]) AS items FROM nation")
def q_metadata_records(spark, sf_dir):
    """The last of equal fields counts, and a page offset is always there."""
    made = metadata.records(metadata.sections(ordered.lines(nations(spark, sf_dir, text=TWICE))))
    return made.select("doc_id", F.explode("fields").alias("field", "v")).select("doc_id", "field", "v.value", F.array_join("v.items", "|").alias("items"))


@query("SELECT cast(n_nationkey AS varchar) AS doc_id, CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 1 END AS book, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE 1 END AS pdf FROM nation")
def q_page_mapping(spark, sf_dir):
    made = metadata.records(metadata.sections(ordered.lines(nations(spark, sf_dir, text=TWICE))))
    return made.select("doc_id", F.explode(metadata.page_offsets(F.col("fields")["PDF Page Offset"]["items"])).alias("o")).select("doc_id", "o.book", "o.pdf")


@query("SELECT doc_id, unnest([2]) AS ord, 'Languages' AS field FROM documents")
def q_allowed_fields(spark, sf_dir):
    """Sections of the named fields alone."""
    found = metadata.sections(ordered.lines(documents(spark, sf_dir, HEADED)))
    return markdown.sections_html(found, ["Languages", "None such"]).select("doc_id", F.col("ord").cast("int").alias("ord"), "field")


@query("SELECT n_nationkey, '<h1>A ' || n_name || '</h1>' || chr(10) || '<p>one <em>two</em></p>' || chr(10) || '<ul><li><a href=\"/static/data/miscellaneous/z\">y</a></li><li><code>c</code></li></ul>' AS html FROM nation")
def q_markdown(spark, sf_dir):
    marked = "'# A ' || n_name || chr(10) || chr(10) || 'one *two*' || chr(10) || chr(10) || '- [y](miscellaneous/z)' || chr(10) || '- `c`'"
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(marked).alias("text"))

    def run(batches):
        for b in batches:
            yield b[["n_nationkey"]].assign(html=[markdown.render(t) for t in b["text"]])

    return rows.mapInPandas(run, "n_nationkey int, html string")


SHOWN = "'# Title' || chr(10) || n_name || chr(10) || '# Empty' || chr(10) || chr(10) || '# Edition PDFs' || chr(10) || '- ' || CASE WHEN n_nationkey % 2 = 0 THEN 'No scan, but [it](http://x/' || n_nationkey || ')' ELSE '[it](http://x/' || n_nationkey || ')' END || chr(10) || '# PDF Page Offset' || chr(10) || '- 3 → ' || n_nationkey || chr(10) || '- x, y'"


@query("""SELECT cast(n_nationkey AS varchar) AS doc_id,
 '[{"type": "field", "label": "Title", "inline_text": "' || n_name || '", "content_html": ""}, {"type": "field", "label": "Edition PDFs", "inline_text": null, "content_html": "<ul><li>' || CASE WHEN n_nationkey % 2 = 0 THEN 'No scan, but ' ELSE '' END || '<a href=\\"http://x/' || n_nationkey || '\\">it</a></li></ul>"}]' AS entries,
 CASE WHEN n_nationkey % 2 = 1 THEN '{"url": "http://x/' || n_nationkey || '", "offsets": [[3, ' || n_nationkey || ']]}' END AS mapping FROM nation""")
def q_metadata_entries(spark, sf_dir):
    return markdown.entries(metadata.sections(ordered.lines(nations(spark, sf_dir, text=SHOWN))))


PRETTY = "'<body><p>a' || chr(10) || '   b</p><l>' || n_name || '</l><pb/>c</body>'"


@query("""SELECT cast(n_nationkey AS varchar) AS doc_id, '<?xml version=''1.0'' encoding=''UTF-8''?>' || chr(10) || '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><p>' || chr(10) || 'a' || chr(10) || '  b</p>' || chr(10) || '<l>' || chr(10) || n_name || '</l>' || chr(10) || '<pb/>' || chr(10) || 'c</body></text></TEI>' || chr(10) AS xml FROM nation""")
def q_written_xml(spark, sf_dir):
    """A whole document with line ends behind the tags of lines, paragraphs and breaks."""
    rows = nations(spark, sf_dir, body=PRETTY)
    return rows.select("doc_id", sinks.tei(F.lit(None).cast("string"), F.col("body"), True).alias("xml"))


@query("SELECT n_nationkey, CAST(n_nationkey || '.5' AS DOUBLE) AS kilobytes FROM nation")
def q_file_sizes(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", header.file_size(F.expr("n_nationkey || '.5'")).alias("kilobytes"))


@query("SELECT 'stem=' || cast(n_nationkey AS varchar) AS folder, row_number() OVER (ORDER BY cast(n_nationkey AS varchar)) AS place FROM nation WHERE n_nationkey % 2 = 0")
def q_stale_folders(spark, sf_dir):
    """Documents' folders in the order of their names, after those without a source are gone."""
    folder = scratch(spark, "stale")
    rows = nations(spark, sf_dir, text="n_name", n="n_nationkey")
    sinks.write_documents(rows, folder, "text")
    sinks.delete_stale(spark, folder, rows.where("n % 2 = 0"))
    left = sinks.read_documents(spark, folder)
    place = F.row_number().over(Window.orderBy("doc_id"))
    return left.select(F.concat(F.lit("stem="), "doc_id").alias("folder"), place.cast("long").alias("place"))


@query("SELECT cast(c.c_custkey AS varchar) AS doc_id, n_name AS title, c_mktsegment AS text FROM customer c LEFT JOIN nation ON n_nationkey = c_nationkey")
def q_text_with_metadata(spark, sf_dir):
    """Texts with their metadata, by one join."""
    rows = table(spark, sf_dir, "customer")
    meta = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("title"))
    return rows.join(meta, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("c_custkey").cast("string").alias("doc_id"), "title", F.col("c_mktsegment").alias("text"))


@query("SELECT DISTINCT role, count(*) OVER (PARTITION BY role) AS turns FROM conversations ORDER BY role")
def q_sorted_keys(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.count(F.lit(1)).alias("turns")).orderBy("role")


@query("SELECT cast(n_nationkey AS varchar) AS doc_id, '9' AS version, n_name AS title FROM nation")
def q_consolidated(spark, sf_dir):
    """All records as one JSON object, read again."""
    found = metadata.records(metadata.sections(ordered.lines(nations(spark, sf_dir, text="'# Title' || chr(10) || n_name"))))
    parsed = F.from_json("json", "struct<records: map<string,string>, version: string>")
    each = header.consolidated(found, "9").select(parsed.alias("j")).select("j.version", F.explode("j.records").alias("doc_id", "record"))
    return each.select("doc_id", "version", F.get_json_object("record", "$.Title.value").alias("title"))


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN n_nationkey || '.1' WHEN 1 THEN cast(n_nationkey AS varchar) ELSE '' END AS base, CASE n_nationkey % 3 WHEN 0 THEN 'ab' ELSE '' END AS part FROM nation")
def q_verse_labels(spark, sf_dir):
    """Verse numbers and the parts of a verse."""
    label = F.expr("CASE n_nationkey % 3 WHEN 0 THEN ' ' || n_nationkey || '.1 ab' WHEN 1 THEN n_nationkey || '' ELSE 'x' || n_nationkey END")
    part = lambda k: F.regexp_extract(label, grammar.VERSE_NUMBER, k)
    return table(spark, sf_dir, "nation").select("n_nationkey", part(1).alias("base"), part(2).alias("part"))


@query("SELECT n_nationkey, n_nationkey % 5 <> 2 AS closes, n_nationkey % 5 IN (1, 3, 4) AS ends FROM nation")
def q_verse_ends(spark, sf_dir):
    """Lines that close a verse line, and those that end a verse."""
    line = F.expr("CASE n_nationkey % 5 WHEN 0 THEN 'a |' WHEN 1 THEN 'a || 1 ||' WHEN 2 THEN 'a b' WHEN 3 THEN 'a || thus' ELSE 'a॥' END")
    return table(spark, sf_dir, "nation").select("n_nationkey", line.rlike(grammar.CLOSE_LINE).alias("closes"), line.rlike(grammar.VERSE_END).alias("ends"))
