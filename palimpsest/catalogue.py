"""Queries over the driver's tables, by name, with the SQL that says the same.

The tables hold prose, so markup operators read it projected into markup, by one expression in both languages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .functions import grammar, text
from .operators import diffing, metadata, ngrams, validation
from .operators import lines as ordered
from .registry import ORACLES, QUERIES, query  # noqa: F401
from .session import table

# ---- inputs, the same in Spark and DuckDB

LINES = "SELECT doc_id, source, unnest(range(len(p))) AS line_no, unnest(p) AS line FROM (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS p FROM documents)"
MARK = """CASE line_no % 9
  WHEN 0 THEN '{' || source || '}'
  WHEN 1 THEN '<' || (doc_id % 50 + line_no) || '>'
  WHEN 2 THEN '[]'
  WHEN 3 THEN chr(9) || line || ' |'
  WHEN 4 THEN line || '-'
  WHEN 5 THEN ''
  WHEN 6 THEN 'ann — ' || line
  WHEN 7 THEN '[' || line_no || ',' || doc_id || ']'
  ELSE line END"""
MARKED = f"SELECT doc_id, line_no, {MARK} AS line FROM ({LINES})"
EDITED = "replace(replace(replace(text, ' the ', ' ≤teh≥«the» '), ' of ', ' «of» '), ' la ', ' ¿la¿ ')"
BRACKETED = "CASE doc_id % 6 WHEN 0 THEN '[' || source || '] {' || lang || '} ' || text WHEN 1 THEN '[a{' || lang || '}b] {x<' || source || '} ' || text WHEN 2 THEN '[] { } <a[b]> ' || text WHEN 3 THEN '(a (b) c) [x] {y} ' || text WHEN 4 THEN '((a)) (b<c>) ' || text ELSE text END"
HEADED = "'# Title' || chr(10) || chr(10) || source || chr(10) || '# Languages' || chr(10) || '- ' || lang || chr(10) || '- ' || lang || '2' || chr(10) || '# Body' || chr(10) || text"


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("long"))


def marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", F.expr(MARK).alias("line"))


def documents(spark: SparkSession, sf_dir: str, as_text: str | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("text", F.expr(as_text)) if as_text else docs


# ---- lines and scalar functions


@query(f"SELECT doc_id, line_no, line FROM ({LINES})")
def q_lines(spark, sf_dir):
    return ordered.lines(documents(spark, sf_dir))


def REPEATED(source: str, rules: list[tuple[str, str, bool]], out: str) -> str:
    """SQL: each rule (pattern, replacement, whether again and again) in turn over (doc_id, t) of source, until it changes nothing."""
    made = " ".join(f"WHEN {k} THEN regexp_replace(t, '{p}', '{r}', 'g')" for k, (p, r, _) in enumerate(rules))
    once = ", ".join(str(k) for k, (_, _, again) in enumerate(rules) if not again) or "-1"
    return f"""WITH RECURSIVE steps(doc_id, rule, t) AS (SELECT doc_id, 0, t FROM ({source})
 UNION ALL SELECT doc_id, CASE WHEN made = t OR rule IN ({once}) THEN rule + 1 ELSE rule END, made FROM (SELECT doc_id, rule, t, CASE rule {made} END AS made FROM steps WHERE rule < {len(rules)}))
 SELECT doc_id, {out} FROM steps WHERE rule = {len(rules)}"""


HYPHENED = "SELECT doc_id, replace(replace(text, 'ing ', '-' || chr(10)), 'tion ', '-' || chr(10) || '<7>' || chr(10)) AS t FROM documents"
JOINING = [(r"-\n(<\d+>)\n\t", r"\1", True), (r"([^\n/|\])>}-])\n\t", r"\1", True), (r"-\n\t", "", True), (r"-\n(<\d+>)\n([^\n])", r"\1\2", True), (r"(\n[^\t\n-]+)\n([^\n\t])", r"\1 \2", True), (r"-\n", "", True), (r"([^\n ])(<\d+> )", r"\1 \2", True)]


@query(REPEATED(HYPHENED, JOINING, "t AS joined"))
def q_hyphen_join(spark, sf_dir):
    docs = documents(spark, sf_dir, "replace(replace(text, 'ing ', '-' || chr(10)), 'tion ', '-' || chr(10) || '<7>' || chr(10))")
    return docs.select("doc_id", text.join_hyphens(F.col("text")).alias("joined"))


CLEAN = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({}, '\t{{2,}}', chr(9), 'g'), ' *(\n+) *', '\1', 'g'), '\n{{2,}}', chr(10) || chr(10), 'g'), ' {{2,}}', ' ', 'g'), '\A\s*', ''), '\s*\z', '')"


@query(f"SELECT doc_id, {CLEAN.format('t')} AS cleaned FROM (SELECT doc_id, chr(10) || replace(replace(text, '. ', '.   '), ', ', ',' || chr(9) || chr(9)) || ' ' AS t FROM documents)")
def q_whitespace_cleanup(spark, sf_dir):
    docs = documents(spark, sf_dir, "chr(10) || replace(replace(text, '. ', '.   '), ', ', ',' || chr(9) || chr(9)) || ' '")
    return docs.select("doc_id", text.clean_whitespace(F.col("text")).alias("cleaned"))


INSIDE = r"[^()<>≤≥\[\]{}]*"
REMOVING = [("˹([^˼]*)˼\\(([^)]*)\\)", "\\1 \\2", False), ("˹([^˼]*)˼", "\\1", False), (r"\(\(([^)]*)\)\)", "\\1", False)]
REMOVING += [(rf"\({INSIDE}\)", "", True), (rf"<{INSIDE}>", "", True), (rf"≤{INSIDE}≥", "", True), (rf"\[{INSIDE}\]", "", True), (rf"\{{{INSIDE}\}}", "", True), ("«([^»]+)»", "\\1", True), ("¿([^¿]+)¿", "\\1", True)]
NOTED = "'(a (b) c) [x ≤y≥] ((stage)) ˹pra˼(cha) {s} (((((((n) o) p) q) r) s) t) ' || " + EDITED


@query(REPEATED(f"SELECT doc_id, {NOTED} AS t FROM documents", REMOVING, CLEAN.format("t") + " AS content"))
def q_plain_content(spark, sf_dir):
    docs = documents(spark, sf_dir, NOTED)
    return docs.select("doc_id", text.plain_content(F.col("text")).alias("content"))


@query(r"""SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN 'v' || regexp_replace(role || ' ' || turn, '[^\p{L}\p{N}_]+', '_', 'g') ELSE 'p' || conv_id || '_1_l' || turn END AS xml_id,
  CASE WHEN turn % 3 = 2 THEN 'p.' || role || ' ' || turn ELSE 'p.' || conv_id || '.1, l.' || turn END AS shown FROM conversations""")
def q_coordinates(spark, sf_dir):
    label = F.expr("CASE WHEN turn % 3 = 2 THEN role || ' ' || turn ELSE conv_id || '.1,' || turn END")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.xml_id(label).alias("xml_id"), text.coordinate(label).alias("shown"))


# ---- n-grams

def GRAMS(n: int, columns: str = "", source: str = "documents") -> str:
    return f"SELECT {columns} unnest(list_transform(range(1, length(text) - {n} + 2), lambda i: substring(text, i, {n}))) AS gram FROM {source}"


@query(f"SELECT gram, count(*) AS cnt FROM ({GRAMS(1)}) GROUP BY gram")
def q_unigram_counts(spark, sf_dir):
    return ngrams.counts(documents(spark, sf_dir), 1)


@query(f"SELECT gram, count(*) AS cnt FROM ({GRAMS(2)}) GROUP BY gram")
def q_bigram_counts(spark, sf_dir):
    return ngrams.counts(documents(spark, sf_dir), 2)


@query(f"SELECT gram, cnt FROM (SELECT gram, count(*) AS cnt FROM ({GRAMS(2)}) GROUP BY gram) d WHERE NOT EXISTS (SELECT 1 FROM ({GRAMS(2, source='benchmark')}) b WHERE b.gram = d.gram)")
def q_unfamiliar_ngrams(spark, sf_dir):
    new, reference = ngrams.counts(documents(spark, sf_dir), 2), ngrams.counts(table(spark, sf_dir, "benchmark"), 2)
    return ngrams.unfamiliar(new, reference).select("gram", "cnt")


RESIDUALS = f"""WITH new AS (SELECT lang, gram, count(*) AS cnt FROM ({GRAMS(2, 'lang,')}) GROUP BY ALL),
 ref AS (SELECT gram, count(*) AS cnt FROM ({GRAMS(2, source='benchmark')}) GROUP BY ALL),
 tot AS (SELECT lang, sum(cnt) AS n FROM new GROUP BY lang),
 joined AS (SELECT tot.lang, ref.gram, coalesce(new.cnt, 0) AS observed, CAST(ref.cnt AS DOUBLE) / (SELECT CAST(sum(cnt) AS DOUBLE) FROM ref) * CAST(tot.n AS DOUBLE) AS e
   FROM ref CROSS JOIN tot LEFT JOIN new ON new.gram = ref.gram AND new.lang IS NOT DISTINCT FROM tot.lang),
 res AS (SELECT lang, gram, observed, (observed - e) / sqrt(e) AS r FROM joined WHERE e > 0)
"""


@query(RESIDUALS + "SELECT lang, gram, observed, round(r, 6) AS residual FROM res")
def q_ngram_residuals(spark, sf_dir):
    new, reference = ngrams.counts(documents(spark, sf_dir), 2, "text", "lang"), ngrams.counts(table(spark, sf_dir, "benchmark"), 2)
    return ngrams.residuals(new, reference, "lang").select("lang", "gram", "observed", F.round("residual", 6).alias("residual"))


@query(RESIDUALS + "SELECT lang, gram, round(r, 6) AS residual, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY abs(r) DESC, gram) AS rank FROM res) WHERE rank <= 10 AND r > 5")
def q_residual_outliers(spark, sf_dir):
    new, reference = ngrams.counts(documents(spark, sf_dir), 2, "text", "lang"), ngrams.counts(table(spark, sf_dir, "benchmark"), 2)
    found = ngrams.outliers(ngrams.residuals(new, reference, "lang"), 10, 5, "lang")
    return found.select("lang", "gram", F.round("residual", 6).alias("residual"), F.col("rank").cast("long").alias("rank"))


@query(f"SELECT gram, count(*) AS cnt FROM ({GRAMS(2)} UNION ALL {GRAMS(2, source='benchmark')}) GROUP BY gram")
def q_ngram_upsert(spark, sf_dir):
    return ngrams.upsert(ngrams.counts(table(spark, sf_dir, "benchmark"), 2), ngrams.counts(documents(spark, sf_dir), 2))


# ---- line classes, coordinates, runs


@query(rf"""SELECT doc_id, line_no, CASE WHEN trim(line) = '' THEN 'blank' WHEN regexp_matches(line, '^\{{([^}}]+)\}}\s*$') THEN 'section'
  WHEN regexp_matches(line, '^<(\d+),(\d+)>$') THEN 'page_line' WHEN regexp_matches(line, '^<(\d+)>$') THEN 'page' WHEN regexp_matches(line, '^<[^\n>]+>$') THEN 'note'
  WHEN regexp_matches(line, '^\[([^\]]+?)\]\t*(.*)$') THEN CASE WHEN trim(regexp_extract(line, '^\[([^\]]+?)\]\t*(.*)$', 2)) <> '' THEN 'condensed_verse' ELSE 'location' END
  WHEN start AND regexp_matches(line, '^(\S+ —)(\t+)(.*)$') THEN 'staggered_cue' WHEN start AND regexp_matches(line, '^(\S+) —\s*(.*)$') THEN 'speaker'
  WHEN regexp_matches(line, '^(.*[|—,])\s*_$') THEN 'head' WHEN regexp_matches(line, '^_(.*)$') THEN 'back' WHEN contains(line, chr(9)) THEN 'verse' ELSE 'prose' END AS class
FROM (SELECT *, coalesce(trim(lag(line) OVER (PARTITION BY doc_id ORDER BY line_no)) = '', true) AS start FROM ({MARKED}))""")
def q_line_classes(spark, sf_dir):
    marked = marked_lines(spark, sf_dir)
    start = F.coalesce(F.trim(F.lag("line").over(ordered.in_order())) == "", F.lit(True))
    return marked.withColumn("start", start).select("doc_id", "line_no", grammar.line_class(F.col("line"), F.col("start")).alias("class"))


@query(rf"""WITH p AS (SELECT *, regexp_matches(line, '^<\d+>$') AS is_page FROM ({MARKED})),
 r AS (SELECT *, last_value(CASE WHEN is_page THEN CAST(regexp_extract(line, '\d+') AS BIGINT) END IGNORE NULLS) OVER w AS page, sum(CASE WHEN is_page THEN 1 ELSE 0 END) OVER w AS run,
   NOT is_page AND trim(line, chr(9) || ' ') <> '' AND NOT regexp_matches(trim(line, chr(9) || ' '), '^(<[^>]+>|\{{[^}}]+\}}|\[\d+(,\d*)?\]|\[\])$') AS content FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
 n AS (SELECT *, CAST(1 + sum(CASE WHEN content THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, run ORDER BY line_no) AS BIGINT) AS number FROM r)
 SELECT doc_id, line_no, page, number, CASE WHEN is_page THEN line ELSE replace(line, '[]', '[' || coalesce(CAST(page AS VARCHAR), 'None') || ',' || number || ']') END AS filled FROM n""")
def q_page_line_numbers(spark, sf_dir):
    return ordered.with_page_lines(marked_lines(spark, sf_dir)).select("doc_id", "line_no", "page", "number", "filled")


@query(rf"""SELECT doc_id, line_no, last_value(nullif(regexp_extract(line, '^\{{([^}}]+)\}}\s*$', 1), '') IGNORE NULLS) OVER w AS section,
  last_value(nullif(regexp_extract(line, '^<(\d+)>$', 1), '') IGNORE NULLS) OVER w AS page FROM ({MARKED}) WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)""")
def q_fill_forward(spark, sf_dir):
    w = ordered.in_order()
    pick = lambda p: F.nullif(F.regexp_extract("line", p, 1), F.lit(""))
    return marked_lines(spark, sf_dir).select("doc_id", "line_no", ordered.fill_forward(pick(grammar.SECTION), w).alias("section"), ordered.fill_forward(pick(grammar.PAGE), w).alias("page"))


@query(rf"""WITH m AS (SELECT doc_id, line_no, line, last_value(CASE WHEN regexp_matches(line, '^<\d+>$') THEN regexp_extract(line, '\d+') END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS page FROM ({MARKED}))
SELECT doc_id, line_no, regexp_extract(line, '^\{{([^}}]+)\}}\s*$', 1) AS name, coalesce(page, 'N/A') AS page, replace(regexp_extract(line, '^\{{([^}}]+)\}}\s*$', 1), ' ', '_') AS id FROM m WHERE regexp_matches(line, '^\{{([^}}]+)\}}\s*$')""")
def q_toc(spark, sf_dir):
    w = ordered.in_order()
    page = ordered.fill_forward(F.nullif(F.regexp_extract("line", grammar.PAGE, 1), F.lit("")), w)
    name = F.regexp_extract("line", grammar.SECTION, 1)
    found = marked_lines(spark, sf_dir).withColumn("page", page).where(F.col("line").rlike(grammar.SECTION))
    return found.select("doc_id", "line_no", name.alias("name"), F.coalesce("page", F.lit("N/A")).alias("page"), F.replace(name, F.lit(" "), F.lit("_")).alias("id"))


SPEECHES = """WITH t AS (SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
 r AS (SELECT *, CAST(sum(CASE WHEN place = 1 OR role IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY place) AS BIGINT) AS run FROM t)
"""


@query(SPEECHES + "SELECT conv_id, run, max(role) AS speaker, min(place) AS first_place, max(place) AS last_place, count(*) AS rows, string_agg(text, ' ' ORDER BY place) AS text FROM r GROUP BY conv_id, run")
def q_speeches(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return ordered.runs(turns, "conv_id", ["turn", "role", "text"], F.col("role"), F.col("text")).withColumnRenamed("key", "speaker")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE event_type IS DISTINCT FROM before")
def q_consecutive_dedup(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").withColumn("before", F.lag("event_type").over(w)).where(~F.col("event_type").eqNullSafe(F.col("before"))).select("event_id", "user_id", "event_type")


@query("SELECT conv_id, turn, base || CASE WHEN n = 1 THEN '' ELSE '_' || n END AS id FROM (SELECT conv_id, turn, 'v' || role AS base, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn, text) AS n FROM conversations)")
def q_occurrence_ids(spark, sf_dir):
    n = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn", "text"))
    base = text.xml_id(F.col("role"))
    made = table(spark, sf_dir, "conversations").withColumn("n", n)
    return made.select("conv_id", "turn", F.when(F.col("n") == 1, base).otherwise(F.concat(base, F.lit("_"), F.col("n").cast("string"))).alias("id"))


@query("SELECT l_orderkey, count(*) AS lines, CASE WHEN count(*) > 1 THEN 'group' ELSE 'single' END AS kind, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS numbers FROM lineitem GROUP BY l_orderkey")
def q_verse_groups(spark, sf_dir):
    numbers = F.array_join(F.array_sort(F.collect_list("l_linenumber")), ",")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.when(F.count(F.lit(1)) > 1, "group").otherwise("single").alias("kind"), numbers.alias("numbers"))


HALVES = f"SELECT *, coalesce(sum(CASE WHEN closes THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS half FROM (SELECT doc_id, line_no, line LIKE '%.' AS closes, CAST(len(regexp_extract_all(lower(line), '(?:ai|au|[aāiīuūṛṝḷḹeo])')) AS BIGINT) AS n FROM ({LINES}))"


@query(f"SELECT doc_id, line_no, coalesce(sum(n) OVER (PARTITION BY doc_id, half ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({HALVES})")
def q_syllable_offsets(spark, sf_dir):
    """Syllables before a line in its half-verse; a line that closes one starts the count again."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    counted = ordered.lines(documents(spark, sf_dir)).withColumn("n", text.syllables(F.col("line")).cast("long"))
    halved = counted.withColumn("half", F.coalesce(F.sum(F.col("line").endswith(".").cast("int")).over(before(ordered.in_order())), F.lit(0)))
    place = before(Window.partitionBy("doc_id", "half").orderBy("line_no"))
    return halved.select("doc_id", "line_no", F.coalesce(F.sum("n").over(place), F.lit(0).cast("long")).alias("before"))


# ---- corrections and readings


@query(f"SELECT doc_id, unnest(range(1, len(s) + 1)) AS number, unnest(s) AS sic, unnest(c) AS corr FROM (SELECT doc_id, regexp_extract_all(t, '≤([^≥]*)≥«([^»]*)»', 1) AS s, regexp_extract_all(t, '≤([^≥]*)≥«([^»]*)»', 2) AS c FROM (SELECT doc_id, {EDITED} AS t FROM documents))")
def q_corrections(spark, sf_dir):
    pairs = F.arrays_zip(F.regexp_extract_all("text", F.lit(grammar.CHOICE), F.lit(1)).alias("sic"), F.regexp_extract_all("text", F.lit(grammar.CHOICE), F.lit(2)).alias("corr"))
    found = documents(spark, sf_dir, EDITED).select("doc_id", F.posexplode(pairs).alias("at", "p"))
    return found.select("doc_id", (F.col("at") + 1).cast("long").alias("number"), "p.sic", "p.corr")


@query(rf"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({EDITED}, '≤([^≥]*)≥«([^»]*)»', '\2', 'g'), '≤([^≥]*)≥', '', 'g'), '«([^»]*)»', '\1', 'g'), '¿([^¿]*)¿', '\1', 'g') AS reading FROM documents")
def q_plain_reading(spark, sf_dir):
    out = F.col("text")
    for pattern, kept in ((grammar.CHOICE, "$2"), (grammar.DELETED, ""), (grammar.SUPPLIED, "$1"), (grammar.UNCLEAR, "$1")):
        out = F.regexp_replace(out, pattern, kept)
    return documents(spark, sf_dir, EDITED).select("doc_id", out.alias("reading"))


@query(rf"""SELECT doc_id, bool_or(regexp_matches(line, '^\{{([^}}]+)\}}\s*$')) AS has_sections, bool_or(contains(line, chr(9))) AS has_verses, bool_or(regexp_matches(line, '-\s*$')) AS has_hyphens,
  count(*) FILTER (regexp_matches(line, '^<(\d+)>$')) AS pages FROM ({MARKED}) GROUP BY doc_id""")
def q_doc_flags(spark, sf_dir):
    any_of = lambda p: F.bool_or(F.col("line").rlike(p))
    return marked_lines(spark, sf_dir).groupBy("doc_id").agg(any_of(grammar.SECTION).alias("has_sections"), any_of("\t").alias("has_verses"), any_of(grammar.HYPHEN_END).alias("has_hyphens"), F.count_if(F.col("line").rlike(grammar.PAGE)).alias("pages"))


# ---- rules

ISSUES = rf"""WITH d AS (SELECT doc_id, t, regexp_extract_all(t, '(?s)\[(.*?)\]', 1) AS sq, regexp_extract_all(t, '(?s)\{{(.*?)\}}', 1) AS cu, regexp_extract_all(t, '(?s)<(.*?)>', 1) AS an,
   regexp_extract_all(regexp_replace(t, '\(\([^)]+\)\)', '', 'g'), '(?s)\((.*?)\)', 1) AS ro FROM (SELECT doc_id, {BRACKETED} AS t FROM documents)),
 i AS (SELECT doc_id, 'R1' AS rule, 'error' AS severity, unnest(list_filter(sq, lambda x: regexp_matches(x, '[{{}}<>]'))) AS detail FROM d
 UNION ALL SELECT doc_id, 'R2', 'error', unnest(list_filter(cu, lambda x: regexp_matches(x, '[\[\]<>]'))) FROM d
 UNION ALL SELECT doc_id, 'R3', 'error', unnest(list_filter(an, lambda x: regexp_matches(x, '[\[\]{{}}]'))) FROM d
 UNION ALL SELECT doc_id, 'R4', 'warning', unnest(list_filter(ro, lambda x: regexp_matches(x, '[()\[\]{{}}<>]'))) FROM d
 UNION ALL SELECT doc_id, 'R5', 'error', '' FROM d WHERE len(sq) = 0
 UNION ALL SELECT doc_id, 'R6', 'error', '' FROM d WHERE len(cu) = 0
 UNION ALL SELECT doc_id, 'R7', 'error', unnest(list_filter(sq, lambda x: trim(x) = '')) FROM d
 UNION ALL SELECT doc_id, 'R8', 'error', unnest(list_filter(cu, lambda x: trim(x) = '')) FROM d)
"""


@query(ISSUES + "SELECT doc_id, rule, severity, detail FROM i")
def q_bracket_rules(spark, sf_dir):
    return validation.bracket_issues(documents(spark, sf_dir, BRACKETED))


@query(ISSUES + "SELECT d.doc_id, count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'error') = 0 AS valid FROM d LEFT JOIN i USING (doc_id) GROUP BY d.doc_id")
def q_verdicts(spark, sf_dir):
    docs = documents(spark, sf_dir, BRACKETED)
    return validation.verdicts(validation.bracket_issues(docs), docs)


@query("SELECT page_id, CASE WHEN first LIKE 'No %' THEN NULL WHEN first NOT LIKE '[%' THEN 'not a link' WHEN NOT contains(first, '](') THEN 'link without target' END AS issue FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'No scan' WHEN 1 THEN url WHEN 2 THEN '[' || url ELSE '[x](' || url || ')' END AS first FROM pages)")
def q_link_lint(spark, sf_dir):
    first = F.expr("CASE page_id % 4 WHEN 0 THEN 'No scan' WHEN 1 THEN url WHEN 2 THEN '[' || url ELSE '[x](' || url || ')' END")
    return table(spark, sf_dir, "pages").select("page_id", validation.link_lint(first).alias("issue"))


# ---- metadata


@query(rf"""WITH l AS (SELECT doc_id, unnest(range(len(p))) AS line_no, unnest(p) AS line FROM (SELECT doc_id, string_split({HEADED}, chr(10)) AS p FROM documents)),
 s AS (SELECT *, CAST(sum(CASE WHEN regexp_matches(line, '^# .+') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS ord FROM l),
 g AS (SELECT doc_id, ord, max(CASE WHEN regexp_matches(line, '^# .+') THEN trim(substring(line, 3)) END) AS field,
   regexp_replace(coalesce(string_agg(CASE WHEN NOT regexp_matches(line, '^# .+') THEN line END, chr(10) ORDER BY line_no), ''), '^\n+|\n+$', '', 'g') AS body FROM s WHERE ord > 0 GROUP BY doc_id, ord),
 k AS (SELECT *, body <> '' AND len(list_filter(string_split(body, chr(10)), lambda x: NOT regexp_matches(x, '^[-*]\s+'))) = 0 AS bullets FROM g)
 SELECT doc_id, ord, field, CASE WHEN bullets THEN 'list' ELSE 'text' END AS kind, CASE WHEN NOT bullets THEN trim(replace(body, chr(10), ' ')) END AS value,
   CASE WHEN bullets THEN array_to_string(list_transform(string_split(body, chr(10)), lambda x: regexp_replace(x, '^[-*]\s+', '')), ';') END AS items FROM k""")
def q_metadata_sections(spark, sf_dir):
    found = metadata.sections(ordered.lines(documents(spark, sf_dir, HEADED)))
    return found.withColumn("items", F.array_join("items", ";"))


@query("""SELECT page_id, 'page ' || page_id AS text, CASE WHEN page_id % 3 = 0 THEN '/static/data/miscellaneous/' || page_id || '.PDF' ELSE url || '.xml' END AS url, 'see it' AS description, CASE WHEN page_id % 3 = 0 THEN '.pdf' ELSE '.xml' END AS filetype FROM pages""")
def q_metadata_links(spark, sf_dir):
    item = F.expr("'[page ' || page_id || '](' || CASE WHEN page_id % 3 = 0 THEN 'miscellaneous/' || page_id || '.PDF' ELSE url || '.xml' END || '): see it'")
    return table(spark, sf_dir, "pages").withColumn("link", metadata.parse_link(item)).select("page_id", "link.*")


OFFSETS = "(VALUES (CAST(1 AS BIGINT), CAST(9 AS BIGINT)), (40, 52), (200, 215))"


@query(f"SELECT p.page_id, s.book AS step_book, p.page_id - s.book + s.pdf AS pdf_page FROM pages p ASOF LEFT JOIN {OFFSETS} s(book, pdf) ON p.page_id >= s.book")
def q_page_offsets(spark, sf_dir):
    steps = spark.createDataFrame([(1, 9), (40, 52), (200, 215)], "book bigint, pdf bigint").withColumn("edition", F.lit(0))
    pages = table(spark, sf_dir, "pages").select("page_id", F.lit(0).alias("edition"))
    found = metadata.as_of(pages, steps, ["edition"], "page_id", "book", "pdf")
    return found.select("page_id", "step_book", (F.col("page_id") - F.col("step_book") + F.col("pdf")).alias("pdf_page"))


@query("SELECT max(greatest(o_orderdate, l_shipdate)) AS latest FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def q_latest_version(spark, sf_dir):
    joined = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").join(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.agg(F.max(metadata.latest(F.col("o_orderdate"), F.col("l_shipdate"))).alias("latest"))


@query("SELECT o_custkey, min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year FROM orders GROUP BY o_custkey")
def q_year_span(spark, sf_dir):
    first, last = metadata.years(F.concat_ws(" ", F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd")))
    spans = table(spark, sf_dir, "orders").select("o_custkey", first.cast("long").alias("a"), last.cast("long").alias("b"))
    return spans.groupBy("o_custkey").agg(F.min("a").alias("first_year"), F.max("b").alias("last_year"))


CONFIG = "(VALUES ('src0', true, 'p.'), ('src1', false, 'act '), ('src2', true, 'fol.'))"


@query(f"SELECT d.doc_id, coalesce(c.drama, false) AS drama, coalesce(c.page_label, 'p.') AS page_label FROM documents d LEFT JOIN {CONFIG} c(source, drama, page_label) USING (source)")
def q_config_lookup(spark, sf_dir):
    config = spark.createDataFrame([("src0", True, "p."), ("src1", False, "act "), ("src2", True, "fol.")], "source string, drama boolean, page_label string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return metadata.with_config(docs, config, "source", {"drama": False, "page_label": "p."}).select("doc_id", "drama", "page_label")


@query("SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n LEFT JOIN (SELECT lower(substring(r_name, 1, 1)) AS k, min(r_name) AS r_name FROM region GROUP BY k) r ON lower(substring(n.n_name, 1, 1)) = r.k")
def q_case_insensitive_lookup(spark, sf_dir):
    left = table(spark, sf_dir, "nation").withColumn("initial", F.substring("n_name", 1, 1))
    right = table(spark, sf_dir, "region").withColumn("key", F.substring(F.lower("r_name"), 1, 1))
    return metadata.lower_lookup(left, right, "initial", "key", "r_name").select("n_nationkey", "n_name", "r_name")


@query("SELECT doc_id, licence FROM documents JOIN (VALUES ('en', 'by'), ('fr', 'by-sa'), ('de', 'by-nc'), ('es', 'zero')) l(lang, licence) USING (lang)")
def q_licence_lookup(spark, sf_dir):
    """A language without a licence would fail the job."""
    from .operators.header import licensed

    licences = spark.createDataFrame([("en", "by"), ("fr", "by-sa"), ("de", "by-nc"), ("es", "zero")], "lang string, licence string")
    docs = table(spark, sf_dir, "documents").where("lang IN ('en', 'fr', 'de', 'es')").select("doc_id", "lang")
    return licensed(docs, licences, "lang").select("doc_id", "licence")


# ---- reports and sets

REPORT = "SELECT source || CASE WHEN doc_id % 2 = 0 THEN '.xml.svrl.xml' ELSE '.svrl.xml' END AS svrl_file, CASE WHEN doc_id % 3 = 0 THEN 'jing' ELSE 'saxon' END AS status, CASE WHEN doc_id % 5 = 0 THEN 'Error: ' ELSE '' END || '“' || lang || '”   is  wrong' AS message FROM documents WHERE {}"
COUNTED = "(SELECT replace(svrl_file, '.xml.svrl.xml', '.svrl.xml') AS svrl_file, CASE WHEN status = 'jing' THEN 'RNG FAIL' ELSE 'SCH FAIL' END AS status, regexp_replace(regexp_replace(replace(replace(message, '“', '\"'), '”', '\"'), '\\s+', ' ', 'g'), '^(error|fatal|warning)\\s*:\\s*', '', 'i') AS message, count(*) AS n FROM ({}) GROUP BY ALL)"


@query(f"SELECT svrl_file, status, message, coalesce(a.n, 0) AS left_count, coalesce(b.n, 0) AS right_count, CASE WHEN b.n IS NULL THEN 'left' WHEN a.n IS NULL THEN 'right' ELSE 'both' END AS side FROM {COUNTED.format(REPORT.format('n_chars % 3 > 0'))} a FULL JOIN {COUNTED.format(REPORT.format('n_chars % 4 > 1'))} b USING (svrl_file, status, message)")
def q_report_comparison(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    made = docs.select("n_chars", *[F.expr(e).alias(n) for e, n in (("source || CASE WHEN doc_id % 2 = 0 THEN '.xml.svrl.xml' ELSE '.svrl.xml' END", "svrl_file"), ("CASE WHEN doc_id % 3 = 0 THEN 'jing' ELSE 'saxon' END", "status"), ("CASE WHEN doc_id % 5 = 0 THEN 'Error: ' ELSE '' END || '“' || lang || '”   is  wrong'", "message"))])
    return diffing.compare(made.where("n_chars % 3 > 0"), made.where("n_chars % 4 > 1"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_stale_outputs(spark, sf_dir):
    return metadata.stale(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id")


@query("SELECT kind, id, message FROM (SELECT 'document' AS kind, doc_id AS id, lang AS message FROM documents UNION ALL SELECT 'page', page_id, url FROM pages)")
def q_union_reports(spark, sf_dir):
    a = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("lang").alias("message"))
    return a.unionByName(table(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("message")))


@query("(SELECT lang FROM documents WHERE source = 'src0' INTERSECT SELECT lang FROM documents WHERE source <> 'src0')")
def q_key_intersection(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.where("source = 'src0'").select("lang").intersect(docs.where("source <> 'src0'").select("lang"))


@query("(SELECT n_regionkey FROM nation EXCEPT SELECT n_regionkey FROM nation WHERE n_regionkey < 3)")
def q_key_difference(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select("n_regionkey")
    return rows.subtract(rows.where("n_regionkey < 3"))


@query("SELECT file, bool_or(failed) AS failed, count(*) FILTER (failed) AS failures, count(*) AS files FROM (SELECT source AS file, n_chars % 7 = 0 AS failed FROM documents) GROUP BY file")
def q_status_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("source").alias("file"), (F.col("n_chars") % 7 == 0).alias("failed"))
    return rows.groupBy("file").agg(F.bool_or("failed").alias("failed"), F.count_if("failed").alias("failures"), F.count(F.lit(1)).alias("files"))


@query(f"WITH m AS (SELECT doc_id, line_no, line, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS n FROM ({MARKED}) WHERE contains(line, chr(9))), c AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS n, line FROM ({LINES}) WHERE line_no % 4 = 1) SELECT m.doc_id, m.line_no, c.line AS gloss FROM m LEFT JOIN c USING (doc_id, n)")
def q_positional_glosses(spark, sf_dir):
    """Spans and glosses meet by their ordinal; spans beyond the list have none."""
    n = F.row_number().over(ordered.in_order())
    spans = marked_lines(spark, sf_dir).where(F.contains("line", F.lit("\t"))).withColumn("n", n).drop("line")
    glosses = ordered.lines(documents(spark, sf_dir)).where("line_no % 4 = 1").withColumn("n", n).select("doc_id", "n", F.col("line").alias("gloss"))
    return spans.join(glosses, ["doc_id", "n"], "left").select("doc_id", "line_no", "gloss")


# ---- headers and romanization


def _hk(column: str) -> str:
    from .functions.translit import HK_IAST

    for a, b in HK_IAST:
        column = f"replace({column}, '{a}', '{b}')"
    return column


@query(f"SELECT n_nationkey, {_hk('n_name')} AS iast FROM nation")
def q_romanization(spark, sf_dir):
    from .functions.translit import hk_to_iast

    return table(spark, sf_dir, "nation").select("n_nationkey", hk_to_iast(F.col("n_name")).alias("iast"))


@query("SELECT o_orderkey, strftime(greatest(o_orderdate, o_orderdate + INTERVAL (o_orderkey % 9 - 4) DAY), '%Y-%m-%d') AS iso, year(greatest(o_orderdate, o_orderdate + INTERVAL (o_orderkey % 9 - 4) DAY)) AS year, strftime(greatest(o_orderdate, o_orderdate + INTERVAL (o_orderkey % 9 - 4) DAY), '%B %d, %Y') AS long FROM orders")
def q_header_dates(spark, sf_dir):
    from .operators.header import dated

    other = F.expr("date_format(date_add(o_orderdate, cast(o_orderkey % 9 - 4 AS int)), 'yyyy-MM-dd')")
    found = table(spark, sf_dir, "orders").select("o_orderkey", dated(F.date_format("o_orderdate", "yyyy-MM-dd"), other).alias("d"))
    return found.select("o_orderkey", "d.iso", F.col("d.year").cast("long").alias("year"), "d.long")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS \"when\", 'clerk ' || o_custkey AS who, o_orderpriority || ': done' AS what, contains(o_orderpriority, 'HIGH') AS ours FROM orders")
def q_header_changes(spark, sf_dir):
    from .operators.header import change

    item = F.expr("'(' || date_format(o_orderdate, 'yyyy-MM-dd') || ') clerk ' || o_custkey || ': ' || o_orderpriority || ': done'")
    return table(spark, sf_dir, "orders").select("o_orderkey", change(item, "HIGH").alias("c")).select("o_orderkey", "c.*")


@query("SELECT n_nationkey, '<title>' || n_name || '</title><idno>' || n_regionkey || '</idno><note></note>' AS header FROM nation")
def q_header_fill(spark, sf_dir):
    from .operators.header import fill

    template = F.lit("<title>{{TITLE}}</title><idno>{{REGION}}</idno><note>{{NO_VALUE}}</note>")
    return table(spark, sf_dir, "nation").select("n_nationkey", fill(template, {"TITLE": F.col("n_name"), "REGION": F.col("n_regionkey")}).alias("header"))


@query("SELECT doc_id, unnest([1, 2]) AS ord, unnest(['Title', 'Languages']) AS field, unnest(['<p>' || source || '</p>', '<ul><li>' || lang || '</li><li>' || lang || '2</li></ul>']) AS html FROM documents")
def q_metadata_html(spark, sf_dir):
    from .functions.markdown import sections_html

    found = sections_html(metadata.sections(ordered.lines(documents(spark, sf_dir, HEADED))), ["Title", "Languages"])
    return found.withColumn("ord", F.col("ord").cast("int"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_bigram_counts(spark, sf_dir)


from . import catalogue_editions, catalogue_sources  # noqa: E402, F401
