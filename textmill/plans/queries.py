"""Queries over the driver's tables, each with the SQL that gives the same rows. Shapes that the tables lack (bullets,
footnotes, broken words, stock phrases) are put in by the query and its SQL alike."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.names import inserted
from textmill.functions.patterns import Grammar
from textmill.operators import audit, budget, chunk, curate, hyphen, model, parallel, publish, segment, serve
from textmill.operators import split as splits
from textmill.session import new_path
from textmill.sources import tables
from textmill.sources.stages import StageTable
from textmill.sources.tables import explode_lines

G = Grammar()
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


LINES = "lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_lines(documents(spark, sf_dir).select("doc_id", "text"))


@query(f"WITH {LINES} SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, raw FROM lines WHERE regexp_matches(raw, '\\S')")
def line_explode_ordinal(spark, sf_dir):
    return lines(spark, sf_dir).withColumn("line_no", F.col("line_no").cast("long"))


@query(rf"""WITH {LINES}, bent AS (SELECT doc_id, line_no, CASE line_no % 4 WHEN 1 THEN '  • - ' || raw WHEN 2 THEN raw || chr(9) || ' ' WHEN 3 THEN chr(7) || raw ELSE raw END AS raw FROM lines WHERE regexp_matches(raw, '\S')),
a AS (SELECT *, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS s FROM bent)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, regexp_replace(regexp_replace(regexp_replace(s, '[\x07\x1f]', '', 'g'), '^[•▪\-–*][•▪\-–*\s]*', ''), '^\s+|\s+$', '', 'g') AS text, regexp_matches(s, '^[•▪]') AS is_bullet FROM a""")
def clean_lines(spark, sf_dir):
    n, raw = F.col("line_no") % 4, F.col("raw")
    bent = F.when(n == 1, F.concat(F.lit("  • - "), raw)).when(n == 2, F.concat(raw, F.lit("\t "))).when(n == 3, F.concat(F.lit("\x07"), raw)).otherwise(raw)
    d = lines(spark, sf_dir).withColumn("raw", bent)
    return d.select("doc_id", F.col("line_no").cast("long").alias("line_no"), T.clean_line(F.col("raw"), G).alias("text"), T.is_bullet(F.col("raw")).alias("is_bullet"))


@query(r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(replace(text, '. ', '.' || chr(13) || chr(10) || chr(13) || chr(10) || chr(13)), '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS text FROM documents""")
def clean_fields(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.clean_field(F.replace(F.col("text"), F.lit(". "), F.lit(".\r\n\r\n\r"))).alias("text"))


@query(r"""SELECT conv_id, turn, CASE WHEN regexp_matches(t, '\p{L}') THEN regexp_extract(t, '(?s)^(\P{L}*)(\p{L})(.*)$', 1) || upper(regexp_extract(t, '(?s)^(\P{L}*)(\p{L})(.*)$', 2)) || regexp_extract(t, '(?s)^(\P{L}*)(\p{L})(.*)$', 3) ELSE t END AS text FROM (SELECT conv_id, turn, '2) ' || lower(text) AS t FROM conversations)""")
def capitalize_first(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", T.capitalised(F.concat(F.lit("2) "), F.lower("text"))).alias("text"))


NOTES = "replace(replace(text, 'e. ', 'e12,3. '), 'n, ', 'n4-6, ')"
FOOT = r"([\p{Ll})%\]”»\x22])(\d{1,3}(?:[,\-–.]\d{1,3})*)([\s.,;:)\]]|$)"


def _noted() -> Column:
    return F.replace(F.replace(F.col("text"), F.lit("e. "), F.lit("e12,3. ")), F.lit("n, "), F.lit("n4-6, "))


@query(rf"SELECT doc_id, regexp_replace({NOTES}, '{FOOT}', '\1\3', 'g') AS text FROM documents")
def footnote_strip(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.strip_footnotes(_noted()).alias("text"))


@query(rf"SELECT doc_id, CAST(coalesce(list_sum(list_transform(regexp_extract_all({NOTES}, '{FOOT}', 2), lambda r: len(regexp_extract_all(r, '\d+')))), 0) AS BIGINT) AS n FROM documents")
def footnote_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.footnote_count(_noted()).alias("n"))


COUNTS = r"CAST(len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: regexp_matches(x, '\S'))) AS BIGINT) AS sentences, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS BIGINT) AS words, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS BIGINT) AS tokens"


@query(f"SELECT doc_id, {COUNTS} FROM documents")
def sentence_word_counts(spark, sf_dir):
    c = F.col("text")
    return documents(spark, sf_dir).select("doc_id", T.sentence_count(c).alias("sentences"), T.word_count(c).alias("words"), T.token_count(c).alias("tokens"))


@query(f"SELECT lang, count(*) AS n, CAST(sum(sentences) AS BIGINT) AS sentences, CAST(sum(words) AS BIGINT) AS words FROM (SELECT lang, {COUNTS} FROM documents) GROUP BY lang")
def text_totals(spark, sf_dir):
    return audit.totals(documents(spark, sf_dir), ["text"], ["lang"])


@query(r"SELECT lang, 'text' AS field, count(*) AS n, round(avg(t), 6) AS mean, round(stddev_samp(t), 6) AS std FROM (SELECT lang, CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS DOUBLE) AS t FROM documents WHERE regexp_matches(text, '\S')) GROUP BY lang")
def length_stats_by_lang(spark, sf_dir):
    out = audit.lengths(documents(spark, sf_dir), ["text"], ["lang"])
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


def _labelled(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").withColumnRenamed("doc_id", "_id")
    return documents(spark, sf_dir).join(labels, F.col("doc_id") == F.col("_id"), "left").drop("_id")


@query(r"SELECT lang, round(avg((quality IS NOT NULL)::INT) * 100, 6) AS quality_present, round(avg((toxic IS NOT NULL)::INT) * 100, 6) AS toxic_present, round(avg(coalesce(regexp_matches(text, '\S'), false)::INT) * 100, 6) AS text_nonblank FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def presence_rates(spark, sf_dir):
    out = audit.presence(_labelled(spark, sf_dir), ["quality", "toxic"], ["text"], ["lang"])
    return out.select("lang", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END) AS missing FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic IS NULL")
def incomplete_rows(spark, sf_dir):
    return audit.incomplete(_labelled(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in ("quality", "toxic")}), ["text", "quality", "toxic"], ["doc_id"])


@query("SELECT doc_id, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, left(text, 20) ORDER BY length(text) DESC, doc_id) AS r FROM documents) WHERE r = 1")
def dedup_keep_longest(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("head", F.left("text", F.lit(20)))
    return curate.keep_longest(d, ["lang", "source", "head"], F.length("text"), ["doc_id"]).select("doc_id", "lang", "source", "n_chars")


RECORDS = """r AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN ' no evidence was found' WHEN 1 THEN 'Please See the previous section.' WHEN 2 THEN NULL WHEN 3 THEN '  ' ELSE text END AS evidence,
CASE doc_id % 3 WHEN 0 THEN 'None' WHEN 1 THEN '' ELSE text END AS considerations FROM documents),
f AS (SELECT *, coalesce(regexp_matches(evidence, '(?i)\\bsee\\s+(the\\s+)?previous\\s+sections?\\b'), false) AS refers,
coalesce(regexp_matches(trim(evidence), '(?i)^(No evidence|No studies were found|Not applicable)'), false) AND (trim(coalesce(considerations, '')) IN ('', 'None', 'None.', 'N/A')) AS place FROM r)"""


def _records(spark, sf_dir):
    k, n, text = F.col("doc_id") % 5, F.col("doc_id") % 3, F.col("text")
    evidence = F.when(k == 0, " no evidence was found").when(k == 1, "Please See the previous section.").when(k == 2, F.lit(None)).when(k == 3, "  ").otherwise(text)
    return documents(spark, sf_dir).select("doc_id", evidence.alias("evidence"), F.when(n == 0, "None").when(n == 1, "").otherwise(text).alias("considerations"))


@query(f"WITH {RECORDS} SELECT doc_id, CASE WHEN coalesce(regexp_matches(evidence, '\\S'), false) THEN evidence ELSE 'No evidence reported.' END AS evidence, considerations FROM f WHERE NOT refers AND NOT place")
def placeholder_filter_fill(spark, sf_dir):
    return curate.filtered(_records(spark, sf_dir), G)


@query(f"WITH {RECORDS} SELECT count(*) AS n_rows, count_if(refers) AS n_cross_reference, count_if(NOT refers AND place AND trim(considerations) = '') AS n_placeholder_empty, count_if(NOT refers AND place AND trim(considerations) <> '') AS n_placeholder_phrase, count_if(NOT refers AND NOT place AND NOT coalesce(regexp_matches(evidence, '\\S'), false)) AS n_filled FROM f")
def removal_counters(spark, sf_dir):
    return curate.removal_counts(_records(spark, sf_dir), G)


BENT = """b AS (SELECT doc_id, lang, CASE WHEN doc_id % 4 = 0 THEN text || '. 2.1. Heading here' ELSE text END AS topic, CASE WHEN doc_id % 3 = 0 THEN text || ' the ' || lang || '- broken, here' WHEN doc_id % 6 = 1 THEN text || 'ends. 3 Heading ' ELSE text END AS evidence FROM documents)"""
LEAK = r"\.\s\d+(?:\.\d+){0,3}\.?\s\p{Lu}[^.:]*$"
HYPH = r"\p{Ll}-\s+\p{Ll}"


def _bent(spark, sf_dir):
    k, text = F.col("doc_id"), F.col("text")
    evidence = F.when(k % 3 == 0, F.concat(text, F.lit(" the "), "lang", F.lit("- broken, here"))).when(k % 6 == 1, F.concat(text, F.lit("ends. 3 Heading "))).otherwise(text)
    return documents(spark, sf_dir).select("doc_id", F.when(k % 4 == 0, F.concat(text, F.lit(". 2.1. Heading here"))).otherwise(text).alias("topic"), evidence.alias("evidence"))


@query(f"WITH {BENT} SELECT * FROM (SELECT doc_id, CASE WHEN regexp_matches(rtrim(topic), '{LEAK}') THEN 'topic' WHEN regexp_matches(rtrim(evidence), '{LEAK}') THEN 'evidence' END AS field FROM b) WHERE field IS NOT NULL")
def first_violation(spark, sf_dir):
    return audit.leaks(_bent(spark, sf_dir), ["topic", "evidence"], ["doc_id"])


@query(f"WITH {BENT} SELECT doc_id, 'evidence' AS field, lang || '- broken' AS words FROM b WHERE regexp_matches(evidence, '{HYPH}')")
def hyphen_audit(spark, sf_dir):
    return audit.hyphens(_bent(spark, sf_dir), ["topic", "evidence"], ["doc_id"])


def _quota(rows: str, size: int, name: str) -> str:
    return f"""{name}_c AS (SELECT source AS s, count(*) AS c FROM {rows} GROUP BY 1), {name}_e AS (SELECT s, c, CAST(c * {size} AS DOUBLE) / (SELECT sum(c) FROM {name}_c) AS e FROM {name}_c),
{name}_r AS (SELECT *, floor(e) AS q, row_number() OVER (ORDER BY e - floor(e) DESC, s) AS r, {size} - sum(floor(e)) OVER () AS more FROM {name}_e),
{name} AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || '|42'), doc_id) <= least(q + (r <= more)::INT, c) AS drawn FROM {rows} d JOIN {name}_r ON source = s)"""


@query(f"WITH {_quota('documents', 125, 't')}, rest AS (SELECT * EXCLUDE (drawn) FROM t WHERE NOT drawn), {_quota('rest', 63, 'v')} SELECT doc_id, source, 'test' AS split FROM t WHERE drawn UNION ALL SELECT doc_id, source, CASE WHEN drawn THEN 'dev' ELSE 'train' END FROM v")
def stratified_split(spark, sf_dir):
    return splits.split(documents(spark, sf_dir).select("doc_id", "source"), "source", "doc_id", 125, 63)


@query("SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'dev' ELSE 'train' END AS split, lang FROM documents")
def split_union_tag(spark, sf_dir):
    d, k = documents(spark, sf_dir).select("doc_id", "lang"), F.col("doc_id") % 10
    return curate.rebuilt({"train": d.filter(k > 1), "dev": d.filter(k == 1), "test": d.filter(k == 0)})


@query("SELECT id, suffix, row_number() OVER (PARTITION BY source ORDER BY suffix) AS place FROM (SELECT source, source || '_' || doc_id AS id, doc_id AS suffix FROM documents)")
def numeric_suffix_sort(spark, sf_dir):
    d = documents(spark, sf_dir).select("source", F.concat_ws("_", "source", F.col("doc_id").cast("string")).alias("id"))
    d = d.withColumn("suffix", curate.suffix_number(F.col("id")))
    return d.select("id", "suffix", F.row_number().over(Window.partitionBy("source").orderBy(*curate.suffix_order("id"))).cast("long").alias("place"))


@query("SELECT 'doc_' || row_number() OVER (ORDER BY source, doc_id) AS id, doc_id FROM documents")
def sequential_ids(spark, sf_dir):
    d = documents(spark, sf_dir).select("source", "doc_id")
    return curate.with_ids(d, "doc", ["source", "doc_id"]).drop("source")


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 AND strpos(text, substr(text, 5, 6)) > 0 THEN substr(text, 1, strpos(text, substr(text, 5, 6)) - 1) || '[mended]' || substr(text, strpos(text, substr(text, 5, 6)) + length(substr(text, 5, 6))) ELSE text END AS text, CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS n_applied FROM documents")
def keyed_patch(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "text")
    patches = d.filter(F.col("doc_id") % 7 == 0).select("doc_id", F.lit("text").alias("field"), F.substring("text", 5, 6).alias("find"), F.lit("[mended]").alias("replacement"), F.lit(1).alias("ord"))
    return curate.patched(d, patches, ["text"], key="doc_id")


PARTS = "SELECT p_partkey, p_name, CASE WHEN p_size % 4 = 0 THEN '  ' ELSE p_brand END AS sub, 'a) ' || p_type AS question, CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'b.2. ' || p_size END AS focus FROM part"


def _parts(spark, sf_dir):
    s = F.col("p_size")
    return read(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(s % 4 == 0, "  ").otherwise(F.col("p_brand")).alias("sub"), F.concat(F.lit("a) "), F.col("p_type")).alias("question"), F.when(s % 3 != 0, F.concat(F.lit("b.2. "), s.cast("string"))).alias("focus"))


@query(f"SELECT p_partkey, concat_ws(chr(10), '- Topic: ' || trim(p_name), CASE WHEN trim(sub) <> '' THEN '- Subtopic: ' || trim(sub) END, '- Question: ' || trim(regexp_replace(question, '^a\\) ', '')), '- Focus: ' || regexp_replace(focus, '^b\\.2\\. ', '')) AS query FROM ({PARTS})")
def composite_labels(spark, sf_dir):
    c = F.col
    return _parts(spark, sf_dir).select("p_partkey", publish.question_text(c("p_name"), c("sub"), c("question"), c("focus"), G.labels["en"]).alias("query"))


@query(f"SELECT p_partkey, concat_ws(chr(10), CASE WHEN trim(sub) <> '' THEN '- Evidence: ' || trim(sub) END, '- Considerations: ' || focus) AS justification FROM ({PARTS})")
def justification(spark, sf_dir):
    return _parts(spark, sf_dir).select("p_partkey", publish.justification(F.col("sub"), F.col("focus"), G.justification_labels).alias("justification"))


@query("""SELECT 'cust_' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS id, 'market' AS source, c_mktsegment AS topic, c_name AS question, CAST(c_nationkey AS VARCHAR) AS judgement, CAST(c_nationkey AS VARCHAR) AS short_answer,
concat_ws(chr(10), '- Topic: ' || c_mktsegment, '- Question: ' || c_name) AS query, 'train' AS split FROM customer WHERE c_nationkey % 5 <> 0""")
def alias_publish(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    raw = c.select(F.col("c_custkey"), F.col("c_mktsegment").alias("Tema "), F.col("c_name").alias("Clinical-Question"), F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey").cast("string")).otherwise("  ").alias("JUDGEMENT"))
    aliases = {"topic": ["topic", "tema"], "question": ["question", "clinical question"], "judgement": ["judgment", "judgement"]}
    out = publish.normalised(raw, aliases, G, "market", "cust", F.col("c_custkey"), split="train")
    return out.select("id", "source", "topic", "question", "judgement", "short_answer", "query", "split")


BROKEN = r"broken AS (SELECT doc_id, regexp_replace(text, '([a-z]{4})([a-z]{3,}) ', '\1-' || chr(10) || '\2 ', 'g') AS text FROM documents), lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM broken)"


def _broken(spark, sf_dir):
    text = F.regexp_replace("text", "([a-z]{4})([a-z]{3,}) ", "$1-\n$2 ")
    return explode_lines(documents(spark, sf_dir).select("doc_id", text.alias("text")))


@query(rf"""WITH {BROKEN}, full_ AS (SELECT * FROM lines WHERE regexp_matches(raw, '\S')),
c AS (SELECT doc_id, line_no, regexp_extract(regexp_replace(raw, '\s+$', ''), '(\p{{L}}+)-$', 1) AS head, regexp_extract(lead(raw) OVER (PARTITION BY doc_id ORDER BY line_no), '^\s*(\p{{L}}+)', 1) AS tail FROM full_),
d AS (SELECT * FROM c WHERE length(head) BETWEEN 2 AND 20 AND length(tail) BETWEEN 2 AND 20),
j AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(raw, '\p{{L}}+'))) AS w FROM full_),
p AS (SELECT DISTINCT doc_id, lower(regexp_extract(r, '^(\p{{L}}+-\p{{L}}+)', 1)) AS w FROM (SELECT doc_id, unnest(regexp_extract_all(raw, '[\p{{L}}-]+')) AS r FROM full_) WHERE regexp_matches(r, '^\p{{L}}+-\p{{L}}+'))
SELECT d.doc_id, CAST(line_no AS BIGINT) AS line_no, head, tail, j.w IS NOT NULL AS has_joined, p.w IS NOT NULL AS has_compound, j.w IS NOT NULL AND p.w IS NULL AS merge
FROM d LEFT JOIN j ON d.doc_id = j.doc_id AND lower(head || tail) = j.w LEFT JOIN p ON d.doc_id = p.doc_id AND lower(head || '-' || tail) = p.w""")
def hyphen_decisions(spark, sf_dir):
    return hyphen.decided(_broken(spark, sf_dir)).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "head", "tail", "has_joined", "has_compound", "merge")


@query(rf"""WITH {BROKEN}, full_ AS MATERIALIZED (SELECT *, lead(raw) OVER w AS nraw, lead(line_no) OVER w AS next_no FROM lines WHERE regexp_matches(raw, '\S') WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)),
c AS MATERIALIZED (SELECT doc_id, line_no, next_no, regexp_extract(regexp_replace(raw, '\s+$', ''), '(\p{{L}}+)-$', 1) AS head, regexp_extract(nraw, '^\s*(\p{{L}}+)', 1) AS tail, regexp_extract(nraw, '^\s*\p{{L}}+([.,;:!?)\]»”\x22]*)', 1) AS marks FROM full_),
j AS MATERIALIZED (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(raw, '\p{{L}}+'))) AS w FROM full_),
p AS MATERIALIZED (SELECT DISTINCT doc_id, lower(regexp_extract(r, '^(\p{{L}}+-\p{{L}}+)', 1)) AS w FROM (SELECT doc_id, unnest(regexp_extract_all(raw, '[\p{{L}}-]+')) AS r FROM full_) WHERE regexp_matches(r, '^\p{{L}}+-\p{{L}}+')),
m AS MATERIALIZED (SELECT c.doc_id, line_no, next_no, tail || marks AS taken FROM c JOIN j ON c.doc_id = j.doc_id AND lower(head || tail) = j.w LEFT JOIN p ON c.doc_id = p.doc_id AND lower(head || '-' || tail) = p.w WHERE length(head) BETWEEN 2 AND 20 AND length(tail) BETWEEN 2 AND 20 AND p.w IS NULL),
b AS MATERIALIZED (SELECT f.doc_id, f.line_no, t.taken, CASE WHEN g.taken IS NULL THEN raw ELSE regexp_extract(raw, '^\s*') || regexp_replace(substr(raw, length(regexp_extract(raw, '^\s*')) + length(g.taken) + 1), '^\s+', '') END AS body
FROM full_ f LEFT JOIN m t ON f.doc_id = t.doc_id AND f.line_no = t.line_no LEFT JOIN m g ON f.doc_id = g.doc_id AND f.line_no = g.next_no)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CASE WHEN taken IS NULL THEN body ELSE regexp_replace(body, '-\s*$', '') || taken END AS raw FROM b""")
def hyphen_merge(spark, sf_dir):
    return hyphen.merged(_broken(spark, sf_dir)).withColumn("line_no", F.col("line_no").cast("long"))


LOOK = Grammar(lettered=r"^Th", judgement=r"tion")


@query(rf"""WITH {LINES}, f AS (SELECT doc_id, line_no, regexp_matches(raw, '^Th') AS lettered, regexp_matches(raw, '(?i)tion') AS j FROM lines WHERE regexp_matches(raw, '\S')),
w AS (SELECT *, min(CASE WHEN j THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS jn, min(CASE WHEN lettered THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS bn, coalesce(lead(lettered) OVER (PARTITION BY doc_id ORDER BY line_no), false) AS next_lettered FROM f)
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, lettered, lettered AND jn IS NOT NULL AND (bn IS NULL OR jn < bn) AS item, next_lettered FROM w""")
def heading_lookahead(spark, sf_dir):
    d = segment.real_items(lines(spark, sf_dir).withColumnRenamed("raw", "text"), LOOK)
    return d.select("doc_id", F.col("line_no").cast("long").alias("line_no"), "lettered", "item", segment.ahead(F.col("lettered")).alias("next_lettered"))


def _carried(spark, sf_dir):
    at = (("conv_id",), "turn")
    c = read(spark, sf_dir, "conversations")
    return c.withColumns({"question": segment.carried(F.when(F.col("role") == "user", F.col("text")), *at), "part": segment.counted(F.col("role") != "assistant", *at)})


CARRIED = "c AS (SELECT *, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w AS question, sum((role <> 'assistant')::BIGINT) OVER w AS part FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))"


@query(f"WITH {CARRIED} SELECT conv_id, CAST(part AS BIGINT) AS part, min(question) AS question, string_agg(text, ' ' ORDER BY turn) AS answer FROM c WHERE role = 'assistant' GROUP BY conv_id, part")
def carry_forward_sections(spark, sf_dir):
    d = _carried(spark, sf_dir).filter(F.col("role") == "assistant")
    return d.groupBy("conv_id", "part").agg(F.min("question").alias("question"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("answer"))


@query(f"WITH {CARRIED} SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN text END AS own, last_value(CASE WHEN turn % 3 = 0 THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id, part ORDER BY turn ROWS UNBOUNDED PRECEDING) AS inherited FROM c")
def inherit_within_key(spark, sf_dir):
    own = F.when(F.col("turn") % 3 == 0, F.col("text"))
    return _carried(spark, sf_dir).select("conv_id", "turn", own.alias("own"), segment.carried(own, ("conv_id", "part"), "turn").alias("inherited"))


@query("""WITH e AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ordinal FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, CAST(ordinal AS BIGINT) AS ordinal, CASE WHEN ordinal = 0 AND conv_id % 2 = 0 THEN 'first' WHEN ordinal = 1 AND conv_id % 2 = 0 THEN 'second' ELSE '' END AS topic FROM e""")
def orphan_lookup(spark, sf_dir):
    n = segment.counted(F.lit(True), ("conv_id",), "turn") - 1
    e = read(spark, sf_dir, "conversations").filter(F.col("role") == "assistant").select("conv_id", "turn", (F.col("conv_id") % 2).alias("doc_id"), n.cast("long").alias("orphan"))
    out = segment.orphan_titles(e, Grammar(orphans=(("0", 0, "first", ""), ("0", 1, "second", ""))))
    return out.select("conv_id", "turn", F.col("orphan").alias("ordinal"), F.coalesce("_ot", F.lit("")).alias("topic"))


@query(rf"WITH {LINES}, b AS (SELECT DISTINCT left(text, 4) AS prefix FROM benchmark) SELECT doc_id, CAST(line_no AS BIGINT) AS line_no FROM lines WHERE regexp_matches(raw, '\S') AND EXISTS (SELECT 1 FROM b WHERE starts_with(raw, prefix))")
def prefix_boundary(spark, sf_dir):
    b = read(spark, sf_dir, "benchmark").select(F.left("text", F.lit(4)).alias("title")).distinct()
    return segment.begins(lines(spark, sf_dir), b, text="raw").filter("boundary").select("doc_id", F.col("line_no").cast("long").alias("line_no"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(t, '[:;]')) AS BIGINT) AS n_marks, len(regexp_extract_all(t, '[:;]')) >= 3 AS tabular FROM (SELECT doc_id, replace(text, ', ', ': ') AS t FROM documents)")
def tabular_test(spark, sf_dir):
    t = F.replace(F.col("text"), F.lit(", "), F.lit(": "))
    return documents(spark, sf_dir).select("doc_id", F.regexp_count(t, F.lit("[:;]")).cast("long").alias("n_marks"), chunk.is_tabular(t).alias("tabular"))


def _texts(spark, sf_dir):
    return documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.lit("text").alias("field"), F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n")).alias("text"))


def _chunks_sql(texts: str, budget: int) -> str:
    """Tables up to `chunks` (id, field, para, piece, text, tokens) of the texts (id, field, text) that a query gives; packing is a recursion over a paragraph's pieces."""
    words = r"list_filter(regexp_split_to_array({}, '\s+'), lambda x: x <> '')"
    n = lambda t: f"len({words.format(t)})"
    cuts = lambda t, marks: rf"list_filter(string_split(regexp_replace({t}, '([{marks}])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '\S'))"
    alone = lambda t: f"(length({t}) <= 1800 AND {n(t)} <= {budget} AND ({n(t)} <= {budget * 0.75} OR len({cuts(t, '.!?')}) <= 1))"
    by_words = "list_transform(range(0, greatest(len(w), 1), 40), lambda i: array_to_string(w[i + 1 : i + 40], ' '))"
    return rf"""RECURSIVE tx AS ({texts}), t1 AS (SELECT *, {alone('text')} AS whole FROM tx WHERE regexp_matches(text, '\S')),
pl AS (SELECT id, field, CASE WHEN whole THEN [text] ELSE list_filter(string_split(text, chr(10) || chr(10)), lambda x: regexp_matches(x, '\S')) END AS ps FROM t1),
pa AS (SELECT id, field, unnest(ps) AS p, generate_subscripts(ps, 1) - 1 AS para FROM pl),
pb AS (SELECT *, {alone('p')} AS whole, CASE WHEN length(p) <= 1800 AND {n('p')} <= {budget} THEN CAST(floor({budget * 0.75}) AS INTEGER) ELSE {budget} END AS goal FROM pa),
sl AS (SELECT *, CASE WHEN whole OR len({cuts('p', '.!?')}) = 0 THEN [p] ELSE {cuts('p', '.!?')} END AS ss FROM pb),
se AS (SELECT id, field, para, goal, whole, unnest(ss) AS s, generate_subscripts(ss, 1) AS si FROM sl),
sn AS (SELECT *, {n('s')} AS n, {cuts('s', ':;')} AS parts, len(regexp_extract_all(s, '[:;]')) >= 3 AS tabular FROM se),
sp AS (SELECT *, CASE WHEN whole OR (n <= {budget} AND NOT tabular) THEN 'whole' WHEN len(parts) > 1 THEN 'parts' WHEN n <= {budget} THEN 'whole' ELSE 'words' END AS way FROM sn),
pp AS (SELECT id, field, para, goal, si, way, unnest(us) AS u, generate_subscripts(us, 1) AS ui FROM (SELECT *, CASE way WHEN 'parts' THEN parts ELSE [s] END AS us FROM sp)),
pw AS (SELECT *, {words.format('u')} AS w FROM pp),
pq AS (SELECT *, CASE WHEN way = 'words' OR (way = 'parts' AND len(w) > {budget}) THEN {by_words} ELSE [u] END AS vs FROM pw),
pv AS (SELECT id, field, para, goal, si, ui, way = 'parts' AS stands, unnest(vs) AS v, generate_subscripts(vs, 1) AS vi FROM pq),
pc AS (SELECT id, field, para, goal, stands, v, {n('v')} AS n, row_number() OVER (PARTITION BY id, field, para ORDER BY si, ui, vi) AS k FROM pv),
run AS (SELECT *, 0 AS piece, CASE WHEN stands THEN NULL ELSE n END AS open_ FROM pc WHERE k = 1
UNION ALL SELECT pc.*, CASE WHEN NOT pc.stands AND open_ + pc.n <= pc.goal THEN piece ELSE piece + 1 END, CASE WHEN pc.stands THEN NULL WHEN open_ + pc.n <= pc.goal THEN open_ + pc.n ELSE pc.n END
FROM run JOIN pc ON pc.id = run.id AND pc.field = run.field AND pc.para = run.para AND pc.k = run.k + 1),
chunks AS (SELECT id, field, para, piece, string_agg(v, ' ' ORDER BY k) AS text, sum(n) AS tokens FROM run GROUP BY id, field, para, piece)"""


@query(f"WITH {_chunks_sql('SELECT doc_id AS id, $$text$$ AS field, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents', 120)} SELECT id, field, CAST(para AS BIGINT) AS para, CAST(piece AS BIGINT) AS piece, text, CAST(tokens AS BIGINT) AS tokens FROM chunks")
def pack_budget(spark, sf_dir):
    d = chunk.chunks(_texts(spark, sf_dir), 120)
    return d.select("id", "field", F.col("para").cast("long").alias("para"), F.col("piece").cast("long").alias("piece"), "text", T.token_count(F.col("text")).alias("tokens"))


@query(r"SELECT doc_id AS id, 'text' AS field, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents WHERE regexp_matches(text, '\S')")
def chunk_reassemble(spark, sf_dir):
    """Chunks put together again have the words that the text has, in order."""
    out = chunk.reassembled(chunk.chunks(_texts(spark, sf_dir), 120))
    return out.withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))


def _sides(spark, sf_dir):
    d = documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("text").alias("body"), F.left("text", F.lit(60)).alias("head"))
    k = F.col("id")
    t = d.filter(k % 11 != 0).select("id", F.when(k % 7 == 0, "").when(k % 5 == 0, F.left("body", F.lit(20))).otherwise(F.col("body")).alias("body"), F.concat("head", F.lit(" ok")).alias("head"))
    return d, t


SIDES = """s AS (SELECT doc_id AS id, text AS body, left(text, 60) AS head FROM documents), t AS (SELECT id, CASE WHEN id % 7 = 0 THEN '' WHEN id % 5 = 0 THEN left(body, 20) ELSE body END AS body, head || ' ok' AS head FROM s WHERE id % 11 <> 0),
pr AS (SELECT id, 'body' AS field, s.body AS src, t.body AS mt FROM s JOIN t USING (id) UNION ALL SELECT id, 'head', s.head, t.head FROM s JOIN t USING (id)),
g AS (SELECT *, length(trim(mt, ' ' || chr(10))) / length(trim(src, ' ' || chr(10))) AS ratio FROM pr WHERE length(trim(src, ' ' || chr(10))) >= 40)"""


@query(f"WITH {SIDES} SELECT id, field, round(ratio, 6) AS ratio, CASE WHEN trim(mt, ' ' || chr(10)) = '' THEN 'EMPTY' WHEN ratio < 0.3 THEN CASE WHEN id % 3 = 0 AND field = 'body' THEN 'pending' ELSE 'truncated' END ELSE 'ok' END AS status FROM g")
def parallel_gate(spark, sf_dir):
    s, t = _sides(spark, sf_dir)
    path = new_path(spark, "flags") + ".jsonl"
    tables.write_jsonl(s.filter(F.col("id") % 3 == 0).select(F.col("id").cast("string").alias("id"), F.lit("body").alias("field")), path)
    exempt = tables.read_flags(spark, path)
    return parallel.gate(s, t, ["body", "head"], exempt).withColumn("ratio", F.round("ratio", 6))


@query(f"WITH {SIDES}, x AS (SELECT *, CASE WHEN trim(mt, ' ' || chr(10)) = '' THEN 'EMPTY' WHEN ratio < 0.3 THEN 'truncated' ELSE 'ok' END AS status FROM g) SELECT field, count(*) AS n, count_if(status = 'EMPTY') AS n_empty, count_if(status = 'truncated') AS n_truncated, count_if(status = 'pending') AS n_pending, round(median(ratio) FILTER (WHERE status <> 'EMPTY'), 6) AS median_ratio, round(min(ratio) FILTER (WHERE status <> 'EMPTY'), 6) AS min_ratio FROM x GROUP BY field")
def gate_totals(spark, sf_dir):
    s, t = _sides(spark, sf_dir)
    out = parallel.gate_totals(parallel.gate(s, t, ["body", "head"]))
    return out.withColumns({c: F.round(c, 6) for c in ("median_ratio", "min_ratio")})


@query("SELECT count_if(l.doc_id IS NULL) AS missing_in_target, count_if(d.doc_id IS NULL) AS missing_in_source, count_if(l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL) AS in_both FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def id_parity(spark, sf_dir):
    return parallel.id_parity(documents(spark, sf_dir), read(spark, sf_dir, "labels"), "doc_id")


QE = "qe AS (SELECT id, field, src, mt, CAST(least(length(src), length(mt)) AS DOUBLE) / greatest(length(src), length(mt), 1) AS qe_score FROM pr WHERE length(trim(src, ' ' || chr(10))) >= 1 AND regexp_matches(mt, '\\S'))"


def _scored(spark, sf_dir, arrow=False):
    s, t = _sides(spark, sf_dir)
    p = parallel.quality_pairs(s, t, ["head", "body", "head"])
    if arrow:
        return model.scored(p, model.stub_scorer)
    a, b = F.length("src"), F.length("mt")
    return p.withColumn("qe_score", F.least(a, b).cast("double") / F.greatest(a, b, F.lit(1)))


@query(f"WITH {SIDES}, {QE} SELECT field, count(*) AS n, round(avg(qe_score), 6) AS mean, round(median(qe_score), 6) AS median, round(min(qe_score), 6) AS min, round(max(qe_score), 6) AS max, round(coalesce(stddev_samp(qe_score), 0), 6) AS stdev FROM qe GROUP BY GROUPING SETS ((field), ())")
def qe_summary(spark, sf_dir):
    out = parallel.quality_summary(_scored(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "median", "min", "max", "stdev")})


@query(f"WITH {SIDES}, {QE} SELECT id, field, round(qe_score, 9) AS qe_score, left(src, 200) AS src, left(mt, 200) AS mt FROM qe ORDER BY qe_score, id, field LIMIT 20")
def worst_k(spark, sf_dir):
    return parallel.worst(_scored(spark, sf_dir)).withColumn("qe_score", F.round("qe_score", 9))


@query(f"WITH {SIDES}, {QE} SELECT id, field, round(qe_score, 9) AS qe_score FROM qe")
def model_scores(spark, sf_dir):
    return _scored(spark, sf_dir, arrow=True).select("id", "field", F.round("qe_score", 9).alias("qe_score"))


@query("SELECT lang, CAST(count(*) AS BIGINT) AS n_before, count_if(r = 1) AS n_after FROM (SELECT lang, row_number() OVER (PARTITION BY lang, source, left(text, 20) ORDER BY length(text) DESC, doc_id) AS r FROM documents) GROUP BY lang")
def freq_before_after(spark, sf_dir):
    d = documents(spark, sf_dir).withColumn("head", F.left("text", F.lit(20)))
    return audit.before_after(d, curate.keep_longest(d, ["lang", "source", "head"], F.length("text"), ["doc_id"]), "lang")


@query(rf"""WITH {_chunks_sql("SELECT conv_id || '_' || turn AS id, unnest(['role', 'text']) AS field, unnest([role, text]) AS text FROM conversations", 400)},
m AS (SELECT id, field, para, piece, array_to_string(list_transform(string_split(text, ' '), lambda x: reverse(x)), ' ') AS text FROM chunks),
mp AS (SELECT id, field, para, string_agg(text, ' ' ORDER BY piece) AS text FROM m GROUP BY id, field, para), mt AS (SELECT id, field, string_agg(text, chr(10) || chr(10) ORDER BY para) AS text FROM mp GROUP BY id, field)
SELECT c.conv_id || '_' || c.turn AS id, coalesce(r.text, c.role) AS role, coalesce(t.text, c.text) AS text FROM conversations c LEFT JOIN mt r ON r.id = c.conv_id || '_' || c.turn AND r.field = 'role' LEFT JOIN mt t ON t.id = c.conv_id || '_' || c.turn AND t.field = 'text'""")
def model_stub_map(spark, sf_dir):
    """Flatten, chunk, run the stub, put together, scatter."""
    c = read(spark, sf_dir, "conversations").select(F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "role", "text")
    return model.translated(c, ["role", "text"], model.stub_translator)


@query(r"""WITH c AS (SELECT conv_id, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t, role = 'user' AND coalesce(lead(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'assistant', false) AS item FROM conversations),
d AS (SELECT *, sum((role = 'system' OR item)::INT) OVER w AS part, last_value(CASE WHEN role = 'system' THEN t END IGNORE NULLS) OVER w AS topic FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)),
e AS (SELECT *, max((role = 'assistant')::INT) OVER (PARTITION BY conv_id, part ORDER BY turn ROWS UNBOUNDED PRECEDING) = 1 AS answered FROM d),
r AS (SELECT conv_id, part, max(topic) AS topic, max(CASE WHEN item THEN 'a) ' || t END) AS question, string_agg(CASE WHEN role = 'assistant' THEN t END, ' ' ORDER BY turn) AS said,
string_agg(CASE WHEN role = 'assistant' THEN 'None' WHEN role = 'user' AND NOT item AND answered THEN 'a) ' || t END, ' ' ORDER BY turn) AS considerations FROM e GROUP BY conv_id, part HAVING count_if(role = 'assistant') > 0),
u AS (SELECT *, CASE WHEN regexp_matches(said, '\p{L}') THEN regexp_extract(said, '(?s)^(\P{L}*)(\p{L})(.*)$', 1) || upper(regexp_extract(said, '(?s)^(\P{L}*)(\p{L})(.*)$', 2)) || regexp_extract(said, '(?s)^(\P{L}*)(\p{L})(.*)$', 3) ELSE said END AS said_ FROM r)
SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(part AS BIGINT) AS row_no, CAST(conv_id AS VARCHAR) AS guidebook, coalesce(topic, '') AS topic, '' AS subtopic, coalesce(question, '') AS question, '' AS focus, said_ AS judgement, said_ AS evidence, considerations FROM u""")
def segment_guides(spark, sf_dir):
    """Conversations as guides: system turns are topics, user turns lettered questions, assistant turns answers."""
    return segment.segmented(_guides(spark, sf_dir), G)


SQL["segment_sections"] = SQL["segment_guides"]


@query()
def segment_sections(spark, sf_dir):
    """The same guides, cut at their topics, with values carried over blocks of lines: no task holds a document."""
    return segment.segmented_in_sections(_guides(spark, sf_dir), G)


def _guides(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.regexp_replace("text", r"\s+", " ").alias("text"))
    r, t = F.col("role"), F.col("text")
    made = F.when(r == "system", F.array(F.concat(F.lit("Topic 1 "), t), t, F.lit("Context"))).when(r == "user", F.array(F.concat(F.lit("a) "), t))).otherwise(F.array(F.concat(F.lit("Verdict: "), t), F.concat(F.lit("Evidence 1: "), t), F.lit("Considerations: None")))
    d = c.select(F.col("conv_id").cast("string").alias("doc_id"), "turn", F.posexplode(made).alias("p", "raw"))
    return d.select("doc_id", (F.col("turn") * 4 + F.col("p")).alias("line_no"), "raw")


@query("SELECT id, split, lang FROM (SELECT 'd_' || doc_id AS id, CASE doc_id % 3 WHEN 0 THEN 'test' ELSE 'train' END AS split, lang FROM documents)")
def column_insert(spark, sf_dir):
    d = documents(spark, sf_dir).select("doc_id", "lang")
    d = inserted(d, "id", F.concat(F.lit("d_"), F.col("doc_id").cast("string")), 0)
    return inserted(d, "split", F.when(F.col("doc_id") % 3 == 0, "test").otherwise("train"), 1).drop("doc_id")


@query("SELECT 'all' AS section, 'num_records' AS key, count(*) AS value FROM documents UNION ALL SELECT 'splits', CASE doc_id % 3 WHEN 0 THEN 'test' ELSE 'train' END, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'topics', source, count(*) FROM documents GROUP BY 2")
def publish_summary(spark, sf_dir):
    d = documents(spark, sf_dir)
    return publish.summary(d.select(F.when(F.col("doc_id") % 3 == 0, "test").otherwise("train").alias("split"), F.col("source").alias("topic")))


@query("SELECT text AS id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return audit.duplicate_ids(documents(spark, sf_dir).select(F.col("text").alias("id")))


@query("SELECT lang, n, round(100.0 * nonblank / n, 6) AS nonblank FROM (SELECT lang, count(*) AS n, count_if(regexp_matches(text, '\\S')) AS nonblank FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, left(text, 20) ORDER BY length(text) DESC, doc_id) AS r FROM (SELECT doc_id, lang, source, trim(regexp_replace(regexp_replace(text, '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS text FROM documents)) WHERE r = 1 GROUP BY lang)")
def flagship(spark, sf_dir):
    """Fields cleaned, the longest of each near-equal key kept, completeness by language."""
    d = documents(spark, sf_dir).select("doc_id", "lang", "source", T.clean_field(F.col("text")).alias("text")).withColumn("head", F.left("text", F.lit(20)))
    kept = curate.keep_longest(d, ["lang", "source", "head"], F.length("text"), ["doc_id"])
    return kept.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg(T.is_nonblank(F.col("text")).cast("double")) * 100, 6).alias("nonblank"))


# what the queries above leave out: sinks and readers, by a round trip through the shared folder, and smaller functions


@query("SELECT form, doc_id, lang, text FROM documents, (VALUES ('csv'), ('jsonl'), ('orc'), ('parquet')) AS f(form)")
def table_formats(spark, sf_dir):
    """Written and read again in each form: line feeds, quotes, commas and NUL in cells survive, and empty texts stay apart from null."""
    d = documents(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text")
    out = None
    for form, write in (("csv", tables.write_csv), ("jsonl", tables.write_jsonl), ("orc", lambda x, p: x.write.orc(p)), ("parquet", lambda x, p: x.write.parquet(p))):
        path = f"{new_path(spark, 'forms')}.{form}"
        write(d, path)
        back = tables.read_table(spark, path, d.schema, quoted_empty=True).select(F.lit(form).alias("form"), F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
        out = back if out is None else out.unionByName(back)
    return out


NATIONS = "n_nationkey int, n_regionkey int, n_name string"


def _nation_file(spark, sf_dir):
    """The 25 nations as one JSON Lines file, in order: a table of one size at every scale."""
    path = new_path(spark, "nations") + ".jsonl"
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("n_nationkey"), F.col("n_regionkey").cast("int").alias("n_regionkey"), "n_name")
    tables.write_jsonl(n.coalesce(1).sortWithinPartitions("n_nationkey"), path, one_file=True)
    return path


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS INTEGER) AS line_no, CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name FROM nation")
def jsonl_line_numbers(spark, sf_dir):
    from pyspark.sql.types import StructType

    return tables.read_jsonl(spark, _nation_file(spark, sf_dir), StructType.fromDDL(NATIONS)).select("line_no", "n_nationkey", "n_name")


@query("SELECT CAST(n_regionkey AS INTEGER) AS n_regionkey, CAST(min(line_no) AS INTEGER) AS line_no, max_by(n_name, line_no) AS n_name FROM (SELECT *, row_number() OVER (ORDER BY n_nationkey) AS line_no FROM nation) GROUP BY 1")
def jsonl_last_wins(spark, sf_dir):
    from pyspark.sql.types import StructType

    records = tables.read_jsonl(spark, _nation_file(spark, sf_dir), StructType.fromDDL(NATIONS))
    return tables.last_by_id(records, "n_regionkey").select("n_regionkey", "line_no", "n_name")


@query("SELECT CAST(2 * row_number() OVER (ORDER BY n_nationkey) - 2 AS BIGINT) AS line_no, n_name AS raw FROM nation")
def text_line_scan(spark, sf_dir):
    """A file of lines, each followed by a blank one that is counted and left out."""
    path = new_path(spark, "text")
    read(spark, sf_dir, "nation").coalesce(1).sortWithinPartitions("n_nationkey").select(F.concat("n_name", F.lit("\n")).alias("value")).write.text(path)
    return tables.read_lines(spark, path).select(F.col("line_no").cast("long").alias("line_no"), "raw")


@query("SELECT doc_id, lang, 'staged' AS kind FROM documents UNION ALL SELECT doc_id, lang, 'curated' FROM documents")
def stage_tables(spark, sf_dir):
    """A stage table is replaced, a curated copy is not; a missing path is skipped."""
    d = documents(spark, sf_dir).select("doc_id", "lang")
    other = d.withColumn("lang", F.lit("?"))
    staged, curated = new_path(spark, "staged"), new_path(spark, "curated") + ".parquet"
    tables.stage(other, staged)
    tables.copy_if_absent(d, curated)
    tables.copy_if_absent(other, curated)
    with redirect_stdout(io.StringIO()):
        found = [x for x in (tables.read_or_none(spark, p) for p in (curated, f"{curated}.missing.parquet")) if x is not None]
    parts = [tables.stage(d, staged).withColumn("kind", F.lit("staged")), *[x.withColumn("kind", F.lit("curated")) for x in found]]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("SELECT 'all' AS section, 'num_records' AS key, count(*) AS value FROM documents UNION ALL SELECT 'splits', CASE doc_id % 3 WHEN 0 THEN 'test' ELSE 'train' END, count(*) FROM documents GROUP BY 2 UNION ALL SELECT 'topics', source, count(*) FROM documents GROUP BY 2")
def summary_sink(spark, sf_dir):
    """The published summary, read back from its JSON."""
    path = new_path(spark, "summary") + ".json"
    with redirect_stdout(io.StringIO()):
        tables.write_summary(publish_summary(spark, sf_dir), path)
    kind = "map<string, long>"
    said = tables.read_table(spark, path, f"`all` {kind}, splits {kind}, topics {kind}")
    return said.unpivot([], ["all", "splits", "topics"], "section", "m").select("section", F.explode("m").alias("key", "value"))


@query("SELECT doc_id, lang, CASE doc_id % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'dev' ELSE 'train' END AS split FROM documents")
def split_outputs(spark, sf_dir):
    """An output for each split, and all of them read back."""
    path = new_path(spark, "splits")
    tables.write_splits(split_union_tag(spark, sf_dir), path)
    return spark.read.schema("doc_id long, lang string, split string").json(path)


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def frequency_table(spark, sf_dir):
    return audit.frequencies(documents(spark, sf_dir), "source")


@query("SELECT doc_id, row_number() OVER (PARTITION BY source ORDER BY CASE split WHEN 'test' THEN 0 WHEN 'dev' THEN 1 WHEN 'train' THEN 2 ELSE 3 END, doc_id) AS place FROM (SELECT doc_id, source, CASE doc_id % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'test' WHEN 2 THEN 'dev' ELSE 'other' END AS split FROM documents)")
def priority_order(spark, sf_dir):
    k = F.col("doc_id") % 4
    d = documents(spark, sf_dir).select("doc_id", "source", F.when(k == 0, "train").when(k == 1, "test").when(k == 2, "dev").otherwise("other").alias("split"))
    return d.select("doc_id", F.row_number().over(Window.partitionBy("source").orderBy(curate.priority(), "doc_id")).cast("long").alias("place"))


@query(rf"""WITH {LINES}, bent AS (SELECT doc_id, line_no, CASE line_no % 5 WHEN 1 THEN ' garden HANDBOOK' WHEN 2 THEN '12 Annual edition ' WHEN 3 THEN 'Garden handbook 7' WHEN 4 THEN 'Garden handbook: ' || raw ELSE raw END AS raw FROM lines WHERE regexp_matches(raw, '\S'))
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, line_no % 5 IN (1, 2, 3) AS furniture, CASE WHEN line_no % 5 IN (1, 2, 3) THEN '' ELSE trim(regexp_replace(raw, '^[ •▪\-–*]+', '')) END AS text FROM bent""")
def page_furniture(spark, sf_dir):
    k, raw = F.col("line_no") % 5, F.col("raw")
    bent = F.when(k == 1, " garden HANDBOOK").when(k == 2, "12 Annual edition ").when(k == 3, "Garden handbook 7").when(k == 4, F.concat(F.lit("Garden handbook: "), raw)).otherwise(raw)
    return lines(spark, sf_dir).select("doc_id", F.col("line_no").cast("long").alias("line_no"), T.is_furniture(T.strip(bent), G).alias("furniture"), T.clean_line(bent, G).alias("text"))


@query(r"SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN regexp_extract(regexp_extract(c, '(?is)^(.*?)\bquestion\b', 1), '(?s)^(.*[.?!]) ', 1) ELSE c END AS text FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN replace(text, 'uestion', 'u') || '. So this Question is divided into parts.' ELSE replace(text, 'uestion', 'u') END AS c FROM documents)")
def narration_cut(spark, sf_dir):
    text = F.replace("text", F.lit("uestion"), F.lit("u"))
    c = F.when(F.col("doc_id") % 2 == 0, F.concat(text, F.lit(". So this Question is divided into parts."))).otherwise(text)
    return documents(spark, sf_dir).select("doc_id", T.cut_narration(c, Grammar(narration=r"question is divided into")).alias("text"))


@query(r"SELECT doc_id, CAST(doc_id % 3 = 0 AS INTEGER) AS has, CASE WHEN doc_id % 3 = 0 THEN ltrim(text, ' ' || chr(10) || chr(9) || chr(13)) END AS text FROM documents")
def marker_split(spark, sf_dir):
    c = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Before. VERDICT: "), "text")).otherwise(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", c.rlike(f"(?iu){G.judgement}").cast("int").alias("has"), T.after_marker(c, G.judgement).alias("text"))


@query(r"SELECT doc_id, replace(t, ', ', ' DNA, ') AS text, CAST(2 * ((length(t) - length(replace(t, ', ', ''))) / 2) AS BIGINT) AS n FROM (SELECT doc_id, regexp_replace(text, '[0-9]', '', 'g') AS t FROM documents)")
def footnote_acronyms(spark, sf_dir):
    """Numbers glued to an acronym, put into texts whose own digits are taken out."""
    c = F.replace(F.regexp_replace("text", "[0-9]", ""), F.lit(", "), F.lit(" DNA4,12, "))
    return documents(spark, sf_dir).select("doc_id", T.strip_footnotes(c, G).alias("text"), T.footnote_count(c, G).alias("n"))


@query("SELECT lang, format('{:,.2f}%', 100.0 * count(quality) / count(*)) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def percent_text(spark, sf_dir):
    return _labelled(spark, sf_dir).groupBy("lang").agg(T.percent(F.count("quality") * 100.0 / F.count("*")).alias("labelled"))


@query(r"SELECT doc_id AS id, field, t AS text FROM (SELECT doc_id, unnest(['text', 'lang', 'options.A', 'options.B', 'options.C']) AS field, unnest([text, lang, source, 'NaN', CASE WHEN doc_id % 2 = 0 THEN lang ELSE ' ' END]) AS t FROM documents) WHERE field <> 'options.B' AND regexp_matches(t, '\S')")
def flatten_options(spark, sf_dir):
    return model.flattened(_with_options(spark, sf_dir), ["text", "lang"], "options")


def _with_options(spark, sf_dir):
    c = F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(" ")
    options = F.create_map(F.lit("A"), "source", F.lit("B"), F.lit("NaN"), F.lit("C"), c)
    return documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text", "lang", options.alias("options"))


@query("SELECT doc_id AS id, lang || '!' AS lang, source || '!' AS a, 'NaN' AS b, CASE WHEN doc_id % 2 = 0 THEN lang || '!' ELSE ' ' END AS c FROM documents")
def scatter_options(spark, sf_dir):
    """Texts that were flattened, marked and put back; what wasn't flattened stays."""
    r = _with_options(spark, sf_dir).drop("text")
    texts = model.flattened(r, ["lang"], "options").withColumn("text", F.concat("text", F.lit("!")))
    out, o = model.scattered(r, texts, ["lang"], "options"), F.col("options")
    return out.select("id", "lang", o["A"].alias("a"), o["B"].alias("b"), o["C"].alias("c"))


SENTENCES = r"list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '\S'))"


@query(f"SELECT doc_id, CAST(generate_subscripts(s, 1) - 1 AS BIGINT) AS n, unnest(s) AS sentence FROM (SELECT doc_id, CASE WHEN len({SENTENCES}) > 0 THEN {SENTENCES} ELSE [text] END AS s FROM documents)")
def sentence_split(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.posexplode(chunk.sentences(F.col("text"))).alias("n", "sentence")).withColumn("n", F.col("n").cast("long"))


@query(r"SELECT doc_id, length(text) <= 1800 AND len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) <= 200 AS fits FROM documents")
def budget_test(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", chunk.fits(F.col("text"), 200).alias("fits"))


@query(f"WITH {SIDES}, x AS (SELECT id, field, ratio, CASE WHEN trim(mt, ' ' || chr(10)) = '' THEN 'EMPTY' WHEN ratio < 0.3 THEN 'truncated' ELSE 'ok' END AS status FROM g) SELECT id, field, round(ratio, 6) AS ratio, status FROM x WHERE status <> 'ok' ORDER BY id, field LIMIT 20")
def gate_failures(spark, sf_dir):
    """The first twenty failures, as the gate reports them."""
    s, t = _sides(spark, sf_dir)
    return parallel.failures(parallel.gate(s, t, ["body", "head"])).withColumn("ratio", F.round("ratio", 6))


@query(rf"""WITH {BROKEN}, full_ AS (SELECT * FROM lines WHERE regexp_matches(raw, '\S')),
c AS (SELECT doc_id, regexp_extract(regexp_replace(raw, '\s+$', ''), '(\p{{L}}+)-$', 1) AS head, regexp_extract(lead(raw) OVER (PARTITION BY doc_id ORDER BY line_no), '^\s*(\p{{L}}+)', 1) AS tail FROM full_),
j AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(raw, '\p{{L}}+'))) AS w FROM full_),
p AS (SELECT DISTINCT doc_id, lower(regexp_extract(r, '^(\p{{L}}+-\p{{L}}+)', 1)) AS w FROM (SELECT doc_id, unnest(regexp_extract_all(raw, '[\p{{L}}-]+')) AS r FROM full_) WHERE regexp_matches(r, '^\p{{L}}+-\p{{L}}+')),
v AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '\p{{L}}+'))) AS w FROM benchmark)
SELECT c.doc_id, count(*) AS n, count_if(CASE WHEN j.w IS NOT NULL AND p.w IS NULL THEN true WHEN j.w IS NULL AND p.w IS NOT NULL THEN false ELSE v.w IS NOT NULL END) AS n_merged
FROM c LEFT JOIN j ON c.doc_id = j.doc_id AND lower(head || tail) = j.w LEFT JOIN p ON c.doc_id = p.doc_id AND lower(head || '-' || tail) = p.w LEFT JOIN v ON lower(head || tail) = v.w
WHERE length(head) BETWEEN 2 AND 20 AND length(tail) BETWEEN 2 AND 20 GROUP BY c.doc_id""")
def merge_counts(spark, sf_dir):
    """Broken words by document, and those that are merged, where the words of benchmark are the fallback vocabulary."""
    words = read(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return hyphen.merge_counts(hyphen.decided(_broken(spark, sf_dir), vocabulary=words))


PHASES = "ph AS (SELECT 'before' AS phase, text, source FROM documents UNION ALL SELECT 'after', text, source FROM documents WHERE doc_id % 4 <> 0)"


@query(rf"""WITH {PHASES}, x AS (SELECT phase, source, regexp_matches(text, '\S') AS full_, {COUNTS} FROM ph), a AS (SELECT phase, CAST(count(*) AS DOUBLE) AS n, CAST(count_if(NOT full_) AS DOUBLE) AS bad, CAST(sum(sentences) AS DOUBLE) AS s, CAST(sum(words) AS DOUBLE) AS w, 100.0 * count(source) / count(*) AS p, 100.0 * count_if(full_) / count(*) AS f FROM x GROUP BY phase)
SELECT phase, unnest(['rows', 'incomplete', 'sentences', 'words', 'present source', 'nonblank text']) AS key, round(unnest([n, bad, s, w, p, f]), 6) AS value FROM a""")
def phase_report(spark, sf_dir):
    d = documents(spark, sf_dir)
    out = audit.phase_report(d, d.filter(F.col("doc_id") % 4 != 0), ["text"], ["source"], ["text"])
    return out.withColumn("value", F.round("value", 6))


@query("""SELECT p_partkey, p_brand AS short_answer, '- Topic: ' || p_name || chr(10) || '- Question: ' || p_type AS query, 'ecnedivE: ' || p_brand || chr(10) || 'snoitaredisnoC: ' || p_size AS justification FROM part WHERE p_size % 2 = 0
UNION ALL SELECT p_partkey, 'old', 'old', 'old' FROM part WHERE p_size % 2 <> 0""")
def composites_rebuilt(spark, sf_dir):
    """Composites made anew from translated parts, under translated labels; records without a guidebook keep theirs."""
    p = read(spark, sf_dir, "part")
    old = {c: F.lit("old") for c in ("short_answer", "query", "justification")}
    r = p.select("p_partkey", F.when(F.col("p_size") % 2 == 0, "guide").alias("guidebook"), F.col("p_name").alias("topic"), F.lit(" ").alias("subtopic"), F.col("p_type").alias("question"), F.lit("").alias("focus"), F.col("p_brand").alias("judgement"), F.col("p_brand").alias("evidence"), F.col("p_size").cast("string").alias("considerations")).withColumns(old)
    labels = model.translated_labels(G.justification_labels, model.stub_translator)
    return model.rebuilt_composites(r, G, "en", labels=labels).select("p_partkey", *old)


COLONS = "SELECT doc_id AS id, $$text$$ AS field, replace(replace(text, chr(10), chr(10) || chr(10)), ', ', ': ') AS text FROM documents"


@query(f"WITH {_chunks_sql(COLONS, 60)} SELECT id, field, CAST(para AS BIGINT) AS para, CAST(piece AS BIGINT) AS piece, text FROM chunks")
def plan_by_counter(spark, sf_dir):
    """Chunks by the lengths that a counter in the workers gives, as a tokenizer would; colons stand where the texts have commas, so sentences are cut as tables."""
    texts = _texts(spark, sf_dir).withColumn("text", F.replace("text", F.lit(", "), F.lit(": ")))
    out = budget.planned(texts, budget.white_space_counter, 60)
    return out.select("id", "field", F.col("para").cast("long").alias("para"), F.col("piece").cast("long").alias("piece"), "text")


@query("SELECT doc_id, CASE WHEN contains(text, 'the') THEN NULL ELSE array_to_string(list_transform(string_split(text, ' '), lambda x: reverse(x)), ' ') END AS said, CASE WHEN contains(text, 'the') THEN 'ValueError: a text with the' END AS error FROM documents")
def model_quarantine(spark, sf_dir):
    """A stub that fails on batches with some texts: those go to the table of failures, alone, and their batch mates don't."""
    got = serve.served(documents(spark, sf_dir).select("doc_id", "text"), serve.failing_stub, out="said")
    none = F.lit(None).cast("string")
    return got.done.select("doc_id", "said", none.alias("error")).unionByName(got.failed.select("doc_id", none.alias("said"), "error"))


@query(r"""WITH a AS (SELECT * FROM documents), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY lang, source, left(text, 20) ORDER BY length(text) DESC, doc_id) = 1), c AS (SELECT * FROM b WHERE NOT regexp_matches(text, '^[Tt]he'))
SELECT CAST(ord AS INTEGER) AS ord, section, key, CAST(value AS DOUBLE) AS value FROM (SELECT 0 AS ord, 'read' AS section, 'rows' AS key, count(*) AS value FROM a UNION ALL SELECT 1, 'read', 'characters', sum(length(text)) FROM a
UNION ALL SELECT 2, 'dedup', 'rows', count(*) FROM b UNION ALL SELECT 3, 'dedup', 'characters', sum(length(text)) FROM b UNION ALL SELECT 4, 'dedup', 'removed', (SELECT count(*) FROM a) - count(*) FROM b
UNION ALL SELECT 5, 'filter', 'rows', count(*) FROM c UNION ALL SELECT 6, 'filter', 'without source', count_if(source IS NULL) FROM c UNION ALL SELECT 7, 'filter', 'removed', (SELECT count(*) FROM b) - count(*) FROM c)""")
def run_report(spark, sf_dir):
    """Three stages and their counters, observed as the stages are written: nothing is scanned for the report."""
    root, run = new_path(spark, "run"), audit.Run()
    at = lambda name: StageTable(spark, f"{root}/{name}")
    size = F.sum(F.length("text"))
    a = run.stage("read", documents(spark, sf_dir), at("read"), characters=size)
    b = run.stage("dedup", curate.keep_longest(a.withColumn("head", F.left("text", F.lit(20))), ["lang", "source", "head"], F.length("text"), ["doc_id"]).drop("head"), at("dedup"), characters=size)
    run.stage("filter", b.filter(~F.col("text").rlike("^[Tt]he")), at("filter"), **{"without source": F.count_if(F.col("source").isNull())})
    return run.report(spark)


@query("SELECT doc_id, lang, version FROM (SELECT doc_id, lang FROM documents), (SELECT unnest([1, 3]) AS version) UNION ALL SELECT doc_id, '?', 2 FROM documents WHERE doc_id % 2 = 0")
def stage_versions(spark, sf_dir):
    """Three versions of a stage table: the rows, others in their place, and the first ones again; each is read as it was."""
    d = documents(spark, sf_dir).select("doc_id", "lang")
    t = StageTable(spark, new_path(spark, "versions"))
    t.write(d)
    t.write(d.filter("doc_id % 2 = 0").withColumn("lang", F.lit("?")))
    t.restore(1)
    parts = [t.read(v).withColumn("version", F.lit(v)) for v in t.versions()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


PARTS_OF = Grammar(boundaries=tuple((str(k), "Closing") for k in range(10)))


@query(r"""WITH c AS (SELECT conv_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k, conv_id BETWEEN 0 AND 9 AS ends FROM conversations WHERE role = 'assistant' AND text IS NOT NULL),
r AS (SELECT conv_id, k * CASE WHEN ends THEN 5 ELSE 4 END + 3 AS row_no, t, 'part ' || t AS focus, t AS evidence_, false AS labelled FROM c
UNION ALL SELECT conv_id, k * CASE WHEN ends THEN 5 ELSE 4 END + 4, t, '1. In sand of the dunes', CASE WHEN ends THEN t ELSE t || ' and more' END, true FROM c),
u AS (SELECT *, CASE WHEN regexp_matches(t, '\p{L}') THEN regexp_extract(t, '(?s)^(\P{L}*)(\p{L})(.*)$', 1) || upper(regexp_extract(t, '(?s)^(\P{L}*)(\p{L})(.*)$', 2)) || regexp_extract(t, '(?s)^(\P{L}*)(\p{L})(.*)$', 3) ELSE t END AS judged,
regexp_extract(evidence_, '(?s)^(\P{L}*)(\p{L})(.*)$', 1) || upper(regexp_extract(evidence_, '(?s)^(\P{L}*)(\p{L})(.*)$', 2)) || regexp_extract(evidence_, '(?s)^(\P{L}*)(\p{L})(.*)$', 3) AS shown FROM r)
SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(row_no AS BIGINT) AS row_no, trim('x ' || t) AS topic, '' AS subtopic, 'a) why? and how' AS question, trim(focus) AS focus, judged AS judgement, CASE WHEN NOT labelled THEN '' WHEN regexp_matches(evidence_, '\p{L}') THEN shown ELSE evidence_ END AS evidence FROM u""")
def segment_parts(spark, sf_dir):
    """Answers as guides with all that a guide can have: an umbrella, a sub-question, a wrapped label that takes the verdict before it, and a section that ends where a registered line begins."""
    c = read(spark, sf_dir, "conversations").filter((F.col("role") == "assistant") & F.col("text").isNotNull())
    t = F.regexp_replace("text", r"\s+", " ")
    said = ["Umbrella 1 of all", ("x ", t), "Preview ends", "Sub-question 1", ("part ", t), "Context", "a) why?", "and how", ("Verdict: ", t), "1. In sand", "of the dunes", ("Evidence 1: ", t), "Closing remarks", "and more"]
    # the registered line ends an answer only in the documents that it is registered for; elsewhere it isn't there
    lines_ = [F.lit(x) if isinstance(x, str) else F.concat(F.lit(x[0]), x[1]) for x in said]
    made = F.filter(F.array(*lines_), lambda x: (x != "Closing remarks") | F.col("conv_id").between(0, 9))
    d = c.select(F.col("conv_id").cast("string").alias("doc_id"), "turn", F.posexplode(made).alias("p", "raw"))
    out = segment.segmented(d.select("doc_id", (F.col("turn") * 20 + F.col("p")).alias("line_no"), "raw"), PARTS_OF)
    return out.select("doc_id", "row_no", "topic", "subtopic", "question", "focus", "judgement", "evidence")


@query(f"WITH {_quota('documents', 125, 't')}, rest AS (SELECT * EXCLUDE (drawn) FROM t WHERE NOT drawn), {_quota('rest', 63, 'v')} SELECT split, CAST(count(*) AS BIGINT) AS n, split <> 'train' AS asserted FROM (SELECT 'test' AS split FROM t WHERE drawn UNION ALL SELECT CASE WHEN drawn THEN 'dev' ELSE 'train' END FROM v) GROUP BY split")
def split_sizes(spark, sf_dir):
    """The sizes of the splits, which have been asserted to be what was asked for."""
    out = splits.split(documents(spark, sf_dir).select("doc_id", "source"), "source", "doc_id", 125, 63)
    splits.check_sizes(out, test=125, dev=63)
    return out.groupBy("split").agg(F.count("*").alias("n")).withColumn("asserted", F.col("split") != "train")


SHAPES = Grammar(pairs=("Lime and ash",))
#: What is put before the lines in turn; what ends with a bar stands for the whole line.
BEFORE = ("", "a) ", "Topic 1 ", "Sub-question 2 ", "Umbrella 3 ", "Preview ends ", "List of questions", "Intervention ", "4. ", "Context|", "context|", "Lime and ash|", "Contexts|", "A) ")
_SHAPED = "CASE WHEN contains(b, '|') THEN replace(b, '|', '') ELSE b || raw END"


@query(rf"""WITH {LINES}, s AS (SELECT doc_id, line_no, {_SHAPED} AS t FROM (SELECT *, [{", ".join(f"'{x}'" for x in BEFORE)}][line_no % {len(BEFORE)} + 1] AS b FROM lines WHERE regexp_matches(raw, '\S')))
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, regexp_matches(t, '^[a-z]\)\s') AS lettered, t = 'Context' AS context, regexp_matches(t, '^Topic\s+\d+') AS topic, regexp_matches(t, '^Sub-question\s+\d+') AS sub, regexp_matches(t, '^Umbrella\s+\d+') AS umbrella,
regexp_matches(t, '^(Preview ends|List of questions)([^\p{{L}}\p{{N}}_]|$)') AS preview, regexp_matches(t, '^Intervention([^\p{{L}}\p{{N}}_]|$)') OR t = 'Lime and ash' AS heading, regexp_matches(t, '^\d+\.\s') AS label, regexp_matches(t, '^\p{{Ll}}') AS lower_case FROM s""")
def line_shapes(spark, sf_dir):
    """The structural tests of lines, each planted on whole lines and before others."""
    d = lines(spark, sf_dir)
    b = F.element_at(F.array(*map(F.lit, BEFORE)), (F.col("line_no") % len(BEFORE) + 1).cast("int"))
    text = F.when(F.contains(b, F.lit("|")), F.replace(b, F.lit("|"), F.lit(""))).otherwise(F.concat(b, F.col("raw")))
    out = segment.looked_at(d.select("doc_id", "line_no", text.alias("text"), F.lit(False).alias("bullet")), SHAPES)
    names = {"lettered": "lettered", "cx": "context", "ts": "topic", "ss": "sub", "us": "umbrella", "ue": "preview", "heading": "heading", "lab": "label", "low": "lower_case"}
    return out.select("doc_id", F.col("line_no").cast("long").alias("line_no"), *(F.col(k).alias(v) for k, v in names.items()))
