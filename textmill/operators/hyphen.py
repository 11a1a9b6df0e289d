"""Words broken over lines, repaired by what else the same document has.

A line that ends with letters and a hyphen, and the next line that is not blank or page furniture and starts with letters, make a candidate
(both parts of LEAST to MOST letters). Its evidence is whether the joined word, or the hyphenated one, stands elsewhere in
the document; where that doesn't decide, a vocabulary may say that the joined word is one. Candidates are decided on the
lines as they were, so in a chain of broken lines each break is decided alone, from the left.

Lines cross one shuffle, by document. Behind it blocks of at most BLOCK lines are rows, with their candidates and the set of their words: a document of one
block has its evidence in its row, with no row for each word. Words of longer documents are made distinct and joined on (document, word),
so no row or task holds such a document, and nothing scans a text for each candidate. The blocks are written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.patterns import Grammar
from textmill.functions.text import WHITE, clean_line, is_furniture, strip
from textmill.session import small, written

LEAST, MOST = 2, 20
#: Lines of a block.
BLOCK = 2048
MARKS = r"[.,;:!?)\]»”\"]*"


def is_text(raw: Column, g: Grammar | None = None) -> Column:
    """Whether a line is neither blank nor page furniture: clean_line() leaves something of it. What begins with a letter or a digit and has no
    control bytes is left as it is, so the patterns for the others aren't tried on it."""
    plain = F.lit(True) if g is None else ~is_furniture(strip(raw), g)
    return F.when(raw.rlike(r"(?U)^\s*+[\p{L}\p{N}][^\x07\x1f]*+$"), plain).otherwise((clean_line(raw, g) != "") & raw.rlike(r"(?U)\S"))


def words_of(text: Column) -> Column:
    """The distinct maximal runs of letters of lines that can be a joined word, and their hyphenated pairs, in lower case."""
    runs = F.filter(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))), lambda w: F.length(w).between(2 * LEAST, 2 * MOST))
    pairs = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<![\p{L}-])(\p{L}++-\p{L}++)"), F.lit(1)))
    return F.transform(F.concat(runs, pairs), F.lower)


def _word(where: Column, head: Column, tail: Column, marks: Column, next_no: Column) -> Column:
    """A broken word, with its joined and hyphenated forms, or null."""
    ok = where & F.length(head).between(LEAST, MOST) & F.length(tail).between(LEAST, MOST)
    return F.when(ok, F.struct(next_no.alias("next_no"), head.alias("head"), tail.alias("tail"), marks.alias("marks"), F.lower(F.concat(head, tail)).alias("joined"), F.lower(F.concat_ws("-", head, tail)).alias("compound")))


def looked_at(lines: DataFrame, g: Grammar | None = None) -> DataFrame:
    """lines with `_take`, the word that is broken behind each line, `_give`, the one that was broken before it, and `_row`, from 0 in each document."""
    c, raw = F.col, F.rtrim("raw", F.lit(WHITE))
    d = lines.repartition("doc_id").withColumn("_full", F.coalesce(is_text(F.col("raw"), g), F.lit(False)))
    d = d.withColumns({
        "_head": F.when(c("_full") & raw.endswith("-"), F.regexp_extract(raw, r"(?<!\p{L})(\p{L}++)-$", 1)),
        "_tail": F.when(c("_full"), F.regexp_extract("raw", r"^\s*(\p{L}+)", 1)),
        "_marks": F.when(c("_full"), F.regexp_extract("raw", rf"^\s*\p{{L}}+({MARKS})", 1)),
    })
    w = Window.partitionBy("doc_id").orderBy(F.desc("_full"), "line_no")  # lines that aren't text come last, and have no part in a word
    d = d.withColumns({"_next": F.lead(F.struct("line_no", "_full", "_tail", "_marks")).over(w), "_before": F.lag("_head").over(w), "_row": F.row_number().over(w) - 1})
    take = _word(c("_full") & c("_next._full"), c("_head"), c("_next._tail"), c("_next._marks"), c("_next.line_no"))
    return d.select(*lines.columns, take.alias("_take"), _word(c("_full"), c("_before"), c("_tail"), c("_marks"), c("line_no")).alias("_give"), "_row")


def evident(d: DataFrame, item: Column, words: list[str]) -> DataFrame:
    """doc_id, _items (what isn't null of item), _hits (words that stand in the document, of those that the items' broken words named need) of the blocks of looked_at()."""
    d = d.select("doc_id", F.floor(F.col("_row") / BLOCK).alias("_block"), item.alias("_item"), "raw")
    blocks = d.groupBy("doc_id", "_block").agg(F.collect_list("_item").alias("_items"), F.array_join(F.collect_list("raw"), "\n").alias("_text"))
    wanted = F.concat(*(F.col(f"_items.{w}.{c}") for w in words for c in ("joined", "compound")))
    many = (F.col("_block") > 0) | F.lead("_block").over(Window.partitionBy("doc_id").orderBy("_block")).isNotNull()
    named = F.col("doc_id").isNotNull()  # lines of no document are no evidence
    none = F.array().cast("array<string>")
    stand = words_of(F.col("_text"))
    blocks = blocks.withColumn("_many", many & named).select(
        "doc_id", "_block", "_many", "_items", F.when(named & ~F.col("_many"), F.array_intersect(stand, wanted)).otherwise(none).alias("_hits"),
        F.when(F.col("_many"), F.filter(F.array_distinct(wanted), F.isnotnull)).otherwise(none).alias("_w"), F.when(F.col("_many"), F.array_distinct(stand)).otherwise(none).alias("_words"))
    blocks = written(blocks, "hyphen-blocks")
    out = blocks.filter(~F.col("_many")).select("doc_id", "_items", "_hits")
    long = blocks.filter("_many")
    if not long.limit(1).count():
        return out
    stands = long.select(F.col("doc_id").alias("_sd"), F.explode("_words").alias("_s")).distinct()
    asked = long.select("doc_id", "_block", F.explode("_w").alias("_word"))
    hits = asked.join(stands, (F.col("doc_id") == F.col("_sd")) & (F.col("_word") == F.col("_s")), "left_semi").groupBy(F.col("doc_id").alias("_hd"), F.col("_block").alias("_hb")).agg(F.collect_list("_word").alias("_found"))
    long = long.join(hits, (F.col("doc_id") == F.col("_hd")) & (F.col("_block") == F.col("_hb")), "left")
    return out.unionByName(long.select("doc_id", "_items", F.coalesce("_found", none).alias("_hits")))


def _known(d: DataFrame, vocabulary: DataFrame | None, words: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """d, and for each of its broken words whether the joined one is in the vocabulary."""
    if vocabulary is None:
        return d, {c: F.lit(False) for c in words}
    v = small(written(vocabulary.select(F.lower("word").alias("_v")).distinct(), "vocabulary"))
    for c in words:
        d = d.join(v.withColumnRenamed("_v", f"{c}_known"), F.col(f"{c}.joined") == F.col(f"{c}_known"), "left")
    return d, {c: F.col(f"{c}_known").isNotNull() for c in words}


def _evidence(word: str, known: Column) -> tuple[Column, Column, Column]:
    """has_joined, has_compound, merge."""
    j, p = (F.array_contains("_hits", F.col(f"{word}.{c}")) for c in ("joined", "compound"))
    return j, p, F.when(j & ~p, True).when(p & ~j, False).otherwise(known)


def decided(lines: DataFrame, g: Grammar | None = None, vocabulary: DataFrame | None = None) -> DataFrame:
    """doc_id, line_no, next_no, head, tail, marks, has_joined, has_compound, merge for each broken word of lines (doc_id, line_no, raw)."""
    d = looked_at(lines.select("doc_id", "line_no", "raw"), g)
    d = evident(d, F.when(F.col("_take").isNotNull(), F.struct("line_no", "_take")), ["_take"]).select("doc_id", "_hits", F.inline("_items"))
    d, known = _known(d, vocabulary, ["_take"])
    j, p, merge = _evidence("_take", known["_take"])
    return d.select("doc_id", "line_no", "_take.next_no", "_take.head", "_take.tail", "_take.marks", j.alias("has_joined"), p.alias("has_compound"), merge.alias("merge"))


def merge_counts(decisions: DataFrame) -> DataFrame:
    """doc_id, n, n_merged: the candidates of decided(), and those that are merged."""
    return decisions.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if("merge").alias("n_merged"))


def merged(lines: DataFrame, g: Grammar | None = None, vocabulary: DataFrame | None = None) -> DataFrame:
    """lines with the second part of each merged word, and marks directly behind it, moved up to the first."""
    words = ["_take", "_give"]
    rest = [c for c in lines.columns if c != "doc_id"]
    slim = lambda c, part: F.when(F.col(c).isNotNull(), F.struct(f"{c}.joined", f"{c}.compound", part(F.concat(f"{c}.tail", f"{c}.marks")).alias("part"))).alias(c)
    item = F.struct(*rest, slim("_take", lambda x: x), slim("_give", F.length))
    d = evident(looked_at(lines, g), item, words).select("doc_id", "_hits", F.inline("_items"))
    d, known = _known(d, vocabulary, words)
    part = lambda c: F.when(F.col("doc_id").isNotNull() & F.col(c).isNotNull() & _evidence(c, known[c])[2], F.col(f"{c}.part"))
    d = d.withColumns({"_taken": part("_take"), "_given": part("_give")})
    lead = F.regexp_extract("raw", r"^\s*", 0)
    body = F.when(F.col("_given").isNotNull(), F.concat(lead, F.regexp_replace(F.substr(F.col("raw"), F.length(lead) + F.col("_given") + 1), r"^\s+", ""))).otherwise(F.col("raw"))
    body = F.when(F.col("_taken").isNotNull(), F.concat(F.regexp_replace(body, r"-\s*$", ""), F.col("_taken"))).otherwise(body)
    return d.withColumn("raw", body).select(*lines.columns)
