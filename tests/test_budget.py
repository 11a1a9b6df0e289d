"""Chunks by measured lengths against the fold, with a real tokenizer, and one text of very many sentences."""

import os
import re

import pytest
from pyspark.sql import functions as F

from textmill.operators import budget, chunk

KEY = ("id", "field")
PATH = "/opt/tokenizers/byte_bpe_50k.json"


def makers():
    """Makers of counters, as closures: what is sent to the workers doesn't need this file."""
    path = PATH

    def words():
        return lambda texts: [len(t.split()) for t in texts]

    def real():
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return lambda texts: [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]

    return words, real


words, real = makers()


def plain(text, count, most=400):
    """The rules of a chunk plan, one text at a time, with a tokenizer as a function."""
    size = lambda t: count([t])[0]
    full = lambda x: re.search(r"\S", x) is not None
    sentences = lambda t: [x for x in re.split(r"(?<=[.!?])[ \t\n\x0b\f\r]+", t) if full(x)] or [t]
    chunks = lambda t: [" ".join(w[i : i + 40]) for w in [t.split()] for i in range(0, max(1, len(w)), 40)]

    def alone(t):
        return len(t) <= 1800 and size(t) <= most and (size(t) <= most * 0.75 or len(sentences(t)) <= 1)

    def pieces(s):
        n = size(s)
        tabular = len(re.findall("[:;]", s)) >= 3
        if n <= most and not tabular:
            return [(s, n, False)]
        parts = [x for x in re.split(r"(?<=[:;])[ \t\n\x0b\f\r]+", s) if full(x)]
        if len(parts) > 1:
            return [(c, size(c), True) for p in parts for c in ([p] if size(p) <= most else chunks(p))]
        return [(s, n, False)] if n <= most else [(c, size(c), False) for c in chunks(s)]

    def packed(items, goal):
        done, open_, n = [], None, 0
        for t, k, one in items:
            if one:
                done += [x for x in [open_] if x is not None] + [t]
                open_, n = None, 0
            elif open_ is not None and n + k <= goal:
                open_, n = f"{open_} {t}", n + k
            else:
                done += [x for x in [open_] if x is not None]
                open_, n = t, k
        return done + [x for x in [open_] if x is not None]

    if not full(text or ""):
        return []
    if alone(text):
        return [[text]]
    out = []
    for p in (x for x in text.split("\n\n") if full(x)):
        goal = int(most * 0.75) if len(p) <= 1800 and size(p) <= most else most
        out.append([p] if alone(p) else packed([i for s in sentences(p) for i in pieces(s)], goal))
    return out


TEXTS = [None, "", " \n ", "One. Two! Three?", "word " * 900, "a: b; c: d; e: " + "long " * 200, "Row: " + "x y; " * 120 + ".", "\n\n".join(["Short one."] * 3 + ["Part: of; it: all " * 60] * 2), "é" * 3000, "No end " * 300 + ". " + "Then: more; of: it. " * 40, "Near. " * 60 + "the: budget.", "\n\n\n\nA. B. " * 50]


@pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")
@pytest.mark.parametrize("most", [20, 60, 400])
def test_planned_by_a_tokenizer(spark, most):
    df = spark.createDataFrame([(k, "f", t) for k, t in enumerate(TEXTS)], "id long, field string, text string")
    count = real()
    want = sorted((k, "f", p, i, t) for k, text in enumerate(TEXTS) for p, run in enumerate(plain(text, count, most)) for i, t in enumerate(run))
    for block in (2048, 5):
        got = budget.planned(df, real, most, KEY, "byte_bpe", block).select(*KEY, "para", "piece", "text").collect()
        assert sorted(map(tuple, got)) == want


def test_planned_is_the_fold(spark):
    """With the fold's own lengths both ways give the same chunks."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"), F.lit("t").alias("field"), "text")
    want = {tuple(r) for r in chunk.chunks(docs, 60).collect()}
    got = [tuple(r) for r in budget.planned(docs, words, 60, KEY, block=16).select(*KEY, "para", "piece", "text").collect()]
    assert set(got) == want and len(got) == len(want)


def test_a_text_of_very_many_sentences(spark):
    """300000 sentences of one paragraph, and of another with pieces that stand alone, equal the fold."""
    n = 300_000
    sent = F.concat(F.repeat(F.lit("w "), (F.xxhash64("i", "id") % 9 + 9).cast("int")), F.when((F.col("id") == 1) & (F.col("i") % 97 == 0), F.lit("a: b; c: d.")).otherwise(F.lit("e.")))
    rows = spark.range(n).select(F.col("id").alias("i")).crossJoin(spark.range(2)).select("id", "i", sent.alias("s"))
    texts = rows.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]), " ").alias("text")).withColumn("field", F.lit("f"))
    got = budget.planned(texts, words, 40, KEY).select(*KEY, "para", "piece", "text")
    long = {r.id: r.text for r in texts.collect()}
    count = words()
    for k, text in long.items():
        (want,) = plain(text, count, 40)
        mine = [r.text for r in got.filter(F.col("id") == k).orderBy("piece").collect()]
        assert mine == want


def test_no_texts(spark):
    assert budget.planned(spark.createDataFrame([], "id long, field string, text string, para int, goal int"), words).collect() == []


def test_short_texts_are_placed_by_one_shuffle(spark, monkeypatch):
    """No range partitions, so nothing is measured a second time for their bounds; a longer text goes through them, and both give the fold's chunks."""
    n = []
    placed = budget.by_blocks.placed
    monkeypatch.setattr(budget.by_blocks, "placed", lambda *a: n.append(1) or placed(*a))
    docs = spark.createDataFrame([(1, "f", "Row: x y. " * 30), (2, "f", "One two! Three? " * 10), (None, "f", None)], "id long, field string, text string")
    want = sorted(map(tuple, chunk.chunks(docs, 20).collect()))
    for block, calls in ((2048, 0), (4, 1)):
        got = budget.planned(docs, words, 20, KEY, block=block).select(*KEY, "para", "piece", "text").collect()
        assert sorted(map(tuple, got)) == want and len(n) == calls
