"""Enrichment, page texts and hard negatives against plain versions, and their odd cases."""

import datetime as dt
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textmill.llm import enrichment, hard_negatives, html_text
from textmill.llm import queries as Q

DAY0 = dt.datetime(2024, 1, 1)
SALES = "sale_id long, client_id long, status string, total double, sold_at timestamp_ntz, arrived_at timestamp_ntz, priority int, at long, client string"
CHANGES = "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double, row long"


def plain_enrichment(sales, changes):
    """The batches one after the other, with lists."""
    micros = lambda t: None if t is None else round((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    number = lambda day: max(0, min(9, (day - 19723) * 10 // 152))
    day = lambda t: (t - dt.datetime(1970, 1, 1)).days
    new_sales, new_changes = defaultdict(list), defaultdict(list)
    for s in sales:
        new_sales[9 if s[5] is None else number(day(s[5]))].append((s[0], s[1], micros(s[4])))
    for c in dict.fromkeys(changes):
        if c[4] is not None:
            shift = 0 if c[0] is None else zlib.crc32(str(c[0]).encode()) % 4
            new_changes[number(day(c[4]) + shift)].append(c)
    low = -(1 << 63)
    seen_s = seen_c = None
    versions, waiting, out = defaultdict(list), [], []

    def emit(s, b):
        order = lambda v: tuple(low if x is None else x for x in v[:3])
        mine = versions[s[1]] if s[1] is not None else []
        fit = [v for v in mine if s[2] is not None and v[0] <= s[2]]
        v = max(fit, key=order) if fit else (None,) * 5
        out.append(("sale", s[0], b, len(mine), v[2], v[3], v[4]))

    for b in range(10):
        wc, ws = (low if x is None else x - 36 * 3_600_000_000 for x in (seen_c, seen_s))
        h = min(wc, ws)
        for c in new_changes[b]:
            t = micros(c[4])
            seen_c = t if seen_c is None else max(seen_c, t)
            if t < wc:
                out.append(("change", c[0], b, None, None, None, None))
            else:
                versions[c[1]].append((t, c[2], c[0], None if c[8] is None else int(np.floor(100 * c[8] + 0.5)), c[3]))
        rest = []
        for s in waiting + new_sales[b]:
            if s[2] is None or s[2] < h:
                emit(s, b)
            else:
                rest.append(s)
        waiting = rest
        for s in new_sales[b]:
            if s[2] is not None:
                seen_s = s[2] if seen_s is None else max(seen_s, s[2])
        for k, v in versions.items():
            old = sorted((x for x in v if x[0] <= h), key=lambda x: tuple(low if y is None else y for y in x[:3]))
            versions[k] = old[-1:] + [x for x in v if x[0] > h]
    for s in waiting:
        emit(s, 10)
    return out


def shop(seed, n=600):
    r = random.Random(seed)
    at = lambda most: DAY0 + dt.timedelta(seconds=r.randrange(most * 86_400))
    client = lambda: 7 if r.random() < 0.4 else r.choice([None, *range(30)])
    sales, changes = [], []
    for k in range(n):
        sold = None if r.random() < 0.02 else at(120)
        late = dt.timedelta(seconds=r.choice((0, 5, 4000, 86_400 * 9)))
        sales.append((k // 2 if r.random() < 0.1 else k, client(), "x" * r.choice((1, 20_000)), 1.0, sold, None if r.random() < 0.01 else (sold or DAY0) + late, 1, 5, "c"))
        changes.append((None if r.random() < 0.01 else k // 2 if r.random() < 0.1 else k, client(), r.choice((None, 0, 0, 1)), r.choice(("I", "U", "D", None)), None if r.random() < 0.02 else at(120), None, "s", "c", r.choice((None, 1.005, -3.336, float(k))), 3))
    # equal times, repeated rows, and sales exactly at a version's time
    changes += changes[:20]
    changes += [(10_000 + k, 7, k % 3, "U", DAY0 + dt.timedelta(days=20), None, None, None, float(k), 3) for k in range(6)]
    sales += [(20_000 + k, 7, "x", 1.0, DAY0 + dt.timedelta(days=20), DAY0 + dt.timedelta(days=20 + k), 1, 5, "c") for k in range(4)]
    return sales, changes


@pytest.mark.parametrize("seed,hot", [(1, 1 << 16), (2, 60)])
def test_enrichment(spark, seed, hot):
    """A client of 40 % of the rows is one bucket's, or dealt in cells; either way answers are those of the plain version."""
    sales, changes = shop(seed)
    got = enrichment.enriched(spark.createDataFrame(sales, SALES), spark.createDataFrame(changes, CHANGES), bucket=400, hot=hot)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_enrichment(sales, changes), key=key)


def test_enrichment_of_nothing(spark):
    no_sales, no_changes = spark.createDataFrame([], SALES), spark.createDataFrame([], CHANGES)
    assert enrichment.enriched(no_sales, no_changes).collect() == []
    sales = [(1, 2, None, None, DAY0, DAY0, None, None, None)]
    assert [tuple(r) for r in enrichment.enriched(spark.createDataFrame(sales, SALES), no_changes).collect()] == [("sale", 1, 10, 0, None, None, None)]


def plain_negatives(rows, is_anchor, positives=5, negatives=3):
    import math

    ok = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, label, v in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, label, q) in enumerate(ok):
        if not is_anchor(i):
            continue
        scores = [(-sum(x * y for x, y in zip(q, v, strict=True)), j, other != label) for b, (j, other, v) in enumerate(ok) if b != a and len(v) == len(q)]
        for s, j, _ in sorted(x for x in scores if not x[2])[:positives]:
            hard = [x for x in sorted(x for x in scores if x[2]) if 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(hard)]
    return out


def test_hard_negatives(spark):
    """Ties, repeated rows, other lengths, odd dimensions, outliers, null and non-finite parts; blocks much smaller than the table."""
    g = np.random.default_rng(3)
    v = g.normal(0, 0.3, (300, 7)).astype(np.float32)
    v[::9] = v[0]
    rows = [(k, int(g.integers(0, 4)), [float(x) for x in v[k]]) for k in range(300)]
    rows += [(300, 1, [1e6] * 7), (301, 2, [-1e6] * 7), (302, None, [0.1] * 7), (303, 1, None), (304, 1, [None] * 7), (305, 1, [float("nan")] * 7), (306, 2, [float("inf")] * 7), (None, 1, [0.2] * 7)]
    rows += [(310 + k, k % 3, [0.5 + k / 10, 0.4]) for k in range(12)] + [(330, 0, []), (340, 1, []), (350, 0, []), rows[20], rows[10]]
    df = spark.createDataFrame([(*x, "k", 0) for x in rows], "vec_id long, label int, embedding array<float>, row string, dim int")
    want = sorted(plain_negatives([(i, label, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for i, label, e in rows], lambda i: i % 10 == 0))
    for rows_, anchors in ((64, 16), (8192, 8192)):
        got = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, rows=rows_, anchors=anchors)
        assert sorted(map(tuple, got.collect())) == want
    assert hard_negatives.hard_negatives(df.filter("1 = 0"), F.lit(True)).collect() == []


def test_bounds_hold():
    """Every score lies within its row's bounds, whatever the cells were fitted on, and few rows need an exact score."""
    g = np.random.default_rng(5)
    vecs = np.floor(256 * g.normal(0, 0.125, (500, 64)))
    for sample in (vecs[:100], np.zeros((1, 64))):
        ends = hard_negatives.ends_of(sample)
        codes = np.stack([np.searchsorted(ends[d], vecs[:, d], side="right") for d in range(64)], axis=1).astype(np.uint8)
        block = hard_negatives.Block(codes, vecs, np.zeros(500, np.int64), ends)
        for q in vecs[:5]:
            low, high = block.bounds(q, slice(0, 500))
            s = vecs @ q
            assert (low <= s).all() and (s <= high).all()
            assert sample is not vecs[:100] or (high - low).mean() < 0.2 * s.std() * 10


def test_huge_components(spark):
    """A score beyond 64 bits counts as the nearest number."""
    rows = [(0, 0, [3e15, 1.0]), (1, 0, [3e15, 0.0]), (2, 1, [9 / 256, 0.0]), (3, 1, [1e-3, 5.0]), (4, 1, [2e15, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = [tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") == 0).collect()]
    assert got == [(0, 1, 1, 2, (1 << 63) - 1, 9 * 256 * 3 * 10**15)]


# pages


@pytest.fixture(scope="module")
def model():
    return html_text.trained()


def test_labeller_on_layouts_it_has_not_seen(model):
    """At most one block in a hundred is labelled wrong over 150 random layouts."""
    reader = html_text.Reader()
    wrong = n = 0
    for k in range(150):
        _, x, y = html_text.labelled(77_000_000 + k, reader)
        if len(x):
            wrong += int(((model.logits(*html_text.padded([x]))[0] > 0) != (y > 0)).sum())
            n += len(y)
    assert wrong <= n / 100


def test_gradients():
    """Going back through time gives the loss's slope."""
    g = np.random.default_rng(1)
    m = html_text.Labeller(3, 4)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, mask = g.standard_normal((3, 5, html_text.PATH + html_text.WORD + html_text.FIGURES)) * 0.3, np.arange(5) < np.array([[5], [3], [1]])
    y = (g.random((3, 5)) > 0.5).astype(float)
    _, grads = m.gradients(x, mask, y)
    for name, p in m.p.items():
        for _ in range(4):
            at = tuple(g.integers(0, s) for s in p.shape)
            old, sides = p[at], []
            for step in (1e-3, -1e-3):
                p[at] = old + step
                sides.append(m.gradients(x, mask, y)[0])
            p[at] = old
            assert abs((sides[0] - sides[1]) / 2e-3 - grads[name][at]) < 1e-4


def test_given_pages(spark, model):
    """On the given pages the text is exactly what stands in the article."""
    import html
    import re

    def article(page):
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        return "\n".join(x for x in parts if x)

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = {r.page_id: r for r in Q.op12_html(spark, "/root/testdata/sf0.01").collect()}
    assert {k: r.text for k, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_blocks():
    read = lambda p: html_text.Reader().blocks(p)[0]
    assert read("<p>a &amp; b&nbsp;&eacute;<br>c <i>d</i>e<p>f<div>g") == ["a & b é c de", "f", "g"]
    assert read("<title>t</title><script>a<p>b</script x>c<style>p{}</style><!-- <p>no</p> -->d<template><p>e</p></template>f") == ["cdf"]
    assert read('<a href="x>y">l</a><p title=\'>\'>m</p') == ["l", "m"]
    assert read("") == read("<p> \n\t</p><!--") == [] and read("1 < 2 & 3 <3") == ["1 < 2 & 3 <3"]
    assert read("<ul><li>a<ul><li>b</ul><li>c</ul>") == ["a", "b", "c"] and read("<textarea><p>x</textarea>y") == ["<p>x", "y"]


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "x", "<li>" * 100_000, "</p>" * 200_000, '<a "' * 100_000, "<" * 300_000, "<!--" * 100_000, "<td><li>" * 50_000, "&" * 300_000, "x " * 500_000, "<script>" * 50_000])
def test_hostile_pages_end(page):
    import time

    began = time.time()
    html_text.Reader().blocks(page)
    assert time.time() - began < 20


def test_odd_pages(spark, model):
    rows = [(1, None, None, "k"), (None, "u", "", "k"), (2, "u", "<nav><a href=x>Home</a></nav>", "k"), (2, "u", "<nav><a href=x>Home</a></nav>", "k"), (3, "u", "<article><h1>Title here.</h1>" + "<p>Some words of a text that is told at length.</p>" * 20_000 + "</article>", "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((r.page_id or 0, r.n_chars) for r in html_text.extracted(df, model).collect())
    assert [g[0] for g in got] == [0, 1, 2, 2, 3] and [g[1] for g in got[:4]] == [0, 0, 0, 0] and got[4][1] == 11 + 20_000 * 45
    assert html_text.extracted(df.filter("1 = 0"), model).collect() == []


OFF = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{folder}").getOrCreate()
import public_tokenizers
from textmill.llm import html_text, near_dup, secret_scan, token_counts
d = s.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g")], "doc_id long, text string")
n = token_counts.count_tokens(d, public_tokenizers.path("byte_bpe_50k.json"), 1024).count()
left = [r.doc_id for r in near_dup.one_of_each(d).collect()]
pages = html_text.extracted(s.createDataFrame([(1, "u", "<p>x")], "page_id long, url string, html string"), html_text.Labeller()).count()
print("SAID", n, left, pages, secret_scan.scan(d).count())
"""


def test_off_the_workers_path(tmp_path):
    """Public functions work on a caller's own table, where the workers of a cluster can't import the package by themselves."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", OFF.format(root=root, folder=tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "SAID 2 [1] 1 2" in run.stdout, run.stderr[-2000:]
