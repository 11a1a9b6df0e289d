"""The layered windows against a plain fold of the same rules over random documents."""

import random
import re

from textmill.functions.patterns import Grammar
from textmill.operators import segment

G = Grammar(
    running_titles=("Garden handbook",), pairs=("Lime and ash",),
    orphans=(("d1", 0, "OT", "OS"), ("d2", 1, "OT2", "OS2")), boundaries=(("d0", "Closing"), ("d1", "Closing"), ("d2", "Closing"), ("d3", "Closing")),
)
POOL = [
    "Umbrella 1 of all", "List of questions here", "This question is divided into parts", "Sub-question 2 of it", "Context", "Topic 3 soils", "words on soil. Then", "a) does lime help?", "b) does ash help?",
    "Verdict: yes", "Evidence 4: strong12, indeed", "Considerations: none", "- Verdict: no", "1. In sand", "2. In clay", "wrapped tail of it", "more text", "Intervention liming", "Lime and ash", "Closing remarks", "• a bullet", "• c) bulleted item", "x Verdict: y",
]


def has(p, t, i=False):
    return re.search(p, t, re.I if i else 0) is not None


def fold(doc, raw, late=False):
    lines = []
    for r in raw:
        t = re.sub(r"^[•▪\-–*][•▪\-–*\s]*", "", r.strip())
        if t:
            lines.append((t, bool(re.match("[•▪]", r.strip()))))
    look = []
    for i in range(len(lines)):
        js = [k for k in range(i, min(i + 8, len(lines))) if has(G.judgement, lines[k][0], True)]
        bs = [k for k in range(i + 1, min(i + 8, len(lines))) if has(G.lettered, lines[k][0])]
        look.append(has(G.lettered, lines[i][0]) and bool(js) and (not bs or js[0] < bs[0]))
    s = dict(topic="", sub="", inter="", question=[], label=[], pending=None, orphan=0, mode=None, saved=None, divided=False, last=None)
    buf = {"judgement": [], "evidence": [], "considerations": []}
    u = sub = top = False
    ub, sb, tb = [], [], []
    un = tn = False
    rows = []

    def flush(keep_sub=False, keep_q=False):
        if any(buf.values()):
            by_sub = s["divided"] and s["sub"]
            label = " ".join(s["label"])
            j = buf["judgement"] or (s["last"] or [] if label else [])
            rows.append((s["topic"], s["sub"] if by_sub else s["inter"], " ".join(s["question"]), label or ("" if by_sub else s["sub"]), " ".join(j), " ".join(buf["evidence"]), " ".join(buf["considerations"])))
            if buf["judgement"]:
                s["last"] = list(buf["judgement"])
            for b in buf.values():
                b.clear()
        s["mode"], s["label"] = None, []
        if not keep_q:
            s["question"], s["last"] = [], None
        if not keep_sub:
            s["sub"] = ""

    for i, (t, bullet) in enumerate(lines):
        nxt = i + 1 < len(lines) and has(G.lettered, lines[i + 1][0])
        nar = has(G.narration, t, True)
        mark = next((m for m, p in (("judgement", G.judgement), ("evidence", G.evidence), ("considerations", G.considerations)) if has(p, t, True)), None)
        if (has(G.intervention, t) or t in G.pairs) and nxt:
            s["pending"] = t
            continue
        if has(G.umbrella_start, t):
            flush()
            u, ub, un = True, [], False
            continue
        if u and has(G.umbrella_end, t):
            u = False
            s["topic"], s["inter"], s["divided"] = " ".join(ub), "", un
        elif u:
            un |= nar
            ub.append(t)
            continue
        if has(G.sub_start, t):
            flush()
            if top:
                top, s["topic"] = False, " ".join(tb)
            sub, sb = True, []
            continue
        if sub:
            if has(G.context, t):
                s["sub"], sub = " ".join(sb), False
            else:
                sb.append(t)
            continue
        if has(G.topic_start, t):
            flush()
            top, tb, tn, s["divided"], s["inter"] = True, [], False, False, ""
            continue
        if top:
            if has(G.context, t):
                s["topic"], top = " ".join(tb), False
            elif tn and bullet:
                s["topic"], top, s["divided"] = " ".join(tb), False, True
            else:
                tn |= nar
                tb.append(t)
            continue
        if has(G.context, t):
            flush()
            s["topic"], s["inter"] = {(d, n): (a, b) for d, n, a, b in G.orphans}.get((doc, s["orphan"]), ("", ""))
            s["divided"], s["orphan"] = False, s["orphan"] + 1
            continue
        if look[i]:
            if late and s["pending"]:
                s["inter"] = s["pending"]
            flush(keep_sub=True)
            if s["pending"]:
                s["inter"] = s["pending"]
            s["pending"], s["question"], s["mode"] = None, [t], "question"
            continue
        if has(G.label, t):
            saved = s["saved"] if s["mode"] == "label" else s["mode"]
            flush(keep_sub=True, keep_q=True)
            s["saved"], s["label"], s["mode"] = saved, [t], "label"
            continue
        if s["mode"] == "label":
            if re.match(r"[a-zà-ÿ]", t) and not mark:
                s["label"].append(t)
                continue
            s["mode"] = s["saved"]
        if s["mode"] in buf and not mark and any(d == doc and t.startswith(x) for d, x in G.boundaries):
            flush()
            s["inter"] = ""
            continue
        s["pending"] = None
        if mark:
            s["mode"] = mark
            buf[mark].append(re.split({"judgement": G.judgement, "evidence": G.evidence, "considerations": G.considerations}[mark], t, maxsplit=1, flags=re.I)[1])
        elif s["mode"] == "question":
            s["question"].append(t)
        elif s["mode"] in buf:
            buf[s["mode"]].append(t)
    flush()
    return rows


def tidy(row):
    """The scalar steps of a record, in Python."""
    topic = row[0]
    if re.search(G.narration, topic, re.I):
        before = topic[: re.search(G.narration_cut, topic, re.I).start()]
        m = re.match(r"(?s)^(.*[.?!]) ", before)
        topic = m[1] if m else ""
    answers = []
    for a in row[4:]:
        a = re.sub(r"(?<=[a-z)%\]”»\"])\d{1,3}(?:[,\-–.]\d{1,3})*(?=[\s.,;:)\]]|$)", "", a)
        m = re.match(r"(?s)^([^A-Za-zÀ-ÿ]*)([A-Za-zÀ-ÿ])(.*)$", a)
        answers.append(m[1] + m[2].upper() + m[3] if m else a)
    return (topic, *row[1:4], *answers)


def run(spark, docs, **kw):
    df = spark.createDataFrame([(d, i, t) for d, ls in docs.items() for i, t in enumerate(ls)], "doc_id string, line_no int, raw string")
    out = {}
    for r in segment.segmented(df.repartition(4), G, **kw).orderBy("doc_id", "row_no").collect():
        out.setdefault(r.doc_id, []).append((r.topic, r.subtopic, r.question, r.focus, r.judgement, r.evidence, r.considerations))
    return out


def test_random_documents(spark):
    rnd = random.Random(11)
    docs = {f"d{k}": [rnd.choice(POOL) for _ in range(rnd.randint(5, 90))] for k in range(400)}
    for late in (False, True):
        got = run(spark, docs, late_intervention=late)
        for d, ls in docs.items():
            want = [tidy(r) for r in fold(d, ls, late)]
            assert [tuple(x.strip() for x in r) for r in got.get(d, [])] == [tuple(x.strip() for x in r) for r in want], (d, late, ls)


def test_one_guide(spark):
    guide = ["Garden handbook 7", "Topic 1", "Liming of soils", "Context", "some background", "Intervention liming", "a) does lime help?", "on sand", "Verdict: yes", "and always", "Evidence 3: strong12.", "1. In sand", "of the dunes", "Evidence: more", "Closing remarks", "ignored", "b) is ash better?", "no verdict follows"]
    assert run(spark, {"d0": guide})["d0"] == [("Liming of soils", "Intervention liming", "a) does lime help? on sand", "", "Yes and always", "Strong.", ""), ("Liming of soils", "Intervention liming", "a) does lime help? on sand", "1. In sand of the dunes", "Yes and always", "More", "")]


def test_lookahead(spark):
    for gap, kept in ((6, True), (7, False)):
        got = run(spark, {"d9": ["a) item"] + ["text"] * gap + ["Verdict: yes"]})["d9"]
        assert (got[0][2] != "") == kept


def test_long_sections(spark):
    """A title of many lines is gathered once, not anew for each line."""
    import time

    n = 30_000
    raw = ["Topic 1 x", *[f"part {i}" for i in range(n)], "Context", "a) Why?", "Verdict: yes"]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(raw)], "doc_id string, line_no int, raw string")
    began = time.time()
    rows = segment.segmented(df, Grammar()).collect()
    assert [(r.topic, r.question, r.judgement) for r in rows] == [(" ".join(raw[1 : n + 1]), "a) Why?", "Yes")] and time.time() - began < 60


def by_sections(spark, docs, block, **kw):
    df = spark.createDataFrame([(d, i, t) for d, ls in docs.items() for i, t in enumerate(ls)], "doc_id string, line_no int, raw string")
    out = {}
    for r in segment.segmented_in_sections(df.repartition(4), G, block=block, **kw).orderBy("doc_id", "row_no").collect():
        out.setdefault(r.doc_id, []).append((r.row_no, r.guidebook, r.topic, r.subtopic, r.question, r.focus, r.judgement, r.evidence, r.considerations))
    return out


def test_sections_are_the_fold(spark):
    """Cut at topics, with values carried over blocks of 9 lines, random documents give what the fold gives, in both readings."""
    rnd = random.Random(12)
    docs = {f"d{k}": [rnd.choice(POOL) for _ in range(rnd.randint(5, 200))] for k in range(250)}
    for late in (False, True):
        got = by_sections(spark, docs, 9, late_intervention=late)
        for d, ls in docs.items():
            want = [tidy(r) for r in fold(d, ls, late)]
            assert [tuple(x.strip() for x in r[2:]) for r in got.get(d, [])] == [tuple(x.strip() for x in r) for r in want], (d, late, ls)
            assert all(r[1] == d for r in got.get(d, []))
    df = spark.createDataFrame([(d, i, t) for d, ls in docs.items() for i, t in enumerate(ls)], "doc_id string, line_no int, raw string")
    whole = sorted(map(tuple, segment.segmented(df, G).collect()))
    assert whole == sorted(map(tuple, segment.segmented_in_sections(df, G, block=16).collect()))


def test_a_very_long_document(spark):
    """A document of 150000 lines is cut into thousands of sections, and equals the fold."""
    rnd = random.Random(13)
    raw = [rnd.choice(POOL) for _ in range(150_000)]
    got = by_sections(spark, {"d1": raw}, 4096)["d1"]
    want = [tidy(r) for r in fold("d1", raw)]
    assert [tuple(x.strip() for x in r[2:]) for r in got] == [tuple(x.strip() for x in r) for r in want]
    numbers = [r[0] for r in got]
    assert numbers == sorted(set(numbers))


def test_blocks(spark):
    """Places, carried values and counts by blocks equal those of one window."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from textmill.operators import blocks

    d = spark.range(3000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 != 0, F.xxhash64("id") % 1000).alias("o"), "id", F.when(F.xxhash64("id", F.lit(1)) % 5 == 0, F.col("id")).alias("v"))
    d = d.withColumn("k", F.when(F.col("k") > 0, F.col("k")))
    b = blocks.in_blocks(d, ["k"], ["o", "id"], 50)
    b = blocks.counted(blocks.carried(b, F.col("v"), "last", ["k"]), F.col("v").isNotNull(), "n", ["k"])
    w = Window.partitionBy("k").orderBy("o", "id")
    want = d.select("id", (F.row_number().over(w) - 1).cast("long"), F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.count("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(map(str, b.select("id", "_place", "last", "n").collect())) != [] and {tuple(r) for r in b.select("id", "_place", "last", "n").collect()} == {tuple(r) for r in want.collect()}
