import random
import re

import pytest
from pyspark.sql import functions as F

from textmill.functions.patterns import Grammar
from textmill.operators import audit, chunk, curate, hyphen, model, parallel, publish, split
from textmill.sources import tables

G = Grammar()


def test_hyphens(spark):
    doc = ["The gar- ", "den, grows", "a garden", "a well-", "known plant", "well-known", "both-", "ways bothways both-ways", "nei-", "ther", "x-", "yz", "soil-", "", "Garden handbook 3", "  bound rest", "soilbound", "last-"]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(doc)], "doc_id string, line_no int, raw string")
    d = {(r.head, r.tail): (r.has_joined, r.has_compound, r.merge) for r in hyphen.decided(df, G).collect()}
    assert d == {("gar", "den"): (True, False, True), ("well", "known"): (False, True, False), ("both", "ways"): (True, True, False), ("nei", "ther"): (False, False, False), ("soil", "bound"): (True, False, True)}
    vocabulary = spark.createDataFrame([("neither",)], "word string")
    out = [r.raw for r in hyphen.merged(df, G, vocabulary).orderBy("line_no").collect()]
    assert out[:2] == ["The garden,", "grows"] and out[8:10] == ["neither", ""] and out[12] == "soilbound" and out[15] == "  rest" and out[3] == "a well-"


def test_hyphen_evidence_is_search(spark):
    rnd = random.Random(3)
    parts = ["ab", "cd", "abcd", "ab-cd", "ab-", "cd,", "x-ab-cd", "éa", "ab-cde"]
    docs = {k: [" ".join(rnd.choice(parts) for _ in range(4)) for _ in range(6)] for k in range(150)}
    df = spark.createDataFrame([(k, i, t) for k, ls in docs.items() for i, t in enumerate(ls)], "doc_id int, line_no int, raw string")
    L = "[^\\W\\d_]"
    for r in hyphen.decided(df).collect():
        text = "\n".join(docs[r.doc_id])
        joined = re.search(rf"(?<!{L}){r.head}{r.tail}(?!{L})", text, re.I) is not None
        compound = re.search(rf"(?<![^\W\d_]|-){r.head}-{r.tail}(?!{L})", text.replace("\n", "\n"), re.I) is not None
        assert (r.has_joined, r.has_compound) == (joined, compound)


def test_keep_longest(spark):
    rows = [(1, "a|b", "c", "xx"), (2, "a", "b|c", "xx"), (3, "a", "b|c", "xxx"), (4, "a", "b|c", "yyy"), (5, None, "c", "z"), (6, None, "c", None)]
    df = spark.createDataFrame(rows, "n int, k1 string, k2 string, v string")
    for f in (curate.keep_longest, curate.keep_longest_window):
        assert sorted(r.n for r in f(df, ["k1", "k2"], F.coalesce(F.length("v"), F.lit(0)), ["n"]).collect()) == [1, 3, 5]
    twice = df.unionByName(df.withColumn("n", F.col("n") + 10))
    assert sorted(r.n for r in curate.keep_longest(twice, ["k1", "k2"], F.coalesce(F.length("v"), F.lit(0)), ["n"]).collect()) == [1, 3, 5]


def test_filters(spark):
    rows = [(1, "No evidence at all", None), (2, " no studies were found", "None."), (3, "Not applicable", "real"), (4, "see previous sections", "x"), (5, None, None), (6, "  ", "y"), (7, "good", "N/A")]
    df = spark.createDataFrame(rows, "n int, evidence string, considerations string")
    assert {r.n: r.evidence for r in curate.filtered(df, G).collect()} == {3: "Not applicable", 5: G.default_evidence, 6: G.default_evidence, 7: "good"}
    c = curate.removal_counts(df, G).first()
    assert (c.n_rows, c.n_cross_reference, c.n_placeholder_empty, c.n_placeholder_phrase, c.n_filled) == (7, 1, 1, 1, 2)


def test_ids_and_patches(spark):
    df = spark.createDataFrame([(i, f"g{i % 3}") for i in range(50)], "n int, g string")
    got = {r.id: r.n for r in curate.with_ids(df, "p", ["g", "n"]).collect()}
    want = sorted(range(50), key=lambda i: (i % 3, i))
    assert got == {f"p_{k + 1}": n for k, n in enumerate(want)}
    ids = curate.by_suffix(spark.createDataFrame([("g", "p_10"), ("g", "p_9"), ("f", "p_11")], "guidebook string, id string")).collect()
    assert [r.id for r in ids] == ["p_11", "p_9", "p_10"]
    rows = spark.createDataFrame([("1", "a.b a.b", "q"), ("2", None, "q"), ("3", "zz", "q")], "id string, text string, other string")
    patches = spark.createDataFrame([("1", "text", "a.b", "X", 1), ("1", "text", "X a", "Y", 2), ("1", "other", "none", "Z", 3), ("2", "text", "x", "y", 1), ("9", "text", "x", "y", 1)], "id string, field string, find string, replacement string, ord int")
    out = {r.id: (r.text, r.other, r.n_applied) for r in curate.patched(rows, patches, ["text", "other"]).collect()}
    assert out == {"1": ("Y.b", "q", 2), "2": (None, "q", 0), "3": ("zz", "q", 0)}


def test_split(spark):
    sizes = {"a": 1, "b": 2, "c": 7, "d": 50}
    df = spark.createDataFrame([(f"{s}{i}", s) for s, n in sizes.items() for i in range(n)], "id string, s string")
    out = split.split(df, "s", "id", 12, 6)
    split.check_sizes(out, test=12, dev=6, train=42)
    assert {r.id: r.split for r in out.collect()} == {r.id: r.split for r in split.split(df.repartition(7), "s", "id", 12, 6).collect()}
    with pytest.raises(ValueError):
        split.check_sizes(out, test=13)
    everything = split.drawn(df, "s", "id", 100).filter("drawn").count()
    assert everything == 60


def test_split_by_brute_force(spark):
    """Each part is what ranking every stratum gives, with null strata, null keys and parts that end in one head."""
    import random
    from collections import defaultdict
    from hashlib import md5

    r = random.Random(5)
    rows = [(i if i % 97 else None, r.choice(["a", "a", "a", "b", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, s string").repartition(5)
    for sizes in ([0], [7, 3], [1200, 1, 900]):
        got = split.cut(df, "s", "id", sizes).collect()
        assert len(got) == len(rows)
        left = defaultdict(list)
        for k, s in rows:
            left[s].append(("" if k is None else md5(f"{k}|42".encode()).hexdigest(), k))
        for v in left.values():
            v.sort(key=lambda x: x[0])
        want = []
        for part, size in enumerate(sizes):
            n = sum(map(len, left.values()))
            exact = {s: len(v) * size / n for s, v in left.items() if v}
            quota = {s: int(e) for s, e in exact.items()}
            for s in sorted(exact, key=lambda s: (-(exact[s] - int(exact[s])), s is not None, s or ""))[: size - sum(quota.values())]:
                quota[s] += 1
            for s, q in quota.items():
                want += [(s, k, part) for _, k in left[s][:q]]
                left[s] = left[s][q:]
        want += [(s, k, len(sizes)) for s, v in left.items() for _, k in v]
        assert sorted(map(repr, want)) == sorted(repr((x.s, x.id, x.part)) for x in got)


def test_audits(spark):
    df = spark.createDataFrame([(1, "A b. C", None), (2, " ", "x"), (3, "End. 2. Head", "well- known")], "n int, a string, b string")
    assert [(r.n, r.missing) for r in audit.incomplete(df, ["a", "b"], ["n"]).orderBy("n").collect()] == [(1, "b"), (2, "a")]
    assert [(r.n, r.field) for r in audit.leaks(df, ["a", "b"], ["n"]).collect()] == [(3, "a")]
    assert [(r.field, r.words) for r in audit.hyphens(df, ["a", "b"], ["n"]).collect()] == [("b", "well- known")]
    r = {(x.phase, x.key): x.value for x in audit.phase_report(df, df.filter("n > 1"), ["a"], ["b"], ["a", "b"]).collect()}
    assert r["before", "rows"] == 3 and r["after", "incomplete"] == 1 and r["before", "nonblank a"] == pytest.approx(200 / 3)
    with pytest.raises(ValueError):
        audit.check_unique(df.unionByName(df), "n")
    both = {x.b: (x.n_before, x.n_after) for x in audit.before_after(df, df.filter("n = 2"), "b").collect()}
    assert both == {None: (1, 0), "x": (1, 1), "well- known": (1, 0)}


def test_publish(spark):
    raw = spark.createDataFrame([(1, " T ", "a) Why?", "Yes", "dev"), (2, "T", "b.1. How?", " ", None), (3, None, "c) When?", "No", None)], "n int, Topic string, `Clinical question` string, Judgment string, split string")
    out = publish.normalised(raw, {"question": ["question", "clinical_question"], "judgement": ["judgement", "judgment"]}, G, "src", "x", F.col("n"), split="train").orderBy("id").collect()
    assert [(r.id, r.split, r.topic, r.query) for r in out] == [("x_00001", "dev", "T", "- Topic: T\n- Question: Why?"), ("x_00003", "train", None, "- Question: When?")]
    with pytest.raises(ValueError):
        publish.normalised(raw, {}, G, "s", "x", F.col("n"))
    with pytest.raises(ValueError):
        publish.check_any(raw.filter("n > 9"))


def test_chunks(spark):
    one, many = "word " * 30, ". ".join("s" * 3 + " t" * 20 for _ in range(30)) + "."
    texts = [("a", one), ("b", many), ("c", " "), ("d", "k: v; " * 200), ("e", "w " * 1500), ("f", many[:300] + "\n\n\n" + one), ("g", None)]
    df = spark.createDataFrame([(i, "f", t) for i, t in texts], "id string, field string, text string")
    parts = chunk.chunks(df, 100)
    rows = parts.collect()
    assert all(len(r.text.split()) <= 100 for r in rows) and {r.id for r in rows} == {"a", "b", "d", "e", "f"}
    assert max(r.para for r in rows if r.id == "f") == 1
    back = {r.id: r.text for r in chunk.reassembled(parts).collect()}
    for i, t in texts:
        if t and t.strip():
            assert back[i].split() == t.split()


def test_models(spark):
    rows = [("1", "G", "T", "", "q one", "f", "yes", "e", None, "old", "s", "j", {"a": "left right", "b": "nan"}), ("2", None, "T", None, "q", None, "no", None, None, "keep", "s2", "j2", None)]
    df = spark.createDataFrame(rows, "id string, guidebook string, topic string, subtopic string, question string, focus string, judgement string, evidence string, considerations string, query string, short_answer string, justification string, options map<string,string>")
    out = {r.id: r for r in model.translated(df, ["topic", "question", "judgement", "evidence", "focus"], model.stub_translator, options="options").collect()}
    assert out["1"].question == "q eno" and out["1"].options == {"a": "tfel thgir", "b": "nan"} and out["2"].options is None and out["1"].subtopic == ""
    made = {r.id: r for r in model.rebuilt_composites(df, G, "en").collect()}
    assert made["1"].query.startswith("- Topic: T") and made["1"].short_answer == "yes" and made["2"].query == "keep" and made["1"].justification == "- Evidence: e"
    assert model.translated_labels(("Evidence", "Notes"), model.stub_translator) == ("ecnedivE", "setoN")
    assert model.rebuilt_composites(df, G, "en", reuse_existing=True).filter("id = '1'").first().query == "old"


def test_parallel(spark):
    long = "x" * 100
    s = spark.createDataFrame([("1", long, "y" * 39), ("2", long, long), ("3", long, long), ("4", long, long)], "id string, a string, b string")
    t = spark.createDataFrame([("1", "y" * 29, ""), ("2", "y" * 30, ""), ("3", "y", " "), ("9", long, long)], "id string, a string, b string")
    e = spark.createDataFrame([("3", "a"), ("3", "b")], "id string, field string")
    got = {(r.id, r.field): r.status for r in parallel.gate(s, t, ["a", "b"], e).collect()}
    assert got == {("1", "a"): "truncated", ("2", "a"): "ok", ("2", "b"): "EMPTY", ("3", "a"): "pending", ("3", "b"): "EMPTY"}
    p = parallel.id_parity(s, t)
    assert p.first().asDict() == {"missing_in_target": 1, "missing_in_source": 1, "in_both": 3}
    with pytest.raises(ValueError):
        parallel.check_gate(parallel.gate(s, t, ["a", "b"], e), p)
    scored = model.scored(parallel.quality_pairs(s, t, ["a", "b", "a"]), model.stub_scorer)
    q = {r.field: (r.n, r.stdev) for r in parallel.quality_summary(scored).collect()}
    assert q["a"][0] == 3 and None in q and "b" not in q
    assert [r.id for r in parallel.worst(scored, k=2).collect()] == ["3", "1"]


def test_quoted_empty_and_long_texts(spark, tmp_path):
    d = str(tmp_path)
    df = spark.createDataFrame([("1", None, "\x00,"), ("2", "", ""), ("3", '""', None)], "id string, a string, b string")
    tables.write_csv(df, f"{d}/t.csv")
    for schema in (df.schema, None):
        assert {tuple(r) for r in tables.read_table(spark, f"{d}/t.csv", schema, quoted_empty=True).collect()} == {("1", None, "\x00,"), ("2", "", ""), ("3", '""', None)}
    assert {tuple(r) for r in tables.read_table(spark, f"{d}/t.csv").collect()} == {("1", None, "\x00,"), ("2", None, None), ("3", '""', None)}
    n = 20_000_001
    tables.write_jsonl(spark.range(1).select(F.repeat(F.lit("x"), F.lit(n)).alias("text")), f"{d}/t.jsonl")
    assert tables.read_table(spark, f"{d}/t.jsonl", "text string").select(F.length("text")).first()[0] == n


def test_sources(spark, tmp_path, capsys):
    d = str(tmp_path)
    df = spark.createDataFrame([("1", "é\"x\",\n", None), ("2", "NA", "")], "id string, a string, b string")
    tables.write_csv(df, f"{d}/t.csv")
    assert {(r.id, r.a, r.b) for r in tables.read_table(spark, f"{d}/t.csv").collect()} == {("1", "é\"x\",\n", None), ("2", "NA", None)}
    tables.write_jsonl(publish.compact(df), f"{d}/t.jsonl", one_file=True)
    said = "".join(p.read_text() for p in (tmp_path / "t.jsonl").glob("part-*"))
    assert "é" in said and said.count("\n") == 2 and '"b"' not in said
    assert tables.read_table(spark, f"{d}/t.jsonl").count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id": "1"}\n\n{"id": \n')
    with pytest.raises(Exception, match="bad.jsonl:3"):
        tables.read_jsonl(spark, f"file://{d}/bad.jsonl", df.schema).collect()
    (tmp_path / "ok.jsonl").write_text('{"id": "1", "a": "x"}\n\n{"id": "2"}\n{"id": "1", "a": "y"}\n')
    keyed = tables.last_by_id(tables.read_jsonl(spark, f"file://{d}/ok.jsonl", df.schema)).orderBy("line_no").collect()
    assert [(r.line_no, r.id, r.a) for r in keyed] == [(1, "1", "y"), (3, "2", None)]
    (tmp_path / "g.txt").write_text("one\n\n  \ntwo\r\nthree")
    assert [(r.doc_id, r.line_no, r.raw) for r in tables.read_lines(spark, f"{d}/g.txt").orderBy("line_no").collect()] == [("g.txt", 0, "one"), ("g.txt", 3, "two"), ("g.txt", 4, "three")]
    assert tables.read_or_none(spark, f"{d}/none.csv") is None and tables.read_flags(spark, f"{d}/none").count() == 0
    with pytest.raises(ValueError):
        tables.read_table(spark, "x.odd")
    tables.copy_if_absent(df, f"{d}/copy")
    assert tables.copy_if_absent(df.filter("id = '1'"), f"{d}/copy").count() == 2
    assert tables.stage(df, f"{d}/stage").count() == 2
    s = spark.createDataFrame([("all", "num_records", 2)], "section string, key string, value long")
    tables.write_summary(s, f"file://{d}/s.json")
    assert '"num_records": 2' in (tmp_path / "s.json").read_text()


def test_lines_of_a_file_in_blocks(spark, tmp_path):
    """Numbers go on from block to block, whichever tasks read them."""
    said = [f"line {i} " + "x" * (i * 37 % 101) if i % 5 else "" for i in range(3000)]
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("\n".join(said) + "\n")
    (tmp_path / "r.jsonl").write_text("\r\n".join(f'{{"id": "{i}"}}' if i % 3 else "" for i in range(2000)))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        got = tables.read_lines(spark, f"file://{tmp_path}/*.txt", keep_blank=True).collect()
        records = tables.read_jsonl(spark, f"file://{tmp_path}/r.jsonl", spark.createDataFrame([], "id string").schema).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for name in ("a.txt", "b.txt"):
        assert sorted((r.line_no, r.raw) for r in got if r.doc_id == name) == list(enumerate(said))
    assert sorted((r.line_no, r.id) for r in records) == [(i + 1, str(i)) for i in range(2000) if i % 3]


def test_write_splits(spark, tmp_path):
    df = spark.createDataFrame([("1", "train"), ("2", "dev"), ("3", "train"), ("4", None)], "id string, split string")
    tables.write_splits(df, f"{tmp_path}/s")
    of = lambda name: sorted(r.id for r in spark.read.json(f"{tmp_path}/s/split={name}").collect())
    assert of("train") == ["1", "3"] and of("dev") == ["2"]
    tables.write_splits(df, f"{tmp_path}/p", form="parquet")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 4


def test_all_customers_published(spark, tmp_path):
    """Customers of six digits and more are published as well."""
    from textmill.plans import queries as plans

    rows = [(k, "TOYS", f"c{k}", 1) for k in (7, 99_999, 100_000, 1_234_567)]
    spark.createDataFrame(rows, "c_custkey long, c_mktsegment string, c_name string, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    ids = {r.id for r in plans.alias_publish(spark, str(tmp_path)).collect()}
    assert ids == {"cust_00007", "cust_99999", "cust_100000", "cust_1234567"}


def test_patch_takes_the_first_row(spark):
    rows = spark.createDataFrame([("1", "a b", 2), ("1", "a c", 1), ("2", "a", 3), (None, "a", 4)], "id string, text string, at int").coalesce(1)
    patches = spark.createDataFrame([("1", "text", "a", "z", 1), ("3", "text", "a", "z", 1)], "id string, field string, find string, replacement string, ord int")
    said = lambda **k: sorted((r.text, r.n_applied) for r in curate.patched(rows, patches, ["text"], **k).collect())
    assert said() == [("a", 0), ("a", 0), ("a c", 0), ("z b", 1)]
    assert said(order=("at",)) == [("a", 0), ("a", 0), ("a b", 0), ("z c", 1)]


def test_gate_totals_and_error(spark):
    checked = spark.createDataFrame([("1", "f", 0.0, "EMPTY"), ("2", "f", 1.0, "ok"), ("1", "g", 0.0, "EMPTY")], "id string, field string, ratio double, status string")
    got = {r.field: (r.n, r.n_empty, r.median_ratio, r.min_ratio) for r in parallel.gate_totals(checked).collect()}
    assert got == {"f": (2, 1, 1.0, 1.0), "g": (1, 1, None, None)}
    many = spark.range(30).select(F.col("id").cast("string"), F.lit("f").alias("field"), F.lit(0.1).alias("ratio"), F.lit("truncated").alias("status"))
    parity = spark.createDataFrame([(0, 0, 5)], "missing_in_target long, missing_in_source long, in_both long")
    with pytest.raises(ValueError, match="and 10 more"):
        parallel.check_gate(many, parity)


def _chunked(text, budget):
    """Chunks of a text, sentence by sentence."""
    words = lambda t: [" ".join(t.split()[i : i + 40]) for i in range(0, len(t.split()), 40)]
    n = lambda t: len(t.split())
    several = lambda t: re.split(r"(?<=[.!?])\s+", t)

    def single(t):
        return len(t) <= 1800 and n(t) <= budget and not (n(t) > budget * 0.75 and len(several(t)) > 1)

    if single(text):
        return [[text]]
    out = []
    for p in (p for p in text.split("\n\n") if p.strip()):
        if single(p):
            out.append([p])
            continue
        most = int(budget * 0.75) if len(p) <= 1800 and n(p) <= budget else budget
        groups, held = [], []
        for s in (s for s in several(p) if s.strip()):
            tabular = s.count(":") + s.count(";") >= 3
            parts = [x for x in re.split(r"(?<=[:;])\s+", s) if x.strip()]
            if n(s) <= budget and not tabular or len(parts) <= 1 and n(s) <= budget:
                made, alone = [s], False
            elif len(parts) <= 1:
                made, alone = words(s), False
            else:
                made, alone = [y for x in parts for y in (words(x) if n(x) > budget else [x])], True
            for x in made:
                if held and (alone or sum(map(n, held)) + n(x) > most):
                    groups.append(" ".join(held))
                    held = []
                if alone:
                    groups.append(x)
                else:
                    held.append(x)
        out.append(groups + ([" ".join(held)] if held else []))
    return out


def test_chunk_plan(spark):
    r = random.Random(7)
    texts = ["a b c: d e f g h i j k", "a;b:c:d e f", "x " * 100 + ".", "One two three. Four five.", "a: b; c: d", "one\n\n\ntwo"]
    for _ in range(150):
        marks = r.choice([" ", " ", ". ", ": ", "; ", ":", "? ", "\n\n"])
        texts.append("".join(r.choice(["a", "bc", "def"]) + r.choice([" ", " ", " ", marks, ". "]) for _ in range(r.randint(1, 120))).strip())
    for budget in (5, 8, 30):
        df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", chunk.plan(F.col("text"), budget).alias("c"))
        for row in df.collect():
            assert row.c == _chunked(texts[row.id], budget), (budget, texts[row.id])
