from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.names import canonical_name, find_column, inserted, ordered
from textmill.functions.patterns import Grammar

G = Grammar(acronyms=("NPK",))


def values(spark, fn, items):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r.v for r in df.select("i", fn(F.col("x")).alias("v")).orderBy("i").collect()]


def test_clean_line(spark):
    said = values(spark, lambda c: T.clean_line(c, G), ["  • - soil  ", "\x07a\x1fb", "Garden handbook 12", "12 garden handbook", "Garden handbook of", "  x ", "- -\t* y", "", None, "$\\bullet$ z"])
    assert said == ["soil", "ab", "", "", "Garden handbook of", "x", "y", "", None, "z"]
    assert values(spark, T.is_bullet, [" • a", "- a", "▪", None]) == [True, False, True, None]


def test_clean_field(spark):
    assert values(spark, T.clean_field, ["a\r\nb\rc", " x \t y ", "p\n\n\n\n\nq", None, "NA", " "]) == ["a\nb\nc", "x y", "p\n\nq", "", "NA", ""]


def test_capitalised(spark):
    assert values(spark, T.capitalised, ["(élan VITAL", "12", "", None, "\U0001f600 ab\ncd", "ñu"]) == ["(Élan VITAL", "12", "", None, "\U0001f600 Ab\ncd", "Ñu"]


def test_narration(spark):
    got = values(spark, lambda c: T.cut_narration(c, G), ["Soil. Water. This question is divided into two.", "The question is divided into", "Plain question", "", None])
    assert got == ["Soil. Water.", "", "Plain question", "", None]


def test_footnotes(spark):
    items = ["soil12, ends", "range29-31.", "paren)4 x", "half%7;", "kg/m2 of", "per kg/m2 x", "NPK3 mix", "XNPK3 mix", "DNA3 x", "abc1d", "chain1.2.3 z", "Word12", None, "quote\"5 y"]
    assert values(spark, lambda c: T.strip_footnotes(c, G), items) == ["soil, ends", "range.", "paren) x", "half%;", "kg/m2 of", "per kg/m2 x", "NPK mix", "XNPK3 mix", "DNA3 x", "abc1d", "chain z", "Word", None, "quote\" y"]
    assert values(spark, lambda c: T.footnote_count(c, G), ["a1,2,3 b", "c29-31.", "NPK3 d4 e", "none", None]) == [3, 2, 2, 0, 0]


def test_counts(spark):
    items = ["Vía sín tomas. año2 x_y!? ", "", " ", None, "..."]
    assert values(spark, T.sentence_count, items) == [2, 0, 0, 0, 0]
    assert values(spark, T.word_count, items) == [5, 0, 0, 0, 0]
    assert values(spark, T.token_count, items) == [5, 0, 0, 0, 1]
    assert values(spark, T.is_nonblank, items + [" "]) == [True, False, False, False, True, False]


def test_markers_and_leaks(spark):
    assert values(spark, lambda c: T.after_marker(c, G.evidence), ["- Evidence 3,4: poor", "x evidence summary: y Evidence: z", "no", None]) == ["poor", "y Evidence: z", None, None]
    assert values(spark, T.has_leak, ["End. 2.1. Heading", "End. 2.1. Heading: no", "End. 2 Heading. More", None, "x. 1.2.3.4 Ab  "]) == [True, False, False, False, True]
    assert values(spark, T.hyphen_words, ["see (well- known) x", "no-break", None, "ÁB a-\nb"]) == ["well- known", None, None, "a- b"]
    assert values(spark, T.strip_label, ["a) why", "b.2. how", "plain", "1.3. x"]) == ["why", "how", "plain", "x"]


def test_ratio_and_names(spark):
    df = spark.createDataFrame([("x" * 40, "y" * 12), ("x" * 39, "y"), ("x" * 100, None), (None, "a")], "s string, t string")
    assert [r[0] for r in df.select(T.length_ratio(F.col("s"), F.col("t"))).collect()] == [0.3, None, 0.0, None]
    assert canonical_name("  Clinical-Question (v2) ") == "clinical_question_v2" and canonical_name("Año") == "a_o"
    assert values(spark, T.canonical, ["  Clinical-Question ", "Año", None]) == ["clinical_question", "a_o", None]
    t = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-B` int, c int")
    assert t.select(find_column(t, ["x", "a_b"])).first()[0] == 2 and t.select(find_column(t, ["x"])).first()[0] == ""
    assert ordered(t, ["c"]).columns == ["c", "A b", "a-B"] and inserted(t, "c", F.lit(1), 0).columns[0] == "c"


def test_hostile_texts_end(spark):
    """Runs of 100000 repeats take neither the stack nor quadratic time."""
    texts = ["a1" + ",1" * 100_000 + " b", "a1" + "-1" * 100_000 + "x", "NPK1" + ".2" * 100_000, "x" + " " * 100_000 + "y", " " * 100_000 + "z ", "a" * 100_000 + "- b"]
    assert [len(t) for t in values(spark, lambda c: T.strip_footnotes(c, G), texts)[:3]] == [3, 200_003, 3]
    assert values(spark, lambda c: T.footnote_count(c, G), texts)[:3] == [100_001, 0, 100_001]
    assert values(spark, T.strip, texts)[3:5] == [texts[3], "z"]
    assert values(spark, T.token_count, texts)[3] == 2


def test_footnotes_behind_units_and_names(spark):
    items = ["kg/m2 x", "Mg/M21, y", "km/h3 z", "Media4 a", "it’5 b", "a1,2345 b", "a1-2-3x", "a7.8, b", "kg/m2,3 x"]
    assert values(spark, lambda c: T.strip_footnotes(c, G), items) == ["kg/m2 x", "Mg/M21, y", "km/h z", "Media4 a", "it’ b", "a,2345 b", "a1-2-3x", "a, b", "kg/m2,3 x"]


def test_words_around_a_hyphen(spark):
    """The words are those that the whole pattern finds, in random texts of several scripts, and a text of a million characters takes seconds."""
    import random
    import re
    import time

    from pyspark.sql import functions as F

    r = random.Random(5)
    texts = ["".join(r.choice("ab-- \n\t.,(1éÄя) ") for _ in range(r.randint(0, 60))) for _ in range(4000)] + ["x(well- known2), more- or"]
    got = [x.w for x in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(T.hyphen_words(F.col("t")).alias("w")).collect()]

    def words(t):
        if not re.search(r"[abxeéяlmorwknu]-[ \t\n]+[abxeéяlmorwknu]", t):
            return None
        return " ".join(w.strip("0123456789.,()") for w in re.search(r"(\S*[abxeéяlmorwknu]-\s+[abxeéяlmorwknu]\S*)", t)[1].split())

    assert got == [words(t) for t in texts]
    began = time.time()
    n = 1_000_000
    text = F.concat(F.repeat(F.lit("ab1"), n // 3), F.lit("x- yz"), F.repeat(F.lit("1"), n), F.lit("a"))
    assert spark.range(1).select(F.length(T.hyphen_words(text)).alias("n")).first().n > n
    notes = F.concat(F.repeat(F.lit("Media b c)d"), n // 11), F.lit("e12, f"))
    assert spark.range(1).select(F.right(T.strip_footnotes(notes), F.lit(4)).alias("e")).first().e == "e, f"
    assert time.time() - began < 30
