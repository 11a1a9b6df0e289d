"""Ordered lines to records, through layers of windows.

A line is an umbrella's, else a sub-question's, else a topic's, else plain; each layer is the last event that a line of the
layers below can see, so no state runs over lines. Plain lines open questions and labels and fill answers. Each flush
begins a new row, so a row's number is a running count, and its fields are gathered by it. segmented() partitions by document: a task holds one
document's lines. segmented_in_sections() takes documents of any length: it finds the topics' first lines by values carried over blocks of lines, cuts
documents there, where but three things go on (a heading that waits for its question, and two counts), and hands these on over one row a section.

Choices where sources differ: the intervention heading before a question belongs to it and not to the row before
(`late_intervention` restores that); a label directly behind a label keeps the mode from before both; a boundary line that also has an
answer's marker is that answer's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.patterns import Grammar
from textmill.functions.text import capitalised, clean_line, cut_narration, is_bullet, strip_footnotes
from textmill.operators import blocks as by_blocks
from textmill.session import small, written

LOOKAHEAD = 8

ANSWERS = ("judgement", "evidence", "considerations")


def cleaned(lines: DataFrame, g: Grammar) -> DataFrame:
    """doc_id, line_no, text, bullet for lines (doc_id, line_no, raw) that are left with text."""
    out = lines.select("doc_id", "line_no", clean_line(F.col("raw"), g).alias("text"), is_bullet(F.col("raw")).alias("bullet"))
    return out.filter(F.col("text") != "")


def _has(pattern: str) -> Column:
    return F.coalesce(F.col("text").rlike(f"(?u){pattern}"), F.lit(False))


def _marker(pattern: str) -> Column:
    return F.coalesce(F.col("text").rlike(f"(?iu){pattern}"), F.lit(False))


def _doc():
    return Window.partitionBy("doc_id").orderBy("line_no")


def carried(value: Column, key: tuple[str, ...] = ("doc_id",), order: str = "line_no", here: bool = True) -> Column:
    """The last value that isn't null, of the rows of a key up to this one; here: this one's too."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if here else -1))


def counted(event: Column, key: tuple[str, ...] = ("doc_id",), order: str = "line_no") -> Column:
    """How many rows of a key up to this one have the event: the number of the section that it is in."""
    return F.sum(event.cast("int")).over(Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))


def ahead(event: Column, key: tuple[str, ...] = ("doc_id",), order: str = "line_no") -> Column:
    """Whether the next row of a key has the event."""
    return F.coalesce(F.lead(event).over(Window.partitionBy(*key).orderBy(order)), F.lit(False))


def _last(value: Column, here: bool = False) -> Column:
    """The last value before a line, or up to it."""
    return carried(value, here=here)


def real_items(lines: DataFrame, g: Grammar, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """lines with `lettered` (its shape) and `item`: lettered, and a judgement stands within LOOKAHEAD lines, itself included, before the next lettered one."""
    w = Window.partitionBy(*key).orderBy("line_no")
    d = lines.withColumns({"lettered": _has(g.lettered), "_j": _marker(g.judgement)})
    j = F.min(F.when(F.col("_j"), F.col("line_no"))).over(w.rowsBetween(0, LOOKAHEAD - 1))
    b = F.min(F.when(F.col("lettered"), F.col("line_no"))).over(w.rowsBetween(1, LOOKAHEAD - 1))
    return d.withColumns({"_jn": j, "_bn": b}).withColumn("item", F.col("lettered") & F.col("_jn").isNotNull() & (F.col("_bn").isNull() | (F.col("_jn") < F.col("_bn")))).drop("_j", "_jn", "_bn")


def begins(lines: DataFrame, titles: DataFrame, lengths: list[int] | None = None, text: str = "text") -> DataFrame:
    """lines with `boundary`: the line begins with one of titles (title; and doc, where a title is for one document only).

    A join on equality for each length that titles have, by a counted broadcast where they are few; nothing compares all lines with all titles."""
    if lengths is None:
        lengths = sorted(r[0] for r in titles.select(F.length("title")).distinct().collect() if r[0])  # as many as titles have lengths
    own = "doc" in titles.columns
    out, hits = lines, F.lit(False)
    for n in lengths:
        t = titles.filter(F.length("title") == n).select(F.col("title").alias(f"_t{n}"), *([F.col("doc").alias(f"_d{n}")] if own else [])).distinct()
        on = F.left(F.col(text), F.lit(n)) == F.col(f"_t{n}")
        out = out.join(small(t), on & (F.col("doc_id").cast("string") == F.col(f"_d{n}")) if own else on, "left")
        hits = hits | F.col(f"_t{n}").isNotNull()
    return out.withColumn("boundary", hits).select(*lines.columns, "boundary")


def boundaries(lines: DataFrame, g: Grammar) -> DataFrame:
    """lines with `boundary`: the line begins with a literal registered for its document."""
    if not g.boundaries:
        return lines.withColumn("boundary", F.lit(False))
    titles = lines.sparkSession.createDataFrame(list(g.boundaries), "doc string, title string")
    return begins(lines, titles, sorted({len(t) for _, t in g.boundaries if t}))


def orphan_titles(lines: DataFrame, g: Grammar, name: Column | None = None) -> DataFrame:
    """lines with _ot and _os: the topic and subtopic registered for a document's nth (column `orphan`, from 0) heading without a topic; null for other lines."""
    if not g.orphans:
        return lines.withColumns({"_ot": F.lit(None).cast("string"), "_os": F.lit(None).cast("string")})
    table = lines.sparkSession.createDataFrame(list(g.orphans), "_od string, _on int, _ot string, _os string")
    on = ((F.col("doc_id") if name is None else name).cast("string") == F.col("_od")) & (F.col("orphan") == F.col("_on"))
    return lines.join(F.broadcast(table), on, "left").drop("_od", "_on")  # configuration


def looked_at(lines: DataFrame, g: Grammar, key: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """lines with what each shows by itself and the lines behind it."""
    d = boundaries(real_items(lines, g, key), g)
    return d.withColumns({
        "us": _has(g.umbrella_start), "ue": _has(g.umbrella_end), "nar": _marker(g.narration), "ss": _has(g.sub_start), "cx": _has(g.context), "ts": _has(g.topic_start),
        "lab": _has(g.label), "low": F.col("text").rlike(r"^\p{Ll}"), "heading": _has(g.intervention) | (F.col("text").isin(*g.pairs) if g.pairs else F.lit(False)),
        "mark": F.when(_marker(g.judgement), "judgement").when(_marker(g.evidence), "evidence").when(_marker(g.considerations), "considerations"),
        "next_item": ahead(F.col("lettered"), key),
    })


def classified(lines: DataFrame, g: Grammar) -> DataFrame:
    """lines with the layer that takes each (`rule`) and the events that the fields are made of."""
    return ruled(looked_at(lines, g), g)


def ruled(d: DataFrame, g: Grammar) -> DataFrame:
    """classified() of looked_at()."""
    # 1: a heading before an item
    d = d.withColumn("r1", F.col("heading") & F.col("next_item"))
    # umbrella
    open_ = F.coalesce(_last(F.when(~F.col("r1"), F.when(F.col("us"), 1).when(F.col("ue"), 0))), F.lit(0)) == 1
    d = d.withColumn("u_open", open_)
    d = d.withColumns({"r2": ~F.col("r1") & F.col("us"), "u_close": ~F.col("r1") & ~F.col("us") & F.col("u_open") & F.col("ue"), "r45": ~F.col("r1") & ~F.col("us") & F.col("u_open") & ~F.col("ue")})
    d = d.withColumn("left2", ~F.col("r1") & ~F.col("r2") & ~F.col("r45"))
    # sub-question
    d = d.withColumn("s_open", F.coalesce(_last(F.when(F.col("left2"), F.when(F.col("ss"), 1).when(F.col("cx"), 0))), F.lit(0)) == 1)
    d = d.withColumns({"r6": F.col("left2") & F.col("ss"), "r7": F.col("left2") & ~F.col("ss") & F.col("s_open") & F.col("cx"), "r8": F.col("left2") & ~F.col("ss") & F.col("s_open") & ~F.col("cx")})
    d = d.withColumn("left3", F.col("left2") & ~F.col("r6") & ~F.col("r7") & ~F.col("r8"))
    # topic
    event = F.when(F.col("r6"), 0).when(F.col("left3"), F.when(F.col("ts"), 1).when(F.col("cx"), 0))
    d = d.withColumns({"t_open": F.coalesce(_last(event), F.lit(0)) == 1, "t_no": counted(F.col("left3") & F.col("ts"))})
    within = F.col("left3") & ~F.col("ts") & F.col("t_open")
    topic = Window.partitionBy("doc_id", "t_no").orderBy("line_no")
    d = d.withColumn("_in", within)
    d = d.withColumn("_narrated", F.coalesce(F.max(F.when(F.col("_in") & F.col("nar"), 1)).over(topic.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1)
    stop = F.min(F.when(F.col("_in") & ~F.col("cx") & F.col("bullet") & F.col("_narrated"), F.col("line_no"))).over(Window.partitionBy("doc_id", "t_no"))
    d = d.withColumn("_stop", stop)
    inside = F.col("_in") & (F.col("_stop").isNull() | (F.col("line_no") <= F.col("_stop")))
    d = d.withColumn("_inside", inside)
    d = d.withColumns({
        "r9": F.col("left3") & F.col("ts"),
        "r11": F.col("_inside") & (F.col("line_no") == F.col("_stop")),
        "r10": F.col("_inside") & F.col("cx"),
        "r1213": F.col("_inside") & ~F.col("cx") & (F.col("_stop").isNull() | (F.col("line_no") < F.col("_stop"))),
        "t_cut": F.col("r6") & F.col("t_open") & (F.col("_stop").isNull() | (F.col("line_no") < F.col("_stop"))),
    })
    d = d.withColumn("left4", F.col("left3") & ~F.col("r9") & ~F.col("_inside"))
    d = d.withColumns({"r14": F.col("left4") & F.col("cx"), "left5": F.col("left4") & ~F.col("cx")})
    d = d.withColumns({"r15": F.col("left5") & F.col("item"), "orphan": F.when(F.col("r14"), counted(F.col("r14")) - 1)})
    d = d.withColumn("r16", F.col("left5") & ~F.col("r15") & F.col("lab"))
    plain = F.col("left5") & ~F.col("r15") & ~F.col("r16")
    all_ = F.col("r2") | F.col("r6") | F.col("r9") | F.col("r14")
    d = d.withColumns({"_plain": plain, "_all": all_})
    # 17: wrapped label
    shaped = F.col("_plain") & F.col("low") & F.col("mark").isNull()
    kind = F.when(F.col("_all"), 0).when(F.col("left5"), F.when(F.col("r16"), 1).when(~shaped, 0))
    d = d.withColumn("r17", shaped & (F.coalesce(_last(kind), F.lit(0)) == 1))
    # mode before the line, labels aside
    rest = F.col("_plain") & ~F.col("r17")
    hard = F.when(F.col("_all"), "none").when(F.col("r15"), "question").when(rest & F.col("mark").isNotNull(), F.col("mark"))
    soft = rest & F.col("mark").isNull() & F.col("boundary")
    d = d.withColumns({"_rest": rest, "_hard": hard, "_soft": soft})
    d = d.withColumns({"_mode": F.coalesce(_last(F.col("_hard")), F.lit("none")), "_hard_no": F.coalesce(_last(F.when(F.col("_hard").isNotNull(), F.col("line_no"))), F.lit(-1)), "_soft_no": F.coalesce(_last(F.when(F.col("_soft"), F.col("line_no"))), F.lit(-1))})
    ended = F.col("_mode").isin(*ANSWERS) & (F.col("_soft_no") > F.col("_hard_no"))
    d = d.withColumn("mode", F.when(ended, "none").otherwise(F.col("_mode")))
    d = d.withColumn("r18", F.col("_soft") & F.col("mode").isin(*ANSWERS))
    d = d.withColumn("r20", F.col("_rest") & F.col("mark").isNotNull())
    d = d.withColumn("r23", F.col("_rest") & ~F.col("r18") & F.col("mark").isNull())
    names = {"r1": 1, "r2": 2, "r45": 4, "r6": 6, "r7": 7, "r8": 8, "r9": 9, "r10": 10, "r11": 11, "r1213": 13, "r14": 14, "r15": 15, "r16": 16, "r17": 17, "r18": 18, "r20": 20, "r23": 23}
    rule = F.coalesce(*[F.when(F.col(c), F.lit(n)) for c, n in names.items()])
    return d.withColumn("rule", rule).select("doc_id", "line_no", "text", "bullet", "rule", "nar", "mark", "mode", "u_close", "t_cut", "orphan")


def _sections(d: DataFrame) -> DataFrame:
    """_doc, _kind, _no, _text: the lines that each layer has collected, one row for each time it was opened. A layer collects nothing
    once it is closed, so a section's lines are those before its close."""
    kind = F.when(F.col("rule") == 4, "u").when(F.col("rule") == 8, "s").when(F.col("rule") == 13, "t")
    no = F.when(F.col("rule") == 4, F.col("u_no")).when(F.col("rule") == 8, F.col("s_no")).otherwise(F.col("t_no"))
    parts = d.filter(F.col("rule").isin(4, 8, 13)).select(F.col("doc_id").alias("_doc"), kind.alias("_kind"), no.alias("_no"), "line_no", "text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: x["text"]), " ")
    return parts.groupBy("_doc", "_kind", "_no").agg(F.trim(text).alias("_text"))


def _title(kind: str | None = None, value: Column | None = None) -> Column:
    """A title: a text, or the section that it is the text of."""
    return F.struct(F.lit(kind).cast("string").alias("kind"), (F.col(f"{kind}_no") if kind else F.lit(None)).cast("int").alias("no"), (F.lit("") if value is None else value).alias("text"))


def _read(rows: DataFrame, sections: DataFrame, title: str) -> DataFrame:
    """rows with a title as its text; empty for none."""
    s = sections.select(*[F.col(c).alias(f"{c}_{title}") for c in sections.columns])
    on = F.col("doc_id").eqNullSafe(F.col(f"_doc_{title}")) & (F.col(f"{title}.kind") == F.col(f"_kind_{title}")) & (F.col(f"{title}.no") == F.col(f"_no_{title}"))
    out = rows.join(s, on, "left").withColumn(title, F.coalesce(F.col(f"_text_{title}"), F.col(f"{title}.text"), F.lit("")))
    return out.select(*rows.columns)


def segmented(lines: DataFrame, g: Grammar, late_intervention: bool = False) -> DataFrame:
    """Records of lines (doc_id, line_no, raw): doc_id, row_no, guidebook, topic, subtopic, question, focus, judgement, evidence, considerations."""
    return records(classified(cleaned(lines, g), g), g, late_intervention)


def _is(*n: int) -> Column:
    return F.col("rule").isin(*n)


RESET = (2, 6, 9, 14, 18)


def _waiting() -> Column:
    """A heading that waits for its question from this line on, or that none does."""
    return F.when(_is(1), F.struct(F.col("text").alias("v"))).when(_is(15, 20, 23), F.struct(F.lit(None).cast("string").alias("v")))


def segmented_in_sections(lines: DataFrame, g: Grammar, late_intervention: bool = False, block: int = by_blocks.BLOCK) -> DataFrame:
    """segmented(), where a task holds the lines of a section (up to the next topic) or of a block, and never a whole document."""
    key = ["doc_id"]
    d = by_blocks.in_blocks(cleaned(lines, g), key, ["line_no"], block)
    d = looked_at(by_blocks.with_next(d, LOOKAHEAD, block), g, ("doc_id", "_block")).filter("_own").drop("_own")
    d = written(d, "looked-at")
    # where the umbrella and the sub-question are open, as ruled() has it
    r1 = F.col("heading") & F.col("next_item")
    u = by_blocks.carried(d, F.when(~r1, F.when(F.col("us"), 1).when(F.col("ue"), 0)), "_u", key)
    left = ~r1 & ~F.col("us") & ((F.coalesce("_u", F.lit(0)) == 0) | F.col("ue"))
    s = by_blocks.carried(u, F.when(left, F.when(F.col("ss"), 1).when(F.col("cx"), 0)), "_s", key)
    topic = left & ~F.col("ss") & F.col("ts") & (F.coalesce("_s", F.lit(0)) == 0)
    cut = by_blocks.counted(s, topic, "_section", key).drop("_u", "_s", "_place", "_block")
    d = written(ruled(cut.withColumn("doc_id", F.struct("doc_id", "_section")).drop("_section"), g), "ruled")
    # what goes on behind a cut, by one row a section
    ends = d.groupBy("doc_id").agg(F.max_by(_waiting(), F.when(_waiting().isNotNull(), F.col("line_no"))).alias("_w"), F.count_if(_is(*RESET, 15, 16)).alias("_n"), F.count_if(_is(14)).alias("_o"))
    before = Window.partitionBy("doc_id.doc_id").orderBy("doc_id._section").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col("doc_id").alias("_d"), F.last("_w", ignorenulls=True).over(before).alias("_waits"), *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(to) for c, to in (("_n", "_rows"), ("_o", "_orphans"))))
    d = d.join(small(written(ends, "sections")), F.col("doc_id").eqNullSafe(F.col("_d"))).drop("_d")
    return records(d, g, late_intervention, cut=True)


def records(d: DataFrame, g: Grammar, late_intervention: bool = False, cut: bool = False) -> DataFrame:
    """The records of classified lines. cut: doc_id is (doc_id, _section), and lines have what goes on behind a cut."""
    is_, reset = _is, _is(*RESET)
    name = F.col("doc_id.doc_id" if cut else "doc_id")
    if cut:
        d = d.withColumn("orphan", F.col("orphan") + F.col("_orphans"))
    d = d.withColumns({"row": counted(reset | is_(15, 16)), "q": counted(reset | is_(15))})
    # the collecting layers: lines carry the number of the section that a title is the text of, and the rows fetch the text in the end
    d = d.withColumns({"u_no": counted(is_(2)), "s_no": counted(is_(6)), "t_no": counted(is_(9))})
    sections = _sections(d)
    section = Window.partitionBy("doc_id", "u_no").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("u_divided", F.coalesce(F.max(F.when(is_(4) & F.col("nar"), 1)).over(section), F.lit(0)) == 1)
    d = orphan_titles(d, g, name)
    empty = F.lit("")
    d = d.withColumn("pending", F.coalesce(_last(_waiting()), *([F.col("_waits")] if cut else [])))
    # a line's own event, then the last one up to it: a close of the umbrella comes before what the line does else
    topic = F.when(is_(14), _title(value=F.coalesce("_ot", empty))).when(is_(10, 11) | F.col("t_cut"), _title("t")).when(F.col("u_close"), _title("u"))
    divided = F.when(is_(9, 14), False).when(is_(11), True).when(F.col("u_close"), F.col("u_divided"))
    sub = F.when(reset, _title()).when(is_(7), _title("s"))
    adopted = F.when(is_(15), F.col("pending.v"))
    intervention = F.when(is_(9, 18), empty).when(is_(14), F.coalesce("_os", empty)).when(adopted.isNotNull(), adopted).when(F.col("u_close"), empty)
    d = d.withColumns({"topic": _last(topic, True), "divided": _last(divided, True), "sub": _last(sub, True), "intervention": _last(intervention, True)})
    if late_intervention:  # the heading that the row's closing question adopts
        d = d.withColumn("intervention", F.when(F.lead("rule").over(_doc()) == 15, F.coalesce(F.when(F.lead("pending.v").over(_doc()).isNotNull(), F.lead("pending.v").over(_doc())), F.col("intervention"))).otherwise(F.col("intervention")))
    marks = {"judgement": g.judgement, "evidence": g.evidence, "considerations": g.considerations}
    behind = F.coalesce(*[F.when(F.col("mark") == m, F.get(F.split("text", f"(?iu){p}", 2), F.lit(1))) for m, p in marks.items()])
    said = F.when(is_(20), behind).otherwise(F.col("text"))
    field = F.when(is_(20), F.col("mark")).when(is_(15), "question").when(is_(16, 17), "label").when(is_(23) & (F.col("mode") != "none"), F.col("mode"))
    d = d.withColumns({"field": field, "said": said})
    part = lambda f: F.array_sort(F.collect_list(F.when(F.col("field") == f, F.struct("line_no", "said"))))
    end = lambda c: F.max_by(c, "line_no").alias(c)
    rows = d.groupBy("doc_id", "q", "row").agg(*[part(f).alias(f) for f in ("question", "label", *ANSWERS)], end("topic"), end("divided"), end("sub"), end("intervention"), (F.first("_rows") if cut else F.max(F.lit(0))).alias("_rows"))
    text = lambda c: F.array_join(F.transform(c, lambda x: x["said"]), " ")
    by_question = Window.partitionBy("doc_id", "q").orderBy("row")
    rows = rows.withColumns({"question": F.trim(text(F.flatten(F.collect_list("question").over(by_question.rowsBetween(Window.unboundedPreceding, 0))))), "label": F.trim(text(F.col("label")))})
    rows = rows.withColumn("_own", F.when(F.size("judgement") > 0, F.col("judgement")))
    rows = rows.withColumn("_old", F.last("_own", ignorenulls=True).over(by_question.rowsBetween(Window.unboundedPreceding, -1)))
    none = F.array().cast(rows.schema["judgement"].dataType)
    rows = rows.filter(F.size(F.concat(*[F.col(c) for c in ANSWERS])) > 0).withColumn("judgement", F.when(F.col("_own").isNotNull(), F.col("_own")).when(F.col("label") != "", F.coalesce("_old", none)).otherwise(none))
    rows = _read(_read(rows, sections, "topic"), sections, "sub")
    by_sub = F.coalesce("divided", F.lit(False)) & (F.col("sub") != "")
    answer = lambda c: capitalised(strip_footnotes(text(F.col(c)), g)).alias(c)
    return rows.select(
        name.alias("doc_id"),
        (F.col("row") + F.col("_rows")).cast("long").alias("row_no"),
        name.cast("string").alias("guidebook"),
        cut_narration(F.col("topic"), g).alias("topic"),
        F.when(by_sub, F.col("sub")).otherwise(F.coalesce("intervention", empty)).alias("subtopic"),
        "question",
        F.when(F.col("label") != "", F.col("label")).when(~by_sub, F.col("sub")).otherwise(empty).alias("focus"),
        *[answer(c) for c in ANSWERS],
    )
