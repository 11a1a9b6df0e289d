"""Publication: alias resolution, composite fields, compact records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.names import find_column, ordered
from textmill.functions.patterns import Grammar
from textmill.functions.text import clean_field, is_nonblank, labelled, strip_label
from textmill.operators.curate import ensured_id

#: The record's columns, in order.
STANDARD = ["id", "source", "guidebook", "topic", "subtopic", "question", "focus", "judgement", "short_answer", "evidence", "considerations", "query", "justification", "options", "correct_answer", "split"]


def compact(df: DataFrame) -> DataFrame:
    """Blank texts, empty arrays and empty maps as null: a JSON writer leaves those out."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "string":
            c = F.nullif(clean_field(c), F.lit(""))
        elif kind.startswith(("array", "map")):
            c = F.when(F.size(c) > 0, c)
        out.append(c.alias(name))
    return df.select(*out)


def question_text(topic: Column, subtopic: Column, question: Column, focus: Column, labels: dict[str, str], existing: Column | None = None) -> Column:
    """The labelled parts of a question, a line each; `existing` is kept where it isn't blank."""
    made = labelled([(labels["topic"], topic), (labels["subtopic"], subtopic), (labels["question"], strip_label(question)), (labels["focus"], strip_label(focus))])
    return made if existing is None else F.when(is_nonblank(existing), existing).otherwise(made)


def justification(evidence: Column, considerations: Column, labels: tuple[str | Column, str | Column], dash: bool = True) -> Column:
    return labelled([(labels[0], evidence), (labels[1], considerations)], dash)


def normalised(df: DataFrame, aliases: dict[str, list[str]], g: Grammar, source: str, prefix: str, ordinal: Column, language: str = "en", split: str | None = None) -> DataFrame:
    """Records with the standard columns out of a table whose columns go by any of their aliases; only those with a
    question and a judgement. A split column of the table's own wins over `split`."""
    get = lambda name, required=False: clean_field(find_column(df, aliases.get(name, [name]), required).cast("string"))
    base = df.select(
        ensured_id(get("id"), prefix, ordinal).alias("id"),
        *[get(c, c in ("question", "judgement")).alias(c) for c in ("guidebook", "topic", "subtopic", "question", "focus", "judgement", "evidence", "considerations", "query")],
        F.coalesce(F.nullif(get("split"), F.lit("")), F.lit(split)).alias("split"),
    ).withColumn("source", F.lit(source))
    base = base.withColumns({"short_answer": F.col("judgement"), "justification": justification(F.col("evidence"), F.col("considerations"), g.justification_labels)})
    base = base.withColumn("query", question_text(F.col("topic"), F.col("subtopic"), F.col("question"), F.col("focus"), g.labels[language], F.col("query")))
    return ordered(compact(base.filter(is_nonblank(F.col("question")) & is_nonblank(F.col("judgement")))), STANDARD)


def check_any(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("no usable rows")
    return df


def summary(df: DataFrame) -> DataFrame:
    """section, key, value: records, by split, by topic where there is one."""
    every = df.agg(F.count("*").alias("value")).select(F.lit("all").alias("section"), F.lit("num_records").alias("key"), "value")
    by = lambda c, s: df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("key")).agg(F.count("*").alias("value")).select(F.lit(s).alias("section"), "key", "value")
    return every.unionByName(by("split", "splits")).unionByName(by("topic", "topics"))
