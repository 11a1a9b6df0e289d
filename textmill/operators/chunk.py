"""Token-budgeted chunks: sentences, oversize and tabular pieces, greedy packing, reassembly. All of it is folds over arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.text import is_nonblank, strip, token_count

BUDGET, MARGIN, CHARACTERS = 400, 0.75, 1800
TABULAR, WORDS = 3, 40

Length = Callable[[Column], Column]


def sentences(c: Column) -> Column:
    """The sentences of a text, or the text itself where there are none."""
    parts = F.filter(F.split(c, r"(?<=[.!?])\s+"), is_nonblank)
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(c))


def is_tabular(c: Column) -> Column:
    return F.regexp_count(c, F.lit("[:;]")) >= TABULAR


def word_chunks(c: Column) -> Column:
    words = F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(WORDS))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(WORDS)), " "))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is made once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pieces(sentence: Column, budget: int, length: Length = token_count) -> Column:
    """A sentence as (text, tokens, alone): whole if it fits and isn't tabular. Else it is cut behind colons and semicolons, its
    parts stand alone, and those still over the budget are cut every WORDS words. Without such a cut, a sentence over the budget is cut every WORDS words."""
    piece = lambda t, n, alone: F.struct(t.alias("text"), n.cast("long").alias("tokens"), F.lit(alone).alias("alone"))
    words = lambda t, alone: F.transform(word_chunks(t), lambda w: piece(w, length(w), alone))

    def part(t: Column) -> Column:
        return let(length(t), lambda n: F.when(n <= budget, F.array(piece(t, n, True))).otherwise(words(t, True)))

    def of(n: Column) -> Column:
        whole = F.array(piece(sentence, n, False))
        cut = let(F.filter(F.split(sentence, r"(?<=[:;])\s+"), is_nonblank), lambda parts: F.when(F.size(parts) > 1, F.flatten(F.transform(parts, part))).when(n <= budget, whole).otherwise(words(sentence, False)))
        return F.when((n <= budget) & ~is_tabular(sentence), whole).otherwise(cut)

    return let(length(sentence), of)


def packed(items: Column, budget: int | Column) -> Column:
    """Runs of consecutive pieces whose tokens are within the budget, joined by spaces; a piece that stands alone is a run."""
    first = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"), F.lit(0).cast("long").alias("n"))

    def step(a: Column, x: Column) -> Column:
        closed = F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"])))
        state = lambda done, text, n: F.struct(done.alias("done"), text.alias("open"), n.alias("n"))
        nothing = F.lit(None).cast("string")
        return (
            F.when(x["alone"], state(F.concat(closed, F.array(x["text"])), nothing, F.lit(0).cast("long")))
            .when(a["open"].isNotNull() & (a["n"] + x["tokens"] <= budget), state(a["done"], F.concat_ws(" ", a["open"], x["text"]), a["n"] + x["tokens"]))
            .otherwise(state(closed, x["text"], x["tokens"]))
        )

    return F.aggregate(items, first, step, lambda a: F.when(a["open"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["open"]))))


def fits(c: Column, budget: int = BUDGET, length: Length = token_count) -> Column:
    """Within the budget; texts over CHARACTERS characters aren't measured."""
    return (F.length(c) <= CHARACTERS) & (length(c) <= budget)


def plan(c: Column, budget: int = BUDGET, length: Length = token_count) -> Column:
    """A text as paragraphs of chunks. A text or paragraph that fits is one chunk, unless it is near the budget and has several
    sentences: those are packed to a smaller budget, while a sentence is still cut only over the whole one."""

    def alone(t: Column) -> Column:
        """Fits, and isn't near the budget with several sentences."""
        short = F.length(t) <= CHARACTERS
        return F.when(short, let(length(t), lambda n: (n <= budget) & ((n <= budget * MARGIN) | (F.size(sentences(t)) <= 1)))).otherwise(F.lit(False))

    def of(p: Column) -> Column:
        goal = F.when(fits(p, budget, length), F.lit(int(budget * MARGIN))).otherwise(F.lit(budget))
        return F.when(alone(p), F.array(p)).otherwise(let(goal, lambda most: packed(F.flatten(F.transform(sentences(p), lambda s: pieces(s, budget, length))), most)))

    paragraphs = F.filter(F.split(c, "\n\n"), is_nonblank)
    return F.when(~is_nonblank(c), F.array().cast("array<array<string>>")).when(alone(c), F.array(F.array(c))).otherwise(F.transform(paragraphs, of))


def chunks(texts: DataFrame, budget: int = BUDGET, length: Length = token_count, key: tuple[str, ...] = ("id", "field")) -> DataFrame:
    """key, para, piece, text for each chunk of texts (key, text)."""
    paras = texts.select(*key, F.posexplode(plan(F.col("text"), budget, length)).alias("para", "parts"))
    return paras.select(*key, "para", F.posexplode("parts").alias("piece", "text"))


def reassembled(chunked: DataFrame, key: tuple[str, ...] = ("id", "field"), text: str = "text") -> DataFrame:
    """key, text: pieces joined by a space, paragraphs by an empty line."""
    paras = chunked.groupBy(*key, "para").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", F.col(text).alias("t")))), lambda x: x["t"]), " ").alias("p"))
    return paras.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para", "p"))), lambda x: x["p"]), "\n\n").alias("text"))


def running(lines: DataFrame, boundary: Column, order: str = "line_no", key: str = "doc_id") -> DataFrame:
    """lines with `group`: the number of boundaries up to each line of its document."""
    return lines.withColumn("group", F.sum(boundary.cast("long")).over(Window.partitionBy(key).orderBy(order)))
