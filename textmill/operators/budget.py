"""Chunks within a budget that a real tokenizer measures, over a table of sentences.

A tokenizer is Python and can't run inside a DataFrame's lambdas, so lengths are columns: texts and paragraphs are measured on their row, then sentences on
rows of their own, then the parts of those few sentences that are over the budget or tabular. Each is one Arrow call for a batch of rows, with no shuffle
between. Pieces are then gathered in blocks of a paragraph's order, BLOCK at most:

Texts of up to LONG characters a piece of BLOCK are placed by one shuffle on their paragraphs, longer ones by range partitions.

* a paragraph of one block is packed by a fold in its row, as chunk.plan() packs it;
* of a longer one, each block gives a table: for each number of tokens that a run may have when the block begins, the number it has behind it, and how many
  runs begin in it. Following the tables (one row a block) gives every block the state it begins with, whatever the length of the text,
  and each block then marks its own runs. No row holds more than a block, and no task a whole text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.text import is_nonblank
from textmill.operators import blocks as by_blocks
from textmill.operators import chunk
from textmill.session import kept, ship, written

#: Makes a tokenizer's function in a worker: a list of texts in, their numbers of tokens out.
Counter = Callable[[], Callable[[list[str]], list[int]]]
BLOCK = 2048
#: Characters that a text may have, for each piece that a block may have, to be placed by its key: a paragraph of it has LONG / 2 blocks at most.
LONG = 64


def white_space_counter() -> Callable[[list[str]], list[int]]:
    """A stand-in for a tokenizer: runs that white space parts."""
    return lambda texts: [len(t.split()) for t in texts]


def measured(make: Counter, name: str | None = None) -> Callable[[Column], Column]:
    """A column function from an array of texts to their lengths, null for null. The tokenizer is loaded once in a worker's life."""
    key = name or uuid.uuid4().hex

    @F.arrow_udf("array<bigint>")
    def lengths(texts: pa.Array) -> pa.Array:
        count = kept(key, make)
        flat = texts.flatten().to_pylist()
        some = [k for k, t in enumerate(flat) if t is not None]
        out: list = [None] * len(flat)
        for k, n in zip(some, count([flat[k] for k in some]) if some else [], strict=True):
            out[k] = n
        ends = np.concatenate([[0], np.cumsum([0 if x is None else x for x in texts.value_lengths().to_pylist()])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(out, pa.int64()))

    return lengths.asNondeterministic()  # else plans put the call into lambdas, where Python can't run


def _alone(text: Column, n: Column, budget: int) -> Column:
    """Fits, and isn't near the budget with several sentences."""
    return F.coalesce((n <= budget) & ((n <= budget * chunk.MARGIN) | (F.size(chunk.sentences(text)) <= 1)), F.lit(False))


def _short(text: Column) -> Column:
    """The text, or null where it has more characters than are measured."""
    return F.when(F.length(text) <= chunk.CHARACTERS, text)


def pieces(texts: DataFrame, make: Counter, budget: int = chunk.BUDGET, key: tuple[str, ...] = ("id", "field"), name: str | None = None) -> DataFrame:
    """key, para, sent, goal (of its paragraph's runs), item (text, tokens, alone) for each piece of texts (key, text), by the rules of chunk.plan()."""
    size = measured(make, name)
    k = list(key)
    none = F.array().cast("array<string>")
    paras = F.when(is_nonblank(F.col("text")), F.filter(F.split("text", "\n\n"), is_nonblank)).otherwise(none)
    rows = texts.select(*k, "text", paras.alias("_paras"))
    # a text that stands alone is its only paragraph
    rows = rows.withColumn("_n", size(F.concat(F.array(_short(F.col("text"))), F.transform("_paras", _short))))
    whole = is_nonblank(F.col("text")) & _alone(F.col("text"), F.get("_n", F.lit(0)), budget)
    sized = F.when(whole, F.array(F.struct(F.col("text").alias("t"), F.get("_n", F.lit(0)).alias("n"), F.lit(True).alias("whole")))).otherwise(
        F.transform("_paras", lambda t, i: F.struct(t.alias("t"), F.get("_n", i + 1).alias("n"), F.lit(False).alias("whole"))))
    p = rows.select(*k, F.posexplode(sized).alias("para", "p")).select(*k, "para", F.col("p.t").alias("_t"), F.col("p.n").alias("_n"), F.col("p.whole").alias("_whole"))
    p = p.withColumn("_one", F.col("_whole") | _alone(F.col("_t"), F.col("_n"), budget))
    goal = F.when(F.coalesce(F.col("_n") <= budget, F.lit(False)), F.lit(int(budget * chunk.MARGIN))).otherwise(F.lit(budget))
    s = p.select(*k, "para", goal.alias("goal"), "_one", "_n", F.posexplode(F.when(F.col("_one"), F.array("_t")).otherwise(chunk.sentences(F.col("_t")))).alias("sent", "_s"))
    s = s.withColumn("_n", F.when(F.col("_one"), F.col("_n")).otherwise(F.get(size(F.array(F.when(~F.col("_one"), F.col("_s")))), F.lit(0))))
    cut = ~F.col("_one") & ((F.col("_n") > budget) | chunk.is_tabular(F.col("_s")))
    # a sentence's parts and, as each may be too long, their word chunks; the sentence's own where it has no parts
    parts = F.when(cut, F.filter(F.split("_s", r"(?<=[:;])\s+"), is_nonblank)).otherwise(none)
    s = s.withColumn("_parts", parts)
    s = s.withColumn("_part_n", size(F.when(F.size("_parts") > 1, F.col("_parts")).otherwise(none)))
    long = F.when(F.size("_parts") > 1, F.filter("_parts", lambda x, i: F.get("_part_n", i) > budget)).when(cut & (F.col("_n") > budget), F.array("_s")).otherwise(none)
    s = s.withColumn("_chunks", F.transform(long, chunk.word_chunks)).withColumn("_chunk_n", size(F.flatten("_chunks")))
    piece = lambda t, n, alone: F.struct(t.alias("text"), n.cast("long").alias("tokens"), F.lit(alone).alias("alone"))
    before = lambda j: F.aggregate(F.slice("_chunks", F.lit(1), j), F.lit(0), lambda a, x: a + F.size(x))  # noqa: E731  chunks before the j-th
    chunked = lambda j, alone: F.transform(F.get("_chunks", j), lambda t, i: piece(t, F.get("_chunk_n", before(j) + i), alone))
    nth = lambda i: F.size(F.filter(F.slice("_part_n", F.lit(1), i), lambda n: n > budget))  # noqa: E731  which of the long parts this is
    of_parts = F.flatten(F.transform("_parts", lambda t, i: F.when(F.get("_part_n", i) > budget, chunked(nth(i), True)).otherwise(F.array(piece(t, F.get("_part_n", i), True)))))
    items = F.when(F.size("_parts") > 1, of_parts).when(cut & (F.col("_n") > budget), chunked(F.lit(0), False)).otherwise(F.array(piece(F.col("_s"), F.col("_n"), False)))
    out = s.select(*k, "para", "goal", "sent", F.posexplode(items).alias("_i", "item"))
    return out.select(*k, "para", F.struct("sent", "_i").alias("sent"), "goal", "item")


# states of a run when a block begins or ends: its tokens from 0 to the goal, more than the goal, no open run


def walked(tokens: np.ndarray, alone: np.ndarray, goal: int, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(states behind the pieces, runs that begin among them, for the first state: whether each piece begins one)."""
    over, none = goal + 1, goal + 2
    state, begun = state.copy(), np.zeros(len(state), np.int64)
    first = np.zeros(len(tokens), bool)
    for i, (n, one) in enumerate(zip(tokens.tolist(), alone.tolist(), strict=True)):
        if one:
            new, state = np.ones(len(state), bool), np.full(len(state), none)
        else:
            new = (state == none) | (state == over) | (state + n > goal)
            state = np.where(new, min(n, over), state + n)
        begun += new
        first[i] = new[0]
    return state, begun, first


def _tables(tokens: pa.Array, alone: pa.Array, goal: pa.Array) -> pa.Array:
    """A block's table."""
    out = []
    for t, a, g in zip(tokens, alone, goal.to_pylist(), strict=True):
        state, begun, _ = walked(np.array(t.as_py(), np.int64), np.array(a.as_py(), bool), g, np.arange(g + 3))
        out.append({"state": state.tolist(), "begun": begun.tolist()})
    return pa.array(out, pa.struct([("state", pa.list_(pa.int32())), ("begun", pa.list_(pa.int64()))]))


def _runs(tokens: pa.Array, alone: pa.Array, goal: pa.Array, state: pa.Array, before: pa.Array) -> pa.Array:
    """The number of each piece's run, by the state that its block begins with and the runs begun before it."""
    out = []
    for t, a, g, s, n in zip(tokens, alone, goal.to_pylist(), state.to_pylist(), before.to_pylist(), strict=True):
        _, _, first = walked(np.array(t.as_py(), np.int64), np.array(a.as_py(), bool), g, np.array([s]))
        out.append((n + np.cumsum(first) - 1).tolist())
    return pa.array(out, pa.list_(pa.int64()))


def grouped(short: DataFrame, long: DataFrame | None = None, key: tuple[str, ...] = ("id", "field"), block: int = BLOCK) -> DataFrame:
    """key, para, piece, text: consecutive pieces of a paragraph (key, para, sent, goal, item) packed to its goal, as chunk.packed() packs them. short: of
    paragraphs that a task may sort; long: of others."""
    k = [*key, "para"]
    at = short.withColumn("_place", (F.row_number().over(Window.partitionBy(*k).orderBy("sent")) - 1).cast("long"))
    if long is not None:
        at = at.unionByName(by_blocks.placed(long, k, ["sent"], "pieces"))
    blocks = at.groupBy(*k, F.floor(F.col("_place") / block).alias("block")).agg(F.min("goal").alias("goal"), F.array_sort(F.collect_list(F.struct("_place", "item"))).alias("_items"))
    blocks = blocks.select(*k, "block", "goal", F.transform("_items", lambda x: x["item"]).alias("items"))
    blocks = written(blocks.withColumn("n_blocks", F.count("*").over(Window.partitionBy(*k))), "piece-blocks")
    tables, runs_of = F.arrow_udf(_tables, "struct<state:array<int>,begun:array<bigint>>"), F.arrow_udf(_runs, "array<bigint>")
    once = blocks.filter("n_blocks = 1").select(*k, F.posexplode(chunk.packed(F.col("items"), F.col("goal"))).alias("piece", "text"))
    many = blocks.filter("n_blocks > 1")
    tokens, alone = F.col("items.tokens"), F.col("items.alone")
    steps = many.select(*k, "block", "goal", tables(tokens, alone, F.col("goal").cast("int")).alias("t"))
    begin = F.struct((F.first("goal") + 2).cast("int").alias("state"), F.lit(0).cast("long").alias("begun"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "t")))
    # what each block begins with, by following the tables
    step = lambda a, x: F.concat(a, F.array(F.struct(F.get(x["t"]["state"], F.element_at(a, -1)["state"]).alias("state"), (F.element_at(a, -1)["begun"] + F.get(x["t"]["begun"], F.element_at(a, -1)["state"])).alias("begun"))))
    entries = steps.groupBy(*k).agg(ordered.alias("_o"), begin.alias("_b"))
    entries = entries.select(*k, F.posexplode(F.aggregate("_o", F.array("_b"), step)).alias("block", "e"))
    placed = many.alias("a").join(entries.alias("b"), [by_blocks.same("a", "b", [*k, "block"])]).select("a.*", "e")
    runs = placed.select(*k, F.posexplode(F.arrays_zip("items", runs_of(tokens, alone, F.col("goal").cast("int"), F.col("e.state"), F.col("e.begun")).alias("run"))).alias("_i", "x"), "block")
    runs = runs.select(*k, F.col("x.run").cast("int").alias("piece"), F.struct("block", "_i", F.col("x.items.text").alias("t")).alias("x"))
    joined = runs.groupBy(*k, "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), " ").alias("text"))
    return once.unionByName(joined)


def planned(texts: DataFrame, make: Counter, budget: int = chunk.BUDGET, key: tuple[str, ...] = ("id", "field"), name: str | None = None, block: int = BLOCK) -> DataFrame:
    """key, para, piece, text for each chunk of texts (key, text): chunk.chunks() by the lengths of a tokenizer. name: of the tokenizer,
    so that plans share one in a worker."""
    ship(texts.sparkSession)
    name = name or uuid.uuid4().hex
    is_long = F.coalesce(F.length("text") > LONG * block, F.lit(False))
    cut = lambda some: pieces(some, make, budget, key, name)
    long = cut(texts.filter(is_long)) if texts.filter(is_long).limit(1).count() else None
    return grouped(cut(texts.filter(~is_long)), long, key, block)
