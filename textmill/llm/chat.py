"""Chat formatting: reply trees to training conversations, in DataFrame functions only.

A tree's messages name their parent. Iterative self-joins by doubling (each round joins the table of jumps with itself
and makes every jump twice as long) give each message its depth and the score of its path from the root in as many
rounds as the depth has binary digits; leaves are ranked within their tree by path score; the chosen leaves' paths are
enumerated through the same jumps, longest last; each path is formatted as one conversation.

A turn is written `<turn ROLE>` line feed, text, `</turn>` line feed. Inside roles and texts `\\`, `<` and `>` are written
`\\\\`, `\\l` and `\\g`, so no mark can occur there, and reading back is exact.

Defined cases: a null text or role is empty; a null tree id is a tree of its own; a message whose parent is missing is
a root; a message on a cycle, or below one, has no root and so no path; equal scores go to the smaller leaf id; repeated
rows of a conversation are turns of their own (in order of role and text); a conversation is one row of output,
so its turns meet in one task, and no other group does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import written

OPEN, AFTER_ROLE, CLOSE = "<turn ", ">\n", "</turn>\n"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescaped(c: Column) -> Column:
    between = F.transform(F.split(c, r"\\\\"), lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")))
    return F.array_join(between, "\\")


def linear(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as trees without branches: tree, node, parent, role, text, score."""
    w = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").alias("tree"), "turn", "role", "text")
    return rows.select("tree", F.row_number().over(w).cast("long").alias("node"), "role", "text").select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _pair(a: str, b: str, left: str, right: str) -> Column:
    return F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree")) & (F.col(f"{a}.{left}") == F.col(f"{b}.{right}"))


def jumps(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, depth, total for each node under a root; tables tree, node, jump of 1, 2, 4, ... steps up)."""
    nodes = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"))
    known = nodes.select("tree", "node")
    state = nodes.alias("a").join(known.alias("b"), _pair("a", "b", "parent", "node"), "left").select("a.tree", "a.node", F.col("b.node").alias("jump"), F.when(F.col("b.node").isNull(), 0).otherwise(1).cast("long").alias("depth"), "total")
    state = written(state, "chat-jumps")
    tables: list[DataFrame] = []
    largest = state.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    for _ in range(int(largest).bit_length()):
        if not state.filter(F.col("jump").isNotNull()).limit(1).count():
            break
        tables.append(state.filter(F.col("jump").isNotNull()).select("tree", "node", "jump"))
        b = state.withColumnsRenamed({"jump": "next", "depth": "more", "total": "above"})
        under = state.filter(F.col("jump").isNotNull())  # the others have reached their roots and only answer
        joined = under.alias("a").join(b.alias("b"), _pair("a", "b", "jump", "node")).select("a.tree", "a.node", F.col("b.next").alias("jump"), (F.col("a.depth") + F.col("b.more")).alias("depth"), (F.col("a.total") + F.col("b.above")).alias("total"))
        state = written(joined.unionByName(state.filter(F.col("jump").isNull())), "chat-jumps")
    return state.filter(F.col("jump").isNull()).select("tree", "node", "depth", "total"), tables


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """tree, leaf, node, at (0 at the root) for the messages on the `best` highest-scored root-to-leaf paths of each tree."""
    reached, tables = jumps(messages)
    inner = messages.select("tree", F.col("parent").alias("node")).filter(F.col("node").isNotNull())
    leaves = reached.alias("a").join(inner.alias("b"), _pair("a", "b", "node", "node"), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), F.asc("node")))
    chosen = leaves.withColumn("rank", rank).filter(F.col("rank") <= best)
    on = chosen.select("tree", F.col("node").alias("leaf"), "node", F.col("depth").alias("at"))
    for i, table in enumerate(tables):
        on = written(on, "chat-paths") if i % 3 == 0 else on  # keeps the plan short: each round reads the one before twice
        up = on.filter(F.col("at") >= 1 << i).alias("a").join(table.alias("b"), _pair("a", "b", "node", "node"))
        on = on.unionByName(up.select("a.tree", "a.leaf", F.col("b.jump").alias("node"), (F.col("a.at") - (1 << i)).alias("at")))
    return on


def format_paths(messages: DataFrame, best: int = 1, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """tree, leaf, text, loss_spans (starts and ends of the texts to learn, in code points) for each chosen path."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    head, body = F.concat(F.lit(OPEN), escaped(role), F.lit(AFTER_ROLE)), escaped(text)
    turns = messages.select("tree", "node", head.alias("head"), body.alias("body"), role.isin(*loss_roles).alias("learn"))
    rows = paths(messages, best).alias("a").join(turns.alias("b"), _pair("a", "b", "node", "node")).select("a.tree", "a.leaf", "a.at", F.length("b.head").alias("h"), F.length("b.body").alias("n"), "b.learn", F.concat("b.head", "b.body", F.lit(CLOSE)).alias("turn"))
    end = F.sum(F.length("turn").cast("long")).over(Window.partitionBy("tree", "leaf").orderBy("at"))
    start = end - F.length("turn") + F.col("h")
    rows = rows.withColumn("span", F.when(F.col("learn"), F.struct(start.alias("start"), (start + F.col("n")).alias("end"))))
    whole = rows.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("at", "turn", "span"))).alias("turns"))
    return whole.select("tree", "leaf", F.array_join("turns.turn", "").alias("text"), F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """tree, leaf, turns (role, text), learnt (the texts under the loss spans): what the formatted text says."""
    pieces = F.slice(F.split("text", CLOSE), 1, F.size(F.split("text", CLOSE)) - 1)
    head = lambda p: F.substring_index(p, AFTER_ROLE, 1)
    turn = lambda p: F.struct(unescaped(F.substr(head(p), F.lit(len(OPEN) + 1))).alias("role"), unescaped(F.substr(p, F.length(head(p)) + len(AFTER_ROLE) + 1)).alias("text"))
    learnt = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("tree", "leaf", F.transform(pieces, turn).alias("turns"), learnt.alias("learnt"), F.length("text").cast("long").alias("chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id and the digest columns, all read back from the formatted text."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("learnt", "")
    return read_back(formatted).select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"), F.col("chars").alias("formatted_chars"))
