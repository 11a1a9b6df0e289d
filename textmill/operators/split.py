"""Stratified splits of exact sizes.

A stratum's rows are ordered by a seeded digest of their keys, and a split takes the first of them. No stratum is sorted:
rows are counted by the head of their digest, which finds the head where a size is reached, and only the rows with that head are ranked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import small, written

#: Hexadecimal digits of a digest's head: a ranked group is a 4096th of its stratum.
HEAD = 3


def dealt(counts: DataFrame, size: int) -> DataFrame:
    """counts (_s, _c: one row for each stratum) with quota: `size` dealt in proportion, the remainder to the largest fractions (ties to the smaller stratum)."""
    counts = counts.filter(F.col("_c") > 0)
    c = counts.crossJoin(F.broadcast(counts.agg(F.sum("_c").alias("_t"))))  # one row
    exact = F.col("_c") * size / F.col("_t")
    c = c.withColumn("_q", F.floor(exact)).withColumn("_f", exact - F.floor(exact))
    left = c.agg((F.lit(size) - F.sum("_q")).alias("_left"))
    # one row for each stratum: ranked as a whole
    ranked = c.crossJoin(F.broadcast(left)).withColumn("_r", F.row_number().over(Window.orderBy(F.desc("_f"), "_s")))
    return ranked.select("_s", F.least(F.col("_q") + (F.col("_r") <= F.col("_left")).cast("long"), F.col("_c")).alias("quota"))


def quotas(rows: DataFrame, stratum: str, size: int) -> DataFrame:
    """stratum, quota of a table of rows."""
    return dealt(rows.groupBy(F.col(stratum).alias("_s")).agg(F.count("*").alias("_c")), size)


def cut(rows: DataFrame, stratum: str, key: str, sizes: list[int], seed: int = 42, name: str = "part") -> DataFrame:
    """rows with `name`: 0 for the first sizes[0] rows, 1 for the next sizes[1], and so on; len(sizes) for the others. Each part
    has each stratum in proportion to what the parts before it have left."""
    mark = F.coalesce(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), F.lit(""))  # rows without a key come first
    marked = rows.withColumns({"_m": mark, "_b": F.left(mark, F.lit(HEAD))})
    heads = written(marked.groupBy(F.col(stratum).alias("_s"), "_b").agg(F.count("*").alias("_n")), "heads")
    # ends: the rank in its stratum up to which each part goes
    ends = heads.groupBy("_s").agg(F.sum("_n").alias("_all")).withColumn("_e", F.lit(0).cast("long"))
    for i, size in enumerate(sizes):
        q = dealt(ends.select("_s", (F.col("_all") - F.col("_e")).alias("_c")), size).withColumnRenamed("_s", "_qs")
        ends = ends.join(q, F.col("_s").eqNullSafe(F.col("_qs")), "left").withColumn("_e", F.col("_e") + F.coalesce("quota", F.lit(0))).withColumn(f"_e{i}", F.col("_e")).drop("_qs", "quota")
    ends = ends.select(F.col("_s").alias("_es"), *[f"_e{i}" for i in range(len(sizes))])
    upto = F.sum("_n").over(Window.partitionBy("_s").orderBy("_b"))
    places = heads.withColumn("_to", upto).join(ends, F.col("_s").eqNullSafe(F.col("_es")))
    # the head that an end falls into, and the rows of the stratum before it
    edge = lambda i: F.min(F.when(F.col("_to") >= F.col(f"_e{i}"), F.struct("_b", (F.col("_to") - F.col("_n")).alias("before"), F.col(f"_e{i}").alias("end")))).alias(f"_x{i}")
    edges = small(written(places.groupBy("_s").agg(*[edge(i) for i in range(len(sizes))]), "edges"))
    joined = marked.join(edges, F.col(stratum).eqNullSafe(F.col("_s")))
    within = reduce(lambda a, b: a | b, [F.col("_b") == F.col(f"_x{i}._b") for i in range(len(sizes))], F.lit(False))
    ranked = joined.filter(within).withColumn("_r", F.row_number().over(Window.partitionBy("_s", "_b").orderBy("_m", key)))
    ranks = joined.filter(~within).withColumn("_r", F.lit(0)).unionByName(ranked)

    def inside(i: int) -> Column:
        x = F.col(f"_x{i}")
        return (F.col("_b") < x["_b"]) | ((F.col("_b") == x["_b"]) & (x["before"] + F.col("_r") <= x["end"]))

    part = F.coalesce(*[F.when(inside(i), i) for i in range(len(sizes))], F.lit(len(sizes)))
    return ranks.withColumn(name, part).select(*rows.columns, name)


def drawn(rows: DataFrame, stratum: str, key: str, size: int, seed: int = 42) -> DataFrame:
    """rows with `drawn`: true for `size` of them, each stratum in proportion, by the order of a seeded digest of the key."""
    return cut(rows, stratum, key, [size], seed, "drawn").withColumn("drawn", F.col("drawn") == 0)


def split(rows: DataFrame, stratum: str, key: str, test: int, dev: int, seed: int = 42) -> DataFrame:
    """rows with `split`: test first, then dev from what remains, the rest train."""
    return cut(rows, stratum, key, [test, dev], seed, "split").withColumn("split", F.element_at(F.array(*map(F.lit, ("test", "dev", "train"))), F.col("split") + 1))


def check_sizes(rows: DataFrame, **sizes: int) -> None:
    have = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    wrong = {k: have.get(k, 0) for k, n in sizes.items() if have.get(k, 0) != n}
    if wrong:
        raise ValueError(f"wanted {sizes}, have {wrong}")
