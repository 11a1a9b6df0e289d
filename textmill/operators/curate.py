"""Curation: keep-longest dedup, pattern filters, default fill, ids, keyed patches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.functions.patterns import Grammar, any_of
from textmill.functions.text import is_nonblank, strip
from textmill.session import small, written


def keep_longest(rows: DataFrame, key: list[str], length: Column, order: list[str]) -> DataFrame:
    """One row for each key (null is a value): the longest, of equals the first by `order`. A shuffle on the key; the best is
    found before it by max_by-style aggregation of the winner's order only, so a hot key moves no rows it won't keep."""
    best = F.max(F.struct(length.alias("_length"), *[(-F.col(c)).alias(c) for c in order]))
    winners = rows.groupBy(*key).agg(best.alias("_w")).select(*[F.col(f"_w.{c}").alias(f"_{c}") for c in order])
    on = reduce(lambda a, b: a & b, [F.col(c) == -F.col(f"_{c}") for c in order])
    return rows.join(winners, on, "left_semi")


def keep_longest_window(rows: DataFrame, key: list[str], length: Column, order: list[str]) -> DataFrame:
    """The same by a window: where `order` isn't unique in the table."""
    w = Window.partitionBy(*key).orderBy(length.desc(), *order)
    return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def refers_back(c: Column, g: Grammar) -> Column:
    return F.coalesce(c.rlike(f"(?iu){g.cross_reference}"), F.lit(False))


def says_no_evidence(c: Column, g: Grammar) -> Column:
    return F.coalesce(strip(c).rlike(f"(?iu)^{any_of(g.no_evidence)}"), F.lit(False))


def is_placeholder(evidence: Column, considerations: Column, g: Grammar) -> Column:
    """No evidence, and considerations that are empty or say nothing."""
    c = strip(F.coalesce(considerations, F.lit("")))
    return says_no_evidence(evidence, g) & ((c == "") | c.isin(*g.empty_considerations))


def filtered(rows: DataFrame, g: Grammar) -> DataFrame:
    """rows without cross-references and placeholders; blank evidence becomes the default."""
    kept = rows.filter(~refers_back(F.col("evidence"), g) & ~is_placeholder(F.col("evidence"), F.col("considerations"), g))
    return kept.withColumn("evidence", filled(F.col("evidence"), g.default_evidence))


def filled(c: Column, default: str) -> Column:
    return F.when(is_nonblank(c), c).otherwise(F.lit(default))


def removal_counts(rows: DataFrame, g: Grammar) -> DataFrame:
    """One row: what filtered() takes out, for which reason, and what it fills; one pass."""
    e, c = F.col("evidence"), F.col("considerations")
    refers, place = refers_back(e, g), is_placeholder(e, c, g)
    empty = strip(F.coalesce(c, F.lit(""))) == ""
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(refers).alias("n_cross_reference"),
        F.count_if(~refers & place & empty).alias("n_placeholder_empty"),
        F.count_if(~refers & place & ~empty).alias("n_placeholder_phrase"),
        F.count_if(~refers & ~place & ~is_nonblank(e)).alias("n_filled"),
    )


def with_ids(rows: DataFrame, prefix: str, order: list[str], name: str = "id") -> DataFrame:
    """rows with prefix_1, prefix_2, ... in order, without a window over the whole table: rows are range-partitioned by
    order, once, and written with their partition and place in it; each partition goes on from the sum of those before it.

    Ranges are sampled anew in each run of a plan, so places and counts must come from one run: hence the written table."""
    spark = rows.sparkSession
    at = F.monotonically_increasing_id()  # the partition above 33 bits of the place
    ranged = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "numbered")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    base, bases = 0, []
    for r in ranged.groupBy(part.alias("_p")).count().orderBy("_p").collect():  # one row for each partition
        bases.append((r["_p"], base))
        base += r["count"]
    b = spark.createDataFrame(bases or [(0, 0)], "_p long, _base long")
    out = ranged.join(F.broadcast(b), part == F.col("_p")).withColumn(name, F.concat(F.lit(f"{prefix}_"), (F.col("_base") + place + 1).cast("string")))
    return out.select(name, *[c for c in rows.columns if c != name])


def ensured_id(value: Column, prefix: str, ordinal: Column) -> Column:
    return F.coalesce(F.nullif(strip(value), F.lit("")), F.format_string(f"{prefix}_%05d", ordinal))


def suffix_number(c: Column) -> Column:
    """The number an id ends with."""
    return F.regexp_extract(c, r"(\d+)$", 1).try_cast("bigint")


def suffix_order(name: str = "id") -> list[Column]:
    """By the number an id ends with, then by the id."""
    return [suffix_number(F.col(name)), F.col(name)]


def by_suffix(rows: DataFrame, group: str = "guidebook", name: str = "id") -> DataFrame:
    return rows.orderBy(group, *suffix_order(name))


def patched(rows: DataFrame, patches: DataFrame, fields: list[str], key: str = "id", order: tuple[str, ...] = ()) -> DataFrame:
    """rows with the patches (id, field, find, replacement, ord) applied to the first row of each id, in order: each replaces
    the first occurrence of its text and does nothing where there is none. n_applied counts those that did something.

    The first row is the first by `order`, or as the table is read. Only rows whose id has a patch are joined and ranked."""
    grouped = patches.groupBy(F.col(key).alias("_key")).agg(*[F.array_sort(F.collect_list(F.when(F.col("field") == f, F.struct("ord", "find", "replacement")))).alias(f"_{f}") for f in fields])
    ids = small(patches.select(F.col(key).alias("_key")).distinct())
    others = rows.join(ids, F.col(key) == F.col("_key"), "left_anti").withColumn("n_applied", F.lit(0).cast("long"))
    some = rows.withColumn("_at", F.monotonically_increasing_id()).join(ids, F.col(key) == F.col("_key"), "left_semi")
    some = some.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order, "_at")))
    out = some.join(grouped, (F.col(key) == F.col("_key")) & (F.col("_rank") == 1), "left")

    def fold(s: Column, p: Column) -> Column:
        at = F.call_function("instr", s["v"], p["find"])
        new = F.concat(F.substr(s["v"], F.lit(1), at - 1), p["replacement"], F.substr(s["v"], at + F.length(p["find"])))
        return F.when(at > 0, F.struct(new.alias("v"), (s["n"] + 1).alias("n"))).otherwise(s)

    n = F.lit(0)
    for f in fields:
        done = F.aggregate(F.coalesce(F.col(f"_{f}"), F.array().cast(grouped.schema[f"_{f}"].dataType)), F.struct(F.col(f).alias("v"), F.lit(0).alias("n")), fold)
        out = out.withColumn(f"_r{f}", done)
        n = n + F.col(f"_r{f}.n")
    out = out.withColumn("n_applied", n.cast("long"))
    for f in fields:
        out = out.withColumn(f, F.col(f"_r{f}.v"))
    return others.unionByName(out.select(*rows.columns, "n_applied"))


def rebuilt(splits: dict[str, DataFrame], position: int = 1) -> DataFrame:
    """The union of split tables with the split's name as a column at `position`."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in splits.items()]
    out = reduce(lambda a, b: a.unionByName(b), tagged)
    rest = [c for c in out.columns if c != "split"]
    return out.select(*rest[:position], "split", *rest[position:])


def priority(order: tuple[str, ...] = ("test", "dev", "train")) -> Column:
    """The place of a row's split in `order`; other splits come behind."""
    return reduce(lambda c, p: c.when(F.col("split") == p[1], p[0]), enumerate(order), F.when(F.lit(False), -1)).otherwise(len(order))


def by_priority(rows: DataFrame, order: tuple[str, ...] = ("test", "dev", "train"), then: tuple[str, ...] = ()) -> DataFrame:
    return rows.orderBy(priority(order), *then)
