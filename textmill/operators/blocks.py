"""Running values over long groups in blocks: a group's rows are numbered without any task seeing them all, and what runs over a group (a carried
value, a count, a look at the next rows) is made inside each block and put together over one row a block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import small, written

BLOCK = 4096


def same(a: str, b: str, names: list[str]) -> Column:
    """Equal, nulls too, in all of these columns of two aliases."""
    out = F.lit(True)
    for c in names:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def placed(rows: DataFrame, key: list[str], order: list[str], name: str = "placed") -> DataFrame:
    """rows with `_place`, from 0 in each key by order (what is equal in all of it in any order, but always the same): places in written range partitions, behind the counts of those before."""
    kept = written(rows.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order).select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_at")), name)
    per = kept.groupBy(*key, "_p").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(*key, "_p", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"))
    return kept.alias("a").join(small(per).alias("b"), same("a", "b", [*key, "_p"])).select(*[F.col(f"a.{c}") for c in rows.columns], (F.col("a._at") + F.col("b._offset")).alias("_place"))


def in_blocks(rows: DataFrame, key: list[str], order: list[str], block: int = BLOCK) -> DataFrame:
    """placed() with `_block`, of `block` rows each."""
    return placed(rows, key, order).withColumn("_block", F.floor(F.col("_place") / block))


def with_next(rows: DataFrame, n: int, block: int) -> DataFrame:
    """rows with `_own`: each block also has copies of the n rows behind it (_own false), so that windows over (key, _block) may look n rows ahead."""
    copy = rows.filter((F.col("_block") > 0) & (F.col("_place") % block < n)).withColumn("_block", F.col("_block") - 1)
    return rows.withColumn("_own", F.lit(True)).unionByName(copy.withColumn("_own", F.lit(False)))


def _joined(rows: DataFrame, per: DataFrame, key: list[str]) -> DataFrame:
    return rows.alias("a").join(small(written(per, "blocks")).alias("b"), same("a", "b", [*key, "_block"]), "left").select("a.*", "b._before")


def carried(rows: DataFrame, value: Column, name: str, key: list[str], here: bool = False) -> DataFrame:
    """rows with the last value, if any, that isn't null before each row of its key (or up to it)."""
    inside = Window.partitionBy(*key, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0 if here else -1)
    rows = rows.withColumn("_value", value)
    per = rows.groupBy(*key, "_block").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_place"))).alias("_last"))
    earlier = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*key, "_block", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    return _joined(rows, per, key).withColumn(name, F.coalesce(F.last("_value", ignorenulls=True).over(inside), F.col("_before"))).drop("_value", "_before")


def counted(rows: DataFrame, event: Column, name: str, key: list[str]) -> DataFrame:
    """rows with how many rows of the key up to each have the event."""
    rows = rows.withColumn("_value", event.cast("long"))
    per = rows.groupBy(*key, "_block").agg(F.sum("_value").alias("_n"))
    earlier = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*key, "_block", F.sum("_n").over(earlier).alias("_before"))
    inside = Window.partitionBy(*key, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return _joined(rows, per, key).withColumn(name, F.coalesce(F.sum("_value").over(inside), F.lit(0)) + F.coalesce("_before", F.lit(0))).drop("_value", "_before")
