"""Reading and writing: tables by suffix, lines with their order, JSON Lines, stage tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textmill.session import small, written
from textmill.sources.stages import StageTable
from textmill.sources.workbook import read_workbook


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, quoted_empty: bool = False) -> DataFrame:
    """csv, tsv and tab, jsonl and ndjson, json (an array or object over many lines), parquet, orc, xlsx (its first sheet, read on the executors).

    Cells of CSV are text; nothing but an empty cell is null. quoted_empty: one in quotes is an empty text, which is how write_csv tells the two apart.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    r = spark.read if schema is None else spark.read.schema(schema)
    if suffix in ("csv", "tsv", "tab"):
        if quoted_empty:
            r = r.option("nullValue", None)  # no text stands for null, else Spark takes the empty one
        # what escapes an escape is NUL if unset, and is then dropped from quoted cells
        return r.csv(path, header=True, sep="," if suffix == "csv" else "\t", escape='"', charToEscapeQuoteEscaping='"', multiLine=True)
    if suffix in ("jsonl", "ndjson", "json"):
        return r.option("maxStringLen", (1 << 31) - 1).json(path, multiLine=suffix == "json", mode="FAILFAST")  # texts of any length, not of 20 million characters at most
    if suffix in ("parquet", "orc"):
        return r.format(suffix).load(path)
    if suffix == "xlsx":
        return read_workbook(spark, path)
    raise ValueError(f"no reader for {path}")


def read_or_none(spark: SparkSession, path: str, **kw) -> DataFrame | None:
    """None, with a word on stdout, where the path is missing."""
    if _exists(spark, path):
        return read_table(spark, path, **kw)
    print(f"{path} is missing; skipped")
    return None


def _numbered(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """path, name, no (from 0), line for each line of the files at path, of any size: files are read in blocks by many tasks.

    A line's number is its place in its block, after the lines of its file's blocks before. Blocks depend on how a plan is run, so the
    lines are written with theirs, once, and counted from there: one row for each block."""
    m = F.col("_metadata")
    read = spark.read.options(**options).text(path).select(m["file_path"].alias("path"), m["file_name"].alias("name"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    kept = written(read, "lines")
    blocks = kept.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select("path", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("offset"))
    return kept.join(small(offsets), ["path", "block"]).select("path", "name", (F.col("at") + F.col("offset")).cast("int").alias("no"), "line")


def read_lines(spark: SparkSession, path: str, keep_blank: bool = False) -> DataFrame:
    """doc_id (the file's name), line_no (from 0, blank lines counted), raw for each line that isn't blank."""
    lines = _numbered(spark, path).select(F.col("name").alias("doc_id"), F.col("no").alias("line_no"), F.col("line").alias("raw"))
    return lines if keep_blank else lines.filter(F.col("raw").rlike(r"(?U)\S"))


def explode_lines(docs: DataFrame, keep_blank: bool = False) -> DataFrame:
    """doc_id, line_no (from 0, blank lines counted), raw of docs (doc_id, text)."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line_no", "raw"))
    return lines if keep_blank else lines.filter(F.col("raw").rlike(r"(?U)\S"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records of a JSON Lines file, with line_no; a bad line is an error that names the file and line."""
    lines = _numbered(spark, path, lineSep="\n").withColumnsRenamed({"path": "file", "no": "i"})
    bad = "_bad"
    parsed = lines.filter(F.col("line").rlike(r"(?U)\S")).withColumn("r", F.from_json("line", T.StructType([*schema.fields, T.StructField(bad, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}))
    said = F.concat_ws(":", "file", (F.col("i") + 1).cast("string"), F.lit(" bad JSON"))
    checked = parsed.withColumn("line_no", F.when(F.col(f"r.{bad}").isNotNull(), F.raise_error(said).cast("int")).otherwise(F.col("i") + 1))
    return checked.select("line_no", *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def last_by_id(records: DataFrame, key: str = "id", order: str = "line_no") -> DataFrame:
    """One row for each key: its last values, at its first place."""
    w = Window.partitionBy(key)
    rank = F.row_number().over(w.orderBy(F.desc(order)))
    return records.withColumns({"_rank": rank, "_first": F.min(order).over(w)}).filter(F.col("_rank") == 1).withColumn(order, F.col("_first")).drop("_rank", "_first")


def read_flags(spark: SparkSession, path: str | None) -> DataFrame:
    """(id, field) pairs that a gate lets pass; none where the file is missing."""
    schema = "id string, field string"
    return spark.read.schema(schema).json(path).distinct() if path and _exists(spark, path) else spark.createDataFrame([], schema)


def write_jsonl(df: DataFrame, path: str, one_file: bool = False) -> None:
    """One object a line, in UTF-8, without null keys. one_file: a single part, for publication."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_splits(df: DataFrame, path: str, split: str = "split", form: str = "json") -> None:
    """An output for each split, in one pass and without a shuffle: folders split=NAME, whose rows keep all other columns."""
    df.write.mode("overwrite").partitionBy(split).format(form).save(path)


def stage(df: DataFrame, path: str) -> DataFrame:
    """df written as a new version of the stage table at path, and read again; earlier versions stay (see stages)."""
    t = StageTable(df.sparkSession, path)
    return t.read(t.write(df))


def copy_if_absent(df: DataFrame, path: str) -> DataFrame:
    """A curated copy: written only where there is none."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_summary(metrics: DataFrame, path: str | None = None) -> str:
    """A small table of section, key, value as an indented JSON object; also printed."""
    out: dict[str, dict[str, object]] = {}
    for r in metrics.orderBy("section", "key").collect():
        out.setdefault(r["section"], {})[r["key"]] = r["value"]
    said = json.dumps(out, ensure_ascii=False, indent=2)
    if path:
        spark = metrics.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
        stream.write(bytearray(said.encode()))
        stream.close()
    print(said)
    return said
