"""Models over texts: flatten records to texts, run a batch function, scatter results back. The function is the caller's."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions.patterns import Grammar
from textmill.functions.text import is_nonblank
from textmill.operators import chunk
from textmill.operators.publish import justification, question_text
from textmill.session import ship

#: A batch function's maker: called once in each task, it gives a function of a list of texts and a cap of new tokens.
Loader = Callable[[], Callable[[list[str], int], list[str]]]
BATCH, LONGEST, SHORTEST_CAP = 32, 512, 32


def flattened(records: DataFrame, fields: list[str], options: str | None = None, key: str = "id") -> DataFrame:
    """key, field, text for the fields that aren't blank; a map's entries as options.KEY, without "nan"."""
    long = records.select(key, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(key, fields, "field", "text")
    if options:
        entries = records.select(key, F.explode(options).alias("k", "text")).filter(F.lower("text") != "nan")
        long = long.unionByName(entries.select(key, F.concat(F.lit(f"{options}."), "k").alias("field"), "text"))
    return long.filter(is_nonblank(F.col("text")))


def scattered(records: DataFrame, texts: DataFrame, fields: list[str], options: str | None = None, key: str = "id") -> DataFrame:
    """records with the texts of `texts` (key, field, text) in their places; what isn't there stays."""
    wide = texts.filter(F.col("field").isin(fields)).groupBy(key).pivot("field", fields).agg(F.first("text")).withColumnsRenamed({f: f"_{f}" for f in fields}).withColumnRenamed(key, "_key")
    out = records.join(wide, F.col(key) == F.col("_key"), "left").drop("_key")
    out = out.withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).drop(*[f"_{f}" for f in fields])
    if options:
        back = texts.filter(F.col("field").startswith(f"{options}.")).groupBy(F.col(key).alias("_key")).agg(F.map_from_entries(F.collect_list(F.struct(F.substr("field", F.lit(len(options) + 2)), "text"))).alias("_o"))
        out = out.join(back, F.col(key) == F.col("_key"), "left")
        old = F.map_filter(options, lambda k, v: ~F.coalesce(F.map_contains_key("_o", k), F.lit(False)))
        out = out.withColumn(options, F.when(F.col("_o").isNull(), F.col(options)).otherwise(F.map_concat(old, "_o"))).drop("_key", "_o")
    return out.select(*records.columns)


def applied(texts: DataFrame, loader: Loader, text: str = "text", out: str = "text", batch: int = BATCH) -> DataFrame:
    """texts with the function's results. Rows are sorted by length within their partition, so a batch holds like
    lengths, and each text's cap follows its own length: results don't depend on which texts share a batch."""
    ship(texts.sparkSession)
    sized = texts.withColumn("_n", F.length(text)).sortWithinPartitions("_n", *texts.columns)
    schema = ", ".join(f"`{n}` {t}" for n, t in texts.dtypes if n != out) + f", `{out}` string"
    names = [n for n in texts.columns if n != out] + [out]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = loader()
        for frame in frames:
            said: list[str] = []
            for at in range(0, len(frame), batch):
                part = frame[text].iloc[at : at + batch].tolist()
                by_cap: dict[int, list[int]] = {}
                for i, t in enumerate(part):
                    by_cap.setdefault(min(LONGEST, max(SHORTEST_CAP, 3 * len(t.split()))), []).append(i)
                got = [""] * len(part)
                for cap, places in by_cap.items():
                    for i, r in zip(places, f([part[i] for i in places], cap), strict=True):
                        got[i] = r
                said += got
            frame[out] = said
            yield frame[names]

    return sized.mapInPandas(run, schema=schema)


def scored(pairs: DataFrame, loader: Callable[[], Callable[[list[str], list[str]], list[float]]], batch: int = 16) -> DataFrame:
    """pairs (..., src, mt) with qe_score. A worker holds one Arrow batch, which session.ship() bounds in rows and bytes, and the texts of one call."""
    ship(pairs.sparkSession)
    schema = ", ".join(f"`{n}` {t}" for n, t in pairs.dtypes) + ", qe_score double"
    names = [*pairs.columns, "qe_score"]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = loader()
        for b in frames:
            src, mt = (b.column(b.schema.names.index(c)) for c in ("src", "mt"))
            scores: list[float] = []
            for at in range(0, b.num_rows, batch):
                scores += f(src.slice(at, batch).to_pylist(), mt.slice(at, batch).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64(), from_pandas=True)], names=names)

    return pairs.mapInArrow(run, schema=schema)


def stub_translator() -> Callable[[list[str], int], list[str]]:
    """A deterministic stand-in: each word reversed."""
    return lambda texts, cap: [" ".join(w[::-1] for w in t.split(" ")) for t in texts]


def stub_scorer() -> Callable[[list[str], list[str]], list[float]]:
    """A deterministic stand-in: the ratio of the shorter length to the longer."""
    return lambda src, mt: [min(len(a), len(b)) / max(len(a), len(b), 1) for a, b in zip(src, mt, strict=True)]


def translated(records: DataFrame, fields: list[str], loader: Loader, budget: int = chunk.BUDGET, options: str | None = None, key: str = "id") -> DataFrame:
    """records with their fields translated in chunks and put together again."""
    parts = chunk.chunks(flattened(records, fields, options, key), budget, key=(key, "field"))
    return scattered(records, chunk.reassembled(applied(parts, loader), (key, "field")), fields, options, key)


def rebuilt_composites(records: DataFrame, g: Grammar, language: str, reuse_existing: bool = False, labels: tuple[str | Column, str | Column] | None = None) -> DataFrame:
    """short_answer, query and justification made anew from their translated parts, where the record has a guidebook."""
    c = F.col
    guided = is_nonblank(c("guidebook"))
    query = question_text(c("topic"), c("subtopic"), c("question"), c("focus"), g.labels[language], c("query") if reuse_existing else None)
    return records.withColumns({
        "short_answer": F.when(guided, c("judgement")).otherwise(c("short_answer")),
        "query": F.when(guided, query).otherwise(c("query")),
        "justification": F.when(guided, justification(c("evidence"), c("considerations"), labels or g.justification_labels, dash=labels is None)).otherwise(c("justification")),
    })


def translated_labels(labels: tuple[str, ...], loader: Loader) -> tuple[str, ...]:
    """A few fixed phrases through the same function, once, on the driver."""
    return tuple(loader()(list(labels), LONGEST))
