"""Helpers shared by the training-data operators: table reading, scratch tables, bounded caches."""

from __future__ import annotations

import gc
import os
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import session
from textmill.session import discard, ship, small  # noqa: F401


def prepared(spark: SparkSession) -> None:
    """The session as ship() leaves it."""
    ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder."""
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage and survives lost executors."""
    prepared(df.sparkSession)
    return session.written(df, name)


def sweep(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more: what was made of them has been written."""
    for _ in range(2):  # the first round lets go of what the second finds
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def no_null_text(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def tokenizer(path: str):
    """The tokenizer file at path, without truncation or padding. It encodes in the calling thread: a Python worker has one core, and
    a pool of threads in each would cost half as much again."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


_held: dict[tuple, object] = {}


def held(make, *key):
    """make(*key), kept in this Python worker until something else is asked for: workers outlive stages, and the caches of
    an earlier operator would stay in memory beside the next one's."""
    if (make, *key) not in _held:
        _held.clear()
        _held[make, *key] = make(*key)
    return _held[make, *key]


class BoundedCache(dict):
    """A dict that misses through fill(keys) and is emptied when it would pass `limit` entries, so its memory is bounded
    whatever the vocabulary; only speed depends on what it holds."""

    def __init__(self, fill, limit: int = 400_000, longest: int = 256):
        super().__init__()
        self.fill, self.limit, self.longest = fill, limit, longest

    def ensure(self, keys) -> dict:
        """A mapping that has every one of keys. Keys over `longest` characters are not kept for later."""
        missing = [k for k in set(keys) if k not in self]
        if not missing:
            return self
        if len(self) + len(missing) > self.limit:
            self.clear()
            missing = list(set(keys))
        got = dict(zip(missing, self.fill(missing), strict=True))
        if len(missing) > self.limit or any(len(k) > self.longest for k in missing):
            whole = {k: self[k] for k in set(keys) if k in self} | got
            self.update((k, v) for k, v in list(got.items())[: self.limit] if len(k) <= self.longest)
            return whole
        self.update(got)
        return self


#: Rows of a key from which keyed_join() takes it for hot.
HOT_ROWS = 100_000


def keyed_join(rows: DataFrame, lookup: DataFrame, key: str, n: Column, how: str = "left", hot: int = HOT_ROWS) -> DataFrame:
    """rows joined with lookup, which has one row for each key and knows how many rows a key has (n). Hot keys are at most a
    `hot`-th of the rows, so they are joined by a counted broadcast, and no task gathers one; the others are joined by a shuffle."""
    heavy = written(lookup.filter(n >= hot), "hot-keys")
    if not heavy.limit(1).count():
        return rows.join(lookup, key, how)
    light = rows.join(small(heavy.select(key)), key, "left_anti").join(lookup.filter(n < hot), key, how)
    return rows.join(small(heavy), key).unionByName(light)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables that hold whole runs of rows with equal first `keys` columns (none null), and the places where runs begin and the last ends.

    The rows must come with equal keys together. A run is held until it ends, so its size must be bounded."""
    held: list[pa.RecordBatch] = []

    def changes(b: pa.RecordBatch | pa.Table) -> np.ndarray:
        new = np.zeros(b.num_rows, bool)
        new[0] = True
        for c in range(keys):
            v = b.column(c).to_numpy(zero_copy_only=False) if isinstance(b, pa.RecordBatch) else b.column(c).to_numpy()
            new[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(new)

    def flush() -> tuple[pa.Table, list[int]]:
        t = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        return t, [*changes(t).tolist(), t.num_rows]

    for b in batches:
        if not b.num_rows:
            continue
        begins = changes(b)
        last = [held[-1].column(c)[held[-1].num_rows - 1].as_py() for c in range(keys)] if held else None
        if held and last != [b.column(c)[0].as_py() for c in range(keys)]:
            yield flush()
        if len(begins) > 1:  # the run at the end may go on in the next batch
            held.append(b.slice(0, begins[-1]))
            yield flush()
            b = b.slice(begins[-1])
        held.append(b)
    if held:
        yield flush()
