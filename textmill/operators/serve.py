"""A model's stage: the model is loaded once in a worker's life, batches are filled by tokens, a batch that fails is tried again text by text, and
the texts that fail alone go to a table of their own. The stage may ask for executors of its own kind (a resource profile).

Rows are sorted by length in their partition, so a batch's texts are of like length; a batch holds at most `tokens` tokens with padding (its longest
text times its texts) and `most` texts, but a text alone may be longer. The results are written once: reading the good and the failed rows runs no model
again, and what a lost executor had written stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.model import BATCH, LONGEST, SHORTEST_CAP, Loader
from textmill.session import kept, ship, written

#: Padded tokens of a batch.
TOKENS = BATCH * LONGEST
ERROR, MODEL = "_textmill_error", "_textmill_model"


class Served(NamedTuple):
    """done: the rows with their results; failed: rows that the model can't do, with `error` instead; load: the rows that each loaded model has served."""

    done: DataFrame
    failed: DataFrame
    load: DataFrame


def batches(lengths: list[int], tokens: int = TOKENS, most: int = BATCH) -> Iterator[tuple[int, int]]:
    """Where batches begin and end, of texts sorted by length."""
    at = 0
    while at < len(lengths):
        z = at + 1
        while z < len(lengths) and z - at < most and (z + 1 - at) * max(1, lengths[z]) <= tokens:
            z += 1
        yield at, z
        at = z


def cap(n: int) -> int:
    """The most tokens that may be made of a text of n tokens."""
    return min(LONGEST, max(SHORTEST_CAP, 3 * n))


def tried(f: Callable[[list[str], int], list[str]], texts: list[str], caps: list[int]) -> tuple[list[str | None], list[str | None]]:
    """(results, errors) of a batch; of one that fails, of its texts one by one. A text's cap is its own, whoever shares its batch."""
    out: list[str | None] = [None] * len(texts)
    errors: list[str | None] = [None] * len(texts)

    def run(places: list[int]) -> None:
        try:
            said = f([texts[k] for k in places], caps[places[0]])
            if len(said) != len(places):
                raise ValueError(f"{len(said)} results for {len(places)} texts")
        except Exception as e:
            if len(places) > 1:
                for k in places:
                    run([k])
            else:
                errors[places[0]] = f"{type(e).__name__}: {e}"
            return
        for k, t in zip(places, said, strict=True):
            out[k] = t

    by_cap: dict[int, list[int]] = {}
    for k, c in enumerate(caps):
        by_cap.setdefault(c, []).append(k)
    for places in by_cap.values():
        run(places)
    return out, errors


def served(texts: DataFrame, loader: Loader, text: str = "text", out: str = "text", tokens: int = TOKENS, most: int = BATCH, count: Callable[[str], int] | None = None, name: str | None = None, profile=None) -> Served:
    """The results of a model for each row of texts. count: tokens of a text (white-space ones if none is given); name: of the model, so that later
    stages find it loaded; profile: a pyspark.resource.ResourceProfile for the executors that the stage runs on. A null text is left null."""
    ship(texts.sparkSession)
    key = name or uuid.uuid4().hex
    columns = [c for c in texts.columns if c != out]
    sized = texts.sortWithinPartitions(F.coalesce(F.length(text), F.lit(0)))
    schema = ", ".join(f"`{c}` {dict(texts.dtypes)[c]}" for c in columns) + f", `{out}` string, {ERROR} string, {MODEL} string"
    names = [*columns, out, ERROR, MODEL]
    size = count or (lambda t: len(t.split()))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, loaded = kept(key, lambda: (loader(), uuid.uuid4().hex))  # a loaded model has an id of its own, so loading twice is seen
        for b in frames:
            said = b.column(b.schema.names.index(text)).to_pylist()
            order = sorted((k for k, t in enumerate(said) if t is not None), key=lambda k: (size(said[k]), k))
            lengths = [size(said[k]) for k in order]
            done: list[str | None] = [None] * len(said)
            wrong: list[str | None] = [None] * len(said)
            for a, z in batches(lengths, tokens, most):
                results, errors = tried(f, [said[k] for k in order[a:z]], [cap(n) for n in lengths[a:z]])
                for k, t, e in zip(order[a:z], results, errors, strict=True):
                    done[k], wrong[k] = t, e
            rest = [b.column(b.schema.names.index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(done, pa.string()), pa.array(wrong, pa.string()), pa.array([loaded] * len(said), pa.string())], names=names)

    made = written(sized.mapInArrow(run, schema, profile=profile), "served")
    done = made.filter(F.col(ERROR).isNull()).select(*texts.columns, *([out] if out not in texts.columns else []))
    failed = made.filter(F.col(ERROR).isNotNull()).select(*(c for c in columns if c != "error"), F.col(ERROR).alias("error"))
    return Served(done, failed, made.groupBy(F.col(MODEL).alias("model")).agg(F.count("*").alias("rows")))


def failing_stub() -> Callable[[list[str], int], list[str]]:
    """A deterministic stand-in that can't do texts with "the" in them: each word reversed."""

    def run(texts: list[str], most: int) -> list[str]:
        if any("the" in t for t in texts):
            raise ValueError("a text with the")
        return [" ".join(w[::-1] for w in t.split(" ")) for t in texts]

    return run
