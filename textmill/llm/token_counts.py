"""Token counts: Arrow batches, lengths only.

Texts are cut at boundaries that no pre-token of a byte-level BPE can cross, then the pieces of a byte-balanced batch
are encoded together by the tokenizers library, each distinct piece once. A cut is made before a single space, or
around a single line feed, that stands between two characters that are not white space: the split pattern of these
tokenizers lets a token hold white space only in front, and special tokens have none.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings inside a text are taken as the library
takes them by default; a text without any boundary is encoded whole; repeated rows and repeated ids each give a row;
columns other than the two named are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import BoundedCache, held, no_null_text, prepared, tokenizer

BATCH_BYTES = 1 << 20
_two_spaces = re.compile(r"\s\s|^ | $|\n \Z")
_cut = re.compile(r"(?<=\S)(?= \S)")


def n_bytes(text: str) -> int:
    return len(text) if text.isascii() else len(text.encode())


def balanced(items: list[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of items of `most` bytes of UTF-8 at most; a longer item stands alone."""
    batch, size = [], 0
    for x in items:
        n = n_bytes(x)
        if batch and size + n > most:
            yield batch
            batch, size = [], 0
        batch.append(x)
        size += n
    if batch:
        yield batch


def safe_pieces(text: str) -> tuple[list[str], list[str], int]:
    """(pieces as they are, pieces that follow a space, line feeds between) whose token counts add up to the text's."""
    if _two_spaces.search(text):
        return _cut.split(text), [], 0
    first, rest = [], []
    lines = text.split("\n")
    for line in lines:
        words = line.split(" ")
        first.append(words[0])
        rest += words[1:]
    return first, rest, len(lines) - 1


class Counter:
    """Counts tokens with one tokenizer file of the tokenizers library; holds bounded caches of piece lengths."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.plain = BoundedCache(lambda keys: self.lengths(keys, ""), 200_000)
        self.spaced = BoundedCache(lambda keys: self.lengths(keys, " "), 600_000)
        self.line_feed = self.lengths(["\n"], "")[0]

    def lengths(self, keys: list[str], before: str) -> list[int]:
        out: list[int] = []
        for batch in balanced(keys):
            out += [len(e.ids) for e in self.tokenizer.encode_batch_fast([before + k for k in batch], add_special_tokens=False)]
        return out

    def count(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for batch in balanced(texts):
            cut = [safe_pieces(t) for t in batch]
            plain = self.plain.ensure([w for first, _, _ in cut for w in first])
            spaced = self.spaced.ensure([w for _, rest, _ in cut for w in rest])
            out += [sum(map(plain.__getitem__, first)) + sum(map(spaced.__getitem__, rest)) + n * self.line_feed for first, rest, n in cut]
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row of docs, by the tokenizer file at path."""
    prepared(docs.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held(Counter, path)
        for b in batches:
            n = c.count(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    text = no_null_text(text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    out = docs.select(F.col(id_column).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")).mapInArrow(lengths, f"doc_id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
