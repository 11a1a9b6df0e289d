"""Dictionary blocks: texts as codes into a dictionary of their block's distinct words.

A block is a run of a task's texts (BLOCK_BYTES of text, or BLOCK_WORDS distinct words, at most a text over). What has to
be looked up for each distinct word goes through a shuffle once for each block that has the word, packed by word bucket,
instead of once for each place; texts go through it as codes. Codes number a block's words by how often they occur, so most are small. Two kinds of rows are written
to the shared folder:

d: a text; the first of each few carries the codes of all of them, packed together
w: a bucket of a block's words with their codes (and counts)
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import written

BLOCK_BYTES = 32 << 20
BLOCK_WORDS = 600_000
#: Codes that are packed together.
PACK = 1 << 17
FIELDS = "kind string, block long, seq int, doc_id {id}, flag boolean, bucket int, n long, x binary, y binary, z binary"


def squeezed(a: np.ndarray | bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(a if isinstance(a, bytes) else a.tobytes())


def loose(b: bytes, dtype: str | None = None):
    raw = zstandard.ZstdDecompressor().decompress(b) if b else b""
    return raw if dtype is None else np.frombuffer(raw, dtype)


def planes(values: np.ndarray) -> bytes:
    """Small numbers by byte planes: the high ones are nearly all zero."""
    return squeezed(np.ascontiguousarray(values.astype("<u4").view("u1").reshape(-1, 4).T), 3)


def of_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(loose(b, "u1").reshape(4, -1).T).view("<u4").reshape(-1)


def ranks(codes: np.ndarray) -> bytes:
    """Frequency ranks: how many bits each has (which compresses well), then those below the highest, packed by that number (which don't)."""
    r = codes.astype(np.int64) + 1
    size = np.frexp(r.astype(np.float64))[1].astype(np.uint8) - np.uint8(1)
    head = squeezed(size)
    out = [len(head).to_bytes(4, "little"), head]
    for k in range(1, int(size.max(initial=0)) + 1):
        low = r[size == k] - (1 << k)
        bits = np.unpackbits(low.astype(">u4").view("u1").reshape(-1, 4), axis=1)[:, 32 - k :]
        out.append(np.packbits(bits).tobytes())
    return b"".join(out)


def of_ranks(b: bytes) -> np.ndarray:
    at = 4 + int.from_bytes(b[:4], "little")
    size = loose(b[4:at], "u1")
    out = np.zeros(len(size), np.int64)
    for k in range(1, int(size.max(initial=0)) + 1):
        mine = size == k
        n = int(mine.sum())
        raw = np.frombuffer(b, np.uint8, -(-n * k // 8), at)
        at += len(raw)
        out[mine] = np.unpackbits(raw)[: n * k].reshape(n, k) @ (1 << np.arange(k - 1, -1, -1)) + (1 << k) - 1
    return out.astype(np.uint32)


def word_blob(words: list[bytes]) -> bytes:
    """Words as the length they share with the one before, and the rest: sorted neighbours share much."""
    n, wide = len(words), 16
    length = np.fromiter(map(len, words), np.int64, n)
    m = np.array([w[:wide] for w in words], f"S{wide}").view("u1").reshape(n, wide)
    shared = np.zeros(n, np.int64)
    shared[1:] = np.minimum(np.logical_and.accumulate(m[1:] == m[:-1], axis=1).sum(axis=1), np.minimum(np.minimum(length[1:], length[:-1]), wide))
    rest = [w[k:] for w, k in zip(words, shared.tolist(), strict=True)]
    sizes = np.ascontiguousarray((length - shared).astype("<u4").view("u1").reshape(n, 4).T)
    return squeezed(shared.astype("u1").tobytes() + sizes.tobytes() + b"".join(rest), 9)


def blob_words(blob: bytes, n: int) -> list[bytes]:
    raw = loose(blob)
    ends = np.cumsum(np.ascontiguousarray(np.frombuffer(raw, "u1", 4 * n, n).reshape(4, n).T).view("<u4").reshape(-1), dtype=np.int64).tolist()
    body, out, last = raw[5 * n :], [], b""
    for k, a, b in zip(raw[:n], [0, *ends], ends, strict=False):
        last = last[:k] + body[a:b]
        out.append(last)
    return out


class _Codes(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Block:
    """One block under way."""

    def __init__(self, number: int, buckets: int, most: int = BLOCK_BYTES):
        self.number, self.buckets, self.most = number, buckets, most
        self.codes, self.bytes = _Codes(), 0
        self.texts: list[tuple] = []  # document, flag, codes

    def full(self) -> bool:
        return self.bytes >= self.most or len(self.codes) >= BLOCK_WORDS

    def add(self, doc, flag: bool, words: list[bytes], size: int) -> None:
        self.texts.append((doc, flag, np.fromiter(map(self.codes.__getitem__, words), np.uint32, len(words))))
        self.bytes += size

    def rows(self, with_counts: bool) -> Iterator[tuple]:
        words = list(self.codes)
        n = len(words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        seen = np.bincount(np.concatenate([c for *_, c in self.texts]), minlength=n)
        of = (hashes % np.uint64(self.buckets)).astype(np.int64)
        by_word = np.empty(n, np.int64)
        by_word[sorted(range(n), key=words.__getitem__)] = np.arange(n)
        order = np.lexsort((by_word, of, -seen))
        new = np.empty(n, np.uint32)
        new[order] = np.arange(n, dtype=np.uint32)
        counted = [c for _, flag, c in self.texts if flag] if with_counts else []
        counts = np.bincount(np.concatenate(counted), minlength=n) if counted else np.zeros(n, np.int64)
        held, size, seq = [], 0, 0
        for doc, flag, codes in self.texts:
            held.append((doc, flag, new[codes]))
            size += len(codes)
            if size >= PACK:
                yield from self._texts(held, seq)
                seq += len(held)
                held, size = [], 0
        yield from self._texts(held, seq)
        order = order[np.argsort(of[order], kind="stable")]
        cuts = np.searchsorted(of[order], np.arange(self.buckets + 1))
        for k in range(self.buckets):
            mine = order[cuts[k] : cuts[k + 1]]
            if len(mine):
                yield "w", self.number, None, None, None, k, len(mine), word_blob([words[i] for i in mine]), squeezed(np.diff(new[mine], prepend=np.uint32(0))), squeezed(counts[mine].astype("<u4")) if with_counts else None

    def _texts(self, held: list[tuple], seq: int) -> Iterator[tuple]:
        for i, (doc, flag, codes) in enumerate(held):
            yield "d", self.number, seq + i, doc, flag, None, len(codes), ranks(np.concatenate([c for *_, c in held])) if i == 0 else None, None, None


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4 << 20, many: int = 2000) -> Iterator[pa.RecordBatch]:
    """rows as Arrow batches of about `most` bytes."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += sum(len(v) for v in r if isinstance(v, (bytes, str)))
        if size >= most or len(held) >= many:
            yield record_batch(held, schema)
            held, size = [], 0
    if held:
        yield record_batch(held, schema)


def buckets_for(docs: DataFrame) -> int:
    """Word buckets: twice as many as the scan has partitions, so a bucket's share of the words keeps its size as the input grows."""
    return max(8, min(16_384, 2 * docs.rdd.getNumPartitions()))


def block_table(docs: DataFrame, split: Callable[[str], list[bytes]], buckets: int, with_counts: bool = False, most: int = BLOCK_BYTES) -> DataFrame:
    """The rows above for docs (doc_id, flag, text): flagged texts are counted."""
    id_type = docs.schema["doc_id"].dataType
    fields = FIELDS.format(id=id_type.simpleString())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def all_rows() -> Iterator[tuple]:
            nonlocal schema
            base, block = TaskContext.get().partitionId() << 24, None
            for b in batches:
                for doc, flag, text in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                    if block is None:
                        block = Block(base, buckets, most)
                        base += 1
                    block.add(doc, flag, split(text), len(text))
                    if block.full():
                        yield from block.rows(with_counts)
                        block = None
            if block is not None:
                yield from block.rows(with_counts)

        yield from in_batches(all_rows(), _schema(id_type))

    return written(docs.select("doc_id", "flag", "text").mapInArrow(rows, fields), "blocks")


def _schema(id_type) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    b = pa.binary()
    return pa.schema([("kind", pa.string()), ("block", pa.int64()), ("seq", pa.int32()), ("doc_id", to_arrow_type(id_type)), ("flag", pa.bool_()), ("bucket", pa.int32()), ("n", pa.int64()), ("x", b), ("y", b), ("z", b)])


def word_codes(y: bytes) -> np.ndarray:
    """The codes of a bucket's words, in their order."""
    return np.cumsum(loose(y, "<u4"), dtype=np.int64)


class Packed:
    """Hands out the codes of texts in the order of their rows."""

    def __init__(self):
        self.codes, self.at = np.zeros(0, np.uint32), 0

    def take(self, x: bytes | None, n: int) -> np.ndarray:
        if x is not None:
            self.codes, self.at = of_ranks(x), 0
        self.at += n
        return self.codes[self.at - n : self.at]


def by_block(table: DataFrame, answers: DataFrame) -> DataFrame:
    """A block's answers (block, n, x, y, z; seq is -1) and then its texts, beside one another in a partition:
    block, seq, doc_id, flag, n, x, y, z."""
    d = table.filter(F.col("kind") == "d").select("block", "seq", "doc_id", "flag", "n", "x", F.lit(None).cast("binary").alias("y"), F.lit(None).cast("binary").alias("z"))
    a = answers.select("block", F.lit(-1).alias("seq"), F.lit(None).cast(table.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("boolean").alias("flag"), "n", "x", "y", "z")
    return d.unionByName(a).repartition("block").sortWithinPartitions("block", "seq")
