"""BPE encoding and decoding through a table of distinct words.

Texts are split into words at places that no pre-token crosses (before a single space, around a single line feed: see
token_counts; before a full stop or comma behind a letter or digit). The words of all blocks meet by bucket; there each distinct word of the
corpus is encoded once, whatever the vocabulary, and its ids go back to the
blocks whose texts have it, where they are joined back by position. Decoding looks each id up in the id-to-piece table
(as long as the vocabulary, so it can be broadcast) and joins the pieces of a text.

Defined cases: a null or empty text has no ids and decodes to the empty text; special strings inside a text are taken as
the library takes them by default; a text without boundaries is one word; repeated rows and ids each give a row, an empty
table none; columns other than the id and the text, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import blocks
from textmill.llm.common import no_null_text, prepared, tokenizer
from textmill.llm.token_counts import balanced

_two_spaces = re.compile(r"\s\s|^ | $|\n \Z|\0")
_cut = re.compile(r"(?<=\S)(?= \S)")
#: A full stop or comma beside another mark, or behind white space, with which it is one pre-token.
_touching = re.compile(r"[.,](?:(?=[^\w\s]|[_\x1c-\x1f])|(?<=[^\w\s].)|(?<=[_\x1c-\x1f].)|(?<=\s.))")


def split_words(text: str) -> list[bytes]:
    """The text's words, which joined are the text."""
    if not text:
        return []
    if _two_spaces.search(text):
        return [w.encode() for w in _cut.split(text)]
    raw = text.encode().replace(b"\n", b"\0\n\0").replace(b" ", b"\0 ")
    if not _touching.search(text):
        raw = raw.replace(b".", b"\0.").replace(b",", b"\0,")
    return [w for w in raw.split(b"\0") if w]


class Words:
    """Ids of the words of one bucket, each encoded once. A bucket's distinct words are held until the next bucket begins; buckets
    are so many that this is about a partition's share of the words (blocks.buckets_for)."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.bucket, self.ids = None, {}

    def of(self, bucket: int, words: list[bytes]) -> list[bytes]:
        if bucket != self.bucket:
            self.bucket, self.ids = bucket, {}
        new = [w for w in words if w not in self.ids]
        self.ids.update(zip(new, self.encode(new), strict=True))
        return list(map(self.ids.__getitem__, words))

    def encode(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for batch in balanced([w.decode() for w in words]):
            out += [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]
        return out


def piece_table(path: str) -> list[bytes]:
    """Bytes of each id, by the byte-level rule: visible Latin-1 characters stand for themselves, the other bytes in order for 256 and up."""
    from tokenizers import Tokenizer

    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}
    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        out[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
    return out


def _word_ids(table: DataFrame, path: str) -> DataFrame:
    """block, bucket, n, x (codes), y (number of ids of each), z (ids): each distinct word is encoded in its bucket's task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for b in batches:
            out = []
            for bucket, block, n, x, y in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                ids = words.of(bucket, blocks.blob_words(x, n))
                out.append((block, n, y, blocks.planes(np.fromiter(map(len, ids), "<u4", n) // 4), blocks.planes(np.frombuffer(b"".join(ids), "<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate([pa.int64(), pa.int64(), *[pa.binary()] * 3])], names=["block", "n", "x", "y", "z"])

    w = table.filter(F.col("kind") == "w").select("bucket", "block", "n", "x", "y").repartition("bucket").sortWithinPartitions("bucket")
    return w.mapInArrow(rows, "block long, n long, x binary, y binary, z binary")


def encode_decode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), text (decoded from ids) for each row of docs."""
    prepared(docs.sparkSession)
    rows_in = docs.select(F.col(id_column).alias("doc_id"), F.lit(False).alias("flag"), no_null_text(text_column).alias("text"))
    table = blocks.block_table(rows_in, split_words, blocks.buckets_for(docs))
    pieces = docs.sparkSession.sparkContext.broadcast(piece_table(path))
    kind = table.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, texts, packed = None, [], [], blocks.Packed()
        piece = pieces.value
        for b in batches:
            out = []
            size = 0
            for block, seq, doc, n, x, y, z in zip(*(b.column(c).to_pylist() for c in (0, 1, 2, 4, 5, 6, 7)), strict=True):
                if block != at:
                    at, ids, texts = block, [], []
                if seq < 0:
                    codes, lengths, flat = blocks.word_codes(x), blocks.of_planes(y), blocks.of_planes(z).tobytes()
                    if len(ids) <= (top := int(codes.max())):
                        ids += [b""] * (top + 1 - len(ids))
                        texts += [b""] * (top + 1 - len(texts))
                    ends = np.cumsum(lengths, dtype=np.int64).tolist()
                    said = list(map(piece.__getitem__, np.frombuffer(flat, "<u4").tolist()))
                    for c, s, e in zip(codes.tolist(), [0, *ends], ends, strict=False):
                        ids[c] = flat[4 * s : 4 * e]
                        texts[c] = b"".join(said[s:e])
                    continue
                codes = packed.take(x, n).tolist()
                mine = b"".join(map(ids.__getitem__, codes))
                text = b"".join(map(texts.__getitem__, codes)).decode("utf-8", "replace")
                out.append((doc, len(mine) // 4, mine, text))
                size += len(mine)
                if size > 4 << 20:
                    yield blocks.record_batch(out, schema)
                    out, size = [], 0
            if out:
                yield blocks.record_batch(out, schema)

    id_type = blocks._schema(table.schema["doc_id"].dataType).field("doc_id").type
    schema = pa.schema([("doc_id", id_type), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])
    return blocks.by_block(table, _word_ids(table, path)).mapInArrow(rows, f"doc_id {kind}, n_tokens long, ids binary, text string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
