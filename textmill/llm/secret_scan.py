"""Secret scans: an Aho-Corasick pass over each text finds keywords; expressions are tried only at those places; tokens
that carry a checksum are reported only if it holds.

Kinds, in this order: assign, access, hex (no keyword: a run of 16 hexadecimal digits is its own prefilter), then
checked: tokens of the form <prefix>_<30 characters><6 characters>, whose last six are the CRC-32 of the thirty in base 62.

Defined cases: a null or empty text has no spans; spans count code points, end exclusive; within a kind matches are
leftmost and don't overlap, and a match that fails its length rule still takes its characters; kinds may overlap.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import held, no_null_text, prepared

KINDS = ("assign", "access", "hex", "checked")
BASE = KINDS[:3]
#: The keywords of each kind, in lower case.
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_KEY = "akia"
CHECKED_KEYS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_assign = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_access = re.compile(r"AKIA[A-Z0-9]+")
_hex = re.compile(r"[0-9a-f]{16,}")
_checked = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")

Span = tuple[str, int, int]


def checksum62(body: str) -> str:
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


class Scanner:
    def __init__(self):
        import ahocorasick

        self.keys = ahocorasick.Automaton()
        for kind, words in (("assign", ASSIGN_KEYS), ("access", (ACCESS_KEY,)), ("checked", CHECKED_KEYS)):
            for w in words:
                self.keys.add_word(w, (kind, len(w)))
        self.keys.make_automaton()

    def spans(self, text: str) -> list[Span]:
        """All spans by start, then kind as listed."""
        found: list[Span] = []
        lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only: places stay
        hits = sorted((end - n + 1, kind) for end, (kind, n) in self.keys.iter(lowered))
        done = dict.fromkeys(KINDS, 0)
        for at, kind in hits:
            if at < done[kind]:
                continue
            if kind == "assign":
                if m := _assign.match(text, at):
                    done[kind] = m.end()
                    if m.end(1) - m.start(1) >= 12:
                        found.append((kind, at, m.end()))
            elif kind == "access":
                if m := _access.match(text, at):
                    done[kind] = m.end()
                    if m.end() - at >= 18:
                        found.append((kind, at, m.end()))
            elif (m := _checked.match(text, at)) and checksum62(m[1]) == m[2]:
                done[kind] = m.end()
                found.append((kind, at, m.end()))
        found += [("hex", *m.span()) for m in _hex.finditer(text)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def redact(text: str, spans: list[Span]) -> str:
    """text with each stretch that spans cover replaced by [SECRET]."""
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and found (kind, start, end by start, then kind) for each row of docs: repeated rows have a row each, an empty table gives none,
    and other columns of docs, whatever their names, are not read."""
    prepared(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = held(Scanner)
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            found = [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in s.spans(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, spans)], names=["doc_id", "found"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("doc_id"), no_null_text(text_column).alias("text")).mapInArrow(rows, f"doc_id {kind}, found array<struct<kind:string,start:bigint,end:bigint>>")


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each kind, a digest of the base kinds' and all spans as text."""
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(kind).alias(f"n_{kind}") for kind in KINDS]
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    return scanned.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said("found").alias("spans"))


def redacted(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """docs with the secrets in its texts replaced, and n_chars, where there is such a column, counted anew; all columns and rows stay. A null text stays null."""
    prepared(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        s = held(Scanner)
        return pa.array([t if t is None else redact(t, s.spans(t)) for t in texts.to_pylist()], pa.string())

    out = docs.withColumn(text_column, clean(F.col(text_column)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(text_column).isNotNull(), F.length(text_column)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out
