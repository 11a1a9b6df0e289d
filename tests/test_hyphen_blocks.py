"""Broken words of documents that are in one block of lines, in several, and in none."""

import pytest

from textmill.operators import hyphen

ROWS = [(1, 0, "a garden-"), (1, 1, "house, and"), (1, 2, ""), (1, 3, "a Gardenhouse"), (2, 0, "a garden-"), (2, 1, "house, and"), (2, 2, "a garden-house"), (None, 0, "a garden-"), (None, 1, "house"), (None, 2, "gardenhouse")]
LONG = [(3, 0, "old win-"), *((3, k, f"line {chr(97 + k % 26)}") for k in range(2, 40)), (3, 1, "ter; and win-"), (3, 40, "Winter is here")]


@pytest.mark.parametrize("block", [2, 2048])
def test_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(hyphen, "BLOCK", block)
    df = spark.createDataFrame(ROWS + LONG, "doc_id long, line_no int, raw string")
    got = sorted(((r.doc_id or 0, r.line_no, r.head + r.tail, r.has_joined, r.has_compound, r.merge) for r in hyphen.decided(df).collect()))
    assert got == [(0, 0, "gardenhouse", False, False, False), (1, 0, "gardenhouse", True, False, True), (2, 0, "gardenhouse", False, True, False), (3, 0, "winter", True, False, True), (3, 1, "winline", False, False, False)]
    said = {(r.doc_id, r.line_no): r.raw for r in hyphen.merged(df).collect()}
    want = {(d, n): t for d, n, t in ROWS + LONG} | {(1, 0): "a gardenhouse,", (1, 1): "and", (3, 0): "old winter;", (3, 1): "and win-"}
    assert said == want


def test_no_row_for_each_word(spark):
    """Lines cross one shuffle, and the words of short documents none."""
    df = spark.createDataFrame(ROWS, "doc_id long, line_no int, raw string")
    plan = hyphen.merged(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
