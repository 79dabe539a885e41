"""Conversation repair: against a plain dynamic program, at piece borders, and over vectors that never converge."""

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F

from shopflow.llm import conversation_repair as cr

ROW = "conv_id long, turn long, role string, text string"


def check(spark, rows, clash=False, parts=5):
    df = spark.createDataFrame(rows, ROW).repartition(parts)
    if clash:
        df = df.withColumns({c: F.lit("x") for c in ("place", "salt", "copies", "kind", "seq", "n", "cost", "open", "lines")})
    got = {r["conv_id"]: tuple(r)[1:] for r in cr.repairs(cr.damaged(df)).collect()}
    want = brute.repairs(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k], (k, got[k][:7], want[k][:7])


def random_rows(seed, n_conv, longest, roles=("user", "assistant", "system", "tool", None, "")):
    r, out = random.Random(seed), []
    for c in range(n_conv):
        for turn in range(r.randrange(longest + 1)):
            role = ("user", "assistant")[turn % 2] if r.random() < 0.7 else r.choice(roles)
            text = r.choice(["Well. ", "Yes!", "and then", "", " \n", None, "a?b", f"No {r.randrange(9)}."])
            out += [(c, None if r.random() < 0.05 else turn + r.randrange(2), role, text)] * (1 if r.random() < 0.9 else 3)
    return out


def test_matches_the_plain_program(spark):
    check(spark, random_rows(1, 60, 12), clash=True)


@pytest.mark.parametrize("piece,growth", [(1, 2), (3, 2), (7, 16)])
def test_pieces_of_any_size(spark, monkeypatch, piece, growth):
    monkeypatch.setattr(cr, "PIECE_ROWS", piece)
    monkeypatch.setattr(cr, "PASS_GROWTH", growth)
    rows = random_rows(2, 12, 15) + [(None, t, r, x) for _, t, r, x in random_rows(3, 4, 20)] + [(99, t, r, x) for _, t, r, x in random_rows(4, 8, 20)]
    check(spark, rows, parts=9)


def test_vectors_that_never_converge(spark, monkeypatch):
    """Only roles that fit nowhere, or only assistants: every piece hands its input on."""
    monkeypatch.setattr(cr, "PIECE_ROWS", 4)
    rows = [(1, t, "tool", f"t {t}.") for t in range(150)] + [(2, t, "assistant", f"t {t}.") for t in range(151)] + [(3, t, "user", "same") for t in range(120)]
    check(spark, rows)


def test_hard_rows(spark):
    long = "word " * 300_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, None, None, None), (3, None, "", "x"), (None, None, "user", "a."),
            (None, 2, "assistant", "b."), (4, 5, "System", "x."), (4, 6, "admin", "é  ."), (4, 2**40, "u", "y.")] + [(5, 1, "user", "same.")] * 500 + [(6, 2, "user", "\x01a\nb.")]
    check(spark, rows)


def test_all_rows_dropped_and_no_rows(spark):
    gone = next(t for t in range(500) if not brute.damage([(7, t, "user", "x.")]))
    got = cr.repairs(cr.damaged(spark.createDataFrame([(7, gone, "user", "x.")], ROW))).collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert cr.repairs(cr.damaged(spark.createDataFrame([], ROW))).count() == 0


def test_turns_are_those_of_the_digest(spark, monkeypatch):
    monkeypatch.setattr(cr, "PIECE_ROWS", 5)
    rows = cr.damaged(spark.createDataFrame(random_rows(5, 30, 14), ROW))
    want = {r["conv_id"]: r["repaired_sha256"] for r in cr.repairs(rows).collect()}
    lines: dict = {}
    for r in cr.repaired_turns(rows).orderBy("conv_id", "piece", "position").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in want} == want


def test_text_ids(spark):
    rows = [("a", 1, "user", "x."), ("a", 2, "assistant", "y."), ("b", 1, "assistant", "z")]
    got = cr.repairs(cr.damaged(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))).collect()
    assert {r["conv_id"] for r in got} == {"a", "b"}
