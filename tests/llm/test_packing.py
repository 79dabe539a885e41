"""Packing: exact round trip of the ids, the sum-of-squares choice, little padding."""

import random
from collections import Counter

import numpy as np
import pytest

from shopflow.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.default_tokenizer())


def sequences(pieces):
    out: dict = {}
    for p in pieces:
        out.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in out.values():
        own.sort()
        at = 0
        for offset, length in own:
            assert offset == at and length > 0
            at += length
    return [sum(n for _, n in own) for own in out.values()]


def check(df, rows, tokenizer, window=packing.WINDOW):
    pieces = packing.packed(df, window=window).collect()
    docs: dict = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"]
        docs.setdefault(p["doc_id"], []).append(p)
    want: dict = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, Counter())[tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])] += 1
    for doc_id, texts in want.items():
        own = docs.pop(doc_id)
        if sum(texts.values()) == 1:
            ids, = texts
            own.sort(key=lambda p: p["start"])
            assert b"".join(p["ids"] for p in own) == np.array(ids, "<u4").tobytes()
            assert [p["start"] for p in own] == [sum(q["length"] for q in own[:i]) for i in range(len(own))]
            assert {p["doc_tokens"] for p in own} == {len(ids)}
        else:
            assert sum(p["length"] for p in own) == sum(len(t) * n for t, n in texts.items())
    assert not docs
    return sequences(pieces)


def test_every_id_in_one_piece(make, hard_rows, tokenizer):
    fills = check(make(hard_rows, clash=True), [r[:2] for r in hard_rows], tokenizer)
    assert all(n == packing.WINDOW or n & (n - 1) == 0 for n in fills)


def test_odd_texts(make, tokenizer):
    odd = ["a\x0bb", "é́ ́a Σ ΑΣ b", "<|endoftext|> a<|startoftext|>b it's 's I'LL 123 ４５ \x85y \x1c\x1d z", "日本語 テキスト 👍🏽 ​ ﻿", "a\x00b\x01", "ſ K İ ŉ ǅ",
           "a\x1cb c", "\x1f", "w" * 500 + " w", "x y　z"]
    check(make(list(enumerate(odd))), list(enumerate(odd)), tokenizer)


@pytest.mark.parametrize("window,most", [(64, 3), (257, 1000)])
def test_small_windows(make, text, tokenizer, monkeypatch, window, most):
    monkeypatch.setattr(packing, "OPEN_WINDOWS", most)
    monkeypatch.setattr(packing, "CACHED_WORDS", 50)
    rows = [(i, text(i, random.Random(i).randrange(1, 60))) for i in range(120)]
    fills = check(make(rows), rows, tokenizer, window)
    assert all(n == window or n & (n - 1) == 0 for n in fills)


def test_nothing_to_pack(make):
    assert packing.packed(make([])).count() == 0


def test_level_leaves_the_least_sum_of_squares():
    rng = np.random.default_rng(3)
    for _ in range(300):
        p = packing.Packer(20)
        p.counts[1:20] = rng.integers(0, 4, 19)
        size = int(rng.integers(1, 20))

        def after(level, p=p, size=size):
            c = p.counts.copy()
            c[level] -= level > 0
            c[level + size] += level + size < 20
            return int((c[1:20] ** 2).sum())
        options = [h for h in range(0, 21 - size) if h == 0 or p.counts[h]]
        best = min(map(after, options))
        assert p.level(size) == max(h for h in options if after(h) == best)


def test_pieces_follow_the_rule():
    """Sizes that fill windows exactly leave none open: the rule never opens a level that it can't fill."""
    p = packing.Packer(10)
    for i in range(200):
        p.add(i, bytes(4 * (3 if i % 2 else 7)))
    assert p.n_open <= 1 and len({x[4] for x in p.out}) >= 99
