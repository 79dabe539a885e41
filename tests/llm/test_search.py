"""Ranked search: against scoring every document, and the stopping rule of the best positions."""

import brute
import numpy as np
import pytest

from shopflow.llm import ranked_search as rs


def check(make, make_items, rows, items, k=10, clash=False):
    got = [tuple(r) for r in rs.ranked(make(rows, clash=clash), make_items(items), k).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0)
    assert sorted(got, key=key) == sorted(brute.ranking(rows, items, k), key=key)


def test_matches_scoring_every_document(make, make_items, hard_rows, text):
    rows = [*hard_rows, *((100 + i, text(i, 10 + i)) for i in range(80)), (300, "Ünï ÜNÏ über_a 12a-b"), (301, "12A 日本語 ünï")]
    items = [(1, text(1, 30)), (2, text(7, 40)), (3, "12a ünï ÜNÏ"), (4, None), (5, "..."), (6, "the of the of and"), (None, "one two"), (7, "one two"), (7, text(3, 12))]
    check(make, make_items, rows, items, clash=True)


@pytest.mark.parametrize("shard,first", [(1, 1), (300, 2), (1 << 20, 4)])
def test_shards_blocks_and_readings(make, make_items, text, monkeypatch, shard, first):
    monkeypatch.setattr(rs, "SHARD_POSTINGS", shard)
    monkeypatch.setattr(rs, "FIRST_READ", first)
    monkeypatch.setattr(rs, "LONGEST_READ", 8)
    monkeypatch.setattr(rs, "BLOCK_BYTES", 150)
    rows = [(i, text(i % 50, 30)) for i in range(150)]
    check(make, make_items, rows, [(i, text(i, 12)) for i in range(6)], k=3)


def test_ties_go_to_the_least_ids(make, make_items, text):
    rows = [(500 - i, text(1, 20)) for i in range(60)] + [(None, text(1, 20))] + [(7, text(1, 20))] * 3
    check(make, make_items, rows, [(1, text(1, 20))])


def test_empty_tables(make, make_items):
    assert rs.ranked(make([]), make_items([(1, "a")])).count() == 0
    assert rs.ranked(make([(1, "a")]), make_items([])).count() == 0
    assert rs.ranked(make([(1, None)]), make_items([(1, "a")])).count() == 0


def _shard(n_docs, n_lists, seed):
    rng = np.random.default_rng(seed)
    term = np.repeat(np.arange(n_lists), n_docs)
    doc = np.tile(np.arange(n_docs), n_lists)
    keep = rng.random(len(term)) < 0.6
    tf = rng.integers(1, 9, len(term))
    return rs.Shard(list(range(n_docs)), np.full(n_docs, 50), term[keep], doc[keep], tf[keep], np.arange(1, n_lists + 1) * 10, n_docs, 50 * n_docs)


def test_reading_stops_early_and_never_too_early():
    for seed in range(20):
        shard = _shard(400, 3, seed)
        total = np.zeros(400, np.int64)
        np.add.at(total, shard.doc, shard.impact)
        want = sorted((-int(s), False, i) for i, s in enumerate(total) if s)[:10]
        top, _ = shard.best(np.arange(3), 10, [])
        assert top == want
        again, seen = shard.best(np.arange(3), 10, [(-10 ** 12, False, -1)] * 10)  # a bound that nothing reaches
        assert again == [(-10 ** 12, False, -1)] * 10 and seen < 100


def test_best_positions_pass_what_direct_access_saw():
    """Two lists in opposite order: each reading of one is seen in the other by direct access only."""
    n = 64
    term, doc = np.repeat([0, 1], n), np.tile(np.arange(n), 2)
    tf = np.concatenate([np.arange(n, 0, -1), np.arange(1, n + 1)])
    shard = rs.Shard(list(range(n)), np.full(n, 10), term, doc, tf, np.array([5, 5]), n, 10 * n)
    top, seen = shard.best(np.array([0, 1]), 1, [])
    total = np.zeros(n, np.int64)
    np.add.at(total, shard.doc, shard.impact)
    assert top[0][:1] == (-int(total.max()),) and seen <= n
