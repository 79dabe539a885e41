"""Near duplicates, decontamination, repeats, mixing: against all-pairs and position-by-position restatements."""

import random
import uuid

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.llm import decontaminate, mixing, ngram_join, repeats
from shopflow.llm.common import components
from shopflow.llm.queries import QUERIES


def _edited(text, k, seed):
    r, w = random.Random(seed), text.split(" ")
    for _ in range(k):
        w[r.randrange(len(w))] = f"w{r.randrange(10**6)}"
    return " ".join(w)


def _near(rows):
    got = {}
    want = {}
    for (doc_id, text), (n, c) in zip(rows, brute.near_classes(rows), strict=True):
        want.setdefault((doc_id, n, c), 0)
        want[(doc_id, n, c)] += 1
    return got, want


def _counted(rows):
    out = {}
    for r in rows:
        k = (r["doc_id"], r["n_shingles"], r["component_id"])
        out[k] = out.get(k, 0) + 1
    return out


def test_near_duplicates_match_all_pairs(make, hard_rows, text):
    rows = list(hard_rows)
    for g in range(6):  # groups of near copies, some beyond DENSE, at all distances around the threshold
        base = text(100 + g, 60 + 30 * g)
        rows += [(1000 * (g + 1) + i, _edited(base, i % 7, i + g)) for i in range(5 + 12 * (g % 3))]
    rows += [(9000 + i, "a very common line of eight whole words " + text(500 + i, 40)) for i in range(40)]
    got = ngram_join.near_duplicates(make(rows, clash=True)).collect()
    assert _counted(got) == _near(rows)[1]


def test_longer_prefixes_lose_no_link(make, text, monkeypatch):
    base = [text(i, 25) for i in range(4)]
    rows = [(i, _edited(base[i % 4], i % 3, i)) for i in range(80)]
    for dense in (2, 10_000):
        monkeypatch.setattr(ngram_join, "DENSE", dense)
        assert _counted(ngram_join.near_duplicates(make(rows)).collect()) == _near(rows)[1]


def test_rows_without_id_and_of_one_id(make, text):
    """20,000 rows without id and 20,000 of one id, each with one near copy, and copies of one row: texts are fetched row by row."""
    rows = [(doc_id, t) for doc_id in (None, 5) for i in range(10_000) for t in (f"{i} {doc_id} " + text(i % 500, 12), f"{i} {doc_id} " + text(i % 500, 12) + " end")]
    rows += [(None, text(7, 60))] * 2000 + [(9, text(7, 60) + " end")]
    got = {(r["doc_id"], r["component_id"]): r["count"] for r in ngram_join.near_duplicates(make(rows)).groupBy("doc_id", "component_id").count().collect()}
    assert got == {(None, None): 20_000, (5, 5): 20_000, (None, 9): 2000, (9, 9): 1}


def test_long_words_that_a_polynomial_confuses(make):
    """Thue-Morse words and their complements agree modulo 2^64 under any base."""
    t = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    swapped = t.translate(str.maketrans("ab", "ba"))
    rows = [(1, t), (2, swapped), (3, t.upper()), (4, f"{t} {swapped} one two three"), (5, f"{swapped} {t} one two three")]
    assert _counted(ngram_join.near_duplicates(make(rows)).collect()) == _near(rows)[1]


def test_representatives_of_rows_without_id_and_of_one_id(make, text):
    a, b, c = text(1, 80), text(2, 80), text(3, 80)
    rows = [(1, a), (1, _edited(a, 1, 1)), (None, _edited(a, 1, 2)), (None, b), (None, _edited(b, 1, 3)), (7, c), (7, c), (7, _edited(c, 1, 4)), (8, ""), (8, None), (9, "")]
    rows = [(*r, None, "s", i % 2) for i, r in enumerate(rows)]
    got = ngram_join.representatives(make(rows, clash=True)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "7", "8", "9", "None"]
    again = ngram_join.representatives(make(rows[::-1], clash=True)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_near_duplicates_of_nothing(make):
    assert ngram_join.near_duplicates(make([])).count() == 0
    assert [tuple(r) for r in ngram_join.near_duplicates(make([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(find(n) == label for n, label in got.items())
    assert {n for e in edges for n in e if e[0] != e[1]} <= set(got)


def _items(text):
    return [(i, text(900 + i, 12 + 3 * i)) for i in range(12)] + [(50, "Two words. And then a longer answer of seven words"), (51, ""), (52, None), (None, text(950, 30))]


def test_leaks_match_containment(make, make_items, text):
    items = _items(text)
    rows = [(i, text(i, 200)) for i in range(30)]
    want = set()
    for k, (item, t) in enumerate(i for i in items if i[1]):
        rows.append((100 + k, f"{text(k, 70 + 13 * k)} {t}*** {text(k + 1, 40)}"))
        want.add((100 + k, item))
    rows += [(200, items[3][1].upper()), (201, items[3][1]), (201, items[3][1]), (202, None), (203, ""), (204, text(7, 20_000) + " " + items[5][1])]
    want |= {(200, 3), (201, 3), (204, 5)}
    hits = decontaminate.leaks(make(rows, clash=True), make_items(items))
    assert {(r["doc_id"], r["item_id"]) for r in hits.collect()} == want
    stay = decontaminate.without_leaks(make(rows), make_items(items)).collect()
    assert {r["doc_id"] for r in stay} == {i for i, _ in rows} - {d for d, _ in want}


def test_index_blocks_give_the_same_hits(make, make_items, text, monkeypatch):
    items = _items(text)
    docs = make([(k, text(k, 90) + " " + t) for k, (_, t) in enumerate(items) if t])
    one = sorted((r["doc_id"], str(r["item_id"]), round(r["score"], 9)) for r in decontaminate.leaks(docs, make_items(items)).collect())
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 300)
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", 2)
    built = decontaminate.index_blocks(make_items(items))
    assert built.count() > 2 and max(len(r["index"]) for r in built.collect()) < 20_000
    clean = docs.unionByName(make([(900, text(77, 50)), (901, None)]))
    assert sorted(r["doc_id"] for r in decontaminate.without_leaks(clean, make_items(items)).collect() if r["doc_id"] >= 900) == [900, 901]
    assert {r["doc_id"] for r in decontaminate.without_leaks(clean, make_items(items)).collect()} & {r[0] for r in one} == set()
    assert sorted((r["doc_id"], str(r["item_id"]), round(r["score"], 9)) for r in decontaminate.leaks(docs, make_items(items)).collect()) == one


def test_wand_retrieves_all_above_the_threshold(text):
    items = [(i, text(i % 40, 20) + " " + text(i, 15)) for i in range(120)]
    index = decontaminate.Index(items, {}, 120, 35.0)
    rng = np.random.default_rng(0)
    for threshold in (0.05, 0.3, 0.6):
        for _ in range(30):
            terms = rng.choice(len(index.terms), int(rng.integers(1, 60)), replace=False)
            score = np.zeros(120)
            for t in terms:
                np.add.at(score, index.item[index.first[t]:index.first[t + 1]], index.gain[index.first[t]:index.first[t + 1]])
            assert sorted(i for i, _ in index.wand(terms, threshold)) == np.flatnonzero(score + 1e-9 >= threshold).tolist()


def test_leaks_of_nothing(make, make_items, text):
    assert decontaminate.leaks(make([(1, text(1, 50))]), make_items([])).count() == 0
    assert decontaminate.leaks(make([]), make_items([(1, text(1, 20))])).count() == 0


def test_suffix_order_is_sorted(monkeypatch):
    rng = np.random.default_rng(0)
    for bound in (50, 8_000_000):
        monkeypatch.setattr(repeats, "IN_MEMORY", bound)
        for _ in range(15):
            s = rng.integers(1, 1 + int(rng.integers(1, 6)), int(rng.integers(1, 300)))
            s = np.concatenate([s, s[:100], [0]])
            disk = repeats.Disk()
            order = np.array(repeats.suffix_order(s, 7, disk)).tolist()
            disk.close()
            assert order == sorted(range(len(s)), key=lambda i: s.tolist()[i:])


@pytest.mark.parametrize("shard", [300, 4_000_000])
def test_repeats_match_brute_force(make, hard_rows, text, monkeypatch, shard):
    monkeypatch.setattr(repeats, "SHARD", shard)
    base, line = text(60, 300), "This very common licence line is longer than one hundred bytes, so that every copy of it repeats, word for word."
    rows = [r for r in hard_rows if r[0] != 11] + [(11, "x" * 3000)]
    rows += [(100 + i, _edited(base, i, i)) for i in range(8)] + [(200 + i, f"{text(i, 30)}\n{line}\n{text(i + 50, 9)}") for i in range(20)]
    rows += [(300, line[:99]), (301, line[:100]), (302, line + line), (303, "ab" * 400), (304, "é" * 60 + line), (305, line), (None, line)]
    want = sorted(zip([str(d) for d, _ in rows], brute.repeats(rows), strict=True))
    got = repeats.digests(make(rows, clash=True)).collect()
    assert sorted((str(r["doc_id"]), (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == want


def test_pieces_of_a_frequent_anchor_fill_no_shard(make, text, monkeypatch, tmp_path):
    monkeypatch.setattr(repeats, "SHARD", 3000)
    real = repeats.repeated_in

    def noted(pieces):
        (tmp_path / uuid.uuid4().hex).write_text(str(sum(len(p) for _, _, p in pieces)))
        return real(pieces)

    monkeypatch.setattr(repeats, "repeated_in", noted)
    line = "a line that most of the texts hold, of less than one hundred bytes,"
    rows = [(i, f"{text(i, 25)}\n{line}\n{text(i % 60 + 500, 25)}") for i in range(150)]
    got = repeats.digests(make(rows)).collect()
    assert sorted((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) \
        == sorted(zip([d for d, _ in rows], brute.repeats(rows), strict=True))
    sizes = [int(f.read_text()) for f in tmp_path.iterdir()]
    assert sizes and max(sizes) < 2 * 3000


def test_kept_bytes_and_empty_table(make, text):
    t = text(1, 60)
    got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(make([(1, t), (2, "new " + t)])).collect()}
    assert got[1] == t.encode() and len(got[2]) < 20
    assert repeats.digests(make([])).count() == 0


def test_mix_matches_brute_force(make, hard_rows, text):
    rows = [(d, t, None, ("b", "a", None, "é", "Z")[i % 5], None) for i, (d, t) in enumerate(hard_rows)]
    rows += [(1000 + i, text(i, 5 + i % 30), None, "big", None) for i in range(300)] + [(5000, "", None, "void", None)]
    got = mixing.with_copies(make(rows, clash=True)).select("doc_id", "text", "source", "__mix.*").collect()
    want = brute.mix([(r[0], r[1], r[3]) for r in rows], mixing.SEED)
    flat = lambda d, t, s, m: (str(d), str(t), str(s), m[0], m[1], round(m[2], 6), m[3])
    assert sorted(flat(r["doc_id"], r["text"], r["source"], (r["size"], r["source_size"], r["target"], r["taken"])) for r in got) \
        == sorted(flat(r[0], r[1], r[3], m) for r, m in zip(rows, want, strict=True))
    assert all(r["taken"] <= 2 * r["size"] for r in got)


def test_mix_meets_its_targets_without_ids(make, text):
    """Rows without id, of one id, and equal rows are drawn one by one."""
    rows = [(None, text(i, 20), None, f"s{i % 3}", None) for i in range(1500)] + [(4, text(i, 20), None, f"s{i % 3}", None) for i in range(1500)]
    rows += [(None, "eight words that are all the same here", None, "same", None)] * 3000
    out = mixing.with_copies(make(rows)).groupBy("source").agg(F.first("__mix.target").alias("target"), F.sum("__mix.taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.05 * r["target"] for r in out) and len(out) == 4


def test_mix_emits_the_copies_and_handles_nothing(make, text):
    docs = make([(i, text(i, 20), None, f"s{i % 3}", None) for i in range(90)])
    taken = {r["doc_id"]: r["copies"] for r in mixing.with_copies(docs).select("doc_id", "__mix.copies").collect()}
    out = mixing.mixed_documents(docs).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in out} == {d: c for d, c in taken.items() if c}
    assert mixing.with_copies(make([])).count() == 0


def test_queries_over_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    got = QUERIES["op9_ngram_jaccard_join"](spark, sf).collect()
    assert _counted(got) == _near(rows)[1]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op8_suffix_array_dedup"](spark, sf).collect()}
    assert got == dict(zip([d for d, _ in rows], brute.repeats(rows), strict=True))
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    hits = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_benchmark_decontamination"](spark, sf).collect()}
    assert {(d, i["item_id"]) for d, t in rows for i in items if i["text"] in t} <= hits
    assert all(len(set(brute.WORD.findall(i["text"])) & set(brute.WORD.findall(dict(rows)[d]))) > 5 for d, k in hits for i in items if i["item_id"] == k)
    assert QUERIES["op7_source_mix"](spark, sf).agg(F.count("*")).first()[0] == len(rows)
