"""Benchmark decontamination: a BM25 index of test items, searched with every training passage by block-max WAND.

Passages are word windows twice as long as the longest item, every such length, so each occurrence of an item lies whole
in one.  A passage is the query, an item the document; impacts are divided by the item's own score, so that an item
copied whole scores 1.  All items above the threshold are retrieved.  Three bounds cut the work, none of them lossy: the
sum of the terms' largest impacts over all items, the same per block of items (both for a batch of passages at once), and
for what is left the cursors of block-max WAND.  A hit counts where the word triples of the item's question (all but the
last sentence) and of its answer (the last one) overlap the passage enough.

Scale.  Term statistics cover the whole benchmark and are counted in Spark.  The items lie in blocks of at most
INDEX_BYTES of text; a task builds the index of a block, and all indexes lie in the shared folder.  A pass searches every
passage against PASS_BLOCKS of them, which is all that the driver and a task hold at a time, so the benchmark may be of
any size; the documents are read once per pass and never shuffled.

Defined cases.  Null, empty or blank texts and items match nothing; an item with a null id is an item like any other.
Equal items are all reported.  Repeated documents are judged alike.  Other columns pass through untouched.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from .common import PLACE_KEYS, item_blocks, mixed, saved, tune, utf8, word_hashes, word_spans

K1, B = 1.2, 0.75
#: Least share of an item's own score.
THRESHOLD = 0.5
QUESTION_OVERLAP, ANSWER_OVERLAP = 0.6, 0.5
#: Items in a block of the index, and bytes of item text in an index.
BLOCK_ITEMS = 2
#: Bounds of (passage, block) held at a time.
CELLS = 2_000_000
INDEX_BYTES = 2_000_000
#: Blocks of the index that a pass over the documents searches.
PASS_BLOCKS = 8


#: Words here are runs of letters, digits and anything beyond ASCII, so glued punctuation does not hide an item.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BREAKS = np.array([bool(i < 128 and not chr(i).isalnum()) for i in range(256)])
SENTENCE = re.compile(r"[.?!][\x20\x09-\x0D]+(?=[^\x20\x09-\x0D])")


def _hashes(text: str) -> np.ndarray:
    data, offsets = utf8(pa.array([text]))
    return word_hashes(data, *word_spans(data, offsets, BREAKS)[:2])


def _triples(hashes: np.ndarray) -> np.ndarray:
    """A fingerprint of each run of three words; of the whole, if there are fewer."""
    n = max(1, len(hashes) - 2)
    out = np.zeros(n, np.uint64)
    for p in range(3):
        part = hashes[p:p + n]
        out[:len(part)] += part * PLACE_KEYS[p]
    return mixed(out)


def split_item(text: str) -> int:
    """The word at which the answer starts: the last sentence, or the last quarter of a single one; three words at least.

    A question of fewer than three words is held against the whole item.
    """
    n = len(TERM.findall(text))
    ends = [m.end() for m in SENTENCE.finditer(text)]
    at = len(TERM.findall(text[:ends[-1]])) if ends else n - max(1, n // 4)
    return max(0, min(at, n - 3))


class Index:
    """Postings of the items' terms with normalised BM25 impacts, per-term and per-block maxima."""

    def __init__(self, items: list[tuple[object, str]], df: dict[int, int], n_items: int, mean_words: float):
        self.ids, self.question, self.answer, postings = [], [], [], {}
        longest = 1
        for item_id, text in items:
            hashes = _hashes(text)
            if not len(hashes):
                continue
            i, cut = len(self.ids), split_item(text)
            self.ids.append(item_id)
            self.question.append(np.unique(_triples(hashes[:cut] if cut >= 3 else hashes)))
            self.answer.append(np.unique(_triples(hashes[cut:])))
            longest = max(longest, len(hashes))
            terms, tf = np.unique(hashes, return_counts=True)
            idf = np.array([math.log(1 + (n_items - df.get(int(t), 1) + 0.5) / (df.get(int(t), 1) + 0.5)) for t in terms])
            gain = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(hashes) / mean_words))
            for t, g in zip(terms.tolist(), (gain / gain.sum()).tolist(), strict=True):
                postings.setdefault(t, []).append((i, g))
        self.longest = longest
        self.terms = np.array(sorted(postings), np.uint64)
        rows = [postings[t] for t in self.terms.tolist()]
        self.first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        self.item = np.array([i for r in rows for i, _ in r], np.int64)
        self.gain = np.array([g for r in rows for _, g in r], np.float64)
        self.most = np.array([max(g for _, g in r) for r in rows], np.float64)
        # (term, block) maxima, in the order of terms
        self.n_blocks = len(self.ids) // BLOCK_ITEMS + 1
        blocks = [{} for _ in rows]
        for b, r in zip(blocks, rows, strict=True):
            for i, g in r:
                b[i // BLOCK_ITEMS] = max(g, b.get(i // BLOCK_ITEMS, 0))
        self.block_first = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype(np.int64)
        self.block = np.array([k for b in blocks for k in b], np.int64)
        self.block_most = np.array([g for b in blocks for g in b.values()], np.float64)

    def packed(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def unpacked(cls, state: bytes) -> Index:
        out = cls.__new__(cls)
        vars(out).update(pickle.loads(state))
        return out

    def wand(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items whose impacts over the given terms sum to the threshold, by block-max WAND."""
        end = len(self.ids)
        cursors = [[int(self.item[self.first[t]]), int(self.first[t]), int(t)] for t in terms]
        last = {int(t): int(self.first[t + 1]) for t in terms}
        maxima = {int(t): dict(zip(self.block[self.block_first[t]:self.block_first[t + 1]].tolist(),
                                   self.block_most[self.block_first[t]:self.block_first[t + 1]].tolist(), strict=True)) for t in terms}
        found, slack = [], 1e-9

        def forward(c: list, target: int) -> None:
            lo, hi = c[1], last[c[2]]
            c[1] = lo + int(np.searchsorted(self.item[lo:hi], target))
            c[0] = int(self.item[c[1]]) if c[1] < hi else end

        while True:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                if c[0] >= end:
                    break
                bound += self.most[c[2]]
                if bound + slack >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            at = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == at:
                pivot += 1
            block = at // BLOCK_ITEMS
            if sum(maxima[c[2]].get(block, 0.0) for c in cursors[:pivot + 1]) + slack < threshold:
                # no item up to the end of the block, or to the next cursor, can reach the threshold
                target = min((block + 1) * BLOCK_ITEMS, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else end)
                for c in cursors[:pivot + 1]:
                    forward(c, max(target, at + 1))
            elif cursors[0][0] == at:
                score = sum(float(self.gain[c[1]]) for c in cursors[:pivot + 1])
                if score + slack >= threshold:
                    found.append((at, score))
                for c in cursors[:pivot + 1]:
                    forward(c, at + 1)
            else:
                for c in cursors[:pivot]:
                    if c[0] < at:
                        forward(c, at)

    def search(self, col: pa.Array, threshold: float) -> list[list[dict]]:
        """The verified hits of each text: for each item its best passage."""
        data, offsets = utf8(col)
        start, end, row = word_spans(data, offsets, BREAKS)
        out: list[list[dict]] = [[] for _ in range(len(col))]
        if not len(start) or not len(self.terms):
            return out
        hashes = word_hashes(data, start, end)
        n_words = np.bincount(row, minlength=len(col))
        base = np.cumsum(n_words) - n_words
        n_pass = -(-n_words // self.longest)
        pass_base = np.cumsum(n_pass) - n_pass
        # distinct terms of each passage: a word is in the window that starts at or before it, and in the one before that
        at = np.searchsorted(self.terms, hashes)
        known = np.flatnonzero(self.terms[np.minimum(at, len(self.terms) - 1)] == hashes)
        nth = (known - base[row[known]]) // self.longest
        own = pass_base[row[known]] + nth
        keys = np.concatenate([own * len(self.terms) + at[known], ((own - 1) * len(self.terms) + at[known])[nth > 0]])
        keys = np.unique(keys)
        passage, term = keys // len(self.terms), keys % len(self.terms)
        total = int(n_pass.sum())
        hot = np.bincount(passage, self.most[term], total) + 1e-9 >= threshold
        passage, term = passage[hot[passage]], term[hot[passage]]
        # the block bounds of what is left
        every, live = np.unique(passage), []
        for p in range(0, len(every), max(1, CELLS // self.n_blocks)):
            some = every[p:p + max(1, CELLS // self.n_blocks)]
            mine = slice(*np.searchsorted(passage, [some[0], some[-1] + 1]))
            size = self.block_first[term[mine] + 1] - self.block_first[term[mine]]
            slot = np.repeat(self.block_first[term[mine]] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            cell = np.repeat(np.searchsorted(some, passage[mine]), size) * self.n_blocks + self.block[slot]
            bound = np.bincount(cell, self.block_most[slot], len(some) * self.n_blocks).reshape(len(some), self.n_blocks)
            live.append(some[(bound + 1e-9 >= threshold).any(axis=1)])
        live = np.concatenate(live) if live else every
        lo, hi = np.searchsorted(passage, live), np.searchsorted(passage, live, side="right")
        doc_of = np.searchsorted(pass_base, live, side="right") - 1
        for p, a, b, doc in zip(live.tolist(), lo, hi, doc_of.tolist(), strict=True):
            hits = self.wand(term[a:b], threshold)
            if not hits:
                continue
            first = (p - int(pass_base[doc])) * self.longest
            mine = hashes[base[doc] + first:base[doc] + min(n_words[doc], first + 2 * self.longest)]
            grams = np.unique(_triples(mine))
            for i, score in hits:
                share = [float(np.isin(g, grams).mean()) for g in (self.question[i], self.answer[i])]
                if share[0] >= QUESTION_OVERLAP and share[1] >= ANSWER_OVERLAP:
                    out[doc].append({"item": i, "score": score, "question": share[0], "answer": share[1], "word": first})
        best = []
        for hits in out:
            top: dict[int, dict] = {}
            for h in hits:
                if h["item"] not in top or (h["score"], -h["word"]) > (top[h["item"]]["score"], -top[h["item"]]["word"]):
                    top[h["item"]] = h
            best.append([top[i] | {"item_id": self.ids[i]} for i in sorted(top)])
        return best


def index_blocks(benchmark: DataFrame) -> DataFrame:
    """(block, index): the index of each block of items, built in a task; document frequencies are those of all items."""
    items = item_blocks(benchmark.filter("text is not null"), "item_id", "text", INDEX_BYTES)
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select("block", F.regexp_extract_all(lower, F.lit(TERM.pattern), F.lit(0)).alias("w"))
    n_items, mean = words.agg(F.count("*"), F.coalesce(F.avg(F.size("w")), F.lit(1.0))).first()
    each = words.select("block", F.explode(F.array_distinct("w")).alias("w"))
    counts = each.distinct().join(each.groupBy("w").agg(F.count("*").alias("df")), "w").select(F.col("block").alias("of"), "w", "df")

    def build(mine: pa.Table, known: pa.Table) -> pa.Table:
        hashes = word_hashes(*_ends(known.column("w").to_pylist())) if len(known) else []
        rows = sorted(zip(*(mine.column(c).to_pylist() for c in ("at", "item_id", "text")), strict=True), key=lambda r: r[0])
        df = {int(h): n for h, n in zip(hashes, known.column("df").to_pylist(), strict=True)}
        index = Index([r[1:] for r in rows], df, n_items, float(mean) or 1.0)
        return pa.table({"block": mine.column("block")[:1], "index": pa.array([index.packed()], pa.binary())})

    return saved(items.groupBy("block").cogroup(counts.groupBy("of")).applyInArrow(build, "block long, index binary"), "leak_index")


def _ends(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = utf8(pa.array(words))
    return data, offsets[:-1], offsets[1:]


def hits_of(text: Column, indexes: list[Index], kind: str, threshold: float = THRESHOLD) -> Column:
    """An array of (item_id, score, question, answer, word) for each text, over some blocks of the index; kind: of ids."""
    schema = f"array<struct<item_id: {kind}, score: double, question: double, answer: double, word: bigint>>"

    def searcher(index: Index):
        def run(col: pa.Array) -> pa.Array:
            found = [[{c: h[c] for c in ("item_id", "score", "question", "answer", "word")} for h in hits] for hits in index.search(col, threshold)]
            return pa.array(found, arrow_type)
        return run

    arrow_type = to_arrow_type(DataType.fromDDL(schema))
    parts = [F.arrow_udf(searcher(i), schema)(text) for i in indexes]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def _passes(benchmark: DataFrame) -> Iterator[tuple[list[Index], bool]]:
    """The blocks of the index, PASS_BLOCKS at a time, and whether others are left."""
    built = index_blocks(benchmark)
    blocks = [r["block"] for r in built.select("block").orderBy("block").collect()]
    for i in range(0, len(blocks), PASS_BLOCKS):
        rows = built.filter(F.col("block").isin(blocks[i:i + PASS_BLOCKS])).orderBy("block").collect()
        yield [Index.unpacked(bytes(r["index"])) for r in rows], i + PASS_BLOCKS < len(blocks)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, word): the items that each document holds."""
    tune(docs.sparkSession)
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    out = docs.sparkSession.createDataFrame([], f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, question_overlap double, answer_overlap double, word long")
    for n, (indexes, more) in enumerate(_passes(benchmark)):
        hits = docs.select("doc_id", F.explode(hits_of(F.col("text"), indexes, kinds[1], threshold)).alias("h")).select(
            "doc_id", "h.item_id", "h.score", F.col("h.question").alias("question_overlap"), F.col("h.answer").alias("answer_overlap"), "h.word")
        out = out.unionByName(saved(hits, "leak_hits")) if more or n else hits
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item; nulls stay."""
    tune(docs.sparkSession)
    kind = dict(benchmark.dtypes)["item_id"]
    for indexes, more in _passes(benchmark):
        docs = docs.withColumn("__hits", hits_of(F.col("text"), indexes, kind, threshold)).filter(F.size("__hits") == 0).drop("__hits")
        docs = saved(docs, "leak_free") if more else docs
    return docs
