"""Ranked lexical search by the Best Position Algorithm over impact lists.

The terms of the items (queries) are looked up in every document; an index row holds, for a batch of documents, the
posting list of each of these terms.  From the counts of the whole table each posting gets its impact, a whole number,
and a document's score for an item is the sum of the impacts of the item's terms.  A task joins its index rows to shards
of SHARD_POSTINGS postings and sorts each term's list by impact.  For an item it reads the lists of its terms from the
top, side by side, and fetches the impacts of every new document from all other lists by direct access, which also marks
the positions where they were found.  A list's best position is the last one up to which all were seen, by either way;
a document that was not seen stands behind it in every list.  So no such document scores more than the sum of the
impacts that follow the best positions, which is at most the sum at the last-read ones.  Reading stops once that sum is
strictly below the k-th best score found by the task so far: a document of equal score might have the lesser id.

Scale.  The items come in blocks of BLOCK_BYTES of text; a block's terms are what the tasks are sent.  For each block the
texts are read once, the index lies in the shared folder, and the counts are grouped with partial aggregation.  Every
task returns k documents an item at most, which a ranking by item merges.

Defined cases.  Null or empty text and texts without terms have no postings; an item without terms finds nothing.  Rows
are documents of their own, also with repeated or null ids; among equal scores the lesser id comes first, null last.
Items with the same id are ranked one by one.  Other columns are ignored.  Empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import LOWER_KEYS, drop_saved, item_blocks, lists, map_batches, saved, tune, utf8, word_hashes, word_spans

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
IS_BREAK = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
#: Text of the items that are searched for at once.
BLOCK_BYTES = 1 << 20
#: Postings of a shard.
SHARD_POSTINGS = 1 << 20
#: Positions read of each list at first; each further reading doubles them, up to the second number.
FIRST_READ, LONGEST_READ = 16, 1024


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and row of each term of a batch."""
    start, end, row = word_spans(data, offsets, IS_BREAK)
    return word_hashes(data, start, end, LOWER_KEYS), row


def index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Posting lists of the terms (sorted fingerprints), a row for each batch of documents.

    ids, n: the documents that hold a term, and their terms in all.  term, df: the lists; doc, tf: their postings end to
    end, doc being a place in ids.  n_docs, n_terms: of all documents of the batch.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        hashes, row = _hashes(*utf8(b.column("text")))
        n = np.bincount(row, minlength=b.num_rows)
        at = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
        hit = terms[at] == hashes if len(terms) else np.zeros(len(hashes), bool)
        key, tf = np.unique(at[hit].astype(np.int64) * b.num_rows + row[hit], return_counts=True)
        term, doc = np.divmod(key, b.num_rows)
        held, place = np.unique(doc, return_inverse=True)
        term, df = np.unique(term, return_counts=True)
        one = lambda x, t: lists(x, np.array([len(x)]), t)
        ids = b.column("doc_id").take(pa.array(held))
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), one(n[held], pa.int64()), one(term.astype(np.int32), pa.int32()), one(df.astype(np.int32), pa.int32()),
             one(place.astype(np.int32), pa.int32()), one(tf.astype(np.int32), pa.int32()), pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])],
            ["ids", "n", "term", "df", "doc", "tf", "n_docs", "n_terms"])
    return saved(map_batches(docs, run, f"ids array<{kind}>, n array<long>, term array<int>, df array<int>, doc array<int>, tf array<int>, n_docs long, n_terms long"), "search_index")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """Impact lists of the terms, by impact from the top and, for direct access, by document."""

    def __init__(self, ids: list, n: np.ndarray, term: np.ndarray, doc: np.ndarray, tf: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids = ids
        length = 10 + np.array([90 * x * n_docs // n_terms for x in n.tolist()], np.int64)  # of any size in Python
        tf = tf.astype(np.int64)
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * length[doc]))
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, term = doc[order], impact[order], term[order]
        self.start, self.end = np.searchsorted(term, np.arange(len(weights))), np.searchsorted(term, np.arange(len(weights)), side="right")
        by_doc = np.lexsort((self.doc, term))  # within a list: its positions in the order of documents
        self.by_doc, self.sorted_doc = by_doc, self.doc[by_doc]

    def best(self, terms: np.ndarray, k: int, top: list[tuple]) -> tuple[list[tuple], int]:
        """The k best of `top` and the shard's documents, as (-score, id is null, id); and how many documents were scored."""
        lists_ = [(a, b) for a, b in zip(self.start[terms].tolist(), self.end[terms].tolist(), strict=True) if b > a and self.impact[a] > 0]
        known, met = np.zeros(len(self.ids), bool), [np.zeros(b - a, bool) for a, b in lists_]
        best, n_seen, at, step = [0] * len(lists_), 0, 0, FIRST_READ
        while lists_:
            read = np.unique(np.concatenate([self.doc[a + at:min(a + at + step, b)] for a, b in lists_]))
            new = read[~known[read]]
            known[new] = True
            n_seen += len(new)
            score, bound = np.zeros(len(new), np.int64), 0
            for i, (a, b) in enumerate(lists_):
                seen = met[i]
                if len(new):  # direct access
                    own = self.sorted_doc[a:b]
                    place = np.minimum(np.searchsorted(own, new), b - a - 1)
                    has = own[place] == new
                    position = self.by_doc[a:b][place[has]]
                    score[has] += self.impact[position]
                    seen[position - a] = True
                p = best[i]
                while p < len(seen) and (gap := np.flatnonzero(~seen[p:p + LONGEST_READ])).size == 0:
                    p += LONGEST_READ
                best[i] = p = min(len(seen), p + int(gap[0])) if p < len(seen) else len(seen)
                bound += int(self.impact[a + p]) if p < len(seen) else 0
            least = -top[k - 1][0] if len(top) >= k else 1
            good = np.flatnonzero(score >= least)
            if len(good):
                if len(good) > 4 * k:  # only what is among the k best of these, with all equal ones
                    good = good[score[good] >= np.partition(score[good], len(good) - k)[len(good) - k]]
                found = [(-s, self.ids[d] is None, self.ids[d]) for s, d in zip(score[good].tolist(), new[good].tolist(), strict=True)]
                top = sorted(top + found, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]
            if bound < (-top[k - 1][0] if len(top) >= k else 1):
                break
            at, step = at + step, min(2 * step, LONGEST_READ)
        return top, n_seen


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    tune(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    blocks = item_blocks(items, item_col, item_text_col, BLOCK_BYTES)
    item = blocks.schema["item_id"].dataType.simpleString()
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = [_block(docs, blocks.filter(F.col("block") == r["block"]), k) for r in blocks.select("block").distinct().orderBy("block").collect()]
    found = reduce(DataFrame.unionByName, out) if out else docs.sparkSession.createDataFrame([], f"block long, at long, doc_id {kind}, score long")
    place = Window.partitionBy("block", "at").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return best.join(blocks.select("block", "at", F.col("item_id").cast(item).alias("item_id")), ["block", "at"]).select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, block: DataFrame, k: int) -> DataFrame:
    """(block, at, doc_id, score): the best k of each task for each item of a block."""
    rows = block.select("block", "at", "text").orderBy("at").toArrow()  # BLOCK_BYTES of text, or one item
    hashes, row = _hashes(*utf8(rows.column("text").combine_chunks()))
    terms = np.unique(hashes)
    own = [np.unique(np.searchsorted(terms, hashes[row == i])) for i in range(len(rows))]
    name, at = rows.column("block")[0].as_py(), rows.column("at").to_pylist()

    lists_ = index(docs, terms)
    n_docs, n_terms = lists_.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = lists_.select(F.inline(F.arrays_zip("term", "df"))).groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    weights = np.zeros(len(terms), np.int64)
    for t, n in zip(df.column("term").to_pylist(), df.column("df").to_pylist(), strict=True):
        weights[t] = weight(n_docs, n)
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        top: list[list[tuple]] = [[] for _ in at]
        parts: list[tuple] = []

        def search() -> None:
            if not parts:
                return
            before = np.cumsum([0, *(len(p[0]) for p in parts)])
            shard = Shard([x for p in parts for x in p[0]], np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]),
                          np.concatenate([p[3] + s for p, s in zip(parts, before.tolist(), strict=False)]), np.concatenate([p[4] for p in parts]), weights, n_docs, n_terms)
            parts.clear()
            for i, t in enumerate(own):
                top[i], _ = shard.best(t, k, top[i])

        for b in batches:
            values = lambda c, i: b.column(c)[i].values.to_numpy(zero_copy_only=False)  # noqa: B023, E731
            for i in range(b.num_rows):
                if len(b.column("term")[i].values):
                    parts.append((b.column("ids")[i].as_py(), values("n", i), np.repeat(values("term", i), values("df", i)), values("doc", i).astype(np.int64), values("tf", i)))
                if sum(len(p[3]) for p in parts) >= SHARD_POSTINGS:
                    search()
        search()
        found = [(name, at[i], x[2], -x[0]) for i, best in enumerate(top) for x in best]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), to_arrow_type(kind), pa.int64()), strict=True)],
                                             ["block", "at", "doc_id", "score"])
    out = saved(lists_.select("ids", "n", "term", "df", "doc", "tf").mapInArrow(run, f"block long, at long, doc_id {kind.simpleString()}, score long"), "search_found")
    drop_saved(lists_)
    return out


#: The ranking in plain SQL.
RANKED_SQL = r"""
with t as (select doc_id, row_number() over () as row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
d as (select doc_id, row, len(w)::bigint as n from t where len(w) > 0),
c as (select count(*)::bigint as nd, sum(n)::bigint as l from d),
p as (select row, term, count(*)::bigint as tf from (select row, unnest(w) as term from t) group by row, term),
f as (select term, floor(1000 * ln((2 * nd + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from p, c group by term, nd),
i as (select distinct item_id, item, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from (select *, row_number() over () as item from benchmark)),
s as (select item_id, item, d.doc_id, d.row, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::bigint as score
      from i join f using (term) join p using (term) join d using (row), c group by item_id, item, d.doc_id, d.row)
select item_id, rank, doc_id, score from (select *, (row_number() over (partition by item order by score desc, doc_id nulls last))::int as rank from s where score > 0) where rank <= 10
"""
