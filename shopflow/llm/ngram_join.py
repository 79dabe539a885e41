"""N-gram Jaccard join with adaptive multi-match prefixes, and the near-duplicate classes that its links form.

A text's set holds the 64-bit fingerprints of its distinct word shingles.  All sets are sorted by one global order that
puts frequent shingles last.  With a link threshold t, two sets of sizes n and m that link share at least
T = ceil(t (n + m) / (1 + t)) shingles, so their prefixes of n - T + l and m - T + l shingles share at least l
(l = 1 is the classic prefix filter).  Each set picks its own l by the estimated cost of its candidates: a longer prefix
meets more posting lists but asks for l shared shingles before a pair is verified.  A pair uses the smaller l of the two.

Scale.  Equal sets are one node, so copies are never expanded.  Postings go by shingle, those that only one set has leave
at once.  In a posting list that many sets share, every set is first held against one pivot (linear work); what that
links is one class, and the pair join then skips pairs within a class, shingles that only one class has, and rows whose
place in the prefix no partner of the list can make up for.  Nothing is capped: these steps skip only pairs whose answer
can't change the classes.  The table of frequent shingles has a fixed size, and only orders the shingles.

Defined cases.  Null, empty or blank text: no shingles, linked with nothing, its own class.  Fewer than k words: the
whole sequence is the one shingle.  Repeated doc_ids are separate rows; a null doc_id is a row like any other and never
names a class unless all its members are null.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, lists, map_batches, mixed, saved, shingles, tune, utf8, word_hashes, word_spans

#: Longest prefix extension, in shingles.
MAX_MATCHES = 4
#: Frequent shingles that the global order knows; more only make the order better.
FREQUENT = 1 << 16
#: A posting list of more sets than this is held against its pivot first.
DENSE = 16


def _tokens(batch: pa.RecordBatch, text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(batch.column(text))
    start, end, row = word_spans(data, offsets)
    return shingles(word_hashes(data, start, end), row, batch.num_rows, k)


def _node(rows: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint for each set: equal sets are one node."""
    total = np.zeros(len(sizes), np.uint64)
    np.add.at(total, rows, mixed(tokens ^ np.uint64(0x9E3779B97F4A7C15)))
    return mixed(total + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def _digest(text: Column) -> Column:
    """128 bits that tell the texts of one id apart, without a copy of the text as a cryptographic digest takes."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def frequent_shingles(docs: DataFrame, text: str, k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and their ranks, rarest first; counts leave a task only where it saw three or more."""
    def count(batches):
        kept = []
        for b in batches:
            kept.append(_tokens(b, text, k)[1])
            if sum(map(len, kept)) > 4_000_000:
                yield from flush(kept)
                kept = []
        yield from flush(kept)

    def flush(kept):
        values, n = np.unique(np.concatenate(kept), return_counts=True) if kept else (np.zeros(0, np.uint64), np.zeros(0, int))
        often = n >= 3
        values, n = values[often], n[often]
        for i in range(0, len(values), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(values[i:i + 100_000].view(np.int64)), pa.array(n[i:i + 100_000].astype(np.int64))], ["token", "n"])

    top = docs.select(text).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "token").limit(size).toArrow()
    value = top.column("token").to_numpy().view(np.uint64)[::-1]
    order = np.argsort(value)
    return value[order], np.arange(1, len(value) + 1, dtype=np.int64)[order]


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id): sets link when 100 * intersection >= percent * union, shingles of k words.

    component_id is the least doc_id that links reach; see the module for the defined cases.
    """
    spark = docs.sparkSession
    tune(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), _digest(F.col(text_col)).alias("digest"))
    heavy, rank = frequent_shingles(docs, "text", k, FREQUENT)

    def prefixes(b: pa.RecordBatch) -> pa.RecordBatch:
        row, token = _tokens(b, "text", k)
        size = np.bincount(row, minlength=b.num_rows)
        at = np.searchsorted(heavy, token)
        place = np.zeros(len(token), np.int64)
        if len(heavy):
            known = heavy[np.minimum(at, len(heavy) - 1)] == token
            place[known] = rank[at[known]]
        order = np.lexsort((token, place, row))
        first = np.cumsum(size) - size
        pos = np.arange(len(token)) - np.repeat(first, size)
        keep = np.minimum(size, size - (percent * size + 99) // 100 + MAX_MATCHES)
        inside = pos < np.repeat(keep, size)
        light = np.bincount(row[order][inside & (place[order] == 0)], minlength=b.num_rows)
        node = pa.array(_node(row, token, size), mask=size == 0)
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("digest"), pa.array(size.astype(np.int64)), node, pa.array(light.astype(np.int32)),
             lists(token[order][inside].view(np.int64), keep, pa.int64())], ["doc_id", "digest", "n", "node", "light", "prefix"])

    kind = dict(docs.dtypes)["doc_id"]
    base = saved(map_batches(docs, prefixes, f"doc_id {kind}, digest struct<a: bigint, b: bigint>, n long, node long, light int, prefix array<long>"), "ngram_base")
    sets = base.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "digest")).alias("row"), F.first("n").alias("n"), F.first("light").alias("light"), F.first("prefix").alias("prefix"))
    posting = sets.select("node", "n", "light", F.posexplode("prefix").alias("pos", "token")) \
        .withColumn("tail", F.col("pos") >= F.col("light"))
    # by shingle once: the count and the rows meet in the same partitions; frequent shingles are counted ahead of any shuffle
    of = lambda p: p.groupBy("token").agg(F.count("*").alias("df"), F.min("n").alias("least_n"), F.min(F.struct("pos", "node", "n")).alias("pivot")).filter("df > 1")
    rare = posting.filter("not tail").select("token", "node", F.col("n").cast("int").alias("n"), "pos").repartition("token")
    often = posting.filter("tail").select("token", "node", F.col("n").cast("int").alias("n"), "pos")
    shared = saved(rare.join(of(rare).hint("merge"), "token")
                   .unionByName(often.join(F.broadcast(of(often)), "token")), "ngram_postings")  # at most FREQUENT rows
    links = None
    label = None
    dense = shared.filter(F.col("df") > DENSE).filter("node <> pivot.node") \
        .select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("pivot.node").alias("b"), F.col("pivot.n").alias("nb")) \
        .filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b").distinct()
    links = _verified(dense, sets, docs, k, percent, "ngram_pivot")
    label = components(links, "ngram_pivot_classes")

    pairs = _candidates(shared, label, percent)
    links = links.unionAll(_verified(pairs, sets, docs, k, percent, "ngram_links"))
    label = saved(components(links, "ngram_classes"), "ngram_labels")
    row = base.select("doc_id", "n", "node").join(label, "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    least = row.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return row.join(least, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of docs for each near-duplicate class: that of least id, null last, then of least text digest.

    Rows that agree in both are told apart by the JSON of all their columns, the least of which stays.
    """
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), _digest(F.coalesce(text_col, F.lit(""))).alias("digest"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key"), F.col(text_col).alias("text"))
    stay = near_duplicates(keyed, "key", "text", **options).filter("doc_id = component_id").groupBy(F.col("doc_id").alias("of")).agg(F.count("*").alias("n"))
    rows = keyed.join(saved(stay, "ngram_stay"), F.col("key") == F.col("of")).select("key", "n", "row")
    one = rows.filter("n = 1").select("row").unionByName(rows.filter("n > 1").groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row"))
    return one.select("row.*")


def _candidates(shared: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different classes that share l shingles of their l-prefixes."""
    reach = lambda n, m: f"cast(ceil({percent} * ({n} + {m}) / {100 + percent}.0) as int)"
    plain = lambda matches: f"n - cast(ceil({percent} * n / 100.0) as int) + {matches}"
    # for each l: posting rows met, plus what verifying the candidates that can reach l matches costs at most
    met = [F.sum(F.when(F.expr(f"pos < {plain(m)}"), F.col("df") - 1).otherwise(0)) for m in range(1, MAX_MATCHES + 1)]
    cost = [s * (1 + F.first("n") / F.lit(16.0 * m)) for m, s in enumerate(met, 1)]
    best = F.least(*cost)
    choice = F.lit(MAX_MATCHES)
    for m in range(MAX_MATCHES - 1, 0, -1):
        choice = F.when(cost[m - 1] <= best, m).otherwise(choice)
    chosen = shared.groupBy("node").agg(choice.alias("l"))
    rows = shared.join(chosen, "node").join(label, "node", "left") \
        .select("token", "node", "n", "pos", "l", "least_n", F.coalesce("label", "node").alias("class"))
    # the least partner of the list sets the longest prefix that can matter
    rows = rows.filter(f"pos < {plain('l')} and pos <= n - {reach('n', f'greatest(least_n, cast(ceil({percent} * n / 100.0) as int))')} + l - 1")
    mixed_lists = rows.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo <> hi").select("token")
    rows = saved(rows.join(mixed_lists, "token").drop("least_n"), "ngram_rows")
    a, b = rows.alias("a"), rows.alias("b")
    total = reach("a.n", "b.n")
    least_l = f"least(a.l, b.l, {total})"
    met = a.join(b, F.expr(
        f"a.token = b.token and a.node < b.node and a.class <> b.class "
        f"and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) "
        f"and a.pos <= a.n - {total} + {least_l} - 1 and b.pos <= b.n - {total} + {least_l} - 1 "
        f"and least(a.pos, b.pos) + least(a.n - a.pos, b.n - b.pos) >= {total}"))
    return met.groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b")) \
        .agg(F.count("*").alias("hits"), F.first(F.expr(least_l)).alias("l")).filter("hits >= l").select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """The pairs whose whole sets link.  A node's text comes from one row of it, found by doc_id and digest, so rows
    without id and of one id are told apart."""
    pairs = saved(pairs, name + "_pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct() \
        .join(sets.select("node", F.col("row.doc_id").alias("of_id"), F.col("row.digest").alias("of_digest")), "node")

    def tokens(b: pa.RecordBatch) -> pa.RecordBatch:
        row, token = _tokens(b, "text", k)
        size = np.bincount(row, minlength=b.num_rows)
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = [token[ends[i]:ends[i + 1]].tobytes() for i in range(b.num_rows)]
        return pa.RecordBatch.from_arrays([b.column("node"), pa.array(raw, pa.binary())], ["node", "tokens"])

    full = docs.join(wanted, (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of_id"))).select("node", "text").dropDuplicates(["node"])
    full = saved(map_batches(full, tokens, "node long, tokens binary"), name + "_sets")

    def linked(b: pa.RecordBatch) -> pa.RecordBatch:
        ok = []
        for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
            n, m = len(x) // 8, len(y) // 8
            both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
            both.sort()
            same = int((both[1:] == both[:-1]).sum())
            ok.append(100 * same >= percent * (n + m - same))
        keep = pa.array(ok)
        return pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], ["a", "b"])

    joined = pairs.join(full.select(F.col("node").alias("a"), F.col("tokens").alias("x")), "a") \
        .join(full.select(F.col("node").alias("b"), F.col("tokens").alias("y")), "b").select("a", "b", "x", "y")
    return saved(map_batches(joined, linked, "a long, b long"), name)


#: The classes in plain SQL, all links expanded: for small tables.
NEAR_SQL = r"""
with recursive t as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
             else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from t),
n as (select doc_id, count(*) as n from s group by doc_id),
l as (select a.doc_id as a, b.doc_id as b from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
      join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
      group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r as (select a as doc_id, a as c from l union select r.doc_id, l.b from r join l on r.c = l.a)
select t.doc_id, coalesce(any_value(n.n), 0)::bigint as n_shingles, least(t.doc_id, coalesce(min(r.c), t.doc_id)) as component_id
from t left join n using (doc_id) left join r using (doc_id) group by t.doc_id
"""
