"""Suffix-array dedup: bytes covered by a string of LENGTH bytes that also starts earlier, over all texts.

Which texts need sorting.  Of the k-grams of every LENGTH-byte window the one of least hash is its anchor, so equal windows
have equal anchors at equal places.  What the windows of an anchor cover is its piece.
Anchors that occur once leave.  Occurrences with equal pieces need no sorting: the first stays, the others are repeats from
end to end.  Where pieces of one anchor differ, one of each goes to the shard of the anchor, and there the suffixes of all
pieces are sorted.  An anchor whose occurrences exceed SHARD bytes (a frequent line in varying contexts) goes to no shard: its
pieces are cut into their windows, and the first occurrence of each window is a grouped minimum over 128-bit fingerprints.

Induced sorting (shard level).  Suffixes are of type L or S by the next different character.  The LMS suffixes (an S
after an L) are sorted by inducing their substrings, naming these, and sorting the string of names, again by induction
while its alphabet is small; from them all others are induced.  The queues that hand a suffix to the bucket of its
predecessor are one per first character, in rank order.  Sorted neighbours with a common prefix of LENGTH bytes are one
class: its first occurrence stays.  A shard is sorted in the memory of its task: its pieces and some ten arrays of 8 bytes for
each of its bytes; it has less than twice SHARD bytes, whatever the data.  Only the string, the order and the queues move to
disk beyond IN_MEMORY elements.

Scale.  A text gives an anchor every 43 bytes or so; one shuffle of anchors, one of the texts that hold differing pieces,
one of the repeated spans, and of the windows of frequent anchors one for the minimum and one for the join with it.  No group
is collected: counts and first occurrences are aggregates.

Defined cases.  Null text is read as empty; texts shorter than LENGTH bytes have no repeats.  Order is by doc_id, null
last; rows of the same doc_id by their text, and rows with the same doc_id and text are one document: they get the same
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BYTE_KEYS, POWER, map_batches, mixed, saved, tune, utf8

LENGTH = 100
GRAM = 16
#: k-grams of a window.
SPREAD = LENGTH - GRAM + 1
#: Bytes of a text hashed at a time; places must fit in 24 bits.
SEGMENT = 1 << 22
#: Bytes at which a shard is full, and above which an anchor is cut into windows; elements that a queue or an array holds in memory.
SHARD, IN_MEMORY = 4_000_000, 8_000_000
#: Random values of the bytes for a second, independent fingerprint.
OTHER_KEYS = np.random.default_rng(20240602).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Names above which a string of names is sorted directly: each is a bucket of the induction.
MAX_BUCKETS = 2000
UNPOWER = np.uint64(pow(int(POWER), -1, 2**64))


class Hashes:
    """Fingerprints of any slice of some bytes, from running sums."""

    def __init__(self, data: np.ndarray, keys: np.ndarray = BYTE_KEYS):
        power = np.full(len(data) + 1, POWER)
        back = np.full(len(data) + 1, UNPOWER)
        power[0] = back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(keys[data] * np.cumprod(power)[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of `width` keys, by prefix and suffix minima of blocks."""
    n = len(key)
    full = -(-n // width) * width
    padded = np.full(full, ~np.uint64(0))
    padded[:n] = key
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, start and length of the piece, anchor hash and piece hash of every anchor, in order.

    The windows of an anchor follow one another; its piece is what they cover.
    """
    out = []
    low = np.uint64((1 << 24) - 1)
    for a in range(0, len(data), SEGMENT):
        b = min(len(data), a + SEGMENT)  # windows that start in [a, b)
        left, right = max(0, a - SPREAD + 1), min(len(data), b + SPREAD - 1 + LENGTH)
        if right - a < LENGTH:
            break
        part = data[left:right]
        hashes = Hashes(part)
        at = np.arange(len(part) - GRAM + 1)
        gram = hashes.of(at, at + GRAM)
        least = _least((gram & ~low) | at.astype(np.uint64), SPREAD)  # of the window at each place of part
        starts = np.arange(a, min(b, left + len(least)))
        row = np.searchsorted(offsets, starts, side="right") - 1
        starts, row = starts[starts + LENGTH <= offsets[row + 1]], row[starts + LENGTH <= offsets[row + 1]]
        place = (least[starts - left] & low).astype(np.int64) + left
        place, one, n = np.unique(place, return_index=True, return_counts=True)
        row, lo, hi = row[one], starts[one], starts[one + n - 1] + LENGTH
        piece = mixed(hashes.of(lo - left, hi - left) ^ (place - lo).astype(np.uint64))
        out.append((row, lo - offsets[row], hi - lo, gram[place - left], piece))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Piece, place in it and two fingerprints of every window of the pieces data[offsets[i]:offsets[i + 1]]."""
    n = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    piece = np.repeat(np.arange(len(n)), n)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    start = offsets[piece] + at
    return piece, at, *(Hashes(data, keys).of(start, start + LENGTH) for keys in (BYTE_KEYS, OTHER_KEYS))


class Disk:
    """A scratch folder of one task: arrays beyond IN_MEMORY elements and the tails of queues."""

    def __init__(self):
        self.path, self.n = None, 0

    def file(self) -> Path:
        self.path = self.path or Path(tempfile.mkdtemp(prefix="suffixes-"))
        self.n += 1
        return self.path / str(self.n)

    def array(self, n: int, kind: type) -> np.ndarray:
        return np.zeros(n, kind) if n <= IN_MEMORY else np.memmap(self.file(), kind, "w+", shape=(n,))

    def close(self) -> None:
        if self.path:
            shutil.rmtree(self.path, ignore_errors=True)


class Queue:
    """Places in rank order, first in, first out; on disk beyond the bound."""

    def __init__(self, disk: Disk, bound: int):
        self.disk, self.bound, self.parts, self.held, self.files = disk, bound, [], 0, []

    def put(self, places: np.ndarray) -> None:
        if len(places):
            self.parts.append(places)
            self.held += len(places)
            if self.held > self.bound:
                path = self.disk.file()
                np.concatenate(self.parts).tofile(path)
                self.files.append(path)
                self.parts, self.held = [], 0

    def take(self) -> Iterator[np.ndarray]:
        """Everything put so far; what is put meanwhile stays for the next call."""
        files, parts, self.files, self.parts, self.held = self.files, self.parts, [], [], 0
        for path in files:
            yield np.fromfile(path, np.int64)
            path.unlink()
        if parts:
            yield np.concatenate(parts)

    def __bool__(self) -> bool:
        return bool(self.files or self.parts)


def _hand_on(queues: list[Queue], text: np.ndarray, places: np.ndarray) -> None:
    """Each place to the queue of its character, in order."""
    if len(places):
        chars = text[places]
        order = np.argsort(chars, kind="stable")
        chars, places = chars[order], places[order]
        cuts = np.concatenate([[0], np.flatnonzero(chars[1:] != chars[:-1]) + 1, [len(chars)]])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            queues[chars[a]].put(places[a:b])


def _induce(text: np.ndarray, n_chars: int, small: np.ndarray, lms: list[np.ndarray], disk: Disk) -> np.ndarray:
    """All suffixes in order, from the LMS suffixes of each bucket in order."""
    bound = max(1000, IN_MEMORY // max(1, n_chars))
    queues = [Queue(disk, bound) for _ in range(n_chars)]
    large: list[list[np.ndarray]] = [[] for _ in range(n_chars)]
    for c in range(n_chars):
        while queues[c]:
            for places in queues[c].take():
                large[c].append(places)
                before = places[places > 0] - 1
                _hand_on(queues, text, before[~small[before]])
        if len(lms[c]):
            _hand_on(queues, text, lms[c][lms[c] > 0] - 1)
    out, end = disk.array(len(text), np.int64), len(text)
    for c in range(n_chars - 1, -1, -1):
        while queues[c]:
            for places in queues[c].take():
                out[end - len(places):end] = places[::-1]
                end -= len(places)
                before = places[places > 0] - 1
                _hand_on(queues, text, before[small[before]])
        for places in reversed(large[c]):
            out[end - len(places):end] = places
            end -= len(places)
            before = places[::-1]
            before = before[before > 0] - 1
            _hand_on(queues, text, before[small[before]])
        if c == 0:  # the end mark is the one S suffix that nothing induces
            end -= 1
            out[end] = len(text) - 1
    return out


def _doubled(names: np.ndarray, depth: int | None) -> np.ndarray:
    """The suffixes of a string over many names, by prefix doubling of those that still tie; up to `depth` names if given."""
    n, width = len(names), 1
    order = np.argsort(names)
    sorted_names = names[order]
    head = np.concatenate([[True], sorted_names[1:] != sorted_names[:-1]])
    rank = np.empty(n, np.int64)  # where the group of ties begins
    rank[order] = np.flatnonzero(head)[np.cumsum(head) - 1]
    live = np.arange(n)
    while depth is None or width < depth:
        live = live[np.bincount(rank[live], minlength=n)[rank[live]] > 1]
        if not len(live):
            break
        after = np.zeros(len(live), np.int64)
        inside = live + width < n
        after[inside] = rank[live[inside] + width] + 1
        key = rank[live] * (n + 1) + after
        order = np.argsort(key)
        key, old = key[order], rank[live[order]]
        at = np.arange(len(live))
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), at, 0))
        part = np.maximum.accumulate(np.where(np.concatenate([[True], key[1:] != key[:-1]]), at, 0))
        rank[live[order]] = old + part - group
        width *= 2
    return np.argsort(rank)


def suffix_order(text: np.ndarray, n_chars: int, disk: Disk, depth: int | None = None) -> np.ndarray:
    """The places of a string in the order of their suffixes; its last character is 0 and occurs nowhere else.

    With a depth, suffixes that agree in so many characters may come in any order.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    # S: the next different character is larger; looked up at the end of each run
    ends = np.concatenate([np.flatnonzero(text[1:] != text[:-1]), [n - 1]])
    grows = np.concatenate([text[ends[:-1] + 1] > text[ends[:-1]], [True]])
    small = np.repeat(grows, np.diff(np.concatenate([[-1], ends])))
    places = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(places) == 1:  # only the end mark
        order = places
    else:
        by_char = lambda p: np.split(p[np.argsort(text[p], kind="stable")], np.cumsum(np.bincount(text[p], minlength=n_chars))[:-1])
        first = _induce(text, n_chars, small, by_char(places), disk)
        is_lms = np.zeros(n, bool)
        is_lms[places] = True
        ordered = first[is_lms[first]]
        # names: equal LMS substrings get one; the substring reaches to the next LMS place
        nth = np.searchsorted(places, ordered)
        stop = np.minimum(np.concatenate([places[1:], [n - 1]])[nth] + 1, n)
        keys = _substring_keys(text, ordered, stop)
        new = np.ones(len(ordered), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (np.diff(stop - ordered) != 0)
        names = np.empty(len(places), np.int64)
        names[nth] = np.cumsum(new) - 1
        n_names = int(new.sum())
        if n_names == len(places):
            order = ordered
        else:
            # an LMS substring has two characters of its own at least
            deep = None if depth is None else depth // 2 + 2
            order = places[suffix_order(names, n_names, disk, deep) if n_names <= MAX_BUCKETS else _doubled(names, deep)]
    lms = np.split(order, np.cumsum(np.bincount(text[order], minlength=n_chars))[:-1])
    return _induce(text, n_chars, small, lms, disk)


def _substring_keys(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    value = mixed(text.astype(np.uint64) + np.uint64(0x9E37))
    power = np.full(len(text) + 1, POWER)
    back = np.full(len(text) + 1, UNPOWER)
    power[0] = back[0] = 1
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(value * np.cumprod(power)[:-1], out=sums[1:])
    return mixed((sums[stop] - sums[start]) * np.cumprod(back)[start])


def repeated_in(pieces: list[tuple[int, int, bytes]]) -> list[tuple[int, int, int]]:
    """(rid, start, end) of what the pieces (rid, place of the first byte, bytes) hold a second time or later.

    A window that several pieces of one text hold is one occurrence.
    """
    disk = Disk()
    try:
        lens = np.array([len(p) for _, _, p in pieces])
        first = np.cumsum(lens + 1) - lens - 1
        text = disk.array(int((lens + 1).sum()) + 1, np.int16)
        for f, (_, _, p) in zip(first.tolist(), pieces, strict=True):
            text[f:f + len(p)] = np.frombuffer(p, np.uint8).astype(np.int16) + 2
            text[f + len(p)] = 1
        order = suffix_order(np.asarray(text), 258, disk, LENGTH)
        piece = np.searchsorted(first, order, side="right") - 1
        at = order - first[piece]
        whole = at + LENGTH <= lens[piece]
        order, piece, at = order[whole], piece[whole], at[whole]
        # sorted neighbours that have LENGTH bytes in common: by their fingerprints, then byte by byte
        same = np.zeros(len(order), bool)
        keys = _substring_keys(text, order, order + LENGTH)
        like = np.flatnonzero(keys[1:] == keys[:-1]) + 1
        window = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
        for a in range(0, len(like), 20_000):
            pick = like[a:a + 20_000]
            same[pick] = (window[order[pick - 1]] == window[order[pick]]).all(axis=1)
        label = np.cumsum(~same)
        rid = np.array([r for r, _, _ in pieces], np.int64)[piece]
        start = np.array([s for _, s, _ in pieces], np.int64)[piece] + at
        many = np.bincount(label)[label] > 1
        label, rid, start, piece = label[many], rid[many], start[many], piece[many]
        by = np.lexsort((start, rid, label))
        label, rid, start = label[by], rid[by], start[by]
        head = np.ones(len(label), bool)
        head[1:] = label[1:] != label[:-1]
        lead = np.flatnonzero(head)[np.cumsum(head) - 1]
        later = (rid != rid[lead]) | (start != start[lead])
        spots = np.unique(np.stack([rid[later], start[later]], 1), axis=0)
        if not len(spots):
            return []
        cut = np.ones(len(spots), bool)
        cut[1:] = (spots[1:, 0] != spots[:-1, 0]) | (spots[1:, 1] != spots[:-1, 1] + 1)
        begin = np.flatnonzero(cut)
        last = np.concatenate([begin[1:], [len(spots)]]) - 1
        return list(zip(spots[begin, 0].tolist(), spots[begin, 1].tolist(), (spots[last, 1] + LENGTH).tolist(), strict=True))
    finally:
        disk.close()


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, rid): rid orders documents.  It is doc_id itself where that is unique and whole."""
    n, distinct, known = docs.agg(F.count("*"), F.countDistinct("doc_id"), F.count("doc_id")).first()
    if n == distinct == known and dict(docs.dtypes)["doc_id"] in ("bigint", "int"):
        return docs.withColumn("rid", F.col("doc_id").cast("long"))
    by = [F.col("doc_id").asc_nulls_last(), F.col("key")]
    keyed = docs.withColumn("key", F.sha2("text", 256))
    placed = saved(keyed.select("doc_id", "key").distinct().repartitionByRange(*by).withColumn("part", F.spark_partition_id())
                   .withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(*by))), "repeat_rows")
    before, starts = 0, []
    for r in sorted(placed.groupBy("part").count().collect()):
        starts.append((r["part"], before))
        before += r["count"]
    starts = docs.sparkSession.createDataFrame(starts or [(0, 0)], "part int, before long")
    ids = placed.join(F.broadcast(starts), "part").select(F.col("doc_id").alias("id"), F.col("key").alias("k"), (F.col("before") + F.col("nth")).alias("rid"))
    return keyed.join(ids, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("k"))).select("doc_id", "text", "rid")


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): kept are the remaining bytes."""
    return removed(docs, lambda spans, raw: b"".join(raw[a:b] for a, b in _rest(spans, len(raw))), "kept binary", pa.binary())


def _rest(spans: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    cuts = [0, *[x for s in spans for x in s], n]
    return [(a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=True) if a < b]


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    def digest(spans: list[tuple[int, int]], raw: bytes) -> str:
        h = hashlib.sha256()
        for a, b in _rest(spans, len(raw)):
            h.update(raw[a:b])
        return h.hexdigest()
    return removed(docs, digest, "kept_sha256 string", pa.string())


def removed(docs: DataFrame, result, column: str, kind: pa.DataType) -> DataFrame:
    """What remains of each text, put into `column` by result(removed spans, bytes)."""
    tune(docs.sparkSession)
    rows = _numbered(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))

    def found(b: pa.RecordBatch) -> pa.RecordBatch:
        row, start, length, gram, piece = anchors(*utf8(b.column("text")))
        return pa.RecordBatch.from_arrays([b.column("rid").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(gram.view(np.int64)), pa.array(piece.view(np.int64))],
                                          ["rid", "start", "length", "gram", "piece"])

    spot = map_batches(rows.select("rid", "text"), found, "rid long, start long, length long, gram long, piece long").repartition("gram")
    # all columns are used on both sides of the join, so that they read one shuffle
    group = spot.groupBy("gram").agg(F.count("*").alias("n"), (F.min("piece") != F.max("piece")).alias("differ"), (F.sum("length") > SHARD).alias("frequent"),
                                     F.min(F.struct("rid", "start", "length")).alias("least")).filter("n > 1 and least is not null")
    shared = saved(spot.join(group.select("gram", "differ", "frequent", "least").hint("merge"), "gram").drop("least"), "repeat_anchors")
    first = shared.groupBy("gram", "piece").agg(F.min(F.struct("rid", "start", "length")).alias("first"), F.first("differ").alias("differ"), F.first("frequent").alias("frequent"), F.count("*").alias("n"))
    again = shared.join(first.filter("n > 1").select("gram", "piece", "first"), ["gram", "piece"]) \
        .filter("first.rid <> rid or first.start <> start").select("rid", "start", (F.col("start") + F.col("length")).alias("end"))

    # one of each differing piece, with its bytes
    wanted = first.filter("differ").select("gram", "frequent", "first.*").groupBy("rid").agg(F.collect_list(F.struct("gram", "frequent", "start", "length")).alias("spots"))

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for rid, text, spots in zip(b.column("rid").to_pylist(), b.column("text").to_pylist(), b.column("spots").to_pylist(), strict=True):
            raw = text.encode()
            for s in spots:
                # pieces of a frequent anchor are no shard: they are dealt by their places
                out.append((s["gram"], rid ^ s["start"] if s["frequent"] else None, rid, s["start"], raw[s["start"]:s["start"] + s["length"]]))
        gram, deal, rid, start, piece = zip(*out, strict=True) if out else ((), (), (), (), ())
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (gram, deal, rid, start)), pa.array(piece, pa.binary())],
                                          ["gram", "deal", "rid", "start", "piece"])

    pieces = map_batches(rows.join(wanted, "rid").select("rid", "text", "spots"), cut, "gram long, deal long, rid long, start long, piece binary") \
        .repartition("gram", "deal").sortWithinPartitions("gram")

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The repeated spans of each shard, without bytes; the pieces of frequent anchors as they are."""
        held, size, last = [], 0, None
        for b in batches:
            whole = b.filter(b.column("deal").is_valid())
            if whole.num_rows:
                start, piece = whole.column("start"), whole.column("piece")
                yield pa.RecordBatch.from_arrays([whole.column("rid"), start, pc.add(start, pc.binary_length(piece).cast(pa.int64())), piece], ["rid", "start", "end", "piece"])
            b = b.filter(b.column("deal").is_null())
            for gram, rid, start, piece in zip(*(b.column(c).to_pylist() for c in ("gram", "rid", "start", "piece")), strict=True):
                if size >= SHARD and gram != last:
                    yield spans_of(held)
                    held, size = [], 0
                held.append((rid, start, piece))
                size += len(piece)
                last = gram
        if held:
            yield spans_of(held)

    def spans_of(held: list) -> pa.RecordBatch:
        rid, start, end = zip(*s, strict=True) if (s := repeated_in(held)) else ((), (), ())
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (rid, start, end)), pa.nulls(len(rid), pa.binary())], ["rid", "start", "end", "piece"])

    shards = saved(pieces.mapInArrow(sort_shards, "rid long, start long, end long, piece binary"), "repeat_shards")

    def cut_windows(b: pa.RecordBatch) -> pa.RecordBatch:
        col = b.column("piece")
        offsets = np.concatenate([[0], np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False).astype(np.int64))])
        piece, at, key, other = windows(np.frombuffer(b"".join(col.to_pylist()), np.uint8), offsets)
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(other.view(np.int64)), b.column("rid").take(pa.array(piece)),
                                           pa.array(b.column("start").to_numpy()[piece] + at)], ["key", "other", "rid", "start"])

    window = map_batches(shards.filter("piece is not null").select("rid", "start", "piece"), cut_windows, "key long, other long, rid long, start long")
    least = window.groupBy("key", "other").agg(F.count("*").alias("n"), F.min(F.struct("rid", "start")).alias("least")).filter("n > 1").drop("n")
    later = window.join(least, ["key", "other"]).filter("least.rid <> rid or least.start <> start").select("rid", "start", (F.col("start") + LENGTH).alias("end"))

    spans = saved(again.unionByName(shards.filter("piece is null").drop("piece")).unionByName(later), "repeat_spans") \
        .groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def judge(b: pa.RecordBatch) -> pa.RecordBatch:
        n_bytes, n_removed, n_spans, rest = [], [], [], []
        for text, found in zip(b.column("text").to_pylist(), b.column("spans"), strict=True):
            raw, runs = text.encode(), []
            if found.is_valid:
                start, end = (found.values.field(c).to_numpy() for c in ("start", "end"))
                by = np.argsort(start)
                start, end = start[by], np.minimum(np.maximum.accumulate(end[by]), len(raw))
                new = np.flatnonzero(start[1:] > end[:-1]) + 1
                runs = list(zip(start[np.concatenate([[0], new])].tolist(), end[np.concatenate([new - 1, [len(end) - 1]])].tolist(), strict=True))
            n_bytes.append(len(raw))
            n_removed.append(sum(e - a for a, e in runs))
            n_spans.append(len(runs))
            rest.append(result(runs, raw))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(rest, kind)],
                                          ["doc_id", "n_bytes", "n_removed", "n_spans", column.split()[0]])

    kind_id = dict(docs.dtypes)["doc_id"]
    return map_batches(rows.join(spans, "rid", "left").select("doc_id", "text", "spans"), judge,
                       f"doc_id {kind_id}, n_bytes long, n_removed long, n_spans long, {column}")
