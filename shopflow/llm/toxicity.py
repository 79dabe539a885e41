"""Toxicity: a convolutional text classifier over hashed words, trained in numpy, with a threshold for each language.

A word's embedding is the sum of those of its hash and of the hash of its first bytes, so inflected forms share
what is known of a stem; filters of several widths slide over the whole text, their maxima feed a logistic unit.
Because a filter is linear in each word, its parts are looked up per hashed word, so scoring needs no matrix product per
position.  Training takes gradients only at the winning positions.  Held-back labelled rows (a fifth, by a hash of their id) then
give each language, told by its function words in the text itself, the threshold of best F1; scores are shifted so that it lies
at DECISION.

Scale.  Every labelled row that is not held out trains or calibrates, its text whole.  A network that has learned a few rows of least
hash goes out to the tasks; each goes on over all its labelled rows, a block at a time, and the tasks' weights are averaged.  A second
pass counts the logits.  The labelled texts are joined once and written to the shared folder; what reaches the driver is those few rows
of bounded length, one set of weights and counts of a fixed size.  Every text is scored whole, in pieces, in one pass without a shuffle.

Defined cases.  Null, empty or blank text is scored as padding only: a low score, like any text without signs.  Labels
without doc_id or value are left out; without labels of both kinds to train on every score is the share of label 1.  Rows are scored
one by one, so ties, repeated rows and other columns don't matter.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FIT_CHARS, drop_saved, mixed, saved, tune, utf8, word_hashes, word_spans
from .textcnn import ConvNet

#: Rows of each label, of up to FIT_CHARS characters, that the network learns before the tasks go on over all rows.
FIRST = 3000
#: Bytes of text in a block of a task's rows.
BLOCK = 4 << 20
DECISION = 0.7
BUCKETS = 1 << 15
EMBED, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
EPOCHS, BATCH, RATE = 5, 32, 0.15
#: Passes of a task over the rows of a block.
PASSES = 3
#: Bytes of a word's stem.
STEM = 4
#: Logits are counted from -LARGEST to LARGEST in steps of 1 / FINE.
LARGEST, FINE = 32, 64

# Common function words by language, only to group texts for the thresholds.
FUNCTION_WORDS = {
    "en": "the and of to in is that it for was on are as with be by this from",
    "de": "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch",
    "fr": "le la les et des en un du une est pour que qui dans sur pas au avec son",
    "es": "el los las y del que en una por con para como más pero sus su al se lo",
}


def _hashes(words: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(words))
    return word_hashes(data, offsets[:-1], offsets[1:])


class Texts:
    """Hashed words and stems of texts, each text followed by padding, and the guessed language of each."""

    def __init__(self, col: pa.Array):
        data, offsets = utf8(col)
        # words without glued marks: a break is any ASCII character that is no letter or digit
        start, end, row = word_spans(data, offsets, BREAKS)
        hashes = word_hashes(data, start, end)
        self.n_words = np.bincount(row, minlength=len(col))
        self.first = np.cumsum(self.n_words + max(WIDTHS)) - self.n_words - max(WIDTHS)
        self.ids = np.full((2, int((self.n_words + max(WIDTHS)).sum())), BUCKETS, np.int32)
        stems = word_hashes(data, start, np.minimum(end, start + STEM)) + np.uint64(1)
        for k, h in enumerate((hashes, stems)):
            self.ids[k, np.arange(len(hashes)) + row * max(WIDTHS)] = (mixed(h) >> np.uint64(40)).astype(np.int32) % BUCKETS
        self.language = np.zeros((len(col), len(FUNCTION_WORDS)), np.int64)
        for k, words in enumerate(FUNCTION_WORDS.values()):
            self.language[:, k] = np.bincount(row[np.isin(hashes, _hashes(words.split()))], minlength=len(col))
        self.language = np.where(self.language.max(axis=1) > 0, self.language.argmax(axis=1), len(FUNCTION_WORDS))


BREAKS = np.array([bool(i < 128 and not chr(i).isalnum()) for i in range(256)])


class Model:
    def __init__(self, seed: int = 7):
        self.net = ConvNet(BUCKETS, EMBED, FILTERS, WIDTHS, RATE, seed)
        self.shift = np.zeros(len(FUNCTION_WORDS) + 1)

    def logits(self, t: Texts, tables: dict | None = None) -> np.ndarray:
        return self.net.logits(t.ids, t.first, t.n_words + 1, tables)

    def scores(self, t: Texts, tables: dict | None = None) -> np.ndarray:
        z = self.logits(t, tables) - self.shift[t.language] + np.log(DECISION / (1 - DECISION))
        return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30).astype(np.float64))), 6)


class Labelled:
    """Labelled texts, and beside each clean one a few of its words, or none: short texts must not look toxic for want of
    clean words.  ``held`` ones calibrate, the others train."""

    def __init__(self, texts: pa.Array, y: np.ndarray, held: np.ndarray, rng: np.random.Generator):
        t = Texts(texts)
        clean = np.flatnonzero(y == 0)
        n_words = rng.integers(0, 9, len(clean))
        start = (rng.random(len(clean)) * np.maximum(0, t.n_words[clean] - n_words)).astype(np.int64)
        start = np.where((n_words == 0) | (t.n_words[clean] < n_words), t.n_words[clean], start)
        few = np.where(start == t.n_words[clean], 1, n_words)
        self.ids, self.first, self.lens = t.ids, np.concatenate([t.first, t.first[clean] + start]), np.concatenate([t.n_words + 1, few])
        self.y, self.held, self.language = (np.concatenate([v, v[clean]]) for v in (y, held, t.language))
        self.train = np.flatnonzero(~self.held)


def _best_threshold(counts: np.ndarray) -> float:
    """The middle of the gap after which F1 is best; counts of logits by label."""
    full = np.flatnonzero(counts.sum(axis=0))[::-1]
    hits = np.cumsum(counts[1, full])
    f1 = 2 * hits / (np.cumsum(counts[:, full].sum(axis=0)) + hits[-1])
    i = int(f1.argmax())
    low = full[i + 1] if i + 1 < len(full) else full[i] - 2 * FINE
    return float((full[i] + low) / 2 / FINE - LARGEST)


def started(some: Labelled, epochs: int, weight: float, seed: int) -> Model:
    """A network that has learned the given rows, if they have both labels; learning can go on."""
    model = Model(seed)
    if len(np.unique(some.y[some.train])) > 1:
        model.net.train(some.ids, some.first, some.lens, some.train, some.y, np.where(some.y == 1, weight, 1.0), max(epochs * len(some.train) // BATCH, 400), BATCH, seed, keep=True)
    return model


def learn(net: ConvNet, some: Labelled, weight: float, epochs: int, rng: np.random.Generator) -> int:
    """Steps over all rows that train.  How many there were."""
    order = np.concatenate([rng.permutation(some.train) for _ in range(epochs)])
    for i in range(0, len(order), BATCH):
        pick = order[i:i + BATCH]
        net.step(some.ids, some.first[pick], some.lens[pick], some.y[pick], np.where(some.y[pick] == 1, weight, 1.0))
    return len(some.train)


def bins(net: ConvNet, some: Labelled, tables: dict) -> np.ndarray:
    """How many rows there are that calibrate or train, by label, language and logit, in steps of 1 / FINE."""
    out = np.zeros((2, 2, len(FUNCTION_WORDS) + 1, 2 * LARGEST * FINE + 1), np.int64)
    z = np.clip(net.logits(some.ids, some.first, some.lens, tables).astype(np.float64), -LARGEST, LARGEST)
    np.add.at(out, ((~some.held).astype(np.int64), (some.y == 1).astype(np.int64), some.language, np.rint((z + LARGEST) * FINE).astype(np.int64)), 1)
    return out


def calibrate(model: Model, counts: np.ndarray) -> Model:
    """A threshold for each language: from the rows that calibrate, or from all where they are too few."""
    use = counts[0] if counts[0, 1].sum() >= 5 else counts.sum(axis=0)
    model.shift[:] = _best_threshold(use.sum(axis=1))
    for k in range(len(model.shift)):
        if use[1, k].sum() >= 20:
            model.shift[k] = _best_threshold(use[:, k])
    return model


def constant(share: float, seed: int) -> Model:
    """Every score is the share of label 1."""
    model, share = Model(seed), float(np.clip(share, 1e-3, DECISION - 1e-3))
    model.net.p["out"][:] = 0
    model.net.p["bias"][:] = np.log(share / (1 - share))
    model.shift[:] = np.log(DECISION / (1 - DECISION))
    return model


def _weight(n_clean: int, n_toxic: int) -> float:
    """Of a toxic row beside a clean one, of which there are twice as many as clean texts."""
    return float(np.sqrt(2 * n_clean / max(1, n_toxic)))


def fit(texts: pa.Array, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Train on four fifths of the rows, set the thresholds on the rest; in one process."""
    held = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[~held])) < 2:
        return constant(y.mean() if len(y) else 0.0, seed)
    some = Labelled(texts, y, held, np.random.default_rng(seed))
    model = started(some, epochs, _weight(int((y == 0).sum()), int((y == 1).sum())), seed)
    model.net.squares = {}
    return calibrate(model, bins(model.net, some, model.net.tables()))


def held_out(doc_id: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Whether a hash of the id falls in the given part; rows with a null id are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def _blocks(batches: Iterator[pa.RecordBatch], rng: np.random.Generator) -> Iterator[Labelled]:
    """The rows of a task, some BLOCK bytes of text at a time."""
    def block() -> Labelled:
        t = pa.Table.from_batches(held)
        return Labelled(t.column("text").combine_chunks(), t.column("y").to_numpy(), t.column("held").to_numpy(), rng)

    held, size = [], 0
    for b in batches:
        held, size = [*held, b], size + b.column("text").nbytes
        if size >= BLOCK:
            yield block()
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield block()


def train(docs: DataFrame, labels: DataFrame, first: int = FIRST, passes: int = PASSES, seed: int = 7) -> Model:
    """Fit on every labelled row that is not held out: the first ones of least hash in the driver, then all of them in the tasks."""
    known = labels.filter("doc_id is not null and toxic is not null").filter(~held_out()) \
        .select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("y"))
    # a merge join at any size: labels grow with the corpus, so they are not sent to every task
    rows = saved(docs.join(known.hint("merge"), F.col("doc_id") == F.col("label_id")).select(
        "text", "y", (F.pmod(F.xxhash64("label_id"), F.lit(5)) == 0).alias("held"), F.xxhash64("label_id", "text", F.lit(seed)).alias("h")), "toxic_rows")
    n = {(r["held"], r["y"]): r["n"] for r in rows.groupBy("held", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_clean, n_toxic = (sum(v for (_, y), v in n.items() if y == k) for k in (0, 1))
    if len({y for held, y in n if not held}) < 2:
        drop_saved(rows)
        return constant(n_toxic / max(1, sum(n.values())), seed)
    weight, few = _weight(n_clean, n_toxic), rows.filter(F.coalesce(F.char_length("text"), F.lit(0)) <= FIT_CHARS)
    picked = []
    for label in (F.col("y") == 1, F.col("y") != 1):
        last = few.filter(label).select("h").orderBy("h").limit(first).agg(F.max("h")).first()[0]
        if last is not None:
            picked.append(few.filter(label & (F.col("h") <= last)).orderBy("h").limit(first).toArrow())
    some = pa.concat_tables(picked).sort_by("h") if picked else rows.limit(0).toArrow()
    some = Labelled(some.column("text").combine_chunks(), some.column("y").to_numpy(), some.column("held").to_numpy(), np.random.default_rng(seed))
    model = started(some, EPOCHS, weight, seed)
    names, start = sorted(model.net.p), model.net
    every = rows.select("text", "y", "held")

    def tasks(batches):
        net, n, rng = copy.deepcopy(start), 0, np.random.default_rng(seed)
        for block in _blocks(batches, rng):
            n += learn(net, block, weight, passes, rng)
        if n:
            flat = np.concatenate([net.p[k].ravel() for k in names]).astype(np.float64) * n
            yield pa.RecordBatch.from_arrays([pa.array(range(len(flat) + 1), pa.int32()), pa.array(np.append(flat, float(n)))], ["at", "value"])

    summed = every.mapInArrow(tasks, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").toArrow()
    flat, at = summed.column("value").to_numpy(), 0
    flat = (flat[:-1] / flat[-1]).astype(np.float32)
    for k in names:
        shape = model.net.p[k].shape
        model.net.p[k] = flat[at:at + int(np.prod(shape))].reshape(shape)
        at += int(np.prod(shape))
    model.net.squares = {}
    net, tables = model.net, model.net.tables()

    def counted(batches):
        total = sum((bins(net, block, tables) for block in _blocks(batches, np.random.default_rng(seed))), np.zeros((), np.int64))
        if total.ndim:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at], pa.int64())], ["at", "n"])

    got = every.mapInArrow(counted, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, 2, len(FUNCTION_WORDS) + 1, 2 * LARGEST * FINE + 1), np.int64)
    counts.ravel()[got.column("at").to_numpy()] = got.column("n").to_numpy()
    drop_saved(rows)
    return calibrate(model, counts)


def scored(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with a column __toxicity from 0 to 1."""
    tune(docs.sparkSession)
    model = model or train(docs.select("doc_id", "text"), labels)
    tables = model.net.tables()

    def run(col: pa.Array) -> pa.Array:
        return pa.array(model.scores(Texts(col), tables))
    return docs.withColumn("__toxicity", F.arrow_udf(run, "double")(F.col("text")))
