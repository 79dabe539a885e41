"""Secret scans: rules find the plain cases, a character convolutional network judges every other candidate in context.

Base findings (assign, access, hex) come from fixed patterns and always stay.  A candidate is any other run of
MIN_TOKEN or more token characters, whatever they are.  The network reads the whole candidate and CONTEXT bytes on
either side, each byte marked as inside or outside.  It is trained on labelled findings: made-up keys of known formats
against look-alikes (paths, versions, dates, identifiers, long words), then the base findings of all documents against
all their ordinary long words.  Held-back findings then calibrate the scores (Platt) and set a threshold for each band of
lengths (BANDS): the highest that still finds MIN_RECALL of the secrets of that band.

All matchers are linear in the text.  Scale: training reads every text whole, in two passes without a shuffle of texts; the tasks'
weights are averaged, and calibration uses counts of all findings.  Scanning is one more such pass.

Defined cases.  Null text is read as empty: no spans.  Candidates that overlap a base finding are not reported again.
Rows are scanned one by one, so ties, repeated rows and other columns don't matter.  Spans count code points, end
exclusive.
"""

from __future__ import annotations

import copy
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import tune, utf8
from .textcnn import ConvNet

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "token")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: Shortest candidate, and bytes of context on either side.
MIN_TOKEN, CONTEXT = 12, 32
#: First lengths of the bands of candidates that have a threshold each.
BANDS = (12, 16, 24, 40)
MIN_RECALL = 0.95
#: Findings of documents in a step of a task, beside as many made-up ones; passes over those of a batch of documents.
REAL_BATCH, PASSES = 32, 3
#: Logits are counted from -LARGEST to LARGEST in steps of 1 / FINE.
LARGEST, FINE = 32, 64
WIDTHS, EMBED, FILTERS, STEPS, BATCH = (2, 3, 5), 8, 10, 500, 64
#: Ids: a byte outside the candidate, inside it, and padding.
INSIDE, PAD = 256, 512


def _is(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


LOWER, UPPER, DIGIT = _is("abcdefghijklmnopqrstuvwxyz"), _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _is("0123456789")
HEX = DIGIT | _is("abcdef")
TOKEN = LOWER | UPPER | DIGIT | _is("+/_=-")


def _runs(data: np.ndarray, offsets: np.ndarray, allowed: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of allowed bytes within a text, of the least length."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = allowed[data]
    start = np.flatnonzero(inside[1:-1] & ~inside[:-2])
    end = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    cut = offsets[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(data))])
    cut = cut[inside[cut] & inside[cut + 1]]  # runs that go on in the next text
    start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    long = end - start >= least
    return start[long], end[long]


class Scan:
    """Base findings and candidates of a batch: row, kind, start, end in bytes of the batch."""

    def __init__(self, col: pa.Array):
        self.data, self.offsets = utf8(col)
        found = []
        for row, text in enumerate(col.to_pylist()):
            if not text:
                continue
            spans = []
            low = text.lower()
            if any(k in low for k in KEYWORDS):
                spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
            if "AKIA" in text:
                spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
            if spans:
                base = self.offsets[row]
                at = (lambda i: i) if text.isascii() else self._starts(row).__getitem__
                found += [(row, kind, int(base + at(a)), int(base + at(b))) for kind, a, b in spans]
        start, end = _runs(self.data, self.offsets, HEX, MIN_HEX)
        found += [(int(r), "hex", int(a), int(b)) for r, a, b in zip(self._row(start), start, end, strict=True)]
        self.base = sorted(found, key=lambda s: (s[2], BASE_KINDS.index(s[1])))
        start, end = _runs(self.data, self.offsets, TOKEN, MIN_TOKEN)
        taken = np.zeros(len(self.data) + 1, np.int64)
        for _, _, a, b in self.base:
            taken[a] += 1
            taken[b] -= 1
        taken = np.concatenate([[0], np.cumsum(np.cumsum(taken)[:-1] > 0)])
        ok = taken[end] == taken[start]
        self.start, self.end = start[ok], end[ok]
        self.row = self._row(self.start)

    def _starts(self, row: int) -> np.ndarray:
        """The byte of a text at which each code point starts, and its end."""
        piece = self.data[self.offsets[row]:self.offsets[row + 1]]
        return np.append(np.flatnonzero((piece & 0xC0) != 0x80), len(piece))

    def _row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def windows(self, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids end to end, first places and lengths of the given spans in their context."""
        a, b = np.maximum(start - CONTEXT, self.offsets[row]), np.minimum(end + CONTEXT, self.offsets[row + 1])
        lens, tail = b - a, max(WIDTHS)
        first = np.cumsum(lens + tail) - lens - tail
        ids = np.full(int((lens + tail).sum()), PAD, np.int64)
        place = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        at = place + np.repeat(a, lens)
        within = (at >= np.repeat(start, lens)) & (at < np.repeat(end, lens))
        ids[place + np.repeat(first, lens)] = self.data[at] + np.where(within, INSIDE, 0)
        return ids[None], first, lens

    def points(self, row: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The code points of their texts that start at the given bytes of the batch; one running sum for all."""
        edges = np.unique(np.concatenate([self.offsets, at]))
        steps = edges[:-1][edges[:-1] < len(self.data)]
        before = np.concatenate([[0], np.cumsum(np.add.reduceat((self.data & 0xC0) != 0x80, steps, dtype=np.int64))]) if len(steps) else np.zeros(1, np.int64)
        count = lambda x: before[np.searchsorted(edges, x)]
        return count(at) - count(self.offsets[row])


class Model:
    def __init__(self, seed: int = 5):
        self.net = ConvNet(PAD, EMBED, FILTERS, WIDTHS, 0.1, seed, scale=0.3)
        self.slope, self.offset, self.thresholds = 1.0, 0.0, np.full(len(BANDS), 0.5)

    def scores(self, scan: Scan, row: np.ndarray, start: np.ndarray, end: np.ndarray, tables: dict | None = None) -> np.ndarray:
        if not len(row):
            return np.zeros(0)
        z = self.net.logits(*scan.windows(row, start, end), tables).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(self.slope * z + self.offset, -30, 30)))

    def limits(self, lengths: np.ndarray) -> np.ndarray:
        """The threshold of each length."""
        return self.thresholds[np.maximum(np.searchsorted(BANDS, lengths, side="right") - 1, 0)]

    def find(self, col: pa.Array, tables: dict | None = None) -> list[list[dict]]:
        """kind, start, end, score of each span, by start, then kind in the order of KINDS."""
        scan = Scan(col)
        spans = [(row, kind, a, b, 1.0) for row, kind, a, b in scan.base]
        score = self.scores(scan, scan.row, scan.start, scan.end, tables)
        spans += [(int(r), "token", int(a), int(b), float(s)) for r, a, b, s, least in zip(scan.row, scan.start, scan.end, score, self.limits(scan.end - scan.start), strict=True) if s >= least]
        out: list[list[dict]] = [[] for _ in range(len(col))]
        rows = np.array([x[0] for x in spans], np.int64)
        starts, ends = (scan.points(rows, np.array([x[i] for x in spans], np.int64)).tolist() for i in (2, 3))
        for (row, kind, _, _, s), a, b in zip(spans, starts, ends, strict=True):
            out[row].append({"kind": kind, "start": a, "end": b, "score": round(s, 6)})
        return [sorted(x, key=lambda s: (s["start"], KINDS.index(s["kind"]), s["end"])) for x in out]


def labelled_findings(rng: np.random.Generator, n: int) -> tuple[list[str], list[tuple[int, int]], list[int]]:
    """Texts with one marked span each, and whether it is a secret: keys of known formats, and what looks like them."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    lower, upper, digits = letters, letters.upper(), "0123456789"
    some = lambda chars, k: "".join(chars[i] for i in rng.integers(0, len(chars), k))
    pick = lambda options: options[int(rng.integers(0, len(options)))]
    syllable = lambda: pick(("", *"bcdfghklmnprstvwz", "ch", "st", "tr", "br", "sch")) + pick(("a", "e", "i", "o", "u", "ie", "ou", "ei")) + pick(("", "", "n", "r", "s", "l", "t"))
    word = lambda: "".join(syllable() for _ in range(int(rng.integers(1, 4))))
    long_word = lambda: "".join(syllable() for _ in range(int(rng.integers(6, 12))))
    name = lambda: "".join(w.capitalize() for w in (word(), word(), word()))

    def secret() -> str:
        n = pick((int(rng.integers(MIN_TOKEN, 24)), int(rng.integers(20, 64))))
        return pick((lambda: some(lower + upper + digits, n), lambda: some(lower + upper + digits + "+/", n) + pick(("", "=", "==")),
                     lambda: pick(("ghp_", "sk_live_", "pk_", "xoxb-", "glpat-", "key-")) + some(lower + upper + digits, n),
                     lambda: some(upper + digits, n), lambda: some("ABCDEF" + digits, n), lambda: some(lower + digits, n), lambda: some(lower + upper, n),
                     lambda: some(lower, n), lambda: some(upper, n), lambda: "eyJ" + some(lower + upper + digits + "-_", n)))()

    def other() -> str:
        return pick((lambda: "/".join(word() for _ in range(4)) + "/" + some(digits, 4), lambda: f"{word()}-{word()}-{word()}-{some(digits, 2)}",
                     lambda: f"20{some(digits, 2)}-0{some(digits, 1)}-1{some(digits, 1)}T{some(digits, 2)}-{some(digits, 2)}Z",
                     lambda: f"{word()}_{word()}_{word()}_{some(digits, 1)}", lambda: name() + some(digits, 2), lambda: word() + word() + word() + some(digits, 3),
                     lambda: f"version-{some(digits, 1)}-{some(digits, 2)}-{word()}-{word()}", lambda: some(digits, 14) + pick(("ms", "km", "kg", "")),
                     lambda: "=" * 10 + word() + some(digits, 1) + "=" * 6, lambda: "-" * 12 + word() + some(digits, 2) + "-" * 8,
                     long_word, lambda: long_word().capitalize(), lambda: long_word().upper(), lambda: f"{long_word()}-{word()}", lambda: name() + name(),
                     lambda: pick("-=_/+") * int(rng.integers(MIN_TOKEN, 60)), lambda: "/".join(word() for _ in range(5)), lambda: "_".join(word() for _ in range(5))))()

    texts, spans, y = [], [], []
    for i in range(n):
        value, good = (secret(), 1) if i % 2 else (other(), 0)
        while len(value) < MIN_TOKEN:
            value += word()
        before = " ".join(word() for _ in range(int(rng.integers(0, 8)))) + pick((" ", "\n", " key ", ": ", ' "', " = ", " at ", " see "))
        texts.append(before + value + pick((" ", "\n", ". ", '" ', ", ")) + " ".join(word() for _ in range(int(rng.integers(0, 8)))))
        spans.append((len(before), len(before) + len(value)))
        y.append(good)
    return texts, spans, y


class Findings:
    """Labelled spans of a scan as the network reads them; ``held`` ones calibrate, the others train."""

    def __init__(self, scan: Scan, row: np.ndarray, start: np.ndarray, end: np.ndarray, y: np.ndarray):
        self.ids, self.first, self.lens = scan.windows(row, start, end)
        self.y, self.length = y, end - start
        # by their place in the text, not in the batch
        self.held = ((start - scan.offsets[row]) * 2654435761 + self.length >> 5) % 4 == 3
        self.train = np.flatnonzero(~self.held)


def made_up(made: int, seed: int) -> Findings:
    lines, spans, y = labelled_findings(np.random.default_rng(seed), made)
    scan, at = Scan(pa.array(lines, pa.string())), np.array(spans, np.int64).reshape(-1, 2)
    found = Findings(scan, np.arange(made), scan.offsets[:made] + at[:, 0], scan.offsets[:made] + at[:, 1], np.array(y))
    found.held = np.arange(made) // 2 % 4 == 3
    found.train = np.flatnonzero(~found.held)
    return found


def real(col: pa.Array) -> Findings:
    """Every base finding of the texts, and every ordinary long word (a run without digits), taken for no secret."""
    scan = Scan(col)
    a, b = _runs(scan.data, scan.offsets, TOKEN, MIN_TOKEN)
    digits = np.concatenate([[0], np.cumsum(DIGIT[scan.data])])
    plain = digits[b] == digits[a]
    base = np.array([(r, x, z) for r, _, x, z in scan.base], np.int64).reshape(-1, 3)
    row, start, end = np.concatenate([base[:, 0], scan._row(a[plain])]), np.concatenate([base[:, 1], a[plain]]), np.concatenate([base[:, 2], b[plain]])
    return Findings(scan, row, start, end, np.concatenate([np.ones(len(base), np.int64), np.zeros(int(plain.sum()), np.int64)]))


def learn(net: ConvNet, some: Findings, made: Findings, rng: np.random.Generator) -> int:
    """Steps over all findings that train, beside as many made-up ones; both labels weigh the same.  How many there were."""
    both = lambda name: np.concatenate([getattr(made, name), getattr(some, name)])
    ids, first, lens, y = np.concatenate([made.ids, some.ids], 1), np.concatenate([made.first, some.first + made.ids.shape[1]]), both("lens"), both("y")
    order = np.concatenate([rng.permutation(some.train) for _ in range(PASSES)]) + len(made.y)
    for i in range(0, len(order), REAL_BATCH):
        pick = np.concatenate([order[i:i + REAL_BATCH], rng.choice(made.train, len(order[i:i + REAL_BATCH]))])
        good = y[pick] == 1
        net.step(ids, first[pick], lens[pick], y[pick], np.where(good, 1.0, min(1.0, max(1, good.sum()) / max(1, (~good).sum()))))
    return len(some.train)


def bins(net: ConvNet, some: Findings, tables: dict) -> np.ndarray:
    """How many findings that calibrate there are by label, band of lengths and logit, in steps of 1 / FINE."""
    out = np.zeros((2, len(BANDS), 2 * LARGEST * FINE + 1), np.int64)
    if some.held.any():
        z = np.clip(net.logits(some.ids, some.first[some.held], some.lens[some.held], tables).astype(np.float64), -LARGEST, LARGEST)
        np.add.at(out, (some.y[some.held], np.maximum(np.searchsorted(BANDS, some.length[some.held], side="right") - 1, 0), np.rint((z + LARGEST) * FINE).astype(np.int64)), 1)
    return out


def calibrate(model: Model, counts: np.ndarray, made: np.ndarray) -> Model:
    """Platt's scaling and the thresholds, from all findings that calibrate; made-up ones weigh as much as real ones, if they are fewer."""
    weight = counts + made * max(1.0, counts.sum() / max(1, made.sum()))
    z = np.arange(weight.shape[2]) / FINE - LARGEST
    n, hits = weight.sum(axis=(0, 1)), weight[1].sum(axis=0)
    for _ in range(50):  # by Newton steps
        p = 1 / (1 + np.exp(-np.clip(model.slope * z + model.offset, -30, 30)))
        w = n * (p * (1 - p) + 1e-6)
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        d = np.linalg.solve(h, [((hits - n * p) * z).sum() - (model.slope - 1), (hits - n * p).sum()])
        model.slope, model.offset = model.slope + float(np.clip(d[0], -1, 1)), model.offset + float(np.clip(d[1], -1, 1))
    for k in range(len(BANDS)):
        # positives of a band: real ones together weigh no more than made-up ones
        found, plan = counts[1, k].astype(float), made[1, k].astype(float)
        found = found * min(1.0, plan.sum() / max(1.0, found.sum())) + plan
        if found.sum():
            at = int(np.searchsorted(np.cumsum(found), (1 - MIN_RECALL) * found.sum(), side="right"))
            model.thresholds[k] = 1 / (1 + np.exp(-np.clip(model.slope * (z[at] - 0.5 / FINE) + model.offset, -30, 30)))
    return model


def started(made: Findings, seed: int) -> Model:
    """A network that has learned the made-up findings; learning can go on."""
    model = Model(seed)
    model.net.train(made.ids, made.first, made.lens, made.train, made.y, np.ones(len(made.y)), STEPS, BATCH, seed, keep=True)
    return model


def fit(texts: pa.Array, made: int = 5000, seed: int = 5) -> Model:
    """Train on made-up findings, and on the base findings and ordinary long words of the given texts; as ``train``, in one process."""
    planned, some = made_up(made, seed), real(texts)
    model = started(planned, seed)
    learn(model.net, some, planned, np.random.default_rng(seed))
    model.net.squares = {}
    tables = model.net.tables()
    return calibrate(model, bins(model.net, some, tables), bins(model.net, planned, tables))


def train(docs: DataFrame, made: int = 5000, seed: int = 5) -> Model:
    """Train on made-up findings, then on those of every document: each task goes on from the made-up ones over all findings of its
    documents, and the weights of the tasks are averaged by how many they had.  A second pass counts the findings that calibrate.
    What reaches the driver is one set of weights, and counts of a fixed size."""
    planned = made_up(made, seed)
    model = started(planned, seed)
    names, start = sorted(model.net.p), model.net
    texts = docs.select("text")

    def tasks(batches):
        net, n = copy.deepcopy(start), 0
        rng = np.random.default_rng(seed)
        for b in batches:
            n += learn(net, real(b.column("text")), planned, rng)
        if n:
            flat = np.concatenate([net.p[k].ravel() for k in names]).astype(np.float64) * n
            yield pa.RecordBatch.from_arrays([pa.array(range(len(flat) + 1), pa.int32()), pa.array(np.append(flat, float(n)))], ["at", "value"])

    summed = texts.mapInArrow(tasks, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").toArrow()
    if summed.num_rows:
        flat = summed.column("value").to_numpy()
        flat, at = (flat[:-1] / flat[-1]).astype(np.float32), 0
        for k in names:
            shape = model.net.p[k].shape
            model.net.p[k] = flat[at:at + int(np.prod(shape))].reshape(shape)
            at += int(np.prod(shape))
    model.net.squares = {}
    net, tables = model.net, model.net.tables()

    def counted(batches):
        total = sum((bins(net, real(b.column("text")), tables) for b in batches), np.zeros((), np.int64))
        if total.ndim:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at], pa.int64())], ["at", "n"])

    got = texts.mapInArrow(counted, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    planned_bins = bins(net, planned, tables)
    counts = np.zeros(planned_bins.size, np.int64)
    counts[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return calibrate(model, counts.reshape(planned_bins.shape), planned_bins)


SPANS = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"


def with_spans(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with the array column __secrets of (kind, start, end, score)."""
    tune(docs.sparkSession)
    model = model or train(docs)
    tables = model.net.tables()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(col: pa.Array) -> pa.Array:
        return pa.array(model.find(col, tables), kind)
    return docs.withColumn("__secrets", F.arrow_udf(run, SPANS)(F.col("text")))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by <SECRET>; overlapping spans are one."""
    def run(col: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for t, spans in zip(col.to_pylist(), found.to_pylist(), strict=True):
            parts, done = [], 0
            for s in spans or ():
                if t is not None and s["start"] >= done:
                    parts += [t[done:s["start"]], "<SECRET>"]
                done = max(done, s["end"])
            out.append(None if t is None else "".join(parts) + t[done:])
        return pa.array(out, pa.string())
    return F.arrow_udf(run, "string")(text, spans)
