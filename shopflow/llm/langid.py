"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

A text is cut into spans of SPAN bytes, each read left to right and right to left by a small GRU; both states label every
position, and the document's probabilities are the mean of its positions' log probabilities, normalised.  All spans of a
batch run side by side, one time step after another, so the work is matrix products of a bounded size.

Scale.  Fitting uses at most MAX_LABELLED rows of least hash, and FIT_CHARS characters of each; every byte of every text is read, in pieces of PIECE spans,
in one pass without a shuffle.

Defined cases.  Null texts, and texts without a letter, are `und` with score 0.  Rows without lang, or held out, are not
learned from; with no rows to learn from everything is `und`, with one language that is the answer.  Ties go to the
language that sorts first.  Rows are read one by one, so repeated rows and other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FIT_CHARS, mixed, tune, utf8

SPAN = 64
HIDDEN, EMBED = 8, 8
#: Rows to learn from at most, and spans drawn from each.
MAX_LABELLED, SPANS_EACH = 3000, 12
STEPS, BATCH, RATE = 260, 256, 0.02
#: Spans that run side by side.
PIECE = 4096
#: Byte 256 stands for places beyond the end of a text.
PAD = 256
UNKNOWN = "und"


def _gate(x: np.ndarray) -> np.ndarray:
    """The piecewise-linear sigmoid, in place: cheap, and 0 and 1 are reached."""
    x *= 0.25
    x += 0.5
    np.maximum(x, 0, out=x)
    return np.minimum(x, 1, out=x)


def _bend(x: np.ndarray) -> np.ndarray:
    """Softsign, in place."""
    scale = np.abs(x)
    scale += 1
    x /= scale
    return x


class Gru:
    """One direction, with piecewise-linear gates and a softsign candidate.  Gates lie in rows: reset, update,
    candidate; columns are spans."""

    def __init__(self, rng: np.random.Generator):
        self.p = {"x": rng.normal(0, 0.3, (3 * HIDDEN, EMBED)), "h": rng.normal(0, 0.3, (3 * HIDDEN, HIDDEN)), "b": np.zeros(3 * HIDDEN)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def run(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States (time, HIDDEN, spans).  gates: what each byte adds to the gates, (3 HIDDEN, 257); ids: (time, spans)."""
        h = np.zeros((HIDDEN, ids.shape[1]), np.float32)
        states, saved = np.empty((len(ids), *h.shape), np.float32), []
        room = np.empty((3 * HIDDEN, ids.shape[1]), np.float32)
        for t, at in enumerate(ids):
            x = gates.take(at, axis=1, mode="clip", out=room)
            from_h = self.p["h"] @ h
            rz, hn = from_h[:2 * HIDDEN], from_h[2 * HIDDEN:]
            rz += x[:2 * HIDDEN]
            _gate(rz)
            r, z = rz[:HIDDEN], rz[HIDDEN:]
            n = r * hn
            n += x[2 * HIDDEN:]
            _bend(n)
            if keep:
                saved.append((h, r, z, hn, n))
            new = h - n
            new *= z
            new += n
            states[t] = h = new
        return states, saved

    def back(self, d_states: np.ndarray, saved: list, x: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weights, and of the inputs x (time, EMBED, spans)."""
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_x, d_h = np.empty_like(x), np.zeros_like(d_states[0])
        for t in range(len(saved) - 1, -1, -1):
            h, r, z, hn, n = saved[t]
            d = d_states[t] + d_h
            d_n = d * (1 - z) * (1 - np.abs(n)) ** 2
            d_z = d * (h - n) * (0.25 * ((z > 0) & (z < 1)))
            d_r = d_n * hn * (0.25 * ((r > 0) & (r < 1)))
            d_x_gates = np.concatenate([d_r, d_z, d_n])
            d_h_gates = np.concatenate([d_r, d_z, d_n * r])
            g["x"] += d_x_gates @ x[t].T
            g["b"] += d_x_gates.sum(1)
            g["h"] += d_h_gates @ h.T
            d_x[t] = self.p["x"].T @ d_x_gates
            d_h = d * z + self.p["h"].T @ d_h_gates
        return g, d_x


class Model:
    def __init__(self, languages: list[str], seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.left, self.right = Gru(rng), Gru(rng)
        self.p = {"embed": rng.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32),
                  "out": rng.normal(0, 0.3, (len(languages), 2 * HIDDEN)).astype(np.float32), "bias": np.zeros(len(languages), np.float32)}

    def weights(self) -> dict[str, np.ndarray]:
        return self.p | {f"{s}_{k}": v for s, g in (("left", self.left), ("right", self.right)) for k, v in g.p.items()}

    def gates(self) -> list[np.ndarray]:
        return [np.ascontiguousarray(g.p["x"] @ self.p["embed"].T + g.p["b"][:, None]) for g in (self.left, self.right)]

    def labels(self, ids: np.ndarray, gates: list[np.ndarray], keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Log probabilities (time, language, spans) of every position."""
        a, saved_a = self.left.run(gates[0], ids, keep)
        b, saved_b = self.right.run(gates[1], ids[::-1], keep)
        z = np.matmul(self.p["out"][:, :HIDDEN], a) + np.matmul(self.p["out"][:, HIDDEN:], b[::-1]) + self.p["bias"][:, None]
        z -= z.max(axis=1, keepdims=True)
        z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return z, (a, b, saved_a, saved_b)

    def step(self, ids: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean loss of all positions that hold a byte."""
        logp, (a, b, saved_a, saved_b) = self.labels(ids, self.gates(), keep=True)
        d = np.exp(logp)
        d[:, y, np.arange(len(y))] -= 1
        real = (ids != PAD)[:, None, :]
        d = (d * real / max(1, real.sum())).astype(np.float32)
        both = np.concatenate([a, b[::-1]], axis=1)
        g = {"out": np.einsum("tls,ths->lh", d, both), "bias": d.sum(axis=(0, 2))}
        d_both = np.matmul(self.p["out"].T, d)
        x = self.p["embed"].T[:, ids].transpose(1, 0, 2)
        g_left, dx_left = self.left.back(d_both[:, :HIDDEN], saved_a, x)
        g_right, dx_right = self.right.back(d_both[::-1, HIDDEN:], saved_b, x[::-1])
        g["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(g["embed"], ids.ravel(), (dx_left + dx_right[::-1]).transpose(0, 2, 1).reshape(-1, EMBED))
        return g | {f"left_{k}": v for k, v in g_left.items()} | {f"right_{k}": v for k, v in g_right.items()}

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language and the probability of each text."""
        data, offsets = utf8(col)
        n_bytes = np.diff(offsets)
        n_spans = -(-n_bytes // SPAN)
        doc = np.repeat(np.arange(len(col)), n_spans)
        begin = offsets[:-1][doc] + SPAN * (np.arange(len(doc)) - np.repeat(np.cumsum(n_spans) - n_spans, n_spans))
        stop = offsets[1:][doc]
        total = np.zeros((len(col), len(self.languages)))
        gates = self.gates()
        for a in range(0, len(doc), PIECE):
            ids = _spans(data, begin[a:a + PIECE], stop[a:a + PIECE])
            logp, _ = self.labels(ids, gates)
            np.add.at(total, doc[a:a + PIECE], (logp * (ids != PAD)[:, None, :]).sum(axis=0).T)
        # positions of a span share its state: a span counts as a few independent signs
        total /= np.maximum(1, np.minimum(n_bytes, SPAN) / 4)[:, None]
        total = np.exp(np.maximum(total - total.max(axis=1, keepdims=True), -50))
        share = total / total.sum(axis=1, keepdims=True)
        letters = pc.fill_null(pc.match_substring_regex(col, r"\pL"), False).to_numpy(zero_copy_only=False)
        names = [self.languages[i] if ok else UNKNOWN for i, ok in zip(share.argmax(axis=1).tolist(), letters, strict=True)]
        return names, np.where(letters, np.round(share.max(axis=1), 6), 0.0)


def _spans(data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Bytes by time and span; PAD beyond the end of a text."""
    at = np.arange(SPAN)[:, None] + begin[None]
    inside = at < stop
    ids = np.full(at.shape, PAD, np.int64)
    ids[inside] = data[at[inside]]
    return ids


def fit(texts: pa.Array, langs: np.ndarray, steps: int = STEPS, seed: int = 11) -> Model | None:
    """Train by Adam on spans drawn from the texts; languages are drawn alike."""
    if not len(langs):
        return None
    names = sorted(set(langs.tolist()))
    model, rng = Model(names, seed), np.random.default_rng(seed)
    data, offsets = utf8(texts)
    y_of = np.searchsorted(np.array(names), langs)
    rows = np.repeat(np.flatnonzero(np.diff(offsets) > 0), SPANS_EACH)
    if len(names) == 1 or not len(rows):
        model.p["out"][:] = 0
        return model
    begin = offsets[rows] + (rng.random(len(rows)) * np.maximum(1, offsets[rows + 1] - offsets[rows] - SPAN // 2)).astype(np.int64)
    stop, y = offsets[rows + 1], y_of[rows]
    by = [np.flatnonzero(y == k) for k in range(len(names))]
    by = [b for b in by if len(b)]
    weights = model.weights()
    first, second = {k: np.zeros_like(v) for k, v in weights.items()}, {k: np.zeros_like(v) for k, v in weights.items()}
    for i in range(1, steps + 1):
        pick = np.concatenate([rng.choice(b, BATCH // len(by)) for b in by])
        g = model.step(_spans(data, begin[pick], stop[pick]), y[pick])
        norm = float(np.sqrt(sum((v * v).sum() for v in g.values())))
        rate = RATE * min(1.0, 2 * (1 - (i - 1) / steps))
        for k, w in weights.items():
            d = g[k] * min(1.0, 1.0 / max(norm, 1e-9))
            first[k] += 0.1 * (d - first[k])
            second[k] += 0.01 * (d * d - second[k])
            w -= rate * (first[k] / (1 - 0.9 ** i)) / (np.sqrt(second[k] / (1 - 0.99 ** i)) + 1e-6)
    return model


def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0) -> Column:
    """Whether a hash of the id falls in the given part; rows with a null id are not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def train(docs: DataFrame, max_labelled: int = MAX_LABELLED) -> Model | None:
    """Fit on rows with a language that are not held out, those of least hash."""
    known = docs.filter("lang is not null and text is not null and doc_id is not null").filter(~held_out())
    # the ids first: a sort of whole texts would move them all
    pick = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).distinct()
    rows = known.select("doc_id", "lang", F.substring("text", 1, FIT_CHARS).alias("text")).join(F.broadcast(pick), "doc_id").toArrow()
    order = np.lexsort((rows.column("lang").to_numpy(zero_copy_only=False).astype(str), mixed(rows.column("doc_id").to_numpy().astype(np.uint64)))) if len(rows) else []
    return fit(rows.column("text").combine_chunks().take(pa.array(order)) if len(order) else pa.array([], pa.string()),
               rows.column("lang").to_numpy(zero_copy_only=False).astype(str)[order] if len(order) else np.array([], str))


def identified(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with a struct column __language (lang, score)."""
    tune(docs.sparkSession)
    model = model or train(docs)

    def run(col: pa.Array) -> pa.Array:
        names, score = model.predict(col) if model else ([UNKNOWN] * len(col), np.zeros(len(col)))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], ["lang", "score"])
    return docs.withColumn("__language", F.arrow_udf(run, "struct<lang: string, score: double>")(F.col("text")))
