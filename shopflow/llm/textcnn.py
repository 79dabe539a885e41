"""A small convolutional classifier of variable-length sequences in numpy: embeddings, filters of several widths, maxima,
one logistic unit.

Ids lie end to end, each sequence followed by PAD ids; a place may hold several ids (rows of the array), whose embeddings
add up.  A filter is linear in each place, so scoring looks up what each id adds to each filter, and needs no matrix
product per place.  Training (Adagrad) takes gradients only at the winning places.
"""

from __future__ import annotations

import numpy as np

#: Places filtered at a time.
PIECE = 200_000


class ConvNet:
    def __init__(self, vocabulary: int, embed: int, filters: int, widths: tuple[int, ...], rate: float, seed: int, scale: float = 0.05):
        rng = np.random.default_rng(seed)
        self.pad, self.filters, self.widths, self.rate = vocabulary, filters, widths, rate
        self.p = {"embed": rng.normal(0, scale, (vocabulary + 1, embed)).astype(np.float32),
                  "out": rng.normal(0, 0.3, len(widths) * filters).astype(np.float32), "bias": np.zeros(1, np.float32)}
        self.p["embed"][vocabulary] = 0
        for w in widths:
            self.p[f"filter{w}"] = rng.normal(0, 0.4, (w, embed, filters)).astype(np.float32)
            self.p[f"start{w}"] = np.zeros(filters, np.float32)
        self.squares = {k: np.full(v.shape, 1e-3, np.float32) for k, v in self.p.items()}

    def tables(self) -> dict:
        """What each id adds to each filter at each of its places."""
        return {w: [self.p["embed"] @ self.p[f"filter{w}"][k] for k in range(w)] for w in self.widths}

    def pooled(self, ids: np.ndarray, first: np.ndarray, lens: np.ndarray, tables: dict) -> np.ndarray:
        """The maxima over all places of each sequence; sequences lie in ids from first, lens places long."""
        out = np.full((len(first), len(self.widths) * self.filters), -np.inf, np.float32)
        at = np.repeat(first - np.cumsum(lens) + lens, lens) + np.arange(int(lens.sum()))
        of_all = np.repeat(np.arange(len(first)), lens)
        for a in range(0, len(at), PIECE):
            here, of = at[a:a + PIECE], of_all[a:a + PIECE]
            cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            for j, w in enumerate(self.widths):
                conv = tables[w][0][ids[0, here]]
                for k in range(w):
                    for kind in range(len(ids)):
                        if k or kind:
                            conv += tables[w][k][ids[kind, here + k]]
                part = slice(j * self.filters, (j + 1) * self.filters)
                out[of[cuts], part] = np.maximum(out[of[cuts], part], np.maximum.reduceat(conv, cuts))
        return np.maximum(out + np.concatenate([self.p[f"start{w}"] for w in self.widths]), 0)

    def logits(self, ids: np.ndarray, first: np.ndarray, lens: np.ndarray, tables: dict | None = None) -> np.ndarray:
        return self.pooled(ids, first, lens, tables or self.tables()) @ self.p["out"] + self.p["bias"]

    def step(self, all_ids: np.ndarray, start: np.ndarray, lens: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """One gradient step on the given sequences."""
        # Each place is embedded once, with the tail a filter reads behind a sequence; a filter's later places are the rows below.
        # Long sequences are read a piece at a time; what has won so far is kept.
        tail = max(self.widths) - 1
        size = lens + tail
        first = np.cumsum(size) - size
        shift, of = np.repeat(start - first, size), np.repeat(np.arange(len(y)), size)
        n = len(of) - tail
        best = {w: np.zeros((len(y), self.filters), np.int64) for w in self.widths}
        tops = {w: np.full((len(y), self.filters), -np.inf, np.float32) for w in self.widths}
        for a in range(0, n, PIECE):
            b = min(n, a + PIECE)
            x = self.p["embed"].take(all_ids.take(shift[a:b + tail] + np.arange(a, b + tail), axis=1), axis=0).sum(axis=0)
            here = np.arange(of[a], of[b - 1] + 1)
            begin, end = np.maximum(first[here], a) - a, np.minimum(first[here] + lens[here], b) - a
            here, begin, end = (v[end > begin] for v in (here, begin, end))  # a piece may begin or end behind a sequence
            edges = np.stack([begin, end], 1).ravel()
            edges = edges[:-1] if edges[-1] == b - a else edges
            for w in self.widths:
                conv = x[:b - a] @ self.p[f"filter{w}"][0]
                for k in range(1, w):
                    conv += x[k:b - a + k] @ self.p[f"filter{w}"][k]
                top = np.full((len(y), self.filters), np.inf, np.float32)
                top[here] = np.maximum.reduceat(conv, edges)[::2]
                # the first place that wins is within its sequence, and is written last
                won = np.flatnonzero(conv == top.take(of[a:b], axis=0))[::-1]
                where, col = np.divmod(won, self.filters)
                place = np.zeros(top.shape, np.int64)
                place[of[a:b][where], col] = where + a
                more = top[here] > tops[w][here]
                best[w][here], tops[w][here] = np.where(more, place[here], best[w][here]), np.where(more, top[here], tops[w][here])
        value = np.concatenate([np.maximum(tops[w] + self.p[f"start{w}"], 0) for w in self.widths], 1)
        z = np.clip(value @ self.p["out"] + self.p["bias"], -30, 30)
        d = (weight * (1 / (1 + np.exp(-z)) - y) / len(y)).astype(np.float32)
        grad = {"out": value.T @ d + 1e-4 * self.p["out"], "bias": d.sum(keepdims=True)}
        d_value = (d[:, None] * self.p["out"]) * (value > 0)
        moved, change = [], []
        for j, w in enumerate(self.widths):
            dv = d_value[:, j * self.filters:(j + 1) * self.filters]
            grad[f"start{w}"] = dv.sum(0)
            g = np.zeros_like(self.p[f"filter{w}"])
            for k in range(w):
                ids = all_ids.take(best[w] + (start - first)[:, None] + k, axis=1)
                g[k] = np.einsum("nfe,nf->ef", self.p["embed"].take(ids, axis=0).sum(axis=0), dv)
                back = (dv[:, :, None] * self.p[f"filter{w}"][k].T[None]).reshape(-1, self.p["embed"].shape[1])
                for kind in ids:
                    moved.append(kind.ravel())
                    change.append(back)
            grad[f"filter{w}"] = g
        for name, g in grad.items():
            self.squares[name] += g * g
            self.p[name] -= self.rate * g / np.sqrt(self.squares[name])
        moved, (rows, width) = np.concatenate(moved), self.p["embed"].shape
        seen, rank = np.zeros(rows, bool), np.empty(rows, np.int64)
        seen[moved] = True
        which = np.flatnonzero(seen)
        rank[which] = np.arange(len(which))
        d_embed = np.zeros((len(which), width), np.float32)
        cells = np.arange(d_embed.size).reshape(d_embed.shape)
        np.add.at(d_embed.reshape(-1), cells.take(rank.take(moved), axis=0).ravel(), np.concatenate(change).ravel())
        d_embed[which == self.pad] = 0
        self.squares["embed"][which] += d_embed * d_embed
        self.p["embed"][which] -= self.rate * d_embed / np.sqrt(self.squares["embed"][which])

    def train(self, ids: np.ndarray, first: np.ndarray, lens: np.ndarray, rows: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int, batch: int, seed: int, keep: bool = False) -> None:
        """Steps over the given rows, each pass in another order; what only training needs is dropped at the end, unless kept."""
        rng = np.random.default_rng(seed)
        order = np.concatenate([rng.permutation(rows) for _ in range(steps * batch // len(rows) + 1)])
        for i in range(steps):
            pick = order[i * batch:(i + 1) * batch]
            self.step(ids, first[pick], lens[pick], y[pick], weight[pick])
        if not keep:
            self.squares = {}
