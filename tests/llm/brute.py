"""Plain restatements of the operators' contracts, row by row, to test against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def quality(text: str | None) -> dict:
    text = text or ""
    w = WORD.findall(text)
    triples = Counter(zip(w, w[1:], w[2:], strict=False))
    again = set()
    for i in range(len(w) - 2):
        if triples[tuple(w[i:i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": dup,
            "n_repeat_words": len(again), "base_failed": len(w) < 50 or 100 * len(again) > 50 * len(w)}


def pii(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        twice = [x if i % 2 == 0 else (2 * x if 2 * x < 10 else 2 * x - 9) for i, x in enumerate(d[::-1])]
        if 12 <= len(d) <= 19 and sum(twice) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], ("email", "ip", "card", "phone").index(s[0])))


def secrets(text: str | None) -> list[tuple[str, int, int]]:
    text, out = text or "", []
    rx = r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    rx = re.sub(r"(?<![\\A-Za-z])[a-z](?=[a-z_|)?])|(?<=[a-z])[a-z]", lambda m: m[0], rx)
    for m in re.finditer(rx, text, re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def shingle_set(text: str | None, k: int = 5) -> frozenset:
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def near_classes(rows: list[tuple[int | None, str | None]]) -> list[tuple[int, int | None]]:
    """(set size, component_id) of each row, all pairs compared."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    inverted: dict = {}
    for i, s in enumerate(sets):
        hits: Counter = Counter()
        for g in s:
            hits.update(inverted.setdefault(g, []))
            inverted[g].append(i)
        for j, n in hits.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(len(s), least.get(find(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def mix(rows: list[tuple[int | None, str | None, str | None]], seed: str, weights=(5, 2, 1)) -> list[tuple[int, int, float, int]]:
    """(size, source_size, target, taken) of each row (doc_id, text, source)."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total: dict = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        total[s] = total.get(s, 0) + n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: set = set()
    left = 1.5 * sum(total.values())
    while True:
        open_ = [s for s in order if s not in full]
        level = (left - sum(2 * total[s] for s in full)) / sum(weight[s] for s in open_) if open_ else 0
        new = {s for s in open_ if 2 * total[s] < weight[s] * level}
        if not new:
            break
        full |= new
    target = {s: 2.0 * total[s] if s in full else weight[s] * level for s in order}
    out, nth = [], Counter()
    for (doc_id, t, s), n in zip(rows, size, strict=True):
        rate = target[s] / total[s] if total[s] else 0
        key = f"{'null' if doc_id is None else doc_id}:{hashlib.md5((t or '').encode()).hexdigest()}"
        draw = int(hashlib.md5(f"{seed}:{key}:{nth[key, s]}:{'null' if s is None else s}".encode()).hexdigest()[:13], 16) / 16 ** 13
        nth[key, s] += 1
        out.append((n, total[s], target[s], (int(rate) + (draw < rate - int(rate))) * n))
    return out


def repeats(rows: list[tuple[int | None, str | None]], length: int = 100) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each row; rows with the same id and text are one document."""
    docs = sorted({(d is None, d or 0, t or "") for d, t in rows}, key=lambda x: (x[0], x[1], hashlib.sha256(x[2].encode()).hexdigest()))
    seen, out = set(), {}
    for key in docs:
        raw = key[2].encode()
        gone = bytearray(len(raw))
        until = 0
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                a = max(p, until)
                gone[a:p + length] = b"\x01" * (p + length - a)
                until = p + length
            seen.add(w)
        n_spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[key] = (len(raw), sum(gone), n_spans, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return [out[(d is None, d or 0, t or "")] for d, t in rows]


def damage(rows: list[tuple]) -> list[tuple]:
    """(conv_id, turn, role, text) rows after their damage, each conversation in order."""
    out = []
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if kind == 4 else role
        text = "" if kind in (0, 1) else re.sub(r"[.!?]", "", text) if kind == 2 else text
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2].encode(), r[3][:64].encode(), hashlib.md5(r[3].encode()).hexdigest()))


def repair(turns: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, lines) of one conversation's (turn, role, text)."""
    known = [t for t, _, _ in turns if t is not None]
    seen, faults = set(), []
    for _, role, text in turns:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    n = len(turns)
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}
    # cheapest (cost, audit, lines) from each place on, by what was written last; two insertions in a row are enough
    best: list[dict] = [{} for _ in range(n + 1)]
    for i in range(n, -1, -1):
        now = {}
        for last in follow:
            options = [(0, "", ())] if i == n and last in ("", "a") else []
            if i < n:
                _, role, text = turns[i]
                options.append((4 + best[i + 1][last][0], "D" + best[i + 1][last][1], best[i + 1][last][2]))
                if faults[i] not in ("blank", "duplicate"):
                    extra = 3 * (faults[i] == "truncated")
                    if role[:1] and role[:1] in follow[last]:
                        c, a, t = best[i + 1][role[:1]]
                        options.append((extra + c, "K" + a, (f"{role}:{text}", *t)))
                    for to in set(follow[last]) & set(full):
                        c, a, t = best[i + 1][to]
                        options.append((3 + extra + c, "R" + a, (f"{full[to]}:{text}", *t)))
            now[last] = options
        for _ in range(3):
            grown = {}
            for last in follow:
                more = [(3 + c, "I" + a, (f"{full[to]}:", *t)) for to in set(follow[last]) & set(full) for c, a, t in now[to][:1]]
                grown[last] = sorted(now[last] + more)[:1]
            now = grown
        best[i] = {k: v[0] for k, v in now.items()}
    cost, audit, lines = best[0][""]
    first = [r[:1] for _, r, _ in turns]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)), cost, audit, lines)


def repairs(rows: list[tuple]) -> dict:
    """The result of each conversation of damaged rows."""
    turns: dict = {r[0]: [] for r in rows}
    for conv_id, *turn in damage(rows):
        turns[conv_id].append(turn)
    out = {}
    for conv_id, own in turns.items():
        *counts, lines = repair(own)
        out[conv_id] = (*counts, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranking(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    """(item_id, rank, doc_id, score), every document scored for every item."""
    counts = [Counter(TERM.findall(lower(t or ""))) for _, t in docs]
    n_docs, total = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, _), c in zip(docs, counts, strict=True):
            n = sum(c.values())
            score = 0
            for t in set(TERM.findall(lower(text or ""))) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1000000000 * c[t] // (1000 * c[t] + 8 * (100 - 90 + 90 * n * n_docs // total)))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return out
