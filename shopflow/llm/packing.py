"""Packing token streams into fixed windows by the sum-of-squares rule.

Every document becomes token ids and an end mark.  Whole windows are cut off its front; the rest is placed by the
sum-of-squares rule: of all fill levels that a partially filled window has (and the empty one), the document goes to the
one that leaves the least sum of squared counts of partially filled windows, where a level array of `window` counters
holds how many windows stand at each level.  Full windows leave at once.

The rule leaves some windows partially filled, which would be padded.  Documents may be cut, so at the end of a task, or
when OPEN_WINDOWS are open, the contents of the open windows are laid end to end, fullest first, and cut into full ones;
the last remainder is cut into sequences of powers of two, which need no padding.  So at most log2(window) sequences a
task are shorter than a window, and a document is cut at most once more for each.

Scale.  Each task packs its own rows, without a shuffle; it holds the open windows, OPEN_WINDOWS * window ids at most,
and its Python worker a table of at most CACHED_WORDS tokenized words.

Defined cases.  Null and empty text is the end mark alone.  A text of any length is cut into windows.  Rows are packed
one by one: null and repeated ids, repeated rows and ties make pieces of their own.  Other columns are ignored.  An empty
table has no pieces.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator
from itertools import batched
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

WINDOW = 4096
END_ID = 2
#: Partially filled windows that a task holds at most before it closes them.
OPEN_WINDOWS = 1024
#: Words whose ids a worker process keeps, and the longest of them in characters.
CACHED_WORDS, CACHED_LENGTH = 1_000_000, 64
#: Words that are encoded at once.
WORDS = 64
STOPS = ".,;:!?"
#: Python splits at these as well, but the tokenizers' white space has them not.
NO_SPACE = re.compile("[\x1c-\x1f]")
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of whole texts, as little-endian 32-bit numbers; words are looked up where they were seen before.

    Right for tokenizers that drop white space and cut at it, as word-level BPE does: no token spans white space,
    whatever stands beside it, so the words between are tokenized once.  Where the tokenizer also reads A-Z as a-z, cuts
    stops off letters and leaves ASCII letters as they are, a word is put together from its stem and its stops, and stems
    of ASCII letters go straight to its model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        ids = lambda x: self.model.encode(x, add_special_tokens=False).ids
        self.stops = STOPS if ids("Worded,Word" + STOPS) == [*ids("worded"), *ids(","), *ids("word"), *ids(STOPS)] else ""
        alphabet = "abcdefghijklmnopqrstuvwxyz"
        steps = self.model.normalizer, self.model.pre_tokenizer
        same = all(steps) and steps[0].normalize_str(alphabet) == alphabet and [x for x, _ in steps[1].pre_tokenize_str(alphabet)] == [alphabet]
        self.letters = self.model.model if same and self.stops else None
        self.known: dict[str, bytes] = {}  # words, stems and stops

    @classmethod
    def of_worker(cls, path: str) -> WordTokenizer:
        """The tokenizer of this process: a Python worker serves many tasks."""
        kept = sys.modules.setdefault("_worker_tokenizers", types.ModuleType("_worker_tokenizers")).__dict__
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def encode(self, texts: list[str]) -> list[bytes]:
        words = [[w for w in BLANK.split(t) if w] if NO_SPACE.search(t) else t.split() for t in texts]
        ids = [list(map(self.known.get, ws)) for ws in words]
        new = {w for ws, found in zip(words, ids, strict=True) if None in found for w, x in zip(ws, found, strict=True) if x is None}
        if new:
            fresh = self._new(new)
            ids = [[fresh[w] if x is None else x for w, x in zip(ws, found, strict=True)] if None in found else found for ws, found in zip(words, ids, strict=True)]
            if len(self.known) + len(fresh) > CACHED_WORDS:
                self.known.clear()
            if len(fresh) <= CACHED_WORDS:
                self.known.update((w, x) for w, x in fresh.items() if len(w) <= CACHED_LENGTH)
        return list(map(b"".join, ids))

    def _new(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words, and of the stems and stops that they are made of."""
        stem_of, todo, stops = {}, set(), self.stops
        for w in words:
            if stops and w.isascii():
                low = w.lower()
                stem = low.rstrip(stops)
                if stem and stem[-1].isalnum():
                    if low != w or stem != w:
                        stem_of[w] = stem, low[len(stem):]
                    todo.update((stem, low[len(stem):]))
                    continue
            todo.add(w)
        todo.discard("")
        out = {w: x for w in todo if (x := self.known.get(w)) is not None}
        todo.difference_update(out)
        if self.letters:
            plain = [w for w in todo if w.isascii() and w.isalpha() and w.islower()]
            for w in plain:
                ids = [x.id for x in self.letters.tokenize(w)]
                out[w] = pack(f"<{len(ids)}I", *ids)
            todo.difference_update(plain)
        for some in batched(todo, WORDS):
            out.update(zip(some, self._apart(some), strict=True))
        for w, (stem, end) in stem_of.items():
            out[w] = out[stem] + out[end] if end else out[stem]
        return out

    def _apart(self, words: tuple[str, ...]) -> list[bytes]:
        """The ids of each word, all encoded as one text; offsets tell them apart."""
        e = self.model.encode("\n".join(words), add_special_tokens=False)
        at = np.fromiter((a for a, _ in e.offsets), np.int64, len(e.ids))
        ends = 4 * np.searchsorted(at, np.cumsum([len(w) + 1 for w in words]))
        ids, out, start = np.array(e.ids, "<u4").tobytes(), [], 0
        for end in ends.tolist():
            out.append(ids[start:end])
            start = end
        return out


class Packer:
    """The level array and the open windows of a task.

    A window is a list of (row, ids); a row is (doc_id, start, doc_tokens) of the piece.
    """

    def __init__(self, window: int = WINDOW, first: int = 0):
        self.window, self.sequence = window, first
        self.counts = np.zeros(window + 1, np.int64)  # windows at each level; 0 and window always count 0
        self.open: dict[int, list[list]] = {}
        self.n_open = 0
        self.out: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.window:
            self._close([((doc_id, at, total), ids[4 * at:4 * (at + self.window)])])
            at += self.window
        if at < total:
            self._place((doc_id, at, total), ids[4 * at:])

    def level(self, size: int) -> int:
        """The fill level at which `size` ids leave the least sum of squares; the fullest of equal ones."""
        w, counts = self.window, self.counts
        # moving one window from level h to h + size changes the sum by 2 (N[h + size] - N[h]) + 2; a level of 0 or w is not counted
        change = counts[size:w + 1] - counts[:w + 1 - size]
        change = 2 * change + 2
        change[0] -= 1  # an empty window is no partially filled one
        change[-1] -= 1  # and a full one neither
        change[1:][counts[1:w + 1 - size] == 0] = np.iinfo(np.int64).max
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def _place(self, row: tuple, ids: bytes) -> None:
        size = len(ids) // 4
        level = self.level(size)
        own = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
            self.n_open -= 1
        own.append((row, ids))
        if level + size == self.window:
            self._close(own)
            return
        self.open.setdefault(level + size, []).append(own)
        self.counts[level + size] += 1
        self.n_open += 1
        if self.n_open > OPEN_WINDOWS:
            self.drain(False)

    def _close(self, pieces: list) -> None:
        offset = 0
        for (doc_id, start, total), ids in pieces:
            self.out.append((doc_id, start, len(ids) // 4, total, self.sequence, offset, ids))
            offset += len(ids) // 4
        self.sequence += 1

    def drain(self, end: bool = True) -> None:
        """Close the open windows: full ones from their contents end to end, and at the end of a task powers of two."""
        line: list = []
        held = 0
        for level in sorted(self.open, reverse=True):
            for own in self.open[level]:
                line += own
                held += level
                while held >= self.window:
                    line = self._cut(line, self.window)
                    held -= self.window
        self.open.clear()
        self.counts[:] = 0
        self.n_open = 0
        if not end and held:
            self.open[held] = [line]
            self.counts[held] = self.n_open = 1
        while end and held:
            size = 1 << (held.bit_length() - 1)
            line = self._cut(line, size)
            held -= size

    def _cut(self, line: list, size: int) -> list:
        """Close a sequence of the first `size` ids of the line; what is left of it."""
        taken, i = [], 0
        while size:
            (doc_id, start, total), ids = line[i]
            n = min(size, len(ids) // 4)
            taken.append(((doc_id, start, total), ids[:4 * n]))
            if 4 * n < len(ids):
                line[i] = ((doc_id, start + n, total), ids[4 * n:])
            else:
                i += 1
            size -= n
        self._close(taken)
        return line[i:]


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) of each piece; ids are little-endian 32-bit numbers.

    tokenizer: a file of the tokenizers library, at the same place on every machine.
    """
    tune(docs.sparkSession)
    path, end = tokenizer or default_tokenizer(), np.array([end_id], "<u4").tobytes()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark.sql.pandas.types import to_arrow_type
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        schema = pa.schema([("doc_id", to_arrow_type(kind)), *((n, pa.int64()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")), ("ids", pa.binary())])
        words, packer = None, Packer(window, TaskContext.get().partitionId() << 40)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*packer.out, strict=True)) or [()] * 7
            packer.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for b in batches:
            words = words or WordTokenizer.of_worker(path)
            texts = [x or "" for x in b.column("text").to_pylist()]
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), words.encode(texts), strict=True):
                packer.add(doc_id, ids + end)
            if packer.out:
                yield flush()
        packer.drain()
        if packer.out:
            yield flush()

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
