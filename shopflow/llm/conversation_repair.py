"""Conversation structure repair: least-cost edits of damaged turn sequences, by rank-convergence parallel Viterbi.

A repaired conversation has role initials `(s?(ua)+)?`.  Four states say what was written so far (nothing, a system, a
user, an assistant turn), and for each place of a conversation a vector holds the least cost from there to the end by
state.  Costs are bounded, so up to a constant there are few different vectors: they are numbered once (`tables`), and a
step backward over a row is one look-up.

Conversations are sorted across the cluster by range and cut into pieces of at most PIECE_ROWS rows or PIECE_BYTES of
text; a conversation may span many pieces and tasks.  Every piece runs backward at once, the last one of a conversation
from the true end, the others from a speculative vector.  Fix-up passes then rerun a piece from the vector that its
right neighbour arrived at, and stop at the row where the new vector differs from the former one only by a constant;
passes go on until no piece's input has changed.  A piece whose vectors never converge hands them on, so each pass lets
one task run through PASS_GROWTH times as many neighbouring pieces as the one before, and the number of passes is
logarithmic in the number of pieces.  The stitched vectors then drive the trace forward, which takes the ASCII-least edit
among the cheapest; pieces are traced at once, as their entry states are composed first.

Scale.  One range shuffle of the rows; conversations that lie within a task are done there.  Of the others only symbols
and vector numbers (two bytes a row) and fingerprints of rows move, and their pieces once for the trace and once for the
digest.  A conversation of any share of all rows is many pieces in many tasks, also where its rows are all alike: a row
number is the last key of the range.  Only what one cell of the result holds (audit, digest) is joined in one task,
piece by piece.

Defined cases.  A null conv_id is a conversation of its own.  Null role and text are read as one space, null turns sort
first and are one space in the key of the damage.  Rows of one turn are taken by role, by the first 64 characters of the
text, then by its MD5.  Blank rows are never duplicates; what was seen earlier counts even if blank or deleted.  A role
counts by its first character; an empty role has none, and fits nowhere.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import drop_saved, map_batches, saved, tune

#: Longest piece of a conversation.
PIECE_ROWS, PIECE_BYTES = 4096, 4 << 20
#: Pieces that a task may run through in the k-th fix-up pass: this to the power of k.
PASS_GROWTH = 16
KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
#: Added where a truncated row stays.
TRUNCATED = 3
#: States by what was written last; what may be written next, other than a system turn at the start.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: A row's symbol: the class of its role, plus CUT if truncated; or GONE if it must be deleted.
CLASSES = {"s": 0, "u": 1, "a": 2}
OTHER, CUT, GONE = 3, 4, 8
LEGAL = frozenset(("su", "ua", "au"))

NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]")
LAST = re.compile(r"[^\x20\x09-\x0D](?=[\x20\x09-\x0D]*\Z)")


def _keeps(state: int, symbol: int) -> int | None:
    """The state after a row of the symbol is kept as it is, or None."""
    role = symbol % 4
    if role == 0:
        return SYSTEM if state == START else None
    return NEXT[state] if role < OTHER and NEXT[state] == (USER, ASSISTANT)[role - 1] else None


def _inserted(v: tuple[int, ...]) -> tuple[int, ...]:
    """With insertions ahead of it where they are cheaper."""
    v = list(v)
    for _ in range(3):
        for s in range(4):
            v[s] = min(v[s], INSERT + v[NEXT[s]])
    return tuple(v)


def _before(v: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """The vector ahead of a row, from the one behind it."""
    out = []
    for s in range(4):
        best = DELETE + v[s]
        if symbol != GONE:
            stays = TRUNCATED * (symbol >= CUT)
            best = min(best, REROLE + stays + v[NEXT[s]])
            if (to := _keeps(s, symbol)) is not None:
                best = min(best, KEEP + stays + v[to])
        out.append(best)
    return _inserted(tuple(out))


def _normal(v: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(x - min(v) for x in v)


class Tables:
    """All vectors that can occur, up to constants, and what follows from them.

    back[v][symbol]: the vector ahead of a row.  trace[v][symbol][state]: edits up to and with the row, state after it,
    and cost, where v is the vector behind the row.
    """

    def __init__(self):
        end = _inserted((0, 10 ** 6, 10 ** 6, 0))
        vectors = [_normal(end), _normal(_inserted((0, 0, 0, 0)))]
        self.end, self.guess = 0, 1
        number, self.back, self.trace = {v: i for i, v in enumerate(vectors)}, [], []
        for v in vectors:  # grows while it is read
            ahead, edits = [], []
            for symbol in range(GONE + 1):
                w = _before(v, symbol)
                if _normal(w) not in number:
                    number[_normal(w)] = len(vectors)
                    vectors.append(_normal(w))
                ahead.append(number[_normal(w)])
                edits.append([self._edits(v, w, symbol, s) for s in range(4)])
            self.back.append(bytes(ahead))  # there are far fewer than 256
            self.trace.append(edits)
        self.size = len(vectors)

    @staticmethod
    def _edits(v: tuple[int, ...], w: tuple[int, ...], symbol: int, state: int) -> tuple[str, int, int]:
        out, cost, stays = "", 0, TRUNCATED * (symbol >= CUT)
        while True:
            if w[state] == DELETE + v[state]:
                return out + "D", state, cost + DELETE
            if w[state] == INSERT + w[NEXT[state]]:
                out, state, cost = out + "I", NEXT[state], cost + INSERT
                continue
            to = _keeps(state, symbol)
            if to is not None and w[state] == KEEP + stays + v[to]:
                return out + "K", to, cost + KEEP + stays
            return out + "R", NEXT[state], cost + REROLE + stays


def trail(t: Tables, symbols: bytes, at_end: int, former: bytes | None = None) -> bytes:
    """The vector ahead of each row and behind the last; a former trail is kept from where it agrees."""
    out = bytearray(former or bytes(len(symbols) + 1))
    v = out[-1] = at_end
    back = t.back
    for i in range(len(symbols) - 1, -1, -1):
        v = back[v][symbols[i]]
        if former is not None and out[i] == v:
            break  # from here on the vectors differ only by a constant
        out[i] = v
    return bytes(out)


def exits(t: Tables, symbols: bytes, vectors: bytes) -> bytes:
    """The state behind the piece for each state ahead of it."""
    states, steps = [0, 1, 2, 3], t.trace
    for i, symbol in enumerate(symbols):
        step = steps[vectors[i + 1]][symbol]
        states = [step[s][1] for s in states]
        if states[0] == states[1] == states[2] == states[3]:
            s = states[0]
            for j in range(i + 1, len(symbols)):
                s = steps[vectors[j + 1]][symbols[j]][s][1]
            return bytes([s] * 4)
    return bytes(states)


def traced(t: Tables, symbols: bytes, vectors: bytes, state: int, last: bool) -> tuple[list[str], int]:
    """The edits up to and with each row, then those at the end of the conversation; and the cost."""
    out, cost = [], 0
    for i, symbol in enumerate(symbols):
        edits, state, c = t.trace[vectors[i + 1]][symbol][state]
        out.append(edits)
        cost += c
    tail = {USER: "I", SYSTEM: "II"}.get(state, "") if last else ""
    return [*out, tail], cost + INSERT * len(tail)


def written(edits: list[str], roles: list[str], texts: list[str], state: int) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the turns that the edits leave, from the state ahead of them."""
    out = []
    for i, piece in enumerate(edits):
        for e in piece:
            if e == "D":
                continue
            role = roles[i] if e == "K" else ROLES[NEXT[state]]
            state = SYSTEM if e == "K" and role[0] == "s" else NEXT[state]
            out.append((e, role, "" if e == "I" else texts[i]))
    return out


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after their damage; dropped ones stay with 0 copies and empty text."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space(conv_col), F.lit(":"), or_space(turn_col)).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(or_space(text_col), "[.!?]", "")).otherwise(or_space(text_col))
    return rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       F.when(kind == 4, "user").otherwise(or_space(role_col)).alias("role"), text.alias("text"),
                       F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _fault(text: str) -> str:
    if not NOT_SPACE.search(text):
        return "blank"
    return "" if LAST.search(text)[0] in ".!?" else "truncated"


def _symbol(role: str, fault: str) -> int:
    return GONE if fault in ("blank", "duplicate") else CLASSES.get(role[:1], OTHER) + CUT * (fault == "truncated")


def _counts(turns: list[int | None], roles: list[str], faults: list[str]) -> dict:
    """What a piece adds to its conversation's counts, and its ends."""
    known = [x for x in turns if x is not None]
    first = [r[:1] for r in roles]
    return {"n": len(roles), "lo": known[0] if known else None, "hi": known[-1] if known else None, "distinct": len(set(known)),
            "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
            "illegal": sum(a + b not in LEGAL for a, b in zip(first, first[1:], strict=False)), "head": first[0] if first else None, "tail": first[-1] if first else None}


def _gaps(c: dict) -> int:
    return 0 if c["lo"] is None else c["hi"] - c["lo"] + 1 - c["distinct"]


def _body(lines: list[tuple[str, str, str]]) -> bytes:
    return "\n".join(f"{role}:{text}" for _, role, text in lines).encode("utf-8", "surrogatepass")


COUNTS = "n long, lo long, hi long, distinct long, blank long, duplicate long, truncated long, illegal long, head string, tail string"
LINES = "array<struct<edit: string, role: string, text: string>>"
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_LINES = pa.list_(pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]))


def _arrow(schema: str, kind: pa.DataType) -> pa.Schema:
    """The Arrow schema of one of the schemas here; conv_id is of the given kind."""
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "int": pa.int32(), LINES: _LINES,
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(name, kind if type_ == "conv" else kinds[type_]) for name, type_ in (f.split(" ", 1) for f in re.split(r", (?=\w+ )(?![^<]*>)", schema))])


class _Pieces:
    """Cuts the sorted rows of a task into pieces; a conversation that lies within the task and in one piece is done."""

    def __init__(self, t: Tables, lines: bool, schema: pa.Schema):
        self.t, self.lines, self.schema = t, lines, schema
        self.out: list[dict] = []
        self.place = TaskContext.get().partitionId() << 32
        self.conv, self.any, self.open = None, False, True  # the first conversation may have begun in an earlier task
        self.clear()

    def clear(self) -> None:
        self.turns, self.roles, self.texts, self.bytes = [], [], [], 0

    def flush(self, done: bool) -> None:
        row = {"conv_id": self.conv, "place": self.place, "open": self.open or not done}
        self.place += 1
        if row["open"]:
            self.open = True
            key = [hashlib.blake2b(f"{len(r)}:{r}{x}".encode("utf-8", "surrogatepass"), digest_size=16).digest() for r, x in zip(self.roles, self.texts, strict=True)]
            row |= {"turns": self.turns, "roles": self.roles, "texts": self.texts, "keys": key}
        else:
            faults, seen = [], set()
            for pair in zip(self.roles, self.texts, strict=True):
                fault = _fault(pair[1])
                faults.append("duplicate" if fault != "blank" and pair in seen else fault)
                seen.add(pair)
            symbols = bytes(map(_symbol, self.roles, faults))
            edits, cost = traced(self.t, symbols, trail(self.t, symbols, self.t.end), START, True)
            lines = written(edits, self.roles, self.texts, START)
            c = _counts(self.turns, self.roles, faults)
            row |= {k: c[k] for k in ("blank", "duplicate", "truncated", "illegal")} | {
                "gaps": _gaps(c), "cost": cost, "audit": "".join(edits), "repaired_sha256": hashlib.sha256(_body(lines)).hexdigest()}
            if self.lines:
                row["lines"] = [dict(zip(("edit", "role", "text"), x, strict=True)) for x in lines]
        self.out.append(row)
        self.clear()

    def add(self, conv, turn, role: str, text: str, copies: int) -> None:
        if not self.any or conv != self.conv:
            if self.any:
                self.flush(True)
                self.open = False
            self.conv, self.any = conv, True
        for _ in range(copies):
            if len(self.roles) >= PIECE_ROWS or self.bytes >= PIECE_BYTES:
                self.flush(False)
            self.turns.append(turn)
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(text) + 64

    def batch(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        return pa.RecordBatch.from_pylist(out, self.schema)


PIECES = f"conv_id conv, place long, open boolean, {RESULT}, lines {LINES}, turns array<long>, roles array<string>, texts array<string>, keys array<binary>"


def _sql(schema: str, kind: str) -> str:
    return schema.replace("conv_id conv", f"conv_id {kind}")


def _conv_kind(df: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type
    field = df.schema["conv_id"].dataType
    return field.simpleString(), to_arrow_type(field)


def _pieces(rows: DataFrame, lines: bool) -> DataFrame:
    """The pieces of all conversations, in the order of place; those not open are finished."""
    sql, kind = _conv_kind(rows)
    t, schema = Tables(), _arrow(PIECES, kind)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64), F.md5(F.col("text").cast("binary"))]
    keyed = rows.withColumn("salt", F.monotonically_increasing_id())

    def run(batches):
        pieces = _Pieces(t, lines, schema)
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies")), strict=True):
                pieces.add(*row)
            if len(pieces.out) >= 256:
                yield pieces.batch()
        if pieces.any:  # the last conversation may go on in the next task
            pieces.open = True
            pieces.flush(False)
        if pieces.out:
            yield pieces.batch()

    ranged = keyed.repartitionByRange(*order, F.col("salt").asc()).sortWithinPartitions(*order, "salt")
    return saved(ranged.select("conv_id", "turn", "role", "text", "copies").mapInArrow(run, _sql(PIECES, sql)), "conversation_pieces")


def _symbols(pieces: DataFrame) -> DataFrame:
    """(place, conv_id, seq, last, symbols, counts): open pieces with the faults of their rows."""
    sql, kind = _conv_kind(pieces)
    by_conv = Window.partitionBy("conv_id").orderBy("place")
    placed = pieces.select("conv_id", "place", F.row_number().over(by_conv).cast("long").alias("seq"),
                           F.lead("place").over(by_conv).isNull().alias("last"))
    key = pieces.select("conv_id", "place", F.posexplode("keys").alias("at", "key"))
    first = key.groupBy("conv_id", "key").agg(F.min(F.struct("place", "at")).alias("first")) \
        .groupBy(F.col("first.place").alias("place")).agg(F.collect_list(F.col("first.at").cast("long")).alias("firsts"))
    rows = pieces.select("place", "turns", "roles", "texts").join(placed, "place").join(first, "place", "left")
    schema = f"conv_id conv, place long, seq long, last boolean, symbols binary, {COUNTS}"

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for r in b.to_pylist():
            firsts = set(r["firsts"] or ())
            faults = [f if (f := _fault(x)) == "blank" or i in firsts else "duplicate" for i, x in enumerate(r["texts"])]
            out.append({k: r[k] for k in ("conv_id", "place", "seq", "last")} | {"symbols": bytes(map(_symbol, r["roles"], faults))} | _counts(r["turns"], r["roles"], faults))
        return pa.RecordBatch.from_pylist(out, _arrow(schema, kind))
    return saved(map_batches(rows, run, _sql(schema, sql)), "conversation_symbols")


def _converged(symbols: DataFrame) -> DataFrame:
    """(conv_id, place, seq, last, symbols, vectors): the trails of all pieces, each from its right neighbour's first vector."""
    sql, kind = _conv_kind(symbols)
    t = Tables()
    schema = "conv_id conv, place long, seq long, last boolean, symbols binary, vectors binary, start int, changed boolean"
    names = [f.name for f in _arrow(schema, kind)]

    def guess(b: pa.RecordBatch) -> pa.RecordBatch:
        out = b.to_pylist()
        for r in out:
            r["vectors"] = trail(t, r["symbols"], t.end if r["last"] else t.guess)
            r |= {"start": r["vectors"][0], "changed": True}
        return pa.RecordBatch.from_pylist(out, _arrow(schema, kind))

    def fix_up(batches):
        after = None  # the piece to the right: conversation, group, number, first vector
        for b in batches:
            out = b.to_pylist()
            for r in out:
                at_end = after[3] if after is not None and after[:3] == (r["conv_id"], r["part"], r["seq"] + 1) else r["right"]
                r["changed"] = False
                if not r["last"] and at_end != r["vectors"][-1]:
                    r["vectors"], r["changed"] = trail(t, r["symbols"], at_end, r["vectors"]), True
                    r["start"] = r["vectors"][0]
                after = (r["conv_id"], r["part"], r["seq"], r["start"])
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in out], _arrow(schema, kind))

    now = saved(map_batches(symbols.select("conv_id", "place", "seq", "last", "symbols"), guess, _sql(schema, sql)), "conversation_trails")
    reach = 1
    while not now.filter("not last and changed").isEmpty():
        reach *= PASS_GROWTH
        right = now.select(F.col("conv_id").alias("conv"), (F.col("seq") - 1).alias("of"), F.col("start").alias("right"))
        rows = now.join(right, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("seq") == F.col("of")), "left").drop("conv", "of") \
            .withColumn("part", F.expr(f"(seq - 1) div {reach}"))
        rows = rows.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", F.desc("seq"))
        after = saved(rows.mapInArrow(fix_up, _sql(schema, sql)), "conversation_trails")
        drop_saved(now)
        now = after
    return now


def _entries(trails: DataFrame) -> DataFrame:
    """(place, entry): the state ahead of each piece, from the states that the pieces before it lead to."""
    t = Tables()
    sql, kind = _conv_kind(trails)
    schema = "conv_id conv, place long, seq long, maps binary"

    def maps(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{k: r[k] for k in ("conv_id", "place", "seq")} | {"maps": exits(t, r["symbols"], r["vectors"])} for r in b.to_pylist()], _arrow(schema, kind))

    def run(batches):
        state = START
        for b in batches:
            entry = []
            for seq, exit_ in zip(b.column("seq").to_pylist(), b.column("maps").to_pylist(), strict=True):
                entry.append(state if seq > 1 else START)
                state = exit_[entry[-1]]
            yield pa.RecordBatch.from_arrays([b.column("place"), pa.array(entry, pa.int32())], ["place", "entry"])

    rows = map_batches(trails.select("conv_id", "place", "seq", "symbols", "vectors"), maps, _sql(schema, sql))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(run, "place long, entry int")


TRACED = f"conv_id conv, place long, seq long, last boolean, {COUNTS}, cost long, audit string, lines {LINES}, body binary, n_lines long"


def _traced(pieces: DataFrame, symbols: DataFrame, lines: bool) -> DataFrame:
    """The open pieces with their edits: bodies for the digest, or the turns themselves."""
    t = Tables()
    sql, kind = _conv_kind(pieces)
    trails = _converged(symbols)
    schema = _arrow(TRACED, kind)
    rows = pieces.select("place", "roles", "texts").join(symbols, "place").join(trails.select("place", "vectors"), "place").join(_entries(trails), "place")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for r in b.to_pylist():
            edits, cost = traced(t, r["symbols"], r["vectors"], r["entry"], r["last"])
            done = written(edits, r["roles"], r["texts"], r["entry"])
            r |= {"cost": cost, "audit": "".join(edits), "n_lines": len(done)}
            r |= {"lines": [dict(zip(("edit", "role", "text"), x, strict=True)) for x in done]} if lines else {"body": _body(done)}
            out.append({f.name: r.get(f.name) for f in schema})
        return pa.RecordBatch.from_pylist(out, schema)
    return saved(map_batches(rows, run, _sql(TRACED, sql)), "conversation_traced")


def _joined(pieces: DataFrame) -> DataFrame:
    """One row for each conversation of several pieces, which come in their order."""
    sql, kind = _conv_kind(pieces)
    schema = f"conv_id conv, {RESULT}"

    def run(batches):
        state: dict | None = None

        def done() -> dict:
            return {"conv_id": state["conv_id"], "gaps": _gaps(state), "audit": "".join(state["parts"]), "repaired_sha256": state["sha"].hexdigest()} | {
                k: state[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")}

        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["seq"] == 1:
                    if state is not None:
                        out.append(done())
                    state = {"conv_id": r["conv_id"], "sha": hashlib.sha256(), "parts": [], "n_lines": 0, "lo": None, "hi": None, "tail": None} | dict.fromkeys(
                        ("distinct", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
                for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
                    state[k] += r[k]
                state["parts"].append(r["audit"])
                if r["n"]:
                    state["illegal"] += state["tail"] is not None and state["tail"] + r["head"] not in LEGAL
                    state["tail"] = r["tail"]
                if r["lo"] is not None:
                    state["distinct"] += r["distinct"] - (state["hi"] == r["lo"])
                    state["lo"] = r["lo"] if state["lo"] is None else state["lo"]
                    state["hi"] = r["hi"]
                if r["n_lines"]:
                    state["sha"].update((b"\n" if state["n_lines"] else b"") + r["body"])
                    state["n_lines"] += r["n_lines"]
            if out:
                yield pa.RecordBatch.from_pylist(out, _arrow(schema, kind))
        if state is not None:
            yield pa.RecordBatch.from_pylist([done()], _arrow(schema, kind))
    rows = pieces.drop("lines").repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return rows.mapInArrow(run, _sql(schema, sql))


RESULT_COLUMNS = ["conv_id", *(f.split()[0] for f in RESULT.split(", "))]


def repairs(rows: DataFrame) -> DataFrame:
    """One row for each conversation of rows (conv_id, turn, role, text, copies): its counts, cost, audit, and the digest
    of the repaired turns as role:text lines."""
    tune(rows.sparkSession)
    pieces = _pieces(rows, False)
    open_ = pieces.filter("open")
    return pieces.filter("not open").select(*RESULT_COLUMNS).unionByName(_joined(_traced(open_, _symbols(open_), False)).select(*RESULT_COLUMNS))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, piece, position, edit, role, text): the repaired turns of each conversation by piece, then position."""
    tune(rows.sparkSession)
    pieces = _pieces(rows, True)
    open_ = pieces.filter("open")
    done = pieces.filter("not open").select("conv_id", F.lit(1).cast("long").alias("piece"), "lines") \
        .unionByName(_traced(open_, _symbols(open_), True).select("conv_id", F.col("seq").alias("piece"), "lines"))
    return done.select("conv_id", "piece", F.posexplode("lines").alias("position", "line")).select("conv_id", "piece", "position", "line.*")


#: The repairs in plain SQL: the best edits of each suffix of a conversation, by state, as (cost, audit, lines).
REPAIR_SQL = r"""
with recursive bits(b, i, c) as (
    select range, 0, range from range(256)
    union all select b, i + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from bits where i < 8),
crc as (select list(c order by b) as t from bits where i = 8),
keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                 list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint) as codes from conversations),
kinds as (select conv_id, turn, role, text,
                 xor(list_reduce(list_prepend(4294967295::bigint, codes), lambda c, x: xor(c >> 8, t[((xor(c, x) & 255) + 1)::bigint])), 4294967295) % 20 as kind from keyed, crc),
rows_ as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
                 case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                 unnest(range(case when kind = 3 then 2 else 1 end)) as copy from kinds where kind <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, left(text, 64), md5(text)) as i from rows_),
judged as (select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank, row_number() over (partition by conv_id, role, text order by i) > 1 as again,
                  regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as mark, left(role, 1) as r,
                  lag(left(role, 1)) over (partition by conv_id order by i) as before from placed),
f as (select conv_id, turn, role, text, i, r, blank or again as gone, blank, again and not blank as duplicate,
             not blank and not again and mark not in ('.', '!', '?') as truncated, before is not null and before || r not in ('su', 'ua', 'au') as illegal from judged),
sums as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (blank) as blank,
                count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated, count(*) filter (illegal) as illegal from f group by conv_id),
best(conv_id, i, z, s, u, a) as (
    select conv_id, n, {'c': 0::bigint, 'e': '', 't': ''}, {'c': 6::bigint, 'e': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)},
           {'c': 3::bigint, 'e': 'I', 't': 'assistant:' || chr(10)}, {'c': 0::bigint, 'e': '', 't': ''} from sums
    union all
    select conv_id, i, list_min([z, {'c': u2.c + 3, 'e': 'I' || u2.e, 't': 'user:' || chr(10) || u2.t}]), list_min([s, {'c': u2.c + 3, 'e': 'I' || u2.e, 't': 'user:' || chr(10) || u2.t}]), u2,
           list_min([a, {'c': u.c + 3, 'e': 'I' || u.e, 't': 'user:' || chr(10) || u.t}]) from (
        select *, list_min([u, {'c': a.c + 3, 'e': 'I' || a.e, 't': 'assistant:' || chr(10) || a.t}]) as u2 from (
            select conv_id, i - 1 as i,
                   list_min([dz, case when not gone and r = 's' then {'c': s.c + x, 'e': 'K' || s.e, 't': line || s.t} end, case when not gone and r = 'u' then ku end, ru]) as z,
                   list_min([ds, case when not gone and r = 'u' then ku end, ru]) as s,
                   list_min([du, case when not gone and r = 'a' then {'c': a.c + x, 'e': 'K' || a.e, 't': line || a.t} end, case when not gone then {'c': a.c + 3 + x, 'e': 'R' || a.e, 't': 'assistant:' || text || chr(10) || a.t} end]) as u,
                   list_min([da, case when not gone and r = 'u' then ku end, ru]) as a from (
                select b.conv_id, b.i, b.z, b.s, b.u, b.a, f.gone, f.r, f.text, f.role || ':' || f.text || chr(10) as line, 3 * f.truncated::int as x,
                       {'c': b.z.c + 4, 'e': 'D' || b.z.e, 't': b.z.t} as dz, {'c': b.s.c + 4, 'e': 'D' || b.s.e, 't': b.s.t} as ds,
                       {'c': b.u.c + 4, 'e': 'D' || b.u.e, 't': b.u.t} as du, {'c': b.a.c + 4, 'e': 'D' || b.a.e, 't': b.a.t} as da,
                       {'c': b.u.c + 3 * f.truncated::int, 'e': 'K' || b.u.e, 't': f.role || ':' || f.text || chr(10) || b.u.t} as ku,
                       case when not f.gone then {'c': b.u.c + 3 + 3 * f.truncated::int, 'e': 'R' || b.u.e, 't': 'user:' || f.text || chr(10) || b.u.t} end as ru
                from best b join f on f.conv_id is not distinct from b.conv_id and f.i = b.i)))),
ids as (select distinct conv_id from conversations)
select ids.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(b.z.c, 0) as cost, coalesce(b.z.e, '') as audit, sha256(coalesce(left(b.z.t, length(b.z.t) - 1), '')) as repaired_sha256
from ids left join sums on sums.conv_id is not distinct from ids.conv_id
left join best b on b.conv_id is not distinct from ids.conv_id and b.i = 0
"""
