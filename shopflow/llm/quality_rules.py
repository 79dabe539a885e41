"""Quality rules: text statistics, and decision lists learned from labelled statistics by sequential covering.

Each rule is a conjunction of thresholds on statistics.  From every statistic one is grown on two thirds of the labelled
rows by FOIL's gain and pruned on the rest, where rejecting clean rows costs most; the best is kept if it is precise
enough, the rows that it covers leave, and the next rule is learned.
The list becomes one ordered Spark conditional expression.

Defined cases.  Null, empty or blank text has no words and zero statistics; it fails the base rule (too few words).
Labels without doc_id or quality, and labels of unknown documents, are not learned from; without labels the list is
empty and only the base rule rejects.  Repeated rows are judged alike.  Other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BYTE_KEYS, IS_SPACE, PLACE_KEYS, mixed, tune, utf8, word_hashes, word_spans

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHARES = ("symbol_share", "dup_line_share", "repeat_share", "mean_word", "upper_share", "digit_share", "comma_stop_share",
          "mark_share", "mean_line_words", "lone_share", "short_share", "long_share")
#: Labelled rows to learn from at most, those of least hash.
MAX_LABELLED = 8000
#: A rule stays if so much of what it covers among the pruning rows is of low quality.
MIN_PRECISION = 0.97
#: Rows of high quality that a rule rejects weigh so many times as much as those of low quality.
COST = 20
MAX_RULES = 12
MAX_CONDITIONS = 4


def _is(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


SYMBOL, MARK, STOP, DIGIT = _is("#*$%&|<>"), _is("!?"), _is(",.;:"), _is("0123456789")
UPPER = _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: ASCII characters that are no letters or digits: a word of one such character stands alone.
ODD = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def text_stats(col: pa.Array) -> pa.Array:
    """The counts and shares of each text."""
    data, offsets = utf8(col)
    n = len(offsets) - 1

    def per_row(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    start, end, row = word_spans(data, offsets)
    n_words = np.bincount(row, minlength=n)
    word_chars = per_row(~IS_SPACE[data] & ((data & 0xC0) != 0x80))
    hashes = word_hashes(data, start, end, BYTE_KEYS)
    row_key = mixed(row.astype(np.uint64) + np.uint64(1))

    # words inside 3-word windows that the text has twice or more
    m = max(0, len(hashes) - 2)
    window = hashes[:m] * PLACE_KEYS[0] + hashes[1:m + 1] * PLACE_KEYS[1] + hashes[2:m + 2] * PLACE_KEYS[2]
    inside = np.flatnonzero(row[:m] == row[2:m + 2])
    key = mixed(window[inside]) ^ row_key[inside]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for p in range(3):
        covered[inside[again] + p] = True

    # lines that hold a word
    edges = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, offsets]))
    line = np.searchsorted(edges, start, side="right") - 1
    first = np.ones(len(start), bool)
    first[1:] = line[1:] != line[:-1]
    line, line_row = line[first], row[first]
    stop = edges[line + 1] if len(line) else line
    stop = stop - (data[stop - 1] == 10)
    n_lines = np.bincount(line_row, minlength=n)
    n_dup = n_lines
    if len(line):
        key = word_hashes(data, edges[line], stop, BYTE_KEYS) ^ row_key[first]
        n_dup = n_lines - np.bincount(line_row[np.unique(key, return_index=True)[1]], minlength=n)

    # shares that don't drift with the length of a text: a long one repeats more of its words
    lens = end - start
    safe = lambda a, b: a / np.maximum(b, 1)
    n_symbols, n_repeat = per_row(SYMBOL[data]), np.bincount(row[covered], minlength=n)
    columns = dict(zip(COUNTS, (n_words, word_chars, n_symbols, n_dup, n_repeat), strict=True))
    columns |= dict(zip(SHARES, (
        safe(n_symbols, word_chars), safe(n_dup, n_lines), safe(n_repeat, n_words), safe(word_chars, n_words),
        safe(per_row(UPPER[data]), word_chars), safe(per_row(DIGIT[data]), word_chars), safe(per_row(STOP[data]), n_words),
        safe(per_row(MARK[data]), n_words), safe(n_words, n_lines), safe(np.bincount(row[(lens == 1) & ODD[data[start]]], minlength=n), n_words),
        safe(np.bincount(row[lens <= 2], minlength=n), n_words), safe(np.bincount(row[lens > 15], minlength=n), n_words)), strict=True))
    return pa.StructArray.from_arrays(
        [pa.array(columns[c].astype(np.int64)) for c in COUNTS] + [pa.array(columns[c].astype(np.float64)) for c in SHARES], COUNTS + SHARES)


STATS = "struct<" + ", ".join([f"{c}: bigint" for c in COUNTS] + [f"{c}: double" for c in SHARES]) + ">"


def stats_of(text: Column) -> Column:
    return F.arrow_udf(text_stats, STATS)(text)


Rule = list[tuple[str, str, float]]


def learn_rules(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...] = SHARES) -> list[Rule]:
    """Rules for the bad rows, in order.  x: a row of statistics for each label."""
    grow = np.arange(len(bad)) % 3 > 0
    left, rules = np.ones(len(bad), bool), []

    def covers(rule: Rule) -> np.ndarray:
        hit = np.ones(len(bad), bool)
        for name, op, cut in rule:
            v = x[:, names.index(name)]
            hit &= v >= cut if op == ">=" else v <= cut
        return hit

    def conditions(hit: np.ndarray) -> list[tuple[float, tuple[str, str, float]]]:
        """FOIL's gain of the best cut of each statistic in each direction."""
        p0, out = (hit & bad).sum(), []
        for f, name in enumerate(names):
            order = np.argsort(x[hit, f], kind="stable")
            v, y = x[hit, f][order], bad[hit][order]
            edge = np.flatnonzero(v[1:] > v[:-1])  # a cut between i and i + 1
            low = np.cumsum(y)[edge]
            for op, p, k in (("<=", low, edge + 1), (">=", p0 - low, len(v) - edge - 1)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / k) - np.log2(p0 / hit.sum())), 0)
                if len(gain) and gain.max() > 1e-9:
                    i = int(gain.argmax())
                    out.append((float(gain.max()), (name, op, float((v[edge[i]] + v[edge[i] + 1]) / 2))))
        return out

    def worth(rule: Rule) -> tuple[float, int, int]:
        """Clean rows that a rule takes weigh COST times; counted on the rows not grown on."""
        held = left & ~grow & covers(rule)
        p, n = int((held & bad).sum()), int((held & ~bad).sum())
        return p - COST * n, p, n

    while len(rules) < MAX_RULES and (left & grow & bad).sum() >= 5:
        best: tuple = (0.0, 0, [])
        for _, start in conditions(left & grow):  # grow a rule from each statistic
            rule: Rule = [start]
            hit = left & grow & covers(rule)
            while len(rule) < MAX_CONDITIONS and (hit & ~bad).any() and (hit & bad).any() and (more := conditions(hit)):
                rule.append(max(more)[1])
                hit = left & grow & covers(rule)
            for k in range(1, len(rule) + 1):  # prune: the prefix that does best
                score, p, n = worth(rule[:k])
                if p >= 2 and p >= MIN_PRECISION * (p + n) and (score, -k) > best[:2]:
                    best = (score, -k, rule[:k])
        if not best[2]:
            break
        rules.append(best[2])
        left &= ~covers(best[2])
    return rules


def labelled_stats(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and low-quality flags of at most max_labelled labelled rows, in the order of a hash of doc_id."""
    known = labels.filter("doc_id is not null and quality is not null").select(F.col("doc_id").alias("label_id"), "quality") \
        .orderBy(F.xxhash64("label_id"), "label_id", "quality").limit(max_labelled)
    rows = docs.join(F.broadcast(known), F.col("doc_id") == F.col("label_id")) \
        .select("label_id", "quality", stats_of(F.col("text")).alias("s")).select("label_id", "quality", *[f"s.{c}" for c in SHARES]).toArrow()
    order = np.argsort(mixed(rows.column("label_id").to_numpy().astype(np.uint64)), kind="stable")
    x = np.stack([rows.column(c).to_numpy()[order] for c in SHARES], 1) if len(order) else np.zeros((0, len(SHARES)))
    return x, rows.column("quality").to_numpy()[order] == 0


def rule_of(stats: str, rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    out = F.lit(0)
    for i in range(len(rules), 0, -1):
        hit = F.lit(True)
        for name, op, cut in rules[i - 1]:
            hit = hit & (F.col(f"{stats}.{name}") >= cut if op == ">=" else F.col(f"{stats}.{name}") <= cut)
        out = F.when(hit, i).otherwise(out)
    return out


def judged(docs: DataFrame, labels: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """docs with a struct column __quality: the counts, base_failed, rule (0: none) and kept."""
    tune(docs.sparkSession)
    if rules is None:
        rules = learn_rules(*labelled_stats(docs.select("doc_id", "text"), labels))
    s = "__stats"
    failed = F.expr(f"{s}.n_words < 50 or 100 * {s}.n_repeat_words > 50 * {s}.n_words")
    return docs.withColumn(s, stats_of(F.col("text"))).withColumn("__quality", F.struct(
        *[F.col(f"{s}.{c}") for c in COUNTS], failed.alias("base_failed"), rule_of(s, rules).alias("rule"),
        (~failed & (rule_of(s, rules) == 0)).alias("kept"))).drop(s)
