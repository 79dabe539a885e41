"""The registered queries of the operators: against their DuckDB oracles, or a plain restatement, on the smallest tables."""

import math
import zlib

import duckdb
import numpy as np
import pytest

from shopflow.llm import packing
from shopflow.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: float(f"{v:.10g}") if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(columns, want.fetchall())


def test_packing_query_holds_every_id_once(spark):
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(packing.default_tokenizer())
    pieces: dict = {}
    sequences: dict = {}
    for r in QUERIES["op11_sum_of_squares_packing"](spark, SF).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert pieces.keys() == {d["doc_id"] for d in docs}
    for d in docs:
        ids = np.array([*model.encode(d["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(pieces[d["doc_id"]], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding == 0
