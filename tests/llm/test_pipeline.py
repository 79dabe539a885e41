"""The pipeline's stages, one after the other, against plain restatements on a small corpus."""

import brute
import corpus_pipeline
from shopflow.llm.mixing import SEED

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _written(spark, tmp_path, docs, labels, items):
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", items)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_stages_one_by_one(spark, make, make_labels, make_items, text, tmp_path):
    item = text(800, 30)
    rows = [(i, text(i, 90), "en", f"s{i % 3}", 1) for i in range(40)]
    rows += [(100, text(1, 90) + " end", "en", "s0", 1), (101, text(2, 90), "en", None, 1), (None, text(55, 70), None, "s1", None), (None, text(55, 70), None, "s1", None)]
    rows += [(102, text(60, 60) + " " + item + " " + text(61, 30), "en", "s1", 1), (103, text(62, 80) + " me@x.de", "en", "s2", 1), (104, "too short", "en", "s0", 1), (105, None, None, None, None)]
    sf = _written(spark, tmp_path, make(rows), make_labels([]), make_items([(1, item)]))
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), list(rows)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "pii", "mixing"]
    key = lambda r: str(tuple(r))

    docs = stages["quality_rules"](spark, docs, sf)
    kept = [r for r in kept if not brute.quality(r[1])["base_failed"]]
    assert docs.columns == COLUMNS and sorted(map(key, docs.collect())) == sorted(map(key, kept))
    docs = stages["ngram_jaccard_join"](spark, docs, sf)
    classes = brute.near_classes([(r[0], r[1]) for r in kept])
    kept = list({key(r): r for r, (_, c) in zip(kept, classes, strict=True) if r[0] == c}.values())
    assert docs.columns == COLUMNS and sorted(map(key, docs.collect())) == sorted(map(key, kept))
    docs = stages["benchmark_decontamination"](spark, docs, sf)
    kept = [r for r in kept if item not in r[1]]
    assert docs.columns == COLUMNS and sorted(map(key, docs.collect())) == sorted(map(key, kept))
    docs = stages["pii"](spark, docs, sf)
    kept = [(r[0], t := r[1].replace("me@x.de", "<EMAIL>"), r[2], r[3], len(t)) for r in kept]
    assert docs.columns == COLUMNS and sorted(map(key, docs.collect())) == sorted(map(key, kept))
    last = stages["mixing"](spark, docs, sf).collect()
    taken = brute.mix([(r[0], r[1], r[3]) for r in kept], SEED)
    want = sorted(key((*r, i + 1)) for r, (n, _, _, t) in zip(kept, taken, strict=True) for i in range(t // n if n else 0))
    assert sorted(map(key, last)) == want


def test_empty_tables(spark, make, make_labels, make_items, tmp_path):
    sf = _written(spark, tmp_path, make([]), make_labels([]), make_items([]))
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_run_takes_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == [*COLUMNS, "copy"] and out.count() > 0
