"""HTML extraction, toxicity, language: exact reading where it is defined, held-out accuracy where it is learned."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopflow.llm import html_extract, langid, toxicity
from shopflow.llm.queries import QUERIES
from shopflow.llm.textcnn import ConvNet

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def field():
    return html_extract.trained()


def test_blocks_are_read_as_defined():
    read = lambda page: [b.text for b in html_extract.blocks_of(page)]
    assert read("") == [] and read("no tags &amp;amp; at all") == ["no tags &amp; at all"]
    assert read("<p>a <b>b</b>c<br>d&nbsp;\n e<p>f</div>g") == ["a bc d e", "f", "g"]
    assert read('<head><title>t</title></head><body><script>var x="</p><p>no";</script>a<!-- <p>no</p> --><style>p{}</style><p title="a>b">c</p') == ["a", "c"]
    assert read("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>1 < 2 & 3 > 2") == ["a", "b", "c", "d", "1 < 2 & 3 > 2"]
    assert read("<p><b>x<br><p>y</p>") == ["x", "y"]
    assert len(html_extract.blocks_of("<div>" * 20_000 + "x" + "</p>" * 20_000)) == 1
    assert len(read("<a " * 20_000 + "x")) <= 1 and len(read("<p>word " * 5000)) == 5000


def test_gradient_of_the_field_is_right():
    """A chain's likelihood, by enumeration of all labellings."""
    pages = html_extract.labelled_pages(6, seed=1)
    field = html_extract.fit(pages, steps=40)
    read = [b for b in map(html_extract.blocks_of, pages) if 1 < len(b) <= 12][:2] or [html_extract.blocks_of(pages[0])[:8]]
    for blocks in read:
        scores = [field.node[f].sum(axis=0) for f in html_extract.features(blocks)]

        def total(y, scores=scores, blocks=blocks):
            return sum(s[k] for s, k in zip(scores, y, strict=True)) + sum(
                field.edge[int(blocks[i].parent == blocks[i - 1].parent)][y[i - 1]][y[i]] for i in range(1, len(y)))
        every = [tuple((m >> i) & 1 for i in range(len(blocks))) for m in range(2 ** len(blocks))]
        assert np.isclose(total(field.decode(blocks)), max(map(total, every)))


def test_unseen_pages(field):
    right = whole = n = 0
    pages = html_extract.labelled_pages(200, seed=1234)
    for page in pages:
        blocks = html_extract.blocks_of(page)
        hits = sum(b.main == y for b, y in zip(blocks, field.decode(blocks), strict=True))
        right, n, whole = right + hits, n + len(blocks), whole + (hits == len(blocks))
    assert right / n > 0.97 and whole / len(pages) > 0.8


def test_pages_without_content(spark, field):
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<html></html>"), (4, "u", "<nav><a href='/'>a</a></nav>"), (5, "u", "<article><p>" + "Long text of words, it is. " * 20 + "</p></article>"), (5, None, "<p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted((r["page_id"], r["main"] is not None, bool(r["main"])) for r in df.withColumn("main", html_extract.main_text(F.col("html"), field)).collect())
    assert got == [(1, True, False), (2, True, False), (3, True, False), (4, True, False), (5, True, False), (5, True, True)]


def test_net_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = ConvNet(20, 3, 2, (1, 2), rate=1.0, seed=1, scale=0.5)
    ids, first, lens = rng.integers(0, 20, (2, 40)), np.array([0, 15]), np.array([12, 20])
    ids[:, 12:15] = ids[:, 35:] = 20
    y, w = np.array([1.0, 0.0]), np.ones(2)

    def loss():
        z = net.logits(ids, first, lens)
        return float(np.mean(np.log1p(np.exp(-(2 * y - 1) * z))) + 0.5e-4 * (net.p["out"] ** 2).sum())
    before = {k: v.copy() for k, v in net.p.items()}
    for v in net.squares.values():
        v[:] = 1e12  # steps so small that they are the gradient
    net.rate = 1e6
    start = loss()
    net.step(ids, first, lens, y, w)
    step = {k: net.p[k] - before[k] for k in before}
    net.p = before
    for name in ("out", "filter1", "filter2", "embed", "start2"):
        at = np.unravel_index(np.abs(step[name]).argmax(), step[name].shape)
        net.p[name][at] += 1e-2
        assert np.isclose((loss() - start) / 1e-2, -step[name][at], rtol=0.15, atol=1e-3), name
        net.p[name][at] -= 1e-2


def _plain_step(net, ids, first, lens, y, weight):
    """One Adagrad step, place by place; of equal places the first one wins."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["out"] += 1e-4 * p["out"]
    for i in range(len(y)):
        won = []
        for j, w in enumerate(net.widths):
            conv = np.array([sum(p["embed"][ids[:, a + k]].sum(axis=0) @ p[f"filter{w}"][k] for k in range(w)) for a in range(first[i], first[i] + lens[i])])
            won += [(j * net.filters + f, w, f, first[i] + int(conv[:, f].argmax()), conv[:, f].max() + p[f"start{w}"][f]) for f in range(net.filters)]
        z = sum(max(v, 0) * p["out"][at] for at, _, _, _, v in won) + p["bias"][0]
        d = weight[i] * (1 / (1 + np.exp(-z)) - y[i]) / len(y)
        grad["bias"] += d
        for at, w, f, place, v in won:
            if v > 0:
                grad["out"][at] += v * d
                back = d * p["out"][at]
                grad[f"start{w}"][f] += back
                for k in range(w):
                    grad[f"filter{w}"][k, :, f] += p["embed"][ids[:, place + k]].sum(axis=0) * back
                    for kind in ids[:, place + k]:
                        grad["embed"][kind] += back * p[f"filter{w}"][k, :, f] * (kind != net.pad)
    return {k: p[k] - net.rate * grad[k] / np.sqrt(net.squares[k] + grad[k] ** 2) for k in p}


@pytest.mark.parametrize("kinds", [1, 2])
def test_a_step_is_that_of_a_plain_one(kinds):
    rng = np.random.default_rng(3)
    net = ConvNet(30, 4, 3, (2, 3, 5), rate=0.1, seed=2, scale=0.5)
    lens = np.array([12, 1, 40, 3, 25])
    first = np.cumsum(lens + 5) - lens - 5
    ids = np.full((kinds, int((lens + 5).sum())), 30)
    for a, n in zip(first, lens, strict=True):
        ids[:, a:a + n] = rng.integers(0, 30, (kinds, n))
    ids[:, first[2] + 20:first[2] + 40] = ids[:, first[2]:first[2] + 20]  # equal places
    pick = np.array([2, 0, 4, 3, 1, 2])
    y, weight = np.array([1, 0, 1, 0, 1, 0]), np.linspace(0.5, 1, 6)
    want = _plain_step(net, ids, first[pick], lens[pick], y, weight)
    net.step(ids, first[pick], lens[pick], y, weight)
    for name, v in want.items():
        assert np.allclose(net.p[name], v, rtol=1e-3, atol=1e-4), name


def test_a_step_embeds_each_place_once():
    """What a step costs is in proportion to its places, not to its places times the widest filter."""
    net = ConvNet(512, 8, 10, (2, 3, 5), rate=0.1, seed=1, scale=0.3)
    n, lens = 64, np.full(64, 200)
    ids = np.random.default_rng(0).integers(0, 512, (1, n * 205))
    tracemalloc.start()
    net.step(ids, np.arange(n) * 205, lens, np.arange(n) % 2, np.ones(n))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 256 * n * 205, most


def _labelled(text, n):
    """Toxic texts hold two of the marked words; the last quarter is not trained on."""
    bad = ["vilename", "grubsor", "nastling", "plonker"]
    r = np.random.default_rng(0)
    out = []
    for i in range(n):
        words = text(i, 60).split(" ")
        if i % 4 == 0:
            for _ in range(3):
                words[int(r.integers(0, 60))] = bad[int(r.integers(0, 4))] + ("s" if r.random() < 0.5 else "")
        out.append((" ".join(words), int(i % 4 == 0)))
    return out


def test_toxicity_on_held_out_texts(text):
    rows = _labelled(text, 1200)
    model = toxicity.fit(pa.array([t for t, _ in rows[:900]]), np.array([y for _, y in rows[:900]]))
    score = model.scores(toxicity.Texts(pa.array([t for t, _ in rows[900:]])))
    y = np.array([y for _, y in rows[900:]]) == 1
    assert ((score >= toxicity.DECISION) == y).mean() > 0.95
    long = "fine words " * 50_000
    ends = model.scores(toxicity.Texts(pa.array([long + "vilename grubsor plonkers", long, None, ""])))
    assert ends[0] > ends[1] and ends[2] == ends[3] < toxicity.DECISION


def test_toxicity_frames(make, make_labels, text):
    rows = [(i, t) for i, (t, _) in enumerate(_labelled(text, 60))] + [(None, "x"), (1, None), (2, ""), (2, "")]
    labels = make_labels([(i, 1, int(i % 4 == 0)) for i in range(60)] + [(None, 1, 1), (3, 1, None), (777, 1, 1)])
    got = toxicity.scored(make(rows, clash=True), labels).select("doc_id", "text", "__toxicity", "score").collect()
    assert len(got) == len(rows) and all(0 <= r["__toxicity"] <= 1 and r["score"] == "x" for r in got)
    assert toxicity.scored(make(rows), make_labels([])).filter("__toxicity >= 0.7").count() == 0
    assert toxicity.scored(make([]), labels).count() == 0


def test_toxicity_learns_every_row_whole(make, make_labels, text):
    """One of the words is marked only in texts where it comes after 20,000 characters."""
    long = "fine words " * 2000
    word = lambda i: ("grubsor" if i % 2 else "vilename") if i % 3 == 0 else "harmless"
    docs = make([(i, (long if i % 2 else "") + text(i, 30) + " " + word(i)) for i in range(480)])
    model = toxicity.train(docs, make_labels([(i, 1, int(i % 3 == 0)) for i in range(480)]))
    score = model.scores(toxicity.Texts(pa.array([text(900 + i, 30) + end for i in range(20) for end in (" grubsor", " vilename", " harmless")])))
    assert (score[::3] >= toxicity.DECISION).mean() > 0.9 and (score[1::3] >= toxicity.DECISION).mean() > 0.9
    assert (score[2::3] < toxicity.DECISION).mean() > 0.9


def test_a_step_over_pieces_of_long_sequences_is_the_same_step(monkeypatch):
    r = np.random.default_rng(0)
    lens = np.array([1, 700, 3, 40, 1, 257])
    first = np.cumsum(lens + 3) - lens - 3
    ids = np.full((2, int((lens + 3).sum())), 30)
    for a, n in zip(first, lens, strict=True):
        ids[:, a:a + n] = r.integers(0, 30, (2, n))
    nets = []
    for piece in (200_000, 50, 7):
        monkeypatch.setattr("shopflow.llm.textcnn.PIECE", piece)
        nets.append(ConvNet(30, 4, 3, (1, 2, 3), rate=0.1, seed=2, scale=0.5))
        nets[-1].step(ids, first, lens, np.array([1, 0, 1, 0, 1, 1]), np.ones(6))
    assert all(np.allclose(nets[0].p[k], net.p[k], atol=1e-4) for net in nets[1:] for k in net.p)


def test_recurrent_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b", "c"], seed=2)
    ids, y = rng.integers(0, 256, (9, 5)), rng.integers(0, 3, 5)
    ids[6:, 2] = langid.PAD

    def loss():
        logp, _ = model.labels(ids, model.gates())
        real = ids != langid.PAD
        return float(-(logp[:, y, np.arange(5)] * real).sum() / real.sum())
    grads = model.step(ids, y)
    for name, w in model.weights().items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = loss()
        w[at] = old - 1e-2
        down = loss()
        w[at] = old
        assert np.isclose((up - down) / 2e-2, grads[name][at], rtol=0.1, atol=1e-3), name


def test_languages(spark, make):
    got = QUERIES["op10_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    odd = [(1, None), (2, ""), (3, "123 !? 4"), (None, "words"), (4, "x" * 100_000)]
    for model in (None, langid.Model(["xx", "yy"])):
        out = {r["doc_id"]: r["__language"] for r in langid.identified(make(odd, clash=True), model).collect()}
        assert all(out[i]["lang"] == "und" and out[i]["score"] == 0 for i in (1, 2, 3))
        assert (out[4]["lang"] == "und") == (model is None)
    one = langid.fit(pa.array(["some words", "more"]), np.array(["en", "en"]))
    assert one.predict(pa.array(["anything"]))[0] == ["en"]
    assert langid.identified(make([])).count() == 0


def test_toxicity_query_keeps_every_row(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = QUERIES["op5_toxicity"](spark, SF).collect()
    assert len(rows) == n and all((r["score"] >= 0.7) == bool(r["predicted"]) for r in rows)


def test_page_query_takes_the_article(spark):
    import re
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op1_html_extraction"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["n_chars"] == len(r["text"])
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.DOTALL)[1]
        plain = lambda s: re.sub(r"\s+|&\w+;?|[&'\"<>]", "", s)
        assert plain(r["text"]) == plain(re.sub(r"<[^>]*>", "", inside))


def test_end_tags_reach_over_many_open_elements_and_digits_count_everywhere():
    page = "<article>" + "<font>x<br>" * 100 + "</article><p>after</p><ul><li>" + "<b>" * 100 + "one<li>two</ul>"
    blocks = html_extract.blocks_of(page)
    assert [b.text for b in blocks][1:] == ["after", "one", "two"]
    assert "tag:article" in blocks[0].marks and all("tag:article" not in b.marks for b in blocks[1:])
    assert "tag:b" in blocks[2].marks and "tag:b" not in blocks[3].marks
    late = html_extract.Block("word " * 40 + "7" * 600, 0, frozenset(), 0, 0)
    assert html_extract.FEATURES["digits"] in html_extract.features([late])[0]


def test_a_head_without_end_tag_ends_where_the_text_begins():
    read = lambda page: [b.text for b in html_extract.blocks_of(page)]
    for page in ("<html><head><title>x</title><article><p>One.</p></article>", "<html><head><title>x</title><meta charset=utf-8><link rel=a>One.",
                 "<head><style>p{}</style><script>1</script></head><p>One.", "<head><title>x</title><body><p>One.", "<head> <title>x</title>\n <br>One.",
                 "<head><title>x</title></head>One.", "<html><head><noscript><p>n</p></noscript><base href=x><div>One.</div>"):
        assert read(page) == ["One."], page
