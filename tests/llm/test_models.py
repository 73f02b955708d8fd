"""Learnt operators: held-out accuracy on the given tables, plain recomputation of scores, awkward input."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from orderloom.llm import html_blocks, quality_model, toxicity
from orderloom.llm.common import sigmoid
from tests.llm.fixtures import documents, empty

SF = "/root/testdata/sf0.1"


def held_out_rows(spark, operator, label: str, folds: int, fold: int):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    got = operator(spark, docs, labels)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    return [(r["score"], r["predicted"], r[label]) for r in rows if r["held_out"]]


def test_quality_on_held_out(spark):
    rows = held_out_rows(spark, quality_model.quality, "quality", 5, 0)
    assert np.mean([p == y for _, p, y in rows]) > 0.97
    assert all(p == 1 for _, p, y in rows if y == 1)


def test_toxicity_on_held_out(spark):
    rows = held_out_rows(spark, toxicity.toxicity, "toxic", 4, 2)
    assert np.mean([p == y for _, p, y in rows]) > 0.97
    assert np.mean([p for _, p, y in rows if y == 0]) < 0.01


@pytest.mark.parametrize(("operator", "untaught"), [(quality_model.quality, 0.5), (toxicity.toxicity, 0.0)])
def test_awkward_documents(spark, operator, untaught):
    docs = documents(spark)
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (7, None, None), (None, 0, 1), (3, 0, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")
    rows = operator(spark, docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (4, 5, 6)}) == 1
    assert operator(spark, empty(spark), labels).count() == 0
    rows = operator(spark, docs, labels.where("false")).collect()
    assert all(abs(r["score"] - untaught) < 1e-9 for r in rows)


def test_held_out_labels_do_not_teach(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr(
        "doc_id",
        "CASE WHEN crc32(cast(doc_id AS string)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality",
        "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic",
    )
    for operator in (quality_model.quality, toxicity.toxicity):
        a, b = ({r["doc_id"]: r["score"] for r in operator(spark, docs, some).collect()} for some in (labels, turned))
        assert a == b


def test_quality_score_is_a_dot_product():
    texts = ["a b b c", "", None, "x y z " * 50]
    weights = np.random.default_rng(1).normal(0, 1, quality_model.DIMENSIONS).astype(np.float32)
    for text, score in zip(texts, quality_model.scores(texts, weights, 0.25), strict=True):
        grams, counts = quality_model.features([text])
        want = weights[grams].sum(dtype=np.float64) / np.sqrt(max(1, counts[0])) + 0.25
        assert abs(score - sigmoid(want)) < 1e-6


def test_machine_learns_pairs():
    """Either word alone is harmless; only the pair is not. A linear model cannot tell."""
    dice = np.random.default_rng(4)
    rows = []
    for _ in range(3000):
        a, b = dice.random(2) < 0.5
        at = [*([10] if a else []), *([20] if b else []), *dice.integers(100, 200, 3)]
        rows.append((np.unique(at).astype(np.int32), int(a and b)))
    machine = toxicity.learn(rows, epochs=6)
    linear = machine.w[[10, 20]]
    pair = machine.v[machine.row[10]] @ machine.v[machine.row[20]]
    assert pair > 0.5 and machine.bias + linear.max() < 0 < machine.bias + linear.sum() + pair


def test_machine_score_is_the_pair_sum():
    machine, dice = toxicity.Machine(), np.random.default_rng(8)
    at = toxicity.terms("alpha beta gamma")
    machine.w[at] = dice.normal(0, 1, len(at))
    machine.row[at], machine.v = np.arange(1, len(at) + 1), dice.normal(0, 1, (len(at) + 1, toxicity.FACTORS)).astype(np.float32)
    machine.v[0] = 0
    v = machine.v[machine.row[at]]
    pairs = sum(v[i] @ v[j] for i in range(len(at)) for j in range(i))
    assert abs(machine.score(["Alpha, BETA gamma! alpha"])[0] - sigmoid(machine.w[at].sum() + pairs)) < 1e-5


PAGE = (
    '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">A</a>'
    "</li></ul></nav><!-- x --><article><h1>Head &amp; line</h1><p><b>One\n  two<br><p>Three &lt;3 <i>x</i>y.</p></article>"
    "<footer>&copy; f</footer></body></html>"
)


def test_blocks_of_a_page():
    read = html_blocks.blocks(PAGE)
    assert [b.text for b in read] == ["T", "A", "Head & line", "One two", "Three <3 xy.", "© f"]
    assert [html_blocks.taught(b) for b in read] == [False, False, True, True, True, False]
    assert html_blocks.blocks(None) == [] == html_blocks.blocks("<p> </p><script>if (a<b) {")
    assert [b.text for b in html_blocks.blocks("plain < text")] == ["plain < text"]


@pytest.mark.parametrize(
    ("put", "more"),
    [
        ('<svg class="i"/>', []), ("<svg/>", []), ('<math display="block" />', []), ("<canvas/>", []), ("<canvas id=c>", []),
        ('<object data="f.swf">', []), ('<svg viewBox="0 0 1 1"><path d="M0 0"/>', []), ("<svg><use href='#a'></svg>", []),
        ("<svg-icon></svg-icon>", []), ("<svg-icon>", []), ("<object-view></object-view>", []), ("<script-box></script-box>", []),
        ("<div><math><mi>x</mi><mo>=</mo><mn>2</mn></math></div>", ["x=2"]), ("<object data='f'><p>In it.</p></object>", ["In it."]),
        ("<svg><text>Drawn</text><style>t{}</style></svg>", ["Drawn"]), ("<svg><foreignObject><p>Set</p></foreignObject></svg>", ["Set"]),
        ("<script>1</script x>", []), ("<STYLE>p{}</style\n>", []), ("<template><p>no</p></template>", []),
    ],
)
def test_blocks_after_elements_with_content_of_their_own(put, more):
    page = f"<body><div><p>One.</p>{put}<p>Two.</p></div><p>Three.</p></body>"
    read = html_blocks.blocks(page)
    assert [b.text for b in read] == ["One.", *more, "Two.", "Three."]
    assert read[-1].path == ("<body", "<p")
    for raw in ("script", "style", "textarea", "iframe", "noscript", "template"):
        assert [b.text for b in html_blocks.blocks(f"<p>One.</p><{raw}><p>Two.</p>")] == ["One."]


def test_main_text_of_pages_with_such_elements(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(60).select("page_id", "url", "html")
    put = ['<svg class="i"/>', "<canvas/>", "<svg-icon></svg-icon>", "<svg><path d='M0 0'/></svg>", '<object data="f">', "<math/>"]
    rows = [(r["page_id"], r["url"], r["html"].replace("<article>", put[k % 6] + "<article>")) for k, r in enumerate(pages.collect())]
    schema = "page_id long, url string, html string"
    model = html_blocks.fit(pages)
    plain = {r["page_id"]: r["text"] for r in html_blocks.main_text(spark, pages, model).collect()}
    got = {r["page_id"]: r["text"] for r in html_blocks.main_text(spark, spark.createDataFrame(rows, schema), model).collect()}
    assert sum(got[k] == text != "" for k, text in plain.items()) >= 0.95 * len(rows)


def test_gradients():
    """Back-propagation through both directions equals differences of the loss."""
    model, dice = html_blocks.Labeller(2), np.random.default_rng(3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    pages = [dice.normal(0, 1, (n, html_blocks.INPUT)) for n in (5, 2)]
    labels = [dice.integers(0, 2, n).astype(float) for n in (5, 2)]

    def loss():
        out, total = model.logits(pages), 0.0
        for k, y in enumerate(labels):
            p = 1 / (1 + np.exp(-out[: len(y), k]))
            total -= (y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
        return total / 7

    out, x, turned, turn, which, live, both, kept0, kept1 = model.logits(pages, learn=True)
    y = np.zeros(out.shape)
    for k, own in enumerate(labels):
        y[: len(own), k] = own
    dout = (1 / (1 + np.exp(-out)) - y) * live / live.sum()
    grads = {k: np.zeros_like(v) for k, v in model.p.items()}
    dboth = dout[:, :, None] * model.p["w"]
    model._backward(0, x, kept0, dboth[:, :, : html_blocks.HIDDEN], grads)
    model._backward(1, turned, kept1, dboth[:, :, html_blocks.HIDDEN :][turn, which], grads)
    for name in ("wx0", "wh0", "b0", "wx1", "wh1", "b1"):
        flat = model.p[name].reshape(-1)
        for at in dice.integers(0, len(flat), 4):
            flat[at] += 1e-2
            up = loss()
            flat[at] -= 2e-2
            down = loss()
            flat[at] += 1e-2
            assert abs((up - down) / 2e-2 - grads[name].reshape(-1)[at]) < 2e-3


def test_main_text(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    extra = spark.createDataFrame([(-1, None, None), (-2, "u", ""), (None, "u", PAGE), (-3, "u", PAGE), (-3, "u", PAGE)], "page_id long, url string, html string")
    rows = html_blocks.main_text(spark, pages.unionByName(extra)).collect()
    assert len(rows) == pages.count() + 5
    got = {r["page_id"]: r for r in rows}
    assert got[-1]["text"] == got[-2]["text"] == "" and got[-1]["n_chars"] == 0
    assert got[-3]["text"] == got[None]["text"] == "Head & line\nOne two\nThree <3 xy."
    right = 0
    for r in pages.collect():
        body = r["html"].split("<article>")[1].split("</article>")[0]
        want = "\n".join(b.text for b in html_blocks.blocks(f"<body><article>{body}</article>"))
        right += got[r["page_id"]]["text"] == want
    assert right >= 0.98 * pages.count()
    assert html_blocks.main_text(spark, pages.where("false")).count() == 0
