"""Pages without blocks, with stray quotes, and very deep or long ones."""

from __future__ import annotations

import time

import numpy as np
import pytest

from orderloom.llm import html_blocks as hb


def texts(page: str | None) -> list[str]:
    return [b.text for b in hb.blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>One.</p><p title=it's>Two.</p><p>Three don't.</p><p>Four.</p>", ["One.", "Two.", "Three don't.", "Four."]),
        ('<p>One <a href="x"">two</a> three.</p><p>Four.</p>', ["One two three.", "Four."]),
        ('<p title="a > b">One.</p><p title=\'<p>\'>Two.</p>', ["One.", "Two."]),
        ('<p title = "a > b" x=y z>One.</p>', ["One."]),
        ('<p "">One.</p><p \'>Two.</p>', ["One.", "Two."]),
        ('<p title="open>One.</p><p>Two.</p>', ["One.", "Two."]),
        ("<p>a <b and c</p>", ["a"]),
        ("<p>One.</p> 1 < 2 <not closed", ["One.", "1 < 2 <not closed"]),
        ("<p>One.</p><script>if (a > b) { x", ["One."]),
        ("<p>One.</p><!-- two <p>three</p>", ["One."]),
        ("<p>One.</p><!-- two --> three", ["One.", "three"]),
    ],
)
def test_tags_and_quotes(page, want):
    assert texts(page) == want


def test_deep_pages_take_time_in_proportion():
    n, took = 20_000, []
    for page in ("<div class=x>" * n + "<p>t</p>" * n, "<b>" * n + "<p>t</p>" * n, "<a '" * n + ">", "<svg><g>" * n + "<p>t",
                 "<div>" * n + "</p></x>" * n, '<a x="' * n + ">", "<p>t</p>" * n + "<a " * n):
        start = time.process_time()
        own = hb.blocks(page)
        assert len(hb.vectors(own)) == len(own)
        took.append(time.process_time() - start)
    assert max(took) < 5, took


def test_a_path_is_summed_over_its_elements():
    page = '<body><div class="main text"><p>One <b>two</b></p><ul id=menu><li>three</li></ul></div></body>'
    own = hb.blocks(page)
    assert [b.path for b in own] == [
        ("<body", "<div", "main", "text", "<p"), ("<body", "<div", "main", "text", "<ul", "menu", "<li"),
    ]
    assert [hb.taught(b) for b in own] == [True, False]
    assert np.allclose(hb.vectors(own), hb.vectors(own, [b.path for b in own]))
    assert hb.vectors([]).shape == (0, hb.INPUT)


def test_long_pages_are_read_in_parts(monkeypatch):
    made = np.random.default_rng(1)
    pages = [made.normal(size=(n, hb.INPUT)).astype(np.float32) for n in (50, 7, 64)]
    model = hb.Labeller()
    whole = model.probabilities(pages)
    monkeypatch.setattr(hb, "STEPS", 8)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(whole, model.probabilities(pages), strict=True))


def test_pages_without_blocks(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<script>x</script>"), (4, "u", "<p> </p>"), (None, None, None)]
    for some in (rows, rows[:1]):
        got = hb.main_text(spark, spark.createDataFrame(some, schema)).collect()
        assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == sorted((r[0] or 0, "", 0) for r in some)
