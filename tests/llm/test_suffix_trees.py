"""Repeated passages against brute force over all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from orderloom.llm import suffix_trees as st
from tests.llm.fixtures import documents, empty, pairs


def brute(docs: list[tuple[int | None, str | None]]) -> list[tuple]:
    """doc_id, n_words, n_removed, kept text of every row."""
    texts = [(doc, st.WORD.findall(text or "")) for doc, text in docs]
    least: dict[tuple, int] = {}
    for doc, words in texts:
        for at in range(len(words) - 49 if doc is not None else 0):
            window = tuple(words[at : at + 50])
            least[window] = min(doc, least.get(window, doc))
    out = []
    for doc, words in texts:
        gone = set()
        for at in range(len(words) - 49 if doc is not None else 0):
            if least[tuple(words[at : at + 50])] < doc:
                gone.update(range(at, at + 50))
        out.append((doc, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def corpus(seed: int) -> list[tuple[int, str]]:
    """Strangers, copies, near copies, shared passages of 49 to 120 words, periodic texts; ids in no order."""
    dice = random.Random(seed)

    def prose(n: int, most: int = 4000) -> list[str]:
        return [f"w{dice.randint(0, most)}" for _ in range(n)]

    passages = [prose(n) for n in (49, 50, 51, 77, 120)]
    texts = [prose(dice.randint(0, 300)) for _ in range(12)]
    for _ in range(30):
        own = prose(dice.randint(0, 90))
        for _ in range(dice.randint(1, 3)):
            at = dice.randint(0, len(own))
            own[at:at] = dice.choice(passages)
        texts.append(own)
    for _ in range(12):
        own = list(dice.choice(texts))
        if own and dice.random() < 0.7:
            own[dice.randrange(len(own))] = "changed"
        texts.append(own)
    texts += [["na"] * n for n in (49, 50, 51, 130)] + [["a", "b", "c"] * 40, ["b", "c", "a"] * 40, prose(400, 2)]
    dice.shuffle(texts)
    joints = (" ", "\n", "\t ", "  ")
    return [(7 * k - 100, "".join(w + dice.choice(joints) for w in own)) for k, own in enumerate(texts)]


def rows(got) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got.collect()), key=str)


def hashed(out: list[tuple]) -> list[tuple]:
    return sorted(((*row[:3], hashlib.sha256(row[3].encode()).hexdigest()) for row in out), key=str)


@pytest.mark.parametrize("most", [1, 5, st.MOST])
def test_passages(spark, monkeypatch, most):
    monkeypatch.setattr(st, "MOST", most)  # groups in many parts, in some, in one
    docs = corpus(most)
    found = st.repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    assert rows(found.digest()) == hashed(brute(docs))
    texts = sorted(((r["doc_id"], r["text"]) for r in found.texts().collect()), key=str)
    assert texts == sorted(((row[0], row[3]) for row in brute(docs)), key=str)
    assert any(0 < row[2] < row[1] for row in brute(docs))


def test_awkward_rows(spark):
    docs = documents(spark)
    long = " ".join(f"t{k}" for k in range(70))
    more = spark.createDataFrame(
        [(300, long), (300, long), (301, long.replace(" ", "\n")), (None, long), (None, long), (-5, "x " + long), (300, "y " + long)],
        "doc_id long, text string",
    )
    docs = docs.unionByName(more, allowMissingColumns=True)
    assert rows(st.repeats(docs).digest()) == hashed(brute(pairs(docs)))
    assert st.repeats(empty(spark)).digest().collect() == []


def test_half_of_all_rows_in_one_group(spark):
    shared = " ".join(f"s{k}" for k in range(60))
    docs = [(k, (f"a{k} b{k} " + shared) if k % 2 else " ".join(f"u{k}x{j}" for j in range(60))) for k in range(3000)]
    assert rows(st.repeats(spark.createDataFrame(docs, "doc_id long, text string")).digest()) == hashed(brute(docs))


def test_words_of_long_texts_are_cut_in_pieces(monkeypatch):
    text = " ".join(f"word{k}" * (k % 5 + 1) for k in range(500)) + "\n"
    whole = st.WORD.findall(text)
    monkeypatch.setattr(st, "PIECE", 64)
    assert [word for part in st.word_lists(text) for word in part] == whole
    assert list(st.word_lists("")) == list(st.word_lists(None)) == []


def test_equal_windows_have_equal_anchors():
    dice = np.random.default_rng(5)
    words = dice.integers(0, 3, 400).astype(np.uint64)
    grams, place = st.anchors(words)
    assert len(place) == len(words) - 49
    for at, own in enumerate(place):
        span = grams[at : at + 43]
        assert own == at + 42 - int(np.argmin(span[::-1]))


def test_deep_nodes_are_equal_windows():
    words = np.random.default_rng(6).integers(0, 2, 300).astype(np.uint64)
    words[200:290] = words[10:100]
    starts = np.arange(251)
    order, nodes = st.deep_nodes(words, starts)
    windows = [tuple(words[k : k + 50].tolist()) for k in starts]
    assert [windows[k] for k in order] == sorted(windows)
    assert len(nodes) == len(set(windows))
