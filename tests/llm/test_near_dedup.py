"""Near-duplicate groups against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from orderloom.llm import near_dedup as nd
from tests.llm.fixtures import documents, empty, pairs


def smallest_reachable(docs: list[tuple[int, str | None]]) -> dict[int, int]:
    sets = {}
    for doc, text in docs:
        words = nd.WORD.findall((text or "").translate(nd.LOWER))
        grams = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        sets[doc] = set(grams)
    name = {doc: doc for doc, _ in docs}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                name[max(x, y)] = min(x, y)
    return {doc: root(doc) for doc in ids}


def chains(seed: int) -> list[tuple[int, str]]:
    """Texts changed step by step, so that ends of a chain are linked only over its middle, and strangers."""
    dice, out = random.Random(seed), []
    for chain in range(4):
        words = [f"w{dice.randint(0, 3000)}" for _ in range(60)]
        for _ in range(15):
            out.append(" ".join(words))
            at = dice.randrange(len(words))
            words[at : at + dice.randint(1, 2)] = [f"c{chain}x{dice.randint(0, 9999)}"]
    out += [" ".join(f"s{dice.randint(0, 50)}" for _ in range(dice.randint(1, 30))) for _ in range(30)]
    dice.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block", [3, 256])
def test_chains(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = chains(block)
    got = {r["doc_id"]: r["component_id"] for r in nd.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == smallest_reachable(rows)


def test_awkward_rows(spark):
    docs = documents(spark)
    rows = nd.groups(docs).collect()
    assert len(rows) == docs.count()
    want = smallest_reachable([r for r in pairs(docs) if r[0] is not None])
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["kept"]) == (want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    by_id = {r["doc_id"]: r["n_shingles"] for r in rows}
    assert (by_id[4], by_id[5], by_id[7], by_id[8], by_id[14]) == (0, 0, 1, 1, 1)
    assert nd.groups(empty(spark)).count() == 0


def test_distinct_documents_keeps_columns(spark):
    docs = documents(spark)
    got = nd.distinct_documents(docs)
    assert got.columns == docs.columns
    want = smallest_reachable([r for r in pairs(docs) if r[0] is not None])
    ids = sorted((r["doc_id"] for r in got.collect()), key=lambda x: (x is None, x or 0))
    assert ids == [*sorted(set(want.values())), None]


def test_estimates_follow_similarity():
    dice = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.75, 0.9):
        found = []
        for _ in range(30):
            pool = dice.integers(0, 1 << 63, 800, np.uint64)
            apart = int(400 * (1 - share) / (1 + share))
            a, b = np.sort(pool[:400]), np.sort(np.concatenate([pool[apart:400], pool[400 : 400 + apart]]))
            signs = [np.frombuffer(nd.packed(nd.minima(x)), np.uint8)[None, :] for x in (a, b)]
            found.append(float(nd.estimates(*signs)[0, 0]))
        assert abs(np.mean(found) - share) < 0.04


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 900), (900, 700)], "a long, b long")
    got = {r["node"]: r["component"] for r in nd.components(links).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 900: 500, 700: 500}
