"""Exactly one row of every near-duplicate group, also with repeated and null ids."""

from __future__ import annotations

from orderloom.llm import near_dedup as nd


def test_one_row_per_group(spark):
    a, b, c, d, e = (" ".join(f"{name}{i}" for i in range(40)) for name in "abcde")
    rows = [
        (7, a, 1), (7, b, 1), (7, b + " more", 1),  # unrelated texts under one id
        (3, c, 1), (5, c, 1), (5, d, 1),  # id 5 is the smallest of one group only
        (None, e, 1), (None, e, 1), (None, e + " more", 1), (None, a, 1),
        (9, "", 1), (9, "", 1), (None, " \n", 1), (None, None, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text int").repartition(3)
    got = nd.distinct_documents(docs)
    assert got.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in got.collect()]
    texts = sorted((text or "").split()[0][0] for _, text in rows if (text or "").strip())
    assert texts == ["a", "b", "c", "d", "e"]
    ids = {text[0]: doc for doc, text in rows if (text or "").strip()}
    assert ids == {"a": 7, "b": 7, "c": 3, "d": 5, "e": None}
    assert sum(not (text or "").strip() for _, text in rows) == 4
