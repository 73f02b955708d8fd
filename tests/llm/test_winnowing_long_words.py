"""Fingerprints of texts without spaces."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from orderloom.llm import winnowing


def test_texts_without_spaces(spark):
    dice = random.Random(6)
    made = lambda n: "".join(chr(dice.choice([0x4E00, 0x20000]) + dice.randrange(3000)) for _ in range(n))
    passage = made(30)
    texts = [made(300), made(200) + passage + made(55), made(31) + passage + made(90), "w" * 64 + " b c", "w" * 65 + " b c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in winnowing.report(docs, 2).collect()}
    assert all(0.3 < rows[k]["near_edited"] < 1 for k in (0, 1, 2))
    hashes = {k: {p.split("@")[0] for p in r["fingerprint"].split()} for k, r in rows.items()}
    assert hashes[1] & hashes[2] and not hashes[0] & hashes[1]
    assert len(hashes[0]) > 60
    plain = {r["doc_id"]: r["picks"] for r in winnowing.fingerprints(docs).collect()}
    assert [len(plain[k]) for k in range(3)] == [1, 1, 1]  # the option is off there
    # Words up to the bound are hashed as before, and longer ones code point by code point.
    same = docs.where("doc_id = 3").select(winnowing.picks(F.col("text")) == winnowing.picks(F.col("text"), winnowing.LONG_WORD)).first()[0]
    own = winnowing.picks(F.col("text"), winnowing.LONG_WORD) == winnowing.picks(F.lit("w " * 65 + "b c"))
    assert same and docs.where("doc_id = 4").select(own).first()[0]
