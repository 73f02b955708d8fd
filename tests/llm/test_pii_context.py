"""Context words on both sides of a span, whatever lies between, and long secrets."""

from __future__ import annotations

from orderloom.llm import pii

LONG = "a" * 90 + "7" + "b" * 10
CASES = {
    "078-05-1120 (SSN)": "id:0:11",
    "SSN 078-05-1120, 219-09-9999": "id:4:15,id:17:28",
    "é😀 219-09-9999 x 078-05-1120: ssn": "id:3:14,id:17:28",
    "SSN " + "- " * 30 + "078-05-1120": "",
    "078-05-1120 " + "- " * 30 + "SSN": "",
    "12-3 078-05-1120 of 219-09-9999": "",
    f"token {LONG}": f"secret:6:{6 + len(LONG)}",
    f"{'1' * 80}x is the password": "secret:0:81",
    f"token {'a' * 90}": "",
    "04dbebab91ab85687d33eeaaf9ac699e1188f962 = api_key": "secret:0:40",
}


def test_context_words(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}
    assert [got[k] for k in range(len(CASES))] == list(CASES.values())
    texts = {r["doc_id"]: r["text"] for r in pii.masked(docs).collect()}
    assert texts[0] == "<id> (SSN)" and texts[1] == "SSN <id>, <id>"
