"""The bound of the training sample holds for rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.llm import html_blocks
from orderloom.llm.common import training_rows


def test_one_row_per_chosen_id(spark):
    docs = spark.range(500).selectExpr("CASE WHEN id < 400 THEN 1 ELSE id END AS doc_id", "concat('text ', 900 - id) AS text")
    docs = docs.unionByName(spark.createDataFrame([(450, None)], "doc_id long, text string"))
    labels = spark.range(500).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    rows = training_rows(docs, labels, "toxic", 4, 2, 60).collect()
    assert 0 < len(rows) <= 60 and len({r["doc_id"] for r in rows}) == len(rows)
    rows = {r["doc_id"]: (r["text"], r["label"]) for r in training_rows(docs, labels, "toxic", 4, 9, 1000).collect()}
    assert rows[1] == ("text 501", 1) and rows[450] == ("", 0) and rows[451] == ("text 449", 1) and len(rows) == 101


def test_one_page_per_chosen_id(spark, monkeypatch):
    """A page that comes many times teaches no more than one that comes once."""
    pages = spark.range(40).selectExpr("id AS page_id", "concat('<p>Text ', id, '.</p><nav>Home</nav>') AS html")
    many = pages.unionByName(pages.where("page_id = 3").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("x"))
    monkeypatch.setattr(html_blocks, "LEAST_STEPS", 10)
    a, b = (html_blocks.fit(some).p for some in (pages, many))
    assert all((a[name] == b[name]).all() for name in html_blocks.Labeller.NAMES)
