"""Quality rules, personal data and fingerprints against plain Python."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orderloom.llm import pii, quality_rules, winnowing
from orderloom.llm.queries import SQL
from tests.llm.fixtures import TEXTS, documents, empty, pairs


def test_quality_rules_equal_sql(spark):
    docs = documents(spark)
    got = quality_rules.quality_rules(docs).drop("cleaned").toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(SQL["op1_quality_rules"]).df()
    columns = sorted(got.columns)
    rows = [
        sorted(map(str, frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False, name=None)))
        for frame in (got.astype({"doc_id": "Int64"}), want.astype({"doc_id": "Int64"}))
    ]
    assert rows[0] == rows[1]


def test_quality_rules_remove_lines_then_documents():
    page = "Home | About | Contact | Login\n" * 3 + TEXTS[0] + "\n" + " ".join(f"w{i}" for i in range(60)) + ".\nLicensed under X."
    row = dict(zip(("n", "chars", "sym", "dup", "rep", "base", "kept", "lines", "left", "lost", "text"), quality_rules.judge(page)))
    assert row["kept"] and "Home" not in row["text"] and row["dup"] == 2 and row["left"] == 2 and row["lines"] == 6
    assert not quality_rules.judge("### %%% &&& $$$ " * 30)[6]


@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words_by_positions(words):
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    assert quality_rules.repeated_words(words) == len(covered)


def luhn(digits: str) -> bool:
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in values) % 10 == 0


def base_spans(text: str) -> list[str]:
    """The base kinds by the plain patterns."""
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append(("ip", m))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", m))
    return [f"{kind}:{m.start()}:{m.end()}" for kind, m in found]


def test_pii_base_spans(spark):
    long = ["1-" * 30000 + "1", "a@" + "b." * 9000, "a" * 50000, "+1" + "(" * 9000, "a@b.c " * 300]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(long)], "doc_id long, text string")
    docs = documents(spark).select("doc_id", "text").union(extra)
    want = Counter((d, hashlib.sha256(",".join(base_spans(t or "")).encode()).hexdigest()) for d, t in pairs(docs))
    rows = pii.report(docs).collect()
    assert Counter((r["doc_id"], r["base_sha256"]) for r in rows) == want
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[10]["n_iban"] == 1 and by_id[11]["spans"] == "secret:9:49"
    assert pii.report(empty(spark)).count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="a@.-1+ 4(é😀0", max_size=60), min_size=5, max_size=40))
def test_pii_random(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.report(docs).collect():
        assert row["base_sha256"] == hashlib.sha256(",".join(base_spans(texts[row["doc_id"]])).encode()).hexdigest()


def test_pii_masked_keeps_columns(spark):
    docs = documents(spark)
    got = pii.masked(docs)
    assert got.columns == docs.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in got.collect()}
    assert texts[9][0] == "mail <email> or call <phone> today, card <card>." and texts[9][1] == len(texts[9][0])
    assert texts[4][0] is None and texts[0][0] == TEXTS[0]


def picked(text: str) -> list[tuple[int, tuple]]:
    """Positions and words of picked grams, given Spark's hashes through the operator's own packing."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [(i, tuple(words[max(0, i - 3) : i + 1])) for i in range(len(words))]


def test_winnowing_picks_rightmost_minimum(spark):
    docs = documents(spark).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for row in winnowing.fingerprints(docs).collect():
        grams = picked(row["text"])
        hashes = {p["position"]: p["hash"] for p in row["picks"]}
        assert bool(grams) == bool(hashes)
        known: dict[tuple, int] = {}
        for at, value in hashes.items():
            assert known.setdefault(grams[at][1], value) == value
        # Every window holds a pick, and equal windows' picks are rightmost.
        for first in range(max(0, len(grams) - 3)):
            inside = [at for at in range(first, first + 4) if at in hashes]
            assert inside
            least = min(hashes[at] for at in inside)
            assert all(known.get(grams[at][1], least + 1) > least for at in range(inside[-1] + 1, first + 4))


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_winnowing_neighbours(spark, buckets):
    docs = documents(spark)
    rows = sorted(((-(1 << 63) if d is None else d, t or "") for d, t in pairs(docs)), key=lambda r: (-r[0], r[1]))
    want = []
    for k, (d, text) in enumerate(rows):
        third = len(text) // 3
        edited = text[: len(text) - third] + rows[(k + 1) % len(rows)][1][:third]
        want.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = winnowing.report(docs, buckets).collect()
    assert sorted((-(1 << 63) if r["doc_id"] is None else r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    same = {r["doc_id"]: r["fingerprint"] for r in got}
    assert same[0] == same[1] != same[3]


def test_winnowing_empty_and_native(spark):
    assert winnowing.report(empty(spark), 4).count() == 0
    for frame in (winnowing.report(documents(spark), 4), pii.report(documents(spark))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
        assert plan.count("Exchange hashpartitioning(bucket") <= 1
