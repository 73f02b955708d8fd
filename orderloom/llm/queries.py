"""The text operators as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm import (
    bpe, conversation_repair, hard_negatives, html_blocks, near_dedup, oracles, packing, pii, quality_model, quality_rules, rans, suffix_trees,
    toxicity, winnowing,
)
from orderloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark, sf):
    judged = quality_rules.quality_rules(table(spark, sf, "documents"))
    return judged.withColumn("cleaned_sha256", F.sha2("cleaned", 256)).drop("cleaned")


def op2_toxicity(spark, sf):
    return toxicity.toxicity(spark, table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_html(spark, sf):
    return html_blocks.main_text(spark, table(spark, sf, "pages"))


def op4_pii(spark, sf):
    return pii.report(table(spark, sf, "documents"))


def pii_base(spark, sf):
    """What the base patterns of the operator find, without its own kinds."""
    return op4_pii(spark, sf).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def op5_winnowing(spark, sf):
    return winnowing.report(table(spark, sf, "documents"))


def op6_rans(spark, sf):
    return rans.roundtrip(table(spark, sf, "documents"), plain_names=False)


def op7_packing(spark, sf):
    return packing.digest(packing.pack(table(spark, sf, "documents"), plain_names=False))


def op8_near_dedup(spark, sf):
    return near_dedup.groups(table(spark, sf, "documents"))


def op9_quality_model(spark, sf):
    return quality_model.quality(spark, table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_bpe(spark, sf):
    return bpe.digests(table(spark, sf, "documents"))


def op11_hard_negatives(spark, sf):
    label, key = F.col("label").cast("bigint"), F.col("vec_id").cast("bigint")
    rows = table(spark, sf, "embeddings").select(
        key.alias("id"), F.when(key % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").alias("vector")
    )
    return hard_negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def op12_substring_dedup(spark, sf):
    return suffix_trees.repeats(table(spark, sf, "documents")).digest()


def op13_conversation_repair(spark, sf):
    turns = conversation_repair.damaged(table(spark, sf, "conversations"))
    return conversation_repair.digest(conversation_repair.edits(turns))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_toxicity, op3_html, op4_pii, op5_winnowing, op6_rans, op7_packing, op8_near_dedup,
        op9_quality_model, op10_bpe, op11_hard_negatives, op12_substring_dedup, op13_conversation_repair, pii_base,
    )
}

# Words and lines by regular expressions as in the operator; window counts by joins over positions.
_OP1 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)
), word_stats AS (
  SELECT row_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY row_id
), windows AS (
  SELECT row_id, pos, [word, lead(word, 1) OVER w, lead(word, 2) OVER w] AS gram, lead(word, 2) OVER w AS third
  FROM words WINDOW w AS (PARTITION BY row_id ORDER BY pos)
), often AS (
  SELECT row_id, pos FROM (
    SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, gram) AS times FROM windows WHERE third IS NOT NULL
  ) WHERE times > 1
), repeats AS (
  SELECT row_id, count(DISTINCT pos + step) AS n_repeat_words
  FROM often, (VALUES (0), (1), (2)) AS s(step) GROUP BY row_id
), lines AS (
  SELECT row_id, unnest(l) AS line, generate_subscripts(l, 1) AS line_no
  FROM (SELECT row_id, string_split(text, chr(10)) AS l FROM docs)
), line_words AS (
  SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
    row_number() OVER (PARTITION BY row_id, line ORDER BY line_no) > 1 AS again
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), line_facts AS (
  SELECT *, len(w) AS n,
    len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>=_~^]+[.,!?;:]?$'))) AS symbols,
    len(list_filter(w, lambda x: x IN ('|', '>', '»', '›', '•', '·'))) AS separators,
    list_max(list_transform(list_distinct(w), lambda x: len(list_filter(w, lambda y: y = x)))) AS most
  FROM line_words
), line_verdicts AS (
  SELECT row_id, line_no, again, list_sum(list_transform(w, lambda x: length(x))) AS chars,
    again OR (symbols > 0 AND 2 * symbols >= n)
      OR (n >= 8 AND ((upper(line) = line AND lower(line) <> line) OR 2 * most >= n))
      OR separators >= 3
      OR (n < 12 AND NOT regexp_matches(w[-1], '[.!?…:;,"'')\]»”]$'))
      OR regexp_matches(lower(line), 'all rights reserved|cookie policy|enable javascript|licensed under|lorem ipsum|privacy policy|released under|sign up for our newsletter|skip to content|terms of service|terms of use|uses cookies')
      OR regexp_matches(lower(line), 'activez javascript|aller au contenu|conditions d''utilisation|mentions légales|politique de confidentialité|politique de cookies|tous droits réservés|utilise des cookies')
      OR regexp_matches(lower(line), 'alle rechte vorbehalten|cookie-richtlinie|datenschutzerklärung|javascript aktivieren|lizenziert unter|nutzungsbedingungen|verwendet cookies|zum inhalt springen')
      OR regexp_matches(lower(line), 'aviso legal|habilite javascript|política de cookies|política de privacidad|saltar al contenido|todos los derechos reservados|términos de uso|utiliza cookies')
      AS failed
  FROM line_facts
), line_stats AS (
  SELECT row_id, count(*) AS n_lines, count(*) FILTER (NOT failed) AS n_lines_kept,
    count(*) FILTER (again) AS n_dup_lines, coalesce(sum(chars) FILTER (failed), 0) AS lost_chars
  FROM line_verdicts GROUP BY row_id
), cleaned AS (
  SELECT row_id, string_agg(line, chr(10) ORDER BY line_no) AS cleaned
  FROM lines LEFT JOIN line_verdicts USING (row_id, line_no) WHERE NOT coalesce(failed, FALSE) GROUP BY row_id
), counts AS (
  SELECT doc_id, sha256(coalesce(cleaned, '')) AS cleaned_sha256, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_lines_kept, 0)::BIGINT AS n_lines_kept,
    coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM docs LEFT JOIN word_stats USING (row_id) LEFT JOIN repeats USING (row_id) LEFT JOIN line_stats USING (row_id)
    LEFT JOIN cleaned USING (row_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost_chars <= 0.4 * word_chars AS kept, n_lines, n_lines_kept, lost_chars, cleaned_sha256
FROM judged
"""

# Inner products over all pairs of an anchor and a row, then two selections.
_OP11 = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor_id, a.label AS anchor_label, r.id, r.label,
    coalesce(list_sum(list_transform(list_zip(a.v, r.v), lambda p: coalesce(p[1] * p[2], 0)))::BIGINT, 0) AS score
  FROM (SELECT DISTINCT * FROM rows WHERE id % 100 = 0) a, rows r
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score, place FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place
    FROM scored WHERE label = anchor_label AND id <> anchor_id
  ) WHERE place <= 5
), negatives AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, place ORDER BY s.score DESC, s.id)::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
    AND 100 * s.score BETWEEN 30 * positive_score AND 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""

# Every window as a text; the words under windows that start in an earlier document are left out.
_OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT row_id, doc_id, pos, md5(array_to_string(w[pos:pos + 49], ' ')) AS own
  FROM (SELECT *, unnest(range(1, len(w) - 48)) AS pos FROM docs WHERE len(w) >= 50 AND doc_id IS NOT NULL)
), firsts AS (
  SELECT own, min(doc_id) AS first_id FROM windows GROUP BY own
), gone AS (
  SELECT DISTINCT row_id, pos + step AS pos
  FROM (SELECT row_id, pos FROM windows JOIN firsts USING (own) WHERE doc_id > first_id), range(50) AS steps(step)
), kept AS (
  SELECT row_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
  FROM (SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs) ANTI JOIN gone USING (row_id, pos)
  GROUP BY row_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_id)
"""

SQL: dict[str, str] = {
    "op1_quality_rules": _OP1,
    "op8_near_dedup": oracles.NEAR_DEDUP,
    "op11_hard_negatives": _OP11,
    "op12_substring_dedup": _OP12,
    "op13_conversation_repair": oracles.CONVERSATIONS,
    "pii_base": oracles.PII_BASE,
}
