"""Quality rules, line by line: lines that fail a rule go, then documents that lost too much text go.

Words are runs of anything but space and the control characters 9 to 13. The rules for a line with
words:

- punctuation: at least half of its words end in (or are) a run of symbols, or it has ``MIN_SHOUTED``
  words or more and no lower-case letter, or one word fills at least half of ``MIN_SHOUTED`` or more, or it
  has fewer than ``MIN_SENTENCE`` words and ends without punctuation (a heading, list item or cut-off line; a longer
  line may be a sentence that something was put behind);
- navigation: it has three or more separators (``| > » › • ·``) that stand alone as words, or it is a
  list item or heading of at most three words that ends without punctuation and holds a link word;
- boilerplate: it holds one of ``BOILERPLATE``'s phrases, in English, French, German or Spanish, whatever its case;
- repetition: it equals an earlier line of the document.

A document is kept if it passes the base test (``MIN_WORDS`` words, at most half of them in repeated
3-word windows) and its failed lines hold at most ``MAX_LOST`` of its word characters. A line without
words stays and counts nothing. A null text counts as an empty one and fails the base test; a repeated
row gives a repeated result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from orderloom.llm.common import prepare

MIN_WORDS = 50
MAX_REPEATED = 0.5
MAX_LOST = 0.4
MIN_SHOUTED = 8
MIN_SENTENCE = 12
# What a boilerplate line says, and words of links, in the languages of the corpus.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "enable javascript", "licensed under", "lorem ipsum",
    "privacy policy", "released under", "sign up for our newsletter", "skip to content",
    "terms of service", "terms of use", "uses cookies",
    "activez javascript", "aller au contenu", "conditions d'utilisation", "mentions légales",
    "politique de confidentialité", "politique de cookies", "tous droits réservés", "utilise des cookies",
    "alle rechte vorbehalten", "cookie-richtlinie", "datenschutzerklärung", "javascript aktivieren",
    "lizenziert unter", "nutzungsbedingungen", "verwendet cookies", "zum inhalt springen",
    "aviso legal", "habilite javascript", "política de cookies", "política de privacidad",
    "saltar al contenido", "todos los derechos reservados", "términos de uso", "utiliza cookies",
)
LINK_WORDS = (
    "about", "contact", "home", "login", "menu", "next", "previous", "search", "sitemap",
    "accueil", "connexion", "précédent", "recherche", "suivant",
    "anmelden", "impressum", "kontakt", "startseite", "suche", "weiter", "zurück",
    "anterior", "buscar", "contacto", "inicio", "siguiente",
)
SEPARATORS = ("|", ">", "»", "›", "•", "·")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
SYMBOL_END = re.compile(r"[#*$%&|<>=_~^]+[.,!?;:]?\Z")
ENDING = re.compile(r"[.!?…:;,\"')\]»”]\Z")
SCHEMA = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, n_lines bigint, n_lines_kept bigint, "
    "lost_chars bigint, cleaned string"
)


def failed_rule(line: str, words: list[str]) -> str | None:
    """The first rule that a line with words fails."""
    symbols = sum(1 for word in words if SYMBOL_END.search(word))
    if 2 * symbols >= len(words) and symbols:
        return "navigation" if sum(word in SEPARATORS for word in words) >= 3 else "punctuation"
    if len(words) >= MIN_SHOUTED:
        if line.upper() == line and line.lower() != line:
            return "punctuation"
        if 2 * max(Counter(words).values()) >= len(words):
            return "punctuation"
    if sum(word in SEPARATORS for word in words) >= 3:
        return "navigation"
    low = line.lower()
    if len(words) <= 3 and not ENDING.search(words[-1]) and any(word in LINK_WORDS for word in low.split()):
        return "navigation"
    if any(phrase in low for phrase in BOILERPLATE):
        return "boilerplate"
    if len(words) < MIN_SENTENCE and not ENDING.search(words[-1]):
        return "punctuation"
    return None


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window that occurs at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    last = total = 0
    for at, window in enumerate(windows):
        if often[window] > 1:
            total += at + 3 - max(last, at)
            last = at + 3
    return total


def judge(text: str | None) -> tuple:
    """The row of one text, without its id."""
    text = text or ""
    words = WORD.findall(text)
    seen, kept_lines = set(), []
    n_lines = n_kept = dup = lost = 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        n_lines += 1
        again = line in seen
        seen.add(line)
        dup += again
        if again or failed_rule(line, own):
            lost += sum(map(len, own))
        else:
            n_kept += 1
            kept_lines.append(line)
    chars = sum(map(len, words))
    repeated = repeated_words(words)
    base_failed = len(words) < MIN_WORDS or repeated > MAX_REPEATED * len(words)
    kept = not base_failed and lost <= MAX_LOST * chars
    return (
        len(words), chars, len(SYMBOL.findall(text)), dup, repeated, base_failed, kept,
        n_lines, n_kept, lost, "\n".join(kept_lines),
    )


def _judge_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``SCHEMA``."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in SCHEMA.split(", ")]
    for batch in batches:
        rows = list(zip(*map(judge, batch.column("text").to_pylist()), strict=True)) or [[]] * 11
        arrays = [pa.array(values, kind) for values, kind in zip(rows, types[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, verdict and cleaned text of every document; one row out per row in."""
    prepare(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text").mapInArrow(_judge_all, SCHEMA)
