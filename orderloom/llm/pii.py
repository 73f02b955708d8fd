"""Personal data by regular expressions, checksums and context words, in DataFrame functions only.

Patterns propose spans. Some are confirmed by a rule: parts of an ip are at most 255, a card number has
16 to 19 digits and passes Luhn, an iban passes mod-97, a phone number has 8 to 15 digits, a secret a letter
and a digit. Each kind has a base score, which words of its ``CONTEXT`` within ``NEAR`` characters before or
after the span raise, whatever else lies between. A span is
reported from ``ACCEPT`` on: the first four kinds always are; a ``secret`` (a long mixed token) and an
``id`` (a long number that is no card) need a word that names them nearby.

Positions. Cutting a text at a pattern's matches gives the pieces between them, so the running lengths of
pieces and matches are the offsets, in code points, end exclusive. Spans of one kind are the leftmost ones
that do not overlap, and a match that fails its rule is dropped without a second try. Spans of different
kinds may overlap; an ``iban``, ``secret`` or ``id`` that meets a span of an earlier kind is left out.

The patterns take runs possessively, which gives the same matches as the plain greedy forms, in time
linear in the text and without recursion in the matcher, so a very long text is safe. A null text counts
as an empty one: no spans. Repeated rows give repeated results; of spans that begin together the order is that of their
kinds. An empty table gives an empty result. ``masked`` keeps all columns, also one named ``pii_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.common import prepare

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret", "id")
NEAR = 40
ACCEPT = 0.5
CONTEXT_BOOST = 0.4
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]{4}+){2,7}+(?:\x20?+[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+",
    "id": r"(?<![0-9.])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|(?<![0-9+.])[0-9]{9,19}+(?![0-9])",
}
# What a text must hold for the pattern to be tried at all; cheaper than the pattern.
HINTS = {
    "email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}", "secret": r"[0-9]", "id": r"[0-9]{4}",
}
# Words that name a kind, in the languages of the corpus.
CONTEXT = {
    "email": "e-?mail|mail|contact|correo|courriel",
    "ip": "ip|address|host|server|adresse",
    "card": "card|credit|visa|mastercard|carte|karte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|téléphone|teléfono",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "secret": "token|secret|password|passwd|api[_ -]?key|key|credential|bearer",
    "id": "ssn|social security|passport|account|iban|id number|tax|ausweis|passeport|pasaporte",
}
BASE_SCORE = {"email": 0.6, "ip": 0.55, "card": 0.6, "phone": 0.55, "iban": 0.6, "secret": 0.2, "id": 0.2}


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn test."""
    doubled = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(
            doubled,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                (2 * d.cast("int")) % 10 + F.floor(2 * d.cast("int") / 10).cast("int")
            ),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an iban without spaces has remainder 1."""
    turned = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(
            (a * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return rest == 1


def confirmed(kind: str, match: Column) -> Column:
    """Whether a match of a kind passes the kind's rule."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(match, " ", ""))
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def _proposed(kind: str, text: Column) -> Column:
    """Confirmed spans of one kind with their scores, left to right."""
    pattern = PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    # The characters behind every match, which are not part of it.
    afters = F.regexp_extract_all(text, F.lit(rf"(?:{pattern})(?=([\s\S]{{0,{NEAR}}}))"), F.lit(1))
    names = rf"(?:^|[^\p{{L}}])(?:{CONTEXT[kind]})"
    zero = F.struct(F.lit(0).alias("end"), F.lit("").alias("tail"), F.array().cast(_SPANS).alias("spans"))

    def step(state, pair):
        begin = state["end"] + F.length(pair["piece"])
        end = begin + F.length(pair["match"])
        before = F.right(F.concat(state["tail"], F.right(pair["piece"], F.lit(NEAR))), F.lit(NEAR))
        near = F.lower(before).rlike(names) | F.lower(pair["after"]).rlike(names)
        score = F.lit(BASE_SCORE[kind]) + F.when(near, CONTEXT_BOOST).otherwise(0.0)
        span = F.struct(
            F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), score.alias("score")
        )
        good = confirmed(kind, pair["match"]) & (F.lit(kind in BASE_KINDS) | (score >= ACCEPT))
        return F.struct(
            end.alias("end"),
            F.right(F.concat(before, F.right(pair["match"], F.lit(NEAR))), F.lit(NEAR)).alias("tail"),
            F.when(good, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    pairs = F.arrays_zip(
        F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"), afters.alias("after")
    )
    found = F.aggregate(pairs, zero, step, lambda state: state["spans"])
    return F.when(text.rlike(HINTS[kind]), found).otherwise(F.array().cast(_SPANS))


_SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with a column ``pii_spans``: kind, start, end and score, in order of kind and start.

    A column of that name in the input is replaced.
    """
    prepare(docs.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(*(_proposed(kind, whole) for kind in BASE_KINDS))
    found = docs.withColumn("pii_spans", base)
    for kind in KINDS[len(BASE_KINDS):]:
        added = F.filter(
            _proposed(kind, whole),
            lambda new: ~F.exists(
                F.col("pii_spans"), lambda old: (old["start"] < new["end"]) & (new["start"] < old["end"])
            ),
        )
        found = found.withColumn("pii_spans", F.concat("pii_spans", added))
    return found


def _written(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("bigint")


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts by base kind, a digest of the base spans, and all spans as text."""
    found = spans(docs.select("doc_id", "text"))
    base = F.filter("pii_spans", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("pii_spans")).alias("spans"),
        F.size("pii_spans").cast("bigint").alias("n_spans"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """The input with every span in ``text`` replaced by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the one that begins first (of equals, the
    longest). ``n_chars``, if there is one, follows the new text. A null text stays null.
    """
    given = "_given_pii_spans"  # a column of the input may have the name of the found ones
    found = spans(docs.withColumnRenamed("pii_spans", given))
    order = F.array_sort(
        F.transform(
            "pii_spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))
        )
    )
    cut = F.aggregate(
        order,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda state, s: F.when(
            s["start"] >= state["at"],
            F.struct(
                F.concat(
                    state["out"],
                    F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]),
                    F.lit("<"), s["kind"], F.lit(">"),
                ).alias("out"),
                (-s["back"]).alias("at"),
            ),
        ).otherwise(F.struct(state["out"].alias("out"), F.greatest(state["at"], -s["back"]).alias("at"))),
        lambda state: F.concat(
            state["out"], F.substring(F.col("text"), state["at"] + 1, F.length(F.col("text")) - state["at"])
        ),
    )
    out = found.withColumn("text", F.when(F.size("pii_spans") > 0, cut).otherwise(F.col("text"))).drop("pii_spans")
    out = out.withColumnRenamed(given, "pii_spans")
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out
