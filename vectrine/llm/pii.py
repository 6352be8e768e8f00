"""Personal data in texts: patterns propose spans, checksums confirm them, context adjusts a score.

Everything is a Spark expression: no Python runs in tasks. A pattern's matches and
the gaps between them come from ``regexp_extract_all`` and ``split``, so a match
starts where the gaps and matches before it end; lengths are in code points.

The patterns below accept the same matches as the plain ones in their comments.
They differ only in cost: a run is entered at its first character alone and never
given back, so long runs of letters or digits take linear time and no stack.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spare_name, text_or_empty


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``base``: kept whenever the check holds. Other kinds need ``threshold``,
    reached by ``score`` plus ``lift`` where a context word stands near.
    """

    name: str
    pattern: str
    context: str
    score: float
    lift: float
    base: bool = False


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind(
        "email",
        r"[A-Za-z0-9._%+-](?:(?<![A-Za-z0-9._%+-][A-Za-z0-9._%+-])|(?<=\G[A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"e-?mail|mail|contact|kontakt|correo|courriel",
        0.9,
        0.1,
        True,
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind(
        "ip",
        r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
        r"\bip\b|host|server|address|adresse",
        0.7,
        0.2,
        True,
    ),
    # [0-9]([\x20-]?[0-9])+ with 12 to 19 digits
    Kind(
        "card",
        r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
        r"card|visa|master|credit|karte|carte|tarjeta",
        0.8,
        0.2,
        True,
    ),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        r"phone|tel|call|mobile|fax|anruf",
        0.7,
        0.2,
        True,
    ),
    Kind(
        "iban",
        r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:[A-Z0-9]{11,30}+|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
        r"iban|account|konto|compte|cuenta|bank",
        0.9,
        0.1,
    ),
    Kind(
        "ssn",
        r"[0-9](?<![A-Za-z0-9-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])",
        r"\bssn\b|social security",
        0.3,
        0.5,
    ),
)
THRESHOLD = 0.5
# Code points before a span in which a context word counts.
CONTEXT_CHARS = 40
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""
    backwards = F.split(F.reverse(digits), "")
    parts = F.transform(backwards, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(parts, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def mod_97(account: Column) -> Column:
    """The mod-97 check of an account number: first four characters to the end, letters as 10 to 35."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.split(F.concat(F.substring(plain, 5, 1000), F.substring(plain, 1, 4)), "")
    step = lambda rest, c: F.when(c == "", rest).when(c.rlike("^[0-9]$"), (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(turned, F.lit(0), step) == 1


def _valid(kind: Kind, match: Column) -> Column:
    if kind.name == "ip":
        return match.rlike(IP_PARTS)
    if kind.name == "card":
        return luhn(_digits(match))
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind.name == "iban":
        return F.length(F.regexp_replace(match, " ", "")).between(15, 34) & mod_97(match)
    if kind.name == "ssn":
        return ~match.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: a lambda's body is evaluated for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunks(items: Column) -> Column:
    """The array in pieces as long as there are pieces.

    A fold that appends copies what it has so far. Over pieces, and then inside each,
    it copies at most the square root of the whole at a time.
    """

    def cut(it: Column) -> Column:
        length = F.ceil(F.sqrt(F.size(it["items"]))).cast("int")
        starts = F.sequence(F.lit(1), F.size(it["items"]), F.greatest(length, F.lit(1)))
        return F.when(F.size(it["items"]) > 0, F.transform(starts, lambda i: F.slice(it["items"], i, length)))

    return _let(F.struct(items.alias("items")), cut)


def _proposals(text: Column, kind: Kind) -> Column:
    """Array of (start, end, match, near) of the pattern's leftmost, non-overlapping matches.

    ``near`` is the text before the match in which context counts.
    """
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    none = F.array().cast("array<struct<start:int,end:int,match:string,near:string>>")
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("match")), lambda p: p["match"].isNotNull())
    nothing = F.array().cast("array<struct<at:int,tail:string,pairs:array<struct<gap:string,match:string>>>>")

    def enter(acc: Column, chunk: Column) -> Column:
        body = F.array_join(F.transform(chunk, lambda p: F.concat(p["gap"], p["match"])), "")
        return F.struct(
            (acc["at"] + F.length(body)).alias("at"),
            F.right(F.concat(acc["tail"], body), F.lit(CONTEXT_CHARS)).alias("tail"),
            F.array_append(acc["parts"], F.struct(acc["at"].alias("at"), acc["tail"].alias("tail"), chunk.alias("pairs"))).alias("parts"),
        )

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        near = F.right(F.concat(acc["tail"], pair["gap"]), F.lit(CONTEXT_CHARS))
        span = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"), near.alias("near"))
        return F.struct(end.alias("at"), F.right(F.concat(near, pair["match"]), F.lit(CONTEXT_CHARS)).alias("tail"), F.array_append(acc["spans"], span).alias("spans"))

    def within(part: Column) -> Column:
        return F.aggregate(part["pairs"], F.struct(part["at"].alias("at"), part["tail"].alias("tail"), none.alias("spans")), step, lambda acc: acc["spans"])

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), nothing.alias("parts"))
    parts = F.aggregate(_chunks(pairs), begin, enter, lambda acc: acc["parts"])
    return F.when(F.size(found) > 0, F.flatten(F.transform(parts, within))).otherwise(none)


def _accepted(proposals: Column, rank: int, kind: Kind) -> Column:
    """Confirmed spans of one kind, with their scores."""

    def scored(span: Column) -> Column:
        near = F.lower(span["near"]).rlike(kind.context)
        score = F.lit(kind.score) + F.when(near, F.lit(kind.lift)).otherwise(F.lit(0.0))
        return F.struct(
            span["start"].alias("start"),
            F.lit(rank).alias("rank"),
            span["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.round(score, 2).alias("score"),
            F.lit(kind.base).alias("base"),
        )

    spans = F.transform(F.filter(proposals, lambda s: _valid(kind, s["match"])), scored)
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with an array column of spans, ordered by start and then kind.

    A span has start, end (exclusive, code points), kind, score and base. Kinds may
    overlap each other. The e-mail, IP, card and phone spans are those of the plain
    patterns with their checks. IBANs need their mod-97 check, US social security
    numbers a context word nearby. A null or empty text has an empty array; rows,
    their order within a file and all other columns stay as they are. A column of
    the name ``into`` is refused rather than replaced.
    """
    if into in docs.columns:
        raise ValueError(f"the rows have a column named {into} already")
    body = text_or_empty(F.col(f"`{text}`"))
    spare = [spare_name(docs, f"__pii_{kind.name}") for kind in KINDS]
    df = docs.withColumns({name: _proposals(body, kind) for name, kind in zip(spare, KINDS)})
    spans = F.array_sort(F.concat(*[_accepted(F.col(name), rank, kind) for rank, (name, kind) in enumerate(zip(spare, KINDS))]))
    return df.withColumn(into, spans).drop(*spare)


def span_list(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each stretch of spans replaced by ``<KIND>`` of its first span.

    Chunks of spans get their stretch of the text first, so that a span's place is
    looked for in a short string.
    """
    parts_of = "array<struct<at:int,end:int,spans:array<struct<start:int,end:int,kind:string>>>>"
    slim = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

    def enter(acc: Column, chunk: Column) -> Column:
        end = F.greatest(acc["at"], F.array_max(F.transform(chunk, lambda s: s["end"])))
        return F.struct(end.alias("at"), F.array_append(acc["parts"], F.struct(acc["at"].alias("at"), end.alias("end"), chunk.alias("spans"))).alias("parts"))

    def within(part: Column) -> Column:
        begin = F.struct(part["at"].alias("at"), F.lit("").alias("out"), text.substr(part["at"] + 1, part["end"] - part["at"]).alias("body"))

        def step(acc: Column, span: Column) -> Column:
            gap = acc["body"].substr(acc["at"] - part["at"] + 1, F.greatest(span["start"] - acc["at"], F.lit(0)))
            put = F.concat(acc["out"], gap, F.lit("<"), F.upper(span["kind"]), F.lit(">"))
            return F.struct(
                F.greatest(acc["at"], span["end"]).alias("at"), F.when(span["start"] >= acc["at"], put).otherwise(acc["out"]).alias("out"), acc["body"].alias("body")
            )

        return F.aggregate(part["spans"], begin, step, lambda acc: acc["out"])

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(parts_of).alias("parts"))
    whole = lambda acc: F.concat(F.array_join(F.transform(acc["parts"], within), ""), text.substr(acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(_chunks(slim), begin, enter, whole)).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in the text masked; a null text stays null.

    All other columns stay as they are, whatever their names, and so do repeated rows.
    """
    spans = spare_name(docs, "__pii_spans")
    df = find_pii(docs, text, spans)
    return df.withColumn(text, masked(F.col(f"`{text}`"), F.col(spans))).drop(spans)


def pii_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: counts by base kind, the base spans' digest, and all spans."""
    df = find_pii(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), "text", "pii")
    base = F.filter("pii", lambda s: s["base"])

    def count(name: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return df.select(
        F.col("key").alias(key),
        *[count(kind.name) for kind in KINDS if kind.base],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("pii")).alias("spans"),
        F.coalesce(F.array_max(F.transform("pii", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
