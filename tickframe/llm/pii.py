"""Personal data in texts, in column expressions alone.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod 97 for IBANs, ranges for addresses and
numbers), and context words shortly before a span raise its score. The four base kinds (email, ip, card, phone) stay
whatever their context; the further kinds count from a score of ``KEEP`` on: IBANs by their checksum, social
security numbers, phone numbers without a country code and secrets only beside a context word. A secret is a run of
``SECRET_CHARS`` or more characters of keys and tokens that looks random: it has letters, digits and ``SECRET_DISTINCT`` or more
different characters.

Matches are leftmost and do not overlap within a kind. Java's engine backtracks where a linear-time engine would not,
so the patterns below are deterministic forms of the plain ones: possessive runs, starts only where a run can start, and
digit counts within the pattern. They accept the same spans and stay linear on long runs of one class.

Spans are counted in code points, end exclusive. A position is the length of the pieces before it; pieces and matches
come from one split and one extraction per kind, only in texts that match at all. Sums run in groups of ``GROUP``
matches, so texts with very many matches cost little more than their length. No shuffle, no Python.

Null texts are empty; repeated rows are judged each for itself; other columns stay, unless they bear the name of a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ["email", "ip", "card", "phone"]
ADDED_KINDS = ["iban", "ssn", "local_phone", "secret"]
KINDS = BASE_KINDS + ADDED_KINDS
GROUP = 256
CONTEXT_CHARS = 40
KEEP = 0.5
SECRET_CHARS, SECRET_DISTINCT = 16, 8

#: Characters of an IBAN by country: the registry, and the countries that use the form without being in it.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBANS = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())

PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ of 14 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9] of 10 to 15 digits
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){9,14}(?![\x20().-]*+[0-9])",
    # The country gives the length, so words that follow stay outside.
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBANS})(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    # A start inside a run is none, so a run is tried once.
    "secret": rf"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/_.-]{{{SECRET_CHARS},}}+={{0,2}}+",
}

#: Score of a confirmed span without context, and the words that raise it by ``BOOST``.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "local_phone": 0.2, "secret": 0.3}
BOOST = 0.3
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|address|host|server",
    "card": "card|visa|credit|payment|amex|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social security",
    "local_phone": "phone|call|tel|mobile|fax",
    "secret": r"\w*(?:token|secret|passw|pwd|credential)|\w*(?:api|access|private|auth|signing)[_\x20-]?key|bearer",
}


def _running(lengths: Column) -> Column:
    """Per group of ``GROUP`` elements, the sums up to each, after a zero."""

    def sums(xs: Column) -> Column:
        return F.aggregate(xs, F.array(F.lit(0).cast("int")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    last = F.floor((F.size(lengths) - 1) / GROUP).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda g: sums(F.slice(lengths, g * GROUP + 1, GROUP)))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    doubled = lambda i: F.when(i % 2 == 0, F.when(value(i) > 4, 2 * value(i) - 9).otherwise(2 * value(i))).otherwise(value(i))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda total, i: total + doubled(i)) % 10 == 0


def _mod97(match: Column) -> Column:
    plain = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    code = lambda i: F.ascii(F.substring(turned, i, F.lit(1)))
    step = lambda left, i: F.when(code(i) < 65, left * 10 + code(i) - 48).otherwise(left * 100 + code(i) - 55) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: F.regexp_replace(part, "^0+", "").rlike(r"^(?:|[0-9]|[0-9]{2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return _luhn(match)
    if kind == "iban":
        return _mod97(match)
    if kind == "secret":
        return match.rlike("[A-Za-z]") & match.rlike("[0-9]") & (F.size(F.array_distinct(F.split(match, ""))) >= SECRET_DISTINCT)
    return F.lit(True)


def _spans(kind: str) -> list[tuple[str, Column]]:
    """Columns to add in turn; the last is the array of the kind's confirmed spans with their scores."""
    match = F.regexp_extract_all("_text", F.lit(PATTERNS[kind]), F.lit(0))
    if PRIOR[kind] < KEEP:
        # Nothing of this kind counts without a context word, so texts that hold none are not searched.
        match = F.when(F.col("_lower").rlike(CONTEXT[kind].replace(r"\w*", "")), match).otherwise(F.array().cast("array<string>"))
    some = F.size("_match") > 0
    steps = [
        ("_match", match),
        ("_piece", F.when(some, F.split(F.col("_text"), PATTERNS[kind], -1))),
        # How far each match lies behind the one before: that match's length and the piece between.
        (
            "_len",
            F.when(
                some,
                F.transform(
                    F.sequence(F.lit(0), F.size("_match") - 1),
                    lambda i: F.char_length(F.get("_piece", i)) + F.coalesce(F.char_length(F.get("_match", i - 1)), F.lit(0)),
                ),
            ),
        ),
        ("_sums", F.when(some, _running(F.col("_len")))),
        (
            "_ahead",
            F.aggregate(
                "_sums", F.array(F.lit(0).cast("int")), lambda a, g: F.concat(a, F.array(F.element_at(a, -1) + F.element_at(g, -1)))
            ),
        ),
        (
            "_start",
            F.flatten(
                F.transform("_sums", lambda g, k: F.transform(F.slice(g, 2, GROUP), lambda x: x + F.get("_ahead", k)))
            ),
        ),
    ]

    def span(match: Column, i: Column) -> Column:
        start = F.get("_start", i)
        before = F.lower(F.substring("_text", F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS))))
        score = F.lit(PRIOR[kind]) + F.when(before.rlike(rf"\b(?:{CONTEXT[kind]})"), F.lit(BOOST)).otherwise(F.lit(0.0))
        return F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            (start + F.char_length(match)).alias("end"),
            F.least(score, F.lit(1.0)).alias("score"),
            _confirmed(kind, match).alias("confirmed"),
        )

    found = F.filter(F.transform("_match", span), lambda s: s.confirmed)
    if kind in ADDED_KINDS:
        found = F.filter(found, lambda s: s.score >= KEEP)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,score:double,confirmed:boolean>>")
    return [*steps, (f"_{kind}", F.when(some, found).otherwise(empty))]


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: array of (start, end, kind, score) in order of start and kind."""
    keep = [c for c in docs.columns if c != "pii"]
    out = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_lower", F.lower("_text"))
    for kind in KINDS:
        for name, column in _spans(kind):
            out = out.withColumn(name, column)
    # What lies in a base span is that span.
    base = F.concat(*(f"_{k}" for k in BASE_KINDS))
    covered = lambda s: F.exists("_base", lambda b: (b.start < s.end) & (s.start < b.end))
    out = out.withColumn("_base", base)
    added = F.filter(F.concat(*(f"_{k}" for k in ADDED_KINDS)), lambda s: ~covered(s))
    names = F.array(*map(F.lit, KINDS))
    return out.select(
        *keep,
        F.transform(
            F.array_sort(F.concat("_base", added)),
            lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.get(names, s.kind).alias("kind"), s.score.alias("score")),
        ).alias("pii"),
    )


def joined(spans: Column, kinds: list[str] = KINDS) -> Column:
    """``kind:start:end``, comma-joined, of the given kinds."""
    chosen = F.filter(spans, lambda s: s.kind.isin(kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
