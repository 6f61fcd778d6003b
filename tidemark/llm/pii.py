"""Personal data in whole texts, by DataFrame functions alone.

Patterns propose spans, checksums confirm them (Luhn for cards, mod-97 for bank
account numbers), and words near a span raise or lower its score. The base kinds
always stay; the kinds added here need a score of at least `LEAST`.

Defined results: null text counts as empty and has no spans; places are code
points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import whole_text
from tidemark.llm.spans import characters, in_order, kind_of, let, located

# The base patterns in the JVM's syntax. Repeated groups are possessive,
# which changes no match, and runs are matched from their first free character on.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Characters of an account number, by country code.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """In groups of four, as long as the country has it; other codes as far as it goes."""
    known = [
        rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, codes in IBAN_LENGTHS.items()
    ]
    other = rf"(?!{'|'.join(c for codes in IBAN_LENGTHS.values() for c in codes.split())})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*known, other])})(?![A-Za-z0-9])"


IBAN = _iban()
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
KINDS = ("email", "ip", "card", "phone", "short_card", "iban", "social")
BASE = 4

# Score of a confirmed span, and words that change it when near.
PRIOR = (0.9, 0.6, 0.8, 0.6, 0.3, 0.9, 0.3)
NEAR = (
    r"e-?mail|contact|write to|reach",
    r"\bip\b|address|host|server|login",
    r"card|visa|master|amex|credit|debit|payment",
    r"phone|tel|call|mobile|fax|whatsapp",
    r"card|visa|master|amex|credit|debit|payment",
    r"iban|bank|account|transfer|konto",
    r"ssn|social security|tax id",
)
AGAINST = r"version|isbn|order no|invoice|example|sample|serial"
GAIN, LOSS, LEAST, REACH = 0.3, 0.3, 0.5, 40


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    places = F.transform(F.reverse(characters(digits)), value)
    return F.aggregate(places, F.lit(0), lambda s, x: s + x) % 10 == 0


def mod97(hit: Column) -> Column:
    """Whether an account number has the remainder 1."""
    bare = F.regexp_replace(hit, "[^A-Z0-9]", "")
    turned = F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4))
    values = F.transform(characters(turned), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.aggregate(values, F.lit(0), lambda s, v: (s * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _byte_sized(hit: Column) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def _long_enough(least: int, most: int):
    return lambda digits: F.length(digits).between(least, most)


def _confirmed(spans: Column, kind: str) -> Column:
    def passes(x: Column) -> Column:
        if kind == "ip":
            return _byte_sized(x["hit"])
        if kind == "iban":
            return mod97(x["hit"])
        if kind == "phone":
            return _long_enough(8, 15)(_digits(x["hit"]))
        least, most = (16, 19) if kind == "card" else (13, 15)
        return let(_digits(x["hit"]), lambda d: F.when(_long_enough(least, most)(d), luhn(d)).otherwise(False))

    return spans if kind in ("email", "social") else F.filter(spans, passes)


def _scored(body: Column, spans: Column) -> Column:
    """The spans with their score."""

    def near(x: Column) -> Column:
        start = F.greatest(x["start"] - REACH, F.lit(0))
        return F.lower(F.concat_ws(" ", F.substring(body, start + 1, x["start"] - start), F.substring(body, x["end"] + 1, F.lit(REACH))))

    def score(x: Column, words: Column) -> Column:
        by_kind = [(x["rank"] == rank, (F.lit(PRIOR[rank]), words.rlike(NEAR[rank]))) for rank in range(len(KINDS))]
        prior, helped = F.lit(0.0), F.lit(False)
        for test, (value, hit) in by_kind:
            prior, helped = F.when(test, value).otherwise(prior), F.when(test, hit).otherwise(helped)
        moved = prior + F.when(helped, GAIN).otherwise(0.0) - F.when(words.rlike(AGAINST), LOSS).otherwise(0.0)
        return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), moved)), 2)

    fields = ("rank", "kind", "start", "end", "hit")
    return F.transform(
        spans, lambda x: let(near(x), lambda words: F.struct(*(x[f].alias(f) for f in fields), score(x, words).alias("score")))
    )


def personal_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and spans: array<struct<rank, kind, start, end, hit, score>> by kind,
    then start; ranks below BASE are the base kinds."""
    body = F.col("_body")
    numbers = located(body, CARD)
    found = {
        "email": located(body, EMAIL),
        "ip": located(body, IP),
        "card": F.col("_numbers"),
        "phone": located(body, PHONE),
        "short_card": F.col("_numbers"),
        "iban": located(body, IBAN),
        "social": located(body, SOCIAL),
    }
    every = F.concat(*(kind_of(_confirmed(found[kind], kind), kind, rank) for rank, kind in enumerate(KINDS)))
    return (
        docs.select(F.col(id), whole_text(text).alias("_body"))
        .withColumn("_numbers", numbers)
        .withColumn("_every", every)
        .withColumn("spans", _scored(body, F.col("_every")))
        .withColumn("spans", F.filter("spans", lambda x: (x["rank"] < BASE) | (x["score"] >= LEAST)))
        .select(id, in_order(F.col("spans"), "rank", "start").alias("spans"))
    )
