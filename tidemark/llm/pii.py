"""Personal data in texts: patterns propose spans, checks confirm them, context moves the score.

Only built-in column functions. Email, address, card and phone spans follow the fixed rules of the
base: a match that fails its check is dropped and not tried again from its middle. The method adds
bank account numbers (IBAN, length by country, mod 97) and social security numbers, which count only from a score of
``LEAST`` on. Every span has a score: that of its kind, and more if a context word stands near it.

Groups repeat possessively, so a match of any length needs no stack.

Defined results: a null text is an empty one; spans of different kinds may overlap; redaction
replaces overlapping spans as one, under the name of the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import apart, own_name
from tidemark.llm.spans import by_kind, with_places

_LOCAL = r"[A-Za-z0-9._%+-]"
# A match begins at the start of a run or where the last match ended.
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Length of an account number by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Account numbers, by fours: of their country's length, or of any length where no country has the code."""
    known = "(?:" + "|".join(" ".join(IBAN_LENGTHS.values()).split()) + ")"
    kinds = []
    for length, countries in IBAN_LENGTHS.items():
        fours, rest = divmod(length - 4, 4)
        last = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        kinds.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{fours}}}{last}")
    four = rf"(?:\x20(?!{known}[0-9]{{2}})[A-Z0-9]{{4}}|[A-Z0-9]{{4}})"
    kinds.append(rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}{four}{{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?")
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(kinds)})(?![A-Za-z0-9])"


IBAN = _iban()
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "ssn": SSN}
BASE = ("email", "ip", "card", "phone")
#: Score of a confirmed match, and words nearby that add ``BONUS`` (fixed values).
SCORES = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.7, "ssn": 0.3}
CONTEXT = {
    "email": "mail|contact|write|kontakt|courriel|correo",
    "ip": "ip|server|host|address|adresse|login",
    "card": "card|credit|visa|mastercard|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|fax|mobile|telefon|appel|llam",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "ssn": "ssn|social|security|taxpayer",
}
BONUS = 0.2
LEAST = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    state = F.aggregate(
        F.split(F.reverse(digits), ""),
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("sum")),
        lambda acc, c: F.struct(
            (acc["at"] + 1).alias("at"),
            (
                acc["sum"]
                + F.when(acc["at"] % 2 == 0, F.ascii(c) - 48).otherwise(
                    (F.ascii(c) - 48) * 2 - F.when(F.ascii(c) > 52, 9).otherwise(0)
                )
            ).alias("sum"),
        ),
        lambda acc: acc["sum"],
    )
    return state % 10 == 0


def mod_97(code: Column) -> Column:
    """Whether an account number, its first four characters moved to the end, is 1 modulo 97."""
    plain = F.replace(code, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda acc, c: F.when(F.ascii(c) < 58, acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97,
    )
    return rest == 1


def _parts_fit(match: Column) -> Column:
    """All four parts at most 255, leading zeros or not."""
    return F.forall(
        F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "")),
        lambda p: (F.char_length(p) < 3) | ((F.char_length(p) == 3) & (p <= "255")),
    )


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return _parts_fit(match)
    if kind == "card":
        digits = _digits(match)
        return F.when(F.char_length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(match)).between(8, 15)
    if kind == "iban":
        return mod_97(match)
    return F.lit(True)


def _scored(number: int, kind: str) -> Column:
    """Confirmed spans of a kind with their scores."""

    def one(m: Column) -> Column:
        near = F.lower(m["before"]).rlike(CONTEXT[kind]) | F.lower(m["after"]).rlike(CONTEXT[kind])
        return F.struct(
            F.lit(number).alias("number"),
            F.lit(kind).alias("kind"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.round(F.lit(SCORES[kind]) + F.when(near, BONUS).otherwise(0.0), 2).alias("score"),
        )

    scored = F.transform(F.filter(f"__{kind}", lambda m: _confirmed(kind, m["match"])), one)
    return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= LEAST)


def find_personal(docs: DataFrame, text: str = "text", base: str = "base_spans", spans: str = "spans") -> DataFrame:
    """Add two arrays of (kind, start, end), by kind, then start: the base kinds, and all.

    A third array ``<spans>_scores`` has the score of each of all spans.
    """
    scores = f"{spans}_scores"
    rows, names = apart(docs)
    given = {base.lower(), spans.lower(), scores.lower()}
    kept = [F.col(inner).alias(c) for c, inner in names.items() if c.lower() not in given]
    df = rows.withColumn("__scan", F.col(own_name(names, text)))
    for kind, pattern in PATTERNS.items():
        df = with_places(df, "__scan", f"__{kind}", pattern)
    found = [_scored(number, kind) for number, kind in enumerate(PATTERNS)]
    df = df.withColumn("__found", F.concat(*found))
    plain = F.filter("__found", lambda s: s["number"] < len(BASE))
    ranked = F.array_sort(
        F.transform("__found", lambda s: F.struct(s["number"].alias("number"), s["start"].alias("start"), s["score"].alias("score")))
    )
    return df.select(
        *kept,
        by_kind(plain).alias(base),
        by_kind(F.col("__found")).alias(spans),
        F.transform(ranked, lambda s: s["score"]).alias(scores),
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with ``[KIND]`` in place of each span."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    cut = F.aggregate(
        ordered,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["parts"])
            .otherwise(
                F.concat(
                    acc["parts"],
                    F.array(
                        F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
                    ),
                )
            )
            .alias("parts"),
        ),
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(text, (acc["at"] + 1).cast("int"))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)
