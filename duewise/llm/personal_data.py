"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Base kinds are always reported where their rule holds: email, ip (parts at most 255), card (14 to 19
digits, Luhn) and phone (10 to 15 digits). The method adds kinds that a pattern alone would find too
often: iban (mod-97), card numbers of 13 digits (Luhn and context), national numbers and phone
numbers without a plus sign (context). A proposed span starts with the score of its kind; a
confirmed checksum and each context word within ``REACH`` characters raise it, words that speak of
versions, orders or parts lower it; spans of ``ENOUGH`` or more are reported. Base spans have score
1 less what such words take away, but are never dropped. Added spans that overlap a base span, or an
added one found before, are left out.

An IBAN has the length of its country, or where the country is not in the table, the longest that
ends with a word and is confirmed. A rejected start is passed over, not what follows it.

Matching is leftmost and non-overlapping per kind on whole texts; every pattern takes time in
proportion to the text, however long a run of digits or letters is.

Defined results: a null or empty text has no spans. Repeated rows give the same. Other columns are
neither read nor changed.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewise.llm.shared import ready

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "short_card", "national_id", "local_phone")
KINDS = BASE_KINDS + ADDED_KINDS
REACH = 40
ENOUGH = 0.6

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the first digit of a run, else it would have begun there.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_START = re.compile(r"\b[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_NEXT = re.compile(r"\x20?[A-Z0-9]")
_WORD = re.compile(r"\w")
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_LENGTHS = {country: n for n, countries in _IBAN_LENGTHS.items() for country in countries.split()}
_SHORT_CARD = re.compile(r"(?<![0-9-])[0-9](?:[\x20-]?[0-9]){12}(?![\x20-]?[0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

# Start score of an added kind, what its checksum adds, and words that support it.
_START = {"iban": 0.3, "short_card": 0.2, "national_id": 0.4, "local_phone": 0.4}
_CONFIRMED = {"iban": 0.4, "short_card": 0.2, "national_id": 0.0, "local_phone": 0.0}
_SUPPORT = {
    "email": r"e-?mail|contact|kontakt|correo|courriel|write to",
    "ip": r"\bip\b|address|server|host|adresse",
    "card": r"card|visa|mastercard|credit|karte|carte|tarjeta",
    "phone": r"phone|call|tel|mobile|fax|telefon",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "short_card": r"card|visa|credit|karte|carte|tarjeta",
    "national_id": r"ssn|social security|national|passport|\bid\b|ausweis",
    "local_phone": r"phone|call|tel|mobile|fax|telefon",
}
_AGAINST = r"version|order|part no|isbn|serial|invoice|build|revision"
_SUPPORT = {k: re.compile(v, re.IGNORECASE) for k, v in _SUPPORT.items()}
_AGAINST = re.compile(_AGAINST, re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        if place % 2:
            digit = digit * 2 - 9 if digit > 4 else digit * 2
        total += digit
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Letters count as 10 to 35; the first four characters are read last."""
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ibans(text: str):
    """(start, end) of confirmed numbers; at most 34 characters are looked at from each start."""
    free = 0
    for m in _IBAN_START.finditer(text):
        if m.start() < free:
            continue
        ends, at = [], _IBAN_NEXT.match(text, m.end())
        while at and len(ends) < 30:
            ends.append(at.end())
            at = _IBAN_NEXT.match(text, at.end())
        length = _IBAN_LENGTHS.get(m[0][:2])
        for n in (length,) if length else range(len(ends) + 4, 14, -1):
            if n - 5 < len(ends) and not _WORD.match(text, end := ends[n - 5]) and mod97(text[m.start() : end].replace(" ", "")):
                yield m.start(), end
                free = end
                break


def _byte(part: str) -> bool:
    return len(part) < 4 and int(part or "0") <= 255


def _emails(text: str):
    """As the pattern matches from the left: around each @, from as far left as its characters reach."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
            at = text.find("@", free)
        else:
            free = at + 1
            at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), ordered by start and then kind as listed."""
    out = [(a, b, "email") for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(_byte(p.lstrip("0")) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() < 60 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return _ordered(out)


def _ordered(spans):
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def context_score(text: str, start: int, end: int, kind: str, score: float) -> float:
    near = text[max(0, start - REACH) : start] + " " + text[end : end + REACH]
    score += 0.25 * min(2, len({m[0].lower() for m in _SUPPORT[kind].finditer(near)}))
    score -= 0.3 * bool(_AGAINST.search(near))
    return max(0.0, min(1.0, score))


def added_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
    """Confirmed or supported spans of further kinds, with their scores."""
    if not _DIGIT.search(text):
        return []
    # Disjoint and in order, so that only two neighbours can overlap a span.
    out, taken = [], []
    for a, b, _ in base:
        if taken and a <= taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    found = [("iban", *span) for span in _ibans(text)]
    for kind, pattern in (("short_card", _SHORT_CARD), ("national_id", _NATIONAL), ("local_phone", _LOCAL_PHONE)):
        found += [(kind, *m.span()) for m in pattern.finditer(text) if kind != "short_card" or luhn(_digits(m[0]))]
    for kind, start, end in found:
        score = context_score(text, start, end, kind, _START[kind] + _CONFIRMED[kind])
        at = bisect_left(taken, (start, end))
        if score >= ENOUGH and not any(a < end and start < b for a, b in taken[max(0, at - 1) : at + 1]):
            out.append((start, end, kind, score))
            insort(taken, (start, end))
    return out


_FOUND = pa.struct([(f"n_{k}", pa.int64()) for k in BASE_KINDS] + [
    ("base_sha256", pa.string()),
    ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))),
])


def _look(text: str | None) -> dict:
    base = base_spans(text) if text else []
    spans = [(a, b, k, context_score(text, a, b, k, 1.0)) for a, b, k in base]
    spans += added_spans(text, base) if text else []
    line = ",".join(f"{k}:{a}:{b}" for a, b, k in base)
    return {f"n_{kind}": sum(k == kind for _, _, k in base) for kind in BASE_KINDS} | {
        "base_sha256": hashlib.sha256(line.encode()).hexdigest(),
        "spans": [{"kind": k, "start": a, "stop": b, "score": s} for a, b, k, s in _ordered(spans)],
    }


def personal_data(text: Column) -> Column:
    """What stands in a text: counts of the base kinds, their digest, and all spans with scores."""

    @F.arrow_udf(
        "struct<n_email:bigint, n_ip:bigint, n_card:bigint, n_phone:bigint, base_sha256:string,"
        " spans:array<struct<kind:string, start:bigint, stop:bigint, score:double>>>"
    )
    def look(texts: pa.Array) -> pa.Array:
        return pa.array([_look(t) for t in texts.to_pylist()], _FOUND)

    return look(text)


def find_personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, the base kinds' counts and digest, and spans (kind, start, stop, score)."""
    ready(documents.sparkSession)
    return documents.select("doc_id", personal_data(F.col("text")).alias("f")).select("doc_id", "f.*")


def personal_data_report(documents: DataFrame) -> DataFrame:
    """The same with the spans as text, kind:start:end joined by commas."""
    line = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    return find_personal_data(documents).withColumn("spans", line)


def redacted(documents: DataFrame) -> DataFrame:
    """doc_id and text with every span replaced by its kind in brackets."""
    ready(documents.sparkSession)

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            if text is None:
                out.append(None)
                continue
            parts, done = [], 0
            for s in _look(text)["spans"]:
                if s["stop"] > done:
                    parts += [text[done : max(done, s["start"])], f"[{s['kind']}]"]
                    done = s["stop"]
            out.append("".join([*parts, text[done:]]))
        return pa.array(out, pa.string())

    return documents.select("doc_id", cut("text").alias("text"))
