from __future__ import annotations

import hashlib
import random
import re

from duewise.llm.personal_data import base_spans, luhn, mod97, personal_data_report, redacted
from duewise.llm.shared import table

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        d = int(c) * (1 + k % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and plain_luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), KINDS.index(kind), m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def test_random_texts_match_the_patterns():
    rng = random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choice("ab1234509.@-+ ()%é\n") for _ in range(rng.randrange(60)))
        assert base_spans(text) == brute(text), text


def test_given_table(spark, folder):
    frame = table(spark, folder, "documents")
    rows = {r.doc_id: r for r in personal_data_report(frame).collect()}
    found = 0
    for r in frame.collect():
        spans = brute(r.text)
        found += len(spans)
        row = rows[r.doc_id]
        line = [f"{k}:{a}:{b}" for a, b, k in spans]
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s[2] == k for s in spans) for k in KINDS]
        assert row.base_sha256 == hashlib.sha256(",".join(line).encode()).hexdigest()
        assert set(line) <= set(row.spans.split(","))
    assert found and len(rows) == frame.count()


def test_added_kinds_need_checksum_or_context(spark, docs):
    rows = [
        (1, "IBAN DE89 3704 0044 0532 0130 00 of the account"), (2, "IBAN DE89 3704 0044 0532 0130 01 of the account"),
        (3, "my ssn is 123-45-6789"), (4, "part 123-45-6789"), (5, "call 555-123-4567"), (6, "order no 555-123-4567"),
    ]
    got = {r.doc_id: r.spans for r in personal_data_report(docs(rows)).collect()}
    assert got == {1: "iban:5:32", 2: "", 3: "national_id:10:21", 4: "", 5: "local_phone:5:17", 6: ""}
    assert luhn("4111111111111111") and not luhn("4111111111111112") and mod97("DE89370400440532013000")


def test_long_runs_take_no_long_time_and_odd_rows_work(spark, docs, odd_rows):
    rows = [*odd_rows, (8, "a" * 200_000), (9, "1" * 200_000), (10, "1." * 100_000), (11, "a@" * 50_000), (12, "+1" + "(" * 100_000)]
    assert personal_data_report(docs(rows)).count() == len(rows)
    assert personal_data_report(docs(rows).limit(0)).count() == 0


def test_redaction(spark, docs):
    text = {r.doc_id: r.text for r in redacted(docs([(1, "to é a.b@c.de, +49 (30) 1234567!"), (2, None)])).collect()}
    assert text == {1: "to é [email], [phone]!", 2: None}
