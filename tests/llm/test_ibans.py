from __future__ import annotations

import time

import pytest

from duewise.llm.personal_data import added_spans, base_spans


def ibans(text):
    return [text[a:b] for a, b, kind, _ in added_spans(text, base_spans(text)) if kind == "iban"]


@pytest.mark.parametrize("number", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"])
@pytest.mark.parametrize("after", ["", " BIC COBADEFFXXX", " 500 EUR", " I was", ", of the bank", "\nAND 12"])
def test_what_follows_a_number_does_not_lose_it(number, after):
    assert ibans(f"IBAN {number}{after}") == [number]


def test_a_rejected_start_hides_no_number():
    assert ibans("bank account AB12 DE89 3704 0044 0532 0130 00") == ["DE89 3704 0044 0532 0130 00"]
    assert ibans("IBAN DE89 3704 0044 0532 0130 01 GB82 WEST 1234 5698 7654 32") == ["GB82 WEST 1234 5698 7654 32"]
    assert ibans("IBAN DE89370400440532013000X of the bank") == []
    assert ibans("IBAN DE89 3704 0044 0532") == []


def test_many_starts_take_no_long_time():
    began = time.time()
    assert ibans("DE12 " * 40_000) == []
    assert time.time() - began < 20
