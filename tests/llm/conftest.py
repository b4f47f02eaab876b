from __future__ import annotations

import pytest

ODD = [None, "", " ", "\n\n", "x", "Ünïcode wörds", "a b c d", "one two three four five"]


@pytest.fixture
def docs(spark):
    """A frame of documents from (doc_id, text) with further columns whose names clash with results."""

    def make(rows, **more):
        full = [
            (i, t, more.get("lang", ("en", "de", "fr", "es", None))[k % 5], ("s0", "s1", None)[k % 3], None if t is None else len(t), 7.0, "s", 3)
            for k, (i, t) in enumerate(rows)
        ]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, score double, size string, node int"
        )

    return make


@pytest.fixture
def odd_rows():
    long = " ".join(f"word{i % 997} of a long text." for i in range(30_000))
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, long), (101, long), (102, "same text twice over here"), (102, "same text twice over here"), (None, "no id at all")]
    return rows
