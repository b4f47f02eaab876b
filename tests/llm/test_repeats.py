from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duewise.llm import repeats as rp
from duewise.llm.shared import table


def brute(rows):
    """Windows in a dictionary, document by document in order."""
    seen, out = set(), {}
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text in order:
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i, text] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[i, t or ""]) for i, t in rows), key=str)


def got(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80).map(lambda b: bytes(x % 3 for x in b)), st.integers(2, 12))
def test_longest_previous_factors(data, length):
    data = np.frombuffer(data, np.uint8)
    at = np.arange(max(0, len(data) - length + 1))

    def common(i, j):
        k = 0
        while k < length and data[i + k] == data[j + k]:
            k += 1
        return k

    assert rp.longest_previous(data, at, length).tolist() == [max((common(i, j) for j in range(i)), default=0) for i in range(len(at))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=60))
def test_smaller_neighbours(values):
    values = np.argsort(np.argsort(values, kind="stable")).tolist()
    before, behind = rp.smaller_neighbours(values)
    for k, v in enumerate(values):
        assert before[k] == max((j for j in range(k) if values[j] < v), default=-1)
        assert behind[k] == min((j for j in range(k + 1, len(values)) if values[j] < v), default=-1)


def test_equal_windows_have_equal_anchors(monkeypatch):
    """Every window lies in one run, whatever the pieces, and equal windows in runs of one anchor."""
    monkeypatch.setattr(rp, "_CHUNK", 700)
    rng = random.Random(2)
    part = bytes(rng.randrange(97, 120) for _ in range(400))
    texts = [part, b"xy" + part[30:330] + b"tail" * 9, b"a" * 900, b"", b"short", part[100:250] + part[:180]]
    starts = np.cumsum([0] + [len(t) for t in texts])
    text, gram, _, start, windows, anchor = rp.anchored_runs(np.frombuffer(b"".join(texts), np.uint8), starts)
    anchors: dict = {}
    seen = set()
    for t, g, s, n in zip(text.tolist(), gram.tolist(), start.tolist(), windows.tolist()):
        for k in range(s, s + n):
            assert (t, k) not in seen
            seen.add((t, k))
            anchors.setdefault(texts[t][k : k + 100], set()).add(g)
    for t, s, n, a in zip(text.tolist(), start.tolist(), windows.tolist(), anchor.tolist()):
        assert n - 1 <= a <= 100 - 32  # all windows of a run hold the anchor
    assert seen == {(t, k) for t, x in enumerate(texts) for k in range(len(x) - 99)}
    assert all(len(g) == 1 for g in anchors.values())


def made_rows():
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnopéü") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    passage, line, base = words(60), words(15), words(150)
    rows = [(i, words(rng.randrange(5, 120))) for i in range(40)]
    rows += [(100 + i, words(30) + passage + words(20)) for i in range(12)]
    rows += [(200 + i, words(12) + "\n" + line + "\n" + words(12)) for i in range(30)]
    rows += [(300 + i, base) for i in range(6)]
    rows += [(400 + i, base[: 200 + 17 * i] + words(3) + base[200 + 17 * i :]) for i in range(12)]
    rows += [(500, "z" * 3000), (501, "z" * 150 + words(4)), (502, (line + "\n") * 40), (503, "ab" * 700), (504, base[:99]), (505, base[:100]), (506, base[1:101])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [20_000, 8])
def test_made_rows(spark, docs, monkeypatch, hot):
    monkeypatch.setattr(rp, "HOT_RUNS", hot)
    monkeypatch.setattr(rp, "SORTED_ROWS", 50)
    rows = made_rows() + [(None, None), (600, ""), (601, None)]
    assert got(rp.repeat_report(docs(rows))) == brute(rows)


def test_repeated_rows_and_ids(spark, docs):
    text = "one text of more than a hundred bytes, which stands in several rows of this table, and twice in one of them. "
    rows = [(1, text), (1, text), (2, text), (2, text), (3, text * 3), (None, text[:105]), (None, text[:105])]
    assert got(rp.repeat_report(docs(rows))) == brute(rows)
    both = got(rp.repeat_report(docs([(7, text + "first"), (7, text + "second")])))
    assert sorted(r[2] for r in both) == [0, len(text)]


def test_odd_rows(spark, docs, odd_rows):
    assert got(rp.repeat_report(docs(odd_rows))) == brute(odd_rows)
    assert rp.repeat_report(docs([(1, "x")]).limit(0)).collect() == []


def test_kept_bytes(spark, docs):
    rows = made_rows()
    result = rp.without_repeats(docs(rows)).collect()
    wanted = {r[0]: r[4] for r in brute(rows)}
    assert len(result) == len(rows) and result[0].size == "s"
    assert {r.doc_id: hashlib.sha256(r.kept).hexdigest() for r in result} == wanted


def test_given_table(spark, folder):
    docs = table(spark, folder, "documents")
    assert got(rp.repeat_report(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])
