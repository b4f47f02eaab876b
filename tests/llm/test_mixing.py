from __future__ import annotations

import hashlib
import math
import random

import pytest

from duewise.llm.mixing import mix, mixed_documents
from duewise.llm.shared import table


def sizes(text):
    return len((text or "").encode().split())


def brute(rows):
    """From (doc_id, source, size): targets by filling, then a walk in hash order."""
    by = {}
    for i, source, n in rows:
        by.setdefault(source, []).append((i, n))
    names = sorted((s for s in by if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in by else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total = {s: sum(n for _, n in by[s]) for s in names}
    left, open_, target = 1.5 * sum(total.values()), set(names), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * per > 2 * total[s]}
        if not full:
            target |= {s: weight[s] * per for s in open_}
            break
        for s in full:
            target[s] = 2.0 * total[s]
            left -= target[s]
        open_ -= full
    out = []
    for s in names:
        budget = math.floor(target[s] + 1e-9)
        rounds = budget // total[s] if total[s] else 0
        rest = budget - rounds * total[s]
        key = lambda d: (hashlib.md5(f"mix-{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[0] is not None, d[0] or 0, d[1])
        for i, n in sorted(by[s], key=key):
            part = min(n, rest)
            rest -= part
            out.append((i, n, total[s], round(target[s], 4), rounds * n + part))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 4), r.taken) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("sources", [["a"], ["a", "b", None], ["Z", "a", "é", "zz", "ﬀ", "𝒳", None, "b"]])
def test_against_a_walk(spark, sources):
    rng = random.Random(len(sources))
    rows = [(k, "w " * rng.choice([0, 1, 5, 40]), rng.choice([*sources, sources[0], sources[0]])) for k in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert got(mix(frame)) == brute([(i, s, sizes(t)) for i, t, s in rows])


def test_given_table_and_targets_are_met(spark, folder):
    frame = table(spark, folder, "documents")
    found = got(mix(frame))
    assert found == brute([(r.doc_id, r.source, sizes(r.text)) for r in frame.collect()])
    assert all(t <= 2 * n for _, n, _, _, t in found)


def test_odd_rows_and_empty_table(spark, docs, odd_rows):
    frame = docs(odd_rows)
    found = mix(frame).collect()
    assert len(found) == len(odd_rows) and sum(r.taken for r in found) > 0
    assert all(r.taken == 0 for r in found if r["size"] == 0)
    assert mix(frame.limit(0)).count() == 0 and mixed_documents(frame.limit(0)).count() == 0


def test_the_stage_repeats_documents_as_taken(spark, docs, odd_rows):
    frame = docs([(k, "w " * (k % 7)) for k in range(100)])
    wanted = {}
    for r in mix(frame).collect():
        wanted[r.doc_id] = math.ceil(r.taken / r["size"]) if r["size"] else 0
    out = mixed_documents(frame)
    assert out.columns == frame.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in wanted.items() if n}


def test_the_stage_takes_copies_each_for_itself(spark):
    rows = [(k % 40, "w " * 5, "abc"[k // 40], f"row {k}") for k in range(120)] + [(None, "w w", "a", "x"), (None, "w w", "a", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, mark string")
    out = mixed_documents(frame)

    def rows_of(found):
        return sorted((-1 if i is None else i, n) for i, n in found)

    taken = rows_of((r.doc_id, math.ceil(r.taken / r["size"])) for r in mix(frame).collect() if r.taken)
    assert out.count() == sum(n for _, n in taken)
    assert rows_of((r.doc_id, r["count"]) for r in out.groupBy("doc_id", "mark").count().collect()) == taken
