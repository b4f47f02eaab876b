from __future__ import annotations

import random

import pytest

from duewise.llm import near_duplicates as nd
from duewise.llm.components import connected_components
from duewise.llm.near_duplicates import drop_near_duplicates, near_duplicates, shingles_of, words_of
from duewise.llm.shared import table


def brute(rows):
    sets = {}
    for i, t in rows:
        sets[i] = set(shingles_of(words_of((t or "").encode())).tolist())
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= 85 * max(len(x), len(y)):
                shared = len(x & y)
                if 100 * shared >= 85 * (len(x) + len(y) - shared):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def got(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in frame.collect()}


def copies(rng, words, share):
    out = list(words)
    for k in range(len(out)):
        if rng.random() < share:
            out[k] = f"new{rng.random()}"
    return " ".join(out)


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force_with_chains_and_stars(spark, docs, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rng = random.Random(5)
    rows = []
    for g in range(6):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(40 if g < 2 else 6):
            rows.append((len(rows), copies(rng, base, rng.choice([0.0, 0.004, 0.01, 0.02, 0.03, 0.05]))))
        chain = list(base)
        for _ in range(6):
            chain[rng.randrange(len(chain))] = f"c{rng.random()}"
            rows.append((len(rows), " ".join(chain)))
    assert got(near_duplicates(docs(rows))) == brute(rows)


def test_words_split_lower_and_odd_rows(spark, docs, odd_rows):
    found = near_duplicates(docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by = {r.doc_id: r for r in found}
    assert by[0].n_shingles == 0 and by[0].component_id == 0 and by[0].kept
    assert by[3].n_shingles == 0 and by[4].n_shingles == 1
    assert by[101].component_id == 100 and not by[101].kept
    assert [r.kept for r in found if r.doc_id == 102] == [True, True]
    assert by[None].component_id is None and by[None].kept


def test_stage_keeps_one_of_each_group_and_all_columns(spark, docs, odd_rows):
    frame = docs(odd_rows)
    kept = drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == sorted((i is None, i or 0) for i in {r[0] for r in odd_rows} - {101})


def test_empty_table(spark, docs):
    frame = docs([(1, "a")]).limit(0)
    assert near_duplicates(frame).count() == 0 and drop_near_duplicates(frame).count() == 0


def test_given_table_against_brute_force(spark, folder):
    frame = table(spark, folder, "documents")
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    assert got(near_duplicates(frame)) == brute(rows)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5, 5)]
    frame = spark.createDataFrame(random.Random(2).sample(edges, len(edges)), "a long, b long")
    roots = {r.node: r.root for r in connected_components(frame).collect()}
    assert roots == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1300)}
    assert connected_components(frame.limit(0)).count() == 0
