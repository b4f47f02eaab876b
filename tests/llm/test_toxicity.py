from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa

from duewise.llm import toxicity as tx
from duewise.llm.toxicity import drop_toxic, fit_toxicity, gram_counts, score_toxicity


def made(n=1200, seed=1):
    rng = random.Random(seed)
    plain = [rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice("lnrst") + rng.choice("aeiou") for _ in range(150)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                w[rng.randrange(len(w))] = "zwyk" + rng.choice(plain)[:2]
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_counts_equal_a_plain_count(spark, docs):
    rows, labels = made(60)
    wanted = {}
    for (i, text), (_, _, toxic) in zip(rows, labels):
        if zlib.crc32(str(i).encode()) % 4 in (0, 1):
            data = b"\0" * 0 + text.encode()
            padded = b" " * (tx.ORDER - 1) + data
            for k in range(len(data)):
                gram = int.from_bytes(padded[k : k + tx.ORDER], "big")
                wanted.setdefault(gram, [0, 0])[1 - toxic] += 1
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.gram: [r.toxic, r.ordinary] for r in gram_counts(docs(rows), frame).collect()}
    assert got == wanted


def test_unseen_toxic_variants_are_found_and_clean_texts_stay(spark, docs):
    rows, labels = made()
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    # Two rows that clash in every way: no label, odd texts.
    extra = [(5000, None), (5001, ""), (5002, "?"), (5003, rows[0][1]), (5003, rows[0][1])]
    found = score_toxicity(docs(rows + extra), frame).collect()
    assert len(found) == len(rows) + len(extra)
    truth = {i: t for i, _, t in labels}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    assert all(r.predicted == 0 for r in found if r.doc_id in (5000, 5001, 5002))
    kept = drop_toxic(docs(rows), frame)
    assert kept.columns == docs(rows).columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert ids == {r.doc_id for r in found if r.doc_id < 5000 and not r.predicted}


def test_held_out_labels_change_nothing(spark, docs):
    rows, labels = made(400)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    scores = []
    for given in (labels, other):
        frame = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
        scores.append({r.doc_id: r.score for r in score_toxicity(docs(rows), frame).collect()})
    assert scores[0] == scores[1]


def test_no_labels_and_no_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in score_toxicity(docs([(1, "a text"), (2, None)]), none).collect()] == [0.0, 0.0]
    assert score_toxicity(docs([(1, "a")]).limit(0), none).count() == 0


def test_long_texts_in_pieces_score_like_whole(spark, docs, monkeypatch):
    rows, labels = made(400)
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = fit_toxicity(docs(rows), frame)
    text = pa.array([" ".join(t for _, t in rows[:40]), None, "short"])
    whole = tx._evidence(text, model.known, model.context)
    monkeypatch.setattr("duewise.llm.shared.PIECE", 64)
    assert np.allclose(tx._evidence(text, model.known, model.context), whole)
