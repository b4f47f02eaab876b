from __future__ import annotations

import random
import zlib

import numpy as np

from duewise.llm.co_training import co_train, score_quality, _logit
from duewise.llm.shared import table


def test_views_teach_each_other():
    rng = np.random.default_rng(2)
    y = (rng.random(4000) < 0.5).astype(float)
    one = y[:, None] * 2 + rng.normal(size=(4000, 3))
    two = y[:, None] * 2 + rng.normal(size=(4000, 3))
    models = co_train([one[:12], two[:12]], y[:12], [one[12:2000], two[12:2000]])
    alone = co_train([one[:12], two[:12]], y[:12], [one[:0], two[:0]])
    right = [np.mean((_logit(m, v[2000:]) > 0) == y[2000:]) for m, v in zip(models, (one, two))]
    before = [np.mean((_logit(m, v[2000:]) > 0) == y[2000:]) for m, v in zip(alone, (one, two))]
    assert min(right) > 0.9 and sum(right) >= sum(before) - 0.02


def test_held_out_accuracy_on_the_given_table(spark, folder):
    big = folder.replace("0.001", "0.1")
    frame, labels = table(spark, big, "documents"), table(spark, big, "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    found = score_quality(frame, labels).collect()
    assert len(found) == frame.count()
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    worst = [sum(r.predicted == truth[r.doc_id] for r in held if truth[r.doc_id] == c) / sum(truth[r.doc_id] == c for r in held) for c in (0, 1)]
    assert min(worst) > 0.8, worst


def test_odd_rows_and_no_labels(spark, docs, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in score_quality(docs(odd_rows), none).collect()} == {0.5}
    rng = random.Random(1)
    rows = [*odd_rows, *[(1000 + k, "good words of text. " * 9 if k % 2 else "BAD!! ## " * 20) for k in range(300)]]
    labels = spark.createDataFrame([(1000 + k, k % 2, 0) for k in range(200)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    found = score_quality(docs(rows), labels).collect()
    assert len(found) == len(rows)
    assert all(r.predicted == (r.doc_id % 2) for r in found if r.doc_id and r.doc_id >= 1000)
    assert score_quality(docs(rows).limit(0), labels).count() == 0
    del rng
