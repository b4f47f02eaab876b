from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from duewise.llm import toxicity as tx


@pytest.mark.parametrize("rows", [1 << 20, 3_000])
def test_every_counted_gram_has_its_own_ratio_and_no_other_has_one(spark, monkeypatch, rows):
    # 20,000 n-grams: some dozens of pairs agree in any 22 bits.
    monkeypatch.setattr(tx, "SHARD_ROWS", rows)
    rng = random.Random(7)
    grams = sorted({rng.getrandbits(48) for _ in range(40_000)})
    counted, strangers = grams[::2], grams[1::2]
    data = [(g, rng.randrange(3), 1 + rng.randrange(50)) for g in counted]
    counts = spark.createDataFrame(data, "gram long, toxic long, ordinary long")
    wanted = {r.gram: r.ratio for r in tx._ratios(counts).collect()}
    known, context = tx._comparison(counts)
    assert (known.bits > 0) == (rows < len(counted))
    got = known.look(np.array(counted))
    assert np.allclose(got, np.array([wanted[g] for g in counted], np.float32))
    assert np.isnan(known.look(np.array(strangers))).all()
    contexts = {g >> 8 for g in counted}
    found = context.look(np.array([g >> 8 for g in grams]))
    assert [not np.isnan(v) for v in found] == [g >> 8 in contexts for g in grams]


def test_shards_that_do_not_fit_a_worker_score_alike(spark, docs, monkeypatch):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("aeioubcd") * rng.randrange(1, 5) + rng.choice("xyz") for _ in range(80))) for i in range(300)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    texts = pa.array([t for _, t in rows[:50]] + [None, ""])
    found = []
    for shard_rows in (1 << 20, 500):
        monkeypatch.setattr(tx, "SHARD_ROWS", shard_rows)
        model = tx.fit_toxicity(docs(rows), labels)
        found.append(tx._evidence(texts, model.known, model.context))
    assert 1 << model.known.bits > tx.KEPT and len(tx._loaded) <= tx.KEPT
    assert np.allclose(found[0], found[1])
