from __future__ import annotations

import numpy as np
import pyarrow as pa

from duewise.llm.shared import flat_bytes, padded_pieces, sifted


def test_sieve_lets_every_wanted_key_and_null_through(spark):
    rows = spark.range(5000).selectExpr("id AS doc_id", "'t' AS text").unionByName(spark.createDataFrame([(None, "t")], "doc_id long, text string"))
    wanted = spark.range(0, 5000, 7).toDF("k")
    left = sifted(rows, "doc_id", wanted)
    got = {r.doc_id for r in left.collect()}
    assert left.columns == rows.columns and {None, *range(0, 5000, 7)} <= got and len(got) < 800
    assert {r.doc_id for r in sifted(rows, "doc_id", wanted.limit(0)).collect()} == {None}


def test_pieces_cover_every_byte_once_with_what_precedes_it(monkeypatch):
    monkeypatch.setattr("duewise.llm.shared.PIECE", 5)
    data, starts = flat_bytes(pa.array(["abcdefghijkl", None, "", "xyz"]).slice(0))
    assert starts.tolist() == [0, 12, 12, 12, 15]
    seen = {}
    for packed, rows, begins, ends in padded_pieces(data, starts, 3, most=9):
        for row, a, b in zip(rows, begins, ends):
            seen.setdefault(row, []).append((bytes(packed[a - 3 : a]), bytes(packed[a:b])))
    assert seen == {0: [(b"   ", b"abcde"), (b"cde", b"fghij"), (b"hij", b"kl")], 3: [(b"   ", b"xyz")]}
    assert np.array_equal(flat_bytes(pa.array(["ab", "cd"]).slice(1))[0], np.frombuffer(b"cd", np.uint8))
