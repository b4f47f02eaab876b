from __future__ import annotations

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from duewise.llm import token_files as tf
from duewise.llm.shared import table


def brute(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tf.default_tokenizer())
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=lambda r: r[1])


def got(frame):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frame.collect()), key=lambda r: r[1])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=300))
def test_elias_fano_round_trip_and_select(values):
    values = np.sort(np.array(values, np.int64))
    bits, low, high, marks = tf.ef_encode(values)
    assert (tf.ef_decode(len(values), bits, low, high) == values).all()
    assert [tf.ef_select(k, bits, low, high, marks) for k in range(len(values))] == values.tolist()


def test_space_is_near_minimal():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    bits, low, high, _ = tf.ef_encode(values)
    assert 8 * (len(low) + len(high)) / len(values) < 2.1 + np.log2(1000)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t.'sé€  \0,1", max_size=60))
def test_pieces_encode_like_whole_texts(text):
    held = tf.encoder(tf.default_tokenizer())
    ids = held.tokenizer.encode(text, add_special_tokens=False).ids
    assert held.encode([text]) == [np.array([*ids, 0], held.kind).tobytes()]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tf, "MEMORY", 50)
    held, rng = tf.PieceEncoder(tf.default_tokenizer()), random.Random(1)
    for _ in range(30):
        texts = [" ".join(f"w{rng.randrange(400)}." for _ in range(20)) for _ in range(3)]
        for text, coded in zip(texts, held.encode(texts)):
            assert coded == np.array(held.tokenizer.encode(text).ids + [0], held.kind).tobytes()
    assert len(held.known) < 250


def test_odd_rows_in_small_blocks(spark, docs, odd_rows, tmp_path):
    tf.write_token_files(docs(odd_rows), str(tmp_path / "t"), block_ids=20)
    assert got(tf.read_token_files(spark, str(tmp_path / "t"))) == brute(odd_rows)
    assert spark.read.parquet(str(tmp_path / "t" / "blocks")).count() > 3


def test_given_table_and_empty_table(spark, folder):
    frame = table(spark, folder, "documents")
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    assert got(tf.token_files(frame)) == brute(rows)
    assert tf.token_files(frame.limit(0)).count() == 0


def test_ids_come_back(spark, docs, tmp_path):
    tf.write_token_files(docs([(2, "two words"), (1, "one"), (-5, None)]), str(tmp_path / "t"))
    ids = {r.doc_id: r.ids for r in tf.read_texts_ids(spark, str(tmp_path / "t")).collect()}
    held = tf.encoder(tf.default_tokenizer()).tokenizer
    assert ids == {-5: [0], 1: held.encode("one").ids + [0], 2: held.encode("two words").ids + [0]}
