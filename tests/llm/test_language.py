from __future__ import annotations

import random
import zlib

from duewise.llm.language import family_of, identify_language
from duewise.llm.shared import table


def test_held_out_accuracy_on_the_given_table(spark, folder):
    frame = table(spark, folder.replace("0.001", "0.01"), "documents")
    truth = {r.doc_id: (r.lang, len(r.text or "")) for r in frame.collect()}
    found = identify_language(frame).collect()
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out and truth[r.doc_id][1] > 20]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) >= 0.97 * len(held)


def test_unknown_codes_odd_rows_and_nothing_to_learn(spark, docs, odd_rows):
    rng = random.Random(1)
    stems = {"xx": "kolu", "yy": "bimi", "fr": "aque"}
    rows = [(k, " ".join(stems[s] + rng.choice("abcde") for _ in range(30)), s) for k in range(200) for s in [rng.choice([*stems])]]
    frame = spark.createDataFrame([*rows, *[(i, t, None) for i, t in odd_rows]], "doc_id long, text string, lang string")
    found = identify_language(frame).collect()
    truth = {i: s for i, _, s in rows if i >= 103 or i in range(8, 100)}
    assert all(r.lang_pred == truth[r.doc_id] for r in found if r.doc_id in truth)
    letterless = {i for i, t in odd_rows if not any(c.isalpha() for c in t or "")}
    assert family_of("xx") == "other" and family_of("de") == "germanic"
    blank = docs(odd_rows, lang=(None,) * 5)
    assert {r.lang_pred for r in identify_language(blank).collect()} == {"und"}
    both = [r for r in identify_language(docs(odd_rows)).collect() if r.doc_id in letterless]
    assert both and all(r.lang_pred == "und" and r.score == 0 for r in both)
    assert identify_language(blank.limit(0)).count() == 0


def test_one_language_only(spark):
    frame = spark.createDataFrame([(k, "des mots", "fr") for k in range(9)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in identify_language(frame).collect()} == {"fr"}
