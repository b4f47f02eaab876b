from __future__ import annotations

import hashlib
import random
import re

import pytest

from duewise.llm.decontamination import _scan, build, contamination_report, drop_contaminated, remove_spans
from duewise.llm.shared import table

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    windows = {}
    for name, text in items:
        w = words(text)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(name))
    sizes = {len(k) for k in windows}
    out = []
    for i, text in rows:
        w, hit, names = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[k : k + size]))) is not None:
                    hit.update(range(k, k + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("block_words", [50_000, 10])
def test_against_brute_force_on_a_small_alphabet(spark, docs, block_words):
    rng = random.Random(3)
    letters = [f"w{k}" for k in range(4)]
    items = [(k, " ".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 8, 12, 13, 14, 20, 40])))) for k in range(25)]
    items += [(90, items[0][1]), (91, None), (92, "...")]
    rows = []
    for k in range(60):
        w = [rng.choice(letters + ["other"]) for _ in range(rng.randrange(80))]
        _, text = rng.choice(items)
        at = rng.randrange(len(w) + 1)
        w[at:at] = (text or "").split()[rng.randrange(4) :]
        rows.append((k, " ".join(w).replace(" w1 ", " W1, ")))
    frame, bench = docs(rows), spark.createDataFrame(items, "item_id long, text string")
    assert got(contamination_report(frame, bench, block_words=block_words)) == brute(rows, items)


def test_given_tables(spark, folder):
    frame, bench = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    assert got(contamination_report(frame, bench)) == brute(rows, items)


def test_odd_rows_and_no_items(spark, docs, odd_rows):
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    frame = docs(odd_rows)
    assert got(contamination_report(frame, bench)) == brute(odd_rows, [(1, "a b c d")])
    assert got(contamination_report(frame, bench.limit(0))) == brute(odd_rows, [])
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns and kept.count() == len(odd_rows) - 1
    assert contamination_report(frame.limit(0), bench).count() == 0


def test_spans_are_cut_out(spark, docs):
    item = " ".join(f"q{k}" for k in range(13))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    frame = docs([(1, f"Before, {item.upper()}! after"), (2, "clean text"), (3, None)])
    rows = {r.doc_id: (r.text, r.removed) for r in remove_spans(frame, bench).collect()}
    assert rows == {1: ("Before, ! after", 13), 2: ("clean text", 0), 3: (None, 0)}


def test_items_without_an_id(spark, docs):
    words = " ".join(f"w{k}" for k in range(15))
    other = " ".join(f"v{k}" for k in range(15))
    schema = "item_id string, text string"
    frame = docs([(1, words), (2, other + " " + words), (3, "nothing here")])
    both = spark.createDataFrame([(None, words), ("b", other), (None, other)], schema)
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256) for r in contamination_report(frame, both).collect()}
    empty, named = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"b").hexdigest()
    assert got == {1: (15, 1, empty), 2: (30, 2, named), 3: (0, 0, empty)}
    alone = spark.createDataFrame([(None, words)], schema)
    assert {r.doc_id: (r.n_hit, r.n_items) for r in contamination_report(frame, alone).collect()} == {1: (15, 1), 2: (15, 1), 3: (0, 0)}
    assert {r.doc_id for r in drop_contaminated(frame, alone).collect()} == {3}


def test_repeated_words_take_linear_time():
    def steps(n):
        found, looks = build([("a", b"a " * n)]), 0

        class Links(list):
            def __getitem__(self, k):
                nonlocal looks
                looks += 1
                return super().__getitem__(k)

        found.link = Links(found.link)
        spans, names = _scan([b"a"] * (5 * n), found, 13)
        assert spans == [(0, 5 * n)] and names == {"a"}
        return looks

    assert steps(2_000) < 2.2 * steps(1_000)
