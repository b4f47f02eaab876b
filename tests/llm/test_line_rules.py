from __future__ import annotations

import re

import pytest

from duewise.llm.line_rules import clean_lines, line_verdict, quality_report
from duewise.llm.shared import table

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = _WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if _WORD.search(line):
            dup += line in seen
            seen.add(line)
    counts, repeated = {}, set()
    for k in range(len(words) - 2):
        counts.setdefault(tuple(words[k : k + 3]), []).append(k)
    for places in counts.values():
        if len(places) > 1:
            for k in places:
                repeated |= {k, k + 1, k + 2}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), n < 50 or 100 * len(repeated) > 50 * n)


def got(frame):
    return [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in quality_report(frame).collect()]


def test_base_counts_of_the_given_table(spark, folder):
    frame = table(spark, folder, "documents")
    assert sorted(got(frame)) == sorted((r.doc_id, brute(r.text)) for r in frame.collect())
    found = quality_report(frame)
    assert found.where("kept and base_failed").count() == 0 and found.where("kept").count() > 0


def test_odd_rows(spark, docs, odd_rows):
    rows = [*odd_rows, (7, "a b c a b c\na b c\r\nü ü \x0b x"), (8, "a\n a\na \na\n")]
    assert sorted(got(docs(rows)), key=repr) == sorted(((i, brute(t)) for i, t in rows), key=repr)
    assert quality_report(docs(rows).limit(0)).count() == 0


@pytest.mark.parametrize("line, rule", [
    ("This is a plain sentence that ends well.", None),
    ("Home | About | Contact | Login", "navigation"),
    ("All rights reserved by us.", "boilerplate"),
    ("Buy now", "punctuation"),
    ("He said \"yes.\"", None),
    ("in*** the### of&&& and$$$ so.***", "punctuation"),
    ("home about contact", "navigation"),
    ("a long heading of many plain words without a closing mark", None),
])
def test_rules(line, rule):
    assert line_verdict(line.encode(), line.encode().split()) == rule


def test_cleaning_drops_failed_lines_and_documents_that_lose_much(spark, docs):
    good = "\n".join(" ".join(f"word{k}{j}" for j in range(9)) + " ends." for k in range(8))
    rows = {r.doc_id: (r.text, r.kept) for r in clean_lines(docs([(1, good + "\nHome | About | Contact | Login"), (2, good.replace(" ", "*** ") + "***"), (3, None)])).collect()}
    assert rows[1] == (good, True) and rows[2][1] is False and rows[3] == (None, False)
