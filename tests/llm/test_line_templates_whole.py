from __future__ import annotations

import random
import re
from collections import defaultdict

from duewise.llm import line_templates as lt
from duewise.llm.line_templates import drop_recurring_lines


def tokens(line):
    return tuple("<*>" if re.search("[0-9@/]", t) else t for t in line.split())


def brute(rows):
    """How many lines of each document go, by one template after another, with no limit."""
    leaves = defaultdict(lambda: defaultdict(set))
    for k, (_, text) in enumerate(rows):
        for line in map(tokens, text.split("\n")):
            if len(line) >= lt.FEWEST_TOKENS:
                leaves[len(line), line[: lt.LEADING]][line].add(k)
    gone = set()
    for rest in leaves.values():
        while rest:
            template = max(rest, key=lambda m: (len(rest[m]), " ".join(m).encode()))
            inside = {m for m in rest if sum(a == b for a, b in zip(m, template)) >= lt.SIMILAR * len(m)}
            if len(set().union(*(rest[m] for m in inside))) >= lt.RECURRING:
                gone |= inside
            rest = {m: d for m, d in rest.items() if m not in inside}
    return sorted((i, sum(tokens(line) in gone for line in text.split("\n"))) for i, text in rows)


def got(frame):
    return sorted((r.doc_id, r.n_dropped) for r in drop_recurring_lines(frame).collect())


def test_every_template_of_a_crowded_leaf_is_dropped(spark, docs, monkeypatch):
    rng = random.Random(5)
    words = [a + b for a in "bdfgklmn" for b in ("ab", "ec", "ol", "um")]
    kinds = [[rng.choice(words) for _ in range(9)] for _ in range(60)]
    rows = []
    for k, kind in enumerate(kinds):
        for _ in range(1 + k % 5):
            line = list(kind)
            line[k % 9] = "x" + rng.choice(words) + rng.choice(words)
            rows.append((len(rows), " ".join(["we", "use", "cookies", *line])))
    rng.shuffle(rows)
    wanted = brute(rows)
    assert sum(n for _, n in wanted) > 100
    assert got(docs(rows)) == wanted
    monkeypatch.setattr(lt, "AT_ONCE", 8)
    monkeypatch.setattr(lt, "MOST_AT_ONCE", 16)
    assert got(docs(rows)) == wanted


def test_similar_lines_of_one_document_are_one_document(spark, docs):
    refrain = "\n".join(f"We thank our dear reader {name} for the kind letter" for name in ("Ann", "Bob", "Cy", "Dee"))
    rows = [(1, refrain), (2, "We thank our dear reader Eve for the kind letter"), (3, "nothing else is here to see")]
    assert got(docs(rows)) == brute(rows) == [(1, 0), (2, 0), (3, 0)]
    rows.append((4, "We thank our dear reader Fay for the kind letter"))
    assert got(docs(rows)) == brute(rows) == [(1, 4), (2, 1), (3, 0), (4, 1)]


def test_short_lines_of_many_documents_go(spark, docs):
    n = lt.SHORT_RECURRING
    rows = [(k, f"Word{'abcdefghijklm'[k]} alone\nAll  rights reserved.\nPage {k}\n{k}\n\n" + ("Read more" if k else "Read")) for k in range(n)]
    found = {r.doc_id: r for r in drop_recurring_lines(docs(rows)).collect()}
    # 'Read more' stands in one document too few, and a number says nothing.
    assert [found[k].text for k in (0, 3)] == ["Worda alone\n0\n\nRead", "Wordd alone\n3\n\nRead more"]
    assert all(found[k].n_dropped == 2 for k in range(n))
