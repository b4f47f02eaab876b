from __future__ import annotations

import re
from collections import Counter, defaultdict

from duewise.llm import line_templates as lt
from duewise.llm.line_templates import drop_recurring_lines
from duewise.llm.shared import table


def tokens(line):
    return ["<*>" if re.search("[0-9@/]", t) else t for t in re.split(r"[\x09-\x0D ]+", line) if t]


def brute(rows):
    """(doc_id, text, n_lines, n_dropped) by the same tree, walked in plain code."""
    leaves = defaultdict(Counter)
    for _, text in rows:
        for masked in {tuple(tokens(line)) for line in (text or "").split("\n")} if text is not None else ():
            if len(masked) >= lt.FEWEST_TOKENS:
                leaves[len(masked), masked[: lt.LEADING]][masked] += 1
    gone = set()
    for lines in leaves.values():
        rest = dict(lines)
        for _ in range(lt.ROUNDS):
            if sum(rest.values()) < lt.RECURRING:
                break
            template = max(rest, key=lambda m: (rest[m], " ".join(m).encode()))
            inside = {m for m in rest if sum(a == b for a, b in zip(m, template)) >= lt.SIMILAR * len(m)}
            if sum(rest[m] for m in inside) >= lt.RECURRING:
                gone |= inside
            rest = {m: n for m, n in rest.items() if m not in inside}
        gone |= {m for m, n in rest.items() if n >= lt.RECURRING}
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        lines = text.split("\n")
        stay = [line for line in lines if tuple(tokens(line)) not in gone]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in drop_recurring_lines(frame).collect()), key=repr)


def test_given_table_against_plain_code(spark, folder):
    frame = table(spark, folder, "documents")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    found = got(frame)
    assert found == brute(rows) and sum(r[3] for r in found) > 0


def test_variable_fields_and_odd_rows(spark, docs, odd_rows):
    rows = [*odd_rows]
    for k in range(5):
        rows.append((200 + k, f"Unique words {'abcde'[k]} here {'xyzuv'[k]} stay.\nUser no {k}77 logged in from host h{k} at the desk today\n\nshort line"))
    rows += [(300 + k, f"We thank our dear reader {name} for the kind letter of today") for k, name in enumerate(("Ann", "Bob", "Cy"))]
    found = got(docs(rows))
    assert found == brute(rows)
    by = {r[0]: r for r in found}
    assert by[200][1] == "Unique words a here x stay.\n\nshort line" and by[200][3] == 1
    assert by[301][1] == "" and by[0][1:] == (None, 0, 0)
    assert drop_recurring_lines(docs(rows).limit(0)).count() == 0


def test_no_python_in_the_plan(spark, docs):
    plan = drop_recurring_lines(docs([(1, "a b c d e")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
