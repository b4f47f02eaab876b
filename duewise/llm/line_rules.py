"""Quality by lines first: failing lines go, and a document that loses too much text goes with them.

A line fails if

* punctuation: it ends in no sentence mark (closing quotes and brackets aside) and has fewer than
  ``TITLE_WORDS`` words or is mostly marks, or more than a third of its words carry symbols;
* navigation: it has three or more separators and at least one for every four words, and does not
  end like a sentence, or it consists of menu words only;
* boilerplate: it has one of the fixed phrases (rights, cookies, terms, licence) and fewer than
  ``PHRASE_WORDS`` words.

A document is kept if the base counts pass and at most ``MOST_LOST`` percent of its word characters
stand in failed lines. All counts are over the whole text; words are parted by \\x20 and \\x09-\\x0D.

Defined results: a null or empty text has no words, fails the base rule and is not kept. A line
without words neither fails nor counts. Repeated rows give the same. Other columns are neither read
nor changed. Memory is bounded by the longest text.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewise.llm.shared import ready

FEWEST_WORDS = 50
MOST_REPEATED = 50  # percent of words in repeated windows
REPEAT_WINDOW = 3
TITLE_WORDS = 8
PHRASE_WORDS = 30
MOST_LOST = 30  # percent

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_NO_SYMBOLS = bytes(b for b in range(256) if b not in b"#*$%&|<>")
_CONTINUED = bytes(range(0x80, 0xC0))  # later bytes of one code point
_CLOSERS = "\"')]}»”’"
_MARKS = tuple(".!?…:;。！？")
_SEPARATORS = re.compile(rb"[|>]|\xc2\xbb|\xe2\x80\xba|\xe2\x80\xa2|\xc2\xb7")

# Phrases of boilerplate lines and words of menus.
PHRASES = re.compile(
    rb"all rights reserved|copyright|\xc2\xa9|cookie|privacy policy|terms of (?:use|service)|licensed under|"
    rb"subscribe|sign up|log in|javascript|powered by|click here|read more",
    re.IGNORECASE,
)
MENU = frozenset(b"home about contact login register search menu next previous back top help faq news blog shop cart".split())


def line_verdict(line: bytes, words: list[bytes]) -> str | None:
    """The rule that a line with words fails, or None."""
    marked = line.decode("utf-8", "replace").rstrip(" \t\r\v\f" + _CLOSERS).endswith(_MARKS)
    separators = len(_SEPARATORS.findall(line))
    if {w.strip(b"|>.,:").lower() for w in words} <= MENU or (separators >= 3 and 4 * separators >= len(words) and not marked):
        return "navigation"
    if len(words) < PHRASE_WORDS and PHRASES.search(line):
        return "boilerplate"
    with_symbols = sum(1 for w in words if _SYMBOLS.search(w)) if _SYMBOLS.search(line) else 0
    if 3 * with_symbols > len(words) or (not marked and len(words) < TITLE_WORDS):
        return "punctuation"
    return None


def look_at_lines(text: bytes) -> tuple[dict, list[bytes]]:
    """Counts and verdict of a whole text, and the lines that stay."""
    words = text.split()
    n = len(words)
    seen, duplicates, lost, chars, stay = set(), 0, 0, 0, []
    failed = dict.fromkeys(("punctuation", "navigation", "boilerplate"), 0)
    for line in text.split(b"\n"):
        here = line.split()
        if not here:
            stay.append(line)
            continue
        if line in seen:
            duplicates += 1
        seen.add(line)
        size = sum(map(len, here)) if line.isascii() else sum(map(len, (w.translate(None, _CONTINUED) for w in here)))
        chars += size
        rule = line_verdict(line, here)
        if rule:
            failed[rule] += 1
            lost += size
        else:
            stay.append(line)
    repeated = 0
    if n >= REPEAT_WINDOW:
        windows = list(zip(*(words[k:] for k in range(REPEAT_WINDOW))))
        if len(set(windows)) < len(windows):
            once, again = set(), set()
            for w in windows:
                (again if w in once else once).add(w)
            covered = 0  # words before this place are counted
            for at, w in enumerate(windows):
                if w in again:
                    repeated += at + REPEAT_WINDOW - max(at, covered)
                    covered = at + REPEAT_WINDOW
    base_failed = n < FEWEST_WORDS or 100 * repeated > MOST_REPEATED * n
    return {
        "n_words": n,
        "word_chars": chars,
        "n_symbols": len(text.translate(None, _NO_SYMBOLS)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated,
        "base_failed": base_failed,
        "kept": not base_failed and 100 * lost <= MOST_LOST * chars,
        "lost_chars": lost,
        **{f"n_{rule}": count for rule, count in failed.items()},
    }, stay


_NUMBERS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("lost_chars", "n_punctuation", "n_navigation", "n_boilerplate")


def _looked(text: Column, with_text: bool) -> Column:
    kinds = [(c, pa.int64()) for c in _NUMBERS] + [("base_failed", pa.bool_()), ("kept", pa.bool_())] + [(c, pa.int64()) for c in _MORE]
    told = [f"{c}:{'boolean' if t == pa.bool_() else 'bigint'}" for c, t in kinds]
    if with_text:
        kinds.append(("text", pa.string()))
        told.append("text:string")

    @F.arrow_udf(f"struct<{','.join(told)}>")
    def look(texts: pa.Array) -> pa.Array:
        rows = []
        for t in pc.cast(texts, pa.binary()).to_pylist():
            row, stay = look_at_lines(t or b"")
            if with_text:
                row["text"] = None if t is None else b"\n".join(stay).decode()
            rows.append(row)
        return pa.array(rows, pa.struct(kinds))

    return look(text)


def quality_report(documents: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and how many lines failed which rule."""
    ready(documents.sparkSession)
    return documents.select("doc_id", _looked(F.col("text"), False).alias("q")).select("doc_id", "q.*")


def clean_lines(documents: DataFrame) -> DataFrame:
    """doc_id, text without the failed lines, and kept."""
    ready(documents.sparkSession)
    return documents.select("doc_id", _looked(F.col("text"), True).alias("q")).select("doc_id", "q.text", "q.kept")
