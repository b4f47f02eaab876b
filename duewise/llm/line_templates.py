"""Line dedup by a log-template tree of fixed depth, in DataFrame functions only.

The tree's levels are a line's number of tokens and its ``LEADING`` first tokens, in which tokens
with digits, at signs or slashes count as a variable field ``<*>`` from the start. A leaf holds
the lines of one length and beginning. Its most frequent line (after masking) becomes a template;
lines that equal it in at least ``SIMILAR`` of their tokens belong to it, their other tokens being
variable fields too. What does not belong forms the leaf's next templates the same way, until the
lines left in a leaf together stand in too few documents to recur. Each round places the templates
among a leaf's ``AT_ONCE`` most frequent lines (twice as many in every next round, up to ``MOST_AT_ONCE``),
which gives the same as one template after another. A template that stands in ``RECURRING`` or more
documents is dropped wherever it occurs.

A line of fewer than ``FEWEST_TOKENS`` tokens is too short for variable words: it is a leaf of its own
and dropped if it stands in ``SHORT_RECURRING`` or more documents, unless it is nothing but fields.
Documents of a template are counted once, however many of its lines they hold. Lines are counted
once per document and masked form before anything is shuffled together, so a hot line
is one row per task; leaves whose lines together stand in fewer than ``RECURRING`` documents never leave
the first count.

Defined results: a null text stays null with 0 lines; an empty text has one line without tokens.
Blank lines stay. Repeated rows count as documents of their own. A null doc_id is allowed. Other
columns are neither read nor changed.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewise.session import staged

LEADING = 3
SIMILAR = 0.8
ROUNDS = sys.maxsize  # no limit: they end when no leaf can hold a further recurring template
AT_ONCE, MOST_AT_ONCE = 16, 512
RECURRING = 3
FEWEST_TOKENS = 4
SHORT_RECURRING = 10
_SPACE = r"[\x09\x0B-\x0D ]+"
_RARE_SPACE = ("\t", "\x0b", "\x0c", "\r", "  ", " \n", "\n ")
# A token with a digit, an at sign or a slash; no position is tried twice, however long a token is.
_FIELD = r"(?<![^ \n])[^ \n0-9@/]*+[0-9@/][^ \n]*+"


def masked_lines(text: Column) -> Column:
    """Of each line of a text its tokens with one space between them, variable fields masked.

    Whole texts are rewritten before they are cut into lines, and only those that need it, which a look at their characters tells.
    """
    rare = F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    for signs in _RARE_SPACE:
        rare = rare | F.contains(text, F.lit(signs))
    once = F.regexp_replace(text, _SPACE, " ")
    edged = F.replace(F.replace(once, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    spaced = F.when(rare, F.trim(edged)).otherwise(text)
    masked = F.when(F.rlike(text, F.lit("[0-9@/]")), F.regexp_replace(spaced, _FIELD, "<*>")).otherwise(spaced)
    return F.split(masked, "\n")


def _says_something(masked: Column) -> Column:
    return F.trim(F.replace(masked, F.lit("<*>"), F.lit(""))) != ""


def _line_keys(text: Column) -> Column:
    """Per line of a text: number, masked line and leaf, which holds all tokens of a short one; lines of fields only must be long."""
    lines = F.transform(masked_lines(text), lambda line, i: F.struct(i.alias("n"), line.alias("masked")))
    sized = F.transform(lines, lambda s: F.struct(
        s["n"].alias("n"), s["masked"].alias("masked"),
        (F.octet_length(s["masked"]) - F.octet_length(F.replace(s["masked"], F.lit(" "), F.lit(""))) + 1).alias("tokens"),
    ))
    return F.transform(F.filter(sized, lambda s: (s["tokens"] >= FEWEST_TOKENS) | _says_something(s["masked"])), lambda s: F.struct(
        s["n"].alias("n"), s["masked"].alias("masked"),
        F.xxhash64(s["tokens"], F.substring_index(s["masked"], " ", LEADING)).alias("leaf"),
    ))


def _similar(one: Column, two: Column) -> Column:
    """Whether two arrays of as many tokens are the same line but for variable fields."""
    same = F.aggregate(F.zip_with(one, two, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return same >= SIMILAR * F.size(one)


def _templates(ranked: Column) -> Column:
    """Of lines in order of rank (arrays of tokens), those that resemble none before them."""
    return F.aggregate(
        ranked, F.array().cast("array<array<string>>"),
        lambda kept, line: F.when(F.exists(kept, lambda t: _similar(line, t)), kept).otherwise(F.array_append(kept, line)),
    )


def _keys(masked: Column) -> list[Column]:
    """128 bits that stand for a masked line."""
    return [F.xxhash64(masked).alias("k1"), F.xxhash64(masked, F.lit("second")).alias("k2")]


def recurring_lines(lines: DataFrame) -> DataFrame:
    """The keys (k1, k2) of masked lines whose template recurs.

    ``lines`` has one row per document and distinct masked line: row (a number of the document's),
    leaf, masked. Below RECURRING = 3 documents, the least and the greatest number are all of a line's.
    """
    leaves = lines.groupBy("leaf").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= RECURRING).select("leaf")
    counted = lines.groupBy("leaf", "masked").agg(
        F.count(F.lit(1)).alias("docs"), F.min("row").alias("low"), F.max("row").alias("high")
    )
    in_leaves = staged(counted.join(leaves, "leaf", "left_semi"), "leaf_lines")
    short = F.size(F.split("masked", " ", FEWEST_TOKENS)) < FEWEST_TOKENS
    found, at_once = [in_leaves.where(short & (F.col("docs") >= SHORT_RECURRING)).select(*_keys(F.col("masked")))], AT_ONCE
    open_lines = in_leaves.where(~short)
    rank = Window.partitionBy("leaf").orderBy(F.desc("docs"), F.desc("masked"))
    for _ in range(ROUNDS):
        if open_lines.isEmpty():
            break
        first = open_lines.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= at_once)
        best = first.groupBy("leaf").agg(F.array_sort(F.collect_list(F.struct("rank", "masked"))).alias("ranked")).select(
            "leaf", _templates(F.transform("ranked", lambda r: F.split(r["masked"], " "))).alias("templates")
        )
        # The tokens are split once per line; 0 is no template.
        of = F.transform(F.array(F.split("masked", " ")), lambda line: F.coalesce(
            F.array_position(F.transform("templates", lambda t: _similar(line, t)), True), F.lit(0)
        ))
        placed = staged(open_lines.join(best, "leaf").select("leaf", "masked", "docs", "low", "high", F.element_at(of, 1).alias("template")), "placed")
        inside = placed.where("template > 0")
        standing = inside.select("leaf", "template", "docs", F.explode(F.array("low", "high")).alias("row"))
        recurs = (
            standing.groupBy("leaf", "template", "row").agg(F.max("docs").alias("docs"))
            .groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("n"), F.max("docs").alias("docs"))
            .where(F.greatest("n", "docs") >= RECURRING)
        )
        found.append(staged(inside.join(recurs, ["leaf", "template"], "left_semi").select(*_keys(F.col("masked"))), "found"))
        rest = placed.where("template = 0").select("leaf", "masked", "docs", "low", "high")
        still = rest.groupBy("leaf").agg(F.sum("docs").alias("n")).where(F.col("n") >= RECURRING)
        open_lines = staged(rest.join(still, "leaf", "left_semi"), "leaf_lines")
        at_once = min(2 * at_once, MOST_AT_ONCE)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def drop_recurring_lines(documents: DataFrame) -> DataFrame:
    """doc_id, text without recurring lines, n_lines and n_dropped, one row per row of ``documents``."""
    rows = documents.select("doc_id", "text")
    known = rows.where("text is not null")
    once = F.array_distinct(F.transform(_line_keys(F.col("text")), lambda s: F.struct(s["leaf"].alias("leaf"), s["masked"].alias("masked"))))
    numbered = known.withColumn("row", F.monotonically_increasing_id())  # before the lines are listed, else they are numbered
    lines = numbered.select("row", F.explode(once).alias("l")).select("row", "l.leaf", "l.masked")
    hot = staged(recurring_lines(lines), "recurring")
    # Only numbers and keys of lines travel; the texts join once, with the numbers of their lines that go.
    marks = F.transform(_line_keys(F.col("text")), lambda s: F.struct(s["n"].alias("n"), *_keys(s["masked"])))
    at = known.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("of_text"), F.explode(marks).alias("l"))
    gone = (
        at.select("_id", "of_text", "l.n", "l.k1", "l.k2")
        .join(hot, ["k1", "k2"], "left_semi")
        .groupBy("_id", "of_text")
        .agg(F.collect_set("n").alias("gone"))
    )
    joined = rows.withColumn("_of", F.xxhash64("text")).join(gone, F.expr("doc_id <=> _id and _of = of_text"), "left")
    every = F.split("text", "\n")
    stay = F.filter(every, lambda line, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    return joined.select(
        "doc_id",
        F.when(F.col("text").isNotNull(), F.array_join(stay, "\n")).alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(every)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
