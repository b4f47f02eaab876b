"""Masks are made on whole texts, before they are cut into lines."""

import random
import re

from pyspark.sql import functions as F

from duewise.llm import line_templates as lt


def _masked(line):
    tokens = re.sub(r"[\t\x0b-\r ]+", " ", line).strip(" ").split(" ")
    return " ".join("<*>" if re.search("[0-9@/]", t) else t for t in tokens)


def test_masks_of_texts_are_those_of_their_lines(spark):
    rng = random.Random(7)
    signs = [" ", " ", "\n", "\t", "\r", "\x0b", "a", "bc", "7", "@", "/", "é", ".", " ", "\xa0"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 14))) for _ in range(3_000)] + ["", " ", "\n", " \n ", "a \n \n b"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", lt.masked_lines(F.col("text")).alias("m"))
    for row in rows.collect():
        assert row["m"] == [_masked(line) for line in row["text"].split("\n")], row["text"]


def test_no_pattern_runs_line_by_line(spark):
    rows = spark.createDataFrame([("a 1\nb",)], "text string").select(F.explode(lt._line_keys(F.col("text"))))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    patterns = re.findall(r"(?:regexp_replace|RLIKE|rlike)[( ]*(\w+)|(\w+)#?\d* RLIKE", plan)
    assert patterns and not any("lambda" in part for found in patterns for part in found), plan
