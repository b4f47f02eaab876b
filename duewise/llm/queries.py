"""The training-data operators as registered queries over the given tables, with SQL where it can tell."""

from __future__ import annotations

from duewise.llm.checks import CHECKS
from duewise.llm.co_training import score_quality
from duewise.llm.decontamination import contamination_report
from duewise.llm.language import identify_language
from duewise.llm.line_rules import quality_report
from duewise.llm.line_templates import drop_recurring_lines
from duewise.llm.mixing import mix
from duewise.llm.near_duplicates import near_duplicates
from duewise.llm.personal_data import personal_data_report
from duewise.llm.repeats import repeat_report
from duewise.llm.shared import table
from duewise.llm.token_alignment import align_tokenizers
from duewise.llm.token_files import token_files
from duewise.llm.toxicity import score_toxicity
from duewise.llm.whitening import whiten


def op1_quality_co_training(spark, folder):
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_toxicity(spark, folder):
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_line_rules(spark, folder):
    return quality_report(table(spark, folder, "documents"))


def op4_decontamination(spark, folder):
    return contamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_language(spark, folder):
    return identify_language(table(spark, folder, "documents"))


def op6_token_files(spark, folder):
    return token_files(table(spark, folder, "documents"))


def op7_personal_data(spark, folder):
    return personal_data_report(table(spark, folder, "documents"))


def op8_near_duplicates(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


def op9_mixing(spark, folder):
    return mix(table(spark, folder, "documents"))


def op10_line_templates(spark, folder):
    return drop_recurring_lines(table(spark, folder, "documents"))


def op11_repeats(spark, folder):
    return repeat_report(table(spark, folder, "documents"))


def op12_whitening(spark, folder):
    return whiten(table(spark, folder, "embeddings"))


def op13_token_alignment(spark, folder):
    return align_tokenizers(table(spark, folder, "documents"))


QUERIES = {
    q.__name__: q
    for q in (
        op1_quality_co_training, op2_toxicity, op3_line_rules, op4_decontamination, op5_language, op6_token_files,
        op7_personal_data, op8_near_duplicates, op9_mixing, op10_line_templates, op11_repeats, op12_whitening, op13_token_alignment,
    )
}

__all__ = ["CHECKS", "QUERIES"]
