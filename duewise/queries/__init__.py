"""Registered queries over the given tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from duewise.queries import (
    back_tests, decisions, enrichments, features, metric_queries, model_queries, plan_queries, profiles, sources_queries,
)

FAMILIES = (
    sources_queries, features, enrichments, profiles, decisions, metric_queries, back_tests, plan_queries, model_queries,
)


def all_queries():
    return {n: q for family in FAMILIES for n, q in family.QUERIES.items()}


def all_checks():
    return {n: sql for family in FAMILIES for n, sql in family.CHECKS.items()}
