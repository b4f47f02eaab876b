from __future__ import annotations

import math
import os
import subprocess
import sys

import duckdb
import pytest

import corpus_pipeline
from duewise.llm.decontamination import contamination_report
from duewise.llm.mixing import mix
from duewise.llm.near_duplicates import near_duplicates
from duewise.llm.queries import CHECKS, QUERIES
from duewise.llm.shared import table
from duewise.llm.toxicity import score_toxicity
from duewise.session import staged


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_its_sql(spark, folder, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    cursor = db.execute(CHECKS[name])
    columns = [c[0] for c in cursor.description]
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(map(repr, (r[c] for c in columns))) for r in df.collect()) == sorted(tuple(map(repr, r)) for r in cursor.fetchall())


def test_every_stage_takes_effect_on_what_came_before(spark, folder):
    docs = table(spark, folder, "documents")
    labels, benchmark = table(spark, folder, "labels"), table(spark, folder, "benchmark")
    wanted = {
        "toxicity": lambda d: {r.doc_id: 1 for r in score_toxicity(d, labels).where("predicted = 0").collect()},
        "near_duplicates": lambda d: {r.doc_id: 1 for r in near_duplicates(d).where("kept").collect()},
        "decontamination": lambda d: {r.doc_id: 1 for r in contamination_report(d, benchmark).where("not contaminated").collect()},
        "mixing": lambda d: {r.doc_id: math.ceil(r.taken / r["size"]) for r in mix(d).where("taken > 0").collect()},
    }
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = staged(stage(spark, docs, folder), name)
        assert out.columns == columns
        assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == wanted[name](docs), name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == docs.count()
    whole = corpus_pipeline.run(spark, folder)
    key = lambda r: (r.start, r.doc_id, r.n_tokens, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, last.collect()))


def test_the_rest_works_without_this_part():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = "import sys; sys.modules['duewise.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
