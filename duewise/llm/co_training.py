"""Quality by co-training: a view of the text and a view of the page's metadata teach each other.

The text view sees shapes of the whole text (shares of kinds of characters, words and lines,
repetition), the metadata view only source, lang and n_chars. Both start from the same labelled rows.
In each of ``ROUNDS`` rounds each view labels the documents of an unlabelled pool it is surest of,
as many of either class as their share among the labels asks for, and hands them to the other view.
In the end each view is calibrated on labelled rows that neither learned from (fold 3), a logistic
curve joins the two, and every document is scored.

Bounds: at most ``LEARN_ROWS`` labelled rows of folds 0 and 1, ``CALIBRATION_ROWS`` of fold 3 and
``POOL_ROWS`` unlabelled rows outside fold 2 are learned from, chosen by a hash of the id. Their
features, and nothing else, reach the driver. All documents are scored.

Defined results: null text, source or lang and a null or negative n_chars are values of their own.
Without labels of both classes every score is 0.5. Repeated rows are scored alike. Other columns are
neither read nor changed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewise.llm.shared import fold, is_held_out, may_learn, ready

ROUNDS = 4
TAUGHT = 200  # pseudo-labels a view hands over per round
LEARN_ROWS = 6_000
CALIBRATION_ROWS = 3_000
POOL_ROWS = 6_000
SOURCE_PLACES, LANG_PLACES, SIZE_PLACES = 32, 8, 24

_KIND = np.full(256, 7)
for _k, _chars in enumerate((range(97, 123), range(65, 91), range(48, 58), b" ", b"\n", b".!?", b"#*$%&|<>")):
    for _c in _chars:
        _KIND[_c] = _k
_KIND[128:] = 8
_KINDS = np.eye(9)[_KIND]


def text_view(text: bytes) -> list[float]:
    n = len(text)
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _KINDS / max(n, 1)
    words = text.split()
    m = len(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = m - 2
    joined = len(set(zip(words, words[1:], words[2:]))) / windows if windows > 0 else 1.0
    return [
        *kinds,
        np.log1p(m),
        np.log1p(len(lines)),
        n / max(m, 1) / 10,
        len(set(words)) / max(m, 1),
        joined,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(m / max(len(lines), 1)),
        sum(map(bytes.isupper, words)) / max(m, 1),
        float(m == 0),
    ]


def metadata_view(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    out = np.zeros(SOURCE_PLACES + LANG_PLACES + SIZE_PLACES + 1)
    out[0 if source is None else 1 + zlib.crc32(source.encode()) % (SOURCE_PLACES - 1)] = 1
    out[SOURCE_PLACES + (0 if lang is None else 1 + zlib.crc32(lang.encode()) % (LANG_PLACES - 1))] = 1
    size = -1 if n_chars is None or n_chars < 0 else n_chars
    out[SOURCE_PLACES + LANG_PLACES + (0 if size < 0 else min(SIZE_PLACES - 1, 1 + int(size).bit_length()))] = 1
    out[-1] = np.log1p(max(size, 0)) / 10
    return list(out)


def _fit(x: np.ndarray, y: np.ndarray, hold: float = 1.0) -> np.ndarray:
    """Means, scales and weights of a logistic regression by Newton's steps; classes weigh alike."""
    middle, scale = x.mean(0), x.std(0)
    scale[scale < 1e-9] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - middle) / scale])
    weight = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w, ridge = np.zeros(z.shape[1]), np.eye(z.shape[1]) * hold
    ridge[0, 0] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weight * (p - y)) + ridge @ w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge, slope)
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return np.concatenate([middle, scale, w])


def _logit(model: np.ndarray, x: np.ndarray) -> np.ndarray:
    k = x.shape[1]
    return model[2 * k] + ((x - model[:k]) / model[k : 2 * k]) @ model[2 * k + 1 :]


@dataclass
class QualityModel:
    text: np.ndarray
    metadata: np.ndarray
    joint: np.ndarray  # weights of 1, the text view's and the metadata view's logit

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = _logit(self.text, text), _logit(self.metadata, metadata)
        z = _logit(self.joint, np.column_stack([a, b]))
        return tuple(1 / (1 + np.exp(-np.clip(v, -30, 30))) for v in (z, a, b))


def co_train(views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], rounds: int = ROUNDS, taught: int = TAUGHT) -> list[np.ndarray]:
    """Both views' models after exchanging confident pseudo-labels."""
    known = [(x, y) for x in views]
    left = np.arange(len(pool[0]))
    share = y.mean()
    for _ in range(rounds):
        models = [_fit(x, t) for x, t in known]
        handed = [[], []]
        for v in (0, 1):
            if not len(left):
                break
            sure = _logit(models[v], pool[v][left])
            order = np.argsort(sure, kind="stable")
            many = min(taught, len(left) // 4)
            top = order[len(order) - round(many * share) :] if round(many * share) else order[:0]
            low = order[: many - len(top)]
            # Only what a view is sure of is handed over.
            top, low = top[sure[top] > 1.0], low[sure[low] < -1.0]
            handed[1 - v] = [(left[top], 1.0), (left[low], 0.0)]
        used = np.zeros(len(pool[0]), bool)
        for v in (0, 1):
            for rows, label in handed[v]:
                known[v] = (np.concatenate([known[v][0], pool[v][rows]]), np.concatenate([known[v][1], np.full(len(rows), label)]))
                used[rows] = True
        left = left[~used[left]]
        if not used.any():
            break
    return [_fit(x, t) for x, t in known]


def _view_columns(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    one = np.array([text_view(t or b"") for t in pc.cast(text, pa.binary()).to_pylist()], float)
    two = np.array([metadata_view(*v) for v in zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist())], float)
    return one, two


def _wanted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, quality, part) of the rows to learn from, a bounded number."""
    marked = labels.where(F.col("quality").isin(0, 1)).select("doc_id", "quality")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality")]
    learn = marked.where(fold(F.col("doc_id")).isin(0, 1)).orderBy(*order).limit(LEARN_ROWS)
    check = marked.where(fold(F.col("doc_id")) == 3).orderBy(*order).limit(CALIBRATION_ROWS)
    drawn = documents.where(may_learn(F.col("doc_id"))).select("doc_id").orderBy(*order[:2]).limit(4 * POOL_ROWS)
    labelled = labels.select("doc_id").join(F.broadcast(drawn), "doc_id", "left_semi")
    pool = drawn.join(labelled, "doc_id", "left_anti").orderBy(*order[:2]).limit(POOL_ROWS)
    return (
        learn.withColumn("part", F.lit("learn"))
        .unionByName(check.withColumn("part", F.lit("check")))
        .unionByName(pool.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit("pool").alias("part")))
    )


def fit_quality(documents: DataFrame, labels: DataFrame) -> QualityModel | None:
    ready(documents.sparkSession)

    @F.arrow_udf("struct<one:array<double>, two:array<double>>")
    def views(text: pa.Array, source: pa.Array, lang: pa.Array, n_chars: pa.Array) -> pa.Array:
        one, two = _view_columns(text, source, lang, n_chars)
        kind = pa.list_(pa.float64())
        return pa.StructArray.from_arrays([pa.array(list(one), kind), pa.array(list(two), kind)], ["one", "two"])

    wanted = _wanted(documents, labels)
    rows = (
        documents.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
        .join(F.broadcast(wanted), "doc_id")
        .select("quality", "part", views("text", "source", "lang", "n_chars").alias("v"))
        .select("quality", "part", "v.*")
        .toPandas()
    )
    widths = {"one": len(text_view(b"")), "two": len(metadata_view(None, None, None))}

    def of(part):
        here = rows[rows.part == part]
        return [np.array(here[c].tolist(), float).reshape(len(here), n) for c, n in widths.items()], here.quality.to_numpy(float)

    (x, y), (cx, cy), (pool, _) = of("learn"), of("check"), of("pool")
    if not len(y) or y.min() == y.max() or not len(cy) or cy.min() == cy.max():
        return None
    if not len(pool[0]):
        pool = [v[:0] for v in x]
    text, metadata = co_train(x, y, pool)
    both = np.column_stack([_logit(text, cx[0]), _logit(metadata, cx[1])])
    return QualityModel(text, metadata, _fit(both, cy))


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and both views' scores for every document."""
    spark = documents.sparkSession
    held = spark.sparkContext.broadcast(fit_quality(documents, labels))
    names = ["score", "text_score", "metadata_score"]

    @F.arrow_udf("struct<score:double, text_score:double, metadata_score:double>")
    def score(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        model = held.value
        for part in parts:
            if model is None or not len(part[0]):
                found = [np.full(len(part[0]), 0.5)] * 3
            else:
                found = model.scores(*_view_columns(*part))
            yield pa.StructArray.from_arrays([pa.array(v) for v in found], names)

    def whole(name: str) -> Column:
        return F.col(name).cast("long") if name == "n_chars" else F.col(name)

    scored = documents.select("doc_id", score(*map(whole, ("text", "source", "lang", "n_chars"))).alias("s"))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "s.*", (F.col("s.score") >= 0.5).cast("int").alias("predicted")
    )
