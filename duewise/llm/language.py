"""Language identification in two steps: the family first, then pairs of languages within it.

A text is its counts of byte n-grams (1 to 4 bytes of lower-case words), hashed into ``SIZE`` places
and divided by their number. Linear support vector machines are fitted by dual coordinate descent:
one per family against all others, and one for every two languages of a family. The language with
most pairwise wins inside the likeliest family is predicted.

Only a bounded sample is learned from: at most ``LEARN_ROWS`` texts in all, spread evenly over the
languages by a hash of the id; each classifier is fitted in a task of its own. What is sent to the
tasks that predict has one row of ``SIZE`` numbers per classifier, for the languages learned.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text
if there is nothing to learn from. Rows with a null ``lang`` or ``doc_id`` are not learned from.
Languages outside the table of families form one family of their own. Repeated rows get the same
answer. Other columns are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duewise.llm.shared import flat_bytes, is_held_out, may_learn, padded_pieces, ready

SIZE_BITS = 12
SIZE = 1 << SIZE_BITS
GRAM = 4
LEARN_ROWS = 6_000
LEARN_PER_LANGUAGE = 600
SCALE = 30.0  # shares of n-grams are small numbers
EPOCHS = 15

# Families of common language codes.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "ug", "uz"),
    "uralic": ("et", "fi", "hu"),
    "semitic": ("am", "ar", "he", "mt"),
    "sinitic": ("zh", "yue"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}
_LETTERS = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.split("-")[0].lower(), "other")


def _places(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For pieces of texts: the place of the n-gram of each length that ends at each byte."""
    data, starts = flat_bytes(pc.utf8_lower(texts))
    for packed, rows, begins, ends in padded_pieces(data, starts, GRAM - 1):
        letters = _LETTERS[packed].astype(np.uint64)
        gram = np.zeros(len(letters), np.uint64)
        places = np.empty((GRAM, len(letters)), np.int32)
        for back in range(GRAM):
            gram[back:] |= letters[: len(letters) - back] << np.uint64(8 * back)
            places[back] = ((gram + np.uint64(back + 1 << 40)) * _ODD) >> np.uint64(64 - SIZE_BITS)
        yield places, rows, begins, ends


def _counts(texts: pa.Array) -> np.ndarray:
    """Shares of n-grams, a dense row per text; for the learned sample only."""
    out = np.zeros((len(texts), SIZE), np.float32)
    for places, rows, begins, ends in _places(texts):
        for row, a, b in zip(rows, begins, ends):
            out[row] += np.bincount(places[:, a:b].ravel(), minlength=SIZE)
    return out * (SCALE / np.maximum(out.sum(1, keepdims=True), 1))


def _svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0) -> np.ndarray:
    """Weights and bias of a linear support vector machine, squared hinge loss, by dual descent."""
    x = np.column_stack([x, np.ones(len(x), np.float32)])
    # Classes weigh alike however many texts each has.
    share = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    diagonal = 1 / (2 * cost * share)
    norms = (x * x).sum(1) + diagonal
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1], np.float64)
    order = np.random.default_rng(1)
    for _ in range(EPOCHS):
        for i in order.permutation(len(y)):
            gradient = y[i] * (x[i] @ w) - 1 + diagonal[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / norms[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


@dataclass
class LanguageModel:
    families: list[str]
    members: dict[str, list[str]]
    names: list[tuple[str, str, str]]  # (family, language, other language); languages are empty for a family
    weights: np.ndarray  # a row of SIZE + 1 per name


def fit_language(documents: DataFrame) -> LanguageModel | None:
    """Learn from text and lang of rows whose fold is not 2."""
    spark = documents.sparkSession
    ready(spark)
    known = documents.where(may_learn(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    langs = sorted(found)
    if not langs:
        return None
    each = max(1, min(LEARN_PER_LANGUAGE, LEARN_ROWS // len(langs)))
    members: dict[str, list[str]] = {}
    for lang in langs:
        members.setdefault(family_of(lang), []).append(lang)
    families = sorted(members)
    names = [(f, "", "") for f in families if len(families) > 1]
    names += [(f, a, b) for f in families for i, a in enumerate(members[f]) for b in members[f][i + 1 :]]
    if not names:
        return LanguageModel(families, members, [], np.zeros((0, SIZE + 1)))
    # About twice the wanted number is drawn first, so that no language gathers more than that.
    drawn = F.create_map(*[F.lit(v) for lang in langs for v in (lang, min(1.0, 2.0 * each / found[lang]))])
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    first = Window.partitionBy("lang").orderBy("chance", "doc_id", "text")
    chosen = (
        known.select("lang", "doc_id", "text", chance.alias("chance"))
        .where(F.col("chance") < drawn[F.col("lang")])
        .where(F.regexp_like("text", F.lit(r"\p{L}")))
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= each)
    )

    @F.arrow_udf("binary")
    def counts(part: pa.Array) -> pa.Array:
        rows = [
            _counts(part.slice(at, 256)).astype(np.float16) for at in range(0, len(part), 256)
        ]
        return pa.array([r.tobytes() for block in rows for r in block], pa.binary())

    tasks = {lang: [k for k, (f, a, b) in enumerate(names) if (lang in (a, b) if a else True)] for lang in langs}
    listed = F.create_map(*[v for lang in langs for v in (F.lit(lang), F.array(*[F.lit(k) for k in tasks[lang]]))])

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        family, a, _ = names[key[0]]
        x = np.frombuffer(b"".join(rows.counts), np.float16).reshape(-1, SIZE).astype(np.float32)
        y = np.where(rows.lang == a, 1.0, -1.0) if a else np.where(rows.lang.map(family_of) == family, 1.0, -1.0)
        return pd.DataFrame({"task": [key[0]], "weights": [_svm(x, y).astype(np.float32).tobytes()]})

    fitted = (
        chosen.select("lang", counts("text").alias("counts"))
        .withColumn("task", F.explode(listed[F.col("lang")]))
        .groupBy("task")
        .applyInPandas(fit, "task int, weights binary")
        .collect()
    )
    weights = np.zeros((len(names), SIZE + 1))
    for row in fitted:
        weights[row.task] = np.frombuffer(row.weights, np.float32)
    return LanguageModel(families, members, names, weights)


def _margins(texts: pa.Array, model: LanguageModel) -> np.ndarray:
    """A row per text, a column per classifier."""
    n, k = len(texts), len(model.names)
    table = np.ascontiguousarray(model.weights[:, :SIZE].astype(np.float32))
    total, size = np.zeros((n, k)), np.zeros(n)
    for places, rows, begins, ends in _places(texts):
        np.add.at(size, rows, GRAM * (ends - begins))
        edges = np.ravel(np.column_stack([begins, ends]))
        edges = edges[edges < places.shape[1]]
        for c in range(k):
            row = table[c]
            here = row[places[0]]
            for back in range(1, GRAM):
                here += row[places[back]]
            total[:, c] += np.bincount(rows, np.add.reduceat(here.astype(np.float64), edges)[::2], n)
    return total * SCALE / np.maximum(size, 1)[:, None] + model.weights[:, SIZE]


def _decided(margins: np.ndarray, model: LanguageModel) -> tuple[list[str], np.ndarray]:
    n = len(margins)
    column = {name: i for i, name in enumerate(model.names)}
    if len(model.families) > 1:
        of_family = margins[:, [column[(f, "", "")] for f in model.families]]
        strong = np.exp(2 * (of_family - of_family.max(1, keepdims=True)))
        strong /= strong.sum(1, keepdims=True)
    else:
        strong = np.ones((n, 1))
    best = strong.argmax(1)
    langs, scores = np.empty(n, object), strong.max(1)
    for f, family in enumerate(model.families):
        here = np.flatnonzero(best == f)
        names = model.members[family]
        wins = np.zeros((len(here), len(names)))
        for i, a in enumerate(names):
            for j in range(i + 1, len(names)):
                p = 1 / (1 + np.exp(-2 * np.clip(margins[here, column[(family, a, names[j])]], -15, 15)))
                # A win counts 1, how clear it is only where wins are equal.
                wins[:, i] += (p >= 0.5) + p / len(names)
                wins[:, j] += (p < 0.5) + (1 - p) / len(names)
        at = wins.argmax(1)
        langs[here] = np.array(names, object)[at]
        if len(names) > 1:
            scores[here] *= wins[np.arange(len(here)), at] / ((len(names) - 1) * (1 + 1 / len(names)))
    return list(langs), np.clip(scores, 0, 1)


def predict_language(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    spark = documents.sparkSession
    ready(spark)
    held = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string, score:double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = held.value
        for part in texts:
            lettered = pc.fill_null(pc.match_substring_regex(part, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if m is None:
                langs, scores = ["und"] * len(part), np.zeros(len(part))
            else:
                langs, scores = _decided(_margins(part, m), m)
                langs = [lang if yes else "und" for lang, yes in zip(langs, lettered)]
                scores = np.where(lettered, scores, 0.0)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return documents.select("doc_id", predict("text").alias("p")).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "p.lang_pred", "p.score"
    )


def identify_language(documents: DataFrame) -> DataFrame:
    return predict_language(documents, fit_language(documents))
