"""Toxicity by two Kneser-Ney models over the bytes of words, one per class, with shared backoff.

A model gives each byte a probability after the five bytes before it. Both classes back off to the
same shorter continuation counts, so that an expression neither class knows weighs nothing, and one
that only shares its beginning with toxic words still counts. A text is compared by its toxic minus
ordinary log-likelihood per byte, over the whole and over its most toxic stretches, and a logistic
curve fitted on labelled rows that the models did not see turns that into a score.

The counts come from all labelled rows of folds 0 and 1 and are added up by Spark. The finished
comparison has one number per counted n-gram and per context, under a key that no other one has; what
was not counted falls to the backoff. It stands in the shared folder in shards of about
``SHARD_ROWS`` by key, as many as the counted n-grams need. A task reads the shards one after another
for each batch and keeps at most ``KEPT`` of them. The shared folder must be one that pyarrow can read
(local, hdfs, s3, gs). The curve is fitted on at most ``CALIBRATION_ROWS`` labelled rows of fold 3.

Defined results: a null or empty text, or one without a letter, has score 0; without rows of both
classes every score is 0. Repeated rows are scored alike. Other columns are neither read nor changed.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewise.llm.shared import PIECE, flat_bytes, fold, is_held_out, let_go, padded_pieces, ready, sifted
from duewise.session import staged, staged_folder

ORDER = 6  # bytes of an n-gram, the last one predicted
STRETCH = 10  # bytes of the stretches whose worst is looked at
SHARD_ROWS = 1 << 20  # numbers of a shard, about
KEPT = 6  # shards a worker holds, of all models
CALIBRATION_ROWS = 8_000
REJECT = 0.3
HELD = 600_000  # counts a task holds
_ODD = 0x9E3779B97F4A7C15
# Letters stay as they are, all else in ASCII parts words.
_LETTERS = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def _grams(data: np.ndarray) -> np.ndarray:
    """The n-gram that ends at each byte, as a number; bytes before the first count as 0."""
    out = np.zeros(len(data), np.int64)
    for back in range(ORDER):
        out[back:] |= data[: len(data) - back].astype(np.int64) << (8 * back)
    return out


def _keys(grams: np.ndarray) -> np.ndarray:
    """63 mixed bits, different for different numbers, as an odd factor can be undone."""
    return ((grams.astype(np.uint64) * np.uint64(_ODD)) & np.uint64(2**63 - 1)).astype(np.int64)


class _Shard:
    """Sorted keys with their values, and where the keys of each beginning start."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int):
        self.keys, self.values = keys, values
        more = max(1, int(len(keys)).bit_length())
        self.shift, self.mask = 63 - bits - more, (1 << more) - 1
        self.starts = np.zeros((1 << more) + 1, np.int32)
        np.cumsum(np.bincount(self._begin(keys), minlength=1 << more), out=self.starts[1:])

    def _begin(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> self.shift) & self.mask

    def look(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), np.nan, np.float32)
        begin = self._begin(keys)
        at, end = self.starts[begin], self.starts[begin + 1]
        live = np.flatnonzero(at < end)
        while len(live):
            here = at[live]
            hit = self.keys[here] == keys[live]
            out[live[hit]] = self.values[here[hit]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out


# Shards of the task at hand; workers live on, so each task lets go of its own at the end.
_loaded: OrderedDict[tuple[str, int], _Shard] = OrderedDict()


@dataclass
class Table:
    """Numbers by key in 2 ** ``bits`` shards of a shared folder."""

    folder: str
    bits: int

    def shard(self, k: int) -> _Shard:
        if (self.folder, k) in _loaded:
            _loaded.move_to_end((self.folder, k))
        else:
            while len(_loaded) >= KEPT:
                _loaded.popitem(last=False)
            store, path = fs.FileSystem.from_uri(f"{self.folder}/shard={k}")
            found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
            files = sorted(f.path for f in found if f.path.endswith(".parquet"))
            keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
            for file in files:
                with store.open_input_file(file) as opened:
                    rows = pq.ParquetFile(opened).read(["key", "value"], use_threads=False)
                keys.append(rows["key"].to_numpy())
                values.append(rows["value"].to_numpy())
            keys, values = np.concatenate(keys), np.concatenate(values)
            order = slice(None) if len(files) < 2 else np.argsort(keys)
            _loaded[self.folder, k] = _Shard(keys[order], values[order], self.bits)
        return _loaded[self.folder, k]

    def look(self, grams: np.ndarray) -> np.ndarray:
        """The number of each; NaN for what is not in the table."""
        if not self.bits:
            return self.shard(0).look(_keys(grams))
        keys, back = np.unique(_keys(grams), return_inverse=True)
        ends = np.searchsorted(keys, (np.arange(1, (1 << self.bits) + 1, dtype=np.uint64) << np.uint64(63 - self.bits)) - np.uint64(1), "right")
        out, start = np.empty(len(keys), np.float32), 0
        for k, end in enumerate(ends):
            if end > start:
                out[start:end] = self.shard(k).look(keys[start:end])
            start = end
        return out[back]


def _added_up(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in found])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(np.concatenate([n for _, n in found])[order], first)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def told(keys, n):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys >> 1), pa.array(np.where(keys & 1, n, 0)), pa.array(np.where(keys & 1, 0, n))],
            names=["gram", "toxic", "ordinary"],
        )

    found, size = [], 0
    for batch in batches:
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
        data, starts = flat_bytes(pc.utf8_lower(batch.column("text")))
        for packed, rows, begins, ends in padded_pieces(data, starts, ORDER - 1):
            grams = _grams(_LETTERS[packed])
            own = np.zeros(len(packed) + 1, np.int8)
            np.add.at(own, begins, 1)
            np.add.at(own, ends, -1)
            keep = np.cumsum(own[:-1]) > 0
            both, n = np.unique(grams[keep] << 1 | np.repeat(toxic[rows], ends - begins), return_counts=True)
            found.append((both, n))
            size += len(both)
            if size > HELD:  # as many are added up before they leave the task, however long that runs
                found = [_added_up(found)]
                size = len(found[0][0])
                if size > HELD // 2:
                    yield told(*found[0])
                    found, size = [], 0
    if found:
        yield told(*_added_up(found))


@dataclass
class ToxicityModel:
    """The log-ratio after each counted n-gram, or of its context; and the curve."""

    known: Table
    context: Table
    curve: np.ndarray | None


def gram_counts(documents: DataFrame, labels: DataFrame, folds: tuple[int, ...] = (0, 1)) -> DataFrame:
    """How often each n-gram stands in toxic and in ordinary labelled texts."""
    marked = labels.where(F.col("toxic").isin(0, 1) & fold(F.col("doc_id")).isin(*folds)).select("doc_id", "toxic")
    texts = documents.where(fold(F.col("doc_id")).isin(*folds) & F.col("text").isNotNull()).select("doc_id", "text")
    return (
        sifted(texts, "doc_id", marked.select("doc_id")).join(marked, "doc_id")
        .select("text", "toxic")
        .mapInArrow(_counted, "gram long, toxic long, ordinary long")
        .groupBy("gram")
        .agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    )


def _ratios(counts: DataFrame) -> DataFrame:
    """Kneser-Ney log-ratios: of each counted n-gram, and what its context gives to all others."""
    ones = counts.agg(*[
        F.count_if(F.col(c) == n).alias(f"{c}_{n}") for c in ("toxic", "ordinary") for n in (1, 2)
    ]).first()
    discount = {c: (ones[f"{c}_1"] + 0.5) / (ones[f"{c}_1"] + 2 * ones[f"{c}_2"] + 1) for c in ("toxic", "ordinary")}
    shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (ORDER - 1)) - 1))
    keyed = counts.select(
        "*",
        F.shiftright("gram", 8).alias("context"),
        shorter.alias("shorter"),
        F.shiftright(shorter, 8).alias("shorter_context"),
    )
    # A context has at most 256 n-grams, a shorter context 256 times as many.
    context, less, least = (Window.partitionBy(c) for c in ("context", "shorter", "shorter_context"))
    sized = keyed.select(
        "*",
        *[F.sum(c).over(context).alias(f"n_{c}") for c in discount],
        *[F.count_if(F.col(c) > 0).over(context).alias(f"kinds_{c}") for c in discount],
        F.count(F.lit(1)).over(less).alias("fronts"),
    ).select(
        "*", F.count(F.lit(1)).over(least).alias("all_fronts"), F.sum(1 / F.col("fronts")).over(least).alias("followers")
    )
    d = 0.75
    shared = (F.col("fronts") - d + d * F.col("followers") / 64) / F.col("all_fronts")

    def chance(c: str) -> Column:
        spare = discount[c] * F.col(f"kinds_{c}") * shared
        seen = F.greatest(F.col(c) - discount[c], F.lit(0.0))
        return F.when(F.col(f"n_{c}") > 0, (seen + spare) / F.col(f"n_{c}")).otherwise(shared)

    def spare_of(c: str) -> Column:
        return F.when(F.col(f"n_{c}") > 0, discount[c] * F.col(f"kinds_{c}") / F.col(f"n_{c}")).otherwise(F.lit(1.0))

    return sized.select(
        "gram", "context",
        F.log(chance("toxic") / chance("ordinary")).alias("ratio"),
        F.log(spare_of("toxic") / spare_of("ordinary")).alias("spare"),
    )


def _comparison(counts: DataFrame) -> tuple[Table, Table]:
    """The log-ratios of n-grams and of contexts as tables of the shared folder."""

    @F.arrow_udf("long")
    def key(grams: pa.Array) -> pa.Array:
        return pa.array(_keys(grams.to_numpy(zero_copy_only=False)))

    ratios = staged(_ratios(counts), "ratios")
    bits = max(0, -(-ratios.count() // SHARD_ROWS) - 1).bit_length()
    tables = []
    for name, rows in (
        ("known", ratios.select("gram", "ratio")),
        ("context", ratios.groupBy("context").agg(F.max("spare"))),
    ):
        keyed = rows.toDF("gram", "value").select(key("gram").alias("key"), F.col("value").cast("float").alias("value"))
        dealt = keyed.withColumn("shard", F.shiftright("key", 63 - bits)).repartition(1 << bits, "shard")
        tables.append(Table(staged_folder(dealt.sortWithinPartitions("shard", "key"), name, "shard"), bits))
    return tables[0], tables[1]


def _evidence(texts: pa.Array, known: Table, context: Table) -> np.ndarray:
    """Per text: log-ratio per byte, of the worst stretch, what stands out in all stretches, bytes."""
    data, starts = flat_bytes(pc.utf8_lower(texts))
    n = len(starts) - 1
    total, worst, excess = np.zeros(n), np.zeros(n), np.zeros(n)
    before = ORDER - 1 + STRETCH
    # Where a worker cannot hold all shards, each is read for as many bytes as a batch has.
    most = (4 if 2 << known.bits <= KEPT else 16) * PIECE
    for packed, rows, begins, ends in padded_pieces(data, starts, before, most):
        grams = _grams(_LETTERS[packed])
        ratio = known.look(grams)
        unseen = np.flatnonzero(np.isnan(ratio))
        ratio[unseen] = np.nan_to_num(context.look(grams[unseen] >> 8))
        run = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
        np.add.at(total, rows, run[ends] - run[begins])
        stretch = np.zeros(len(packed))
        stretch[STRETCH:] = run[STRETCH + 1 :] - run[1 : len(packed) - STRETCH + 1]
        edges = np.ravel(np.column_stack([begins, ends]))
        edges = edges[edges < len(stretch)]
        np.maximum.at(worst, rows, np.maximum.reduceat(stretch, edges)[::2])
        np.add.at(excess, rows, np.add.reduceat(np.maximum(stretch - 6.0, 0.0), edges)[::2])
    size = np.diff(starts)
    return np.column_stack([total / np.maximum(size, 1), worst / STRETCH, np.log1p(excess / STRETCH), np.log1p(size)])


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """Logistic regression by Newton's steps, lightly held back; first the means, scales, then weights."""
    if len(y) == 0 or y.min() == y.max():
        return None
    middle, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - middle) / scale])
    w, hold = np.zeros(z.shape[1]), np.eye(z.shape[1]) * 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + hold, z.T @ (p - y) + hold @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate([middle, scale, w])


def _applied(curve: np.ndarray | None, x: np.ndarray) -> np.ndarray:
    if curve is None:
        return np.zeros(len(x))
    k = x.shape[1]
    z = np.clip((x - curve[:k]) / curve[k : 2 * k], -4, 4)  # nothing is read off far from what was seen
    return 1 / (1 + np.exp(-np.clip(curve[2 * k] + z @ curve[2 * k + 1 :], -30, 30)))


def fit_toxicity(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from rows whose fold is not 2: the models from folds 0 and 1, the curve from fold 3."""
    spark = documents.sparkSession
    ready(spark)
    known, context = _comparison(staged(gram_counts(documents, labels), "grams"))

    @F.arrow_udf("array<double>")
    def evidence(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for part in texts:
                yield pa.array(list(_evidence(part, known, context)), pa.list_(pa.float64()))
        finally:
            _loaded.clear()
            let_go()

    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) == 3))
        .select("doc_id", "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic")
        .limit(CALIBRATION_ROWS)
    )
    texts = documents.where((fold(F.col("doc_id")) == 3) & F.col("text").isNotNull()).select("doc_id", "text")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("toxic", evidence("text").alias("x")).toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), 4)
    return ToxicityModel(known, context, _curve(x, rows["toxic"].to_numpy(float)))


def toxicity_score(model: ToxicityModel, spark, text: Column) -> Column:
    """The score of whole texts as a column, from 0 to 1."""
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for part in texts:
                lettered = pc.fill_null(pc.match_substring_regex(part, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                yield pa.array(np.where(lettered, _applied(model.curve, _evidence(part, model.known, model.context)), 0.0))
        finally:
            _loaded.clear()
            let_go()

    return score(text)


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    model = fit_toxicity(documents, labels)
    scored = documents.select("doc_id", toxicity_score(model, documents.sparkSession, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted")
    )


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, whose score stays below the limit."""
    model = fit_toxicity(documents, labels)
    return documents.where(toxicity_score(model, documents.sparkSession, F.col("text")) < REJECT)
