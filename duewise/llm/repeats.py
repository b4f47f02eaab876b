"""Removal of later copies of long byte strings, found by longest-previous-factor arrays.

A byte goes if it lies in a string of LENGTH bytes that also starts earlier: in a document with a
smaller doc_id, or earlier in the same one. Whether a string starts earlier is read from the
longest-previous-factor array: suffixes are sorted, and for each the nearest ones before and after
it in that order which start earlier in the corpus (previous and next smaller position) give the
longest earlier match.

One suffix array of a whole corpus would be 16 bytes or more per byte in one order. Only matches of
LENGTH bytes matter here, so the order is cut into parts that can be sorted apart and still hold every
match:

* Every window of LENGTH bytes has an anchor, its GRAM-byte string of the least hash (the first of
  equal ones). Equal windows have equal anchors at the same place, so all suffixes that can match
  share the anchor's hash. Consecutive windows with one anchor form a run: one narrow row per some
  40 bytes of text.
* Runs are dealt out by anchor. A run whose bytes are those of an earlier run is repeated as a whole;
  an anchor with one kind of run repeats nothing. Only where the same anchor has different
  surroundings are the bytes themselves fetched, once for each kind, and their suffixes sorted.
* Whole copies of texts are found by their hash before, and repeats within one text inside the task,
  so that neither multiplies rows. Anchors of more than HOT_RUNS runs, found on a sample, are not
  sorted in one task: equal runs are found by adding up the first of each kind, and the kinds are
  halved into runs with longer anchors until none is so frequent. The sample chooses between two ways
  to the same result.

Runs are compared by two 64-bit hashes with keys of their own (128 bits together), suffixes by their
bytes.

Defined results: null and empty texts have no bytes and lose none. Rows with equal doc_id and equal
text are one document and return the same. Rows with equal doc_id and different texts follow one
another in the order of a hash of the text; rows without doc_id come first. An empty table gives an
empty result. Other columns are not read. Cuts are made between bytes, so the kept bytes need not be
valid UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duewise.llm.shared import flat_bytes, ready, sieve_flag, sifted
from duewise.operators.ordering import hot_keys, split_hot
from duewise.session import freeing, new_folder, scope, staged

LENGTH = 100
GRAM = 32
HOT_RUNS = 20_000
SORTED_ROWS = 8_000  # runs whose suffixes are sorted together, on average
_CHUNK = 1 << 18  # windows that are looked at together
_PLACE = (1 << 20) - 1

_random = np.random.default_rng(11)
_BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = [int(x) * 2 + 1 for x in _random.integers(1 << 61, 1 << 62, 2)]
_POWERS = {}


def _powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of both bases modulo 2**64, and of their inverses."""
    if "n" not in _POWERS or _POWERS["n"] < n:
        def rising(base):
            return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, base, np.uint64))])

        _POWERS["n"] = n
        _POWERS["of"] = [(rising(b), rising(pow(b, -1, 1 << 64))) for b in _BASES]
    return _POWERS["of"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchored_runs(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, anchor's hash, hash of the run's bytes, first window, windows, anchor's place in the run."""
    found = []
    for c in range(0, max(0, len(data) - length + 1), _CHUNK):
        piece = data[c : c + _CHUNK + length - 1]
        n = len(piece) - length + 1
        (power, inverse), (power2, inverse2) = _powers(_CHUNK + length)
        value = _BYTE[piece]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value * power[: len(piece)])])
        grams = _mixed((sums[gram:] - sums[:-gram]) * inverse[: len(sums) - gram])
        anchor = _least((grams & np.uint64(~_PLACE & (1 << 64) - 1)) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
        anchor = (anchor & np.uint64(_PLACE)).astype(np.int64)
        low, high = np.searchsorted(starts, c, "right") - 1, np.searchsorted(starts, c + n, "left")
        edges = np.clip(starts[low : high + 1] - c, 0, n)
        text = np.repeat(np.arange(low, high), np.diff(edges))
        inside = np.flatnonzero(np.arange(c, c + n) + length <= starts[text + 1])
        if not len(inside):
            continue
        text, anchor = text[inside], anchor[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        windows = np.diff(np.append(first, len(inside)))
        begin = inside[first]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value * power2[: len(piece)])])
        run = (sums[begin + windows + length - 1] - sums[begin]) * inverse2[begin]
        run = _mixed(_mixed(run + windows.astype(np.uint64)) + (anchor[first] - begin).astype(np.uint64))
        found.append((text[first], grams[anchor[first]].view(np.int64), run.view(np.int64), begin + c - starts[text[first]], windows, anchor[first] - begin))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*found))


# ---- suffix order and longest previous factors ----------------------------------------------------

def _ranks(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """For sizes 1, 2, 4, ... and ``length``: numbers that order the strings of that size at each place."""
    n = len(data)
    held = {1: data.astype(np.int64)}
    size = 1
    while size < length:
        more = min(2 * size, length)
        behind = np.zeros(n, np.int64)
        shift = more - size
        behind[: max(0, n - shift)] = held[size][shift:]
        if more <= 4:
            held[more] = held[size] << 8 * size | behind if more == 2 * size else np.unique(held[size] << 32 | behind, return_inverse=True)[1]
        else:
            held[more] = np.unique(held[size].astype(np.uint64) << np.uint64(32) | behind.astype(np.uint64), return_inverse=True)[1]
        size = more
    return held


def smaller_neighbours(values: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest one before, and behind, that holds a smaller value; -1 where there is none."""
    before, behind, open_places = [-1] * len(values), [-1] * len(values), []
    for k, v in enumerate(values):
        while open_places and values[open_places[-1]] > v:
            behind[open_places.pop()] = k
        if open_places:
            before[k] = open_places[-1]
        open_places.append(k)
    return np.array(before, np.int64), np.array(behind, np.int64)


def longest_previous(data: np.ndarray, at: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """How long the longest match, up to ``length``, is that starts at an earlier one of the places ``at``.

    ``at`` rises, and ``length`` bytes follow each place.
    """
    if not len(at):
        return np.zeros(0, np.int64)
    ranks = _ranks(data, length)
    order = np.argsort(ranks[length][at], kind="stable")  # equal suffixes by place
    best = np.zeros(len(at), np.int64)
    for neighbour in smaller_neighbours(order.tolist()):
        has = np.flatnonzero(neighbour >= 0)
        a, b = at[order[has]], at[order[neighbour[has]]]
        common = np.zeros(len(has), np.int64)
        whole = ranks[length][a] == ranks[length][b]
        for size in sorted((s for s in ranks if s < length), reverse=True):
            same = ~whole & (common + size <= length)
            same[same] = ranks[size][a[same] + common[same]] == ranks[size][b[same] + common[same]]
            common[same] += size
        common[whole] = length
        best[order[has]] = np.maximum(best[order[has]], common)
    return best


def _ranges(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and number of each stretch of consecutive places."""
    new = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    return places[new], np.diff(np.append(new, len(places)))


# ---- Spark ------------------------------------------------------------------------------------

_KEY = ["doc_id", "version"]
_SNIPPET = [*_KEY, "gram", "start", "windows", "bytes"]
_RANGE = "doc_id long, version long, start int, windows int"


def _document(documents: DataFrame) -> DataFrame:
    """doc_id, version, text."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), "text")


def _same(left: DataFrame, right: DataFrame, *more: str) -> Column:
    condition = left["doc_id"].eqNullSafe(right["doc_id"]) & (left["version"] == right["version"])
    for c in more:
        condition = condition & (left[c] == right[c])
    return condition


def _runs(texts: DataFrame) -> DataFrame:
    """Runs of all texts, the first of equal ones per text; the others as ranges without an anchor."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, gram, run, start, windows, anchor = anchored_runs(*flat_bytes(batch.column("text")))
            if not len(text):
                continue
            order = np.lexsort((start, run, gram, text))
            text, gram, run, start, windows, anchor = (x[order] for x in (text, gram, run, start, windows, anchor))
            again = np.zeros(len(text), bool)
            again[1:] = (text[1:] == text[:-1]) & (gram[1:] == gram[:-1]) & (run[1:] == run[:-1])
            first = ~again
            # Windows that are repeated within their text, as stretches.
            rows, places = np.repeat(text[again], windows[again]), _filled(start[again], windows[again])
            order = np.lexsort((places, rows))
            places, counts = _ranges(places[order] + (rows[order] << 40))
            rows, places = places >> 40, places & ((1 << 40) - 1)
            none = np.zeros(len(rows), np.int64)
            out = [np.concatenate(x) for x in (
                (text[first], rows), (gram[first], none), (run[first], none), (start[first], places), (windows[first], counts), (anchor[first], none))]
            empty = np.concatenate([np.zeros(int(first.sum()), bool), np.ones(len(rows), bool)])
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column("doc_id"), pa.array(out[0])), pc.take(batch.column("version"), pa.array(out[0])),
                 pa.array(out[1], mask=empty), pa.array(out[2], mask=empty), *[pa.array(x.astype(np.int32)) for x in out[3:]]],
                names=["doc_id", "version", "gram", "run", "start", "windows", "anchor"],
            )

    return texts.select("doc_id", "version", "text").mapInArrow(
        runs, "doc_id long, version long, gram long, run long, start int, windows int, anchor int"
    )


def _filled(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each, ``counts`` of them."""
    ends = np.cumsum(counts)
    return np.repeat(start - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _snippets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted runs (doc_id, version, gram, start, windows, anchor, hot)."""
    per_text = wanted.groupBy(*_KEY).agg(F.collect_list(F.struct("gram", "start", "windows", "anchor", "hot")).alias("runs"))
    found = sifted(texts, "version", wanted.select("version"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                runs = batch.column("runs")[k].values
                data = np.frombuffer(batch.column("text")[k].as_buffer(), np.uint8)
                start, windows = (runs.field(c).to_numpy().astype(np.int64) for c in ("start", "windows"))
                size = windows + LENGTH - 1
                offsets = np.concatenate([[0], np.cumsum(size)])
                pieces = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[_filled(start, size)])]
                )
                whose = pa.array(np.full(len(size), k))
                yield pa.RecordBatch.from_arrays(
                    [pc.take(batch.column("doc_id"), whose), pc.take(batch.column("version"), whose), runs.field("gram"),
                     *[runs.field(c) for c in ("start", "windows", "anchor", "hot")], pieces.cast(pa.binary())],
                    names=["doc_id", "version", "gram", "start", "windows", "anchor", "hot", "bytes"],
                )

    return found.join(per_text, _same(found, per_text)).select(found["doc_id"], found["version"], "text", "runs").mapInArrow(
        cut, "doc_id long, version long, gram long, start int, windows int, anchor int, hot boolean, bytes binary"
    )


def _sorted_repeats(snippets: DataFrame, rows: int) -> DataFrame:
    """Ranges of windows whose longest previous factor is LENGTH, sorting the suffixes of some thousand runs together."""
    buckets = max(1, -(-rows // SORTED_ROWS))

    def repeats(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("version", "ascending"), ("start", "ascending")])
        ids = group["doc_id"].to_numpy(zero_copy_only=False) if not group["doc_id"].null_count else None
        if ids is None:  # rows without an id come first
            known = pc.is_valid(group["doc_id"])
            group = pa.concat_tables([group.filter(pc.invert(known)), group.filter(known)])
            ids = pc.fill_null(group["doc_id"], np.iinfo(np.int64).min).to_numpy()
        version, start, windows = (group[c].to_numpy() for c in ("version", "start", "windows"))
        # Rows of a repeated document bring the same runs.
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (version[1:] != version[:-1]) | (start[1:] != start[:-1])
        group, start, windows = group.filter(pa.array(new)), start[new].astype(np.int64), windows[new].astype(np.int64)
        data = np.frombuffer(b"".join(group["bytes"].to_pylist()), np.uint8)
        begin = np.cumsum(windows + LENGTH - 1) - (windows + LENGTH - 1)
        run = np.repeat(np.arange(len(windows)), windows)
        at = _filled(begin, windows)
        again = longest_previous(data, at) >= LENGTH
        places, counts = _ranges(at[again])  # runs lie LENGTH - 1 bytes apart, so stretches end with their run
        run = run[np.searchsorted(at, places)]
        whose = pa.array(run)
        return pa.table({
            "doc_id": group["doc_id"].take(whose), "version": group["version"].take(whose),
            "start": pa.array((places - begin[run] + start[run]).astype(np.int32)), "windows": pa.array(counts.astype(np.int32)),
        })

    return snippets.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets))).groupBy("bucket").applyInArrow(repeats, _RANGE)


def _first_of_each(rows: DataFrame, kind: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each kind, and the ranges of all others, which repeat it as a whole."""
    more = [c for c in rows.columns if c not in (*_KEY, "start", *kind)]
    first = rows.groupBy(*kind).agg(F.min(F.struct(*_KEY, "start", *[c for c in more if c not in kind])).alias("f"))
    first = staged(first.select(*kind, "f.*"), name)
    # Found by place, which no two rows share, so a frequent kind is no frequent key here.
    return first, rows.join(first, _same(rows, first, "start"), "left_anti").select(*_KEY, "start", "windows")


def _halved(pieces: DataFrame) -> DataFrame:
    """Each run in two, by whether a window holds the half of the missing bytes behind its core or more of those before it.

    The core, ``size`` bytes at ``anchor``, is what all windows of a run hold. Each half has a longer
    core, and its hash is the new key. After seven halvings a core is a whole window.
    """
    at, size, last = F.col("anchor"), F.col("size"), F.col("windows") - 1
    behind = F.expr(f"({LENGTH} - size + 1) DIV 2").cast("int")
    before = LENGTH - size - behind + 1
    turn = at + size + behind - LENGTH  # the first window that holds the bytes behind
    low, high = F.greatest(F.lit(0), turn), F.least(last, turn - 1)

    def half(side: int, begin: Column, windows: Column, core: Column, length: Column) -> Column:
        data = F.substring("bytes", begin + 1, windows + LENGTH - 1)
        key = F.xxhash64(F.lit(side), F.substring(data, core + 1, length))
        return F.struct(
            key.alias("gram"), (F.col("start") + begin).cast("int").alias("start"), windows.cast("int").alias("windows"),
            core.cast("int").alias("anchor"), length.cast("int").alias("size"), data.alias("bytes"),
        )

    halves = F.array_compact(F.array(
        F.when(low <= last, half(1, low, last - low + 1, at - low, size + behind)),
        F.when(high >= 0, half(0, F.lit(0), high + 1, at - before, size + before)),
    ))
    return pieces.select(*_KEY, F.explode(halves).alias("p")).select(*_KEY, "p.*").withColumns({
        "h": F.xxhash64("bytes", "anchor", "size"), "h2": F.xxhash64(F.lit(1), F.col("anchor"), F.col("bytes"))
    })


def _parted(pieces: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Runs of hot anchors under longer keys, until no key has more than HOT_RUNS kinds; and ranges found on the way."""
    done, ranges = [], []
    while True:
        first, later = _first_of_each(staged(_halved(pieces), "halves"), ["gram", "h", "h2"], "kinds")
        ranges.append(later)
        first = first.drop("h", "h2")
        hot = hot_keys(first, "gram", HOT_RUNS)
        if hot is None:
            return reduce(DataFrame.unionByName, [*done, first]), ranges
        cold, pieces = split_hot(first, hot, "gram")
        done.append(cold)


def _heads(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, version, n_bytes, digest of the text."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return _document(documents).select("doc_id", "version", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("digest"))


def _whole_copies(heads: DataFrame) -> DataFrame:
    """doc_id and version of the texts that stand, whole, in an earlier document."""
    long = heads.where(F.col("n_bytes") >= LENGTH)
    several = (
        long.groupBy(F.col("digest").alias("_digest"))
        .agg(F.min(F.struct("doc_id")).alias("first"), F.max(F.struct("doc_id")).alias("last"))
        .where(F.col("first") != F.col("last"))
    )
    found = long.join(several, F.col("digest") == F.col("_digest"))
    return found.where(~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).select(*_KEY).distinct()


def _repeated(documents: DataFrame, copies: DataFrame) -> DataFrame:
    """Per document with repeats that is no whole copy: the ranges of its repeated windows.

    Tables written on the way are deleted once the ranges are.
    """
    spark = documents.sparkSession
    folder = new_folder(spark, "ranges")
    with scope(spark), freeing(spark):
        _ranges_of(documents, copies).write.parquet(folder)
    return spark.read.parquet(folder)


def _ranges_of(documents: DataFrame, copies: DataFrame) -> DataFrame:
    texts = _document(documents).where(F.octet_length("text") >= LENGTH)
    marked = sieve_flag(texts, "version", copies.select("version"))
    doubtful = marked.where("_maybe").select(*texts.columns)
    fresh = marked.where(~F.col("_maybe")).select(*texts.columns).unionAll(
        doubtful.join(copies, _same(doubtful, copies), "left_anti")
    )
    runs = staged(_runs(fresh), "runs")
    anchored = runs.where(F.col("gram").isNotNull())
    parts = [runs.where(F.col("gram").isNull()).select("doc_id", "version", "start", "windows")]
    hot = hot_keys(anchored, "gram", HOT_RUNS)
    if hot is not None:
        anchored, frequent = split_hot(anchored, hot, "gram")
        first, later = _first_of_each(staged(frequent, "hot-runs"), ["gram", "run"], "hot-first")
        parts.append(later)
    same_gram = Window.partitionBy("gram")
    same_run = Window.partitionBy("gram", "run").orderBy(F.col("doc_id").asc_nulls_first(), "version", "start")
    shared = (
        anchored.select("*", F.count(F.lit(1)).over(same_gram).alias("n"), F.min("run").over(same_gram).alias("low"), F.max("run").over(same_gram).alias("high"))
        .where("n > 1")
        .select(*anchored.columns, (F.col("low") != F.col("high")).alias("differs"), F.dense_rank().over(same_run).alias("rank"))
        .where("rank > 1 or differs")
    )
    shared = staged(shared, "shared")
    parts.append(shared.where("rank > 1").select("doc_id", "version", "start", "windows"))
    wanted = shared.where("rank = 1 and differs").select(*_KEY, "gram", "start", "windows", "anchor", F.lit(False).alias("hot"))
    if hot is not None:
        wanted = wanted.unionByName(first.select(*_KEY, "gram", "start", "windows", "anchor", F.lit(True).alias("hot")))
    rows, snippets = wanted.count(), _snippets(texts, wanted)
    if hot is not None:
        snippets = staged(snippets, "snippets")
        parted, found = _parted(snippets.where("hot").withColumn("size", F.lit(GRAM)))
        parts += found
        snippets = snippets.where("not hot").select(*_SNIPPET).unionByName(parted.select(*_SNIPPET))
    parts.append(_sorted_repeats(snippets.select(*_SNIPPET), rows))
    ranges = reduce(DataFrame.unionByName, parts)
    return ranges.groupBy(*_KEY).agg(F.collect_list(F.struct("start", "windows")).alias("ranges"))


def _cut(texts: DataFrame, ranges: DataFrame, column: str, kind: str, result) -> DataFrame:
    """Remove the bytes of repeated windows; ``result`` makes of the kept bytes what is returned in ``column``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for k in range(batch.num_rows):
                ranges = batch.column("ranges")[k].values
                start, windows = (ranges.field(c).to_numpy().astype(np.int64) for c in ("start", "windows"))
                data = np.frombuffer(batch.column("text")[k].as_buffer(), np.uint8)
                edges = np.zeros(len(data) + 1, np.int64)
                np.add.at(edges, start, 1)
                np.add.at(edges, start + windows + LENGTH - 1, -1)
                gone = np.cumsum(edges[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                kept.append(result(data[~gone].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept)],
                names=["doc_id", "version", "n_removed", "n_spans", column],
            )

    found = sifted(texts, "version", ranges.select("version"))
    joined = found.join(ranges, _same(found, ranges)).select(found["doc_id"], found["version"], "text", "ranges")
    return joined.mapInArrow(cut, f"doc_id long, version long, n_removed long, n_spans long, {column} {kind}")


def _changed(documents: DataFrame, column: str, kind: str, result) -> tuple[DataFrame, DataFrame]:
    """Heads of all rows, and what is removed of the documents that lose anything."""
    ready(documents.sparkSession)
    heads = staged(_heads(documents), "heads")
    copies = staged(_whole_copies(heads), "copies")
    cut = _cut(_document(documents), _repeated(documents, copies), column, kind, result)
    whole = heads.join(copies, _same(heads, copies), "left_semi").select(
        "doc_id", "version", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(result(b"")).cast(kind).alias(column)
    )
    return heads, cut.unionByName(whole).dropDuplicates(_KEY)


def repeat_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    heads, changed = _changed(documents, "kept", "string", lambda kept: hashlib.sha256(kept).hexdigest())
    return heads.join(changed, _same(heads, changed), "left").select(
        heads["doc_id"], "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept", "digest").alias("kept_sha256"),
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """All columns of ``documents``, and the kept bytes as binary column ``kept``."""
    _, changed = _changed(documents, "kept", "binary", bytes)
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("version"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_bytes"),
    )
    return rows.join(changed, _same(rows, changed), "left").select("_row.*", F.coalesce("kept", "_bytes").alias("kept"))
