"""MinHash near-duplicates by an LSH forest: sorted signature orders with prefix neighbours.

Each distinct word sequence gets ``TREES`` labels of ``DEPTH`` min-hashes. In each tree texts are
sorted by label, and those that share the first ``BASE`` hashes form a region. Candidates are

1. the next ``NEIGHBOURS`` texts of the sorted order within a region, so that the depth at which
   texts meet follows from how dense the region is;
2. each member with the pivot of its region, the text that lies in the largest regions over all
   trees: where thousands of copies surround one text, they meet it rather than one another.

Both grow with the number of texts, never with the square of a region. Candidates whose signatures
agree enough (six standard deviations below the limit) are confirmed on full shingle sets. Regions
whose members then still lie in different components are gone through completely: texts outside the
largest component against all, block against block, first by signature and then, where these agree,
on full sets. Pairs are looked at within tasks; only links leave. So none depends on how many
neighbours are taken. Texts that are linked but share no region (below 1 in a million pairs at the limit itself)
would be missed.

Exact copies of a word sequence are one node from the start, however many there are.

Defined results: a null text, or one without words, has no shingles and is linked with nothing.
Repeated rows are copies of one another. Rows without a doc_id take part; a group of only such rows
has a null component. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType

from duewise.llm.components import connected_components
from duewise.llm.shared import ASCII_LOWER, ready, sifted
from duewise.session import staged

SHINGLE = 5
SIMILARITY = 85  # percent of the union
TREES, DEPTH, BASE = 20, 8, 4
NEIGHBOURS = 3
BLOCK = 1024  # texts of one side compared in one task
HASHES = TREES * DEPTH
_draw = np.random.default_rng(20240607)
_FACTORS = (_draw.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFTS = _draw.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_PLACES = (_draw.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1))
# Agreements a linked pair falls short of less than once in a thousand million times, one byte a hash.
_AGREE = int(HASHES * (SIMILARITY / 100 - 6 * np.sqrt(SIMILARITY / 100 * (1 - SIMILARITY / 100) / HASHES)))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ASCII_LOWER).split()  # splits at \x20 and \x09-\x0D, like the word rule


def shingles_of(words: list[bytes]) -> np.ndarray:
    """The distinct five-word shingles as sorted 64-bit hashes; fewer words make one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        mixed += hashes[k : k + n] * _PLACES[k]
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _signature(shingles: np.ndarray) -> np.ndarray:
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(out, (low[at : at + 2048, None] * _FACTORS + _SHIFTS).min(0), out=out)
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sizes, labels, briefs = [], [], [], []
        last = {}  # copies often follow one another
        for text in pc.cast(batch.column("text"), pa.binary()).to_pylist():
            words = words_of(text or b"")
            key = xxhash.xxh3_128_digest(b" ".join(words)) if words else None
            if key not in last:
                found = shingles_of(words)
                signature = _signature(found) if words else None
                if len(last) > 500:
                    last.clear()
                last[key] = (
                    len(found),
                    signature.astype(">u4").tobytes() if words else None,
                    (signature >> np.uint32(11)).astype(np.uint8).tobytes() if words else None,
                )
            size, label, brief = last[key]
            keys.append(key)
            sizes.append(size)
            labels.append(label)
            briefs.append(brief)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(labels, pa.binary()), pa.array(briefs, pa.binary())],
            names=["doc_id", "node", "n_shingles", "label", "brief"],
        )


def signed(documents: DataFrame) -> DataFrame:
    """doc_id, node (128-bit hash of the words, null without words), n_shingles and signature."""
    ready(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        _signed, f"doc_id {kind}, node binary, n_shingles long, label binary, brief binary"
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of rows that follow one another in a region; the first and last rows are told as well.

    Rows arrive sorted. Only the last few are held.
    """
    def told(pairs, edges, place):
        a = [p[0] for p in pairs] + [e[2] for e in edges]
        b = [p[1] for p in pairs] + [None] * len(edges)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.binary()), pa.array(b, pa.binary()),
             pa.array([None] * len(pairs) + [e[0] for e in edges], pa.int32()),
             pa.array([None] * len(pairs) + [e[1] for e in edges], pa.binary()),
             pa.array([None] * len(pairs) + [place] * len(edges), pa.string())],
            names=["a", "b", "tree", "label", "place"],
        )

    recent, seen = [], 0
    for batch in batches:
        pairs, firsts = [], []
        for row in zip(batch.column("tree").to_pylist(), batch.column("label").to_pylist(), batch.column("node").to_pylist()):
            if seen < NEIGHBOURS:
                firsts.append(row)
            seen += 1
            for old in recent:
                if old[0] == row[0] and old[1][: 4 * BASE] == row[1][: 4 * BASE]:
                    pairs.append((old[2], row[2]))
            recent = [*recent[-(NEIGHBOURS - 1) :], row]
        yield told(pairs, firsts, "first")
    yield told([], recent, "last")


_NEIGHBOUR_ROWS = "a binary, b binary, tree int, label binary, place string"


def forest_members(texts: DataFrame) -> DataFrame:
    """(tree, region, label, node, n): texts in regions of two or more, with the region's size."""
    width = 4 * DEPTH
    trees = texts.select("node", "label", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    entries = trees.select(
        "node", "tree", F.substring("label", F.col("tree") * width + 1, F.lit(width)).alias("label")
    ).withColumn("region", F.xxhash64("tree", F.substring("label", 1, 4 * BASE)))
    sizes = entries.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return entries.join(sizes, "region").select("tree", "region", "label", "node", "n")


def candidates(members: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of neighbours in the sorted orders, and of members with their pivot."""
    spark = members.sparkSession
    segments = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = (
        members.select("tree", "label", "node")
        .repartitionByRange(segments, "tree", "label", "node")
        .sortWithinPartitions("tree", "label", "node")
    )
    found = staged(ordered.mapInArrow(_neighbours, _NEIGHBOUR_ROWS), "neighbours")
    # Where one partition ends and the next begins: a few rows of each, put in order and looked at alike.
    edges = found.where("place is not null").select("tree", "label", F.col("a").alias("node")).distinct()
    across = edges.coalesce(1).sortWithinPartitions("tree", "label", "node").mapInArrow(_neighbours, _NEIGHBOUR_ROWS)
    beside = found.where("place is null").select("a", "b").unionByName(across.where("place is null").select("a", "b"))

    central = members.groupBy("node").agg(F.sum("n").alias("weight"))
    pivots = (
        members.where(F.col("n") > NEIGHBOURS + 1)
        .join(central, "node")
        .groupBy("region")
        .agg(F.max_by("node", F.struct("weight", "node")).alias("pivot"))
    )
    around = members.join(pivots, "region").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    both = beside.unionByName(around).where("a <> b")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


@F.arrow_udf(IntegerType())
def _agreeing(a: pa.Array, b: pa.Array) -> pa.Array:
    one = np.frombuffer(b"".join(a.to_pylist()), np.uint8).reshape(-1, HASHES)
    two = np.frombuffer(b"".join(b.to_pylist()), np.uint8).reshape(-1, HASHES)
    return pa.array((one == two).sum(1).astype(np.int32))


def screened(pairs: DataFrame, briefs: DataFrame) -> DataFrame:
    """Pairs whose signatures agree often enough for a link."""
    sides = [briefs.select(F.col("node").alias(c), F.col("brief").alias(f"brief_{c}")) for c in "ab"]
    return (
        pairs.join(sides[0], "a").join(sides[1], "b")
        .select("a", "b", _agreeing("brief_a", "brief_b").alias("agree"))
        .where(F.col("agree") >= _AGREE)
        .select("a", "b")
    )


@F.arrow_udf(BooleanType())
def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    known: dict[bytes, np.ndarray] = {}

    def of(text):
        if text not in known:
            if len(known) > 100:
                known.clear()
            known[text] = shingles_of(words_of(text))
        return known[text]

    out = []
    for one, two in zip(pc.cast(a, pa.binary()).to_pylist(), pc.cast(b, pa.binary()).to_pylist()):
        x, y = of(one), of(two)
        shared = len(np.intersect1d(x, y, assume_unique=True))
        out.append(100 * shared >= SIMILARITY * (len(x) + len(y) - shared))
    return pa.array(out)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full shingle sets are similar enough."""
    sides = [texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab"]
    return (
        pairs.join(sides[0], "a").join(sides[1], "b")
        .select("a", "b", _linked("text_a", "text_b").alias("linked"))
        .where("linked")
        .select("a", "b")
    )


def _texts_of(documents: DataFrame, firsts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The text of each node that stands in a pair, from one row that holds it."""
    wanted = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(firsts, "node"), "wanted")

    @F.arrow_udf("binary")
    def node_of(texts: pa.Array) -> pa.Array:
        found = [words_of(t or b"") for t in pc.cast(texts, pa.binary()).to_pylist()]
        return pa.array([xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in found], pa.binary())

    # A doc_id may repeat with other texts, so the node is made sure of.
    # Few texts are wanted, so most are left out before the shuffle.
    likely = sifted(documents.where("text is not null").select("doc_id", "text"), "doc_id", wanted.select("first_id"))
    rows = likely.join(wanted.withColumnRenamed("node", "wanted"), F.expr("doc_id <=> first_id")).select("wanted", "text", node_of("text").alias("node"))
    return rows.where("node = wanted").groupBy("node").agg(F.max("text").alias("text"))


def _blocks(rows: DataFrame, group: str, main: DataFrame, *kept: str) -> DataFrame:
    """Each group's texts outside its largest component against all of the group, cut into blocks.

    ``main`` has per group: n, its largest component ``main`` and the ``n_main`` texts of that. A
    text is repeated once for each block of the other side; at most about 2 * BLOCK meet in a task.
    """
    sized = staged(
        rows.join(main, group).select(
            group, "node", "root", *kept, (F.col("root") != F.col("main")).alias("outside"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("rows"),
            F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("columns"),
        ),
        "sized",
    )
    place = F.xxhash64("node", F.lit(5))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n: str) -> Column:
        return F.pmod(place, F.col(n)).cast("int")

    inner = sized.select(group, own("rows").alias("row"), every("columns").alias("column"), "node", "root", *kept, F.lit(0).alias("side"))
    outer = sized.where("outside").select(
        group, every("rows").alias("row"), own("columns").alias("column"), "node", "root", *kept, F.lit(1).alias("side")
    )
    return inner.unionByName(outer)


def _main(rows: DataFrame, group: str) -> DataFrame:
    parts = rows.groupBy(group, "root").agg(F.count(F.lit(1)).alias("n"))
    return parts.groupBy(group).agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"),
        F.max("n").alias("n_main"),
    ).where("roots > 1").drop("roots")


def _sides(group: pd.DataFrame):
    one, two = group[group.side == 1], group[group.side == 0]
    x, y = (np.frombuffer(b"".join(g.brief), np.uint8).reshape(-1, HASHES) for g in (one, two))
    numbers = {r: i for i, r in enumerate(dict.fromkeys([*one.root, *two.root]))}
    root_x, root_y = (np.array([numbers[r] for r in g.root], np.int64) for g in (one, two))
    return one, two, x, y, root_x, root_y


def _agreeing_clusters(group: pd.DataFrame) -> pd.DataFrame:
    """Edges that hold agreeing texts of different components together, as few as that takes."""
    one, two, x, y, root_x, root_y = _sides(group)
    node_x, node_y = one.node.to_numpy(), two.node.to_numpy()
    held, a, b = np.full(len(two), -1), [], []
    for k in range(len(one)):
        hits = np.flatnonzero(((y == x[k]).sum(1) >= _AGREE) & (root_y != root_x[k]))
        for other in np.unique(held[hits]):
            if other >= 0:
                a.append(node_x[k])
                b.append(node_x[other])
        new = hits[held[hits] < 0]
        held[new] = k
        a.extend(node_y[new])
        b.extend([node_x[k]] * len(new))
    return pd.DataFrame({"a": a, "b": b})


def _linked_components(group: pd.DataFrame) -> pd.DataFrame:
    """Links on full sets between texts of different components; one for each two that meet here."""
    one, two, x, y, root_x, root_y = _sides(group)
    if not len(one) or not len(two):
        return pd.DataFrame({"a": [], "b": []})
    sets = [np.frombuffer(v, np.uint64) for v in two.shingles]
    sizes = np.array([len(v) for v in sets])
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(where, kind="stable")
    holders = np.repeat(np.arange(len(sets)), sizes)[order]
    bounds = np.searchsorted(where[order], np.arange(len(values) + 1))
    merged = np.arange(max(root_x.max(), root_y.max()) + 1)
    a, b = [], []
    for k, shingles in enumerate(np.frombuffer(v, np.uint64) for v in one.shingles):
        hits = ((y == x[k]).sum(1) >= _AGREE) & (merged[root_y] != merged[root_x[k]])
        if not hits.any():
            continue
        at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
        at = at[values[at] == shingles]
        if not len(at):
            continue
        shared = np.bincount(np.concatenate([holders[bounds[v] : bounds[v + 1]] for v in at]), minlength=len(sets))
        linked = hits & (100 * shared >= SIMILARITY * (len(shingles) + sizes - shared))
        for j in np.flatnonzero(linked):
            if merged[root_y[j]] != merged[root_x[k]]:
                a.append(one.node.iloc[k])
                b.append(two.node.iloc[j])
                merged[merged == merged[root_y[j]]] = merged[root_x[k]]
    return pd.DataFrame({"a": a, "b": b})


def _rest(components: DataFrame, members: DataFrame, briefs: DataFrame, documents: DataFrame, firsts: DataFrame) -> DataFrame | None:
    """Links between components within larger regions, so that these miss none; None if there are none.

    First every text outside the largest component of its region is compared by signature with the
    whole region, and texts that agree are held together as clusters. Then each cluster's texts are
    compared on full shingle sets, again outside its largest component against all.
    """
    rooted = members.where(F.col("n") > NEIGHBOURS + 1).select("region", "node").join(components, "node", "left")
    rooted = rooted.select("region", "node", F.coalesce("root", "node").alias("root"))
    blocks = _blocks(rooted.join(briefs, "node"), "region", _main(rooted, "region"), "brief")
    agreeing = staged(
        blocks.groupBy("region", "row", "column").applyInPandas(_agreeing_clusters, "a binary, b binary").distinct(), "agreeing"
    )
    if not agreeing.limit(1).count():
        return None
    clusters = connected_components(agreeing).select("node", F.col("root").alias("cluster"))
    rooted = clusters.join(components, "node", "left").select("cluster", "node", F.coalesce("root", "node").alias("root"))

    @F.arrow_udf("binary")
    def shingles(texts: pa.Array) -> pa.Array:
        return pa.array([shingles_of(words_of(t)).tobytes() for t in pc.cast(texts, pa.binary()).to_pylist()], pa.binary())

    sets = _texts_of(documents, firsts, agreeing).select("node", shingles("text").alias("shingles"))
    full = rooted.join(briefs, "node").join(sets, "node")
    blocks = _blocks(full, "cluster", _main(rooted, "cluster"), "brief", "shingles")
    return blocks.groupBy("cluster", "row", "column").applyInPandas(_linked_components, "a binary, b binary")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``documents``."""
    rows = staged(signed(documents), "signed")
    texts = staged(
        rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.first("label").alias("label"), F.first("brief").alias("brief")
        ),
        "nodes",
    )
    briefs, firsts = texts.select("node", "brief"), texts.select("node", "first_id")
    members = staged(forest_members(texts), "members")
    pairs = staged(screened(candidates(members), briefs), "pairs")
    found = staged(_texts_of(documents, firsts, pairs), "texts")
    links = staged(confirmed(pairs, found), "confirmed")
    components = connected_components(links)
    more = _rest(components, members, briefs, documents, firsts)
    if more is not None:
        components = connected_components(links.unionByName(more))
    smallest = components.join(firsts, "node").groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = components.join(smallest, "root").select("node", "component_id")
    placed = firsts.join(of_node, "node", "left").select("node", F.coalesce("component_id", "first_id").alias("component_id"))
    with_words = rows.where("node is not null").select("doc_id", "node", "n_shingles").join(placed, "node")
    return (
        with_words.select("doc_id", "n_shingles", "component_id")
        .unionByName(rows.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
        .select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))
    )


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each group, with all columns; rows that repeat a kept one go as well.

    Rows without an id go where a copy with an id stays; otherwise they stay.
    """
    ids = near_duplicates(documents).where("kept").select(F.col("doc_id").alias("_kept_id"))
    return documents.join(ids, F.expr("doc_id <=> _kept_id"), "left_semi").dropDuplicates(["doc_id", "text"])
