"""Alignment of two tokenizers' ids on each text, and how often each pair of ids meets in the corpus.

Both tokenizers encode a space and the text. A group ends where a token of each ends at the same
byte. Groups are found by skipping runs along a diagonal: at the current shift between the two
arrays of token ends, stretches of doubling length are compared until they differ, the longest equal
stretch is jumped over (one-to-one groups), the irregular group behind it is resolved token by
token, and its sizes give the next shift. Where the arrays begin anew with each text both hold an
end, so the texts of a batch form one stream.

Two passes. The first encodes and aligns; a block of some MB of text becomes one Parquet row with
its ids, a bit per token that ends a group, and the counts of the block's distinct pairs. Spark adds
the counts up over all blocks and writes each block's pairs with their totals to a folder per
part, so that the second pass, which adds up links per document, reads beside each block only that
block's own pairs. Nothing that grows with the corpus is broadcast, and texts are not shuffled.
pyarrow has to know the shared folder's store.

Defined results: texts that are null or empty, or that either tokenizer does not give back byte for
byte, have no tokens: zeros and an empty digest. Strings of special tokens are plain text. Repeated
rows and ids each count and each return; a null doc_id stays null. Links and counts are whole
numbers of 64 bits. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duewise.llm.shared import flat_bytes, let_go, ready
from duewise.llm.token_files import PieceEncoder, default_tokenizer
from duewise.session import staged_folder

BLOCK_BYTES = 2 << 20  # a block ends with the document that reaches this
GROUP_BLOCKS = 4  # written together: Parquet's writer would hold 100 rows before it first looks at their size, and its reader a group
STREAM_BYTES = 1 << 18  # of texts that are encoded together
SUMMED_TOKENS = 200_000  # of both sides, whose links are looked up together
CUT_BYTES = 1 << 20  # longer texts are not cut into words for side b
PIECES, WORDS = 150_000, 200_000  # of either side, remembered within a task


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# ---- run skipping -----------------------------------------------------------------------------

def skip_runs(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """Places of the tokens of each side that do not end a group; both lists rise to the same last end."""
    inner_a, inner_b, n = [], [], len(ends_a)
    over_a, over_b = inner_a.append, inner_b.append
    i = j = 0
    while i < n:
        a, b = ends_a[i], ends_b[j]
        if a == b:
            i += 1
            j += 1
            if i == n:
                break
            a, b = ends_a[i], ends_b[j]
            if a == b:  # a stretch of two at least: how long does it go on?
                i, j, step = i + 1, j + 1, 2
                while (piece := ends_a[i : i + step]) and piece == ends_b[j : j + step]:
                    i, j, step = i + len(piece), j + len(piece), 2 * step
                while step > 1:  # the difference lies within the last stretch
                    step //= 2
                    if (piece := ends_a[i : i + step]) and piece == ends_b[j : j + step]:
                        i, j = i + len(piece), j + len(piece)
                if i == n:
                    break
                a, b = ends_a[i], ends_b[j]
        while a != b:
            if a < b:
                over_a(i)
                i += 1
                a = ends_a[i]
            else:
                over_b(j)
                j += 1
                b = ends_b[j]
        i += 1
        j += 1
    return inner_a, inner_b


def links(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of both tokens of every link. ``last_*`` says which tokens end a group.

    Each end starts or closes exactly one overlap: group ends belong to the two tokens that end
    there, an inner end to its token and the one of the other side that lies over it.
    """
    inner_a, inner_b = np.flatnonzero(~last_a), np.flatnonzero(~last_b)
    over_b = np.searchsorted(ends_b, ends_a[inner_a])
    over_a = np.searchsorted(ends_a, ends_b[inner_b])
    return np.concatenate([np.flatnonzero(last_a), inner_a, over_a]), np.concatenate([np.flatnonzero(last_b), over_b, inner_b])


# ---- the two tokenizers -------------------------------------------------------------------------

def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Side:
    """Bytes of every id: all behind one another, where each starts, and how many it has."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.kind = np.dtype("<u2" if len(tokens) <= 1 << 16 else "<u4")

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ids) else 0)]


class Pair:
    """Both tokenizers with their ids' bytes."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = PieceEncoder(path_a, PIECES)
        self.a.tokenizer.encode_special_tokens = True
        alphabet, names = _byte_alphabet(), {}
        for token, number in self.a.tokenizer.get_vocab().items():
            names[number] = token
        self.side_a = _Side([bytes(alphabet.get(c, 0) for c in names.get(k, "")) for k in range(1 + max(names))])
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)

        def piece(k: int) -> bytes:
            token = self.b.id_to_piece(k)
            return bytes([int(token[3:5], 16)]) if self.b.is_byte(k) else token.replace("▁", " ").encode()

        tokens = [piece(k) for k in range(self.b.vocab_size())]
        self.side_b = _Side(tokens)
        # Where no piece holds a space behind another sign, a text's words, parted by single spaces, are encoded apart.
        self.by_words = all(b" " not in t.lstrip(b" ") for t in tokens)
        self.words: dict[str, bytes] = {}
        most = max(len(self.side_a.sizes), len(self.side_b.sizes))
        self.written = [f"{k}{sign}" for k in range(most) for sign in ",|;"]

    def encode_b(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of side b; words seen before come from a memory of WORDS entries."""
        if len(self.words) > WORDS:
            self.words = {}
        known, kind = self.words, self.side_b.kind
        out, open_texts, new = [], [], set()
        for t in texts:
            if not self.by_words or "  " in t or "▁" in t or t[:1] == " " or t[-1:] == " " or len(t) > CUT_BYTES:
                out.append(np.array(self.b.encode(t, num_threads=1), kind))
                continue
            words = t.split(" ")
            found = list(map(known.get, words))
            try:
                out.append(np.frombuffer(b"".join(found), kind))
            except TypeError:  # some are not known yet
                holes = [k for k, ids in enumerate(found) if ids is None]
                new.update(map(words.__getitem__, holes))
                open_texts.append((len(out), words, found, holes))
                out.append(None)
        new = list(new)
        coded = self.b.encode(new, num_threads=1)
        ends = np.cumsum([0, *map(len, coded)]) * kind.itemsize
        whole = np.fromiter(chain.from_iterable(coded), kind).tobytes()
        known.update(zip(new, map(whole.__getitem__, map(slice, ends[:-1].tolist(), ends[1:].tolist()))))
        for at, words, found, holes in open_texts:
            for k in holes:
                found[k] = known[words[k]]
            out[at] = np.frombuffer(b"".join(found), kind)
        return out

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides per text, none where a side does not give the text back."""
        coded = self.a.encode([" " + t for t in texts])
        ids_a = [np.frombuffer(c, self.a.kind)[:-1] for c in coded]
        ids_b = self.encode_b(texts)
        wanted, starts = flat_bytes(pa.array([" " + t for t in texts], pa.large_string()))
        good = np.array([bool(t) for t in texts], bool)
        for ids, side in ((ids_a, self.side_a), (ids_b, self.side_b)):
            good &= np.array([int(side.sizes[i].sum()) for i in ids], np.int64) == np.diff(starts)
        for ids, side in ((ids_a, self.side_a), (ids_b, self.side_b)):
            kept = np.flatnonzero(good)
            if len(kept):
                joined, at = side.joined(np.concatenate([ids[k] for k in kept])), 0
                for k in kept:
                    size = starts[k + 1] - starts[k]
                    good[k] = np.array_equal(joined[at : at + size], wanted[starts[k] : starts[k + 1]])
                    at += size
        none = np.zeros(0, np.int64)
        return [x if g else none for x, g in zip(ids_a, good)], [x if g else none for x, g in zip(ids_b, good)]

    def digests(self, ids_a, ids_b, last_a, last_b, n_a, n_b) -> list[str]:
        """The digest of each text's groups."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        # A token stands behind the other side's tokens of earlier groups, and of its own if it is of side b.
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[np.arange(len(ids_a)) + np.concatenate([[0], ends_b])[group_a]] = 3 * ids_a.astype(np.int64) + last_a
        codes[np.arange(len(ids_b)) + ends_a[group_b]] = 3 * ids_b.astype(np.int64) + 2 * last_b
        parts, out, at = list(map(self.written.__getitem__, codes.tolist())), [], 0
        for size in (n_a + n_b).tolist():
            out.append(hashlib.sha256("".join(parts[at : at + size])[:-1].encode()).hexdigest() if size else "")
            at += size
        return out


# ---- first pass -----------------------------------------------------------------------------------

_BLOCK = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())),
    ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("digests", pa.list_(pa.string())),
    ("ids_a", pa.binary()), ("ids_b", pa.binary()), ("last_a", pa.binary()), ("last_b", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
])
_BLOCK_SQL = (
    "part int, block int, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, "
    "ids_a binary, ids_b binary, last_a binary, last_b binary, pairs array<long>, counts array<long>"
)


def _pair_keys(ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    return ids_b[at_b].astype(np.int64) << 32 | ids_a[at_a].astype(np.int64)


def _per_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive values, ``sizes`` of them each."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    whole, back = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(whole), np.int64)
    np.add.at(sums, back, np.concatenate(counts))
    return whole, sums


class _Blocks:
    """Gathers aligned streams of texts until a block is full."""

    def __init__(self, pair: Pair):
        self.pair, self.part, self.number = pair, TaskContext.get().partitionId(), 0
        self._new()

    def _new(self) -> None:
        self.docs, self.columns, self.keys, self.counts, self.size = [], [], [], [], 0

    def add(self, docs: list[int | None], texts: list[str | None]) -> None:
        pair = self.pair
        lists_a, lists_b = pair.encode([t or "" for t in texts])
        n_a, n_b = np.array([len(i) for i in lists_a], np.int64), np.array([len(i) for i in lists_b], np.int64)
        ids_a, ids_b = np.concatenate(lists_a).astype(pair.side_a.kind), np.concatenate(lists_b).astype(pair.side_b.kind)
        ends_a, ends_b = np.cumsum(pair.side_a.sizes[ids_a]), np.cumsum(pair.side_b.sizes[ids_b])
        inner_a, inner_b = skip_runs(ends_a.tolist(), ends_b.tolist())
        last_a, last_b = np.ones(len(ids_a), bool), np.ones(len(ids_b), bool)
        last_a[inner_a] = False
        last_b[inner_b] = False
        keys, counts = np.unique(_pair_keys(ids_a, ids_b, *links(ends_a, ends_b, last_a, last_b)), return_counts=True)
        digests = pair.digests(ids_a, ids_b, last_a, last_b, n_a, n_b)
        self.docs.extend(docs)
        self.columns.append((n_a, n_b, _per_text(last_a, n_a), digests, ids_a, ids_b, last_a, last_b))
        self.keys.append(keys)
        self.counts.append(counts)
        if len(self.keys) > 8:
            merged = _added(self.keys, self.counts)
            self.keys, self.counts = [merged[0]], [merged[1]]
        self.size += int(ends_a[-1]) if len(ends_a) else 0
        self.size += len(docs)

    def row(self) -> pa.RecordBatch:
        n_a, n_b, n_groups, digests, ids_a, ids_b, last_a, last_b = zip(*self.columns)
        pairs, counts = _added(self.keys, self.counts)
        row = {
            "part": self.part, "block": self.number, "doc_ids": self.docs, "n_a": np.concatenate(n_a), "n_b": np.concatenate(n_b),
            "n_groups": np.concatenate(n_groups), "digests": [d for ds in digests for d in ds],
            "ids_a": np.concatenate(ids_a).tobytes(), "ids_b": np.concatenate(ids_b).tobytes(),
            "last_a": np.packbits(np.concatenate(last_a)).tobytes(), "last_b": np.packbits(np.concatenate(last_b)).tobytes(),
            "pairs": pairs, "counts": counts,
        }
        self.number += 1
        self._new()
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, len(row[f.name])], pa.int32()), pa.array(row[f.name], f.type.value_type)) if pa.types.is_list(f.type)
             else pa.array([row[f.name]], f.type) for f in _BLOCK],
            schema=_BLOCK,
        )


_pairs: dict[tuple[str, str], Pair] = {}  # one per worker


def aligned_blocks(documents: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Encode and align all texts; one row per block, staged in the shared folder."""
    spark = documents.sparkSession
    ready(spark)
    files = path_a or default_tokenizer(), path_b or default_pieces()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if files not in _pairs:
            _pairs.clear()
            _pairs[files] = Pair(*files)
        gathered = _Blocks(_pairs[files])
        try:
            for batch in batches:
                docs, texts, at, size = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), 0, 0
                for k, text in enumerate(texts):
                    size += len(text or "")
                    if size >= STREAM_BYTES or k + 1 == len(texts):
                        gathered.add(docs[at : k + 1], texts[at : k + 1])
                        at, size = k + 1, 0
                        if gathered.size >= block_bytes:
                            yield gathered.row()
            if gathered.docs:
                yield gathered.row()
        finally:  # what is remembered ends with the task
            _pairs[files].a.forget()
            _pairs[files].words = {}
            del gathered
            let_go()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(blocks, _BLOCK_SQL)
    folder = staged_folder(rows, "aligned", **{"parquet.block.row.count.limit": GROUP_BLOCKS})
    return spark.read.schema(_BLOCK_SQL).parquet(folder)


# ---- second pass ----------------------------------------------------------------------------------

def link_counts(blocks: DataFrame) -> DataFrame:
    """pair (b << 32 | a), n_pair (its links in all texts) and best (none of its b has more)."""
    counted = (
        blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.counts").alias("n_pair"))
    )
    # An id of b has at most as many rows here as a's vocabulary has ids.
    most = F.max("n_pair").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counted.select("pair", "n_pair", (F.col("n_pair") == most).alias("best"))


_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _totals_of(folder: str, part: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's pairs in rising order with their totals."""
    store, path = fs.FileSystem.from_uri(f"{folder}/part={part}")
    files = [f.path for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet")]
    if not files:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    rows = pads.dataset(files, filesystem=store, format="parquet").to_table(
        columns=["pair", "n_pair", "best"], filter=pads.field("block") == block, use_threads=False
    )
    rows = [rows[c].to_numpy() for c in ("pair", "n_pair", "best")]
    order = np.argsort(rows[0], kind="stable")
    return tuple(r[order] for r in rows)


def align_tokenizers(documents: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: numbers of tokens, groups and links, links with their b id's commonest partner, and the sum of counts."""
    spark = documents.sparkSession
    ready(spark)
    files = path_a or default_tokenizer(), path_b or default_pieces()
    blocks = aligned_blocks(documents, *files, block_bytes)
    own = blocks.select("part", "block", F.explode("pairs").alias("pair")).join(link_counts(blocks), "pair")
    folder = staged_folder(own.repartition("part").sortWithinPartitions("part", "block", "pair"), "totals", "part")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if files not in _pairs:
            _pairs.clear()
            _pairs[files] = Pair(*files)
        a, b = _pairs[files].side_a, _pairs[files].side_b
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                n_a, n_b, n_groups = (row[c].values.to_numpy(zero_copy_only=False) for c in ("n_a", "n_b", "n_groups"))
                ids_a, ids_b = np.frombuffer(row["ids_a"].as_buffer(), a.kind), np.frombuffer(row["ids_b"].as_buffer(), b.kind)
                last_a = np.unpackbits(np.frombuffer(row["last_a"].as_buffer(), np.uint8), count=len(ids_a)).astype(bool)
                last_b = np.unpackbits(np.frombuffer(row["last_b"].as_buffer(), np.uint8), count=len(ids_b)).astype(bool)
                pairs, totals, best = _totals_of(folder, row["part"].as_py(), row["block"].as_py())
                n_best, count_sum = np.zeros(len(n_a), np.int64), np.zeros(len(n_a), np.int64)
                ends_a, ends_b = np.cumsum(n_a), np.cumsum(n_b)
                # Links never cross documents, so some documents at a time do, and arrays stay small.
                cuts = np.flatnonzero(np.diff((ends_a + ends_b) // SUMMED_TOKENS)) + 1
                for docs in map(slice, [0, *cuts.tolist()], [*cuts.tolist(), len(n_a)]):
                    if docs.stop == docs.start:
                        continue
                    of_a = slice(ends_a[docs.start] - n_a[docs.start], ends_a[docs.stop - 1])
                    of_b = slice(ends_b[docs.start] - n_b[docs.start], ends_b[docs.stop - 1])
                    at_a, at_b = links(np.cumsum(a.sizes[ids_a[of_a]]), np.cumsum(b.sizes[ids_b[of_b]]), last_a[of_a], last_b[of_b])
                    if len(at_a):
                        place = np.searchsorted(pairs, _pair_keys(ids_a[of_a], ids_b[of_b], at_a, at_b))
                        text = np.searchsorted(np.cumsum(n_a[docs]), at_a, "right")
                        np.add.at(n_best[docs], text, best[place].astype(np.int64))
                        np.add.at(count_sum[docs], text, totals[place])
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_a + n_b - n_groups),
                     pa.array(n_best), pa.array(count_sum), row["digests"].values],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return blocks.drop("pairs", "counts").mapInArrow(summed, _RESULT)


def aligned_tokens(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, both sides' ids, and for each token whether a group ends with it."""
    blocks = aligned_blocks(documents, path_a, path_b)
    files = path_a or default_tokenizer(), path_b or default_pieces()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if files not in _pairs:
            _pairs.clear()
            _pairs[files] = Pair(*files)
        sides = _pairs[files].side_a.kind, _pairs[files].side_b.kind
        for batch in batches:
            for row in batch.to_pylist():
                columns = [pa.array(row["doc_ids"], pa.int64())]
                for name, kind in zip("ab", sides):
                    ids = np.frombuffer(row[f"ids_{name}"], kind)
                    last = np.unpackbits(np.frombuffer(row[f"last_{name}"], np.uint8), count=len(ids)).astype(bool)
                    offsets = pa.array(np.concatenate([[0], np.cumsum(row[f"n_{name}"])]).astype(np.int32))
                    columns += [pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(last))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids_a", "last_a", "ids_b", "last_b"])

    return blocks.mapInArrow(split, "doc_id long, ids_a array<int>, last_a array<boolean>, ids_b array<int>, last_b array<boolean>")
