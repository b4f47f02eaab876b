"""Token ids behind one another, with Elias-Fano coded document boundaries.

Texts are encoded, dealt out by ranges of doc_id and sorted, so that ids follow in ascending doc_id
order. A block of the file format is one row of a Parquet file in the shared folder:

* ``ids``: the ids of its documents as little-endian unsigned 16-bit integers (32-bit, if the
  vocabulary needs them; ``width`` says which);
* ``low``, ``high``: the documents' end positions in Elias-Fano code. The low bits of each are
  packed, the high bits stand in unary in ``high``; ``low_bits`` is their number. That takes about
  2 + log2(ids per document) bits a document, where a table of offsets takes 64;
* ``marks``: the place in ``high`` of every 64th end, so that any end is found (select) by reading
  a few bytes instead of adding up all before it;
* ``doc_ids``: the ascending doc ids less the first one, coded alike.

Where a block starts in the whole is the sum of the blocks before it, added up per partition and
then over the partitions' totals, and written as a second small table. Parquet and Spark's commit
let a lost executor's work be done again, and any store that Spark knows can hold the files.

Encoding goes through the tokenizers library. Its pre-tokenizer never joins what a single space
parts, nor a single line break, so texts are cut there, pieces seen before in the task come from a memory bounded in pieces and bytes, and new ones are
encoded some together as one text whose ids are parted where pieces begin; texts with other white space next to white space are encoded as they are.

Defined results: a null or empty text has the end id only. Repeated ids and rows follow one another.
Rows without a doc_id come first. An empty table writes no block. Other columns are not read.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duewise.llm.shared import let_go, ready
from duewise.session import stage_dir

END_ID = 0
BLOCK_IDS = 2_000_000  # a block ends with the document that reaches this
MARK_EVERY = 64
MEMORY = 400_000  # pieces remembered within a task, twice
MEMORY_BYTES = 24 << 20  # of text in them, twice
JOINED = 50  # pieces that are encoded as one text; longer ones take more time a piece
_TIGHT = re.compile(r"\s\s")  # white space beside white space


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# ---- Elias-Fano -------------------------------------------------------------------------------

def ef_encode(values: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(low_bits, low, high, marks) of ascending whole numbers from 0."""
    values = np.asarray(values, np.int64)
    n = len(values)
    low_bits = max(0, int(int(values[-1]) // n).bit_length() - 1) if n else 0
    low = b""
    if low_bits and n:
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    places = (values >> low_bits) + np.arange(n)
    bits = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
    bits[places] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    return low_bits, low, high, places[::MARK_EVERY].astype("<u4").tobytes()


def ef_decode(n: int, low_bits: int, low: bytes, high: bytes) -> np.ndarray:
    """All values again."""
    places = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8), bitorder="little"))[:n]
    out = (places - np.arange(n)) << low_bits
    if low_bits and n:
        bits = np.unpackbits(np.frombuffer(low, np.uint8), bitorder="little")[: n * low_bits].reshape(n, low_bits)
        out = out | (bits.astype(np.int64) << np.arange(low_bits)).sum(1)
    return out.astype(np.int64)


def ef_select(k: int, low_bits: int, low: bytes, high: bytes, marks: bytes) -> int:
    """The k-th value, read from the mark before it."""
    mark = int(np.frombuffer(marks, "<u4")[k // MARK_EVERY])
    left, byte = k % MARK_EVERY, mark // 8
    current = high[byte] >> (mark % 8) << (mark % 8)
    while (ones := current.bit_count()) <= left:
        left -= ones
        byte += 1
        current = high[byte]
    for _ in range(left):
        current &= current - 1
    place = byte * 8 + (current & -current).bit_length() - 1
    value = (place - k) << low_bits
    if low_bits:
        start = k * low_bits
        part = int.from_bytes(low[start // 8 : (start + low_bits + 7) // 8], "little") >> (start % 8)
        value |= part & ((1 << low_bits) - 1)
    return value


# ---- encoding ---------------------------------------------------------------------------------

class PieceEncoder:
    """Ids of whole texts, with a bounded memory of pieces."""

    def __init__(self, path: str, memory: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memory, self.held_bytes = memory, 0
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what was known before, until known is full again
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        # Byte-level tokens are written with one character per byte, a space and a line break with these.
        self.opens, self.breaks = np.zeros(self.tokenizer.get_vocab_size(), bool), np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.opens[number], self.breaks[number] = token[:1] in ("\u0120", "\u010a"), token == "\u010a"
        self.end = np.array([END_ID], self.kind).tobytes()

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces as a few texts, and part their ids where pieces begin.

        A line break, which is an id of its own, stands before a piece that brings no space. As
        pieces hold neither further on, ids that begin with either begin a piece.
        """
        clear = [p for p in pieces if not p[-1].isspace() and (p[0] == " " or not p[0].isspace())]
        joined = [p if p[0] == " " else "\n" + p for p in clear]
        texts = ["".join(joined[at : at + JOINED]) for at in range(0, len(joined), JOINED)]
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, self.kind), *(np.array(c.ids, self.kind) for c in coded)])
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) == len(clear):
            stops = np.append(begins[1:], len(ids))
            places = map(slice, ((begins + self.breaks[ids[begins]]) * self.width).tolist(), (stops * self.width).tolist())
            self.known.update(zip(clear, map(ids.tobytes().__getitem__, places)))
        for piece in pieces:
            if piece not in self.known:
                self.known[piece] = self._ids(piece)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as bytes, with the end id."""
        if len(self.known) > (self.memory or MEMORY) or self.held_bytes > MEMORY_BYTES:
            self.older, self.known, self.held_bytes = self.known, {}, 0
        known, older, out, open_texts, new = self.known, self.older, [], [], set()
        for text in texts:
            if text and (_TIGHT.search(text) or "\0" in text):
                out.append(self._ids(text) + self.end)
                continue
            # As no white space stands beside white space, only the first and the last piece may be empty.
            pieces = (text or "").replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
            if not pieces[-1]:
                pieces.pop()
            if pieces and not pieces[0]:
                del pieces[0]
            found = list(map(known.get, pieces))
            try:
                out.append(b"".join(found) + self.end)
            except TypeError:  # some are not known yet
                holes = [k for k, ids in enumerate(found) if ids is None]
                new.update(map(pieces.__getitem__, holes))
                open_texts.append((len(out), pieces, found, holes))
                out.append(b"")
        again = [p for p in new if p in older]
        known.update((p, older[p]) for p in again)
        new.difference_update(again)
        self.held_bytes += sum(map(len, new)) + sum(map(len, again))
        # Letters and a sign after them are never one token, so only the letters may be new.
        signed = [p for p in new if p[-1] in ".,!?;:" and p[p[0] == " " : -1].isalpha()]
        new.difference_update(signed)
        new.update(p for s in signed for p in (s[:-1], s[-1]) if p not in known)
        plain = list(new)
        for at in range(0, len(plain), 20_000):
            self._learn(plain[at : at + 20_000])
        for piece in signed:
            known[piece] = known[piece[:-1]] + known[piece[-1]]
        for at, pieces, found, holes in open_texts:
            for k in holes:
                found[k] = known[pieces[k]]
            out[at] = b"".join(found) + self.end
        return out

    def forget(self) -> None:
        self.known, self.older, self.held_bytes = {}, {}, 0


def forget_pieces() -> None:
    """Workers live on, so what encoding tasks remembered goes with the first other task."""
    if any(held.known or held.older for held in _encoders.values()):
        for held in _encoders.values():
            held.forget()
        let_go()


_encoders: dict[str, PieceEncoder] = {}  # one per worker and file


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


# ---- writing and reading ----------------------------------------------------------------------

_BLOCK = (
    "part int, block int, n_docs long, n_null long, first_doc long, n_ids long, width int, ids binary, "
    "low_bits int, low binary, high binary, marks binary, doc_low_bits int, doc_low binary, doc_high binary, doc_marks binary"
)


def _block(part: int, number: int, docs: list[int | None], ids: list[bytes], width: int) -> dict:
    ends = np.cumsum([len(i) // width for i in ids])
    known = np.array([d for d in docs if d is not None], np.int64)
    first = int(known[0]) if len(known) else 0
    low_bits, low, high, marks = ef_encode(ends)
    d_bits, d_low, d_high, d_marks = ef_encode(known - first)
    return {
        "part": part, "block": number, "n_docs": len(docs), "n_null": len(docs) - len(known), "first_doc": first,
        "n_ids": int(ends[-1]), "width": width, "ids": b"".join(ids), "low_bits": low_bits, "low": low, "high": high,
        "marks": marks, "doc_low_bits": d_bits, "doc_low": d_low, "doc_high": d_high, "doc_marks": d_marks,
    }


def write_token_files(documents: DataFrame, folder: str, tokenizer: str | None = None, block_ids: int = BLOCK_IDS) -> None:
    """Encode ``documents`` into ``folder``/blocks, and the blocks' starts into ``folder``/starts."""
    spark = documents.sparkSession
    ready(spark)
    tokenizer = tokenizer or default_tokenizer()
    segments = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("first_doc", pa.int64()),
        ("n_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()),
        ("high", pa.binary()), ("marks", pa.binary()), ("doc_low_bits", pa.int32()), ("doc_low", pa.binary()),
        ("doc_high", pa.binary()), ("doc_marks", pa.binary()),
    ])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, docs, ids, size, part = encoder(tokenizer), 0, [], [], 0, 0
        try:
            for batch in batches:
                part = batch.column("part")[0].as_py() if len(batch) else part
                for at in range(0, len(batch), 256):
                    piece = batch.slice(at, 256)
                    for doc, coded in zip(piece.column("doc_id").to_pylist(), held.encode(piece.column("text").to_pylist())):
                        docs.append(doc)
                        ids.append(coded)
                        size += len(coded) // held.width
                        if size >= block_ids:
                            yield pa.RecordBatch.from_pylist([_block(part, number, docs, ids, held.width)], schema)
                            number, docs, ids, size = number + 1, [], [], 0
            if docs:
                yield pa.RecordBatch.from_pylist([_block(part, number, docs, ids, held.width)], schema)
        finally:  # pieces stay for the worker's next task; reading, which follows, forgets them
            let_go()

    (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(segments, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
        .mapInArrow(blocks, _BLOCK)
        .write.parquet(f"{folder}/blocks")
    )
    sizes = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks").select("part", "block", "n_ids")
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition is added up in order, as many as there are shuffle partitions.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    (
        sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("part", "block", (F.col("ahead") + F.col("within")).alias("start"))
        .write.parquet(f"{folder}/starts")
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files alone."""
    ready(spark)
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    starts = spark.read.schema("part int, block int, start long").parquet(f"{folder}/starts")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_pieces()
        for batch in batches:
            for b in batch.to_pylist():
                ends = ef_decode(b["n_docs"], b["low_bits"], b["low"], b["high"])
                known = ef_decode(b["n_docs"] - b["n_null"], b["doc_low_bits"], b["doc_low"], b["doc_high"]) + b["first_doc"]
                begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                wide = np.frombuffer(b["ids"], f"<u{b['width']}").astype("<u4").tobytes()
                view = memoryview(wide)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None] * b["n_null"] + known.tolist(), pa.int64()),
                        pa.array(begins + b["start"]),
                        pa.array(ends - begins),
                        pa.array([zlib.crc32(view[4 * i : 4 * j]) for i, j in zip(begins.tolist(), ends.tolist())], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    narrow = blocks.select("part", "block", "n_docs", "n_null", "first_doc", "width", "ids", "low_bits", "low", "high", "doc_low_bits", "doc_low", "doc_high")
    # The starts have one narrow row per block of MBs, so they are small beside the blocks.
    return narrow.join(starts, ["part", "block"]).mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_texts_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id and ids of every document, from the files."""
    ready(spark)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_pieces()
        for batch in batches:
            for b in batch.to_pylist():
                ends = ef_decode(b["n_docs"], b["low_bits"], b["low"], b["high"])
                known = ef_decode(b["n_docs"] - b["n_null"], b["doc_low_bits"], b["doc_low"], b["doc_high"]) + b["first_doc"]
                ids = np.frombuffer(b["ids"], f"<u{b['width']}").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None] * b["n_null"] + known.tolist(), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids)),
                    ],
                    names=["doc_id", "ids"],
                )

    return spark.read.schema(_BLOCK).parquet(f"{folder}/blocks").mapInArrow(documents, "doc_id long, ids array<int>")


def token_files(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``documents`` to a new folder in the shared one, and read them back."""
    spark = documents.sparkSession
    folder = f"{stage_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(documents, folder, tokenizer)
    return read_token_files(spark, folder)
