"""Benchmark decontamination by a generalised suffix automaton of the test items.

The automaton is built over the items' normalised words. A document's words are streamed through
it, which keeps for each word the longest run ending there that stands in some item. Where that run
holds a whole window (13 words, or a shorter item complete), the window's words are hit. Words that
no item has end a run at once, so only stretches of known words at least as long as the shortest
window pass through the automaton; the rest is skipped without loss.

Items are taken in blocks of at most ``BLOCK_WORDS`` words (a longer item makes its own block), so
the automaton that is sent to the tasks has a bounded size whatever the benchmark's. Every block
looks at all documents.

Defined results: null texts and texts without words have no hits. Items without words have no
window. Items without item_id hit like others; together they count as one item, and the digest of
ids leaves them out. Repeated items and repeated documents count each by themselves; ``n_items`` counts distinct
item ids. Other columns are neither read nor changed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duewise.llm.shared import let_go, ready

WINDOW = 13
BLOCK_WORDS = 50_000
HIT_SHARE = 20  # contaminated if 20 * n_hit >= n_words
# Lower-case A-Z; digits, letters and every byte above ASCII stay, all else parts words.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


@dataclass
class Automaton:
    """Generalised suffix automaton over word numbers; state 0 is the start."""

    words: dict[bytes, int] = field(default_factory=dict)
    steps: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    items: dict[int, dict[int, list[str]]] = field(default_factory=dict)  # state -> window length -> items
    shortest: int = WINDOW

    def _extend(self, last: int, word: int) -> int:
        steps, link, length = self.steps, self.link, self.length
        if word in steps[last]:
            to = steps[last][word]
            if length[to] == length[last] + 1:
                return to
            return self._copy(last, word, to)
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and word not in steps[at]:
            steps[at][word] = new
            at = link[at]
        if at >= 0:
            to = steps[at][word]
            link[new] = to if length[to] == length[at] + 1 else self._copy(at, word, to)
        return new

    def _copy(self, at: int, word: int, to: int) -> int:
        steps, link, length = self.steps, self.link, self.length
        new = len(steps)
        steps.append(dict(steps[to]))
        length.append(length[at] + 1)
        link.append(link[to])
        link[to] = new
        while at >= 0 and steps[at].get(word) == to:
            steps[at][word] = new
            at = link[at]
        return new

    def holding(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a run that ends in ``state``.

        A walk that goes on from there looks at one word more than ``size`` each time, so all its
        climbs together take as many steps as it has words.
        """
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state


def build(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> Automaton:
    found = Automaton(shortest=window)
    numbered = []
    for name, text in items:
        numbers = [found.words.setdefault(w, len(found.words)) for w in normal_words(text)]
        if numbers:
            numbered.append((name, numbers))
            found.shortest = min(found.shortest, len(numbers))
            last = 0
            for number in numbers:
                last = found._extend(last, number)
    for name, numbers in numbered:
        size, state, run = min(window, len(numbers)), 0, 0
        for number in numbers:
            state, run = found.holding(found.steps[state][number], size), run + 1
            if run >= size:
                names = found.items.setdefault(state, {}).setdefault(size, [])
                if not names or names[-1] != name:
                    names.append(name)
    return found


def _scan(words: list[bytes], found: Automaton, window: int) -> tuple[list[tuple[int, int]], set[str]]:
    """Word ranges covered by window occurrences, merged and in order, and the items they come from."""
    get = found.words.get
    spans: list[tuple[int, int]] = []
    names: set[str] = set()
    if len(words) < found.shortest:
        return spans, names
    numbers = list(map(get, words))
    steps, link, length, items = found.steps, found.link, found.length, found.items
    seen_states = set()

    def hit(start: int, end: int) -> None:
        while spans and spans[-1][1] >= start:
            start = min(start, spans.pop()[0])
        spans.append((start, end))

    begin, n = 0, len(numbers)
    while begin < n:
        try:
            stop = numbers.index(None, begin)
        except ValueError:
            stop = n
        if stop - begin >= found.shortest:
            state = run = 0
            for at in range(begin, stop):
                number = numbers[at]
                while number not in steps[state]:
                    state = link[state]
                    if state < 0:
                        break
                    run = length[state]
                if state < 0:
                    state = run = 0
                    continue
                state, run = steps[state][number], run + 1
                if run > window:  # longer matches hold no other window that ends here
                    state, run = found.holding(state, window), window
                if run < found.shortest:
                    continue
                # Every window that ends here is the suffix of some size up to the run's.
                up = state
                while up > 0:
                    if up in items:
                        for size, of in items[up].items():
                            if size <= run:
                                hit(at + 1 - size, at + 1)
                                if (up, size) not in seen_states:
                                    seen_states.add((up, size))
                                    names.update(of)
                    up = link[up]
        begin = stop + 1
    return spans, names


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes]]]:
    """The items, a bounded number of words at a time."""
    sized = benchmark.where("text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")
    )
    words = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-words // (4 * block_words)))  # a word has two bytes at least, mostly more
    for block in range(blocks):
        part = sized.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        yield [(r.item_id, bytes(r.text)) for r in part.toLocalIterator()]


def _scan_column(spark, items: list[tuple[str, bytes]], window: int, text: Column) -> Column:
    held = spark.sparkContext.broadcast(build(items, window))

    @F.arrow_udf("struct<n_words:bigint, spans:array<struct<start:bigint, stop:bigint>>, items:array<string>>")
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = held.value
        kind = pa.struct([
            ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("items", pa.list_(pa.string())),
        ])
        try:
            for part in texts:
                rows = []
                for text in pc.cast(part, pa.binary()).to_pylist():
                    words = normal_words(text or b"")
                    spans, names = _scan(words, found, window)
                    rows.append({"n_words": len(words), "spans": [{"start": a, "stop": b} for a, b in spans], "items": list(names)})
                yield pa.array(rows, kind)
        finally:
            let_go()

    return scan(text)


def _summed(spans: Column, items: Column) -> Column:
    """Words within any span, and the distinct items with the digest of their ids."""
    ordered = F.array_sort(F.flatten(spans))
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hits"))

    def add(sofar: Column, span: Column) -> Column:
        new = F.greatest(F.lit(0).cast("long"), span["stop"] - F.greatest(sofar["end"], span["start"]))
        return F.struct(F.greatest(sofar["end"], span["stop"]).alias("end"), (sofar["hits"] + new).alias("hits"))

    names = F.array_distinct(F.flatten(items))
    digest = F.sha2(F.array_join(F.array_sort(F.array_compact(names)), ",").cast("binary"), 256)
    return F.struct(
        F.aggregate(ordered, start, add)["hits"].alias("n_hit"), F.size(names).cast("long").alias("n_items"), digest.alias("items_sha256")
    )


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """All columns of ``documents`` plus ``_found``: n_words, and the spans and items of each block."""
    spark = documents.sparkSession
    ready(spark)
    scans = [_scan_column(spark, items, window, F.col("text")) for items in item_blocks(benchmark, block_words)]
    return documents.withColumn("_found", F.array(*scans))


def contamination_report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document n_words, n_hit, n_items, items_sha256 and contaminated."""
    found = contamination(documents.select("doc_id", "text"), benchmark, window, block_words)
    return found.select("doc_id", F.col("_found")[0]["n_words"].alias("n_words"), _sums(F.col("_found")).alias("s")).select(
        "doc_id", "n_words", "s.n_hit", "s.n_items", "s.items_sha256",
        ((F.col("s.n_hit") > 0) & (HIT_SHARE * F.col("s.n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _sums(found: Column) -> Column:
    """Most documents have no hit; those need no sums."""
    none = F.struct(F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.lit(hashlib.sha256(b"").hexdigest()).alias("items_sha256"))
    return F.when(F.exists(found, lambda f: F.size(f["spans"]) > 0), _summed(found["spans"], found["items"])).otherwise(none)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, all columns, whose hits stay below the limit; their texts stay as they are."""
    names = documents.columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text")
    found = contamination(rows, benchmark, window).select("_row", F.col("_found")[0]["n_words"].alias("_n"), _sums(F.col("_found")).alias("_s"))
    dirty = (F.col("_s.n_hit") > 0) & (HIT_SHARE * F.col("_s.n_hit") >= F.col("_n"))
    return found.where(~dirty).select("_row.*")


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, longest: int = WINDOW, share: int = HIT_SHARE) -> DataFrame:
    """doc_id, text and removed: spans of at least ``longest`` words go, and all spans of documents
    whose hits reach one ``share``-th of the words. The text between kept words stays as it is."""

    @F.arrow_udf("struct<text:string, removed:bigint>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, parts in zip(pc.cast(texts, pa.binary()).to_pylist(), spans.to_pylist()):
            merged = _merged([(s["start"], s["stop"]) for part in parts for s in part])
            if text is None or not merged:
                out.append({"text": None if text is None else text.decode(), "removed": 0})
                continue
            plain = text.translate(_WORDS)
            bounds, at = [], 0
            for word in plain.split():
                at = plain.index(word, at)
                bounds.append((at, at + len(word)))
                at += len(word)
            whole = share * sum(b - a for a, b in merged) >= len(bounds)
            keep, done, removed = [], 0, 0
            for a, b in merged:
                if whole or b - a >= longest:
                    keep.append(text[done : bounds[a][0]])
                    done, removed = bounds[b - 1][1], removed + b - a
            out.append({"text": b"".join([*keep, text[done:]]).decode(), "removed": removed})
        return pa.array(out, pa.struct([("text", pa.string()), ("removed", pa.int64())]))

    found = contamination(documents.select("doc_id", "text"), benchmark, window)
    return found.select("doc_id", cut("text", F.col("_found")["spans"]).alias("c")).select("doc_id", "c.*")
