"""Links are looked up for some documents of a block at a time."""

import random

from duewise.llm import token_alignment as ta


def test_a_block_of_several_slices_counts_like_small_blocks(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abeinorst") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(3_000))) for k in range(36)] + [(100, None), (101, ""), (102, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    one = sorted(map(tuple, ta.align_tokenizers(docs, block_bytes=64 << 20).collect()))
    small = sorted(map(tuple, ta.align_tokenizers(docs, block_bytes=20_000).collect()))
    assert sum(r[1] + r[2] for r in one) > 2 * ta.SUMMED_TOKENS
    assert one == small and len(one) == 39


def test_streams_and_blocks_are_small():
    assert ta.STREAM_BYTES <= 1 << 18 and ta.BLOCK_BYTES <= 2 << 20
