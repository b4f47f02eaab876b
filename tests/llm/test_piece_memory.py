"""Pieces are parted where they begin, and are kept until another task than encoding runs."""

import random

import numpy as np

from duewise.llm import token_files as tf


def test_ids_are_the_tokenizers_and_go_when_asked():
    held, rng = tf.encoder(tf.default_tokenizer()), random.Random(5)
    signs = [" ", " ", "\n", "\t", "\xa0", "a", "be", "É", "7", ".", "!", "'s", "<|endoftext|>", "日", "\r", "\0", "don't", "🙂", "|"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(8_000)] + [None, "", " ", "\n", "\xa0<|endoftext|>"]
    coded = [c for at in range(0, len(texts), 200) for c in held.encode(texts[at : at + 200])]
    for text, ids in zip(texts, coded):
        wanted = held.tokenizer.encode(text or "", add_special_tokens=False).ids + [tf.END_ID]
        assert np.frombuffer(ids, held.kind).tolist() == wanted, text
    assert held.known
    tf.forget_pieces()
    assert not held.known and not held.older and not held.held_bytes
