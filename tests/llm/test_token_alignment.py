from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from duewise.llm import token_alignment as ta
from duewise.llm.shared import table
from duewise.llm.token_files import default_tokenizer

ODD = ["é", "ﬁ  two  spaces", "▁ mark", "<s> </s> <|endoftext|> <0x41>", "a\tb c\nd", "日本語 text", "\0", " lead", "trail ", "x" * 3000, "🙂🙂 ok"]


def plain_tokens(text):
    """(id, start, end) in bytes of both tokenizers, or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    if "held" not in plain_tokens.__dict__:
        a = Tokenizer.from_file(default_tokenizer())
        a.encode_special_tokens = True
        plain_tokens.held = a, sentencepiece.SentencePieceProcessor(model_file=ta.default_pieces()), ta._byte_alphabet()
    a, b, alphabet = plain_tokens.held
    if not text:
        return None
    wanted, out = (" " + text).encode(), []
    coded = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    pieces = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    for side in (coded, pieces):
        if b"".join(t for _, t in side) != wanted:
            return None
        at, spans = 0, []
        for i, t in side:
            spans.append((i, at, at + len(t)))
            at += len(t)
        out.append(spans)
    return out


def plain(rows):
    per, counts = [], Counter()
    for doc, text in rows:
        tokens = plain_tokens(text)
        if tokens is None:
            per.append((doc, 0, 0, 0, [], ""))
            continue
        a, b = tokens
        linked, j = [], 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                linked.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for s, e in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, x, y in side if s <= x and y <= e) for side in (a, b)) if len(cuts) < 400 else None)
        if None in groups:
            groups, ia, ib = [], 0, 0
            for e in cuts:
                ja, jb = ia, ib
                while ja < len(a) and a[ja][2] <= e:
                    ja += 1
                while jb < len(b) and b[jb][2] <= e:
                    jb += 1
                groups.append(",".join(str(t[0]) for t in a[ia:ja]) + "|" + ",".join(str(t[0]) for t in b[ib:jb]))
                ia, ib = ja, jb
        counts.update(linked)
        per.append((doc, len(a), len(b), len(cuts), linked, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most: dict = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return sorted(
        ((d, na, nb, ng, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), h) for d, na, nb, ng, ls, h in per), key=str
    )


def got(frame):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)))
def test_run_skipping_finds_the_common_ends(a, b):
    a, b = sorted(a | {61}), sorted(b | {61})
    inner_a, inner_b = ta.skip_runs(a, b)
    assert [x for k, x in enumerate(a) if k not in set(inner_a)] == sorted(set(a) & set(b))
    assert [x for k, x in enumerate(b) if k not in set(inner_b)] == sorted(set(a) & set(b))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t.'sé€  \0,1▁<>x日", max_size=60))
def test_words_encode_like_whole_texts(text):
    pair = pair_of_tokenizers()
    assert pair.encode_b([text])[0].tolist() == pair.b.encode(text)


def pair_of_tokenizers():
    if "held" not in pair_of_tokenizers.__dict__:
        pair_of_tokenizers.held = ta.Pair(default_tokenizer(), ta.default_pieces())
    return pair_of_tokenizers.held


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 40)), st.sets(st.integers(1, 40)))
def test_links_are_the_overlaps(a, b):
    a, b = np.array(sorted(a | {41})), np.array(sorted(b | {41}))
    last_a, last_b = np.isin(a, b), np.isin(b, a)
    starts_a, starts_b = np.r_[0, a[:-1]], np.r_[0, b[:-1]]
    wanted = {(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]}
    found = list(zip(*(x.tolist() for x in ta.links(a, b, last_a, last_b))))
    assert len(found) == len(wanted) and set(found) == wanted


def test_one_to_one_stretches_are_jumped():
    class Counted(list):
        looks = 0

        def __getitem__(self, k):
            Counted.looks += 1
            return super().__getitem__(k)

    ends = Counted(range(1, 100_001))
    assert ta.skip_runs(ends, list(range(1, 100_001))) == ([], [])
    assert Counted.looks < 100


def test_given_table(spark, folder):
    docs = table(spark, folder, "documents")
    assert got(ta.align_tokenizers(docs, block_bytes=40_000)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, docs, odd_rows):
    rows = [r for r in odd_rows if r[0] != 101] + [(200 + k, t) for k, t in enumerate(ODD)]
    frame = docs(rows)
    result = ta.align_tokenizers(frame)
    assert got(result) == plain(rows)
    assert dict(result.dtypes)["n_a"] == "bigint" and result.columns[-1] == "groups_sha256"


def test_empty_table(spark, docs):
    assert ta.align_tokenizers(docs([(1, "x")]).limit(0)).collect() == []
    assert [tuple(r)[1:] for r in ta.align_tokenizers(docs([(1, None), (2, "")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_tokens_with_their_groups(spark, docs):
    [row] = ta.aligned_tokens(docs([(3, "indubitably aligned tokens")])).collect()
    a, b = plain_tokens("indubitably aligned tokens")
    assert row.ids_a == [t[0] for t in a] and row.ids_b == [t[0] for t in b]
    common = {t[2] for t in a} & {t[2] for t in b}
    assert row.last_a == [t[2] in common for t in a] and row.last_b == [t[2] in common for t in b]
