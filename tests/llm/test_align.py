"""Alignment of two tokenizers against a plain version with the libraries' own calls."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from parcelflow.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    t, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    t.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    docs = []
    for text in texts:
        a, b = [], []
        if text:
            a = [(i, bytes(letters[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()) for i in sp.encode(text) for p in [sp.id_to_piece(i)]]
            if any(b"".join(x for _, x in side) != b" " + text.encode() for side in (a, b)):
                a, b = [], []
        links, groups, i, j, end_a, end_b, group = [], [], 0, 0, 0, 0, ([], [])
        spans = []
        for side in (a, b):
            at, out = 0, []
            for k, x in side:
                out.append((k, at, at + len(x)))
                at += len(x)
            spans.append(out)
        for k, lo, hi in spans[0]:
            links += [(k, m) for m, lo2, hi2 in spans[1] if lo < hi2 and lo2 < hi]
        ends = sorted({hi for *_, hi in spans[0]} & {hi for *_, hi in spans[1]})
        lo = 0
        for hi in ends:
            groups.append("|".join(",".join(str(k) for k, x, _ in side if lo <= x < hi) for side in spans))
            lo = hi
        docs.append((len(a), len(b), links, groups))
    counts = Counter(x for _, _, links, _ in docs for x in links)
    best = {}
    for (_, m), c in counts.items():
        best[m] = max(best.get(m, 0), c)
    return [(n, m, len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for n, m, x, g in docs]


@pytest.mark.parametrize("head", [400_000, 40, 0])
def test_align(spark, monkeypatch, head):
    monkeypatch.setattr(align, "HEAD", head)
    monkeypatch.setattr(align, "PENDING", 500)
    rng = random.Random(4)
    some = lambda n: " ".join(rng.choice(["alpha", "beta", "the", "Straße", "naïve", "don't", "中文字", "3.14", "😀"]) for _ in range(n))
    texts = [None, "", " ", "  two  blanks ", "x", "<|endoftext|> <s> <0x41> </s>", "tab\tand\nline", "ﬁ ligature", "é é", "a" * 3000, some(3000), "▁ sign", "zero​width   nbsp"]
    texts += [some(rng.randint(1, 30)) for _ in range(40)] + ["the same text again"] * 30
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in align.align(docs, A, B).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    want = plain(texts)
    assert got == dict(enumerate(want)) and sum(w[0] > 0 for w in want) > 60 and want[2:4] != [(0,) * 6 + ("",)] * 3


def test_odd_rows(spark):
    rows = [(1, "some text", 5, "k"), (1, "some text", 6, "k"), (None, "other text", None, None), (1, "third", 1, None), (2, None, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a long, name string")
    got = sorted((r.doc_id or -1, r.n_a, r.count_sum, r.groups_sha256) for r in align.align(docs, A, B).collect())
    assert got == sorted((r[0] or -1, w[0], w[5], w[6]) for r, w in zip(rows, plain([r[1] for r in rows]), strict=True))
    assert align.align(docs.where("false"), A, B).count() == 0
