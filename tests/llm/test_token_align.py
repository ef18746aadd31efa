from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from demandspark.llm.queries import two_tokenizers
from demandspark.llm.token_align import ChunkEncoder, TokenizerPair, lockstep, split_chunks

public = pytest.importorskip("public_tokenizers")

with open(public.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(public.path("piece_bpe_32k.model"), "rb") as g:
    PAIR = TokenizerPair(f.read(), g.read())

ODD = ["", " ", "   ", "a", " a", "a  b ", "\n", "a\n b", "a \n b", "a  b", "​ x​ y!​ z", "!​", "<|endoftext|> x</s><0x0A>", "日本語 テキスト",
       "😀 é é", "it's we'll", "\x00 \x1f\x85 x", "x▁y", "▁", "-" * 500, "  \t\t  tab", "᠎ ﻿ z", "a" * 5000, "　 w"]


def whole(text):
    """Both tokenizers on the whole text."""
    if not text:
        return [], []
    a = PAIR.a.encode(" " + text, add_special_tokens=False).ids
    b = PAIR.b.encode(text)
    spelled = (" " + text).encode()
    same = b"".join(PAIR.bytes_a[i] for i in a) == spelled == b"".join(PAIR.bytes_b[i] for i in b)
    return (a, b) if same else ([], [])


def brute_links(a, b):
    """Overlapping pairs of token positions by comparing all ranges, and the cuts."""
    def ranges(ids, spelled):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(spelled[i])))
            at = out[-1][1]
        return out
    ra, rb = ranges(a, PAIR.bytes_a), ranges(b, PAIR.bytes_b)
    links = [(i, j) for i, (p, q) in enumerate(ra) for j, (r, s) in enumerate(rb) if max(p, r) < min(q, s)]
    return links, sorted({q for _, q in ra} & {s for _, s in rb}), ra, rb


def brute(docs):
    rows, counts = [], Counter()
    for doc, text in docs:
        a, b = whole(text)
        links, cuts, ra, rb = brute_links(a, b)
        counts.update((a[i], b[j]) for i, j in links)
        groups, low = [], 0
        for cut in cuts:
            groups.append(",".join(str(x) for x, (p, _) in zip(a, ra) if low <= p < cut) + "|" + ",".join(str(x) for x, (p, _) in zip(b, rb) if low <= p < cut))
            low = cut
        rows.append((doc, a, b, links, ";".join(groups), len(cuts)))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc, a, b, links, text, n in rows:
        times = [counts[a[i], b[j]] for i, j in links]
        best = sum(t == most[b[j]] for t, (_, j) in zip(times, links))
        out.append((doc, len(a), len(b), n, len(links), best, sum(times), hashlib.sha256(text.encode()).hexdigest() if text else "", text))
    return sorted(out, key=str)


def random_texts(n, seed):
    rng = random.Random(seed)
    bits = ["a", "the", "ing", "tion", " ", "  ", "\n", "é", "日本", "😀", "'s", "-", "1", "22", "\t", " ", "​", ".", " of", "▁", "ñ", "heron"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_chunks_are_encoded_as_whole_texts():
    texts = ODD + random_texts(2000, 1)
    for kept in (5, 10_000):
        encoder = ChunkEncoder(PAIR, kept)
        for at in range(0, len(texts), 50):
            for text, (a, b) in zip(texts[at:at + 50], encoder.encode(texts[at:at + 50])):
                assert (a.tolist(), b.tolist()) == tuple(map(list, whole(text)))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    (a, b), = ChunkEncoder(PAIR).encode([text])
    assert (a.tolist(), b.tolist()) == tuple(map(list, whole(text)))
    assert not text or " ".join(["", *split_chunks(text)]) == " " + text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), min_size=1, max_size=12), max_size=5), st.randoms(), st.integers(1, 12))
def test_lockstep_finds_all_overlaps(docs, rng, lane):
    ends_a, ends_b, starts, base = [], [], [], 0
    for doc in docs:
        size = sum(doc)
        starts.append(base)
        ends_a += (base + np.cumsum(doc)).tolist()
        ends_b += sorted({base + size} | {base + rng.randint(1, size) for _ in range(len(doc))})
        base += size
    a, b, cut = lockstep(np.array(ends_a, int), np.array(ends_b, int), np.array(starts, int), base, lane)
    ranges = [list(zip([0] + e[:-1], e)) for e in (ends_a, ends_b)]
    want = [(i, j) for i, (p, q) in enumerate(ranges[0]) for j, (r, s) in enumerate(ranges[1]) if max(p, r) < min(q, s)]
    assert list(zip(a.tolist(), b.tolist())) == want
    assert cut.tolist() == [ends_a[i] == ends_b[j] for i, j in want]


def test_documents(spark):
    docs = list(enumerate(ODD + random_texts(60, 2))) + [(None, None), (5, ""), (7, "heron of the tion"), (7, "heron of the tion"), (None, "the heron")]
    rows = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, pairs string, block int").repartition(3)
    got = two_tokenizers(rows, with_groups=True, block_chars=300, lane_bytes=16).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs)
    plain = two_tokenizers(rows).collect()
    assert sorted(map(tuple, plain), key=str) == [r[:-1] for r in brute(docs)]
    assert two_tokenizers(rows.limit(0)).count() == 0
    assert two_tokenizers(rows.filter("text IS NULL")).first().asDict() == dict(
        doc_id=None, n_a=0, n_b=0, n_groups=0, n_links=0, n_best=0, count_sum=0, groups_sha256="")


def test_long_text(spark):
    text = "thereinhe ofandtion  " * 20_000 + "x" * 10_000
    rows = spark.createDataFrame([(1, text), (2, "of")], "doc_id long, text string")
    a, b = whole(text)
    got = {r.doc_id: r for r in two_tokenizers(rows).collect()}
    assert (got[1].n_a, got[1].n_b) == (len(a), len(b)) and got[1].n_links >= max(len(a), len(b))
