from __future__ import annotations

import base64
import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

from demandspark.llm.bpe import Decoder, MergeTable, encode_piece, piece_encoder, read_ranks, replay
from demandspark.llm.queries import byte_bpe

public = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
    RANKS = read_ranks(f)
TABLE = MergeTable(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", "a", "a" * 5000, "-" * 3000, " " * 99, "́" * 9, "日本語テキスト" * 20, "<|endoftext|> x", "it's we'll\n\n\t  x", "😀" * 40, "\x00\x1f"]


def test_matches_library_on_odd_and_random_texts():
    rng = random.Random(1)
    bits = ["a", "b", "aa", "the", "in", "ing", "er", " ", "  ", "\n", "1", "22", "é", "日本", "😀", "'s", "-", "=", "ll", "ou", "re", "tion", "on", "h"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    assert [x.tolist() for x in piece_encoder(TABLE, public.PATTERN).encode(texts)] == LIBRARY.encode_ordinary_batch(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_matches_library_and_round_trips(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids = list(piece_encoder(TABLE, public.PATTERN, kept=3).encode(texts))
    assert [x.tolist() for x in ids] == LIBRARY.encode_ordinary_batch(texts)
    assert [Decoder(TABLE.token).decode(x).decode() for x in ids] == texts


def test_merges_out_of_training_order():
    """Vocabularies whose ranks do not follow their parts: a merge may open an earlier one."""
    rng = random.Random(7)
    for _ in range(300):
        made = {bytes([b]) for b in range(256)}
        while len(made) < 256 + 14:
            made.add(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))))
        longer = [t for t in made if len(t) > 1]
        rng.shuffle(longer)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + i for i, t in enumerate(longer)}
        pieces = list({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 9))) for _ in range(30)})
        ids, sizes = replay(pieces, MergeTable(ranks))
        library = tiktoken.Encoding("r", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        at = 0
        for piece, n in zip(pieces, sizes.tolist()):
            assert ids[at:at + n].tolist() == library.encode_ordinary(piece.decode()) == encode_piece(piece, MergeTable(ranks))
            at += n


def test_documents(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(50, None, "x"), (0, "", "x"), (51, "long word " * 40_000, None)]
    got = byte_bpe(spark.createDataFrame(rows, "doc_id long, text string, ids string"), with_ids=True, block_chars=1000).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t, _ in rows}
    for r in got:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert byte_bpe(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rank_lines():
    assert read_ranks([base64.b64encode(b"ab") + b" 7", b""]) == {b"ab": 7}


def test_large_ids_beside_null(spark):
    rows = [(2**53 + 1, "a"), (None, "b"), (2**62 + 3, None)]
    got = byte_bpe(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 2**53 + 1, 2**62 + 3]
