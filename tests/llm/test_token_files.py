from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from demandspark.llm.queries import END_ID
from demandspark.llm.token_files import SequenceReader, open_folder, read_documents, word_encoder, write_tokens

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

with open(public.path("word_bpe_49k.json"), encoding="utf-8") as f:
    JSON = f.read()
LIBRARY = tokenizers.Tokenizer.from_str(JSON)
BITS = ["the", "The", "ΑΣ", "ς", "İ", "é", "é", "́", " ", "  ", "\n", "\t", "\r", "\xa0", " ", "\x1c", "'s", "'", "12", "-", "<|endoftext|>",
        "日本", "😀", "ﬁ", "!", "İI", "\x00", "x̸", ".", ",", "Éa", "ß", "_", "|", "&&&", "WORD!!"]


def whole(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_the_library_ids():
    rng = random.Random(4)
    texts = ["", " ", "\n \n"] + ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    encoder = word_encoder(JSON)
    assert [x.tolist() for x in encoder.encode(texts)] == [whole(t) for t in texts]


def test_files_read_back(spark, tmp_path):
    rng = random.Random(5)
    words = ["alpha", "beta", "Gamma,", "x1", "don't", "—"]
    rows = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), 1) for i in range(200)]
    rows += [(9_999, None, 1), (10_000, "", 1), (10_001, "long text " * 30_000, 1), (9, "again", 1), (9, "again", 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    folder, manifest = write_tokens(df, JSON, END_ID, str(tmp_path / "t"), sequence=16, batch=4, block_chars=500)
    got = sorted(read_documents(folder, manifest).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    start, expected = 0, {}
    for i, t, _ in rows:
        ids = np.array(whole(t) + [END_ID], "<u4")
        expected.setdefault(i, []).append((len(ids), zlib.crc32(ids)))
    for r in got:
        assert r.start == start
        start += r.n_tokens
        expected[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    files, root = open_folder(folder)
    for m in manifest.collect():
        reader = SequenceReader(files, f"{root}/{m.file}")
        n = -(-m.n_ids // 16)
        both = [reader.sequence_at(i) for i in range(n)]
        assert all(len(ids) == len(mask) == 16 for ids, mask in both)
        assert sum(int(mask.sum()) for _, mask in both) == m.n_ids
        ids = np.concatenate([i for i, _ in both])[:m.n_ids]
        assert (ids == np.concatenate(list(reader.stretch(0, m.n_ids)))).all()
        assert reader.file.get_batch(0).column(0).flatten().to_numpy(zero_copy_only=True) is not None


def test_no_rows_and_null_ids(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert read_documents(*write_tokens(empty, JSON, END_ID, str(tmp_path / "e"))).count() == 0
    one = spark.createDataFrame([(None, "a"), (1, "b")], "doc_id long, text string")
    assert [(r.doc_id, r.start) for r in read_documents(*write_tokens(one, JSON, END_ID, str(tmp_path / "n"))).orderBy("start").collect()] == [(None, 0), (1, 2)]
