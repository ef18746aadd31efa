from __future__ import annotations

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from demandspark.llm import lm_score
from demandspark.llm.lm_score import CLASSES, class_of, code_of, count_of, score_documents

SCHEMA = "doc_id long, text string, score string, n_tokens int"


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def held(doc_id):
    return crc32((str(doc_id) if doc_id is not None else "").encode()) % 7 == 2


def base(rows):
    """The contract's base model, token by token."""
    count = Counter(t for d, x in rows if not held(d) for t in tokens(x))
    n, v = sum(count.values()), len(count)
    return {d: (held(d), len(tokens(x)), sum(count[t] > 0 for t in tokens(x)), n,
                sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens(x))) for d, x in rows}


def witten_bell(rows):
    """Interpolated trigram without classes, with dictionaries."""
    count, seen, kinds, grams = Counter(), Counter(), Counter(), Counter()
    for d, x in rows:
        if not held(d):
            count.update(tokens(x))
            for c, b, a in zip(tokens(x), ["<s>"] + tokens(x), ["<s>", "<s>"] + tokens(x)):
                grams.update([(b, c), (a, b, c)])
    for (*context, _), n in grams.items():
        seen[tuple(context)] += n
        kinds[tuple(context)] += 1
    room = sum(count.values()) + len(count) + 1
    out = {}
    for d, x in rows:
        total = 0.0
        for c, b, a in zip(tokens(x), ["<s>"] + tokens(x), ["<s>", "<s>"] + tokens(x)):
            p = (count[c] + 1) / room
            for context in ((b,), (a, b)):
                if seen[context]:
                    p = (grams[(*context, c)] + kinds[context] * p) / (seen[context] + kinds[context])
            total += math.log10(p)
        out[d] = total
    return out


def corpus(n=150, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        at, text = rng.randrange(60), []
        for _ in range(rng.randint(0, 60)):
            at = (at * 7 + rng.choice([1, 1, 1, 2, 5])) % 60
            text.append(words[at].upper() if rng.random() < 0.2 else words[at])
        rows.append((i, " ".join(text) + ("\n" if i % 3 else " x\xa0y")))
    return rows + [(1000, None), (1001, ""), (1002, "never seen before"), (None, "w1 w8"), (1003, "w1 w8 w57 " * 3000)]


def run(spark, rows, **options):
    got = score_documents(spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA), **options).collect()
    assert len(got) == len(rows)
    return {r.doc_id: r for r in got}


def check_base(rows, got):
    for d, (is_held, n, known, total, score) in base(rows).items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (is_held, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9, abs=1e-9)


def test_matches_dictionaries_without_classes(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 0)
    monkeypatch.setattr(lm_score.Totals, "frequent", lambda self, before: np.zeros(len(before), bool))
    rows = corpus()
    got = run(spark, rows, block_chars=2_000, shards=3)
    check_base(rows, got)
    for d, score in witten_bell(rows).items():  # half a step of the quantised values for each token
        assert got[d].score == pytest.approx(score, abs=1.6e-4 * got[d].n_tokens + 1e-3)


def test_blocks_shards_and_asked_pairs_do_not_matter(spark, monkeypatch):
    rows = corpus()
    first = run(spark, rows)
    check_base(rows, first)
    monkeypatch.setattr(lm_score, "ASK_FROM", 2)
    second = run(spark, rows, block_chars=500, shards=7)
    for d in first:
        assert second[d].score == pytest.approx(first[d].score, rel=1e-5, abs=3.2e-4 * first[d].n_tokens)


def test_better_than_base_on_held_out_documents(spark):
    got = [r for r in run(spark, corpus(400)).values() if r.held_out]
    assert sum(r.score for r in got) > 0.8 * sum(r.base_score for r in got)
    assert all(r.score < 0 for r in got)


def test_probabilities_after_a_frequent_word_sum_to_its_classes_share():
    """All words of a class and its unknown, after a frequent word and any word before it."""
    rng = np.random.default_rng(3)
    count = rng.integers(1, 50, 500)
    ids = np.sort(((lm_score.CODES - code_of(count)) << lm_score.ID_BITS) + (rng.integers(0, CLASSES, 500) << lm_score.CLASS_AT) + np.arange(500) + 1)
    seen = count_of(ids)
    totals = lm_score.Totals([[np.array([seen.sum(), 500.0, 900.0]), np.bincount(class_of(ids), seen + 1, CLASSES)]])
    two = ids[rng.choice(500, 120, replace=False)]
    one, mid, n = np.full(120, lm_score.START), ids[rng.choice(4, 120)], rng.integers(1, 4, 120)
    two, mid, n = two[::-1], mid[::-1], n[::-1]  # in no order
    model = lm_score.ShardModel.build(one, mid, two, n, totals)
    seen_before = model.look_up(one, mid, two)
    assert np.allclose(model.learned(), seen_before, atol=1e-9)
    for before in (ids[0], ids[400]):
        logp = model.look_up(np.full(500, lm_score.START), np.full(500, before), ids)
        for c in range(CLASSES):
            own = class_of(ids) == c
            share = totals.class_share(np.array([lm_score.START]), np.array([float(n[np.isin(two, ids[own])].sum())]))[0]
            unknown = 1 / CLASSES / totals.room / totals.mass[c]
            p = (10 ** logp[own]).sum()
            assert p <= share * 1.002 and p == pytest.approx(share, rel=0.004 + unknown)


def test_nothing_to_learn_from_and_no_rows(spark):
    alone = next(i for i in range(100) if held(i))
    r = run(spark, [(alone, "a b")])[alone]
    assert (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0.0) and r.score == pytest.approx(0, abs=1e-3)
    assert score_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_counts_in_ids():
    c = np.array([0, 1, 32_767, 32_768, 10**6, 10**12])
    back = count_of((lm_score.CODES - code_of(c)) << lm_score.ID_BITS)
    assert (back[:4] == c[:4]).all() and np.abs(back / np.maximum(c, 1) - (c > 0)).max() < 0.0005


def test_shards_follow_the_text_and_too_many_bits_raise(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "d" * 90)], "doc_id long, text string")
    few = lm_score._shards(docs, "text")
    monkeypatch.setattr(lm_score, "SHARD_CHARS", 1)
    assert lm_score._shards(docs, "text") == 95 > few
    assert lm_score.packed_bits(1000, 255, 256) == [8, 9]
    with pytest.raises(ValueError, match="use more shards"):
        lm_score.packed_bits(1000, 255, 256, most=26)
