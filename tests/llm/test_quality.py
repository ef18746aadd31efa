from __future__ import annotations

import itertools
import random

import numpy as np

import pytest

from demandspark.llm.quality import BUCKETS, LABELLERS, Features, LabelModel, QualityModel, fit, fit_label_model, keep_good, score, votes, _shape

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, quality string"


def clean(rng, n):
    return ". ".join(" ".join("".join(rng.choice(["an", "the", "ion", "or", "st", "wa"]) for _ in range(rng.randint(1, 4)))
                              for _ in range(9)).capitalize() for _ in range(n)) + "."


def junk(rng, kind):
    text = clean(rng, 8)
    return {"shout": text.upper().replace(" ", "!! "), "marks": text.replace(" ", "*** "), "cells": text.replace(" ", " | "),
            "loop": " ".join([text.split()[0]] * 60), "lines": "\n".join([clean(rng, 1)] * 30)}[kind]


def corpus(seed=0, n=240):
    rng = random.Random(seed)
    kinds = ["shout", "marks", "cells", "loop", "lines"]
    return [(i, junk(rng, kinds[i % 5]) if i % 4 == 0 else clean(rng, rng.randint(1, 30)), "en", "s", 1, "extra") for i in range(n)]


def test_em_finds_accuracies_of_drawn_votes():
    rng = np.random.default_rng(2)
    right, seen = np.array([0.95, 0.9, 0.8, 0.7, 0.85]), np.array([1.0, 0.9, 0.8, 0.9, 0.7])
    good = rng.random(20_000) < 0.75
    rows = []
    for g in good:
        correct = rng.random(5) < right
        rows.append("".join("-" if u > s else "gb"[int(g != c)] for c, u, s in zip(correct, rng.random(5), seen)))
    patterns, counts = np.unique(rows, return_counts=True)
    model = fit_label_model(patterns.tolist(), counts)
    assert abs(model.prior - 0.75) < 0.03
    assert np.abs(model.given_good[:, 0] - right).max() < 0.05
    assert ((model.posterior(rows) > 0.5) == good).mean() > 0.93


def test_scorer_generalises_to_fresh_documents(spark):
    model = fit(spark.createDataFrame(corpus(), COLUMNS))
    fresh = corpus(seed=9)
    got = {r.doc_id: r for r in score(spark.createDataFrame(fresh, COLUMNS), model).collect()}
    assert len(got) == len(fresh)
    assert np.mean([got[i].kept == (i % 4 != 0) for i in got]) > 0.97
    kept = keep_good(spark.createDataFrame(fresh, COLUMNS), model)
    assert kept.columns == COLUMNS.replace(" long", "").replace(" string", "").split(", ")
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}


def test_odd_texts(spark):
    model = fit(spark.createDataFrame(corpus(), COLUMNS))
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One."), (5, clean(rng, 20_000)), (5, clean(rng, 3)), (None, clean(rng, 3)), (7, "\x00é日本")]
    df = spark.createDataFrame([(i, t, None, None, None, None) for i, t in rows], COLUMNS)
    got = score(df, model).collect()
    assert len(got) == len(rows)
    assert all(r.quality == 0 and not r.kept and r.votes == "-" * len(LABELLERS) for r in got if r.doc_id in (1, 2, 3))
    assert all(r.kept for r in got if r.doc_id in (5, None))
    assert keep_good(df, model).count() == sum(r.kept for r in got)


@pytest.mark.parametrize("bias, stays", [(-0.2, False), (0.0, True), (0.2, True)])  # probabilities of 0.45, 0.5 and 0.55
def test_what_is_rather_junk_than_good_goes(spark, bias, stays):
    weights = np.zeros(BUCKETS)
    weights[Features().whole[-1]] = bias
    even = np.full((len(LABELLERS), 3), 0.5)
    docs = spark.createDataFrame([(1, "Some words.", None, None, None, None)], COLUMNS)
    model = QualityModel(LabelModel(0.5, even, even), weights)
    assert [r.kept for r in score(docs, model).collect()] == [stays] and keep_good(docs, model).count() == stays


def test_no_rows_and_no_words(spark):
    for rows in ([], [(1, "", None, None, None, None)]):
        df = spark.createDataFrame(rows, COLUMNS)
        assert fit(df) is None
        assert score(df, None).count() == len(rows) and keep_good(df, None).count() == 0


def test_votes_and_features():
    assert votes(b"") == "-" * len(LABELLERS)
    assert "b" in votes(b"SHOUT LOUD " * 10) and "b" not in votes(b"Short text.")
    features = Features(kept=1)
    one, two = (list(features.of([b"Ab ab c"])) for _ in range(2))
    assert (one[0][0] == two[0][0]).all() and one[0][1][-1] == 1.0


def long_passage(rng):
    """One line of a passage of 250 different words, again and again."""
    return " ".join([" ".join(rng.sample(WORDS, 250))] * 100)


WORDS = ["".join(p) + q for p in itertools.product(["an", "the", "ion", "or", "st", "wa"], repeat=3) for q in ("", "s", "ly", "er")]


def test_repetition_of_long_passages_is_seen_whatever_their_length(spark):
    rng = random.Random(6)
    column = [name for name, _, _ in LABELLERS].index("seen_runs")
    for times, vote in ((1, "g"), (2, "b"), (100, "b")):
        assert votes(" ".join([" ".join(rng.sample(WORDS, 250))] * times).encode())[column] == vote
    assert [votes(" ".join(rng.choices(WORDS, k=n)).encode())[column] for n in (100, 50_000)] == ["g", "g"]
    model = fit(spark.createDataFrame(corpus(), COLUMNS))
    fresh = [(i, long_passage(rng) if i else " ".join(rng.choices(WORDS, k=25_000)), "en", "s", 1, "extra") for i in range(4)]
    got = {r.doc_id: r.quality for r in score(spark.createDataFrame(fresh, COLUMNS), model).collect()}
    assert max(got[i] for i in (1, 2, 3)) < got[0] - 0.02


def test_shapes_of_whole_words():
    assert [_shape(w) for w in (b"Ab12x.", b"AAAAA--", "été".encode(), b"(\n")] == [b"Aa00a.", b"AA--", b"aa", b"(\n"]
    assert _shape(b"a1" * 40 + b"#") != _shape(b"a1" * 40)
