from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from demandspark.llm import quality
from demandspark.llm.mixing import balance, mix

from test_jaccard_join import brute as near_brute

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return ". ".join(" ".join("".join(rng.choice(["an", "the", "ion", "or", "st", "wa", "be", "li"]) for _ in range(rng.randint(1, 4)))
                              for _ in range(9)).capitalize() for _ in range(n)) + "."


def documents(seed=3):
    rng = random.Random(seed)
    texts = []
    for _ in range(120):
        text = prose(rng, rng.randint(3, 25))
        texts.append(text)
        if rng.random() < 0.2:
            texts.append(text.replace(" ", "\n ", 3))
        if rng.random() < 0.2:
            words = text.split(" ")
            words[rng.randrange(len(words))] = "edit"
            texts.append(" ".join(words))
        if rng.random() < 0.2:
            texts.append(text.upper().replace(" ", "!! "))
    texts += [None, "", "short one."]
    sources = ["a", "b", "b", "b", "c", None]
    return [(i * 5, t, "en", rng.choice(sources), len(t or "")) for i, t in enumerate(texts)]


def test_stages_against_brute_force(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judge = quality.Judge(quality.fit(docs))
    kept = [r for r, q in zip(rows, judge([r[1] or "" for r in rows])[2]) if q >= quality.KEEP_FROM]
    assert sum(r[1] is not None and "!!" in r[1] for r in kept) == 0 and len(kept) >= 120
    first = {}
    for r in kept:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
        first[key] = min(first.get(key, r), r, key=lambda x: x[0])
    unique = list(first.values())
    stays = {d for d, _, c in near_brute([(r[0], r[1]) for r in unique]) if d == c}
    unique = [r for r in unique if r[0] in stays]
    got = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        path = f"{tmp_path}/{name.replace(' ', '_')}"
        stage(spark, got, str(tmp_path)).write.parquet(path)
        got = spark.read.parquet(path)
        assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(unique)
    copies = {r.doc_id: r.copies for r in balance(got).collect()}
    mixed = mix(got)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in copies.items() if n})
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in result) == Counter({d: n for d, n in copies.items() if n})
    texts = {r[0]: r[1] for r in rows}
    assert all(r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() for r in result)


@pytest.mark.parametrize("weights, most", [((5.0, 2.0, 1.0), 3), ((1.0,), 2)])
def test_mixture(spark, weights, most):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["a", "a", "b", "c", "d", "é", None]), 1) for i in range(900)]
    rows += [(5, None, "a", 1), (5, "x y", "z", 1), (5, "x y", "z", 1), (None, "q", None, 1), (7, "w " * 5000, "b", 1)]
    got = balance(spark.createDataFrame(rows, "doc_id long, text string, source string, block int"), weights, most).collect()
    assert len(got) == len(rows)
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        assert r.taken <= most * r.size and r.taken == r.copies * r.size
    names = sorted((s for s in sizes if s is not None)) + [None]
    share = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, stopped, total = {}, set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        target = {s: most * sizes[s] if s in stopped else share[s] * left / sum(w for x, w in share.items() if x not in stopped) for s in names}
        over = {s for s in names if s not in stopped and target[s] > most * sizes[s]}
        if not over:
            break
        stopped |= over
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for s in names:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6
    again = balance(spark.createDataFrame(rows[::-1], "doc_id long, text string, source string, block int"), weights, most).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mixture_without_words(spark):
    for rows in ([], [(1, None, "a"), (2, "", None)]):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        assert [(r.size, r.taken) for r in balance(df).collect()] == [(0, 0)] * len(rows)
        assert mix(df).count() == 0


def test_mixture_of_alike_rows(spark):
    """Rows with one id, with null ids and with one text are decided each, and copied with their own columns."""
    rows = [(7, "w " * 10, "a", i) for i in range(100)] + [(None, "w " * 10, "b", i) for i in range(100)]
    rows += [(i, "v " * (i % 20), "c", i) for i in range(100)] + [(8, "u " * (i % 9), None, i) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(5)
    got = balance(df).collect()
    taken, target = Counter(), {r.source: r.target for r in got}
    for r in got:
        taken[r.source] += r.taken
    assert len(got) == 400 and all(abs(taken[s] - target[s]) <= 10 for s in target)
    mixed = Counter((r.source, r.n) for r in mix(df).collect())
    words = Counter()
    for (source, n), times in mixed.items():
        words[source] += times * next(len(t.split()) for _, t, s, m in rows if (s, m) == (source, n))
        assert times <= 3
    assert words == taken and sum(s == "a" for s, _ in mixed) > 40
