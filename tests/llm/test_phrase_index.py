from __future__ import annotations

import hashlib
import random
import re

import pytest

from demandspark.llm import phrase_index as pi

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UP))


def brute(docs, items, window=10):
    cut = []
    for item, text in items:
        w = words(text)
        cut += [(item, w[i:i + window]) for i in range(max(len(w) - window, 0) + 1) if w]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, g in cut:
            for i in range(len(w) - len(g) + 1):
                if w[i:i + len(g)] == g:
                    hit |= set(range(i, i + len(g)))
                    found |= {str(item)} - {"None"}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


def made(seed, n_docs=60, vocab="a b c dd É 日本 7".split()):
    rng = random.Random(seed)
    draw = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    items = [(i, draw(rng.choice([1, 3, 4, 10, 11, 14]))) for i in range(12)]
    items += [(2, draw(12)), (None, draw(12)), (90, None), (91, ""), (92, "--- !"), (10**12, draw(10)), (7, items[7][1])]
    docs = [(i, draw(rng.randint(0, 40)) + ", " + (rng.choice(items)[1] or "").upper() + "\n" if rng.random() < .5 else draw(rng.randint(0, 30)))
            for i in range(n_docs)]
    return docs + [(None, None), (5, ""), (5, docs[5][1]), (5, docs[5][1]), (77, "the " * 3000 + draw(3000))], items


def frame(spark, docs, items):
    return (spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, row int, term string"),
            spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, window int"))


@pytest.mark.parametrize("sent", [True, False])
def test_matches_brute_force(spark, monkeypatch, sent):
    if not sent:  # the salted joins
        monkeypatch.setattr(pi, "SENT_ROWS", -1)
        monkeypatch.setattr(pi, "SENT_BYTES", -1)
        monkeypatch.setattr(pi, "SALTS", 3)
    docs, items = made(3)
    got = pi.contamination(*frame(spark, docs, items)).collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    assert any(r.n_items > 1 for r in got) and any(not r.contaminated for r in got)


def test_empty_tables(spark):
    docs, items = [(1, "a b c"), (None, None)], [(1, "a b")]
    none = hashlib.sha256(b"").hexdigest()
    got = pi.contamination(*frame(spark, docs, [])).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 3, 0, 0, none, False), (None, 0, 0, 0, none, False)], key=str)
    assert pi.contamination(*frame(spark, [], items)).count() == 0
    assert pi.contamination(*frame(spark, [], [])).count() == 0


def test_words_are_ascii_lowered_and_others_kept(spark):
    text = "It's A-b ÀÉ 日本語、x\x00y\x7f9_z"
    got = spark.createDataFrame([(text,)], "text string").select(pi.words().alias("w")).first().w
    assert got == words(text) == ["it", "s", "a", "b", "ÀÉ", "日本語、x", "y", "9", "z"]


def test_overlapping_occurrences_count_each_word_once(spark):
    docs, items = [(1, "x " * 25 + "y")], [(1, "x " * 10), (2, "x " * 3 + "y")]
    assert pi.contamination(*frame(spark, docs, items)).first().n_hit == 26


def test_proximity(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 40)))) for i in range(30)]
    items = [(1, "a b c"), (2, "a a g"), (3, "d"), (4, "a zz"), (5, "e f e f")]
    d, t = frame(spark, docs, items)
    vocab = pi.vocabulary(t)
    index = pi.build_index(d, vocab)
    windows, owners = pi.item_windows(t)
    ranked = pi.rarest_first(windows, vocab, index)
    anchors = {r.window: (r.w, r.a) for r in ranked.join(windows, "window").selectExpr("window", "words w", "words[terms[0].offset] a").collect()}
    ids = {r.row: r.doc_id for r in index.filter("term = -1").collect()}
    within = 3
    got = {(ids[r.row], r.window, r.anchor) for r in pi.proximity_matches(index, ranked, within).collect()}
    want = set()
    for window, (w, a) in anchors.items():
        for i, text in docs:
            tokens = words(text)
            for at, token in enumerate(tokens):
                near = tokens[max(0, at - within):at + within + 1]
                if token == a and all(near.count(x) >= w.count(x) for x in w):
                    want.add((i, window, at))
    assert got == want and len(want) > 20
