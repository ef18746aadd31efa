from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from demandspark.llm.jaccard_join import Shingler, _from_planes, _planes, drop_near_duplicates, jaccard_components, one_of_each_group, shared_counts

SCHEMA = "doc_id long, text string, n int, digest string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows, percent=80):
    """Set sizes and components by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                label[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


def check(spark, rows, percent=80, **options):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, percent, **options).collect())
    assert got == brute(rows, percent)


def copies(seed, n_groups=14, per=9, passage=True):
    """Groups of copies with few to many edits, chains of edits, and a passage that many documents share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4)))
    shared, rows = " ".join(word() for _ in range(40)), []
    for _ in range(n_groups):
        base = [word() for _ in range(rng.randint(3, 90))]
        last = base
        for _ in range(rng.randint(1, per)):
            text = list(rng.choice([base, last]))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = word()
            last = text
            extra = shared if passage and rng.random() < 0.3 else ""
            rows.append(" ".join(text) + " " + extra)
    rng.shuffle(rows)
    return [(i * 7 % 1009, t.upper() if rng.random() < 0.2 else t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    check(spark, copies(seed))


def test_small_blocks_and_other_thresholds(spark):
    check(spark, copies(3, n_groups=10), percent=70, block_chars=400)


def test_dense_group_and_exact_border(spark):
    """A middle whose copies link to it but seldom to each other, and pairs exactly at and below the border."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(64)]
    rows = []
    for i in range(60):
        text = list(base)
        text[rng.randrange(60)] = f"x{i}"
        rows.append((1000 + i, " ".join(text)))
    rows.append((5000, " ".join(base)))
    a = [f"q{i}" for i in range(49)]  # 45 shingles; cut off 9 of them: 36 / 45 is exactly the border
    rows += [(1, " ".join(a)), (2, " ".join(a[:40])), (3, " ".join(a[:39]) + " z")]
    check(spark, rows)


def test_odd_texts(spark):
    rows = [(9, None), (8, ""), (7, " \n"), (6, "one"), (5, "ONE"), (4, "one two"), (3, "one two three four five"), (2, "a " * 500),
            (1, "a a a a a"), (20, "\xa0"), (21, "\xa0"), (30, "long text here now again " * 20_000), (31, "long text here now again " * 20_001)]
    check(spark, rows)


def test_repeated_rows_null_ids_and_none(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text, 1, "x"), (3, text, 1, "x"), (None, text, 1, "x"), (None, "alone here", 1, "x"), (5, text + " more", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id or -1, r.component_id or -1) for r in jaccard_components(df).collect()))
    assert got == [(-1, -1), (-1, 3), (3, 3), (3, 3), (5, 3)]
    assert sorted(r.doc_id or -1 for r in drop_near_duplicates(df).collect()) == [-1, -1, 3, 3]
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_row_of_each_group_stays_whatever_its_ids(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "wv")
    rows = [(3, text, 1, "x"), (3, text, 2, "x"), (3, text + " edit", 1, "x"), (None, text, 1, "x"), (None, "alone here", 1, "x"),
            (5, text + " more", 1, "x"), (3, "far from all", 1, "x"), (None, other, 1, "x"), (None, other + " more", 1, "x"), (9, None, 1, "x")]
    stays = [(-1, "alone here"), (-1, min(other, other + " more", key=lambda t: hashlib.md5(t.encode()).hexdigest())), (3, "far from all"),
             (3, min(text, text + " edit", key=lambda t: hashlib.md5(t.encode()).hexdigest())), (9, "")]
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, SCHEMA)
        got = one_of_each_group(df)
        assert got.columns == df.columns
        assert sorted((-1 if r[0] is None else r[0], r[1] or "") for r in got.collect()) == sorted(stays)
    assert one_of_each_group(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shared_counts_are_never_too_low(spark):
    rows = copies(8)
    df = spark.createDataFrame([(d, t) for d, t in rows], "doc_id long, text string")
    sets = {d: shingles(t) for d, t in rows}
    for bits, chars in ((64, 10**6), (64, 300), (8, 300)):
        for r in shared_counts(df, bits, 3, chars).collect():
            others = frozenset().union(*(s for d, s in sets.items() if d != r.doc_id))
            exact = len(sets[r.doc_id] & others)
            assert r.n_shingles == len(sets[r.doc_id]) and (r.shared == exact if bits == 64 else r.shared >= exact)


def test_planes_and_sets():
    x = np.sort(np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64))
    assert (_from_planes(_planes(x)) == x).all()
    texts = ["A b c d e f", "a  B\nc d\te f", "a b", "b a", "ab"]
    sets = Shingler().sets(texts)
    assert (sets[0] == sets[1]).all() and len({s.tobytes() for s in sets}) == 4
