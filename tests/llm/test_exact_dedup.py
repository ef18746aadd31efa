from __future__ import annotations

import hashlib
import random
import re

from demandspark.llm import exact_dedup
from demandspark.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

SCHEMA = "doc_id long, text string, row string, run int"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check(spark, rows):
    got = exact_duplicates(spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)).collect()
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): (k, v) for k, v in groups.items()}
    for r in got:
        _, ids = by_sha[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (min(known, default=None), len(ids))
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)


def test_matches_dictionary(spark):
    rng = random.Random(1)
    texts = ["a b", "a  b", "a\tb", " a b", "a b ", "", None, " ", "\xa0", "A b", "é", "x" * 200_000, "x" * 200_001]
    check(spark, [(rng.randrange(10**6), rng.choice(texts)) for _ in range(500)])


def test_many_runs_and_one_large_group(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "ROWS_PER_RUN", 8)
    check(spark, [(i, "same text" if i % 3 else f"own {i}") for i in range(700, 0, -1)])


def test_repeated_rows_null_ids_and_no_rows(spark):
    check(spark, [(3, "a"), (3, "a"), (None, "a"), (None, "b"), (None, "b")])
    check(spark, [])
    df = spark.createDataFrame([(3, "a", "r", 1), (3, "a", "r", 1), (4, " a", "r", 1), (5, "a", "r", 1), (None, "z", "r", 1)], SCHEMA)
    assert sorted((r.doc_id or -1, r.text) for r in drop_exact_duplicates(df).collect()) == [(-1, "z"), (3, "a"), (4, " a")]
    assert drop_exact_duplicates(df).columns == df.columns
