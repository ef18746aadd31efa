from __future__ import annotations

import random

import pyarrow as pa
from hypothesis import given, settings, strategies as st

from demandspark.llm.blocks import blocks, map_blocks, pack, unpack
from demandspark.llm.common import components

import numpy as np


def brute(pairs):
    label = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_components_of_chains_hubs_and_random_links(spark):
    rng = random.Random(2)
    ids = rng.sample(range(10_000), 400)
    pairs = list(zip(ids[:120], ids[1:121]))  # a chain in no order
    pairs += [(ids[150], x) for x in ids[151:260]]  # a hub
    pairs += [(rng.choice(ids[300:]), rng.choice(ids[300:])) for _ in range(60)] + [(5, 5)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == brute(pairs)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), max_size=40), st.lists(st.integers(0, 255), max_size=9))
def test_packed_arrays_come_back(longs, small):
    a, b, c = np.array(longs, np.int64), np.array(small, np.uint8), np.array(longs, float)
    assert all(x.dtype == y.dtype and (x == y).all() for x, y in zip((a, b, c), unpack(pack(a, b, c))))


def test_blocks_keep_all_rows_in_order():
    texts = ["é" * n for n in (0, 3, 500, 1, 0, 40, 7)]
    batch = pa.record_batch([pa.array([1, None, 2**60 + 1, 4, 5, 6, 7]), pa.array(texts)], names=["id", "text"])
    frames = list(blocks(iter([batch, batch.slice(0, 0)]), chars=50))
    assert [t for f in frames for t in f["text"]] == texts and len(frames) > 2
    assert [i for f in frames for i in f["id"]][1:3] == [None, 2**60 + 1]


def test_map_blocks(spark):
    df = spark.createDataFrame([(i, "word " * i) for i in range(20)], "id long, text string")
    sizes = map_blocks(df, lambda frames: (f.assign(n=f["text"].str.len())[["id", "n"]] for f in frames), "id long, n int", 30)
    assert {r.id: r.n for r in sizes.collect()} == {i: 5 * i for i in range(20)}
