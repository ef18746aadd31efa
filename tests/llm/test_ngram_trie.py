from __future__ import annotations

import tempfile

import numpy as np
import pytest

from demandspark.llm.ngram_trie import EliasFano, Trie, quantise, restore


@pytest.mark.parametrize("n, top", [(0, 1), (1, 0), (1, 10**12), (5, 3), (200, 150), (3000, 10**6), (700, 2**50), (64, 64), (1000, 1)])
def test_elias_fano_matches_sorted_array(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top + 1, n))
    ef = EliasFano.build(values)
    assert (ef.access(np.arange(n)).astype(np.int64) == values).all()
    asked = np.concatenate([values, values + 1, rng.integers(0, top + 2, 50), [0, top + 5]])
    place, found = ef.successor(asked)
    assert (place == np.searchsorted(values, asked)).all()
    assert (found == np.isin(asked, values)).all()


def test_compact():
    values = np.sort(np.random.default_rng(1).integers(0, 10**9, 100_000))
    ef = EliasFano.build(values)
    assert (ef.low.nbytes + ef.high.nbytes) * 8 / len(values) < np.log2(10**9 / 100_000) + 2.5


def test_trie_of_three_levels_in_a_file():
    rng = np.random.default_rng(4)
    three = np.unique(rng.integers(0, 12, (400, 3)), axis=0)
    grams = [np.unique(three[:, :k], axis=0) for k in (1, 2, 3)]
    values = [-rng.random(len(g)) * 5 for g in grams]
    with tempfile.TemporaryFile() as file:
        Trie.build(grams, values, values).write(file)
        trie = Trie.open(file)
        assert isinstance(trie.levels[0].logp, np.memmap)
        asked = np.concatenate([three, rng.integers(0, 14, (500, 3))])
        found = trie.find(asked)
        for row, at in zip(asked, found):
            for k in range(3):
                hit = np.flatnonzero((grams[k] == row[:k + 1]).all(1))
                assert at[k] == (hit[0] if len(hit) else -1)
                if len(hit):
                    assert restore(trie.levels[k].logp[at[k]:at[k] + 1])[0] == pytest.approx(values[k][hit[0]], abs=3e-4)
        begin, end = trie.children(0, np.arange(len(grams[0])))
        assert (end - begin == [(grams[1][:, 0] == g).sum() for g in grams[0][:, 0]]).all()


def test_quantised_values():
    x = -np.linspace(0, 19.9, 1000)
    assert np.abs(restore(quantise(x)) - x).max() < 3e-4
