from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from demandspark.llm.queries import REJECTED_WORDS, URL_RULES
from demandspark.llm.url_filter import END, START, MarkovModel, Rule, _grams, _symbols, fit_ratio, judge, seed_labels


def slow_logp(urls, text, order, min_context=2):
    """Witten-Bell with dictionaries, symbol by symbol."""
    count, follow = Counter(), {}
    for u in urls:
        s = bytes([START]) + u + bytes([END])
        for i in range(1, len(s)):
            for k in range(min(order, i) + 1):
                count[s[i - k:i + 1]] += 1
                follow.setdefault(s[i - k:i], Counter())[s[i]] += 1

    def p(ctx, c):
        lower = 1 / 256 if not ctx else p(ctx[1:], c)
        seen = follow.get(ctx)
        if not seen or sum(seen.values()) < min_context:
            return lower
        n, t = sum(seen.values()), len(seen)
        return (seen[c] + t * lower) / (n + t)

    s = bytes([START]) + text + bytes([END])
    return sum(math.log(p(s[max(0, i - order):i], s[i])) for i in range(1, len(s)))


def test_markov_model_matches_dictionaries():
    rng = random.Random(3)
    urls = ["".join(rng.choice("abc/.") for _ in range(rng.randint(0, 12))).encode() for _ in range(60)]
    codes, place, _ = _symbols(urls)
    keys = np.concatenate([_grams(codes, place, m)[1] for m in range(1, 6)])
    model = MarkovModel.fit(*np.unique(keys, return_counts=True), order=4)
    for text in [b"", b"a", b"abcabc", b"zz/abc", "é".encode(), urls[0]]:
        codes, place, _ = _symbols([text])
        assert model.score(codes, place).sum() == pytest.approx(slow_logp(urls, text, 4), rel=1e-9)


def url(rng, bad):
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re"]) for _ in range(3))
    host = f"{rng.choice(['casino', 'free-casino', 'casino-win'])}.example.com" if bad else f"{word()}.example.com"
    return f"https://{rng.choice(['www.', 'm.', ''])}{host}/en/{rng.randint(1, 999)}"


def test_held_out_accuracy(spark):
    rng = random.Random(1)
    rows = [(url(rng, bad), not bad) for bad in (True, False) for _ in range(300)]
    model = fit_ratio(spark.createDataFrame(rows, "url string, accepted boolean"))
    fresh = [(url(rng, bad), bad) for bad in (True, False) for _ in range(300)]
    p = model.probability([u.encode() for u, _ in fresh])
    assert ((p < 0.5) == np.array([b for _, b in fresh])).mean() > 0.98


def test_rules_hosts_and_odd_urls(spark):
    cases = {
        1: ("http://A.B.NET/x", "a.b.net", "/x", "net/", "block"), 2: ("http://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
        3: ("http://xexample.net/en/1", "xexample.net", "/en/1", "net/", "block"), 4: ("h://m.example.com/de/?q", "m.example.com", "/de/", "example.com/de/", "block"),
        5: ("http://a.org/fr/#x", "a.org", "/fr/", "org/fr/", "allow"), 6: ("http://a.org/fr", "a.org", "/fr", None, "allow"),
        7: (None, "", "", None, "allow"), 8: ("net/", "", "", None, "allow"), 9: ("http://a.net?x=/", "a.net", "", None, "allow"),
        10: ("://net/", "net", "/", "net/", "block"), 11: ("", "", "", None, "allow"), 12: ("http://ÄB.net/\n/é", "Äb.net", "/\n/é", "net/", "block"),
        13: ("x" * 100_000 + "://a.net/" + "y" * 100_000, "a.net", "/" + "y" * 100_000, "net/", "block")}
    df = spark.createDataFrame([(k, v[0], "h", "r") for k, v in cases.items()] + [(1, cases[1][0], "h", "r")], "page_id long, url string, host string, rule string")
    got = judge(df, URL_RULES, None).collect()
    assert len(got) == len(cases) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == cases[r.page_id][1:]


def test_model_judges_what_no_rule_fits(spark):
    rng = random.Random(2)
    rows = [(i, url(rng, i % 3 == 0)) for i in range(600)] + [(1000, None), (1001, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.page_id: r for r in judge(pages, [], fit_ratio(seed_labels(pages, REJECTED_WORDS))).collect()}
    assert len(got) == 602 and all(r.rule is None for r in got.values())
    assert sum(got[i].verdict == ("block" if i % 3 == 0 else "allow") for i in range(600)) >= 594


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert fit_ratio(seed_labels(empty, REJECTED_WORDS)) is None
    assert judge(empty, URL_RULES, None).count() == 0
    with pytest.raises(ValueError):
        judge(empty, [Rule(f"{i}/", "block") for i in range(2000)], None)
