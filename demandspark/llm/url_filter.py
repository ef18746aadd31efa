"""URL verdicts: rules first, then the likelihood ratio of two character models."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import sent

#: Longest context in bytes, contexts seen less often than MIN_CONTEXT are cut, URLs per class in the fit.
ORDER = 5
MIN_CONTEXT = 2
FIT_URLS = 5_000
#: Longer URLs are scored but do not enter the fit, which bounds the model's size.
FIT_BYTES = 512
#: Every CALIBRATION_FOLDth URL of the fit sets the threshold instead.
CALIBRATION_FOLD = 5
#: More rules than this belong into a join, not into an expression.
MOST_RULES = 1_000
START, END = 1, 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host after the first ``://`` with A-Z lower-cased, and path; both empty without one."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, null where none fits.

    Of rules of one length the one with the longer host wins, then a blocking one, then code points.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} fit an expression")
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _symbols(urls: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All URLs as one array of bytes with start and end marks, each symbol's place, and its URL."""
    lengths = np.fromiter((len(u) + 2 for u in urls), np.int64, len(urls))
    joined = b"".join(bytes([START]) + u + bytes([END]) for u in urls)
    first = np.cumsum(lengths) - lengths
    of = np.repeat(np.arange(len(urls)), lengths)
    return np.frombuffer(joined, np.uint8).astype(np.uint64), np.arange(len(of)) - first[of], of


def _grams(codes: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with a gram of that size inside their URL, and its bytes and size in one integer."""
    at = np.flatnonzero(place >= max(1, size - 1))
    key = np.full(len(at), size << 56, np.uint64)
    for back in range(size):
        key |= codes[at - back] << np.uint64(8 * back)
    return at, key


def _contexts(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys & np.uint64((1 << 56) - 1)) >> np.uint64(8)) | np.uint64((size - 1) << 56)


def _suffixes(keys: np.ndarray, size: int) -> np.ndarray:
    return (keys & np.uint64((1 << (8 * (size - 1))) - 1)) | np.uint64((size - 1) << 56)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


@dataclass
class MarkovModel:
    """Sorted grams with log probability, sorted contexts with the log weight of what they never saw."""
    grams: np.ndarray
    logp: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray
    order: int

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray, order: int = ORDER, min_context: int = MIN_CONTEXT) -> MarkovModel:
        """Witten-Bell interpolation over contexts of up to ``order`` bytes, cut where they are rare.

        ``keys`` are packed grams of 1 to order + 1 symbols with their counts.
        """
        grams, logp, contexts, rest = [], [], [], []
        shorter_keys, shorter_p = np.zeros(0, np.uint64), np.zeros(0)
        for size in range(1, order + 2):
            own = (keys >> np.uint64(56)) == size
            k, c = keys[own], counts[own].astype(float)
            by = np.argsort(k)
            k, c = k[by], c[by]
            context, where = np.unique(_contexts(k, size), return_inverse=True)
            total, kinds = np.bincount(where, c, len(context)), np.bincount(where, minlength=len(context))
            kept = total >= min_context
            k, c, where_kept = k[kept[where]], c[kept[where]], where[kept[where]]
            below = np.full(len(k), 1 / 256) if size == 1 else shorter_p[_find(shorter_keys, _suffixes(k, size))[0]]
            p = (c + kinds[where_kept] * below) / (total + kinds)[where_kept]
            shorter_keys, shorter_p = k, p
            grams.append(k), logp.append(np.log(p))
            contexts.append(context[kept]), rest.append(np.log(kinds[kept] / (total + kinds)[kept]))
        # The size is in the top byte, so the parts are in order.
        return cls(np.concatenate(grams), np.concatenate(logp), np.concatenate(contexts), np.concatenate(rest), order)

    def score(self, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Log probability of every symbol but the start marks, longest known context first."""
        out = np.full(len(codes), -np.log(256.0))
        for size in range(1, self.order + 2):
            at, key = _grams(codes, place, size)
            i, known = _find(self.grams, key)
            j, seen = _find(self.contexts, _contexts(key, size))
            if len(self.contexts):
                out[at] += np.where(seen, self.rest[j], 0.0)
            if len(self.grams):
                out[at[known]] = self.logp[i[known]]
        out[place == 0] = 0.0
        return out


@dataclass
class UrlRatio:
    accepted: MarkovModel
    rejected: MarkovModel
    slope: float
    shift: float

    def ratio(self, urls: list[bytes]) -> np.ndarray:
        """Difference of the log likelihoods over the number of symbols."""
        if not urls:
            return np.zeros(0)
        codes, place, of = _symbols(urls)
        diff = self.accepted.score(codes, place) - self.rejected.score(codes, place)
        return np.bincount(of, diff, len(urls)) / (np.bincount(of, minlength=len(urls)) - 1)

    def probability(self, urls: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.ratio(urls) + self.shift, -500, 500)))


def _platt(x: np.ndarray, accepted: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, both classes weighing the same, smoothed targets."""
    n1, n0 = accepted.sum(), (~accepted).sum()
    target = np.where(accepted, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(accepted, 0.5 / max(n1, 1), 0.5 / max(n0, 1))
    scale = max(float(np.abs(x).max(initial=0)), 1e-9)
    z, w = np.stack([x / scale, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (weight * (p - target)) + 1e-6 * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit_ratio(labelled: DataFrame, fit_urls: int = FIT_URLS, order: int = ORDER, min_context: int = MIN_CONTEXT) -> UrlRatio | None:
    """Models of accepted and rejected URLs and the calibration, from ``url`` and ``accepted``.

    At most ``fit_urls`` different URLs of each class enter, picked by hash, none above FIT_BYTES;
    rows with a null are left out. Grams are counted by Spark and bounded by the sample. Without
    both classes there is nothing to compare and the result is None.
    """
    urls = (labelled.select(F.col("url").cast("string").alias("url"), F.col("accepted").cast("boolean").alias("accepted"))
            .dropna().filter(F.octet_length("url") <= FIT_BYTES).distinct().withColumn("h", F.xxhash64("url")))
    picked = [urls.filter(F.col("accepted") == side).orderBy("h", "url").limit(fit_urls) for side in (True, False)]
    sample = picked[0].unionByName(picked[1]).withColumn("held", F.pmod("h", F.lit(CALIBRATION_FOLD)) == 0)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for side, part in rows.groupby("accepted"):
                codes, place, _ = _symbols([u.encode() for u in part["url"]])
                for size in range(1, order + 2):
                    keys, n = np.unique(_grams(codes, place, size)[1], return_counts=True)
                    yield pd.DataFrame({"accepted": side, "gram": keys.astype(np.int64), "n": n})

    counts = (sample.filter(~F.col("held")).mapInPandas(count, "accepted boolean, gram long, n long")
              .groupBy("accepted", "gram").agg(F.sum("n").alias("n")).toPandas())
    held = sample.filter("held").select("url", "accepted").toPandas()
    if counts["accepted"].nunique() < 2:
        return None
    models = [MarkovModel.fit(part["gram"].to_numpy().astype(np.uint64), part["n"].to_numpy(), order, min_context)
              for part in (counts[counts["accepted"]], counts[~counts["accepted"].astype(bool)])]
    ratio = UrlRatio(*models, 1.0, 0.0)
    if held["accepted"].nunique() == 2:
        ratio.slope, ratio.shift = _platt(ratio.ratio([u.encode() for u in held["url"]]), held["accepted"].to_numpy(bool))
    return ratio


def accept_probability(pages: DataFrame, model: UrlRatio | None, url: str = "url") -> Column:
    """Calibrated probability that a URL is one of the accepted; 1 without a model, null URLs are empty."""
    if model is None:
        return F.lit(1.0)
    model_of = sent(pages.sparkSession, model)  # bounded by the fit's sample

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_of()
        for urls in batches:
            code, different = pd.factorize(urls.fillna(""))
            yield pd.Series(model.probability([u.encode() for u in different])[code], dtype=float)

    return probability(F.col(url))


def judge(pages: DataFrame, rules: list[Rule], model: UrlRatio | None, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, accept_probability, verdict`` for every row of ``pages``.

    The longest fitting rule decides, else the models: allow at a calibrated probability of one half
    or more. Null and empty URLs, and those without ``://``, have an empty host and path, fit no rule
    that has a host, and are judged by their characters. Repeated rows give repeated answers; no rows
    give no rows; other columns are not read.
    """
    host, path = host_and_path("url")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    rows = rows.withColumn("url", F.coalesce("url", F.lit("")))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"), accept_probability(rows, model).alias("accept_probability"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("accept_probability") >= 0.5, "allow").otherwise("block")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "accept_probability")


def seed_labels(pages: DataFrame, words: tuple[str, ...], url: str = "url") -> DataFrame:
    """Weak labels: a URL whose host has one of the words between dots or hyphens is rejected, others accepted."""
    host, _ = host_and_path("url")
    hit = host.rlike(r"(^|[.-])(" + "|".join(map(re.escape, words)) + r")([.-]|$)")
    return pages.select(F.col(url).alias("url")).filter(host != "").select("url", (~hit).alias("accepted"))
